"""A fitted segmentation that can be saved, loaded and applied: a ``pyspark.ml`` model.

It holds what a new row needs: the scaling, the centroids, the mixture and the
fare thresholds, all model-sized. A save writes one row of Parquet into a staging
folder and then renames it to ``version=N`` (one rename, so a reader sees a
version whole or not at all). Loading reads the newest version, or a given one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark.ml import Model
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from fareseg.operators import mixture as X
from fareseg.operators import segments as G
from fareseg.operators.stats import FeatureStats
from fareseg.plans.models import clustered
from fareseg.schema import FEATURES

_SCHEMA = ("features array<string>, rows long, mean array<double>, var array<double>, centroids array<array<double>>, "
           "phi array<double>, mu array<array<double>>, sigma array<array<array<double>>>, thresholds map<string,map<double,double>>")


@dataclass
class Parts:
    """The values of a model; ``mixture`` and ``thresholds`` may be missing."""
    stats: FeatureStats
    centroids: np.ndarray
    mixture: X.Mixture | None = None
    thresholds: dict | None = None


class SegmentationModel(Model, MLWritable, MLReadable):
    """``transform`` adds ``cluster``, with a mixture ``component``, with thresholds the fare labels."""

    def __init__(self, parts: Parts | None = None) -> None:
        super().__init__()
        self.parts = parts

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = self.parts
        out = dataset.select("*", *G.label_columns(p.thresholds)) if p.thresholds else dataset
        out = clustered(out, p.stats, p.centroids)
        return X.predict(out, FEATURES, p.mixture, keep=out.columns) if p.mixture else out

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """The saved versions, oldest first."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """One rename that fails, rather than moves into it, where ``target`` is there already."""
    jvm = spark._jvm
    (a, fs), (b, _) = _folder(spark, source), _folder(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(a), fs.makeQualified(b), no_options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


class _Writer(MLWriter):
    """``save`` adds a version. ``overwrite`` isn't needed and changes nothing: older versions stay."""

    def __init__(self, model: SegmentationModel) -> None:
        super().__init__()
        self._model = model

    def saveImpl(self, path: str) -> None:
        spark, p = SparkSession.active(), self._model.parts
        m = p.mixture
        row = (list(p.stats.mean), p.stats.n, list(p.stats.mean.values()), list(p.stats.var.values()), np.asarray(p.centroids).tolist(),
               *((m.phi.tolist(), m.mu.tolist(), m.sigma.tolist()) if m else (None, None, None)),
               p.thresholds)
        staging = f"{path}/_staging-{uuid.uuid4().hex}"
        spark.createDataFrame([row], _SCHEMA).coalesce(1).write.parquet(staging)
        while not _renamed(spark, staging, f"{path}/version={max(versions(spark, path), default=0) + 1}"):
            pass  # another writer took that number first

    def save(self, path: str) -> None:
        self.saveImpl(path)


class _Reader(MLReader):
    def load(self, path: str, version: int | None = None) -> SegmentationModel:
        spark = SparkSession.active()
        found = versions(spark, path)
        if not found or version is not None and version not in found:
            raise FileNotFoundError(f"no such model version in {path}: {version or 'any'}")
        r = spark.read.schema(_SCHEMA).parquet(f"{path}/version={version or found[-1]}").first()
        stats = FeatureStats(r["rows"], dict(zip(r["features"], r["mean"])), dict(zip(r["features"], r["var"])))
        m = X.Mixture(np.array(r["phi"]), np.array(r["mu"]), np.array(r["sigma"])) if r["phi"] is not None else None
        return SegmentationModel(Parts(stats, np.array(r["centroids"]), m, r["thresholds"]))
