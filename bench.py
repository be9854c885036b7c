"""Headline-query timings; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8).
The training sample is built once (checkpointed) and every timed step runs
on the whole of it: cleaning, sampling, quantile labels, k-means with k = 5
to convergence, the k = 2..20 sweep, EM seeded from the k-means clusters and
both summaries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from pyspark.sql import functions as F

    from fareseg.operators import kmeans as K
    from fareseg.operators import mixture as X
    from fareseg.operators import sampling as S
    from fareseg.operators import segments as G
    from fareseg.operators import stats as ST
    from fareseg.operators import sweep as SW
    from fareseg.operators.clean import reject_counts, trips_from_raw
    from fareseg.plans.models import clustered
    from fareseg.schema import FEATURES
    from fareseg.session import local_session
    from fareseg.sources.fixtures import raw_trips

    spark = local_session(cores=cpus, event_log_dir=None)
    times: dict[str, float] = {}
    info: dict[str, object] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        print(f"[bench] {name}: {times[name]}s", file=sys.stderr, flush=True)
        return out

    raw = raw_trips(spark, sf_dir).persist()
    timed("raw_lines", lambda: raw.count())
    trips = trips_from_raw(raw)
    info["trips"] = timed("clean_features", lambda: trips.count())
    timed("reject_counts", lambda: reject_counts(raw).collect())
    timed("sample_half", lambda: S.sample_exact(trips, max(1, info["trips"] // 2), 7).count())
    train = timed("training_sample", lambda: trips.checkpoint(eager=True))
    th = timed("fare_quantiles_labels", lambda: G.fare_thresholds(train))
    stats = timed("feature_stats", lambda: ST.feature_stats_row(train, FEATURES))
    z = ST.scaled_features(train, FEATURES, stats=stats).persist()
    z.count()
    seeds = S.seed_rows(z, 20, 42, FEATURES)
    km = timed("kmeans_k5", lambda: K.kmeans_fit(z, FEATURES, init=seeds[:5]))
    info["kmeans_rounds"] = km.rounds
    info["kmeans_converged"] = km.converged
    timed("silhouette_k5", lambda: K.model_silhouette(z, km))
    labelled = train.select("*", *G.label_columns(th))
    kl = clustered(labelled, stats, km.centroids)
    timed("cluster_summary", lambda: G.segment_summary(kl, "cluster").collect())
    fits = timed("k_sweep_2_20", lambda: SW.k_sweep(z, FEATURES, range(2, 21), 42))
    info["sweep_max_rounds"] = max(f.rounds for f in fits.values())
    info["sweep_all_converged"] = all(f.converged for f in fits.values())
    timed("sweep_silhouettes", lambda: SW.multi_silhouette(z, FEATURES, fits))
    import numpy as np
    center = np.array([stats.mean[c] for c in FEATURES])
    init = timed("gmm_init", lambda: X.init_from_clusters(kl, FEATURES, "cluster", 5, center))
    gm, _ = timed("gmm_fit", lambda: X.gmm_fit(train, FEATURES, init, center=center))
    info["gmm_rounds"] = gm.rounds
    info["gmm_converged"] = gm.converged
    timed("component_summary", lambda: G.segment_summary(
        X.predict(labelled, FEATURES, gm, keep=labelled.columns), "component").collect())
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "segmentation_total", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": int(cpus), "info": info}))
    spark.stop()


if __name__ == "__main__":
    main()
