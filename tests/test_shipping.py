"""Task functions must reach workers that can't import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
os.environ.pop("PYTHONPATH", None)
import numpy as np
from fareseg.session import local_session
from fareseg.operators import mixture as X, sweep as SW
spark = local_session(cores=2)
rng = np.random.default_rng(0)
x = np.concatenate([rng.normal(m, 0.3, (60, 2)) for m in (0, 4)])
df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "trip_id long, a double, b double")
fits = SW.k_sweep(df, ["a", "b"], range(2, 4), 42)
start = X.Mixture(np.array([.5, .5]), x[[0, 100]], np.array([np.eye(2)] * 2))
model, _ = X.gmm_fit(df, ["a", "b"], start)
print("DONE", sorted(fits), model.converged)
"""


def test_kernels_run_without_the_package_on_the_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "DONE [2, 3] True" in out.stdout, out.stderr[-2000:]
