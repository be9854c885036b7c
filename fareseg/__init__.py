"""fareseg: Spark-native trip segmentation.

Raw trip lines are cleaned and turned into features, sampled reproducibly,
labelled by fare-per-mile quantiles and clustered with k-means and a
Gaussian mixture seeded from it. Everything is a DataFrame plan; only
model-sized results (k rows) come back to the driver between rounds.
"""

import sys

from pyspark import cloudpickle

from fareseg.schema import FARES, FEATURES, TRIP_COLUMNS  # noqa: F401

__all__ = ["FARES", "FEATURES", "TRIP_COLUMNS"]

# Task functions travel whole with the job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
