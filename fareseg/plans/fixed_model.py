"""A fixed mixture used to check the per-row E-step operators against SQL.

The values are parameters (a plausible 3-component model over the 7 trip
features), not data: the checked queries run it over the whole trips table.
"""

from __future__ import annotations

import numpy as np

from fareseg.operators.mixture import Mixture

# Component means, feature standard deviations, correlations.
MU = [
    [2.0, 8.0, -73.96, 40.70, -73.95, 40.68, 20.0],
    [4.0, 14.0, -73.99, 40.74, -74.00, 40.72, 30.0],
    [6.0, 20.0, -74.02, 40.78, -73.97, 40.76, 12.0],
]
PHI = [0.5, 0.3, 0.2]
SD = [2.0, 6.9, 0.06, 0.07, 0.06, 0.07, 14.4]
CORR = {(2, 4): 0.3, (3, 5): 0.3, (1, 6): 0.2}


def fixed_mixture() -> Mixture:
    d = len(SD)
    r = np.eye(d)
    for (a, b), v in CORR.items():
        r[a, b] = r[b, a] = v
    sig = []
    for j in range(len(MU)):
        s = np.array(SD) * (1.0 + 0.25 * j)
        sig.append(np.outer(s, s) * r)
    return Mixture(np.array(PHI), np.array(MU), np.array(sig))
