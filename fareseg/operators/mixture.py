"""Gaussian mixture fitted by EM, seeded from k-means clusters.

The model (phi, mu, sigma: k x d x d) lives on the driver. Every E-step is a
set of column expressions with the model as literals: per component, the
deviation from mu is projected on the eigenvectors of sigma scaled by
1/sqrt(eigenvalue) (pseudo-inverse: eigenvalues at or below a relative
cutoff are dropped, as a singular-tolerant normal density does), giving the
log density; responsibilities are normalised in log space. The M-step is one
global aggregate of responsibility-weighted moments about a fixed centre,
so a round needs no join and returns one row.

``em_schedule="two_phase"`` (default) follows the reference round: phi is
updated first, then mu and sigma use responsibilities computed with the new
phi and the old Gaussians (two scans). ``"single"`` is textbook EM (one scan).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame

from fareseg.functions.vector import first_argmax, lit, q, sum_sql
from fareseg.operators.scan import Extent, Folds, column_sums, extent, matrix, summed

LOG_2PI = math.log(2.0 * math.pi)
# Eigenvalues below 1e6 * machine epsilon * largest |eigenvalue|
# are treated as zero; exp() of a log density below this underflows to 0.
EIG_CUTOFF_FACTOR = 1e6
# A singular Gaussian has density 0 off its subspace: further than this many times the
# standard deviation at the eigenvalue cut-off along a dropped direction.
SUPPORT_FACTOR = 10.0
LOG_UNDERFLOW = math.log(np.nextafter(0.0, 1.0))
#: Rows of one matrix product, and bits of the pieces that those of the moments multiply: 2 * 20 + 12 <= 53.
CHUNK = 2048
PIECE_BITS = 20
MOMENT_PIECES = 6


@dataclass
class Gaussian:
    mu: np.ndarray          # (d,)
    proj: np.ndarray        # (d, rank)
    log_pdet: float
    rank: int
    null: np.ndarray        # (d, d - rank): dropped directions
    reach: float            # how far along them a point may lie and still be in the support


@dataclass
class Mixture:
    phi: np.ndarray         # (k,)
    mu: np.ndarray          # (k, d)
    sigma: np.ndarray       # (k, d, d)
    rounds: int = 0
    converged: bool = False
    deltas: list[float] = field(default_factory=list)

    @property
    def k(self) -> int:
        return len(self.phi)


def prepare(mu: np.ndarray, sigma: np.ndarray) -> Gaussian:
    s, u = np.linalg.eigh(np.asarray(sigma, dtype=float))
    top = float(np.max(np.abs(s))) if s.size else 0.0
    eps = EIG_CUTOFF_FACTOR * np.finfo(float).eps * top
    keep = s > eps
    proj = u[:, keep] / np.sqrt(s[keep])
    return Gaussian(np.asarray(mu, float), proj, float(np.sum(np.log(s[keep]))), int(keep.sum()), u[:, ~keep],
                    SUPPORT_FACTOR * math.sqrt(eps))


def _projections(cols, gs: list[Gaussian]) -> list[str]:
    out = []
    for j, g in enumerate(gs):
        for i in range(g.rank):
            terms = [f"(({q(c)} - {lit(g.mu[a])}) * {lit(g.proj[a, i])})" for a, c in enumerate(cols)]
            out.append(f"{sum_sql(terms)} as _z{j}_{i}")
        for i in range(g.null.shape[1]):
            terms = [f"(({q(c)} - {lit(g.mu[a])}) * {lit(g.null[a, i])})" for a, c in enumerate(cols)]
            out.append(f"{sum_sql(terms)} as _o{j}_{i}")
    return out


def _logpdf(j: int, g: Gaussian) -> str:
    maha = sum_sql([f"(_z{j}_{i} * _z{j}_{i})" for i in range(g.rank)]) if g.rank else "0.0D"
    dens = f"(-0.5D * ({lit(g.rank * LOG_2PI + g.log_pdet)} + ({maha})))"
    if not g.null.shape[1]:
        return dens
    off = " or ".join(f"abs(_o{j}_{i}) > {lit(g.reach)}" for i in range(g.null.shape[1]))
    return f"(case when {off} then double('-Infinity') else {dens} end)"


def log_density(df: DataFrame, cols, model: Mixture, keep=("trip_id",)) -> DataFrame:
    """Adds ``_ld0 .. _ld{k-1}``: log N(x | mu_j, sigma_j)."""
    gs = [prepare(model.mu[j], model.sigma[j]) for j in range(model.k)]
    keep = [q(c) for c in keep]
    step = df.selectExpr(*keep, *[q(c) for c in cols if q(c) not in keep], *_projections(cols, gs))
    return step.selectExpr(*keep, *[q(c) for c in cols if q(c) not in keep],
                           *[f"{_logpdf(j, g)} as _ld{j}" for j, g in enumerate(gs)])


def responsibilities(df: DataFrame, cols, model: Mixture, keep=("trip_id",), underflow: str = "exact") -> DataFrame:
    """Adds ``_r0 .. _r{k-1}`` (sum to 1) and ``_lp`` = the log posterior
    numerators' maximum; keeps the ``keep`` and feature columns."""
    k = model.k
    dens = log_density(df, cols, model, keep)
    base = [q(c) for c in dict.fromkeys([*keep, *cols])]
    lw = [f"(_ld{j} + {lit(math.log(model.phi[j]))})" if model.phi[j] > 0 else "double('-Infinity')"
          for j in range(k)]
    step = dens.selectExpr(*base, *[f"_ld{j}" for j in range(k)], *[f"{lw[j]} as _l{j}" for j in range(k)])
    step = step.selectExpr(*base, *[f"_ld{j}" for j in range(k)], *[f"_l{j}" for j in range(k)],
                           "greatest(" + ", ".join(f"_l{j}" for j in range(k)) + ") as _m")
    step = step.selectExpr(*base, *[f"_ld{j}" for j in range(k)], *[f"_l{j}" for j in range(k)], "_m",
                           *[f"exp(_l{j} - _m) as _e{j}" for j in range(k)])
    total = sum_sql([f"_e{j}" for j in range(k)])
    # a row off every support gets the weights themselves
    r = [f"case when _m = double('-Infinity') then {lit(model.phi[j])} else _e{j} / ({total}) end" for j in range(k)]
    if underflow == "uniform":
        # every density underflows to 0 -> the reference falls back to 1/k, i.e. r = phi
        cond = "greatest(" + ", ".join(f"_ld{j}" for j in range(k)) + f") < {lit(LOG_UNDERFLOW)}"
        r = [f"case when {cond} then {lit(model.phi[j])} else {r[j]} end" for j in range(k)]
    elif underflow != "exact":
        raise ValueError("underflow must be 'exact' or 'uniform'")
    return step.selectExpr(*base, *[f"{r[j]} as _r{j}" for j in range(k)],
                           *[f"_l{j}" for j in range(k)])


def predict(df: DataFrame, cols, model: Mixture, keep=("trip_id",), name: str = "component") -> DataFrame:
    """Most likely component (first index on ties)."""
    rs = responsibilities(df, cols, model, keep)
    return rs.selectExpr(*[q(c) for c in keep], f"{first_argmax([f'_l{j}' for j in range(model.k)])} as {q(name)}")


# -- moments -------------------------------------------------------------------
def _pairs(d):
    return [(a, b) for a in range(d) for b in range(a, d)]


def _moment_size(k: int, d: int) -> int:
    return k * (1 + d + d * (d + 1) // 2)


def _cut(values: np.ndarray, e: int, out: np.ndarray) -> None:
    """``values`` (overwritten), of magnitude 2^e at most, as ``out``'s three pieces of ``PIECE_BITS`` bits each.

    Adding and taking away 1.5 * 2^52 times a grid rounds to a multiple of it.
    """
    for i, piece in enumerate(out):
        shift = math.ldexp(1.5, 52 + e - PIECE_BITS * (i + 1))
        np.add(values, shift, out=piece)
        piece -= shift
        if i + 1 < len(out):
            values -= piece


class _MomentSums:
    """Exact pieces of W_j, S_j and the upper triangle of Q_j for weights (0 to 1) and centred rows, a chunk at a time.

    Features are divided by powers of two above their reach, so that one grid fits them and their products.
    Weights and products are cut into pieces so short that a matrix
    product over ``CHUNK`` rows, whatever its order, adds whole multiples of one
    grid below 2^53 of them. Its sums are cut once more, so that up to 2^26
    chunks add up exactly: :meth:`pieces` are ``(MOMENT_PIECES, size)``, coarsest first.
    """

    def __init__(self, k: int, reach: np.ndarray) -> None:
        e, pairs = np.clip(np.frexp(reach)[1], -400, 450), _pairs(len(reach))
        self.down = np.ldexp(1.0, -e)[:, None]
        self.up = np.ldexp(1.0, np.array([0, *e, *[e[a] + e[b] for a, b in pairs]]))
        self.total = np.zeros((MOMENT_PIECES, k, len(self.up)))

    def add(self, r: np.ndarray, xc: np.ndarray) -> None:
        """``r``: ``(k, rows)``, ``xc``: ``(d, rows)``, of ``CHUNK`` rows at most."""
        (k, n), d, at, columns = r.shape, len(xc), len(xc), len(self.up)
        v, p, w = np.empty((columns - 1, n)), np.empty((3, columns, n)), np.empty((3, k, n))
        np.multiply(xc, self.down, out=v[:d])
        for a in range(d):
            np.multiply(v[a], v[a:d], out=v[at:at + d - a])
            at += d - a
        p[:, 0] = np.array([1.0, 0.0, 0.0])[:, None]
        _cut(v, 0, p[:, 1:])
        _cut(r.copy(), 1, w)
        by = [w[:3 - i].reshape(-1, n) @ p[i].T for i in range(3)]
        levels = by[0][:k], by[0][k:2 * k] + by[1][:k], by[0][2 * k:] + by[1][k:] + by[2]
        for i, level in enumerate(levels):
            coarse = 2.0 ** (26 - PIECE_BITS * (i + 2))
            high = np.rint(level / coarse) * coarse
            self.total[2 * i] += high
            self.total[2 * i + 1] += level - high

    def pieces(self) -> np.ndarray:
        return (self.total * self.up).reshape(MOMENT_PIECES, -1)


def _moment_pieces(r: np.ndarray, xc: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Summed pieces (see :class:`_MomentSums`) of weights ``(rows, k)`` and centred rows ``(rows, d)``."""
    sums = _MomentSums(r.shape[1], reach)
    for at in range(0, len(xc), CHUNK):
        sums.add(np.ascontiguousarray(r[at:at + CHUNK].T), np.ascontiguousarray(xc[at:at + CHUNK].T))
    return sums.pieces()


def _moments(v: np.ndarray, k: int, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m = v.reshape(k, -1)
    Q = np.zeros((k, d, d))
    for n, (a, b) in enumerate(_pairs(d)):
        Q[:, a, b] = Q[:, b, a] = m[:, 1 + d + n]
    return m[:, 0].copy(), m[:, 1:1 + d].copy(), Q


def centred_reach(data: DataFrame | RDD, cols, center: np.ndarray) -> np.ndarray:
    """Each column's largest distance from ``center``, of a table (null or non-finite values are an error) or of blocks."""
    if isinstance(data, DataFrame):
        return extent(data.selectExpr(*[f"cast({q(c)} as double) - {lit(v)} as {q(c)}" for c, v in zip(cols, center)]), cols).reach
    return data.map(lambda b: np.abs(matrix(*b) - center).max(axis=0)).fold(np.zeros(len(center)), np.maximum)


def weighted_moments(df: DataFrame, cols, weights: list[str], center: np.ndarray) -> tuple:
    """One scan: W_j, S_j (d), Q_j (d x d) of the weights (SQL expressions, 0 to 1)
    over features centred at ``center``. Returns numpy arrays."""
    d, k = len(cols), len(weights)
    data = df.selectExpr(*[q(c) for c in cols], *[f"{w} as _w{j}" for j, w in enumerate(weights)])
    reach = centred_reach(data, cols, center)

    def kernel(x):
        return _moment_pieces(x[:, d:], x[:, :d] - center, reach)

    return _moments(Folds.joined(summed(data, data.columns, kernel, _moment_size(k, d), MOMENT_PIECES)), k, d)


def moments_to_params(W, S, Q, center) -> tuple[np.ndarray, np.ndarray]:
    """Weighted mean and covariance about that mean, per component."""
    k, d = S.shape
    mu = np.zeros((k, d))
    sigma = np.zeros((k, d, d))
    for j in range(k):
        if W[j] <= 0:
            mu[j] = center
            continue
        m = S[j] / W[j]
        mu[j] = center + m
        sigma[j] = Q[j] / W[j] - np.outer(m, m)
        sigma[j] = (sigma[j] + sigma[j].T) / 2.0
    return mu, sigma


def sigma_as_written(W, S, Q, center) -> np.ndarray:
    """The reference's component covariance: for component j it subtracts
    mu_j from the scalar feature j of each row, which gives
    var_w(x_j) + (mu_jj - mu_j)(mu_jj - mu_j)'. Needs k <= d."""
    k, d = S.shape
    if k > d:
        raise IndexError("the as-written covariance needs k <= number of features")
    mu, sigma = moments_to_params(W, S, Q, center)
    out = np.zeros((k, d, d))
    for j in range(k):
        u = mu[j, j] - mu[j]
        out[j] = sigma[j, j, j] + np.outer(u, u)
    return out


def init_from_clusters(df: DataFrame, cols, cluster_col: str, k: int, center: np.ndarray) -> Mixture:
    """EM seed: phi = n_c / N, mu = cluster mean, sigma = population
    covariance about it; one aggregate (hard 0/1 weights)."""
    weights = [f"cast({q(cluster_col)} = {j} as double)" for j in range(k)]
    W, S, Q = weighted_moments(df, cols, weights, center)
    mu, sigma = moments_to_params(W, S, Q, center)
    live = W > 0
    return Mixture(W[live] / W.sum(), mu[live], sigma[live])


def gmm_fit(df: DataFrame, cols, init: Mixture, tol: float = 1e-4, max_iter: int | None = None,
            em_schedule: str = "two_phase", center: np.ndarray | None = None, persist: bool = True,
            underflow: str = "exact", covariance: str = "weighted", ridge: float = 0.0) -> tuple[Mixture, Mixture]:
    """EM until sum |delta phi| <= tol (checked before the M-step of each
    round, which still runs, as in the reference). Returns (final model,
    lagged model) where the lagged one is what the reference labels with:
    last phi, Gaussians from before the last M-step.

    Each scan's sums are exact (see ``scan.py``), so the model has the same bits
    however the rows are partitioned.

    ``covariance="as_written"`` fits with the reference's component covariance
    (see :func:`sigma_as_written`; k <= number of features). ``ridge`` is added
    to the diagonal of every covariance, the seeds' too, in the features' own
    squared units, so the features should be on one scale.
    """
    if covariance not in ("weighted", "as_written"):
        raise ValueError("covariance must be 'weighted' or 'as_written'")
    from fareseg.operators.kmeans import loop_input

    cols = list(cols)
    data, size = loop_input(df, cols) if persist else (df.select(*cols), extent(df, cols))
    try:
        if center is None:
            total = column_sums(df, {c: q(c) for c in cols}, dict(zip(cols, size.reach)), size.rows)
            center = np.array([total[c] / size.rows for c in cols], float)
        reach = centred_reach(data, cols, center)
        lift = ridge * np.eye(len(cols))
        model = Mixture(np.array(init.phi, float), np.array(init.mu, float), np.array(init.sigma, float) + lift)
        deltas: list[float] = []
        lagged = model
        rounds = 0
        while True:
            if em_schedule == "two_phase":
                W0 = batched_weights(data, cols, model, center, size, underflow)
                new_phi = W0 / W0.sum()
                delta = float(np.sum(np.abs(new_phi - model.phi)))
                model = Mixture(new_phi, model.mu, model.sigma)
                W, S, Q = batched_moments(data, cols, model, center, reach, underflow)
            elif em_schedule == "single":
                W, S, Q = batched_moments(data, cols, model, center, reach, underflow)
                new_phi = W / W.sum()
                delta = float(np.sum(np.abs(new_phi - model.phi)))
            else:
                raise ValueError("em_schedule must be 'two_phase' or 'single'")
            lagged = Mixture(new_phi, model.mu, model.sigma)
            mu, sigma = moments_to_params(W, S, Q, center)
            if covariance == "as_written":
                sigma = sigma_as_written(W, S, Q, center)
            sigma = sigma + lift
            rounds += 1
            deltas.append(delta)
            model = Mixture(new_phi, mu, sigma, rounds, False, deltas)
            # NaN > tol is false: a NaN change ends the loop, as in the reference
            if not (delta > tol):
                model.converged = not math.isnan(delta)
                return model, lagged
            if max_iter is not None and rounds >= max_iter:
                return model, lagged
    finally:
        if persist:
            data.unpersist()


def mixture_frame(spark, model: Mixture, cols) -> DataFrame:
    rows = [(j, float(model.phi[j]), [float(v) for v in model.mu[j]],
             [[float(v) for v in row] for row in model.sigma[j]]) for j in range(model.k)]
    return spark.createDataFrame(rows, "component int, phi double, mu array<double>, sigma array<array<double>>")


# -- Arrow-batched E-step + moments for the EM loop ----------------------------
class _EStep:
    """Responsibilities of a batch's rows, ``CHUNK`` at a time.

    A row's projections on the axes of all components are one matrix product,
    always of ``CHUNK`` columns (the last chunk is filled up with the centre), so that
    a row's bits depend on nothing but the row and the model.
    """

    def __init__(self, model: Mixture, center: np.ndarray, underflow: str) -> None:
        gs = [prepare(model.mu[j], model.sigma[j]) for j in range(model.k)]
        axes = [np.concatenate([g.proj, g.null], axis=1) for g in gs]
        offsets = [(center - g.mu) @ a for g, a in zip(gs, axes)]
        self.axes = np.column_stack([np.concatenate([a.T for a in axes]), np.concatenate(offsets)])
        self.center, self.underflow = center, underflow
        self.singular = [(j, g.rank, g.reach) for j, g in enumerate(gs) if g.null.shape[1]]
        self.const = np.array([g.rank * LOG_2PI + g.log_pdet for g in gs])[:, None]
        self.phi = np.asarray(model.phi, float)[:, None]

    def chunks(self, x: np.ndarray):
        """``(k, rows)`` responsibilities and ``(d, rows)`` centred values of each chunk."""
        d = x.shape[1]
        xc = np.empty((d + 1, CHUNK))
        xc[d] = 1.0
        for at in range(0, len(x), CHUNK):
            n = min(CHUNK, len(x) - at)
            xc[:d, n:] = 0.0
            np.subtract(x[at:at + n].T, self.center[:, None], out=xc[:d, :n])
            yield self._of(xc)[:, :n], xc[:d, :n]

    def _of(self, xc: np.ndarray) -> np.ndarray:
        z = (self.axes @ xc).reshape(len(self.phi), -1, xc.shape[1])
        off = [(j, (np.abs(z[j, rank:]) > reach).any(axis=0)) for j, rank, reach in self.singular]
        np.multiply(z, z, out=z)
        for j, rank, _ in self.singular:
            z[j, rank:] = 0.0
        ld = z[:, 0]
        for i in range(1, z.shape[1]):
            ld += z[:, i]
        ld += self.const
        ld *= -0.5
        for j, rows in off:
            ld[j, rows] = -np.inf
        with np.errstate(divide="ignore"):
            lw = ld + np.log(self.phi)
        top = np.maximum.reduce(lw, axis=0)
        apart = not np.isfinite(top).all()
        if apart:
            top = np.where(np.isfinite(top), top, 0.0)
        lw -= top
        r = np.exp(lw, out=lw)
        total = r[0].copy()
        for e in r[1:]:
            total += e
        if apart:  # a row off every support gets the weights themselves
            some = total > 0
            r = np.where(some, r / np.where(some, total, 1.0), self.phi)
        else:
            r /= total
        if self.underflow == "uniform":
            r = np.where(np.maximum.reduce(ld, axis=0) < LOG_UNDERFLOW, self.phi, r)
        return r


def batched_weights(data: DataFrame | RDD, cols, model: Mixture, center: np.ndarray, size: Extent, underflow: str = "exact") -> np.ndarray:
    """One scan: each component's summed responsibilities, without the moments."""
    step, folds = _EStep(model, center, underflow), Folds(size.rows)

    def kernel(x):
        return sum((folds.split(r, 1.0).sum(axis=2) for r, _ in step.chunks(x)), np.zeros((folds.count, len(step.phi))))

    return Folds.joined(summed(data, cols, kernel, model.k, folds.count))


def batched_moments(data: DataFrame | RDD, cols, model: Mixture, center: np.ndarray, reach: np.ndarray, underflow: str = "exact") -> tuple:
    """One scan: (W, S, Q) of the responsibilities under ``model``, about ``center``; ``reach``: that of :func:`centred_reach`."""
    d, k, step = len(cols), model.k, _EStep(model, center, underflow)

    def kernel(x):
        sums = _MomentSums(k, reach)
        for r, xc in step.chunks(x):
            sums.add(r, xc)
        return sums.pieces()

    return _moments(Folds.joined(summed(data, cols, kernel, _moment_size(k, d), MOMENT_PIECES)), k, d)
