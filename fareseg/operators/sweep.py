"""Lloyd rounds for many models in one scan (the k sweep), pruned by triangle-inequality bounds.

Each Arrow batch of feature rows is assigned to the nearest centroid of every
active model with NumPy and reduced to sums per model and cluster; a task
emits one model-sized vector of them (see ``scan.py``). Models that have
converged drop out; the scan count is the largest round count, not the sum
over k. From the third scan on only rows that changed cluster are cut and added:
the sums of the round before, which are exact, plus what those rows change.

Bounds. After the first rounds a table is made, for some models, of the rows near a
border: with their cluster under the centroids of that round (the anchors) and
how much nearer that centroid is than the second nearest (their lead), least
lead first, up to an allowance of some times the model's last step. It is made
for the models of which scans of all rows have found that it would hold few of
them; the others go on with all rows, in the same job. As long as no row's lead outside it can be used up by what its centroid and the
farthest-moved other one have travelled, rounds scan this persisted table alone:
all other rows are where they were, and their share of the sums is part of the
anchors' own sums. In it only rows whose lead is used up are computed, and only
those that really moved change the sums; as sums are exact, the result has the
bits of a full scan. The same rule spares most rows the second assignment, under
the previous centroids, that the count of changed rows needs. When an allowance
is used up, a new table is made from all rows for the models that need one; the
tables of the others stay, up to ``MOST_TABLES`` of them.

Distances are accumulated feature by feature, left to right, exactly as the
column expressions and the SQL oracles do, so ties resolve the same way. Most
rows are told apart without them: a matrix product in single precision gives a
row's distances to all centroids with a proven bound of their error, and only
rows whose two nearest centroids lie within it are computed as above
(:class:`_Sieve`).
"""

from __future__ import annotations

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

from fareseg.operators.kmeans import ClusterStats, KMeansModel, loop_input, update_centroids
from fareseg.operators.sampling import seed_rows
from fareseg.operators.scan import Extent, Folds, blocked, extent, matrix, summed

#: Rounds before the first table of near rows.
FIRST_ROUNDS = 2
#: Scans of all rows count those that an allowance of so many last steps would take into the table.
TRIED_AHEAD = 8
#: Least and most last steps of an allowance.
AHEAD = (4, 256)
#: Share of all rows that an allowance of one step may take in for a model to be in the table.
MOST_NEAR = 0.04
#: Tables of near rows at a time; beyond, the models of the tables with fewest go into the new one.
MOST_TABLES = 6
#: Rows computed at a time, and rows of a block of near rows.
CHUNK = 4096
BLOCK = 16_384
#: Up to this many rows are computed with all centroids at once.
FEW = 256
#: Part of the distances by which a bound must be met, far above their rounding errors.
SLACK = 1e-9
#: Rows of one matrix product of the sieve, the most bits of a centroid's number in it, and the magnitudes of squares it takes.
SIEVE_ROWS = 5000
SIEVE_BITS = 8
SIEVE_RANGE = (1e-20, 1e30)


def _sq_dist(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(m, k) squared distances, summed over features in column order."""
    acc = np.zeros((len(x), len(c)))
    for f in range(x.shape[1]):
        diff = x[:, f, None] - c[None, :, f]
        acc += diff * diff
    return acc


def _nearest(x: np.ndarray, cents: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every row's nearest centroid (the first on ties) and its squared distances to it and to the next (infinite for a
    single centroid); the distances are those of :func:`_sq_dist`."""
    n, d = x.shape
    if n <= FEW:
        dist, at = _sq_dist(x, cents), np.arange(n)
        lab = dist.argmin(axis=1).astype(np.int32)
        near = dist[at, lab]
        dist[at, lab] = np.inf
        return lab, near, dist.min(axis=1)
    lab, near, second = np.zeros(n, np.int32), np.full(n, np.inf), np.full(n, np.inf)
    for at in range(0, n, CHUNK):
        columns = [np.ascontiguousarray(x[at:at + CHUNK, f]) for f in range(d)]
        to = slice(at, at + len(columns[0]))
        acc, diff = np.empty(len(columns[0])), np.empty(len(columns[0]))
        for j, c in enumerate(cents):
            for f, column in enumerate(columns):
                np.subtract(column, c[f], out=diff)
                if f:
                    diff *= diff
                    acc += diff
                else:
                    np.multiply(diff, diff, out=acc)
            np.copyto(lab[to], j, where=acc < near[to])
            np.minimum(second[to], np.maximum(near[to], acc, out=diff), out=second[to])
            np.minimum(near[to], acc, out=near[to])
    return lab, near, second


def _own_sq_dist(x: np.ndarray, cents: np.ndarray, lab: np.ndarray) -> np.ndarray:
    """Every row's squared distance to its own centroid; the distances are those of :func:`_sq_dist`."""
    acc = np.zeros(len(x))
    for f in range(x.shape[1]):
        diff = x[:, f] - cents[lab, f]
        acc += diff * diff
    return acc


def _middle(models) -> np.ndarray:
    """A point amid the centroids of some models."""
    return np.concatenate([*models]).mean(axis=0)


def _sq_norm(x: np.ndarray) -> np.ndarray:
    sq = x[:, 0] * x[:, 0]
    for f in range(1, x.shape[1]):
        sq = sq + x[:, f] * x[:, f]
    return sq


def _leads(near: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How much nearer the nearest centroid is than the next, less the rounding slack; infinite for a single centroid."""
    a, b = np.sqrt(near), np.sqrt(second)
    with np.errstate(invalid="ignore"):
        return np.where(np.isinf(b), np.inf, b - a - SLACK * (a + b))


class _Sieve:
    """The nearest centroids of a batch's rows, by a matrix product in single precision where that is certain.

    About a point ``centre`` near the rows, |x|^2 - 2 x.c + |c|^2 is off by at most E = g (|x|^2 + max |c|^2), where g
    covers the rounding of the numbers, of the product's ``columns + 2`` terms and of the last bits, which are taken
    for the centroid's number: least and next then come out of plain minima. E is added to every value, so that none is negative
    (and they are in order as integers) and each is an upper bound. Rows whose next value is within 2 E of the least are computed
    by :func:`_nearest`; for all others its distances, whose errors are far smaller, have the same order.
    """

    def __init__(self, x: np.ndarray, centre: np.ndarray) -> None:
        (n, d), self.x, self.centre = x.shape, x, centre
        about = x.T - centre[:, None]
        sq = np.einsum("ij,ij->j", about, about)
        top = float(sq.max(initial=0.0))
        self.usable = SIEVE_RANGE[0] < top < SIEVE_RANGE[1]
        if self.usable:
            self.rows = np.empty((d + 2, n), np.float32)
            self.rows[:d], self.rows[d], self.rows[d + 1] = about, 1.0, sq
            self.room = np.empty(min(n, SIEVE_ROWS) << SIEVE_BITS, np.float32)

    def assigned(self, cents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every row's nearest centroid as by :func:`_nearest`, and its lead (see :func:`_leads`) or a little less."""
        (n, d), k = self.x.shape, len(cents)
        c = cents - self.centre
        sq = (c * c).sum(axis=1)
        far, bits = float(sq.max()), (k - 1).bit_length()
        if k == 1:
            return np.zeros(n, np.int32), np.full(n, np.inf)
        if not self.usable or bits > SIEVE_BITS or not far < SIEVE_RANGE[1]:
            lab, near, second = _nearest(self.x, cents)
            return lab, _leads(near, second)
        g = 1.5 * ((d + 6) * 2.0 ** -23 + 2.0 ** (bits - 22))
        left = np.column_stack([-2.0 * c, sq + (g * far + SIEVE_RANGE[0] * 1e-9), np.full(k, 1.0 + g)]).astype(np.float32)
        mask, number = np.int32((1 << bits) - 1), np.arange(k, dtype=np.int32)[:, None]
        lab, lead, unsure = np.empty(n, np.int32), np.empty(n, np.float32), []
        for at in range(0, n, SIEVE_ROWS):
            to = slice(at, at + SIEVE_ROWS)
            part = self.rows[:, to]
            value = np.matmul(left, part, out=self.room[:k * part.shape[1]].reshape(k, -1))
            code = value.view(np.int32)
            np.bitwise_and(code, ~mask, out=code)
            np.bitwise_or(code, number, out=code)
            near = np.minimum.reduce(code, axis=0)
            np.bitwise_and(near, mask, out=lab[to])
            # how much more than the least, less one: of the least itself -1, the largest number without a sign
            near += 1
            code -= near
            second = np.minimum.reduce(value.view(np.uint32), axis=0).view(np.int32)
            second += near
            near -= 1
            near, second = near.view(np.float32), second.view(np.float32)
            # 2 E and what the additions here may be off
            second -= self.rows[d + 1, to] * np.float32(2.1 * g) + np.float32(2.1 * g * far + SIEVE_RANGE[0] * 1e-8)
            unsure.append(np.flatnonzero(~(second > near)) + at)
            a, b = np.sqrt(near), np.sqrt(np.maximum(second, 0.0, out=second))
            np.subtract(b, a, out=lead[to])
            lead[to] -= np.float32(1e-6) * (a + b)
        unsure = np.concatenate(unsure) if unsure else np.empty(0, int)
        if len(unsure):
            lab[unsure], near, second = _nearest(np.take(self.x.T, unsure, axis=1).T, cents)
            lead[unsure] = np.nextafter(_leads(near, second).astype(np.float32), np.float32(-np.inf))
        return lab, lead


def _travel(now: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Per centroid: its own way plus the longest way of any other."""
    way = np.sqrt(((now - then) ** 2).sum(axis=1)) * (1 + SLACK)
    if len(way) == 1:
        return way
    order = np.argsort(way)
    return way + np.where(np.arange(len(way)) == order[-1], way[order[-2]], way[order[-1]])


class _Tally:
    """The pieces of one batch's columns, and their sums by cluster."""

    def __init__(self, folds: Folds, x: np.ndarray, reach: np.ndarray) -> None:
        self.folds, self.x, self.reach, self.whole = folds, x, reach, None

    def _pieces(self, x: np.ndarray) -> np.ndarray:
        """By fold, column (the last is the squared norm) and row."""
        columns = [self.folds.split(x[:, c], r) for c, r in enumerate(self.reach)]
        return np.stack([*columns, self.folds.split(_sq_norm(x), float((self.reach * self.reach).sum()) * 1.01)], axis=1)

    def by(self, lab: np.ndarray, k: int) -> np.ndarray:
        """``(fold, (1 + columns) * k)``: count (in the first fold), column sums and squared-norm sums."""
        if self.whole is None:
            self.whole = self._pieces(self.x)
        out = np.zeros((self.folds.count, 1 + self.whole.shape[1], k))
        if len(lab):
            out[0, 0] = np.bincount(lab, minlength=k)
            for f, fold in enumerate(self.whole):
                for c, column in enumerate(fold):
                    out[f, 1 + c] = np.bincount(lab, weights=column, minlength=k)
        return out.reshape(self.folds.count, -1)


def _stats(pieces: np.ndarray, k: int, d: int) -> ClusterStats:
    m = Folds.joined(pieces).reshape(d + 2, k)
    return ClusterStats(m[0].copy(), m[1:1 + d].T.copy(), m[1 + d].copy())


def multi_round_scan(data: DataFrame | RDD, cols: list[str], models: dict[int, np.ndarray], size: Extent | None = None) -> dict[int, ClusterStats]:
    """One full scan: every model's ClusterStats, costs included, under its centroids."""
    size = size or extent(data, cols)
    folds, d = Folds(size.rows), len(cols)
    far = {m: float(((size.reach + np.abs(c).max(axis=0)) ** 2).sum()) * 1.01 for m, c in models.items()}
    centre = _middle(models.values())

    def kernel(x):
        tally, sieve, out = _Tally(folds, x, size.reach), _Sieve(x, centre), []
        for m, cents in models.items():
            lab = sieve.assigned(cents)[0]
            near = _own_sq_dist(x, cents, lab)
            out += [tally.by(lab, len(cents)), folds.sums(np.sqrt(near), far[m] ** 0.5)[:, None], folds.sums(near, far[m])[:, None]]
        return np.concatenate(out, axis=1)

    v = summed(data, cols, kernel, sum(len(c) * (d + 2) + 2 for c in models.values()), folds.count)
    out, at = {}, 0
    for m, cents in models.items():
        k = len(cents)
        st = out[m] = _stats(v[:, at:at + k * (d + 2)], k, d)
        st.sum_distance, st.wssse = (float(z) for z in Folds.joined(v[:, at + k * (d + 2):at + k * (d + 2) + 2]))
        at += k * (d + 2) + 2
    return out


def near_rows(blocks: RDD, models: list[tuple[np.ndarray, float, int]]) -> RDD:
    """``blocks`` of the rows whose lead under a model's centroids is at most its allowance, least lead first.

    ``models``: centroids, allowance and a number. After their count and values: the model's number, the rows' clusters, and
    their leads, rounded down.
    """
    centre = _middle(cents for cents, *_ in models)

    def run(batches):
        some: list[list] = [[] for _ in models]

        def block(i):
            x, c, lead = (np.concatenate(v, axis=-1) for v in zip(*some[i]))
            some[i] = []
            order = np.argsort(lead, kind="stable")
            return len(order), np.take(x, order, axis=1).tobytes(), models[i][2], c[order].tobytes(), lead[order].tobytes()

        for n, data in batches:
            x = matrix(n, data)
            sieve = _Sieve(x, centre)
            for i, (cents, allowance, _) in enumerate(models):
                at = np.flatnonzero(sieve.assigned(cents)[1] <= allowance)
                part = np.take(x.T, at, axis=1)
                lab, near, second = _nearest(part.T, cents)
                lead = np.nextafter(_leads(near, second).astype(np.float32), np.float32(-np.inf))
                some_at = np.flatnonzero(lead <= allowance)
                if len(some_at):
                    some[i].append((np.take(part, some_at, axis=1), lab[some_at], lead[some_at]))
                    if sum(len(h[1]) for h in some[i]) >= BLOCK:
                        yield block(i)
        for i, h in enumerate(some):
            if h:
                yield block(i)

    return blocks.mapPartitions(run)


def round_scan(data: DataFrame | RDD, size: Extent, models: dict[int, tuple], anchors: dict[int, tuple], tables: list[RDD] | None = None,
               before: dict[int, np.ndarray] | None = None) -> dict[int, tuple]:
    """One job of a round: for every model ``(pieces of its sums, changed rows, distances computed, near rows)``.

    ``models``: current and previous centroids (or None). ``anchors``: centroids, pieces and number of the models of
    ``tables``, those of near rows (a table may also hold models no longer taken from it); the other models scan ``data``,
    the blocks of all rows. Near rows are those of the table, or those that one with an allowance of ``TRIED_AHEAD`` steps would hold. ``before``: pieces
    under the previous centroids; a scan of all rows then cuts and adds the changed rows only.
    """
    before = {m: p for m, p in (before or {}).items() if m in models and m not in anchors and models[m][1] is not None}
    folds, d = Folds(size.rows), len(size.reach)
    then, start, width = {a[2]: m for m, a in anchors.items()}, {}, 0
    at_anchors = {m: a[0] for m, a in anchors.items()}
    for m, (cur, _) in models.items():
        start[m] = width
        width += len(cur) * (d + 2) + 3

    centre = _middle(cur for cur, _ in models.values())

    def changes(x, cur, prev, lab, lead):
        """Rows of x in another cluster under the previous centroids, that cluster, the distances that took, and rows that a
        table would hold."""
        step = _travel(cur, prev)
        unsure = np.flatnonzero(lead <= step[lab])
        tried = int((lead <= TRIED_AHEAD * step.max()).sum())
        was = _Sieve(np.take(x.T, unsure, axis=1).T, centre).assigned(prev)[0]
        other = was != lab[unsure]
        return unsure[other], was[other], len(unsure) * len(prev), tried

    def one(x, m, tally=None, sieve=None, was=None, lead=None):
        """A model's part: its sums, or what moved rows change of them, and the three counts."""
        (cur, prev), k, part = models[m], len(models[m][0]), x
        if was is not None:
            reach = _travel(cur, at_anchors[m])
            if prev is not None:
                reach = np.maximum(reach, _travel(prev, at_anchors[m]))
            some = np.searchsorted(lead, np.float32(np.nextafter(np.float32(reach.max()), np.float32(np.inf))), side="right")
            rows = np.flatnonzero(lead[:some] <= reach[was[:some]])
            was, part = was[rows], np.take(x.T, rows, axis=1).T
            sieve = _Sieve(part, centre)
        lab, ahead = sieve.assigned(cur)
        changed, earlier, again, tried = changes(part, cur, prev, lab, ahead) if prev is not None else (None, None, 0, len(x))
        if was is not None:
            moved = np.flatnonzero(lab != was)
            sums = shift(part, moved, lab[moved], was[moved], k)
        elif m in before:
            sums = shift(part, changed, lab[changed], earlier, k)
        else:
            sums = tally.by(lab, k)
        rest = np.zeros((folds.count, 3))
        rest[0] = len(x) if changed is None else len(changed), len(part) * k + again, tried if was is None else len(x)
        return np.concatenate([sums, rest], axis=1)

    def shift(x, moved, to, of, k):
        """What ``moved`` rows of x, from clusters ``of`` to clusters ``to``, change of the sums."""
        tally = _Tally(folds, np.take(x.T, moved, axis=1).T, size.reach)
        return tally.by(to, k) - tally.by(of, k)

    def kernel(x, i=None, was=None, lead=None):
        if i is None:
            tally, sieve = _Tally(folds, x, size.reach), _Sieve(x, centre)
            parts = {m: one(x, m, tally, sieve) for m in models if m not in anchors}
        else:
            m = then.get(i)
            parts = {m: one(x, m, was=np.frombuffer(was, np.int32), lead=np.frombuffer(lead, np.float32))} if m in models else {}
        out = np.zeros((folds.count, width))
        for m, part in parts.items():
            out[:, start[m]:start[m] + part.shape[1]] = part
        return out

    sources = [data] * bool(models.keys() - anchors.keys()) + (tables or []) * bool(models.keys() & anchors.keys())
    v = summed(sources, (), kernel, width, folds.count)
    out = {}
    for m, (cur, _) in models.items():
        at, n = start[m], len(cur) * (d + 2)
        pieces = v[:, at:at + n]
        if m in anchors:
            pieces = pieces + anchors[m][1]
        elif m in before:
            pieces = pieces + before[m]
        out[m] = pieces, *(int(c) for c in v[0, at + n:at + n + 3])
    return out


def kmeans_many(df: DataFrame, cols, inits: dict[int, np.ndarray], max_iter: int | None = None,
                persist: bool = True) -> dict[int, KMeansModel]:
    """Run one Lloyd fit per initial centroid array, all sharing each scan.

    Same stopping rule and round accounting as :func:`kmeans.kmeans_fit`.
    """
    cols = list(cols)
    d = len(cols)
    data, size = loop_input(df, cols) if persist else (blocked(df, cols), extent(df, cols))
    tables: list[tuple[RDD, set[int], int]] = []  # models that are taken from it, and how many it was made for
    made = 0
    try:
        cur = {m: np.array(c, dtype=float) for m, c in inits.items()}
        prev: dict[int, np.ndarray] = {}
        rounds, re = dict.fromkeys(cur, 0), {m: [] for m in cur}
        work, full = dict.fromkeys(cur, 0), dict.fromkeys(cur, 0)
        done: dict[int, bool] = {}
        anchors: dict[int, tuple] = {}
        sums: dict[int, np.ndarray] = {}
        allowed: dict[int, float] = {}
        scans = 0
        per_step: dict[int, float] = {}
        while len(done) < len(cur):
            active = {m: (c, prev.get(m) if rounds[m] >= 2 else None) for m, c in cur.items() if m not in done}
            found = round_scan(data, size, active, anchors, [t for t, *_ in tables], sums)
            scans += 1
            sums = {m: f[0] for m, f in found.items()}
            taken = {}
            for m, (pieces, changed, distances, near) in found.items():
                st = _stats(pieces, len(cur[m]), d)
                work[m] += distances
                full[m] += size.rows * len(cur[m]) * (2 if rounds[m] >= 2 else 1)
                if rounds[m]:
                    re[m].append(changed if rounds[m] >= 2 else size.rows)
                same = rounds[m] >= 2 and changed == 0
                if same or (max_iter is not None and rounds[m] >= max_iter):
                    done[m] = bool(same)
                    continue
                taken[m] = cur[m], pieces
                prev[m], cur[m] = cur[m], update_centroids(st, cur[m])
                rounds[m] += 1
                # the share of rows that an allowance of one step, as long as the last, takes in
                step = float(_travel(cur[m], prev[m]).max())
                share = near / max(size.rows, 1)
                per_step[m] = (share * step / allowed[m] if allowed[m] else 0.0) if m in anchors else share / TRIED_AHEAD
            if not persist or scans < FIRST_ROUNDS:
                continue
            spent = {m for m in taken if m in anchors and _travel(cur[m], anchors[m][0]).max() > allowed[m]}
            fit = {m for m in taken if per_step[m] <= MOST_NEAR and (m in spent or m not in anchors)}
            live = (taken.keys() & anchors.keys()) - spent
            # tables most of whose models are done or spent go, and so do small ones when there are too many; their other models move
            kept = [(t, ms & live, n) for t, ms, n in tables if 2 * len(ms & live) >= n]
            kept.sort(key=lambda table: -len(table[1]))
            kept = kept[:max(MOST_TABLES - bool(fit), 0)]
            moved = live - {m for _, ms, _ in kept for m in ms}
            for t, *_ in tables:
                if all(t is not u for u, *_ in kept):
                    t.unpersist()
            tables = kept
            fit |= {m for m in moved if per_step[m] <= MOST_NEAR}
            anchors = {m: a for m, a in anchors.items() if m in live - moved}
            if fit:
                # a table costs about one scan of all rows, each of its rounds its share of one: this many steps cost least
                mean = sum(per_step[m] * len(cur[m]) for m in fit) / sum(len(cur[m]) for m in fit)
                ahead = min(max(max(mean, 1e-12) ** -0.5, AHEAD[0]), AHEAD[1])
                allowed |= {m: ahead * float(_travel(cur[m], prev[m]).max()) for m in fit}
                anchors |= {m: (*taken[m], made + i) for i, m in enumerate(sorted(fit))}
                made += len(fit)
                new = near_rows(data, [(anchors[m][0], allowed[m], anchors[m][2]) for m in sorted(fit)])
                tables.append((new.persist(StorageLevel.MEMORY_AND_DISK), fit, len(fit)))
        last = multi_round_scan(data, cols, cur, size)
        for m, st in last.items():
            st.changed = re[m][-1] if re[m] else 0
        return {m: KMeansModel(cols, cur[m], last[m], rounds[m], done[m], re[m], work[m], full[m]) for m in cur}
    finally:
        for t, *_ in tables:
            t.unpersist()
        if persist:
            data.unpersist()


def k_sweep(df: DataFrame, cols, ks=range(2, 21), seed: int = 42, max_iter: int | None = None,
            key: str = "trip_id") -> dict[int, KMeansModel]:
    """k-means for every k in ``ks`` from nested seeds (the first k sample rows)."""
    ks = list(ks)
    seeds = seed_rows(df, max(ks), seed, list(cols), key)
    return kmeans_many(df, cols, {k: seeds[:k] for k in ks}, max_iter=max_iter)


def multi_silhouette(df: DataFrame, cols, fits: dict[int, KMeansModel]) -> dict[int, float]:
    """Silhouette of every fitted model in one scan (closed form, see kmeans)."""
    cols = list(cols)
    models = {m: (f.centroids, f.stats) for m, f in fits.items() if (f.stats.n > 0).sum() >= 2}

    centre = _middle(cent for cent, _ in models.values()) if models else None

    def kernel(x):
        sq, at, out, sieve = _sq_norm(x), np.arange(len(x)), [], _Sieve(x, centre) if models else None
        for cent, st in models.values():
            lab = sieve.assigned(cent)[0]
            live = np.flatnonzero(st.n > 0)
            n = st.n[live]
            inner = sum(x[:, [c]] * st.sums[live][:, c] for c in range(x.shape[1]))
            avg = (sq[:, None] + (st.sqnorm[live] / n)[None, :]) - 2.0 * inner / n[None, :]
            pos = np.searchsorted(live, lab)
            n_own = n[pos]
            with np.errstate(divide="ignore", invalid="ignore"):
                a = avg[at, pos] * n_own / (n_own - 1.0)
                avg[at, pos] = np.inf
                b = avg.min(axis=1)
                s = np.where(n_own == 1.0, 0.0, np.where(a < b, 1.0 - a / b, np.where(a > b, b / a - 1.0, 0.0)))
            out.append(folds.sums(s, 4.0))  # a score lies between -1 and 1, but for rounding
        return np.stack(out, axis=1) if out else np.zeros((folds.count, 0))

    rows = extent(df, cols).rows
    folds = Folds(rows)
    v = Folds.joined(summed(df, cols, kernel, len(models), folds.count))
    return {m: float(s / rows) for m, s in zip(models, v)} if rows else {}
