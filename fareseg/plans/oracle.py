"""DuckDB SQL oracles, one per registered query.

Written independently of the Spark code: the same fixture text, then plain
SQL for every rule, aggregate and iteration (recursive CTEs that stop where
the fits stop). Floats are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from fareseg.functions.numeric import DATETIME_PATTERN, NUMBER_PATTERN
from fareseg.schema import FARES, FEATURES, SWEEP_KS
from fareseg.sources.fixtures import raw_trips_sql

SEED = 42
SAMPLE_ROWS = 5000
SMALL_SAMPLE = 40


def num(s: str) -> str:
    return f"(case when regexp_full_match({s}, '{NUMBER_PATTERN}') then try_cast({s} as double) end)"


def fin(x: str) -> str:
    return f"coalesce(isfinite({x}), false)"


def md5_key(seed: int = SEED, key: str = "trip_id") -> str:
    return f"md5('{seed}:' || cast({key} as varchar))"


def r6(x: str) -> str:
    return f"round({x}, 6)"


_NUMERIC = {"secs": 5, "distance": 6, "pu_lon": 7, "pu_lat": 8, "do_lon": 9, "do_lat": 10,
            "fare": 12, "surcharge": 13, "tip": 15, "toll": 16}

RULE_SQL = [
    ("arity", "n_fields = 17"),
    ("key", "(coalesce(medallion, '') <> '' or coalesce(hack_license, '') <> '' or coalesce(pickup_datetime, '') <> '')"),
    ("number", f"({fin('secs')} and {fin('distance')} and {fin('fare')} and {fin('tip')})"),
    ("time_zero", "secs <> 0"),
    ("distance_zero", "distance <> 0"),
    ("fare_range", "fare between 1 and 600"),
    ("surcharge", f"(surcharge >= 0 and {fin('surcharge')})"),
    ("tip", f"(tip >= 0 and {fin('tip')})"),
    ("toll", f"(toll >= 0 and {fin('toll')})"),
    ("longitude", "(pu_lon between -80 and -71 and do_lon between -80 and -71)"),
    ("latitude", "(pu_lat between 40 and 45 and do_lat between 40 and 45)"),
    ("datetime", "ts is not null"),
]


def _ok(cond: str) -> str:
    return f"coalesce({cond}, false)"


ALL_RULES = " and ".join(_ok(c) for _, c in RULE_SQL)
FIRST_FAILED = "case " + " ".join(f"when not {_ok(c)} then '{n}'" for n, c in RULE_SQL) + " else 'kept' end"

_fields = ", ".join(f"{num(f'p[{i}]')} as {n}" for n, i in _NUMERIC.items())

BASE: dict[str, str] = {
    "raw": raw_trips_sql("duckdb"),
    "sp": "select trip_id, string_split(line, ',') as p from raw",
    "parsed": f"""select trip_id, cast(len(p) as integer) as n_fields,
        p[1] as medallion, p[2] as hack_license, p[3] as pickup_datetime,
        case when regexp_full_match(p[3], '{DATETIME_PATTERN}') then try_cast(p[3] as timestamp) end as ts,
        {_fields}
        from sp""",
    "clean": f"select * from parsed where {ALL_RULES}",
    "trips": """select trip_id, cast(isodow(ts) as integer) as weekday, cast(hour(ts) as integer) as hour,
        pu_lon, pu_lat, do_lon, do_lat, secs / 60.0 as trip_min, fare, surcharge, tip, toll, distance
        from clean""",
    "train": "select * from trips",
}

DEPS = {
    "raw": [], "sp": ["raw"], "parsed": ["sp"], "clean": ["parsed"], "trips": ["clean"],
    "train": ["trips"],
}


def with_ctes(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} as ({BASE[n]})" for n in order]
    for n, body in extra or []:
        parts.append(f"{n} as {body}" if body.lstrip().lower().startswith("materialized") else f"{n} as ({body})")
    return "with recursive " + ",\n".join(parts) + "\n"


def register(name: str, body: str, deps: list[str]) -> None:
    BASE[name] = body
    DEPS[name] = deps


ORACLE: dict[str, str] = {}

# -- scans, parsing, rules ---------------------------------------------------
ORACLE["raw_scan"] = with_ctes("raw") + "select trip_id, line from raw"
ORACLE["split_fields"] = with_ctes("sp") + (
    "select trip_id, cast(len(p) as integer) as n_fields, p[3] as f2, p[5] as f4, p[12] as f11 from sp")
ORACLE["numeric_validity"] = with_ctes("parsed") + (
    f"select trip_id, {fin('secs')} as ok_time, {fin('distance')} as ok_distance, "
    f"{fin('fare')} as ok_fare, {fin('tip')} as ok_tip from parsed")
ORACLE["filter_any_key"] = with_ctes("parsed") + f"select trip_id from parsed where {_ok(RULE_SQL[1][1])}"
ORACLE["geo_box_filter"] = with_ctes("parsed") + (
    "select trip_id from parsed where pu_lon between -80 and -71 and pu_lat between 40 and 45 "
    "and do_lon between -80 and -71 and do_lat between 40 and 45")
ORACLE["clean_trips"] = with_ctes("clean") + (
    "select trip_id, pickup_datetime, secs, distance, pu_lon, pu_lat, do_lon, do_lat, "
    "fare, surcharge, tip, toll from clean")
ORACLE["reject_counts"] = with_ctes("parsed") + (
    f"select rule, count(*) as n from (select {FIRST_FAILED} as rule from parsed) group by rule")
ORACLE["trip_features"] = with_ctes("trips") + "select * from trips"


# -- sampling, statistics, segments ------------------------------------------
def half_up2(x: str) -> str:
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,20)), 2) as double)"


_zs = ", ".join(f"case when s_{c} > 0 then ({c} - m_{c}) / s_{c} else 0 end as {c}" for c in FEATURES)
register("fstats", "select " + ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in FEATURES)
         + " from train", ["train"])
register("z", f"select trip_id, {_zs} from train, fstats", ["train", "fstats"])
register("rates", "select trip_id, (fare + surcharge + tip) / distance as driver_rate, "
                  "(fare + surcharge + toll) / distance as passenger_rate from train", ["train"])
register("thr", "select " + ", ".join(
    f"{half_up2(f'quantile_disc({col}, {q})')} as {pre}{int(q * 100)}"
    for pre, col in (("d", "driver_rate"), ("p", "passenger_rate")) for q in (0.75, 0.5, 0.25)) + " from rates",
    ["rates"])
register("labels", "select trip_id, "
                   "case when driver_rate >= d75 then 'D2' when driver_rate >= d25 then 'D1' else 'D0' end as d_label, "
                   "case when passenger_rate >= p75 then 'P2' when passenger_rate >= p25 then 'P1' else 'P0' end "
                   "as p_label from rates, thr", ["rates", "thr"])

_fmt = " || ', ' || ".join(
    f"cast({c} as varchar)" if c in ("weekday", "hour") else f"cast(cast({c} as decimal(18,6)) as varchar)"
    for c in FEATURES + FARES)
_parse = ", ".join(
    (f"cast(try_cast(p[{i + 1}] as double) as integer) as {c}" if c in ("weekday", "hour")
     else f"{num(f'p[{i + 1}]')} as {c}") for i, c in enumerate(FEATURES + FARES))
ORACLE["training_text_parse"] = with_ctes("train", extra=[
    ("txt", f"select trip_id, '(' || {_fmt} || ')' as line from train"),
    ("sp2", "select trip_id, string_split(substr(line, 2, length(line) - 2), ', ') as p from txt"),
]) + f"select trip_id, {_parse} from sp2"
ORACLE["sample_trips"] = with_ctes("trips") + (
    f"select * from trips order by {md5_key()}, trip_id limit {SAMPLE_ROWS}")
ORACLE["sample_small"] = with_ctes("trips") + (
    f"select * from trips order by {md5_key()}, trip_id limit {SMALL_SAMPLE}")
# text files in trip order: a line's position is the bytes of the lines before it, with their line feeds
register("lines", "select sum(strlen(line) + 1) over (order by trip_id) - strlen(line) - 1 as trip_id, line from raw", ["raw"])
ORACLE["text_scan"] = with_ctes("lines") + "select cast(trip_id as bigint) as trip_id, line from lines"
ORACLE["text_sample"] = with_ctes("lines") + (
    f"select cast(trip_id as bigint) as trip_id, line from lines order by {md5_key()}, trip_id limit {SMALL_SAMPLE}")
ORACLE["clean_audit"] = ORACLE["reject_counts"]
ORACLE["quarantine"] = with_ctes("parsed", "raw") + (
    f"select raw.trip_id, raw.line, {FIRST_FAILED} as rule from parsed join raw using (trip_id) where {FIRST_FAILED} <> 'kept'")
ORACLE["sketch_days"] = with_ctes("clean") + (
    "select cast(ts as date) as day, rate, count(*) as n from clean, (values ('driver'), ('passenger')) r(rate) group by all")
ORACLE["sketch_quantiles"] = with_ctes("trips") + (
    "select rate, cast(q as double) as q, count(*) as n, true as within_bound from trips, (values ('driver'), ('passenger')) r(rate), "
    "(values (0.75), (0.5), (0.25)) s(q) group by rate, q")
ORACLE["trip_index"] = with_ctes("trips") + (
    "select row_number() over (order by trip_id) - 1 as idx, trip_id from trips")
ORACLE["trip_index_buckets"] = ORACLE["trip_index"]
ORACLE["feature_stats"] = with_ctes("train") + " union all ".join(
    f"select '{c}' as feature, count(*) as n, {r6(f'avg({c})')} as mean, {r6(f'var_pop({c})')} as var, "
    f"{r6(f'stddev_pop({c})')} as std from train" for c in FEATURES)
ORACLE["feature_var_as_written"] = with_ctes("train") + " union all ".join(
    f"select '{c}' as feature, {r6(f'var_pop({FEATURES[0]}) + (avg({FEATURES[0]}) - avg({c})) * (avg({FEATURES[0]}) - avg({c}))')} as var from train"
    for c in FEATURES)
ORACLE["scaled_features"] = with_ctes("z") + "select trip_id, " + ", ".join(
    f"{r6(c)} as {c}" for c in FEATURES) + " from z"
ORACLE["fare_per_mile"] = with_ctes("rates") + (
    f"select trip_id, {r6('driver_rate')} as driver_rate, {r6('passenger_rate')} as passenger_rate from rates")
ORACLE["fare_quantiles"] = with_ctes("thr") + (
    "select 'driver' as rate, d75 as q75, d50 as q50, d25 as q25 from thr union all "
    "select 'passenger', p75, p50, p25 from thr")
ORACLE["fare_quantiles_narrowed"] = ORACLE["fare_quantiles"]
ORACLE["trip_labels"] = with_ctes("labels") + "select trip_id, d_label, p_label from labels"
ORACLE["label_onehot"] = with_ctes("labels") + "select trip_id, " + ", ".join(
    f"cast({col} = '{pre.upper()}{lv}' as integer) as {pre}{lv}"
    for pre, col in (("d", "d_label"), ("p", "p_label")) for lv in (2, 1, 0)) + " from labels"
ORACLE["attach_labels"] = with_ctes("labels") + (
    "select t.trip_id, l.d_label, l.p_label, " + ", ".join(f"t.{c}" for c in FARES)
    + " from train t left join labels l using (trip_id)")


# -- k-means (recursive: one row a round and model, until no row changes cluster) ------
KMEANS_K = 5


def _d2(a: str, b: str, cols=FEATURES) -> str:
    return " + ".join(f"(({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c}))" for c in cols)


def _d2_list(x: str, c: str, cols) -> str:
    return " + ".join(f"(({x}.{n} - {c}[{i}]) * ({x}.{n} - {c}[{i}]))" for i, n in enumerate(cols, 1))


def _near(x: str, cents: str, cols) -> str:
    """List of squared distances to every centroid of a list."""
    return f"list_transform({cents}, lambda c: {_d2_list(x, 'c', cols)})"


def kmeans_ctes(ks=(KMEANS_K,), src: str = "z", cols=FEATURES, prefix: str = "km",
                key: str = "trip_id") -> list[tuple[str, str]]:
    """Lloyd's rounds for every k of ``ks`` to their own end.

    ``_r``: a row per round and model with the centroids after it (``cur``), those before it (``prev``) and how many rows
    ``prev`` puts elsewhere than the centroids before. A model goes on while rows move; its last row's ``prev`` are the
    final centroids (``_f``). ``_c``, ``_c0``, ``_c1``: centroids as rows, final, seeds and after one round; ``_a``,
    ``_a1``: cluster (from 0) and squared distance under the final centroids and the seeds.
    """
    h = md5_key(key=key)
    xs = ", ".join(cols)
    models = ", ".join(f"({k})" for k in ks)
    seeds = (f"select m.k, list([{', '.join(f's.{c}' for c in cols)}] order by s.i) as cents from "
             f"(select *, row_number() over (order by {h}, {key}) as i from {src} qualify i <= {max(ks)}) s "
             f"join (values {models}) m(k) on s.i <= m.k group by m.k")
    means = ", ".join(f"sum({c}) / count(*)" for c in cols)
    step = (f"select k, t + 1, list_transform(range(1, k + 1), lambda i: coalesce(map(list(a), list(mean))[i], any_value(cur)[i])), "
            f"any_value(cur), cast(sum(moved) as bigint) from ("
            f"select k, t, a, any_value(cur) as cur, [{means}] as mean, count_if(b is distinct from a) as moved from ("
            f"select k, t, cur, list_position(dc, list_min(dc)) as a, list_position(dp, list_min(dp)) as b, {xs} from ("
            f"select r.k, r.t, r.cur, {_near('p', 'r.cur', cols)} as dc, {_near('p', 'r.prev', cols)} as dp, "
            f"{', '.join(f'p.{c}' for c in cols)} from {prefix}_z p, {prefix}_r r where r.t <= 2 or r.moved > 0)) "
            f"group by k, t, a) group by k, t")

    def rows(cents: str) -> str:
        return ("select k, cast(i - 1 as integer) as cluster, " + ", ".join(f"c[{n}] as {x}" for n, x in enumerate(cols, 1))
                + f" from (select k, i, cents[i] as c from (select k, cents, unnest(range(1, k + 1)) as i from ({cents})))")

    def near(cents: str) -> str:
        return (f"select {key}, k, cast(list_position(d, list_min(d)) - 1 as integer) as cluster, list_min(d) as d2 from "
                f"(select p.{key}, f.k, {_near('p', 'f.cents', cols)} as d from {prefix}_z p, ({cents}) f)")

    final, first, once = (f"from {prefix}_f", f"select k, cur as cents from {prefix}_r where t = 0",
                          f"select k, cur as cents from {prefix}_r where t = 1")
    return [
        (f"{prefix}_z", f"materialized (select {key}, {xs} from {src})"),
        (f"{prefix}_r(k, t, cur, prev, moved)",
         f"(select cast(k as bigint), 0, cents, cast(null as double[][]), cast(null as bigint) from ({seeds}) union all {step})"),
        (f"{prefix}_f", f"materialized (select k, arg_max(prev, t) as cents from {prefix}_r group by k)"),
        (f"{prefix}_c", rows(final)), (f"{prefix}_c0", rows(first)), (f"{prefix}_c1", rows(once)),
        (f"{prefix}_a", f"materialized ({near(final)})"), (f"{prefix}_a1", near(first)),
    ]


def silhouette_sql(src: str, cols=FEATURES, prefix: str = "km", key: str = "trip_id") -> str:
    """``(k, silhouette)`` per model: closed form on squared distances, rows alone in their cluster score 0."""
    sq = " + ".join(f"(p.{c} * p.{c})" for c in cols)
    dot = " + ".join(f"(p.{c} * s_{c})" for c in cols)
    return (f"with st as (select a.k, a.cluster, count(*) as n, {', '.join(f'sum(p.{c}) as s_{c}' for c in cols)}, sum({sq}) as q "
            f"from {src} p join {prefix}_a a using ({key}) group by a.k, a.cluster), "
            f"av as (select a.{key}, a.k, a.cluster = st.cluster as own, st.n, "
            f"((({sq}) + st.q / st.n) - (2.0 * ({dot})) / st.n) as avg_d "
            f"from {src} p join {prefix}_a a using ({key}) join st on st.k = a.k), "
            f"ab as (select {key}, k, max(case when own then avg_d * n / nullif(n - 1.0, 0) end) as a, "
            f"max(case when own then n end) as n_own, min(case when not own then avg_d end) as b from av group by {key}, k) "
            "select k, avg(case when n_own = 1 then 0.0 when a < b then 1.0 - a / b when a > b then b / a - 1.0 else 0.0 end) "
            "as silhouette from ab group by k")


def _km(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    return with_ctes("z", *names, extra=kmeans_ctes() + (extra or []))


_r6cols = ", ".join(f"{r6(c)} as {c}" for c in FEATURES)
ORACLE["kmeans_seeds"] = _km() + f"select cluster, {_r6cols} from km_c0"
ORACLE["point_centroid_distances"] = _km() + (
    f"select p.trip_id, c.cluster, {r6(f'sqrt({_d2(chr(112), chr(99))})')} as distance from z p cross join km_c0 c")


def _sized(cents: str, assigned: str) -> str:
    return (f"select c.cluster, cast(coalesce(m.n, 0) as bigint) as n, " + ", ".join(f"{r6('c.' + c)} as {c}" for c in FEATURES)
            + f" from {cents} c left join (select cluster, count(*) as n from {assigned} group by cluster) m using (cluster)")


ORACLE["kmeans_update"] = _km() + _sized("km_c1", "km_a1")
ORACLE["kmeans_fit"] = _km() + _sized("km_c", "km_a")
ORACLE["kmeans_assign"] = _km() + "select trip_id, cluster from km_a"
ORACLE["kmeans_reassigned"] = _km() + (
    "select cast(t - 1 as integer) as round, case when t = 2 then (select count(*) from z) else moved end as n "
    "from km_r where t >= 2")
ORACLE["kmeans_cost"] = _km() + f"select {r6('sum(sqrt(d2))')} as sum_distance, {r6('sum(d2)')} as wssse from km_a"
ORACLE["silhouette"] = _km() + f"select {r6('silhouette')} as silhouette from ({silhouette_sql('z')})"

SWEEP = tuple(SWEEP_KS)
_sweep = with_ctes("z", extra=kmeans_ctes(SWEEP) + [
    ("sc", "select k, sum(sqrt(d2)) as sum_distance, sum(d2) as wssse from km_a group by k"),
    ("si", silhouette_sql("z"))])
ORACLE["k_sweep"] = _sweep + (f"select cast(k as integer) as k, {r6('sum_distance')} as sum_distance, {r6('wssse')} as wssse, "
                              f"{r6('silhouette')} as silhouette from sc join si using (k)")
_gaps = _sweep + ("select k, (1 - (k - min(k) over ()) / (max(k) over () - min(k) over ()) - (sum_distance - arg_max(sum_distance, k) over ()) "
                  "/ (arg_min(sum_distance, k) over () - arg_max(sum_distance, k) over ())) / sqrt(2) as gap from sc")
ORACLE["elbow_gaps"] = f"select cast(k as integer) as k, {r6('gap')} as gap from ({_gaps})"
ORACLE["pick_k_elbow"] = f"select cast(case when gap >= 0.05 then k end as integer) as k from ({_gaps}) order by gap desc, k limit 1"
ORACLE["pick_k"] = _sweep + "select cast(k as integer) as k from si order by silhouette desc, k limit 1"

_kmj = _km("labels", extra=[
    ("ka", "select t.*, l.d_label, l.p_label, a.cluster from train t join km_a a using (trip_id) "
           "join labels l using (trip_id)")])
ORACLE["cluster_centroids"] = _kmj + "select cluster, " + ", ".join(f"{r6(f'avg({c})')} as {c}" for c in FEATURES) + (
    " from ka group by cluster")


def summary_sql(src: str, key: str) -> str:
    hot = ", ".join(f"{r6(f'avg(cast({col} = {chr(39)}{pre.upper()}{lv}{chr(39)} as integer))')} as {pre}{lv}"
                    for pre, col in (("d", "d_label"), ("p", "p_label")) for lv in (2, 1, 0))
    fares = ", ".join(f"{r6(f'avg({c})')} as {c}" for c in FARES)
    return f"select {key}, count(*) as n, {hot}, {fares} from {src} group by {key}"


ORACLE["cluster_summary"] = _kmj + summary_sql("ka", "cluster")
_pairs = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i:]]
ORACLE["cluster_covariance"] = _kmj + " union all ".join(
    f"select cluster, '{a}' as a, '{b}' as b, {r6(f'covar_pop({a}, {b})')} as cov from ka group by cluster"
    for a, b in _pairs)


# -- Gaussian mixture (densities by Cholesky factors computed in SQL) ---------------------
from fareseg.plans.fixed_model import fixed_mixture  # noqa: E402


def dlit(v: float) -> str:
    return f"'{float(v)!r}'::double"


def _tri(d: int) -> list[tuple[int, int]]:
    """Lower-triangle positions, also the order in which a component's list ``g`` holds its covariance after its mean."""
    return [(i, j) for i in range(d) for j in range(i + 1)]


def whitened_sql(src: str, d: int) -> str:
    """``src`` (with ``g``: mean, covariance) plus ``h``: the constant of -2 log density, the mean, the inverse Cholesky factor."""
    at = {ij: d + 1 + n for n, ij in enumerate(_tri(d))}
    sql = f"select * from {src}"
    for j in range(d):
        def part(i, j=j):
            return " - ".join([f"g[{at[i, j]}]", *[f"l{i}_{p} * l{j}_{p}" for p in range(j)]])
        sql = f"select *, sqrt({part(j)}) as l{j}_{j} from ({sql})"
        if j + 1 < d:
            sql = f"select *, {', '.join(f'({part(i)}) / l{j}_{j} as l{i}_{j}' for i in range(j + 1, d))} from ({sql})"
    for i in range(d):
        w = [f"-({' + '.join(f'l{i}_{p} * w{p}_{j}' for p in range(j, i))}) / l{i}_{i} as w{i}_{j}" for j in range(i)]
        sql = f"select *, {', '.join([*w, f'1.0 / l{i}_{i} as w{i}_{i}'])} from ({sql})"
    const = " + ".join([f"{d} * ln(2 * pi())", *[f"2 * ln(l{i}_{i})" for i in range(d)]])
    mean = [f"g[{i + 1}]" for i in range(d)]
    return f"select *, [{', '.join([const, *mean, *[f'w{i}_{j}' for i, j in _tri(d)]])}] as h from ({sql})"


def log_densities(cols, hs: str = "hs") -> str:
    """List of log densities of a row with these columns under the components ``hs``."""
    d = len(cols)
    at = {ij: d + 2 + n for n, ij in enumerate(_tri(d))}
    z = ["(" + " + ".join(f"h[{at[i, j]}] * ({cols[j]} - h[{j + 2}])" for j in range(i + 1)) + ")" for i in range(d)]
    return f"list_transform({hs}, lambda h: -0.5 * (h[1] + {' + '.join(f'{x} * {x}' for x in z)}))"


def responsibilities_sql(src: str, keep: str, k: int) -> str:
    """``keep`` and list ``r`` from rows of ``src`` with lists ``ld`` and ``phi``; also ``l``, the log numerators."""
    ks = range(1, k + 1)
    lw = f"select {keep}, ld, [{', '.join(f'ld[{j}] + ln(phi[{j}])' for j in ks)}] as l from {src}"
    e = f"select {keep}, ld, l, list_transform(l, lambda v: exp(v - list_max(l))) as e from ({lw})"
    return f"select {keep}, ld, l, list_transform(e, lambda v: v / list_sum(e)) as r from ({e})"


def em_ctes(src: str, seeds: str, cols, k: int, tol: float = 1e-4, prefix: str = "em") -> list[tuple[str, str]]:
    """EM from the groups of ``seeds`` (``cluster`` and columns) until the weights change by ``tol`` or less.

    ``_r`` holds two rows a round: one after the weights, one after means and covariances; all about the overall means
    (``_o``). ``_g``: final components ``component, phi, g`` in the features' own units.
    """
    d, cat = len(cols), ", ".join
    centred = cat(f"s.{c} - o.{c} as {c}" for c in cols)
    pairs = _tri(d)
    g0 = cat([f"avg({c})" for c in cols] + [f"covar_pop({cols[i]}, {cols[j]})" for i, j in pairs])
    seed = (f"select list(phi order by cluster) as phi, list(g order by cluster) as g from (select cluster, "
            f"count(*) / (select count(*) from {seeds}) as phi, [{g0}] as g from "
            f"(select s.cluster, {centred} from {seeds} s, {prefix}_o o) group by cluster)")
    whiten = whitened_sql(f"(select t, phase, delta, phi, gs, unnest(range(1, {k + 1})) as j, unnest(gs) as g from {prefix}_r "
                          f"where phase = 1 or t = 0 or delta > {tol!r})", d)
    model = f"select t, phase, delta, phi, any_value(gs) as gs, list(h order by j) as hs from ({whiten}) group by t, phase, delta, phi"
    state = "t, phase, delta, phi, gs"
    dens = f"(select {state}, {cat(f'p.{c}' for c in cols)}, {log_densities([f'p.{c}' for c in cols])} as ld from {prefix}_z p, ({model}) m)"
    resp = responsibilities_sql(dens, f"{state}, {cat(cols)}", k)
    sums = [f"count(*) as n"]
    for m in range(1, k + 1):
        sums += [f"sum(r[{m}]) as w{m}", *[f"sum(r[{m}] * {c}) as s{m}_{i}" for i, c in enumerate(cols)],
                 *[f"sum(r[{m}] * {cols[i]} * {cols[j]}) as q{m}_{i}_{j}" for i, j in pairs]]
    total = f"select {state}, {cat(sums)} from ({resp}) group by {state}"
    new_phi = "[" + cat(f"w{m} / n" for m in range(1, k + 1)) + "]"
    new_g = "[" + cat("[" + cat([f"s{m}_{i} / w{m}" for i in range(d)] + [f"q{m}_{i}_{j} / w{m} - s{m}_{i} / w{m} * s{m}_{j} / w{m}"
                                                                        for i, j in pairs]) + "]" for m in range(1, k + 1)) + "]"
    change = " + ".join(f"abs(w{m} / n - phi[{m}])" for m in range(1, k + 1))
    step = (f"select t + phase, 1 - phase, case when phase = 0 then {change} else delta end, "
            f"case when phase = 0 then {new_phi} else phi end, case when phase = 1 then {new_g} else gs end from ({total})")
    back = cat([f"g[{i + 1}] + o.{c}" for i, c in enumerate(cols)] + [f"g[{d + 1 + n}]" for n in range(len(pairs))])
    return [
        (f"{prefix}_o", f"materialized (select {cat(f'avg({c}) as {c}' for c in cols)} from {src})"),
        (f"{prefix}_z", f"materialized (select s.trip_id, {centred} from {src} s, {prefix}_o o)"),
        (f"{prefix}_r(t, phase, delta, phi, gs)",
         f"(select 0, 0, cast(null as double), phi, g from ({seed}) union all {step})"),
        (f"{prefix}_g", f"materialized (select component, phi, [{back}] as g from (select unnest(range({k})) as component, "
                        f"unnest(phi) as phi, unnest(gs) as g from {prefix}_r where phase = 0 order by t desc limit {k}), {prefix}_o o)"),
    ]


def mixture_ctes(comps: str, k: int) -> list[tuple[str, str]]:
    """``gm`` and ``gr``: per trip the log numerators ``l{j}``, log densities ``ld{j}``, their maximum and weights ``r{j}``."""
    model = f"select list(phi order by component) as phi, list(h order by component) as hs from ({whitened_sql(comps, len(FEATURES))})"
    dens = f"(select t.trip_id, {', '.join(f't.{c}' for c in FEATURES)}, phi, {log_densities([f't.{c}' for c in FEATURES])} as ld from train t, ({model}) m)"
    keep = f"trip_id, {', '.join(FEATURES)}"
    each = ", ".join(f"ld[{j + 1}] as ld{j}, l[{j + 1}] as l{j}, r[{j + 1}] as r{j}" for j in range(k))
    return [("gr", f"materialized (select {keep}, list_max(l) as m, {each} from ({responsibilities_sql(dens, keep, k)}))")]


def _fixed_ctes() -> list[tuple[str, str]]:
    fm = fixed_mixture()
    rows = [f"({j}, {dlit(fm.phi[j])}, [{', '.join(dlit(v) for v in [*fm.mu[j], *[fm.sigma[j][a, b] for a, b in _tri(len(FEATURES))]])}])"
            for j in range(fm.k)]
    return [("fixed", f"select * from (values {', '.join(rows)}) v(component, phi, g)"), *mixture_ctes("fixed", fm.k)]


_GK = fixed_mixture().k
_gmm = with_ctes("train", extra=_fixed_ctes())
ORACLE["gmm_density"] = _gmm + " union all ".join(
    f"select trip_id, {j} as component, {r6(f'ld{j}')} as log_density from gr" for j in range(_GK))
ORACLE["gmm_e_step"] = _gmm + " union all ".join(
    f"select trip_id, {j} as component, {r6(f'r{j}')} as r from gr" for j in range(_GK))
ORACLE["join_features_resp"] = _gmm + ", rl as (" + " union all ".join(
    f"select trip_id, {j} as component, {r6(f'r{j}')} as r from gr" for j in range(_GK)) + (
    ") select t.trip_id, rl.component, rl.r, " + ", ".join(f"t.{c}" for c in FEATURES)
    + " from train t join rl using (trip_id)")
ORACLE["join_bucketed_resp"] = ORACLE["join_features_resp"]
ORACLE["gmm_phi_update"] = _gmm + " union all ".join(
    f"select {j} as component, {r6(f'avg(r{j})')} as phi from gr" for j in range(_GK))
ORACLE["gmm_predict"] = _gmm + "select trip_id, cast(case " + " ".join(
    f"when l{j} = m then {j}" for j in range(_GK)) + " end as integer) as component from gr"
_wm = ", wm as (" + " union all ".join(
    f"select {j} as component, sum(r{j}) as weight, " + ", ".join(f"sum(r{j} * {c}) / sum(r{j}) as {c}" for c in FEATURES)
    + " from gr" for j in range(_GK)) + ")"
ORACLE["gmm_m_step_mu"] = _gmm + _wm + " select component, " + r6("weight") + " as weight, " + ", ".join(
    f"{r6(c)} as {c}" for c in FEATURES) + " from wm"
ORACLE["gmm_m_step_sigma"] = _gmm + _wm + " " + " union all ".join(
    f"select {j} as component, '{a}' as a, '{b}' as b, "
    f"{r6(f'sum(gr.r{j} * (gr.{a} - wm.{a}) * (gr.{b} - wm.{b})) / sum(gr.r{j})')} as cov "
    f"from gr, wm where wm.component = {j}"
    for j in range(_GK) for i, a in enumerate(FEATURES) for b in FEATURES[i:])
ORACLE["gmm_sigma_as_written"] = _gmm + _wm + " " + " union all ".join(
    f"select {j} as component, '{a}' as a, '{b}' as b, "
    f"{r6(f'sum(gr.r{j} * (gr.{FEATURES[j]} - wm.{FEATURES[j]}) * (gr.{FEATURES[j]} - wm.{FEATURES[j]})) / sum(gr.r{j}) + (min(wm.{FEATURES[j]}) - min(wm.{a})) * (min(wm.{FEATURES[j]}) - min(wm.{b}))')} as cov "
    f"from gr, wm where wm.component = {j}"
    for j in range(_GK) for i, a in enumerate(FEATURES) for b in FEATURES[i:])
ORACLE["gmm_init"] = _kmj + (
    "select cast(cluster as integer) as component, " + r6("count(*) / (select count(*) from ka)") + " as phi, "
    + ", ".join(f"{r6(f'avg({c})')} as {c}" for c in FEATURES) + ", "
    + ", ".join(f"{r6(f'covar_pop({a}, {b})')} as cov_{a}_{b}" for a, b in _pairs) + " from ka group by cluster")
_em = _km("labels", extra=[
    ("ka", "select t.*, a.cluster from train t join km_a a using (trip_id)"), *em_ctes("train", "ka", FEATURES, KMEANS_K)])
ORACLE["gmm_fit"] = _em + "select cast(component as integer) as component, " + r6("phi") + " as phi, " + ", ".join(
    f"{r6(f'g[{i}]')} as {c}" for i, c in enumerate(FEATURES, 1)) + " from em_g"
_both = _km("labels", extra=[
    ("ka", "select t.*, l.d_label, l.p_label, a.cluster from train t join km_a a using (trip_id) join labels l using (trip_id)"),
    *em_ctes("train", "ka", FEATURES, KMEANS_K), *mixture_ctes("em_g", KMEANS_K),
    ("best", "select trip_id, cast(case " + " ".join(f"when l{j} = m then {j}" for j in range(KMEANS_K))
     + " end as integer) as component from gr"),
    ("kc", "select ka.*, b.component from ka join best b using (trip_id)"),
])
ORACLE["gmm_component_summary"] = _both + summary_sql("kc", "component")
ORACLE["segment_trips"] = _both + " union all ".join(
    f"select '{kind}' as kind, cast({kind} as integer) as segment, * exclude ({kind}) from ({summary_sql('kc', kind)})"
    for kind in ("cluster", "component"))


# -- k-means on the 64-dimensional embeddings ----------------------------------------
EMB_DIM = 64
EMB_K = 10
EMB_COLS = [f"e{i}" for i in range(EMB_DIM)]
register("emb", "select vec_id, label, " + ", ".join(f"cast(embedding[{i + 1}] as double) as e{i}" for i in range(EMB_DIM))
         + f" from embeddings where len(embedding) = {EMB_DIM} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0", [])
_emb = with_ctes("emb", extra=kmeans_ctes((EMB_K,), "emb", EMB_COLS, "ek", "vec_id"))
ORACLE["embedding_kmeans"] = _emb + (
    f"select cast(a.cluster as integer) as cluster, e.label, count(*) as n from emb e join ek_a a using (vec_id) "
    "group by a.cluster, e.label")
ORACLE["embedding_silhouette"] = _emb + (
    f"select {r6('silhouette')} as silhouette from ({silhouette_sql('emb', EMB_COLS, 'ek', 'vec_id')})")


# -- EM on two features, to its end ---------------------------------------------------
GMM2_K, GMM2_TOL = 3, 1e-3
register("t2", "select trip_id, cast(hour as double) as hour, trip_min from train", ["train"])
register("z2", "select trip_id, case when sh > 0 then (hour - mh) / sh else 0 end as hour, "
               "case when st > 0 then (trip_min - mt) / st else 0 end as trip_min from t2, "
               "(select avg(hour) as mh, stddev_pop(hour) as sh, avg(trip_min) as mt, stddev_pop(trip_min) as st from t2)",
         ["t2"])


ORACLE["gmm_fit_2d"] = with_ctes("z2", "t2", extra=[
    *kmeans_ctes((GMM2_K,), "z2", ["hour", "trip_min"], "g2"),
    ("ka2", "select t.trip_id, t.hour, t.trip_min, a.cluster from t2 t join g2_a a using (trip_id)"),
    *em_ctes("t2", "ka2", ["hour", "trip_min"], GMM2_K, GMM2_TOL, prefix="e2")]) + (
    f"select cast(component as integer) as component, {r6('phi')} as phi, {r6('g[1]')} as mu_hour, {r6('g[2]')} as mu_trip_min "
    "from e2_g")
