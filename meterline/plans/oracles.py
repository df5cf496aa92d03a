"""The registered queries as plain SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

import math

from ..schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from ..search.propose import CANDIDATES, CELLS, KERNEL_WIDTH
from ..search.space import SPACE
from ..sources.trips import DUCK_TRIPS, TRIP_KEY
from .queries import STUMP_BINS, STUMP_FEATURES, STUMP_ROUNDS

KEY = ", ".join(TRIP_KEY)


def q6(x: str) -> str:
    return f"floor(({x})::DOUBLE * 1e6 + 0.5e0) / 1e6"


def md5_int(key: str, seed: int) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {key}, '{seed}')), 1, 15))::BIGINT"


def md5_u(key: str, seed: int) -> str:
    return f"({md5_int(key, seed)} / 1152921504606846976e0)"


PU = "tpep_pickup_datetime"
RULES = {
    "card": "payment_type = 1",
    "duration": "duration_min >= 1 and duration_min <= 180",
    "distance": "trip_distance >= 0.1e0 and trip_distance <= 100",
    "fare": "fare_amount >= 2.5e0 and fare_amount <= 500",
    "tip": "tip_amount >= 0",
    "speed": "speed_mph <= 80",
    "target": "tip_pct >= 0 and tip_pct <= 1",
}
WITH = f"""with trips as ({DUCK_TRIPS}),
timed as (select *, date_diff('microsecond', {PU}, tpep_dropoff_datetime) / 6e7 as duration_min from trips),
derived as (select *, case when duration_min <> 0 then trip_distance / (duration_min / 60e0) end as speed_mph,
  case when fare_amount <> 0 then tip_amount / fare_amount end as tip_pct,
  case when year({PU}) between 1995 and 1999 then 'train' when year({PU}) = 2000 then 'valid'
    when year({PU}) = 2001 then 'test' end as split from timed),
cleaned as (select * from derived where {" and ".join(f"({r})" for r in RULES.values())})
"""
SPLIT = WITH + ", labelled as (select * from cleaned where split is not null)\n"

ANGLE = f"2e0 * pi() * (hour({PU}) + minute({PU}) / 60e0) / 24e0"
DOW = f"isodow({PU}) - 1"


def flag(c: str) -> str:
    return f"cast(coalesce({c}, false) as int)"


EXPRS = {
    "hour_sin": f"sin({ANGLE})",
    "hour_cos": f"cos({ANGLE})",
    "dow": f"({DOW})",
    "is_weekend": flag(f"{DOW} >= 5"),
    "is_night": flag(f"hour({PU}) >= 22 or hour({PU}) < 6"),
    "store_and_fwd": flag("store_and_fwd_flag = 'Y'"),
    "pu_airport": flag("PULocationID in (1, 132, 138)"),
    "do_airport": flag("DOLocationID in (1, 132, 138)"),
}
FILLED = ["passenger_count", "congestion_surcharge", "airport_fee", "extra", "tolls_amount"]
EXPRS |= {c: f"coalesce(cast({c} as double), 0e0)" for c in FILLED}
CODES = {
    "PULocationID": "case when PULocationID between 1 and 265 then cast(PULocationID - 1 as int) end",
    "DOLocationID": "case when DOLocationID between 1 and 265 then cast(DOLocationID - 1 as int) end",
    "RatecodeID": "case when RatecodeID between 1 and 6 then cast(RatecodeID - 1 as int) when RatecodeID = 99 then 6 end",
    "VendorID": "case VendorID when 1 then 0 when 2 then 1 when 6 then 2 when 7 then 3 end",
}


def f32(name: str) -> str:
    return f"cast({EXPRS.get(name, name)} as float)"


MATRIX = (
    WITH
    + f"select {KEY}, "
    + ", ".join(f"{q6(f32(c))} as {c}" for c in NUMERIC_FEATURES)
    + ", "
    + ", ".join(f"{CODES[c]} as {c}" for c in CATEGORICAL_FEATURES)
    + f", {q6('tip_pct')} as tip_pct from cleaned"
)


def metrics(test: str, mean: str) -> str:
    """Select list for a test relation with ``prediction``."""
    rmse = "sqrt(avg((prediction - tip_pct) * (prediction - tip_pct)))"
    base = f"sqrt(avg(({mean} - tip_pct) * ({mean} - tip_pct)))"
    return (
        f"{q6(rmse)} as test_rmse, {q6('avg(abs(prediction - tip_pct))')} as test_mae, "
        f"{q6(base)} as baseline_rmse, count(*) as n_test, "
        f"{q6(f'100e0 * (1e0 - {rmse} / {base})')} as improvement_pct"
    )


def zone_mean(src: str, tag: str) -> str:
    return f"""
{tag}_mean as (select avg(tip_pct) as train_mean from {src} where split = 'train'),
{tag}_zone as (select PULocationID as z, avg(tip_pct) as m from {src} where split = 'train' group by 1),
{tag}_scored as (select t.tip_pct, coalesce(m, train_mean) as prediction, train_mean
  from {src} t cross join {tag}_mean left join {tag}_zone on PULocationID = z where split = 'test')"""


def edge_ctes(features: list[str], bins: int) -> str:
    """CTE ``edges`` (pos, edge) from CTE ``train``."""
    union = " union all ".join(
        f"select {i} as pos, cast({f32(c)} as double) as v from train"
        for i, c in enumerate(features)
    )
    return f"""
vals as ({union}),
counts as (select pos, v, count(*) as n from vals where v is not null group by 1, 2),
cums as (select pos, v, n, sum(n) over (partition by pos order by v) as cum, sum(n) over (partition by pos) as total,
  count(*) over (partition by pos) as distinct_n from counts),
edges as (select pos, v as edge from cums where cum - n > 0 and
  (distinct_n <= {bins} or least((cum * {bins}) // total, {bins - 1}) > ((cum - n) * {bins}) // total))"""


def quantile_edges(features: list[str], bins: int) -> str:
    """CTE ``edges`` by DuckDB's own quantiles; every distinct value where there are few."""
    union = " union all ".join(
        f"select {i} as pos, cast({f32(c)} as double) as v from train" for i, c in enumerate(features)
    )
    cuts = ", ".join(f"{j / bins!r}" for j in range(1, bins))
    return f"""
vals as ({union}),
per as (select pos, min(v) as low, count(distinct v) as distinct_n, quantile_disc(v, [{cuts}]) as cuts
  from vals where v is not null group by 1),
edges as (
  select distinct pos, edge from (select pos, low, unnest(cuts) as edge from per where distinct_n > {bins}) where edge > low
  union all
  select distinct vals.pos, v from vals join per on vals.pos = per.pos where distinct_n <= {bins} and v > low)"""


FIXED_CELLS = f"""{SPLIT}, rows_in as (
  select VendorID % 2 as slot, floor((0.15e0 - tip_pct) * 1e6) as g,
    [cast(floor(trip_distance) as int) + 1, cast(coalesce(floor(passenger_count), 0) as int),
     coalesce({CODES['PULocationID']} + 1, 0), coalesce({CODES['RatecodeID']} + 1, 0)] as bins
  from labelled where split = 'train'),
long as (select slot, g, unnest(bins) as bin, unnest([0, 1, 2, 3]) as feature from rows_in),
cells as (select cast(slot as bigint) as slot, feature, bin, cast(sum(g) as double) as g,
  cast(count(*) as double) as h from long group by 1, 2, 3)"""


def sc(g: str, h: str) -> str:
    return f"(pow(greatest(abs({g}) - 1000e0, 0e0), 2) / ({h} + 1e0))"


def gain(gl: str, hl: str, fits: str) -> str:
    ok = f"{fits} and {hl} >= 5 and ht - {hl} >= 5"
    return (
        f"case when {ok} then {sc(gl, hl)} + {sc(f'(gt - {gl})', f'(ht - {hl})')} - {sc('gt', 'ht')} else -1e0 end"
    )


SCAN = f"""{FIXED_CELLS}, keyed as (
  select *, case when feature = 2 and bin > 0 then g / (h + 1e0) else cast(bin as double) end as k from cells),
running as (select *, sum(g) over w as gt, sum(h) over w as ht,
  sum(case when bin = 0 then g else 0e0 end) over w as gm, sum(case when bin = 0 then h else 0e0 end) over w as hm,
  sum(case when bin > 0 then g else 0e0 end) over o as gp, sum(case when bin > 0 then h else 0e0 end) over o as hp,
  count(*) filter (where bin > 0) over o as pos, count(*) filter (where bin > 0) over w as n_present
  from keyed window w as (partition by slot, feature),
    o as (partition by slot, feature order by bin > 0, k, bin rows between unbounded preceding and current row)),
sided as (select *, case when feature = 3 then gt - gm - g else gp end as gl,
  case when feature = 3 then ht - hm - h else hp end as hl from running where bin > 0),
scan as (select *, {gain('gl', 'hl', '(feature <> 2 or least(pos, n_present - pos) <= 64)')} as gain_right,
  {gain('(gl + gm)', '(hl + hm)', '(feature <> 2 or least(pos, n_present - pos) <= 64)')} as gain_left from sided)"""


def stumps(logistic: bool = False, gains_only: bool = False, scored: str = "") -> str:
    """Three rounds of one-split trees over three binned columns, lambda 1, rate 0.5."""
    cols = [f32(c) for c in STUMP_FEATURES]
    bins = ", ".join(
        f"(select count(*) from edges e where e.pos = {i} and e.edge <= r.v{i}) + 1 as b{i}" for i in range(len(cols))
    )
    vals = ", ".join(f"cast({c} as double) as v{i}" for i, c in enumerate(cols))
    target = "cast(tip_pct > 0 as int)::DOUBLE" if logistic else "cast(cast(tip_pct as float) as double)"
    start = "ln(avg(y) / (1e0 - avg(y)))" if logistic else "avg(y)"
    chance = "(1e0 / (1e0 + exp(-pred)))"
    grad = f"{chance} - y" if logistic else "pred - y"
    hess = f"sum({chance} * (1e0 - {chance}))" if logistic else "count(*)"
    error = "avg(ln(1e0 + exp(pred)) - y * pred)" if logistic else "sqrt(avg((pred - y) * (pred - y)))"
    names_of = ("train_loss", "valid_loss") if logistic else ("train_rmse", "valid_rmse")
    sql = f"""{SPLIT}, train as (select * from labelled where split = 'train'), {edge_ctes(STUMP_FEATURES, STUMP_BINS)},
numbered as (select e.pos, e.edge, row_number() over (partition by pos order by edge) as b from edges e),
vs as (select split, {target} as y, {vals} from labelled where split in ('train', 'valid', 'test')),
base as (select {start} as m from vs where split = 'train'),
s0 as (select r.split, r.y, {bins}, m as pred from vs r cross join base)"""
    for r in range(STUMP_ROUNDS):
        hist = " union all ".join(
            f"select {i} as pos, b{i} as b, sum({grad}) as g, {hess} as h from s{r} where split = 'train' group by 2"
            for i in range(len(cols))
        )
        right = " or ".join(f"(pos = {i} and b{i} > b)" for i in range(len(cols)))
        keep = ", ".join(f"b{i}" for i in range(len(cols)))
        sql += f""",
h{r} as (select *, sum(g) over (partition by pos) as gt, sum(h) over (partition by pos) as ht,
  sum(g) over (partition by pos order by b) as gl, sum(h) over (partition by pos order by b) as hl from ({hist})),
b{r}_best as (select *, gl*gl/(hl+1e0) + (gt-gl)*(gt-gl)/(ht-hl+1e0) - gt*gt/(ht+1e0) as gain from h{r}
  where hl >= 1 and ht - hl >= 1 order by gain desc, pos, b limit 1),
w{r} as (select pos, b, gain, hl, -0.5e0*gl/(hl+1e0) as lw, -0.5e0*(gt-gl)/(ht-hl+1e0) as rw from b{r}_best),
s{r + 1} as (select split, y, {keep}, pred + case when {right} then rw else lw end as pred from s{r} cross join w{r})"""
    names = "case w.pos " + " ".join(f"when {i} then '{c}'" for i, c in enumerate(STUMP_FEATURES)) + " end"
    if scored:
        return f"""{sql}
select {q6('pred')} as prediction, cast(1 as int) as model_version, count(*) as n_rows from s{STUMP_ROUNDS}
where split = '{scored}' group by 1"""
    if gains_only:
        return sql + "\n" + " union all ".join(f"select {names} as feature, w.gain from w{r} w" for r in range(STUMP_ROUNDS))
    rows = " union all ".join(
        f"""select cast({r} as int) as round, {names} as feature, {q6('n.edge')} as edge, {q6('w.gain')} as gain,
  {q6('w.hl')} as n_left, {q6('w.lw')} as left_weight, {q6('w.rw')} as right_weight,
  (select {q6(error)} from s{r + 1} where split = 'train') as {names_of[0]},
  (select {q6(error)} from s{r + 1} where split = 'valid') as {names_of[1]}
  from w{r} w join numbered n on n.pos = w.pos and n.b = w.b"""
        for r in range(STUMP_ROUNDS)
    )
    return f"{sql}\n{rows}"


def gains() -> str:
    """Average gain per feature over the rounds of ``stumps``."""
    names = " union all ".join(f"select '{c}' as feature" for c in STUMP_FEATURES)
    return f"""with splits as ({stumps(gains_only=True)}), names as ({names})
select feature, {q6('coalesce(avg(gain), 0e0)')} as gain from names left join splits using (feature) group by 1"""


CURVES = """with rounds as (select l_partkey as trial, cast(l_quantity as int) as boost_round,
  sum(l_orderkey % 997)::DOUBLE / count(*) as valid_rmse from lineitem group by 1, 2)"""

REPORTS = """with reports as (select cast(l_suppkey as varchar) as study, cast(l_partkey % 12 as int) as trial_id,
  cast(l_orderkey % 7 + 1 as int) as report_no, sum(l_orderkey % 997)::DOUBLE / count(*) as valid_rmse,
  cast((l_orderkey % 7 + 1) * 100 + l_partkey % 12 * 5 % 12 as bigint) as seq
  from lineitem group by 1, 2, 3, 5)"""


def rung(level: int, src: str) -> str:
    return f"""select study, report_no, trial_id, cutoff, coalesce(valid_rmse > cutoff, false) as stops from (
  select *, quantile_cont(valid_rmse, {1 / 3!r}) over (partition by study order by seq
    rows between unbounded preceding and 1 preceding) as cutoff from {src} where report_no = {level})"""


def best(value: str) -> str:
    return f"""{REPORTS}, last as (select study, trial_id, {value} as rmse from reports group by 1, 2)
select study, arg_min(trial_id, {{'r': rmse, 't': trial_id}}) as trial_id, {q6('min(rmse)')} as best_rmse,
  count(*) as n_trials from last group by 1"""


def draw(p, u: str) -> str:
    if p.kind == "int":
        return f"cast(floor({u} * {p.high - p.low}e0) + {int(p.low)} as int)"
    if p.kind == "log":
        a, b = math.log(p.low), math.log(p.high)
        return f"exp({a!r}::DOUBLE + {u} * {b - a!r}::DOUBLE)"
    return f"{p.low!r}::DOUBLE + {u} * {p.high - p.low!r}::DOUBLE"


def unit(p) -> str:
    v = p.name
    if p.kind == "int":
        return f"({v} - {int(p.low)} + 0.5e0) / {p.high - p.low}e0"
    if p.kind == "log":
        a, b = math.log(p.low), math.log(p.high)
        return f"(ln({v}) - {a!r}::DOUBLE) / {b - a!r}::DOUBLE"
    return f"({v} - {p.low!r}::DOUBLE) / {p.high - p.low!r}::DOUBLE"


def shown(p, e: str) -> str:
    return e if p.kind == "int" else q6(e)


def configs(id_col: str, seed: int) -> str:
    return ", ".join(f"{draw(p, md5_u(id_col + '::VARCHAR, ' + repr(p.name), seed))} as {p.name}" for p in SPACE)


HISTORY = f"""with history as (select cast(c_custkey // 60 as varchar) as study, cast(c_custkey as int) as trial_id,
  abs(c_acctbal) as rmse, {configs('c_custkey', 1)} from customer),
ranked as (select *, row_number() over (partition by study order by rmse, trial_id) as rn,
  count(*) over (partition by study) as n from history),
marked as (select *, case when rn <= least(ceil(n * 0.1e0), 25) then 1 else 0 end as good from ranked),
units as ({" union all ".join(f"select study, '{p.name}' as param, {unit(p)} as u, good from marked" for p in SPACE)}),
counts as (select study, param, least(greatest(cast(floor(u * {CELLS}) as int), 0), {CELLS - 1}) as source,
  sum(good) as n_good, sum(1 - good) as n_bad from units group by 1, 2, 3),
spread as (select *, unnest(range({CELLS})) as cell from counts),
weighted as (select *, exp(-0.5e0 * pow((cell - source) / {CELLS}e0 / {KERNEL_WIDTH}e0, 2)) as w from spread),
dens as (select study, param, cell, sum(n_good * w) + 1e0 as gd, sum(n_bad * w) + 1e0 as bd from weighted group by 1, 2, 3),
scores as (select study, param, cast(cell as int) as cell, gd / sum(gd) over (partition by study, param) as good_density,
  bd / sum(bd) over (partition by study, param) as bad_density from dens)"""


def proposals() -> str:
    u = md5_u("trial_id::VARCHAR, param, k::VARCHAR", 0)
    inside = md5_u("trial_id::VARCHAR, param, 'inside'", 0)
    return f"""{HISTORY}, todo as (select study, cast(max(trial_id) + 1 as int) as trial_id from history group by 1),
tries as (select *, unnest(range(1, {CANDIDATES + 1})) as k from todo),
ladder as (select *, ln(good_density) - ln(bad_density) as score,
  sum(good_density) over (partition by study, param order by cell) as cum from scores),
params as (select distinct study, param from ladder),
draws as (select t.study, trial_id, param, k, {u} as u from tries t join params using (study)),
stepped as (select d.study, d.trial_id, d.param, d.k, least(count(*) filter (where l.cum <= d.u), {CELLS - 1}) as cell
  from draws d join ladder l on l.study = d.study and l.param = d.param group by 1, 2, 3, 4),
chosen as (select s.study, trial_id, s.param, arg_max(s.cell, {{'s': l.score, 'k': k}}) as cell
  from stepped s join ladder l on l.study = s.study and l.param = s.param and l.cell = s.cell group by 1, 2, 3),
placed as (select study, trial_id, param, (cell + {inside}) / {CELLS}e0 as u from chosen)
select study, trial_id, {", ".join(f"{shown(p, draw(p, f'max(u) filter (where param = {p.name!r})'))} as {p.name}" for p in SPACE)}
from placed group by 1, 2"""


def oracle_sql() -> dict[str, str]:
    out = {
        "split_summary": SPLIT
        + f"select split, count(*) as n_rows, {q6('avg(tip_pct)')} as mean_tip_pct from labelled group by 1",
        "scan_pruned": WITH
        + f"select count(*) as n_rows, count(passenger_count) as n_passengers, {q6('sum(fare_amount)')} as fares from trips",
        "month_union": WITH
        + f"""select cast(month({PU}) as int) as month, count(*) as n_rows, cast(sum(PULocationID) as bigint) as zone_sum,
  cast(sum(payment_type) as bigint) as payment_sum from trips group by 1""",
        "reject_waterfall": WITH
        + "select case "
        + " ".join(f"when not coalesce({r}, false) then '{n}'" for n, r in RULES.items())
        + " else 'kept' end as outcome, count(*) as n_rows from derived group by 1",
        "duration_speed": WITH
        + f"select {KEY}, {q6('duration_min')} as duration_min, {q6('speed_mph')} as speed_mph from derived",
        "tip_pct": WITH + f"select {KEY}, {q6('tip_pct')} as tip_pct from derived",
        "cyclic_hour": WITH
        + f"select {KEY}, {q6(EXPRS['hour_sin'])} as hour_sin, {q6(EXPRS['hour_cos'])} as hour_cos from trips",
        "calendar_flags": WITH
        + f"select {KEY}, cast({DOW} as int) as dow, {EXPRS['is_weekend']} as is_weekend, {EXPRS['is_night']} as is_night from trips",
        "location_flags": WITH
        + f"select {KEY}, {EXPRS['pu_airport']} as pu_airport, {EXPRS['do_airport']} as do_airport from trips",
        "store_fwd_flag": WITH + f"select {KEY}, {EXPRS['store_and_fwd']} as store_and_fwd from trips",
        "coerce_fill": WITH + f"select {KEY}, " + ", ".join(f"{q6(f32(c))} as {c}" for c in FILLED) + " from trips",
        "pinned_codes": WITH + f"select {KEY}, " + ", ".join(f"{e} as {c}" for c, e in CODES.items()) + " from trips",
        "feature_matrix": MATRIX,
        "stream_features": MATRIX,
        "stream_scores": stumps(scored="test"),
        "load_months": WITH
        + f"""select strftime({PU}, '%Y-%m') as src_month, count(*) as n_rows, count(*) as n_keys,
  cast(sum(payment_type) as bigint) as payment_sum, cast(sum(PULocationID) as bigint) as zone_sum, min({PU}) as first_pickup
from trips group by 1""",
        "temporal_split_counts": WITH
        + f"""select split, count(*) as n_rows, min({PU}) as first_pickup, max({PU}) as last_pickup
  from derived where split is not null group by 1""",
        "hash_sample": WITH + f"select {KEY} from trips where {md5_u(KEY, 42)} < 0.1e0",
        "capped_sample": WITH
        + f"""select {KEY} from trips where {md5_u(KEY, 42)} <
  case when (select count(*) from trips) <= 5000 then 2e0 else 5000e0 / (select count(*) from trips) end""",
        "exact_sample": WITH + f"select {KEY} from trips order by {md5_int(KEY, 42)}, {KEY} limit 1000",
        "round_subsample": WITH
        + f""", rounds as (select *, unnest([0, 1, 2]) as round from cleaned where split is not null)
select round, count(*) as n_rows, {q6('avg(tip_pct)')} as mean_tip_pct from rounds
where {md5_u(KEY + ', round', 7)} < 0.8e0 group by 1""",
        "baseline_rmse": SPLIT
        + f""", mean as (select avg(tip_pct) as m from labelled where split = 'train')
select {q6('sqrt(avg((m - tip_pct) * (m - tip_pct)))')} as baseline_rmse, count(*) as n_test
from labelled cross join mean where split = 'test'""",
        "zone_mean_metrics": SPLIT
        + f", {zone_mean('labelled', 'a')} select {metrics('a_scored', 'train_mean')} from a_scored",
        "random_vs_temporal": SPLIT
        + f""", drawn as (select * replace (case when {md5_u(KEY, 3)} < 0.7e0 then 'train'
    when {md5_u(KEY, 3)} < {0.7 + 0.15!r}::DOUBLE then 'valid' else 'test' end as split) from cleaned),
{zone_mean('labelled', 'a')}, {zone_mean('drawn', 'b')}
select 'temporal' as split_style, {metrics('a_scored', 'train_mean')} from a_scored
union all select 'random', {metrics('b_scored', 'train_mean')} from b_scored""",
        "zone_join": WITH
        + f""", zones as (select n_nationkey * 10 + 1 as zone_id, r_name from nation join region on n_regionkey = r_regionkey)
select p.r_name as pu_borough, q.r_name as do_borough, count(*) as n_trips, {q6('avg(trip_distance)')} as mean_distance
from trips left join zones p on PULocationID = p.zone_id left join zones q on DOLocationID = q.zone_id group by 1, 2""",
        "bin_edges": SPLIT
        + f""", train as (select * from labelled where split = 'train'), {quantile_edges(NUMERIC_FEATURES, 256)}
select pos, {q6('edge')} as edge from edges""",
        "binned_counts": SPLIT
        + f""", train as (select * from labelled where split = 'train'), {edge_ctes(NUMERIC_FEATURES, 256)},
vrows as ({" union all ".join(f"select {i} as pos, cast({f32(c)} as double) as v, null::int as code from labelled where split = 'valid'" for i, c in enumerate(NUMERIC_FEATURES))}
  union all {" union all ".join(f"select {len(NUMERIC_FEATURES) + i}, null, {CODES[c]} from labelled where split = 'valid'" for i, c in enumerate(CATEGORICAL_FEATURES))}),
lists as (select pos, list(edge) as es from edges group by 1)
select vrows.pos, cast(case when vrows.pos < {len(NUMERIC_FEATURES)} then
  case when v is null then 0 else 1 + coalesce(len(list_filter(es, lambda x: x <= v)), 0) end
  else coalesce(code + 1, 0) end as int) as bin, count(*) as n_rows
from vrows left join lists on lists.pos = vrows.pos group by 1, 2""",
        "grad_histogram": f"{FIXED_CELLS} select slot, cast(feature as int) as feature, cast(bin as int) as bin, g, h from cells",
        "root_split": f"""{SCAN}, top as (select *, greatest(gain_left, gain_right) as best, gain_right >= gain_left as mr,
    row_number() over (partition by slot order by greatest(gain_left, gain_right) desc, feature, bin) as rn from scan)
select slot, cast(feature as int) as feature, cast(bin as int) as bin, mr as missing_right, {q6('best / 1e12')} as gain,
  gl + case when mr then 0e0 else gm end as g_left, hl + case when mr then 0e0 else hm end as h_left from top where rn = 1""",
        "missing_direction": f"""{SCAN} select slot, cast(bin as int) as bin, {q6('gain_left / 1e12')} as gain_left,
  {q6('gain_right / 1e12')} as gain_right, gain_right >= gain_left as missing_right from scan where feature = 1""",
        "categorical_order": f"""{SCAN} select slot, cast(bin as int) as bin, pos,
  {q6('greatest(gain_left, gain_right) / 1e12')} as gain from scan where feature = 2""",
        "boost_stumps": stumps(),
        "boost_logistic": stumps(logistic=True),
        "model_gains": gains(),
        "early_stop": f"""{CURVES}, a as (select *, min(valid_rmse) over (partition by trial order by boost_round
    rows between unbounded preceding and 1 preceding) as before from rounds),
b as (select *, max(case when before is null or valid_rmse < before then boost_round end)
    over (partition by trial order by boost_round rows unbounded preceding) as best_at from a),
c as (select *, min(case when boost_round - best_at >= 10 then boost_round end) over (partition by trial) as stop_round from b)
select trial, arg_min(boost_round, {{'v': valid_rmse, 'r': boost_round}}) as best_round, min(valid_rmse) as best_rmse,
  max(stop_round) as stop_round from c where stop_round is null or boost_round <= stop_round group by 1""",
        "report_rows": f"""{CURVES} select trial, boost_round,
  cast(row_number() over (partition by trial order by boost_round) as int) as report_no, {q6('valid_rmse')} as valid_rmse
from rounds where boost_round = 1 or boost_round % 10 = 0""",
        "asha_cutoffs": f"""{REPORTS}, judged as ({rung(2, 'reports')} union all {rung(6, 'reports')})
select study, trial_id, report_no, {q6('cutoff')} as cutoff, stops from judged""",
        "asha_survivors": f"""{REPORTS}, first as ({rung(2, 'reports')}),
running as (select r.* from reports r where not exists
  (select 1 from first f where f.stops and f.study = r.study and f.trial_id = r.trial_id)),
judged as (select * from first union all {rung(6, 'running')})
select study, trial_id, report_no, {q6('cutoff')} as cutoff, stops from judged""",
        "sync_halving": f"""{REPORTS} select study, trial_id, {q6('valid_rmse')} as valid_rmse from (
  select *, percent_rank() over (partition by study order by valid_rmse) as share from reports where report_no = 2)
where share <= {1 / 3!r}::DOUBLE""",
        "best_trial": best("arg_max(valid_rmse, report_no)"),
        "best_trial_min": best("min(valid_rmse)"),
        "gain_topk": f"""with used as (select p_brand as feature, avg((l_orderkey % 1009)::DOUBLE) as gain
    from lineitem join part on l_partkey = p_partkey group by 1),
names as (select distinct p_brand as feature from part)
select feature, {q6('coalesce(gain, 0e0)')} as gain from names left join used using (feature)
order by coalesce(gain, 0e0) desc, feature limit 12""",
        "search_space_sample": "select c_custkey as trial_id, "
        + ", ".join(
            f"{shown(p, draw(p, md5_u('c_custkey::VARCHAR, ' + repr(p.name), 1)))} as {p.name}" for p in SPACE
        )
        + " from customer",
        "config_listing": f"with drawn as (select s_suppkey as trial_id, {configs('s_suppkey', 2)} from supplier) "
        + " union all ".join(
            f"select trial_id, '{p.name}' as param, {q6(p.name)} as value from drawn" for p in SPACE
        ),
        "tpe_scores": f"""{HISTORY} select study, param, cell, {q6('good_density')} as good_density,
  {q6('bad_density')} as bad_density, {q6('ln(good_density) - ln(bad_density)')} as score from scores""",
        "tpe_proposals": proposals(),
    }
    for name, rule in RULES.items():
        out[f"filter_{name}"] = WITH + (
            f"select count(*) as n_rows, cast(sum(l_orderkey) as bigint) as key_sum, "
            f"{q6('avg(duration_min)')} as mean_duration from derived where {rule}"
        )
    return out
