"""Registry of named queries: Spark plan builders and their SQL oracles.

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the given tables.  ``ORACLE`` holds independent DuckDB SQL for each key that
SQL can express; keys without an entry are checked on row counts only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall import oracle
from pitwall.functions.timing import time_to_ms
from pitwall.plans import base_tables as bt
from pitwall.plans import evaluate as ev
from pitwall.plans import features as ft
from pitwall.plans import notebook as nb
from pitwall.plans import reports as rp
from pitwall.operators import aggregates as ag
from pitwall.operators import joins as jn
from pitwall.plans.base_tables import RaceTables

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None, extra: dict[str, str] | None = None,
          conformed: bool = True):
    def deco(fn: Callable[[RaceTables], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: fn(RaceTables(spark, sf_dir, conformed))
        if sql is not None:
            ORACLE[key] = oracle.sql(sql, extra)
        return fn
    return deco


# --- oracle building blocks (DuckDB) -----------------------------------------

OX: dict[str, str] = {
    "lap_base_o": """
select lt.season, lt.round, lt.driverId, lt.lap, lt.position, lt.time,
  r.circuitId, r.raceName, c.circuitName, c.lat, c.long,
  coalesce(p.stop, 0) as stop, p.duration as duration_pitstop,
  coalesce(p.is_pit_stop_lap, false) as is_pit_stop_lap,
  w.mean_temp, w.precipitation_sum, w.windspeed_mean
from lap_times lt
left join races r on r.season = lt.season and r.round = lt.round
left join circuits c on c.circuitId = r.circuitId
left join (select season, round, driverId, lap, stop, duration, true as is_pit_stop_lap
           from pit_stops) p
  on p.season = lt.season and p.round = lt.round and p.driverId = lt.driverId and p.lap = lt.lap
left join weather w on w.season = lt.season and w.round = lt.round""",
    "lap_ms_o": """
select *,
  case when len(string_split(time, ':')) = 2
       then cast(split_part(time, ':', 1) as bigint) * 60000
            + cast(trunc(cast(split_part(time, ':', 2) as decimal(18,3)) * 1000) as bigint)
       when len(string_split(time, ':')) = 1
       then cast(trunc(cast(time as decimal(18,3)) * 1000) as bigint) end as lap_time_milliseconds
from lap_base_o""",
    "lap_norm_o": """
select b.*, m.min_lap_time_race,
  case when m.min_lap_time_race <> 0 then b.lap_time_milliseconds / m.min_lap_time_race end
    as normalized_lap_time
from lap_ms_o b join (select season, round, min(lap_time_milliseconds) as min_lap_time_race
                      from lap_ms_o group by season, round) m
  on m.season = b.season and m.round = b.round""",
    "lap_series_o": """
select *,
  lag(normalized_lap_time, 1) over w as normalized_lap_time_lag_1,
  lag(normalized_lap_time, 2) over w as normalized_lap_time_lag_2,
  lag(normalized_lap_time, 3) over w as normalized_lap_time_lag_3,
  coalesce(lag(is_pit_stop_lap, 1) over w, false) as is_pit_exit_lap
from lap_norm_o
window w as (partition by season, round, driverId order by lap)""",
    "lap_kept_o": """
select * from lap_series_o
where normalized_lap_time is not null and normalized_lap_time <= 1.5""",
    "lap_coded_o": """
select k.*, coalesce(c.code, -1) as circuitId_code
from lap_kept_o k left join (
  select circuitId, cast(dense_rank() over (order by circuitId) - 1 as int) as code
  from (select distinct circuitId from lap_kept_o where circuitId is not null) d) c
  on c.circuitId = k.circuitId""",
    "lap_features_o": """
select season, round, driverId, lap, position, is_pit_stop_lap, is_pit_exit_lap,
  coalesce(normalized_lap_time_lag_1, m.m1) as normalized_lap_time_lag_1,
  coalesce(normalized_lap_time_lag_2, m.m2) as normalized_lap_time_lag_2,
  coalesce(normalized_lap_time_lag_3, m.m3) as normalized_lap_time_lag_3,
  circuitId_code,
  coalesce(mean_temp, m.mt) as mean_temp, coalesce(precipitation_sum, m.mp) as precipitation_sum,
  coalesce(windspeed_mean, m.mw) as windspeed_mean, normalized_lap_time
from lap_coded_o, lap_med_o m""",
    "lap_med_o": """
select median(normalized_lap_time_lag_1) as m1, median(normalized_lap_time_lag_2) as m2,
  median(normalized_lap_time_lag_3) as m3, median(mean_temp) as mt,
  median(precipitation_sum) as mp, median(windspeed_mean) as mw
from lap_coded_o""",
}


# --- F1 / W1-W3 / P10 / C1 -----------------------------------------------------

@query("lap_base", "select * from lap_base_o", OX)
def q_lap_base(t):
    return bt.lap_base(t)


@query("time_to_ms", """
select season, round, driverId, lap, time, lap_time_milliseconds from lap_ms_o""", OX)
def q_time_to_ms(t):
    return t.lap_times.select("season", "round", "driverId", "lap", "time",
                              time_to_ms("time").alias("lap_time_milliseconds"))


@query("time_to_ms_parity", """
select season, round, driverId, lap, time,
  cast(trunc((cast(split_part(time, ':', 1) as bigint) * 60
              + cast(split_part(time, ':', 2) as double)) * 1000) as bigint)
    as lap_time_milliseconds
from lap_times""")
def q_time_to_ms_parity(t):
    return t.lap_times.select("season", "round", "driverId", "lap", "time",
                              time_to_ms("time", parity=True).alias("lap_time_milliseconds"))


@query("lap_normalized", """
select season, round, driverId, lap, lap_time_milliseconds, min_lap_time_race,
  normalized_lap_time from lap_norm_o""", OX)
def q_lap_normalized(t):
    return ft.normalized_laps(t).select(
        "season", "round", "driverId", "lap", "lap_time_milliseconds", "min_lap_time_race",
        "normalized_lap_time")


@query("lap_lags", """
select season, round, driverId, lap, normalized_lap_time, normalized_lap_time_lag_1,
  normalized_lap_time_lag_2, normalized_lap_time_lag_3 from lap_series_o""", OX)
def q_lap_lags(t):
    return ft.lap_series(t).select("season", "round", "driverId", "lap", "normalized_lap_time",
                                   *ft.LAP_LAGS)


@query("pit_exit", """
select season, round, driverId, lap, is_pit_stop_lap, is_pit_exit_lap from lap_series_o""", OX)
def q_pit_exit(t):
    return ft.lap_series(t).select("season", "round", "driverId", "lap", "is_pit_stop_lap",
                                   "is_pit_exit_lap")


@query("lap_outlier_filter", """
select season, round, driverId, lap, normalized_lap_time from lap_kept_o""", OX)
def q_lap_outlier_filter(t):
    return ft.lap_outlier_filter(ft.lap_series(t)).select(
        "season", "round", "driverId", "lap", "normalized_lap_time")


@query("lap_features", "select * from lap_features_o", OX)
def q_lap_features(t):
    return ft.lap_features(t)


# --- race-shaped source views (read from the given tables) ---------------------

def _view_query(name: str):
    @query(f"view_{name}", f"select * from {name}", conformed=False)
    def _q(t):
        return getattr(t, name)
    return _q


for _name in ("laps", "races", "lap_times", "pit_stops", "qualifying", "race_results",
              "driver_standings", "constructor_standings", "weather", "circuits"):
    _view_query(_name)


# --- oracle helpers for the entry-level tables ---------------------------------

def _fmt_ms(c: str) -> str:
    return (f"case when {c} is null then null else "
            f"cast(cast(floor({c}/60000) as int) as varchar) || ':' || "
            f"lpad(cast(cast(floor(({c}%60000)/1000) as int) as varchar), 2, '0') || '.' || "
            f"lpad(cast({c}%1000 as varchar), 3, '0') end")


def _qual_ms(c: str) -> str:
    return (f"coalesce(case when len(string_split({c}, ':')) = 2 then "
            f"cast(split_part({c}, ':', 1) as bigint) * 60000 + "
            f"cast(trunc(cast(split_part({c}, ':', 2) as decimal(18,3)) * 1000) as bigint) "
            f"else cast(trunc(try_cast(split_part({c}, ':', 1) as decimal(18,3)) * 1000) as bigint) "
            f"end, -1)")


def _codes(src: str, col: str) -> str:
    return (f"(select {col}, cast(dense_rank() over (order by {col}) - 1 as int) as code "
            f"from (select distinct {col} from {src} where {col} is not null) d)")


_PREV_SQL = """
left join driver_standings ds on ds.driverId = b0.driverId and ds.season + 1 = b0.season
left join constructor_standings cs on cs.constructorId = b0.constructorId and cs.season + 1 = b0.season
left join weather w on w.season = b0.season and w.round = b0.round"""
_PREV_COLS = """
  ds.points as driver_prev_season_points, ds.position as driver_prev_season_position,
  ds.wins as driver_prev_season_wins, cs.points as constructor_prev_season_points,
  cs.position as constructor_prev_season_position, cs.wins as constructor_prev_season_wins,
  w.mean_temp, w.precipitation_sum, w.windspeed_mean"""

OX.update({
    "rq_o": f"""
select rr.*, coalesce(try_cast(rr.position as double) in (1, 2, 3), false) as on_podium,
  cast(q.position as double) as grid, {_fmt_ms('q.q1')} as qual_q1,
  {_fmt_ms('q.q2')} as qual_q2, {_fmt_ms('q.q3')} as qual_q3
from race_results rr left join qualifying q
  on q.season = rr.season and q.round = rr.round and q.driverId = rr.driverId""",
    "podium_base_o": f"""
select b0.*, ra.circuitId, ra.raceName, {_PREV_COLS}
from rq_o b0 left join races ra on ra.season = b0.season and ra.round = b0.round {_PREV_SQL}""",
    "podium_coded_o": f"""
select b.*, coalesce(cc.code, -1) as circuitId_code, coalesce(kc.code, -1) as constructorId_code,
  {_qual_ms('b.qual_q1')} as qual_q1_ms, {_qual_ms('b.qual_q2')} as qual_q2_ms,
  {_qual_ms('b.qual_q3')} as qual_q3_ms
from podium_base_o b
left join {_codes('podium_base_o', 'circuitId')} cc on cc.circuitId = b.circuitId
left join {_codes('podium_base_o', 'constructorId')} kc on kc.constructorId = b.constructorId""",
    "podium_med_o": """
select median(grid) as g, median(driver_prev_season_points) as dp,
  median(driver_prev_season_position) as dpo, median(driver_prev_season_wins) as dw,
  median(constructor_prev_season_points) as cp, median(constructor_prev_season_position) as cpo,
  median(constructor_prev_season_wins) as cw, median(mean_temp) as mt,
  median(precipitation_sum) as mp, median(windspeed_mean) as mw
from podium_coded_o""",
    "podium_features_o": """
select season, round, raceName, driverId, constructorId, position,
  coalesce(grid, m.g) as grid, circuitId_code,
  coalesce(driver_prev_season_points, m.dp) as driver_prev_season_points,
  coalesce(driver_prev_season_position, m.dpo) as driver_prev_season_position,
  coalesce(driver_prev_season_wins, m.dw) as driver_prev_season_wins,
  constructorId_code,
  coalesce(constructor_prev_season_points, m.cp) as constructor_prev_season_points,
  coalesce(constructor_prev_season_position, m.cpo) as constructor_prev_season_position,
  coalesce(constructor_prev_season_wins, m.cw) as constructor_prev_season_wins,
  qual_q1_ms, qual_q2_ms, qual_q3_ms,
  coalesce(mean_temp, m.mt) as mean_temp, coalesce(precipitation_sum, m.mp) as precipitation_sum,
  coalesce(windspeed_mean, m.mw) as windspeed_mean, on_podium
from podium_coded_o, podium_med_o m""",
    "scored_o": """
select *, 1.0E0 / (1.0E0 + grid) as p, 1.0E0 / (1.0E0 + grid) >= 0.25 as predicted
from podium_features_o""",
    "pole_base_o": f"""
select b0.season, b0.round, b0.driverId, b0.constructorId, {_fmt_ms('b0.q3')} as pole_lap_time,
  1 as grid, ra.circuitId, ra.raceName, {_PREV_COLS}
from (select * from qualifying where position = 1) b0
left join races ra on ra.season = b0.season and ra.round = b0.round {_PREV_SQL}""",
    "pole_coded_o": f"""
select b.*, coalesce(dc.code, -1) as driverId_code, coalesce(cc.code, -1) as circuitId_code,
  coalesce(kc.code, -1) as constructorId_code
from pole_base_o b
left join {_codes('pole_base_o', 'driverId')} dc on dc.driverId = b.driverId
left join {_codes('pole_base_o', 'circuitId')} cc on cc.circuitId = b.circuitId
left join {_codes('pole_base_o', 'constructorId')} kc on kc.constructorId = b.constructorId""",
    "pole_med_o": """
select median(driver_prev_season_points) as dp, median(driver_prev_season_position) as dpo,
  median(driver_prev_season_wins) as dw, median(constructor_prev_season_points) as cp,
  median(constructor_prev_season_position) as cpo, median(constructor_prev_season_wins) as cw
from pole_coded_o""",
    "pole_features_o": """
select season, round, driverId, circuitId_code,
  coalesce(driver_prev_season_points, m.dp) as driver_prev_season_points,
  coalesce(driver_prev_season_position, m.dpo) as driver_prev_season_position,
  coalesce(driver_prev_season_wins, m.dw) as driver_prev_season_wins,
  constructorId_code,
  coalesce(constructor_prev_season_points, m.cp) as constructor_prev_season_points,
  coalesce(constructor_prev_season_position, m.cpo) as constructor_prev_season_position,
  coalesce(constructor_prev_season_wins, m.cw) as constructor_prev_season_wins,
  driverId_code
from pole_coded_o, pole_med_o m""",
})


def scored(t: RaceTables) -> DataFrame:
    return ev.stand_in_scores(ft.podium_features(t))


# --- C2 / C3 and their joins -----------------------------------------------------

@query("podium_base", "select * from podium_base_o", OX)
def q_podium_base(t):
    return bt.podium_base(t)


@query("results_join_qualifying", "select * from rq_o", OX)
def q_results_join_qualifying(t):
    return bt.results_join_qualifying(t)


@query("pole_sitters", f"""
select season, round, driverId, constructorId, {_fmt_ms('q3')} as pole_lap_time, 1 as grid
from qualifying where position = 1""")
def q_pole_sitters(t):
    return bt.pole_sitters(t)


@query("pole_base", "select * from pole_base_o", OX)
def q_pole_base(t):
    return bt.pole_base(t)


@query("podium_features", "select * from podium_features_o", OX)
def q_podium_features(t):
    return ft.podium_features(t)


@query("pole_features", "select * from pole_features_o", OX)
def q_pole_features(t):
    return ft.pole_features(t)


@query("qual_time_to_ms", """
select season, round, driverId, qual_q1, qual_q2, qual_q3, qual_q1_ms, qual_q2_ms, qual_q3_ms
from podium_coded_o""", OX)
def q_qual_time_to_ms(t):
    from pitwall.functions.timing import qual_time_to_ms
    df = bt.podium_base(t)
    return df.select("season", "round", "driverId", "qual_q1", "qual_q2", "qual_q3",
                     *[qual_time_to_ms(c).alias(f"{c}_ms") for c in ("qual_q1", "qual_q2", "qual_q3")])


@query("category_codes", f"""
select circuitId, code as circuitId_code from {_codes('podium_base_o', 'circuitId')} x""", OX)
def q_category_codes(t):
    from pitwall.operators.windows import category_codes
    d = bt.podium_base(t).select("circuitId").distinct()
    return category_codes(d, "circuitId", "circuitId_code").filter(F.col("circuitId").isNotNull())


# --- E1-E9 on stand-in scores ----------------------------------------------------

@query("regression_metrics", """
select avg((normalized_lap_time_lag_1 - normalized_lap_time) * (normalized_lap_time_lag_1 - normalized_lap_time)) as mse,
  avg(abs(normalized_lap_time_lag_1 - normalized_lap_time)) as mae, count(*) as n,
  case when season >= 2000 then 'test' else 'train' end as split
from lap_features_o group by case when season >= 2000 then 'test' else 'train' end""", OX)
def q_regression_metrics(t):
    f = ft.lap_features(t).withColumn(
        "split", F.when(F.col("season") >= 2000, "test").otherwise("train"))
    return ev.regression_metrics(f, "normalized_lap_time", "normalized_lap_time_lag_1", ["split"])


@query("classification_accuracy", """
select avg(case when on_podium = predicted then 1.0E0 else 0.0E0 end) as accuracy, count(*) as n
from scored_o""", OX)
def q_classification_accuracy(t):
    return ev.accuracy(scored(t), "on_podium", "predicted")


@query("confusion_matrix", """
select l.c as on_podium, p.c as predicted, count(s.on_podium) as n
from (select distinct on_podium as c from scored_o union select distinct predicted from scored_o) l
cross join (select distinct on_podium as c from scored_o union select distinct predicted from scored_o) p
left join scored_o s on s.on_podium = l.c and s.predicted = p.c
group by l.c, p.c""", OX)
def q_confusion_matrix(t):
    return ev.confusion_matrix(scored(t), "on_podium", "predicted")


_REPORT_O = """
per as (
  select cls, sum(is_label) as support, sum(is_pred) as n_pred, sum(hit) as tp from (
    select on_podium as cls, 1 as is_label, 0 as is_pred, case when on_podium = predicted then 1 else 0 end as hit from scored_o
    union all select predicted, 0, 1, 0 from scored_o) u group by cls),
pr as (
  select cast(cls as varchar) as class_label,
    coalesce(tp / nullif(cast(n_pred as double), 0), 0.0E0) as precision,
    coalesce(tp / nullif(cast(support as double), 0), 0.0E0) as recall, cast(support as bigint) as support
  from per),
f as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0.0E0 end as f1 from pr)
"""


@query("classification_report", "with " + _REPORT_O + """
select class_label, precision, recall, support, f1 from f
union all select 'macro avg', avg(precision), avg(recall), sum(support), avg(f1) from f
union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(support), sum(f1 * support) / sum(support) from f""", OX)
def q_classification_report(t):
    return ev.classification_report(scored(t), "on_podium", "predicted")


@query("weighted_f1", "with " + _REPORT_O + """
select sum(f1 * support) / sum(support) as weighted_f1 from f""", OX)
def q_weighted_f1(t):
    return ev.weighted_f1(scored(t), "on_podium", "predicted")


@query("roc_auc", """
with d as (select p as s, count_if(on_podium) as pos, count_if(not on_podium) as neg
           from scored_o group by p),
c as (select *, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as below from d)
select case when sum(pos) > 0 and sum(neg) > 0
            then sum(pos * (below + 0.5E0 * neg)) / (sum(pos) * sum(neg)) end as roc_auc,
  cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg from c""", OX)
def q_roc_auc(t):
    return ev.roc_auc(scored(t), "on_podium", "p")


_TOP3_O = """
pt as (select *, row_number() over (partition by season, round order by p desc, driverId) as rk from scored_o),
pred as (select season, round, min(raceName) as race,
           max(case when rk = 1 then driverId end) as predicted_p1,
           max(case when rk = 2 then driverId end) as predicted_p2,
           max(case when rk = 3 then driverId end) as predicted_p3 from pt where rk <= 3 group by season, round),
atop as (select *, row_number() over (partition by season, round order by try_cast(position as int), driverId) as rk
       from scored_o where on_podium),
act as (select season, round, count(*) as n_actual,
          max(case when rk = 1 then driverId end) as actual_p1,
          max(case when rk = 2 then driverId end) as actual_p2,
          max(case when rk = 3 then driverId end) as actual_p3 from atop group by season, round),
val as (
  select pred.season, pred.round, race, predicted_p1 as predicted_winner, actual_p1 as actual_winner,
    predicted_p1 = actual_p1 as winner_match,
    cast(len(list_intersect(list_distinct([predicted_p1, predicted_p2, predicted_p3]),
                            [actual_p1, actual_p2, actual_p3])) as int) as podium_matches,
    predicted_p1, predicted_p2, predicted_p3, actual_p1, actual_p2, actual_p3
  from pred join act on pred.season = act.season and pred.round = act.round
  where act.n_actual >= 3)
"""


@query("season_validation", "with " + _TOP3_O + "select * from val", OX)
def q_season_validation(t):
    return ev.season_validation(scored(t))


@query("season_summary", "with " + _TOP3_O + """
select season, count(*) as races, avg(case when winner_match then 1.0E0 else 0.0E0 end) * 100 as winner_accuracy_pct,
  count_if(winner_match) as winners_correct, avg(cast(podium_matches as double)) as avg_podium_matches,
  count_if(podium_matches = 3 and winner_match) as perfect_races, count_if(podium_matches = 3) as races_all_three
from val group by season""", OX)
def q_season_summary(t):
    return ev.season_summary(ev.season_validation(scored(t)))


@query("match_distribution", "with " + _TOP3_O + """
select season, podium_matches, count(*) as races,
  count(*) * 100.0E0 / sum(count(*)) over (partition by season) as pct
from val group by season, podium_matches""", OX)
def q_match_distribution(t):
    return ev.match_distribution(ev.season_validation(scored(t)))


@query("perfect_races", "with " + _TOP3_O + """
select season, round, race from val where podium_matches = 3 and winner_match""", OX)
def q_perfect_races(t):
    return ev.perfect_races(ev.season_validation(scored(t)))


OX_CALLED = {**OX, "scored_o": """
select * exclude (p), p, p >= 0.25 as predicted from (
  select *, 1.0E0 / (1.0E0 + case when round % 2 = 0 then coalesce(try_cast(position as double), 99) else grid end) as p
  from podium_features_o) x"""}


@query("perfect_races_called", "with " + _TOP3_O + """
select season, round, race from val where podium_matches = 3 and winner_match""", OX_CALLED)
def q_perfect_races_called(t):
    """E8 with a stand-in score that calls every second round right."""
    place = F.coalesce(F.col("position").try_cast("double"), F.lit(99.0))
    p = 1.0 / (1.0 + F.when(F.col("round") % 2 == 0, place).otherwise(F.col("grid").cast("double")))
    called = ft.podium_features(t).withColumn("p", p).withColumn("predicted", F.col("p") >= 0.25)
    return ev.perfect_races(ev.season_validation(called))


@query("top3_per_race", """
select season, round, driverId, p, cast(rk as int) as pred_rank from (
  select *, row_number() over (partition by season, round order by p desc, driverId) as rk from scored_o) x
where rk <= 3""", OX)
def q_top3_per_race(t):
    return ev.predicted_top3(scored(t)).select("season", "round", "driverId", "p", "pred_rank")


@query("podium_sets", """
with pr as (select season, round, min(raceName) as raceName,
              array_to_string(list_sort(list(distinct driverId)), ',') as predicted_podium from (
              select *, row_number() over (partition by season, round order by p desc, driverId) as rk
              from scored_o) x where rk <= 3 group by season, round),
ac as (select season, round, array_to_string(list_sort(list(distinct driverId)), ',') as actual_podium,
         count(*) as n_actual from scored_o where on_podium group by season, round)
select pr.*, ac.actual_podium, ac.n_actual from pr join ac on pr.season = ac.season and pr.round = ac.round""", OX)
def q_podium_sets(t):
    return ev.podium_sets(scored(t))


@query("podium_set_eval", """
with pr as (select season, round, list_sort(list(distinct driverId)) as ps from (
              select *, row_number() over (partition by season, round order by p desc, driverId) as rk
              from scored_o) x where rk <= 3 group by season, round),
ac as (select season, round, list_sort(list(distinct driverId)) as acs from scored_o where on_podium group by season, round),
e as (select ps = acs as exact, len(list_intersect(ps, acs)) as correct
      from pr join ac on pr.season = ac.season and pr.round = ac.round)
select avg(case when exact then 1.0E0 else 0.0E0 end) as exact_podium_accuracy,
  cast(sum(correct) as bigint) as correct_drivers, count(*) * 3 as podium_slots,
  sum(correct) / (count(*) * 3.0E0) as correct_ratio, avg(correct) as avg_correct_per_race,
  count(*) as races from e""", OX)
def q_podium_set_eval(t):
    return ev.podium_set_eval(scored(t))


@query("race_accuracy", """
select season, round, count_if(predicted = on_podium) as correct, count(*) as total,
  count_if(predicted) as predicted_podiums, count_if(on_podium) as actual_podiums,
  count_if(predicted and on_podium) as true_positives,
  count_if(predicted = on_podium) * 100.0E0 / count(*) as accuracy_pct,
  case when count_if(on_podium) > 0 then count_if(predicted and on_podium) * 100.0E0 / count_if(on_podium) end as recall_pct
from scored_o group by season, round""", OX)
def q_race_accuracy(t):
    return ev.race_accuracy(scored(t))




# --- P: projections, filters, predicates ----------------------------------------

@query("project_subset", "select season, round, circuitId, raceName from races")
def q_project_subset(t):
    return t.races.select("season", "round", "circuitId", "raceName")


@query("project_rename", """
select season, round, driverId, position as grid_position_raw, q1 as qual_q1, q2 as qual_q2,
  q3 as qual_q3 from qualifying""")
def q_project_rename(t):
    return t.qualifying.withColumnsRenamed({
        "position": "grid_position_raw", "q1": "qual_q1", "q2": "qual_q2", "q3": "qual_q3"}
    ).drop("constructorId")


@query("project_drop", """
select season, round, driverId, lap, position, time, circuitId, raceName, circuitName, lat, long,
  is_pit_stop_lap, mean_temp, precipitation_sum, windspeed_mean from lap_base_o""", OX)
def q_project_drop(t):
    return bt.lap_base(t).drop("stop", "duration_pitstop", "no_such_column")


@query("project_constants", """
select season, round, driverId, lap, position, time, false as is_pit_stop_lap, 0 as stop,
  cast(null as varchar) as duration_pitstop, cast(null as double) as mean_temp,
  cast(null as double) as precipitation_sum, cast(null as double) as windspeed_mean
from lap_times""")
def q_project_constants(t):
    """The 'no pit data / no weather' branch: constants and typed NULL placeholders."""
    return t.lap_times.withColumns({
        "is_pit_stop_lap": F.lit(False), "stop": F.lit(0),
        "duration_pitstop": F.lit(None).cast("string"),
        **{c: F.lit(None).cast("double") for c in ft.WEATHER}})


@query("lenient_numeric", """
select season, round, driverId, position, try_cast(position as double) as position_numeric
from race_results""")
def q_lenient_numeric(t):
    return t.race_results.select("season", "round", "driverId", "position",
                                 F.col("position").try_cast("double").alias("position_numeric"))


@query("podium_label", """
select season, round, driverId, position,
  coalesce(try_cast(position as double) in (1, 2, 3), false) as on_podium from race_results""")
def q_podium_label(t):
    return t.race_results.select("season", "round", "driverId", "position",
                                 bt.podium_label(F.col("position")).cast("boolean").alias("on_podium"))


@query("temporal_split", """
select season, round, driverId,
  case when season between 1995 and 1999 then 'train' else 'test' end as split
from podium_features_o where season between 1995 and 2001""", OX)
def q_temporal_split(t):
    from pitwall.operators.splits import temporal_split
    return temporal_split(ft.podium_features(t), TRAIN_SEASONS, TEST_SEASONS).select(
        "season", "round", "driverId", "split")


@query("complete_cases", """
select * from podium_base_o where grid is not null and driver_prev_season_points is not null
  and constructor_prev_season_points is not null and mean_temp is not null""", OX)
def q_complete_cases(t):
    return ft.complete_cases(bt.podium_base(t), ["grid", "driver_prev_season_points",
                                                 "constructor_prev_season_points", "mean_temp"])


@query("latest_round", """
select b.season, b.round, b.driverId, b.position from race_results b
join (select season, max(round) as round from race_results group by season) m
  on m.season = b.season and m.round = b.round""")
def q_latest_round(t):
    return rp.latest_round(t.race_results.select("season", "round", "driverId", "position"))


@query("probability_bands", """
select season, round, driverId, p,
  case when p >= 0.7 then '[HIGH]' when p >= 0.4 then '[ MED]' else '[ LOW]' end as band,
  case when predicted then '[PODIUM]' else '[  --  ]' end as prediction_tag,
  case when predicted and rk = 1 then '[1]' when predicted and rk = 2 then '[2]'
       when predicted and rk = 3 then '[3]' else '   ' end as rank_icon
from (select *, row_number() over (partition by season, round order by p desc, driverId) as rk from scored_o) x""", OX)
def q_probability_bands(t):
    return rp.probability_bands(scored(t))


# --- J: joins ------------------------------------------------------------------

@query("lap_join_races", """
select lt.*, r.circuitId, r.raceName from lap_times lt
left join races r on r.season = lt.season and r.round = lt.round""")
def q_lap_join_races(t):
    return jn.join_races(t.lap_times, t.races, ["circuitId", "raceName"])


@query("lap_base_dated", """
select *, make_date(season, round, 1) as date, '00:00:00Z' as time_race_start from lap_base_o""", OX)
def q_lap_base_dated(t):
    """J1 with the race's date and start time."""
    return bt.lap_base(t, dated=True)


@query("lap_join_circuits", """
select lt.*, r.circuitId, c.circuitName, c.lat, c.long from lap_times lt
left join races r on r.season = lt.season and r.round = lt.round
left join circuits c on c.circuitId = r.circuitId""")
def q_lap_join_circuits(t):
    df = jn.join_races(t.lap_times, t.races, ["circuitId"])
    return jn.join_circuits(df, t.circuits)


@query("lap_pit_marker", """
select lt.*, coalesce(p.stop, 0) as stop, p.duration as duration_pitstop,
  p.season is not null as is_pit_stop_lap
from lap_times lt left join pit_stops p
  on p.season = lt.season and p.round = lt.round and p.driverId = lt.driverId and p.lap = lt.lap""")
def q_lap_pit_marker(t):
    return jn.pit_marker(t.lap_times, t.pit_stops)


@query("lap_join_weather", """
select lt.*, w.mean_temp, w.precipitation_sum, w.windspeed_mean from lap_times lt
left join weather w on w.season = lt.season and w.round = lt.round""")
def q_lap_join_weather(t):
    return jn.join_weather(t.lap_times, t.weather)


@query("prev_driver_standings", """
select r.season, r.round, r.driverId, ds.points as driver_prev_season_points,
  ds.position as driver_prev_season_position, ds.wins as driver_prev_season_wins
from race_results r left join driver_standings ds on ds.driverId = r.driverId and ds.season + 1 = r.season""")
def q_prev_driver_standings(t):
    return jn.join_prev_season(t.race_results.select("season", "round", "driverId"),
                               t.driver_standings, "driverId", "driver")


@query("prev_constructor_standings", """
select r.season, r.round, r.driverId, r.constructorId, cs.points as constructor_prev_season_points,
  cs.position as constructor_prev_season_position, cs.wins as constructor_prev_season_wins
from race_results r left join constructor_standings cs
  on cs.constructorId = r.constructorId and cs.season + 1 = r.season""")
def q_prev_constructor_standings(t):
    return jn.join_prev_season(t.race_results.select("season", "round", "driverId", "constructorId"),
                               t.constructor_standings, "constructorId", "constructor")


OX.update({
    "nb_join_o": """
select l.season * 100 + l.round as raceId, l.driverId, l.lap, l.lap_ms as milliseconds,
  cast(substr(r.circuitId, 2) as int) as circuitId
from laps l left join races r on r.season = l.season and r.round = l.round""",
    "nb_norm_o": """
select j.*, j.milliseconds / m.mn as normalized_time
from nb_join_o j join (select raceId, min(milliseconds) as mn from nb_join_o group by raceId) m
  on m.raceId = j.raceId""",
    "nb_pit_o": """
select n.*, p.raceId is not null as is_pit_stop from nb_norm_o n
left join (select season * 100 + round as raceId, driverId, lap from pit_stops) p
  on p.raceId = n.raceId and p.driverId = n.driverId and p.lap = n.lap""",
    "nb_exit_o": """
select *, coalesce(lag(is_pit_stop) over (partition by raceId, driverId order by lap), false) as is_pit_exit
from nb_pit_o""",
})


@query("nb_join_races", "select * from nb_join_o", OX)
def q_nb_join_races(t):
    return nb.nb_join_races(t)


@query("nb_pit_indicator", "select raceId, driverId, lap, is_pit_stop from nb_pit_o", OX)
def q_nb_pit_indicator(t):
    return nb.nb_pit_indicator(t).select("raceId", "driverId", "lap", "is_pit_stop")


@query("nb_pit_exit", "select raceId, driverId, lap, is_pit_stop, is_pit_exit from nb_exit_o", OX)
def q_nb_pit_exit(t):
    return nb.nb_pit_exit(t).select("raceId", "driverId", "lap", "is_pit_stop", "is_pit_exit")


OX["nb_lags_o"] = """
select raceId, driverId, circuitId, lap, is_pit_stop, is_pit_exit, lag_1, lag_2, normalized_time from (
  select *, lag(normalized_time, 1) over w as lag_1, lag(normalized_time, 2) over w as lag_2
  from nb_exit_o where normalized_time <= 1.5
  window w as (partition by raceId, driverId order by lap)) x
where circuitId is not null and lag_1 is not null and lag_2 is not null and normalized_time is not null"""


@query("nb_lap_lags", "select * from nb_lags_o", OX)
def q_nb_lap_lags(t):
    return nb.nb_lap_lags(t)


# --- A: aggregations -----------------------------------------------------------

@query("median_features", """
select median(grid) as grid, median(driver_prev_season_points) as driver_prev_season_points,
  median(constructor_prev_season_points) as constructor_prev_season_points,
  median(mean_temp) as mean_temp, median(precipitation_sum) as precipitation_sum,
  median(windspeed_mean) as windspeed_mean from podium_base_o""", OX)
def q_median_features(t):
    cols = ["grid", "driver_prev_season_points", "constructor_prev_season_points", *ft.WEATHER]
    found = ag.medians(bt.podium_base(t), cols)
    return found.agg(*[F.max(F.when(F.col("column_name") == c, F.col("median"))).alias(c) for c in cols])


@query("season_stats", """
select season, count(distinct round) as total_races, count(distinct driverId) as unique_drivers,
  count(*) as total_entries from race_results group by season""")
def q_season_stats(t):
    return rp.season_stats(t.race_results)


@query("table_counts", """
select 'races' as table_name, count(*) as row_count from races
union all select 'race_results', count(*) from race_results
union all select 'qualifying', count(*) from qualifying
union all select 'lap_times', count(*) from lap_times
union all select 'pit_stops', count(*) from pit_stops""")
def q_table_counts(t):
    return ag.table_counts({n: getattr(t, n) for n in
                            ("races", "race_results", "qualifying", "lap_times", "pit_stops")})


_NULL_COLS = ["grid", "qual_q1", "qual_q2", "qual_q3", "driver_prev_season_points",
              "constructor_prev_season_points", "mean_temp", "circuitId"]


@query("null_counts", " union all ".join(
    f"select '{c}' as column_name, count_if({c} is null) as null_count, count(*) as row_count, "
    f"count_if({c} is null) = count(*) as all_null from podium_base_o" for c in _NULL_COLS), OX)
def q_null_counts(t):
    return ag.null_counts(bt.podium_base(t), _NULL_COLS)


@query("class_weights", """
select on_podium, count(*) as n_class, sum(count(*)) over () / (count(*) over () * count(*)) as class_weight
from podium_features_o group by on_podium""", OX)
def q_class_weights(t):
    return ag.class_weights(ft.podium_features(t), "on_podium")


TRAIN_SEASONS = [1995, 1996, 1997, 1998, 1999]
TEST_SEASONS = [2000, 2001]


@query("season_availability", """
select s.season, r.season is not null as has_results, q.season is not null as has_qualifying,
  d.season is not null as has_prev_standings
from (select unnest(range(1995, 2002)) as season) s
left join (select distinct season from race_results) r on r.season = s.season
left join (select distinct season from qualifying) q on q.season = s.season
left join (select distinct season + 1 as season from driver_standings) d on d.season = s.season""")
def q_season_availability(t):
    from pitwall.operators.splits import season_availability
    return season_availability(t, TRAIN_SEASONS + TEST_SEASONS)


# --- W / O: windows and ordering --------------------------------------------------

@query("race_ranking", """
select season, round, rpad(substr(raceName, 1, 30), 30, ' ') as race_label, cast(rk as int) as rank,
  driverId, substr(constructorId, 1, 22) as team, cast(grid as int) as grid,
  round(p * 100, 1) as probability_pct,
  case when predicted then '[PODIUM]' else '[  --  ]' end as prediction,
  case when predicted and rk = 1 then '[1]' when predicted and rk = 2 then '[2]'
       when predicted and rk = 3 then '[3]' else '   ' end as rank_icon,
  case when p >= 0.7 then '[HIGH]' when p >= 0.4 then '[ MED]' else '[ LOW]' end as band
from (select s.*, row_number() over (partition by s.season, s.round order by p desc, driverId) as rk
      from scored_o s join (select season, max(round) as round from scored_o group by season) m
        on m.season = s.season and m.round = s.round) x
where rk <= 10""", OX)
def q_race_ranking(t):
    return rp.race_report(scored(t))


@query("race_ranking_of_round", """
select season, round, make_date(season, round, 1) as date, rpad(substr(raceName, 1, 30), 30, ' ') as race_label,
  cast(rk as int) as rank, driverId, substr(constructorId, 1, 22) as team, cast(grid as int) as grid,
  round(p * 100, 1) as probability_pct,
  case when predicted then '[PODIUM]' else '[  --  ]' end as prediction,
  case when predicted and rk = 1 then '[1]' when predicted and rk = 2 then '[2]'
       when predicted and rk = 3 then '[3]' else '   ' end as rank_icon,
  case when p >= 0.7 then '[HIGH]' when p >= 0.4 then '[ MED]' else '[ LOW]' end as band
from (select s.*, row_number() over (partition by s.season, s.round order by p desc, driverId) as rk
      from scored_o s where season = 1998 and round = 5) x
where rk <= 10""", OX)
def q_race_ranking_of_round(t):
    """R1/P12 for a race that the user chooses, with its date."""
    return rp.race_report(scored(t), race_round=5, season=1998, races=bt.race_days(t.races))


@query("actual_podium", """
select season, round, 'P' || cast(pos_num as varchar) as place, driverId,
  round(p * 100, 1) as probability_pct, case when predicted then '[OK]' else '[XX]' end as called
from (select *, try_cast(position as int) as pos_num,
        row_number() over (partition by season, round order by try_cast(position as int), driverId) as rk
      from scored_o where on_podium) x where rk <= 3""", OX)
def q_actual_podium(t):
    return rp.actual_podium(scored(t))


@query("season_rounds", "select distinct season, round from race_results order by season, round")
def q_season_rounds(t):
    return t.race_results.select("season", "round").distinct().orderBy("season", "round")


# --- U: set operations -------------------------------------------------------------

@query("union_seasons", """
select season, round, driverId, grid, cast(null as double) as mean_temp from podium_base_o where season <= 1998
union all select season, round, driverId, grid, mean_temp from podium_base_o where season > 1998""", OX)
def q_union_seasons(t):
    """Frames with different columns, aligned by name; the missing one becomes NULL."""
    b = bt.podium_base(t)
    early = b.filter(F.col("season") <= 1998).select("season", "round", "driverId", "grid")
    late = b.filter(F.col("season") > 1998).select("season", "round", "driverId", "grid", "mean_temp")
    return early.unionByName(late, allowMissingColumns=True)


# --- F: scalar functions --------------------------------------------------------------

@query("fill_constants", """
select lt.season, lt.round, lt.driverId, lt.lap, coalesce(p.stop, 0) as stop,
  coalesce(p.is_pit, false) as is_pit_stop_lap
from lap_times lt left join (select season, round, driverId, lap, stop, true as is_pit from pit_stops) p
  on p.season = lt.season and p.round = lt.round and p.driverId = lt.driverId and p.lap = lt.lap""")
def q_fill_constants(t):
    """F3 via ``na.fill`` on the raw left join."""
    marks = t.pit_stops.select("season", "round", "driverId", "lap", "stop",
                               F.lit(True).alias("is_pit_stop_lap"))
    j = t.lap_times.select("season", "round", "driverId", "lap").join(
        marks, ["season", "round", "driverId", "lap"], "left")
    return j.na.fill({"stop": 0, "is_pit_stop_lap": False})


@query("composite_key", """
select concat_ws('_', season, round, driverId, lap) as pit_stop_key, stop, duration from pit_stops""")
def q_composite_key(t):
    return t.pit_stops.select(
        F.concat_ws("_", "season", "round", "driverId", "lap").alias("pit_stop_key"),
        "stop", "duration")


@query("report_labels", """
select season, round, upper(replace(raceName, ' ', '_')) as race_key,
  rpad(substr(raceName, 1, 30), 30, ' ') as race_label,
  rpad(substr(coalesce(driverId, 'Unknown'), 1, 15), 15, ' ') as driver_label,
  substr(coalesce(constructorId, 'Unknown'), 1, 22) as team
from podium_base_o""", OX)
def q_report_labels(t):
    b = bt.podium_base(t)
    return b.select(
        "season", "round", F.upper(F.replace("raceName", F.lit(" "), F.lit("_"))).alias("race_key"),
        F.rpad(F.substring("raceName", 1, 30), 30, " ").alias("race_label"),
        F.rpad(F.substring(F.coalesce("driverId", F.lit("Unknown")), 1, 15), 15, " ").alias("driver_label"),
        rp.team_label(b).alias("team"))




# --- M9-M12, M14: splits and folds ----------------------------------------------------

@query("hash_split", """
select season, round, driverId, lap,
  case when substr(md5(concat_ws('_', season, round, driverId, lap)), 1, 2) < '33' then 'test' else 'train' end as split
from lap_features_o""", OX)
def q_hash_split(t):
    from pitwall.operators.splits import hash_split
    f = ft.lap_features(t).select("season", "round", "driverId", "lap")
    return hash_split(f, ["season", "round", "driverId", "lap"])


@query("ordered_split", """
select season, round, driverId, lap,
  case when row_number() over (order by season, round, driverId, lap)
            <= count(*) over () - ceil(count(*) over () * 0.2) then 'train' else 'test' end as split
from lap_features_o""", OX)
def q_ordered_split(t):
    from pitwall.operators.splits import ordered_split
    f = ft.lap_features(t).select("season", "round", "driverId", "lap")
    return ordered_split(f, ["season", "round", "driverId", "lap"])


@query("stratified_split", """
select season, round, driverId, on_podium,
  case when row_number() over (partition by on_podium
              order by md5(concat_ws('_', season, round, driverId)), season, round, driverId)
            <= floor(count(*) over (partition by on_podium) * 0.75) then 'train' else 'test' end as split
from podium_features_o""", OX)
def q_stratified_split(t):
    from pitwall.operators.splits import stratified_split
    f = ft.podium_features(t).select("season", "round", "driverId", "on_podium")
    return stratified_split(f, "on_podium", ["season", "round", "driverId"])


@query("cv_folds", """
with c as (select on_podium, count(*) as n from podium_features_o group by on_podium),
a as (select on_podium, n, coalesce(sum(n) over (order by on_podium rows between unbounded preceding and 1 preceding), 0) as s from c),
r as (select season, round, driverId, on_podium,
        row_number() over (partition by on_podium order by season, round, driverId) as rn from podium_features_o)
select r.season, r.round, r.driverId, r.on_podium,
  case when rn <= floor((a.s + a.n + 1) / 2) - floor((a.s + 1) / 2) then 0 else 1 end as fold
from r join a on a.on_podium = r.on_podium""", OX)
def q_cv_folds(t):
    from pitwall.operators.splits import stratified_kfold2
    f = ft.podium_features(t).select("season", "round", "driverId", "on_podium")
    return stratified_kfold2(f, "on_podium", ["season", "round", "driverId"])


@query("cv_folds_regression", """
select season, round, driverId, lap,
  case when row_number() over (order by season, round, driverId, lap) <= ceil(count(*) over () / 2) then 0 else 1 end as fold
from lap_features_o""", OX)
def q_cv_folds_regression(t):
    from pitwall.operators.splits import kfold2
    f = ft.lap_features(t).select("season", "round", "driverId", "lap")
    return kfold2(f, ["season", "round", "driverId", "lap"])




# --- S: landed pages, scans and sinks ---------------------------------------------------

def _pages(t, endpoint, schema=None):
    from pitwall.sources import landed as ld
    return ld.read_pages(t.spark, ld.landed_paths(t)[endpoint], schema or ld.PAGE_SCHEMA)


def _ld():
    from pitwall.sources import landed as ld
    return ld


_DRV_O = """cast(substr(driverId, 2) as int) as permanentNumber, cast(null as varchar) as driverCode,
  cast(null as varchar) as givenName, cast(null as varchar) as familyName"""


@query("flatten_races", """
select r.season, r.round, r.raceName, r.circuitId, c.circuitName, cast(null as varchar) as circuitLocality,
  c.circuitName as circuitCountry, make_date(r.season, r.round, 1) as date,
  case when r.round % 2 = 0 then '14:00:00Z' end as time
from races r left join circuits c on c.circuitId = r.circuitId""")
def q_flatten_races(t):
    return _ld().flatten_races(_pages(t, "races"))


@query("flatten_qualifying", f"""
select q.season, q.round, r.raceName, q.driverId, {_DRV_O}, q.constructorId,
  'Team ' || q.constructorId as constructorName, q.position,
  {_fmt_ms('q.q1')} as q1, {_fmt_ms('q.q2')} as q2, {_fmt_ms('q.q3')} as q3
from qualifying q join races r on r.season = q.season and r.round = q.round""")
def q_flatten_qualifying(t):
    return _ld().flatten_qualifying(_pages(t, "qualifying"))


@query("flatten_results", f"""
select x.season, x.round, r.raceName, x.driverId, {_DRV_O}, x.constructorId,
  'Team ' || x.constructorId as constructorName, cast(null as int) as carNumber, x.position,
  x.points, cast(null as int) as grid, x.laps,
  case when x.position = 'R' then 'Retired' else 'Finished' end as status
from race_results x join races r on r.season = x.season and r.round = x.round""")
def q_flatten_results(t):
    return _ld().flatten_results(_pages(t, "results"))


@query("flatten_laps", "select * from lap_times")
def q_flatten_laps(t):
    return _ld().flatten_laps(_pages(t, "laps"))


def _spoilt_laps(t):
    """Lap pages with broken copies among them, landed and judged."""
    from pitwall.session import scratch_path
    ld = _ld()
    path = scratch_path(t.spark, "spoilt")
    ld.spoilt(ld.read_lines(t.spark, ld.landed_paths(t)["laps"])).write.option("compression", "gzip").text(path)
    return ld.judged(ld.read_lines(t.spark, path))


@query("landed_rejects", """
with pages as (select distinct season, round, lap, (position - 1) // 100 as page from lap_times)
select reason, cast(count(*) as bigint) as pages from (
  select 'page' as reason from pages
  union all select 'malformed' from pages where lap % 10 = 0
  union all select 'no RaceTable' from pages where lap % 5 = 0 and lap % 10 <> 0) x group by reason""")
def q_landed_rejects(t):
    """Every landed line is a page or a reject with its reason."""
    return _spoilt_laps(t).groupBy(F.coalesce("reason", F.lit("page")).alias("reason")).agg(F.count(F.lit(1)).alias("pages"))


@query("quarantined_laps", "select * from lap_times")
def q_quarantined_laps(t):
    """S7 + S13: the laps of the whole pages among broken ones."""
    ld = _ld()
    return ld.flatten_laps(ld.good_pages(_spoilt_laps(t)))


@query("results_official_grid", f"""
select rr.season, rr.round, rr.driverId, q.position + case when q.position % 7 = 0 then 5 else 0 end as grid_official,
  cast(q.position as double) as grid, coalesce(try_cast(rr.position as double) in (1, 2, 3), false) as on_podium,
  {_fmt_ms('q.q3')} as qual_q3
from race_results rr left join qualifying q on q.season = rr.season and q.round = rr.round and q.driverId = rr.driverId""")
def q_results_official_grid(t):
    """A results table with a starting grid of its own (five places lost by every seventh qualifier)."""
    q = t.qualifying.select("season", "round", "driverId", F.col("position").cast("double").alias("grid"),
                            bt.fx.format_ms(F.col("q3")).alias("qual_q3"))
    penalty = F.when(F.col("position") % 7 == 0, 5).otherwise(0)
    official = t.qualifying.select("season", "round", "driverId", (F.col("position") + penalty).alias("grid"))
    results = jn.left_join(t.race_results, official, ["season", "round", "driverId"])
    return bt.joined_grid(results, q).select("season", "round", "driverId", "grid_official", "grid", "on_podium", "qual_q3")


@query("merge_pages", "select * from lap_times")
def q_merge_pages(t):
    ld = _ld()
    return ld.merge_pages(ld.flatten_laps(_pages(t, "laps_overlap")),
                          ["season", "round", "driverId", "lap"])


@query("flatten_pit_stops", """
select season, round, driverId, lap, stop, cast(null as varchar) as time, duration from pit_stops""")
def q_flatten_pit_stops(t):
    return _ld().flatten_pit_stops(_pages(t, "pit_stops"))


@query("flatten_driver_standings", f"""
select d.season, l.last_round as round, d.driverId, {_DRV_O}, cast(null as varchar) as constructorId,
  cast(null as varchar) as constructorName, d.position, d.points, d.wins
from driver_standings d join (select season, max(round) as last_round from races group by season) l
  on l.season = d.season""")
def q_flatten_driver_standings(t):
    return _ld().flatten_driver_standings(_pages(t, "driver_standings"))


@query("flatten_constructor_standings", """
select d.season, l.last_round as round, d.constructorId, 'Team ' || d.constructorId as constructorName,
  cast(null as varchar) as nationality, d.position, d.points, d.wins
from constructor_standings d join (select season, max(round) as last_round from races group by season) l
  on l.season = d.season""")
def q_flatten_constructor_standings(t):
    return _ld().flatten_constructor_standings(_pages(t, "constructor_standings"))


@query("flatten_circuits", """
select x.season, c.circuitId, c.circuitName, cast(null as varchar) as locality, c.circuitName as country,
  c.lat, c.long, cast(null as varchar) as url
from (select distinct season, circuitId from races) x join circuits c on c.circuitId = x.circuitId""")
def q_flatten_circuits(t):
    return _ld().flatten_circuits(_pages(t, "circuits"))


@query("flatten_seasons", "select distinct season from races")
def q_flatten_seasons(t):
    return _ld().flatten_seasons(_pages(t, "seasons"))


@query("flatten_weather", """
select c.lat, c.long, make_date(r.season, r.round, 1) as date, w.mean_temp, w.precipitation_sum,
  w.windspeed_mean
from races r join circuits c on c.circuitId = r.circuitId
join weather w on w.season = r.season and w.round = r.round""")
def q_flatten_weather(t):
    ld = _ld()
    return ld.flatten_weather(_pages(t, "weather", ld.WEATHER_SCHEMA))


@query("weather_for_races", """
select r.season, r.round, r.circuitId, w.mean_temp, w.precipitation_sum, w.windspeed_mean
from races r join circuits c on c.circuitId = r.circuitId
join weather w on w.season = r.season and w.round = r.round""")
def q_weather_for_races(t):
    ld = _ld()
    landed_races = ld.flatten_races(_pages(t, "races")).withColumn(
        "date", ld.race_date(F.col("season"), F.col("round")))
    weather = ld.flatten_weather(_pages(t, "weather", ld.WEATHER_SCHEMA))
    return ld.weather_for_races(landed_races.select("season", "round", "circuitId", "date"),
                                t.circuits, weather)


@query("clean_date", """
select season, round, make_date(season, round, 1) as date from races""")
def q_clean_date(t):
    ld = _ld()
    r = t.races.select("season", "round", ld.race_date(F.col("season"), F.col("round")).alias("txt"))
    return r.select("season", "round", ld.clean_date(F.col("txt")).alias("date"))


@query("incomplete_laps", """
select r.season, r.round, r.driverId, r.laps, coalesce(max(l.lap), 0) as landed_laps
from race_results r left join (select * from lap_times where round <> 3 and lap % 5 <> 0) l
  on l.season = r.season and l.round = r.round and l.driverId = r.driverId
group by r.season, r.round, r.driverId, r.laps having coalesce(max(l.lap), 0) < r.laps""")
def q_incomplete_laps(t):
    """D11 on lap times of which round 3 and every fifth lap have not landed."""
    landed = t.lap_times.filter((F.col("round") != 3) & (F.col("lap") % 5 != 0))
    return _ld().incomplete_laps(landed, t.race_results)


# Partitioned scans and sinks on the conformed store

def _located(t, name: str) -> tuple[str, str]:
    from pitwall.sources.conform import located
    return located(t.spark, t.sf_dir, name)


@query("scan_season", """
select 'race_results' as table_name, count(*) as row_count from race_results where season = 1997
union all select 'qualifying', count(*) from qualifying where season = 1997
union all select 'lap_times', count(*) from lap_times where season = 1997
union all select 'pit_stops', count(*) from pit_stops where season = 1997
union all select 'driver_standings', count(*) from driver_standings where season = 1997
union all select 'constructor_standings', count(*) from constructor_standings where season = 1997
union all select 'weather', count(*) from weather where season = 1997
union all select 'races', count(*) from races where season = 1997
union all select 'no_such_table', 0""")
def q_scan_season(t):
    """The nine tables of one season (partition-pruned); an absent table is empty."""
    from pitwall import schemas
    from pitwall.sources.tables import scan_table
    named = {n: scan_table(t.spark, *_located(t, n), schemas.CONFORMED[n], seasons=[1997])
             for n in ("race_results", "qualifying", "lap_times", "pit_stops", "driver_standings",
                       "constructor_standings", "weather", "races")}
    absent = scan_table(t.spark, _located(t, "races")[0], "no_such_table", schemas.CONFORMED["races"], seasons=[1997])
    return ag.table_counts({**named, "no_such_table": absent})


@query("scan_multi_season", "select * from race_results where season between 1995 and 1999")
def q_scan_multi_season(t):
    """One scan over a season list (partition filter), no per-season loop."""
    from pitwall import schemas
    from pitwall.sources.tables import scan_table
    return scan_table(t.spark, *_located(t, "race_results"), schemas.CONFORMED["race_results"],
                      seasons=TRAIN_SEASONS).select(*schemas.CONFORMED["race_results"].fieldNames())


@query("scan_projected", "select season, round, driverId, lap from pit_stops")
def q_scan_projected(t):
    """S3: a projected scan: only the listed columns are read."""
    from pitwall import schemas
    from pitwall.sources.tables import scan_table
    return scan_table(t.spark, *_located(t, "pit_stops"), schemas.CONFORMED["pit_stops"],
                      columns=["season", "round", "driverId", "lap"])


@query("sink_roundtrip", "select * from race_results")
def q_sink_roundtrip(t):
    """Write season-partitioned CSV with a header, read back with the declared schema."""
    from pitwall import schemas
    from pitwall.session import scratch_path
    from pitwall.sources.tables import scan_table, write_table
    root = scratch_path(t.spark, "sink")
    write_table(t.race_results, root, "race_results", fmt="csv")
    return scan_table(t.spark, root, "race_results", schemas.CONFORMED["race_results"],
                      fmt="csv").select(*schemas.CONFORMED["race_results"].fieldNames())


@query("incremental_seasons", "select * from race_results")
def q_incremental_seasons(t):
    """Land seasons up to 1998, let a writer die in 1999, then append what has not landed."""
    import os

    from pitwall import schemas
    from pitwall.session import scratch_path
    from pitwall.sources.tables import incremental_append, scan_table
    sch = schemas.CONFORMED["race_results"]
    root = scratch_path(t.spark, "incremental")
    incremental_append(t.spark, t.race_results.filter(F.col("season") <= 1998), root, "race_results", sch)
    half = t.race_results.filter((F.col("season") == 1999) & (F.col("round") <= 6)).drop("season")
    half.write.parquet(os.path.join(root, "race_results", "season=1999"))  # no marker
    incremental_append(t.spark, t.race_results, root, "race_results", sch)
    return scan_table(t.spark, root, "race_results", sch).select(*sch.fieldNames())




# --- E3-E5 with many classes; the pole as a choice (D9, D10) ----------------------------------

_POLE_SCORED_O = """
ps as (select p.season, p.round, p.driverId, p.driverId_code, coalesce(b.driverId_code, 0) as predicted_code
       from pole_features_o p left join pole_features_o b on b.season = p.season and b.round + 1 = p.round),
cl as (select distinct driverId_code as code, driverId as name from ps),
per as (
  select cl.code, cl.name, count_if(ps.driverId_code = cl.code) as support, count_if(ps.predicted_code = cl.code) as n_pred,
    count_if(ps.driverId_code = cl.code and ps.predicted_code = cl.code) as tp
  from cl cross join ps group by cl.code, cl.name),
pr as (select *, case when n_pred = 0 then 0e0 else tp * 1e0 / n_pred end as precision,
              case when support = 0 then 0e0 else tp * 1e0 / support end as recall from per),
pf as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0e0 end as f1 from pr)"""


def _pole_called(t):
    """Pole rows with a stand-in prediction: the pole sitter of the round before (else the first code)."""
    f = ft.pole_features(t).select("season", "round", "driverId", ft.POLE_Y)
    before = f.select("season", (F.col("round") + 1).alias("round"), F.col(ft.POLE_Y).alias("predicted_code"))
    return f.join(before, ["season", "round"], "left").withColumn("predicted_code", F.coalesce("predicted_code", F.lit(0)))


@query("pole_report", "with " + _POLE_SCORED_O + """
select name, precision, recall, cast(support as bigint) as support, f1 from pf
union all select 'macro avg', avg(precision), avg(recall), cast(sum(support) as bigint), avg(f1) from pf
union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  cast(sum(support) as bigint), sum(f1 * support) / sum(support) from pf""", OX)
def q_pole_report(t):
    """The many-class report by driver, names found by code."""
    df = _pole_called(t)
    names = df.select(F.col(ft.POLE_Y).alias("code"), F.col("driverId").alias("name")).distinct()
    return ev.named_report(df, ft.POLE_Y, "predicted_code", names)


@query("pole_confusion", "with " + _POLE_SCORED_O + """
, classes as (select driverId_code as c from ps union select predicted_code from ps)
select a.c as driverId_code, b.c as predicted_code,
  (select count(*) from ps where ps.driverId_code = a.c and ps.predicted_code = b.c) as n
from classes a cross join classes b""", OX)
def q_pole_confusion(t):
    """E3 over all pole sitters."""
    return ev.confusion_matrix(_pole_called(t), ft.POLE_Y, "predicted_code")


@query("pole_weighted_f1", "with " + _POLE_SCORED_O + """
select sum(f1 * support) / sum(support) as weighted_f1 from pf""", OX)
def q_pole_weighted_f1(t):
    """E5, the tuning score of the pole model, over all pole sitters."""
    return ev.weighted_f1(_pole_called(t), ft.POLE_Y, "predicted_code")


@query("ml_pole_report")
def q_ml_pole_report(t):
    """The pole forest's test report by driver, for every code its fitted features hold."""
    _, pred, features = _fit_predict(t, "pole", "pole_forest")
    names = features.decoder(pred, "driverId").select(F.col("code").cast("double").alias("code"), F.col("value").alias("name"))
    return ev.named_report(pred, "label", "prediction", names)


@query("pole_candidates", """
with form as (select season + 1 as season, driverId, sum(position) * 1e0 / count(*) as prev_season_qualifying,
                cast(count_if(position = 1) as bigint) as prev_season_poles from qualifying group by season, driverId)
select q.season, q.round, q.driverId, q.constructorId, q.position = 1 as is_pole,
  ds.points as driver_prev_season_points, ds.position as driver_prev_season_position, ds.wins as driver_prev_season_wins,
  cs.points as constructor_prev_season_points, cs.position as constructor_prev_season_position,
  cs.wins as constructor_prev_season_wins, f.prev_season_qualifying, f.prev_season_poles
from qualifying q
left join driver_standings ds on ds.driverId = q.driverId and ds.season + 1 = q.season
left join constructor_standings cs on cs.constructorId = q.constructorId and cs.season + 1 = q.season
left join form f on f.driverId = q.driverId and f.season = q.season""")
def q_pole_candidates(t):
    """All entrants of every race, by what is known before it."""
    from pitwall.plans.candidates import candidates
    return candidates(t)


@query("ml_pole_choice")
def q_ml_pole_choice(t):
    """One predicted pole per race of the test seasons, chosen among its entrants."""
    from pitwall.plans import candidates as cd
    md = _md()
    rows = md.cut_lineage(cd.candidates(t))
    choice = cd.fit(rows.filter(F.col("season").isin(md.TRAIN)))
    called = choice.poles(rows.filter(F.col("season").isin(md.TEST)))
    actual = rows.filter("is_pole").select("season", "round", F.col("driverId").alias("actual_driverId"))
    return called.join(actual, ["season", "round"], "left").select(
        "season", "round", F.col("driverId").alias("predicted_driverId"), "p", "actual_driverId",
        (F.col("driverId") == F.col("actual_driverId")).alias("hit"))


# --- M: Spark ML (rows-only checks) --------------------------------------------------------

def _md():
    from pitwall.plans import models as md
    return md


def _fit_predict(t, family: str, name: str):
    """A fitted model, its predictions on the test seasons, and the stage that made its features."""
    md = _md()
    data = md.prepared(t, family, weighted=family != "lap")
    rows = (data.train.count(),) if family in ("pole", "podium") else ()
    model = getattr(md, f"{family}_estimators")(data.cols, *rows)[name].fit(data.train)
    return model, model.transform(data.test), data.features


@query("ml_lap_linear")
def q_ml_lap_linear(t):
    _, pred, _ = _fit_predict(t, "lap", "lap_linear")
    return pred.select("season", "round", "driverId", "lap", "label", "prediction")


@query("ml_lap_forest")
def q_ml_lap_forest(t):
    _, pred, _ = _fit_predict(t, "lap", "lap_forest")
    return pred.select("season", "round", "driverId", "lap", "label", "prediction")


@query("ml_lap_gbt")
def q_ml_lap_gbt(t):
    _, pred, _ = _fit_predict(t, "lap", "lap_gbt")
    return pred.select("season", "round", "driverId", "lap", "label", "prediction")


@query("ml_model_comparison")
def q_ml_model_comparison(t):
    md = _md()
    train, test, cols = md.lap_sets(t)
    preds = {n: m.transform(test) for n, m in md.fit_all(md.lap_estimators(cols), train).items()}
    return md.model_comparison(preds)


def _podium_scored(t, name: str):
    md = _md()
    model, pred, features = _fit_predict(t, "podium", name)
    return model, md.with_probability(pred), features


@query("ml_podium_logistic")
def q_ml_podium_logistic(t):
    _, pred, _ = _podium_scored(t, "podium_logistic")
    return pred.select("season", "round", "driverId", "on_podium", "p", "predicted")


@query("ml_podium_forest")
def q_ml_podium_forest(t):
    pred = _md().podium_test_predictions(t)
    return pred.select("season", "round", "driverId", "on_podium", "p", "predicted")


@query("ml_pole_logistic")
def q_ml_pole_logistic(t):
    _, pred, features = _fit_predict(t, "pole", "pole_logistic")
    return _md().decode_pole(pred, features).select("season", "round", "driverId", "prediction",
                                            "predicted_driverId")


@query("ml_pole_forest")
def q_ml_pole_forest(t):
    _, pred, features = _fit_predict(t, "pole", "pole_forest")
    return _md().decode_pole(pred, features).select("season", "round", "driverId", "prediction",
                                            "predicted_driverId")


@query("ml_podium_evaluation")
def q_ml_podium_evaluation(t):
    """E2-E6 on the fitted forest's test predictions, one plan."""
    pred = _md().podium_test_predictions(t)
    acc = ev.accuracy(pred, "on_podium", "predicted").select(
        F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
    auc = ev.roc_auc(pred, "on_podium", "p").select(
        F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    rep = ev.classification_report(pred, "on_podium", "predicted").select(
        F.concat(F.lit("f1 "), F.col("class_label")).alias("metric"), F.col("f1").alias("value"))
    return acc.unionByName(auc).unionByName(rep)


@query("ml_season_validation")
def q_ml_season_validation(t):
    """R2 with model scores: per-race predicted vs actual podium on the test seasons."""
    pred = _md().podium_test_predictions(t)
    return ev.season_validation(pred)


@query("ml_race_prediction")
def q_ml_race_prediction(t):
    """R1 with the fitted forest: ranked candidates of the latest race of each test season."""
    pred = _md().podium_test_predictions(t)
    return rp.race_report(pred)


@query("ml_feature_importance")
def q_ml_feature_importance(t):
    md = _md()
    return md.feature_importance(md.trained_podium_model(t), t.spark)


@query("ml_pole_coefficients")
def q_ml_pole_coefficients(t):
    """M18 for the multinomial pole model: one row per class and feature."""
    model, _, _ = _fit_predict(t, "pole", "pole_logistic")
    return _md().feature_importance(model, t.spark)


@query("ml_pole_one_vs_rest")
def q_ml_pole_one_vs_rest(t):
    """M5 one-vs-rest with the L2 penalty of C = 1."""
    _, pred, features = _fit_predict(t, "pole", "pole_one_vs_rest")
    return _md().decode_pole(pred, features).select("season", "round", "driverId", "prediction", "predicted_driverId")


@query("nb_split_features", """
select *, case when substr(md5(concat_ws('_', raceId, driverId, lap)), 1, 2) < '33' then 'test' else 'train' end as split
from nb_lags_o""", OX)
def q_nb_split_features(t):
    """The rows the notebook's models learn from, with the 80/20 split."""
    from pitwall.operators.splits import hash_split
    return hash_split(nb.nb_lap_lags(t), ["raceId", "driverId", "lap"])


def _nb_predictions(t, name: str):
    md = _md()
    train, test, cols = md.nb_sets(t)
    return md.nb_estimators(cols)[name].fit(train).transform(test)


@query("ml_nb_linear")
def q_ml_nb_linear(t):
    return _nb_predictions(t, "nb_linear").select("raceId", "driverId", "label", "prediction")


@query("ml_nb_forest")
def q_ml_nb_forest(t):
    return _nb_predictions(t, "nb_forest").select("raceId", "driverId", "label", "prediction")


@query("ml_nb_gbt")
def q_ml_nb_gbt(t):
    return _nb_predictions(t, "nb_gbt").select("raceId", "driverId", "label", "prediction")


@query("ml_nb_comparison")
def q_ml_nb_comparison(t):
    """M19 on the notebook's features and split: test MSE and improvement over the linear model."""
    md = _md()
    train, test, cols = md.nb_sets(t)
    preds = {n: m.transform(test) for n, m in md.fit_all(md.nb_estimators(cols), train).items()}
    return md.model_comparison(preds, "nb_linear")


@query("ml_tune_podium_forest")
def q_ml_tune_podium_forest(t):
    md = _md()
    return md.tuning_table(md.tuned(t, "podium"), "podium_forest", t.spark)


@query("ml_tune_pole_forest")
def q_ml_tune_pole_forest(t):
    md = _md()
    return md.tuning_table(md.tuned(t, "pole"), "pole_forest", t.spark)


@query("ml_tune_lap_forest")
def q_ml_tune_lap_forest(t):
    md = _md()
    return md.tuning_table(md.tuned(t, "lap"), "lap_forest", t.spark)


@query("ml_model_save_load")
def q_ml_model_save_load(t):
    """S17 + S18: save two versions with their features, load the latest by name, score the test seasons."""
    from pitwall.plans.registry import ModelRegistry
    md = _md()
    model, _, features = _fit_predict(t, "podium", "podium_logistic")
    registry = ModelRegistry(t.spark)
    for _ in range(2):
        registry.save(md.complete(features, model), "podium_predictor")
    return md.score_podium(registry.latest("podium_predictor"), t, md.TEST).select("season", "round", "driverId", "p", "predicted")


_FIT = "season between 1995 and 1999"


def _fitted_codes(col: str) -> str:
    return (f"(select {col}, cast(dense_rank() over (order by {col}) - 1 as int) as code "
            f"from (select distinct {col} from podium_base_o where {_FIT} and {col} is not null) d)")


@query("podium_stored_features", f"""
with m as (
  select {', '.join(f'median({c}) as {c}' for c in ft.PODIUM_IMPUTE)} from podium_coded_o where {_FIT})
select b.season, b.round, b.raceName, b.driverId, b.constructorId, b.position,
  coalesce(cc.code, -1) as circuitId_code, coalesce(kc.code, -1) as constructorId_code,
  {', '.join(f'coalesce(cast(b.{c} as double), m.{c}) as {c}' for c in ft.PODIUM_IMPUTE)},
  b.qual_q1_ms, b.qual_q2_ms, b.qual_q3_ms, b.on_podium
from podium_coded_o b cross join m
left join {_fitted_codes('circuitId')} cc on cc.circuitId = b.circuitId
left join {_fitted_codes('constructorId')} kc on kc.constructorId = b.constructorId
where b.season in (2000, 2001)""", OX)
def q_podium_stored_features(t):
    """Features fitted on the training seasons, saved, loaded, and applied to the test seasons alone."""
    from pyspark.ml import PipelineModel

    from pitwall.plans.registry import ModelRegistry
    md, recipe = _md(), ft.RECIPES["podium"]
    rows = recipe.inputs(t)
    registry = ModelRegistry(t.spark)
    registry.save(PipelineModel(stages=[recipe.fitter().fit(rows.filter(F.col("season").isin(md.TRAIN)))]), "podium_features")
    return registry.latest("podium_features").transform(rows.filter(F.col("season").isin(md.TEST)))


@query("ml_quick_predict")
def q_ml_quick_predict(t):
    """S18 + R1: the latest stored model on the last race of the last season, from that race's rows alone."""
    md = _md()
    return rp.race_report(md.score_podium(md.trained_podium_model(t), t, md.TEST[-1:], latest_round=True))


@query("ml_lap_forest_module")
def q_ml_lap_forest_module(t):
    """M3: the module's lap forest, 100 trees on all features at depth 20."""
    md = _md()
    data = md.prepared(t, "lap")
    pred = md.module_lap_forest(data.cols).fit(md.in_tasks(data.train)).transform(data.test)
    return pred.select("season", "round", "driverId", "lap", "label", "prediction")


@query("ml_tune_podium_forest_module")
def q_ml_tune_podium_forest_module(t):
    """The podium module's 36 points."""
    md = _md()
    return md.tuning_table(md.tune_podium_forest(t, md.MODULE_CLASS_GRID), "podium_forest", t.spark)


@query("ml_tune_pole_forest_module")
def q_ml_tune_pole_forest_module(t):
    """The pole module's 36 points."""
    md = _md()
    return md.tuning_table(md.tune_pole_forest(t, md.MODULE_CLASS_GRID), "pole_forest", t.spark)


# --- streaming: incremental ingest of landed pages ------------------------------------

@query("stream_landed_laps", "select * from lap_times")
def q_stream_landed_laps(t):
    """S13/S15 as a file stream: overlapping lap pages -> one de-duplicated table."""
    from pitwall.session import scratch_path
    from pitwall.streaming.ingest import ingested_laps
    pages = _ld().landed_paths(t)["laps_overlap"]
    return ingested_laps(t.spark, pages, scratch_path(t.spark, "stream"))


@query("stream_rejects", """
with pages as (select distinct season, round, lap, (position - 1) // 100 as page from lap_times)
select reason, cast(count(*) as bigint) as pages from (
  select 'malformed' as reason from pages where lap % 10 = 0
  union all select 'no RaceTable' from pages where lap % 5 = 0 and lap % 10 <> 0) x group by reason""")
def q_stream_rejects(t):
    """S13 as a stream: broken pages go to a rejects table, batch by batch."""
    import os

    from pitwall.session import scratch_path
    from pitwall.streaming.ingest import ingested_laps, rejected
    ld = _ld()
    root = scratch_path(t.spark, "stream")
    pages = os.path.join(root, "pages")
    ld.spoilt(ld.read_lines(t.spark, ld.landed_paths(t)["laps"])).write.option("compression", "gzip").text(pages)
    ingested_laps(t.spark, pages, root)
    return rejected(t.spark, root).groupBy("reason").agg(F.count(F.lit(1)).alias("pages"))




# --- remaining section 2 keys -------------------------------------------------------------

@query("median_impute", """
select season, round, driverId,
  coalesce(grid, m.g) as grid,
  coalesce(driver_prev_season_points, m.dp) as driver_prev_season_points,
  coalesce(driver_prev_season_position, m.dpo) as driver_prev_season_position,
  coalesce(driver_prev_season_wins, m.dw) as driver_prev_season_wins,
  coalesce(constructor_prev_season_points, m.cp) as constructor_prev_season_points,
  coalesce(constructor_prev_season_position, m.cpo) as constructor_prev_season_position,
  coalesce(constructor_prev_season_wins, m.cw) as constructor_prev_season_wins,
  coalesce(mean_temp, m.mt) as mean_temp, coalesce(precipitation_sum, m.mp) as precipitation_sum,
  coalesce(windspeed_mean, m.mw) as windspeed_mean
from podium_base_o, (
  select median(grid) as g, median(driver_prev_season_points) as dp,
    median(driver_prev_season_position) as dpo, median(driver_prev_season_wins) as dw,
    median(constructor_prev_season_points) as cp, median(constructor_prev_season_position) as cpo,
    median(constructor_prev_season_wins) as cw, median(mean_temp) as mt,
    median(precipitation_sum) as mp, median(windspeed_mean) as mw from podium_base_o) m""", OX)
def q_median_impute(t):
    """Fit the medians (one row), fill NULLs with them."""
    b = bt.podium_base(t).select("season", "round", "driverId", *ft.PODIUM_IMPUTE)
    filled = ag.with_statistics(b, ag.fit_statistics(b, ft.PODIUM_IMPUTE, []))
    return filled.withColumns(ag.impute(ft.PODIUM_IMPUTE)).drop("medians", "codes")


@query("pole_label_decode", f"""
select p.season, p.round, p.driverId_code, c.driverId as decoded_driverId
from pole_features_o p left join {_codes('pole_base_o', 'driverId')} c on c.code = p.driverId_code""", OX)
def q_pole_label_decode(t):
    """Code -> driverId through the fitted code table (a join, not a driver-side map)."""
    f = ft.pole_features(t)
    codes = f.select(F.col(ft.POLE_Y).alias("code"), F.col("driverId").alias("decoded_driverId")) \
             .distinct()
    return f.select("season", "round", ft.POLE_Y).join(
        codes, F.col(ft.POLE_Y) == F.col("code"), "left").drop("code")


@query("feature_guard", """
select grid, circuitId, driver_prev_season_points, mean_temp from podium_base_o""", OX)
def q_feature_guard(t):
    """Keep only the wanted feature columns that exist (absent names are dropped)."""
    b = bt.podium_base(t)
    wanted = ["grid", "circuitId", "driver_prev_season_points", "mean_temp",
              "grid_official", "humidity"]
    return b.select(*ft.feature_guard(b, wanted))


@query("ml_training_summary")
def q_ml_training_summary(t):
    """The three tuned models: best parameters, as the models state them, and test metrics."""
    return _md().training_summary(t)


FLAGSHIP = "season_validation"
