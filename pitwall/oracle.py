"""Independent SQL (DuckDB dialect) for every SQL-expressible query.

The race-shaped views are spelled out once as CTE bodies; :func:`sql`
prepends only the views a statement uses (and what they depend on).  The
statements are written from the operator semantics, not generated from the
Spark plans, so a match is real evidence.
"""

from __future__ import annotations

import re

# Fixed view definitions (FIXTURES.md section C).
VIEW_SQL: dict[str, str] = {
    "laps": """
select cast(year(o.o_orderdate) as int) as season, cast(month(o.o_orderdate) as int) as round,
  concat('D', cast(l.l_suppkey as varchar)) as driverId,
  concat('C', cast(s.s_nationkey as varchar)) as constructorId,
  cast(row_number() over (partition by year(o.o_orderdate), month(o.o_orderdate), l.l_suppkey
    order by l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice,
             l.l_quantity, l.l_discount, l.l_tax) as int) as lap,
  cast(80000 + floor(l.l_extendedprice / 2) as bigint) as lap_ms,
  l.l_returnflag = 'R' as is_pit, l.l_quantity as qty, l.l_discount as disc, l.l_tax as tax
from lineitem l join orders o on l.l_orderkey = o.o_orderkey join supplier s on s.s_suppkey = l.l_suppkey""",
    "races": """
select season, round, concat('GP ', cast(season as varchar), '-', cast(round as varchar)) as raceName,
  concat('K', cast((season*12+round)%23 as varchar)) as circuitId
from (select distinct season, round from laps) x""",
    "lap_times": """
select season, round, driverId, lap,
  cast(rank() over (partition by season, round, lap order by lap_ms, driverId) as int) as position,
  concat(cast(cast(floor(lap_ms/60000) as int) as varchar), ':',
         lpad(cast(cast(floor((lap_ms%60000)/1000) as int) as varchar), 2, '0'), '.',
         lpad(cast(lap_ms%1000 as varchar), 3, '0')) as time
from laps""",
    "pit_stops": """
select season, round, driverId, lap,
  cast(row_number() over (partition by season, round, driverId order by lap) as int) as stop,
  cast(qty as varchar) as duration
from laps where is_pit""",
    "qualifying": """
select season, round, driverId, constructorId,
  cast(row_number() over (partition by season, round
    order by q3 nulls last, q2 nulls last, q1 nulls last, driverId) as int) as position, q1, q2, q3
from (select season, round, driverId, min(constructorId) as constructorId,
        min(case when disc <= 0.04 then lap_ms end) as q1,
        min(case when disc between 0.03 and 0.07 then lap_ms end) as q2,
        min(case when disc >= 0.06 then lap_ms end) as q3
      from laps group by season, round, driverId) x""",
    "race_results": """
select season, round, driverId, constructorId,
  case when n < 4 then 'R' else cast(pos as varchar) end as position,
  case when n < 4 then 0.0E0 when pos=1 then 25.0E0 when pos=2 then 18.0E0 when pos=3 then 15.0E0
       when pos <= 10 then cast(22-2*pos as double) else 0.0E0 end as points, n as laps
from (select season, round, driverId, min(constructorId) as constructorId, cast(count(*) as int) as n,
        cast(row_number() over (partition by season, round
          order by sum(lap_ms)/count(*), driverId) as int) as pos
      from laps group by season, round, driverId) x""",
    "driver_standings": """
select season, driverId, points, wins,
  cast(row_number() over (partition by season order by points desc, wins desc, driverId) as int) as position
from (select season, driverId, sum(points) as points,
        cast(sum(case when position='1' then 1 else 0 end) as int) as wins
      from race_results group by season, driverId) x""",
    "constructor_standings": """
select season, constructorId, points, wins,
  cast(row_number() over (partition by season order by points desc, wins desc, constructorId) as int) as position
from (select season, constructorId, sum(points) as points,
        cast(sum(case when position='1' then 1 else 0 end) as int) as wins
      from race_results group by season, constructorId) x""",
    # Same values as round(avg(qty),4), round(sum(tax),4), round(avg(disc)*100,4), but
    # in exact integer arithmetic (half up): parallel double sums are order-dependent
    # when a value sits on a rounding tie.
    "weather": """
select season, round,
  cast((2 * sum(cast(qty as bigint)) * 10000 + count(*)) // (2 * count(*)) as double) / 10000 as mean_temp,
  cast(sum(cast(round(tax * 100) as bigint)) as double) / 100 as precipitation_sum,
  cast((2 * sum(cast(round(disc * 100) as bigint)) * 10000 + count(*)) // (2 * count(*)) as double) / 10000
    as windspeed_mean
from laps where round <> 7 group by season, round""",
    "circuits": """
select concat('K', cast(n_nationkey as varchar)) as circuitId, n_name as circuitName,
  n_nationkey*3.5E0-40 as lat, n_nationkey*7.25E0-80 as long
from nation where n_nationkey < 23""",
}

VIEW_ORDER = list(VIEW_SQL)


def _uses(text: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None


def sql(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it (transitively) references, dependencies first.

    ``extra`` adds statement-specific CTEs.  A body that starts with its own
    ``with`` clause is merged into the same clause.
    """
    defs = dict(VIEW_SQL)
    if extra:
        defs.update(extra)
    names = list(defs)
    ordered: list[str] = []
    visiting: set[str] = set()

    def visit(text: str):
        for name in names:
            if name in ordered or name in visiting or not _uses(text, name):
                continue
            visiting.add(name)
            visit(defs[name])
            visiting.discard(name)
            ordered.append(name)

    visit(body)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} as ({defs[n]}\n)" for n in ordered)
    stripped = body.lstrip()
    if stripped[:4].lower() == "with" and stripped[4:5].isspace():
        return "with " + ctes + ",\n" + stripped[5:]
    return "with " + ctes + "\n" + body
