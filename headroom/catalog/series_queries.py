"""Grids, fills, slices and positions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from headroom.catalog import views as v
from headroom.catalog.views import oracle
from headroom.operators import quantiles as q
from headroom.operators import series as s
from headroom.operators.filters import slice_time_of_day

NTZ = "timestamp_ntz"
DAY0, DAY1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def resample_ffill(spark, sf):
    return s.resample_ffill(v.imbalance(spark, sf), "PT15M", "quantity", "region").withColumn("quantity", F.round("quantity", 6))


def resample_mean(spark, sf):
    return s.resample_mean(v.imbalance(spark, sf), "PT1H", "quantity", "region").withColumn("quantity", F.round("quantity", 6))


def fill_missing(spark, sf):
    cells = s.resample_mean(v.imbalance(spark, sf), "PT15M", "quantity", "region")
    forward = s.fill_missing(cells, "quantity", "region", method="ffill").withColumnRenamed("quantity", "forward")
    backward = s.fill_missing(cells, "quantity", "region", method="bfill").withColumnRenamed("quantity", "backward")
    return forward.join(backward, ["region", "valid_from", "valid_to"]).select(
        "region", "valid_from", "valid_to", F.round("forward", 6).alias("forward"), F.round("backward", 6).alias("backward")
    )


def min_resolution(spark, sf):
    imbalance = v.imbalance(spark, sf)
    both = s.min_resolution(imbalance, "valid_from", "valid_to").withColumn("source", F.lit("interval"))
    return both.unionByName(s.min_resolution(v.steps(spark, sf)).withColumn("source", F.lit("gap")))


def align_resolutions(spark, sf):
    hourly = s.resample_mean(v.imbalance(spark, sf), "PT1H", "quantity", "region").where("quantity is not null")
    fine, coarse = s.align_resolutions([v.imbalance(spark, sf), hourly], "quantity", "region")
    return fine.withColumn("source", F.lit("fine")).unionByName(coarse.withColumn("source", F.lit("coarse"))).withColumn(
        "quantity", F.round("quantity", 6)
    )


WINDOW = (datetime(1996, 1, 3), datetime(1997, 6, 20))


def fill_steps(spark, sf):
    """Whole series, and the same within a query window, where a series may have no row left."""
    whole = s.fill_steps(v.steps(spark, sf), ["series_id", "type"]).withColumn("part", F.lit("whole"))
    window = s.fill_steps(v.steps(spark, sf), ["series_id", "type"], start=WINDOW[0], end=WINDOW[1]).withColumn("part", F.lit("window"))
    return whole.unionByName(window).select("part", "series_id", "type", "series_from", "series_to", "valid_from", "valid_to", "resolution", "position", "quantity")


def double_weight(spark, sf):
    bids = v.bids(spark, sf).select("id", "valid_from", "quantity")
    return s.double_weight(bids, datetime(2024, 1, 31), "P10D").groupBy("valid_from").agg(
        F.count("*").alias("n"), F.round(F.sum("quantity"), 4).alias("quantity")
    )


def time_slices(spark, sf):
    slices = s.time_slices(spark, DAY0 - timedelta(hours=1), DAY1 - timedelta(hours=1), 6, zone="CET")
    counts = v.bids(spark, sf).select("valid_from")
    tagged = slice_time_of_day(counts.withColumnRenamed("valid_from", "t"), slices, "t")
    joined = tagged.join(slices, "position")
    return joined.groupBy("position", "valid_from", "valid_to", "start_time", "end_time", "number_of_points").agg(F.count("*").alias("n"))


def position_times(spark, sf):
    points = v.steps(spark, sf).drop("valid_from", "valid_to")
    return s.position_times(points).select("series_id", "position", "valid_from", "valid_to")


def series_bounds(spark, sf):
    points = v.steps(spark, sf).select("series_id", "position", "valid_from", "valid_to", "resolution", F.lit(7).alias("number_of_points"))
    return s.series_bounds(points).select("series_id", "position", "series_from", "series_to", "number_of_points")


def refine_points(spark, sf):
    receivers = v.areas(spark, sf).selectExpr(
        "cast(id % 5 as int) receiver", "case when id % 5 = 0 then 'PT12H' when id % 5 = 1 then 'PT8H' when id % 5 = 2 then 'P2D' end output_resolution"
    ).distinct()
    points = v.steps(spark, sf).selectExpr("series_id", "cast(series_id % 5 as int) receiver", "position", "resolution", "quantity")
    return s.refine_points(points, receivers)


def period_bounds(spark, sf):
    orders = v.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderdate now", "'-P3D' valid_offset", "'-P2D' valid_delta",
        "case when o_orderkey % 2 = 0 then 'P4D' end shift", "cast(null as string) data_offset", "'P60D' data_delta",
    )
    return s.period_bounds(orders).select("o_orderkey", "valid_from", "valid_to", "data_from", "data_to")


def point_resolution(spark, sf):
    series = v.steps(spark, sf).groupBy("series_id", "series_from", "series_to").agg(F.count("*").cast("int").alias("number_of_points"))
    return s.point_resolution(series).select("series_id", "number_of_points", "point_resolution")


def quantile_spacing(spark, sf):
    table = q.quantile_spacing(spark, [(95, 100, 0.1), (90, 100, 1)])
    sizes = v.bids(spark, sf).groupBy("product").agg(F.count("quantity").alias("n"))
    ticks = F.array(*[F.lit(t) for t in sorted({*q.spacing_ticks(95, 100, 0.1), *q.spacing_ticks(90, 100, 1)})])
    return sizes.withColumn("tick", F.explode(ticks)).join(table, "tick").selectExpr(
        "product", "spacing_start", "spacing_step", "probability", "percentage_level", "(cast(tick as bigint)*(n-1)) div 10000 rank"
    )


def quantile_lower(spark, sf):
    ticks = list(range(0, 501, 10))
    shifted = v.bids(spark, sf).withColumn("quantity", F.col("quantity") - 2)
    return q.quantile_lower(shifted, "quantity", ticks, ["area", "product", "direction"]).drop("tick").withColumn("value", F.round("value", 6))


def quantile_linear(spark, sf):
    return q.quantile_linear(v.imbalance(spark, sf), "quantity", [0.005, 0.1, 0.2, 0.5, 0.8, 0.9, 0.995], "region").withColumn(
        "value", F.round("value", 6)
    )


def sliced_quantiles(spark, sf):
    slices = s.time_slices(spark, DAY0 - timedelta(hours=1), DAY1 - timedelta(hours=1), 6, zone="CET")
    found = q.sliced_quantiles(v.bids(spark, sf), "quantity", slices, [(95, 100, 0.5), (90, 100, 1)], ["area", "product"])
    return found.select(
        "position", "start_time", "end_time", "spacing_start", "spacing_step", "area", "product", "percentage_level", F.round("value", 6).alias("value")
    )


def sort_levels(spark, sf):
    levels = q.quantile_lower(v.bids(spark, sf), "quantity", list(range(0, 501, 100)), ["area"])
    return q.sort_levels(levels, ["area"]).select("area", "percentage_level", F.round("value", 6).alias("value"))


QUERIES = {f.__name__: f for f in (
    resample_ffill, resample_mean, fill_missing, min_resolution, align_resolutions, fill_steps, double_weight, time_slices,
    position_times, series_bounds, refine_points, period_bounds, point_resolution, quantile_spacing, quantile_lower,
    quantile_linear, sliced_quantiles, sort_levels,
)}

GRID = """, span as (select region, min(valid_from) lo, max(valid_from) hi from imbalance group by 1),
 grid as (select region, unnest(generate_series(lo, hi, interval 15 minutes)) valid_from from span)"""

SLICES = """, slice(position, start_time, end_time) as (values (1,'00:00:00','03:59:59'),(2,'04:00:00','07:59:59'),(3,'08:00:00','11:59:59'),
 (4,'12:00:00','15:59:59'),(5,'16:00:00','19:59:59'),(6,'20:00:00','23:59:59'))"""

ORACLE = {
    "resample_ffill": oracle("imbalance", GRID + """
select g.region, g.valid_from, g.valid_from + interval 15 minutes valid_to,
 round(last_value(quantity ignore nulls) over (partition by g.region order by g.valid_from rows unbounded preceding), 6) quantity
from grid g left join imbalance i on i.region=g.region and i.valid_from=g.valid_from"""),
    "resample_mean": oracle("imbalance", """, b as (select region, time_bucket(interval 1 hour, valid_from) valid_from, avg(quantity) quantity from imbalance group by 1,2),
 span as (select region, min(valid_from) lo, max(valid_from) hi from b group by 1),
 grid as (select region, unnest(generate_series(lo, hi, interval 1 hour)) valid_from from span)
select g.region, g.valid_from, g.valid_from + interval 1 hour valid_to, round(quantity, 6) quantity from grid g left join b using (region, valid_from)"""),
    "fill_missing": oracle("imbalance", GRID + """
select g.region, g.valid_from, g.valid_from + interval 15 minutes valid_to,
 round(last_value(quantity ignore nulls) over (partition by g.region order by g.valid_from rows unbounded preceding), 6) forward,
 round(first_value(quantity ignore nulls) over (partition by g.region order by g.valid_from rows between current row and unbounded following), 6) backward
from grid g left join imbalance i on i.region=g.region and i.valid_from=g.valid_from"""),
    "min_resolution": oracle("imbalance steps", """
select 'interval' source, min(epoch(valid_to)-epoch(valid_from))::bigint resolution from imbalance
union all select 'gap', min(gap)::bigint from (select epoch(valid_from)-lag(epoch(valid_from)) over (order by valid_from) gap from (select distinct valid_from from steps))"""),
    "align_resolutions": oracle("imbalance", """, hourly as (select region, time_bucket(interval 1 hour, valid_from) valid_from, avg(quantity) quantity from imbalance group by 1,2),
 tf as (select distinct valid_from from imbalance), th as (select distinct valid_from from hourly),
 gf as (select unnest(generate_series(min(valid_from), max(valid_from), interval 15 minutes)) g from tf),
 gh as (select unnest(generate_series(min(valid_from), max(valid_from) + interval 45 minutes, interval 15 minutes)) g from th),
 af as (select g, (select max(valid_from) from tf where valid_from<=g) t from gf),
 ah as (select g, (select max(valid_from) from th where valid_from<=g) t from gh)
select 'fine' source, g valid_from, g + interval 15 minutes valid_to, region, round(quantity,6) quantity from af join imbalance on valid_from=t
union all select 'coarse', g, g + interval 15 minutes, region, round(quantity,6) from ah join hourly on valid_from=t"""),
    "fill_steps": oracle("steps", f""", s as (select distinct series_id, "type", series_from, series_to from steps),
 g as (select 'whole' part, *, unnest(generate_series(series_from, series_to - interval 1 day, interval 1 day)) valid_from from s
  union all select 'window', *, unnest(generate_series(greatest(series_from, timestamp '{WINDOW[0]}'), least(series_to, timestamp '{WINDOW[1]}') - interval 1 day, interval 1 day)) from s)
select part, g.series_id, g."type", g.series_from, g.series_to, g.valid_from, g.valid_from + interval 1 day valid_to,
 last_value(resolution ignore nulls) over w resolution, last_value("position" ignore nulls) over w "position", last_value(quantity ignore nulls) over w quantity
from g left join steps t on t.series_id=g.series_id and t.valid_from=g.valid_from
window w as (partition by part, g.series_id order by g.valid_from rows unbounded preceding)"""),
    "double_weight": oracle("bids", """
select valid_from, sum(case when valid_from between timestamp '2024-01-21' and timestamp '2024-01-31' then 2 else 1 end)::bigint n,
 round(sum(quantity*case when valid_from between timestamp '2024-01-21' and timestamp '2024-01-31' then 2 else 1 end),4) quantity from bids group by 1"""),
    "time_slices": oracle("bids", SLICES + """
select "position", timestamp '2023-12-31 23:00:00' + ("position"-1)*interval 4 hours valid_from, timestamp '2023-12-31 23:00:00' + "position"*interval 4 hours valid_to,
 start_time, end_time, 6 number_of_points, count(*) n from (select valid_from t from bids) join slice
 on strftime(timezone('CET', timezone('UTC', t)),'%H:%M:%S') between start_time and end_time group by all"""),
    "position_times": oracle("steps", """select series_id, "position", valid_from, valid_to from steps"""),
    "series_bounds": oracle("steps", """select series_id, "position", series_from, series_to, 7 number_of_points from steps"""),
    "refine_points": oracle("steps", """, k as (select *, case series_id%5 when 0 then 2 when 1 then 3 else 1 end n from steps)
select series_id, cast(series_id%5 as int) receiver, cast(("position"-1)*n + i as int) "position",
 case n when 2 then 'PT12H' when 3 then 'PT8H' else resolution end resolution, quantity
from k, lateral (select unnest(generate_series(1, n)) i)"""),
    "period_bounds": """select o_orderkey, o_orderdate + interval 3 days valid_from, o_orderdate + interval 5 days valid_to,
 case when o_orderkey%2=0 then o_orderdate + interval 1 day else o_orderdate end - interval 60 days data_from,
 case when o_orderkey%2=0 then o_orderdate + interval 1 day else o_orderdate end data_to from orders""",
    "point_resolution": oracle("steps", """, c as (select series_id, count(*)::int n from steps group by 1),
 d as (select *, 604800//n t from c)
select series_id, n number_of_points, 'P' || case when t//86400>0 then (t//86400) || 'D' else '' end
 || case when t%86400>0 then 'T' || case when t%86400//3600>0 then (t%86400//3600) || 'H' else '' end
 || case when t%3600//60>0 then (t%3600//60) || 'M' else '' end || case when t%60>0 then (t%60) || 'S' else '' end else '' end point_resolution from d"""),
    "quantile_spacing": oracle("bids", """, n as (select product, count(quantity) n from bids group by 1),
 s as (select 95.0::double spacing_start, 0.1::double spacing_step, unnest(generate_series(0,500,10)) tick
  union all select 90.0::double, 1.0::double, unnest(generate_series(0,1000,100)))
select product, spacing_start, spacing_step, tick/10000.0::double probability, round(100.0-tick/100.0,2)::double percentage_level, (tick*(n-1))//10000 rank from n, s"""),
    "quantile_lower": oracle("bids", """, r as (select area, product, direction, quantity-2 quantity,
  row_number() over (partition by area,product,direction order by quantity)-1 rn, count(*) over (partition by area,product,direction) n from bids),
 p as (select unnest(generate_series(0,500,10)) tick)
select area, product, direction, round(100.0-tick/100.0,2)::double percentage_level, round(greatest(quantity,0.0),6) "value"
from r join p on rn = (tick*(n-1))//10000"""),
    "quantile_linear": oracle("imbalance", """, p as (select region, unnest([0.005,0.1,0.2,0.5,0.8,0.9,0.995]::double[]) probability,
 unnest(quantile_cont(quantity,[0.005,0.1,0.2,0.5,0.8,0.9,0.995])) v from imbalance group by 1)
select region, probability, round(v,6) "value" from p"""),
    "sliced_quantiles": oracle("bids", SLICES + """, t as (select area, product, quantity, sl.* from bids join slice sl
  on strftime(timezone('CET', timezone('UTC', valid_from)),'%H:%M:%S') between start_time and end_time),
 r as (select *, row_number() over (partition by "position",area,product order by quantity)-1 rn, count(*) over (partition by "position",area,product) n from t),
 p as (select 95.0::double spacing_start, 0.5::double spacing_step, unnest(generate_series(0,500,50)) tick
  union all select 90.0::double, 1.0::double, unnest(generate_series(0,1000,100)))
select "position", start_time, end_time, spacing_start, spacing_step, area, product, round(100.0-tick/100.0,2)::double percentage_level, round(quantity,6) "value"
from r join p on rn = (tick*(n-1))//10000"""),
    "sort_levels": oracle("bids", """, r as (select area, quantity, row_number() over (partition by area order by quantity)-1 rn, count(*) over (partition by area) n from bids),
 p as (select unnest(generate_series(0,500,100)) tick)
select area, round(100.0-tick/100.0,2)::double percentage_level, round(quantity,6) "value" from r join p on rn = (tick*(n-1))//10000"""),
}
