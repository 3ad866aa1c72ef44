"""Realised against proposed, versions, reports, result points, merges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from headroom.catalog import views as v
from headroom.catalog.views import oracle
from headroom.scale import literal_table
from headroom.operators import exceedance as x
from headroom.operators import filters as f
from headroom.operators import merge as m
from headroom.operators import results as r
from headroom.operators.quantiles import quantile_lower

KEYS = ["area", "direction"]


def _joined(spark, sf):
    """Realised rows of every sender beside the newest proposed value; scaled so that some products exceed."""
    proposed = v.proposed(spark, sf).withColumn("value", F.col("value") / 8)
    return x.join_realised_proposed(proposed, v.realised(spark, sf), KEYS, tie="value")


def join_realised_proposed(spark, sf):
    joined = x.join_realised_proposed(v.proposed(spark, sf), v.realised(spark, sf), KEYS, tie="value")
    return joined.withColumns({n: F.round(n, 6) for n in ("proposed", "realised")})


def exceeded_proportion(spark, sf):
    joined = _joined(spark, sf)
    common = x.exceeded_proportion(joined, KEYS).withColumn("mode", F.lit("common"))
    own = x.exceeded_proportion(joined, KEYS, correct_initial=True, report_diff=True, strategy="min").withColumn("mode", F.lit("own"))
    return common.unionByName(own).withColumns({n: F.round(n, 7 if n == "proposed" else 6) for n in ("proposed", "realised", "norm", "exceeded", "value")})


def exceeded_cascade(spark, sf):
    return x.exceeded_cascade(_joined(spark, sf), KEYS).withColumns({n: F.round(n, 7 if n == "proposed" else 6) for n in ("proposed", "realised", "exceeded", "value")})


def unified_level(spark, sf):
    proposed = v.proposed(spark, sf)
    parts = [x.unified_level(proposed, "level", s, KEYS).withColumn("strategy", F.lit(s)) for s in ("min", "median", "max")]
    return m.union_all([p.withColumn("level", F.col("level").cast("double")) for p in parts])


def next_version(spark, sf):
    new = v.realised(spark, sf).select(*KEYS, "level", "sender", "value")
    stored = v.proposed(spark, sf).withColumn("level", F.col("level") + 2)  # so some new rows have nothing stored
    return x.next_version(new, [*KEYS, "level"], stored)


def split_by_receiver(spark, sf):
    rows = v.realised(spark, sf).withColumnRenamed("sender", "receiver")
    known = literal_table(spark, [(0,), (2,), (9,)], "receiver int")
    return x.split_by_receiver(rows, known, KEYS, ["received", "level"]).select("receiver", *KEYS, "level", "value")


def proposed_vs_realised_report(spark, sf):
    latest = f.latest_version(v.proposed(spark, sf), fixed_cols=[*KEYS, "level"])
    realised = v.realised(spark, sf).withColumnRenamed("sender", "operator")
    return r.proposed_vs_realised_report(latest.withColumn("level", F.col("level") + 2), realised, KEYS, "level")


def points_from_quantiles(spark, sf):
    levels = quantile_lower(v.bids(spark, sf), "quantity", [0, 100, 200, 300, 400, 500], ["area", "product", "direction"]).withColumns({
        "position": F.lit(1), "valid_from": F.lit(datetime(2024, 2, 1)), "valid_to": F.lit(datetime(2024, 2, 2)), "point_resolution": F.lit("P1D"),
        "number_of_points": F.lit(1), "spacing_start": F.lit(95.0), "spacing_step": F.lit(1.0), "spacing_stop": F.lit(100.0),
    })
    areas = v.areas(spark, sf).select(F.expr("case id when 0 then 'North' when 1 then 'Mid' else concat('x', id) end").alias("name"), F.col("code").alias("mrid"))
    points = r.points_from_quantiles(levels, {"version": 3, "sender": "RCC", "block": "Block", "data_from": "2024-01-01", "data_to": "2024-01-31", "calculation_date": "2024-01-31"}, areas)
    return points.select(
        "result_type", "message_type", "process_type", "business_type", "version_number", F.col("domain.name").alias("domain"), F.col("domain.mrid").alias("mrid"),
        F.col("direction.code").alias("direction"), F.col("type.name").alias("product"), F.col("percentage_level.value").alias("level"),
        F.round("available.value", 6).alias("value"), F.col("available.measurement_unit").alias("unit"), F.col("quantile_spacing.step_percentage").alias("step"),
    )


def series_from_points(spark, sf):
    series = r.series_from_points(v.steps(spark, sf), ["type", "series_id"], ["type"])
    return series.select(
        "document_key", "series_key", F.size("points").alias("n"), F.col("points")[0]["position"].alias("first_position"),
        F.aggregate("points", F.lit(0.0), lambda a, p: a + p["quantity"]).alias("quantity"),
    )


def group_quantile_tables(spark, sf):
    return r.group_quantile_tables(v.proposed(spark, sf), ["version_number"], "level", KEYS, ["A_F", "N_O", "R_F"])


def result_headers(spark, sf):
    points = v.realised(spark, sf).withColumns({"version_number": F.col("level"), "unit": F.lit("MAW"), "part": F.col("direction")})
    return r.result_headers(points.withColumn("until", F.col("received")), ["area", "sender"], "received", "until", "version_number", ["unit", "part"])


def sort_report(spark, sf):
    return r.sort_report(v.realised(spark, sf), ["received", "sender", "level"]).select("received", "sender", "level", "value")


def latest_per_sender(spark, sf):
    return f.latest_per_sender(v.realised(spark, sf), "sender", "received", ["area", "direction", "level"]).select("sender", "received", "area", "direction", "level", "value")


def union_all(spark, sf):
    return m.union_all([v.proposed(spark, sf), v.realised(spark, sf)])


def distinct_rows(spark, sf):
    return m.distinct_rows(v.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"
    )


def append_missing(spark, sf):
    old = v.realised(spark, sf).select(*KEYS, "level", "sender", "value")
    new = v.proposed(spark, sf).select(*KEYS, (F.col("level") - 2).alias("level"), F.col("version_number").cast("int").alias("sender"), "value")
    return m.append_missing(old, new, [*KEYS, "level", "sender"])


def update_by_key(spark, sf):
    old = v.realised(spark, sf).select(*KEYS, "level", "sender", "value", "received")
    new = v.proposed(spark, sf).select(
        *KEYS, (F.col("level") - 2).alias("level"), F.col("version_number").cast("int").alias("sender"), F.when(F.col("level") != 98, F.col("value")).alias("value")
    )
    return m.update_by_key(old, new, [*KEYS, "level", "sender"])


QUERIES = {q.__name__: q for q in (
    join_realised_proposed, exceeded_proportion, exceeded_cascade, unified_level, next_version, split_by_receiver, proposed_vs_realised_report,
    points_from_quantiles, series_from_points, group_quantile_tables, result_headers, sort_report, latest_per_sender, union_all, distinct_rows,
    append_missing, update_by_key,
)}

_NEWEST = """, pl as (select * from (select *, max(cast(version_number as int)) over (partition by area,direction,"level") mv from proposed) where cast(version_number as int)=mv),
 rn as (select * from (select *, row_number() over (partition by area,direction,"level",sender order by received desc, "value" desc) k from realised) where k=1)"""
_JOINED = _NEWEST + """,
 j as (select p.area, p.direction, p."level", p.version_number, sender, p."value"/8 proposed, r."value" realised from pl p join rn r on p.area=r.area and p.direction=r.direction and p."level"=r."level")"""

# one step per level, from the highest down
CASCADE = _JOINED + """ /*recursive*/,
 l as (select *, row_number() over (partition by area,direction order by "level" desc) k from (select area, direction, "level", sum(realised) used, min(proposed) prop from j group by all)),
 d as (select area, direction, "level", k, used, greatest(least(prop,used),0) al, greatest(least(prop,used),0) run from l where k=1
  union all select l.area, l.direction, l."level", l.k, l.used, greatest(least(l.prop-d.run,l.used),0), d.run+greatest(least(l.prop-d.run,l.used),0)
  from d join l on l.area=d.area and l.direction=d.direction and l.k=d.k+1),
 x as (select j.*, used, al, case when used>proposed then realised end er, case when used>proposed then proposed end ep from j join d using (area,direction,"level")),
 t as (select *, sum(er) over (partition by area,direction) zr, sum(ep) over (partition by area,direction) zp from x)"""

ORACLE = {
    "join_realised_proposed": oracle("proposed realised", _NEWEST + """
select p.area, p.direction, p."level", version_number, sender, round(p."value",6) proposed, round(r."value",6) realised from pl p join rn r on p.area=r.area and p.direction=r.direction and p."level"=r."level\""""),
    "exceeded_proportion": oracle("proposed realised", _JOINED + """, n as (select *, realised/proposed norm, sum(realised/proposed) over (partition by area,direction) s,
  max("level") over (partition by area,direction) lx, max_by(proposed,"level") over (partition by area,direction) px from j)
select 'common' "mode", area, direction, lx "level", version_number, sender, round(proposed,7) proposed, round(realised,6) realised, round(norm/s,6) norm,
 round(norm/s*px,6) exceeded, round(norm/s*px,6) "value" from n where s>1
union all select 'own', area, direction, "level", version_number, sender, round(proposed,7), round(realised,6), round(norm/s,6), round(norm/s*proposed,6), round(-(realised-norm/s*proposed),6) from n where s>1"""),
    "exceeded_cascade": oracle("proposed realised", CASCADE + """
select area, direction, "level", version_number, sender, round(proposed,7) proposed, round(realised,6) realised, round(realised/used*al,6) exceeded, round(realised/used*al,6) "value"
from t where zr>zp and abs(realised/used*al-realised)>1e-9"""),
    "unified_level": oracle("proposed", """select area, direction, min("level")::double "level", 'min' strategy from proposed group by all
union all select area, direction, median("level")::double, 'median' from proposed group by all union all select area, direction, max("level")::double, 'max' from proposed group by all"""),
    "next_version": oracle("proposed realised", """select r.area, r.direction, r."level", sender, r."value", cast((select case when count(*)=0 then 1 else greatest(max(cast(version_number as int)),1)+1 end from proposed p
 where p.area=r.area and p.direction=r.direction and p."level"+2=r."level") as int) version_number from realised r"""),
    "split_by_receiver": oracle("realised", """select sender receiver, area, direction, "level", round("value",1) "value" from
 (select *, row_number() over (partition by sender, area, direction order by received desc, "level" desc) k from realised where sender in (0,2)) where k=1"""),
    "proposed_vs_realised_report": oracle("proposed realised", _NEWEST + """
select r.area, r.direction, r."level", r.sender operator, r."value" realised, p."value" proposed from realised r left join pl p on p.area=r.area and p.direction=r.direction and p."level"+2=r."level\""""),
    "points_from_quantiles": oracle("bids", """, r as (select area, product, direction, quantity, row_number() over w-1 rn, count(*) over (partition by area,product,direction) n from bids window w as (partition by area,product,direction order by quantity)),
 p as (select unnest(generate_series(0,500,100)) tick)
select 'NCPB' result_type, 'A24' message_type, 'A14' process_type, case product when 'aFRR' then 'A96' end business_type, '3' version_number,
 case when area<>'South' then area end "domain", case area when 'North' then 'N0' when 'Mid' then 'N1' end mrid, case direction when 'UP' then 'A01' else 'A02' end direction, product,
 round(100-tick/100,2)::double "level", round(quantity,6) "value", 'MAW' unit, 1.0::double step from r join p on rn=(tick*(n-1))//10000"""),
    "series_from_points": oracle("steps", """select replace("type",' ','_') document_key, replace("type",' ','_') || '_' || series_id series_key, count(*)::int n, min("position") first_position, sum(quantity) quantity from steps group by "type", series_id"""),
    "group_quantile_tables": oracle("proposed", """select version_number, "level", min("value") filter (area='A' and direction='F') "A_F", min("value") filter (area='N' and direction='O') "N_O",
 min("value") filter (area='R' and direction='F') "R_F" from proposed group by all"""),
    "result_headers": oracle("realised", """select area, sender, min(received) received, max(received) "until", max("level")::bigint version_number, 'MAW' unit,
 case when min(direction)=max(direction) then min(direction) end part from realised group by all"""),
    "sort_report": oracle("realised", """select received, sender, "level", "value" from realised"""),
    "latest_per_sender": oracle("realised", """select sender, received, area, direction, "level", "value" from
 (select *, row_number() over (partition by sender order by received desc, area desc, direction desc, "level" desc) k from realised) where k=1"""),
    "union_all": oracle("proposed realised", """select area, direction, "level", version_number, "value", null::int sender, null::timestamp received from proposed
union all select area, direction, "level", null, "value", sender, received from realised"""),
    "distinct_rows": """select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_extendedprice) k from lineitem) where k=1""",
    "append_missing": oracle("proposed realised", """, o as (select area, direction, "level", sender, "value" from realised)
select * from o union all select area, direction, "level"-2, cast(version_number as int), "value" from proposed p
where not exists (select 1 from o where o.area=p.area and o.direction=p.direction and o."level"=p."level"-2 and o.sender=cast(p.version_number as int))"""),
    "update_by_key": oracle("proposed realised", """, o as (select area, direction, "level", sender, "value", received from realised),
 n as (select area, direction, "level"-2 "level", cast(version_number as int) sender, case when "level"<>98 then "value" end nv from proposed)
select area, direction, "level", sender, coalesce(nv, "value") "value", received from o full join n using (area, direction, "level", sender)"""),
}
