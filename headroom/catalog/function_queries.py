"""Column functions on values taken from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from headroom import functions as h
from headroom.catalog import views as v
from headroom.catalog.views import oracle


def parse_iso_duration(spark, sf):
    text = F.expr("""case o_orderkey % 5 when 0 then concat('P', o_orderkey % 3, 'DT', o_orderkey % 24, 'H', o_orderkey % 60, 'M')
 when 1 then concat('-PT', o_orderkey, 'S') when 2 then concat('P', 1 + o_orderkey % 4, 'Y', o_orderkey % 12, 'M') when 3 then concat('P', o_orderkey % 9, 'W') else 'soon' end""")
    return v.table(spark, sf, "orders").select("o_orderkey", h.parse_iso_duration(text).alias("seconds"))


def format_iso_duration(spark, sf):
    return v.table(spark, sf, "orders").select("o_orderkey", h.format_iso_duration(F.col("o_orderkey") * 7 % 200000).alias("text"))


def parse_datetime_any(spark, sf):
    t = F.col("o_orderdate").cast("timestamp")
    text = (
        F.when(F.col("o_orderkey") % 6 == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm'Z'"))
        .when(F.col("o_orderkey") % 6 == 1, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(F.col("o_orderkey") % 6 == 2, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderkey") % 6 == 3, F.date_format(t, "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 6 == 4, F.date_format(t, "d MMM yyyy HH:mm' B'"))
        .otherwise("not a date")
    )
    return v.table(spark, sf, "orders").select("o_orderkey", h.parse_datetime_any(text).cast("timestamp_ntz").alias("parsed"))


def to_zone(spark, sf):
    return v.table(spark, sf, "events").select("event_id", h.to_zone(F.col("ts"), "CET").alias("cet"), h.localize(h.to_zone(F.col("ts"), "CET"), "CET").alias("utc"))


def format_utc(spark, sf):
    return v.table(spark, sf, "events").select("event_id", h.format_utc(F.col("ts")).alias("text"), h.format_utc(F.col("ts"), "yyyyMMddHHmm").alias("compact"))


def ceil_floor_dec(spark, sf):
    value = F.col("value") - 50
    return v.table(spark, sf, "events").select("event_id", h.ceil_dec(value, 1).alias("up"), h.floor_dec(value, 1).alias("down"), h.floor_dec(value).alias("whole"))


def safe_ratio(spark, sf):
    a, b = F.col("l_linenumber") % 3, F.floor(F.col("l_quantity")) % 4
    return v.table(spark, sf, "lineitem").groupBy(a.alias("a"), b.alias("b")).agg(F.count("*").alias("n")).withColumn("ratio", F.round(h.safe_ratio(F.col("a"), F.col("b")), 6))


def ordered_subsequence(spark, sf):
    words = v.bids(spark, sf).select("id", F.array("area", "product", "kind", "direction").alias("words"), F.array("area", "direction").alias("inside"), F.array("direction", "area").alias("swapped"))
    short = F.array(F.lit("o"), F.lit("mFRR"))
    return words.select(
        "id", h.ordered_subsequence(F.col("inside"), F.col("words")).alias("ordered"), h.ordered_subsequence(F.col("swapped"), F.col("words")).alias("reverse"),
        h.contiguous_substrings(short, F.col("words")).alias("contiguous"),
    )


def contains_any(spark, sf):
    label = F.concat_ws(" ", "area", "product", "direction")
    return v.bids(spark, sf).where(h.contains_any(label, ["MFRR", "south"], ["down"])).select("id", label.alias("label"))


def strip_direction_words(spark, sf):
    label = F.concat_ws(".", "area", "product", "direction")
    merged = h.strip_direction_words(label, ["SA_", "DA_"], "")
    parts = h.order_label_words(F.array("area", "direction", "product"), ["aFRR", "mFRR", "UP"])
    return v.bids(spark, sf).groupBy(merged.alias("label"), F.concat_ws("|", parts).alias("parts")).agg(F.round(F.sum("quantity"), 4).alias("quantity"))


def strip_zone(spark, sf):
    return v.table(spark, sf, "events").select("event_id", h.strip_zone(F.col("ts").cast("timestamp"), "CET").alias("local"))


QUERIES = {f.__name__: f for f in (
    parse_iso_duration, format_iso_duration, parse_datetime_any, to_zone, format_utc, ceil_floor_dec, safe_ratio, ordered_subsequence,
    contains_any, strip_direction_words, strip_zone,
)}

_CET = "timezone('CET', timezone('UTC', ts))"

ORACLE = {
    "parse_iso_duration": """select o_orderkey, cast(case o_orderkey%5 when 0 then (o_orderkey%3)*86400+(o_orderkey%24)*3600+(o_orderkey%60)*60 when 1 then -o_orderkey
 when 2 then (1+o_orderkey%4)*31536000+(o_orderkey%12)*2592000 when 3 then (o_orderkey%9)*604800 end as bigint) "seconds" from orders""",
    "format_iso_duration": """select o_orderkey, case when t=0 then null else 'P' || case when t//86400>0 then (t//86400) || 'D' else '' end
 || case when t%86400>0 then 'T' || case when t%86400//3600>0 then (t%86400//3600) || 'H' else '' end
 || case when t%3600//60>0 then (t%3600//60) || 'M' else '' end || case when t%60>0 then (t%60) || 'S' else '' end else '' end end "text" from (select o_orderkey, o_orderkey*7%200000 t from orders)""",
    "parse_datetime_any": """select o_orderkey, case o_orderkey%6 when 5 then null when 1 then o_orderdate - interval 2 hours when 4 then o_orderdate + interval 2 hours else o_orderdate end parsed from orders""",
    "to_zone": f"select event_id, {_CET} cet, ts utc from events",
    "format_utc": """select event_id, strftime(ts, '%Y-%m-%dT%H:%MZ') "text", strftime(ts, '%Y%m%d%H%M') compact from events""",
    "ceil_floor_dec": "select event_id, ceil((value-50)*10)/10 up, floor((value-50)*10)/10 down, floor(value-50) whole from events",
    "safe_ratio": """select a, b, n, round(case when b=0 and a=0 then 0 when b=0 then 2 else a/b end,6)::double ratio from (select l_linenumber%3 a, cast(floor(l_quantity) as bigint)%4 b, count(*) n from lineitem group by 1,2)""",
    "ordered_subsequence": oracle("bids", """select id, true "ordered", false "reverse", (contains(area,'o') and contains(product,'mFRR')) contiguous from bids"""),
    "contains_any": oracle("bids", """select id, concat_ws(' ',area,product,direction) "label" from bids where (product like '%mFRR%' or area='South') and direction<>'DOWN'"""),
    "strip_direction_words": oracle("bids", """select "label", parts, round(sum(quantity),4) quantity from (select quantity, concat_ws('.', area, replace(replace(product,'SA_',''),'DA_',''), direction) "label",
 case when direction='UP' and product<>'RR' then area || '|' || right(product,4) || '_UP' else area || '|' || direction || '|' || right(product,4) end parts from bids) group by 1,2"""),
    "strip_zone": f"""select event_id, {_CET} "local" from events""",
}
