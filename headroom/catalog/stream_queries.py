"""Streams drained with `availableNow`, registries and message handlers."""

from __future__ import annotations

from pyspark.sql import functions as F

from headroom import registry
from headroom.catalog import exceedance_queries as ex
from headroom.catalog import views as v
from headroom.catalog.views import oracle
from headroom.operators import combine as cb
from headroom.operators import exceedance as x
from headroom.scale import literal_table, scratch_path
from headroom.sources.store import read_store
from headroom.streaming import streams as sm

POINT = "area string, direction string, `level` int, sender int, value double, valid_from timestamp"
IDS = ["area", "direction", "level", "sender", "valid_from"]


def _points(spark, sf):
    return v.realised(spark, sf).select(
        "area", "direction", "level", "sender", "value", F.lit("2024-01-01").cast("timestamp").alias("valid_from"), F.col("received").cast("timestamp").alias("received")
    )


def _messages(spark, sf, path):
    """Realised points as messages: JSON and XML payloads, a foreign header, and a second delivery of every fourth level.

    The points are a summary of at most a few hundred rows, so a file each is enough.
    """
    body = F.struct("area", "direction", "level", "sender", "value", "valid_from")
    points = _points(spark, sf)
    again = points.where("level % 4 = 0").withColumns({"value": F.col("value") + 500, "received": F.col("received") + F.expr("interval 1 day")})
    payload = F.when(F.col("level") % 2 == 0, F.to_json(body)).otherwise(F.to_xml(body, {"rowTag": "Point"}))
    headers = F.create_map(F.lit("businessType"), F.when(F.col("sender") == 1, "OTHER").otherwise("REALISED"))
    for i, part in enumerate((points.where("level < 97"), points.where("level >= 97"), again)):
        part.select(headers.alias("headers"), payload.alias("payload"), "received").coalesce(1).write.mode("append").parquet(path)


def json_points(messages):
    return messages.select(F.from_json("payload", POINT).alias("p"), "received").select("p.*", "received")


def xml_points(messages):
    return messages.select(F.from_xml("payload", POINT, {"rowTag": "Point"}).alias("p"), "received").select("p.*", "received")


def _stored(spark, target):
    rows = read_store(spark, target)
    return rows.select("area", "direction", "level", "sender", F.round("value", 6).alias("value"))


def stream_points(spark, sf):
    inbox, target = scratch_path(spark, "inbox"), scratch_path(spark, "points")
    _messages(spark, sf, inbox)
    stream = sm.message_stream(spark, inbox, files_per_batch=1)
    writer = sm.stream_points(stream, {"businessType": "REALISED"}, target, {"json": json_points, "xml": xml_points}, IDS, ["received"])
    sm.drain_available(writer, scratch_path(spark, "progress"))
    return _stored(spark, target)


def stream_latest_by_key(spark, sf):
    inbox, target = scratch_path(spark, "inbox"), scratch_path(spark, "latest")
    bids = v.bids(spark, sf).select("id", "valid_from", "area", "quantity")
    bids.write.parquet(inbox)
    stream = spark.readStream.schema(bids.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    sm.drain_available(sm.stream_latest_by_key(stream, ["valid_from", "area"], target, ["id"]), scratch_path(spark, "progress"))
    return read_store(spark, target).select("valid_from", "area", "id")


def stream_exceeded_check(spark, sf):
    """Three deliveries, each drained by itself: two senders' parts, then zeros for area A, which clear its exceedances."""
    inbox, stored, result, progress = (scratch_path(spark, n) for n in ("inbox", "realised", "exceeded", "progress"))
    points = _points(spark, sf)
    zeros = points.where("area = 'A'").withColumns({"value": F.lit(0.0), "received": F.col("received") + F.expr("interval 1 day")})
    proposed = v.proposed(spark, sf).withColumn("value", F.col("value") / 8)
    receivers = literal_table(spark, [(0,), (1,), (2,)], "receiver int")
    for part in (points.where("sender = 0"), points.where("sender > 0"), zeros):
        part.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(points.schema).parquet(inbox)
        sm.drain_available(sm.stream_exceeded_check(stream, proposed, stored, result, receivers, ["area", "direction"]), progress)
    return read_store(spark, result).select("area", "direction", "level", "receiver", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"), "value")


def drain_available(spark, sf):
    inbox, target = scratch_path(spark, "inbox"), scratch_path(spark, "drained")
    v.bids(spark, sf).select("id", "valid_from", "area", "quantity").write.parquet(inbox)
    stream = spark.readStream.schema("id bigint, valid_from timestamp_ntz, area string, quantity double").parquet(inbox)
    writer = stream.writeStream.format("parquet").option("path", target)
    sm.drain_available(writer, scratch_path(spark, "progress"))
    return spark.read.parquet(target).groupBy("area").agg(F.count("*").alias("n"), F.round(F.sum("quantity"), 4).alias("quantity"))


def combine_registry(spark, sf):
    """Every registered combine operator, and one of the caller's own."""
    registry.register_combine("MEAN", lambda tables, by=None, time=None, **_: cb._combine(tables, by, time, "inner", lambda a, b: (a + b) / 2))
    by = ["area", "direction"]
    tables = [cb.pivot_products(v.bids(spark, sf).where(F.col("product") == n), "quantity", by) for n in ("SA_mFRR", "DA_mFRR")]
    rows = [
        registry.COMBINE[n](tables, by=by, time=["valid_from", "valid_to"]).withColumn("operator", F.lit(n)) for n in ("ADD", "MIN", "MAX", "MEAN")
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3]).groupBy("operator", *by).agg(F.count("value").alias("n"), F.round(F.sum("value"), 4).alias("value"))


def exceedance_registry(spark, sf):
    registry.register_exceedance("NONE", lambda joined, by=None, level=None, **_: joined.limit(0).withColumns({"exceeded": F.lit(0.0), "value": F.lit(0.0)}))
    joined = ex._joined(spark, sf)
    rows = [registry.EXCEEDANCE[n](joined, by=ex.KEYS, level="level").select("area", "sender", "value").withColumn("operator", F.lit(n)) for n in ("CASCADE", "PROPORTION", "NONE")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("operator", "area").agg(F.count("*").alias("n"))


def aggregate_by_name(spark, sf):
    bids = v.bids(spark, sf)
    parts = [cb.pivot_products(bids, "quantity", ["area", "product"], how=n).withColumn("how", F.lit(n)) for n in ("min", "max", "median", "count")]
    parts = [p.withColumn("value", F.round(F.col("value").cast("double"), 6)) for p in parts]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def payload_parser_registry(spark, sf):
    inbox = scratch_path(spark, "inbox")
    _messages(spark, sf, inbox)
    registry.register_parser("json", json_points)
    registry.register_parser("xml", xml_points)
    points = sm.parse_payloads(spark.read.parquet(inbox), registry.PARSERS)
    return points.select("area", "direction", "level", "sender", F.round("value", 6).alias("value"))


def message_handler(spark, sf):
    """Two handlers, each with its own header filter, behind one `foreachBatch`."""
    inbox, realised, other = (scratch_path(spark, n) for n in ("inbox", "realised", "other"))
    _messages(spark, sf, inbox)

    def keep(path):
        return lambda batch, batch_id: batch.select("received").write.mode("append").parquet(path)

    handler = sm.route([({"businessType": "REALISED"}, keep(realised)), ({"businessType": "OTHER"}, keep(other))])
    sm.drain_available(sm.message_stream(spark, inbox).writeStream.foreachBatch(handler), scratch_path(spark, "progress"))
    both = spark.read.parquet(realised).withColumn("kind", F.lit("realised")).unionByName(spark.read.parquet(other).withColumn("kind", F.lit("other")))
    return both.groupBy("kind").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    stream_points, stream_latest_by_key, stream_exceeded_check, drain_available, combine_registry, exceedance_registry, aggregate_by_name,
    payload_parser_registry, message_handler,
)}

_PAIR = """, a as (select valid_from, area, direction, sum(quantity) q from bids where product='SA_mFRR' group by all),
 b as (select valid_from, area, direction, sum(quantity) q from bids where product='DA_mFRR' group by all),
 t as (select distinct valid_from from a intersect select distinct valid_from from b),
 j as (select area, direction, a.q x, b.q y from a full join b using (valid_from, area, direction) where valid_from in (from t))"""

ORACLE = {
    "stream_points": oracle("realised", """select area, direction, "level", sender, round("value" + case when "level"%4=0 then 500 else 0 end,6) "value" from realised where sender<>1"""),
    "stream_latest_by_key": oracle("bids", "select valid_from, area, max(id) id from bids group by 1,2"),
    "stream_exceeded_check": oracle("proposed realised", ex.CASCADE + """
select area, direction, "level", sender receiver, timestamp '2024-01-01' valid_from, round(realised/used*al,1) "value" from t
where zr>zp and abs(realised/used*al-realised)>1e-9 and area<>'A'"""),
    "drain_available": oracle("bids", "select area, count(*) n, round(sum(quantity),4) quantity from bids group by 1"),
    "combine_registry": oracle("bids", _PAIR + """, u as (select 'ADD' operator, area, direction, coalesce(x+y,x,y) z from j union all select 'MIN', area, direction, least(x,y) from j
 union all select 'MAX', area, direction, greatest(x,y) from j union all select 'MEAN', area, direction, case when x is not null and y is not null then (x+y)/2 else coalesce(x,y) end from j)
select operator, area, direction, count(z) n, round(sum(z),4) "value" from u group by all"""),
    "exceedance_registry": oracle("proposed realised", ex.CASCADE + """
select 'PROPORTION' operator, area, count(*) n from (select *, sum(realised/proposed) over (partition by area,direction) s from j) where s>1 group by area
union all select 'CASCADE', area, count(*) from t where zr>zp and abs(realised/used*al-realised)>1e-9 group by area"""),
    "aggregate_by_name": oracle("bids", """select 'min' how, valid_from, valid_to, area, product, round(min(quantity),6) "value" from bids group by all
union all select 'max', valid_from, valid_to, area, product, round(max(quantity),6) from bids group by all
union all select 'median', valid_from, valid_to, area, product, round(median(quantity),6) from bids group by all
union all select 'count', valid_from, valid_to, area, product, count(quantity)::double from bids group by all"""),
    "payload_parser_registry": oracle("realised", """select area, direction, "level", sender, round("value",6) "value" from realised
union all select area, direction, "level", sender, round("value"+500,6) from realised where "level"%4=0"""),
    "message_handler": oracle("realised", """select case sender when 1 then 'other' else 'realised' end kind, count(*) + count(*) filter ("level"%4=0) n from realised group by 1"""),
}
