"""Documents, JSON payloads and the keyed store: written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from headroom.catalog import views as v
from headroom.catalog.views import oracle
from headroom.operators.columns import quoted
from headroom.scale import put_text, scratch_path
from headroom.sources import documents as d
from headroom.sources import matrix as mx
from headroom.sources import store as st

DOC = "ReserveBid_MarketDocument"


def _result_points(spark, sf):
    """Steps as result points: one series per order, one receiver per priority, a document per receiver and start day."""
    return v.steps(spark, sf).select(
        "series_id", "position", F.col("quantity").alias("value"), F.lit(99.0).alias("percentage_level"),
        F.col("series_from").cast("timestamp").alias("series_from"), F.col("series_to").cast("timestamp").alias("series_to"), "resolution",
        F.lit("A97").alias("business_type"), F.concat(F.lit("area"), F.col("series_id") % 3).alias("domain"), F.lit("A01").alias("direction"),
        F.lit("A14").alias("process_type"), F.lit("A24").alias("message_type"), F.lit("RCC").alias("sender"), F.lit(2).alias("version"), F.lit("BLOCK").alias("block"),
        F.col("type").alias("receiver"), F.lit("95_100").alias("spacing"), F.col("series_from").cast("timestamp").alias("period_from"),
        F.col("series_to").cast("timestamp").alias("period_to"),
    )


def _document_text(spark, sf):
    """Documents as text; the shuffle that collects them spreads them."""
    return d.document_text(d.market_documents(_result_points(spark, sf), DOC), DOC)


# what is read back of a written document: the fields in question, in one pass over its text
WRITTEN = "`receiver_MarketParticipant.mRID` struct<_codingScheme:string,_VALUE:string>, Bid_TimeSeries array<struct<Period:struct<Point:array<struct<quantity:double>>>>>"


def write_market_xml(spark, sf):
    documents = _document_text(spark, sf).select("receiver", "period_from", F.from_xml("document", WRITTEN, {"rowTag": DOC}).alias("doc"))
    series, to = F.col("doc.Bid_TimeSeries"), F.col("doc").getField("receiver_MarketParticipant.mRID")
    points = F.flatten(F.transform(series, lambda s: s.getField("Period").getField("Point")))
    total = F.aggregate(points, F.lit(0.0), lambda a, p: a + p.getField("quantity"))
    return documents.select(
        "receiver", F.col("period_from").cast("timestamp_ntz").alias("period_from"), F.size(series).alias("series"), F.size(points).alias("points"),
        F.round(total, 4).alias("quantity"), to.getField("_VALUE").alias("to_mrid"), to.getField("_codingScheme").alias("scheme"),
    )


def read_market_xml(spark, sf):
    path = scratch_path(spark, "documents")
    d.write_market_xml(_result_points(spark, sf), DOC, path, compression="gzip")
    points = d.read_market_xml(spark, path, DOC)
    return points.select(
        "document_type", quoted("Bid_TimeSeries.mRID").cast("bigint").alias("series_id"), quoted("Point.position").alias("position"),
        quoted("Point.quantity").alias("quantity"), quoted("Bid_TimeSeries.connecting_Domain.mRID").alias("domain"),
        quoted("Bid_TimeSeries.connecting_Domain.mRID.codingScheme").alias("scheme"), quoted("process.processType").alias("process_type"),
        F.col("utc_start").cast("timestamp_ntz").alias("utc_start"), F.col("utc_end").cast("timestamp_ntz").alias("utc_end"),
    )


def parse_market_xml(spark, sf):
    points = d.parse_market_xml(_document_text(spark, sf), "document", DOC)
    return points.select(
        quoted("Bid_TimeSeries.mRID").cast("bigint").alias("series_id"), quoted("Point.position").alias("position"), quoted("Point.quantity").alias("quantity"),
        F.col("utc_start").cast("timestamp_ntz").alias("utc_start"),
    )


def _odd_documents(spark, sf):
    """Documents with an element that no schema lists, and a text for the quantity of each first point."""
    def odd(point):
        return point.withField("quantity", F.when(point.getField("position") == 1, "open").otherwise(point.getField("quantity").cast("string")))

    def opened(series):
        return series.withField("Period.Point", F.transform(series.getField("Period").getField("Point"), odd))

    documents = d.market_documents(_result_points(spark, sf), DOC)
    note = F.struct(F.lit("free").alias("_kind"), F.array("receiver", F.lit("end")).alias("line"))
    document = F.col("document").withField("Bid_TimeSeries", F.transform(F.col("document.Bid_TimeSeries"), opened)).withField("`delivery.note`", note)
    path = scratch_path(spark, "odd")
    d.write_documents(documents.withColumn("document", document), DOC, path, compression="gzip")
    return path


def unlisted_elements(spark, sf):
    found = d.unlisted_elements(spark, _odd_documents(spark, sf), DOC)
    return found.groupBy("path", F.array_join(F.col("position").cast("array<string>"), ".").alias("position"), "value").agg(F.count("*").alias("n"))


def read_mixed_quantities(spark, sf):
    points = d.read_market_xml(spark, _odd_documents(spark, sf), DOC)
    return points.select(
        quoted("Bid_TimeSeries.mRID").cast("bigint").alias("series_id"), quoted("Point.position").alias("position"), quoted("Point.quantity").alias("quantity"),
        quoted("Point.quantity.text").alias("text"),
    )


def bounded_documents(spark, sf):
    """Documents of at most 200 points and one series: the parts of each group, read back whole."""
    path = scratch_path(spark, "parts")
    d.write_market_xml(_result_points(spark, sf).withColumn("period_from", F.lit("1995-01-01").cast("timestamp")), DOC, path, max_points=200, compression="gzip")
    points = d.read_market_xml(spark, path, DOC)
    per = points.groupBy("mRID", quoted("receiver_MarketParticipant.mRID").alias("receiver")).agg(F.count("*").alias("points"), F.round(F.sum(quoted("Point.quantity")), 4).alias("quantity"))
    return per.groupBy("receiver").agg(F.max(F.col("points") < 207).alias("bounded"), (F.count("*") > 1).alias("parted"), F.sum("points").alias("points"), F.round(F.sum("quantity"), 4).alias("quantity"))


XSD = """<?xml version="1.0"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="Series"><xs:complexType><xs:sequence>
<xs:element name="mRID" type="xs:string"/><xs:element name="position" type="xs:integer"/>
<xs:element name="quantity" type="xs:decimal"/></xs:sequence></xs:complexType></xs:element></xs:schema>"""


FILE_ROWS = 500_000  # of a file to validate: one task reads a file whole


def _to_validate(spark, sf):
    """Path of one element a step, some with a text for the quantity, and the schema of their columns."""
    path = scratch_path(spark, "checked")
    broken = F.when(F.col("series_id") % 10 == 0, "much").otherwise(F.col("quantity").cast("string"))
    rows = v.steps(spark, sf).select(F.col("series_id").cast("string").alias("mRID"), "position", broken.alias("quantity"))
    rows.write.format("xml").options(rowTag="Series", rootTag="All", indent="", maxRecordsPerFile=FILE_ROWS, compression="gzip").save(path)
    return path, rows.limit(0).select("mRID", "position", F.lit(0.0).alias("quantity")).schema


def validate_market_xml(spark, sf):
    xsd = put_text(spark, f"{scratch_path(spark, 'schema')}/series.xsd", XSD)
    path, kind = _to_validate(spark, sf)
    checked = d.validate_market_xml(spark, path, xsd, "Series", kind)
    return checked.groupBy("valid").agg(F.count("*").alias("n"), F.round(F.sum("quantity"), 4).alias("quantity"))


def read_matrix_json(spark, sf):
    names = ["North", "Mid", "South"]
    cells = v.imbalance(spark, sf).groupBy("valid_from", "valid_to").pivot("region", names).agg(F.first("quantity"))
    header = F.array(*[
        F.struct(F.lit(i).alias("index"), F.lit(n).alias("group_level_0"), F.lit("BALANCING ACE").alias("group_level_1"), F.lit("Upward" if i else "Downward").alias("label"))
        for i, n in enumerate(names)
    ])
    line = F.struct(
        F.date_format(F.col("valid_from").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("from"),
        F.date_format(F.col("valid_to").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("to"), F.array(*names).alias("values"),
    )
    days = cells.groupBy(F.to_date("valid_from").alias("day")).agg(F.collect_list(line).alias("timeseries"))  # 96 lines a day
    payload = F.to_json(F.struct(F.struct(F.lit("balancing_ace").alias("id"), F.lit("MW").alias("measurement_unit"), header.alias("columns"), "timeseries").alias("data")))
    points = mx.read_matrix_json(days.select(payload.alias("value")), areas={"North": "N", "Mid": "M"})
    return points.where("quantity is not null").select(
        "mrid", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"), F.col("valid_to").cast("timestamp_ntz").alias("valid_to"), "domain_name", "domain",
        "direction_code", "message_type", "business_type", "process_type", F.round("quantity", 6).alias("quantity"),
    )


def _point_lists(spark, sf):
    """Lists of at most 500 points each, as one message or file holds them."""
    point = F.struct("id", "area", F.struct(F.col("quantity").alias("value")).alias("available"))
    return v.bids(spark, sf).groupBy(F.floor(F.col("id") / 500).alias("list")).agg(F.to_json(F.collect_list(point)).alias("value"))


POINT = "id bigint, area string, available struct<value: double>"


def read_json_points(spark, sf):
    path = scratch_path(spark, "lists")
    _point_lists(spark, sf).write.partitionBy("list").text(path)
    points = mx.read_json_points(spark, path, POINT)
    return points.select("id", "area", F.col("available.value").alias("value"))


def parse_json_points(spark, sf):
    points = mx.parse_json_points(_point_lists(spark, sf), "value", "id: bigint, area: string, available: struct<value: double>")
    return points.select("id", "area", F.col("available.value").alias("value"))


def upsert_by_key(spark, sf):
    target = scratch_path(spark, "store")
    keys = ["valid_from", "area", "product", "exclusive_id"]
    bids = v.bids(spark, sf).select("id", *keys, "quantity")
    st.upsert_by_key(bids.where("id % 2 = 0"), target, keys, ["id"])
    # corrections of stored rows, new rows, and rows older than what is stored
    late = bids.where("id % 2 = 1 or id % 3 = 0").withColumn("quantity", F.col("quantity") + 1000)
    st.upsert_by_key(late, target, keys, ["id"])
    return st.read_store(spark, target).select("id_key", "id", *keys, F.round("quantity", 6).alias("quantity"))


QUERIES = {f.__name__: f for f in (
    write_market_xml, read_market_xml, parse_market_xml, unlisted_elements, read_mixed_quantities, bounded_documents, validate_market_xml, read_matrix_json, read_json_points, parse_json_points, upsert_by_key,
)}

ORACLE = {
    "write_market_xml": oracle("steps", """select "type" receiver, series_from period_from, count(distinct series_id)::int series, count(*)::int points, round(sum(quantity),4) quantity, "type" to_mrid, 'A01' scheme from steps group by 1,2"""),
    "read_market_xml": oracle("steps", """select 'ReserveBid_MarketDocument' document_type, series_id, "position", round(quantity,1) quantity, 'area' || (series_id%3) "domain", 'A01' scheme, 'A14' process_type, valid_from utc_start, valid_to utc_end from steps"""),
    "parse_market_xml": oracle("steps", """select series_id, "position", round(quantity,1) quantity, valid_from utc_start from steps"""),
    "unlisted_elements": oracle("steps", """, g as (select distinct "type", series_from from steps)
select 'delivery.note.line' "path", '1' "position", "type" "value", count(*) n from g group by all union all select 'delivery.note.line', '2', 'end', count(*) from g
union all select 'delivery.note.kind', '', 'free', count(*) from g"""),
    "read_mixed_quantities": oracle("steps", """select series_id, "position", case when "position">1 then round(quantity,1) end quantity, case when "position"=1 then 'open' end "text" from steps"""),
    "bounded_documents": oracle("steps", """select "type" receiver, true bounded, count(*)>1 parted, count(*) points, round(sum(round(quantity,1)),4) quantity from steps group by 1"""),
    "validate_market_xml": oracle("steps", """select series_id%10<>0 "valid", count(*) n, round(sum(case when series_id%10<>0 then quantity end),4) quantity from steps group by 1"""),
    "read_matrix_json": oracle("imbalance", """select 'balancing_ace' mrid, valid_from, valid_to, region domain_name, case region when 'North' then 'N' when 'Mid' then 'M' end "domain",
 case region when 'North' then 'A02' else 'A01' end direction_code, 'A86' message_type, 'B33' business_type, 'A16' process_type, round(quantity,6) quantity from imbalance"""),
    "read_json_points": oracle("bids", """select id, area, quantity "value" from bids"""),
    "parse_json_points": oracle("bids", """select id, area, quantity "value" from bids"""),
    "upsert_by_key": oracle("bids", """, b as (select *, concat_ws('-', strftime(valid_from,'%Y-%m-%d %H:%M:%S'), area, product, exclusive_id) k from bids)
select k id_key, id, valid_from, area, product, exclusive_id, round(quantity+case when id%2=1 or id%3=0 then 1000 else 0 end,6) quantity
from (select *, row_number() over (partition by k order by id desc) r from b) where r=1"""),
}
