"""Documents, nesting, the store and streams."""

from datetime import datetime

import pytest
from plain_rows import rows
from pyspark.sql import functions as F

from headroom import registry
from headroom.catalog import document_queries as dq
from headroom.catalog import stream_queries as sq
from headroom.operators.columns import quoted
from headroom.scale import scratch_path
from headroom.sources import documents as d
from headroom.sources import matrix as mx
from headroom.sources import points as p
from headroom.sources import store as st
from headroom.streaming import streams as sm

T0 = datetime(2024, 3, 1)


def test_flatten_undoes_nest(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, None, 3.0)], "id int, `domain.name` string, `available.value` double")
    assert rows(p.flatten_nested(p.nest_columns(df))) == rows(df)


def test_flatten_measures_lists_at_every_depth(spark):
    df = spark.sql("select 1 id, array(named_struct('a', array(1,2,3), 'b', 'x')) l union all select 2, array(named_struct('a', array(4), 'b', 'y'), named_struct('a', array(), 'b', 'z'))")
    flat = p.flatten_nested(df)
    assert flat.columns == ["id", "l.1.a.1", "l.1.a.2", "l.1.a.3", "l.1.b", "l.2.a.1", "l.2.a.2", "l.2.a.3", "l.2.b"]
    assert rows(flat)[0] == (1, 1, 2, 3, "x", None, None, None, None)


def test_time_chunks_last_one_is_shorter(spark):
    got = rows(p.time_chunks(spark, T0, datetime(2024, 3, 4), "P2D"))
    assert got == [(0, T0, datetime(2024, 3, 3)), (1, datetime(2024, 3, 3), datetime(2024, 3, 4))]


XML = """<?xml version="1.0"?>
<Balancing_MarketDocument xmlns="urn:made-up"><mRID>sample-7</mRID><type>A86</type><process.processType>A47</process.processType>
<domain.mRID codingScheme="A10">HILLS</domain.mRID>
<period.timeInterval><start>2019-06-03T00:00Z</start><end>2019-06-03T06:00Z</end></period.timeInterval>
<TimeSeries><mRID>east</mRID><connecting_Domain.mRID codingScheme="A10">HX</connecting_Domain.mRID>
<Period><timeInterval><start>2019-06-03T00:00Z</start><end>2019-06-03T02:00Z</end></timeInterval><resolution>PT1H</resolution>
<Point><position>1</position><quantity>31</quantity></Point><Point><position>2</position><quantity>-4.25</quantity></Point></Period></TimeSeries>
<TimeSeries><mRID>west</mRID><Period><timeInterval><start>2019-06-03T05:00Z</start><end>2019-06-03T06:00Z</end></timeInterval><resolution>PT1H</resolution>
<Point><position>1</position><quantity>0</quantity></Point></Period></TimeSeries></Balancing_MarketDocument>"""


def test_read_market_xml_file(spark, tmp_path):
    (tmp_path / "one.xml").write_text(XML)
    points = d.read_market_xml(spark, str(tmp_path), "Balancing_MarketDocument")
    got = rows(points.select(
        quoted("TimeSeries.mRID"), quoted("Point.quantity"), quoted("domain.mRID"), quoted("domain.mRID.codingScheme"), quoted("document.period.timeInterval.end"),
        F.col("utc_start").cast("timestamp_ntz"),
    ))
    end = "2019-06-03T06:00Z"
    assert got == [
        ("east", -4.25, "HILLS", "A10", end, datetime(2019, 6, 3, 1)), ("east", 31.0, "HILLS", "A10", end, datetime(2019, 6, 3)),
        ("west", 0.0, "HILLS", "A10", end, datetime(2019, 6, 3, 5)),
    ]
    text = spark.createDataFrame([(XML,), ("<broken",)], "payload string")
    assert d.parse_market_xml(text, "payload", "Balancing_MarketDocument").count() == 3


def test_read_json_list_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "v": {"x": 2.5}},\n {"id": 2}]')
    (tmp_path / "b.json").write_text('[{"id": 3, "v": {"x": 4.0}}]')
    points = mx.read_json_points(spark, str(tmp_path), "id int, v struct<x: double>")
    assert rows(p.flatten_nested(points)) == [(1, 2.5), (2, None), (3, 4.0)]


def test_documents_round_trip(spark, sf):
    assert dq.read_market_xml(spark, sf).count() == dq.parse_market_xml(spark, sf).count() == dq._result_points(spark, sf).count()


def _store_schema():
    return "k string, valid_from timestamp_ntz, n int, v double"


def test_store_rerun_is_harmless_and_keeps_other_months(spark):
    target, schema = scratch_path(spark, "store"), _store_schema()
    st.upsert_by_key(spark.createDataFrame([("a", T0, 1, 1.0), ("a", T0, 2, 2.0), (None, T0, 1, 5.0), ("a", datetime(2024, 4, 1), 1, 9.0)], schema), target, ["k", "valid_from"], "n")
    late = spark.createDataFrame([("a", T0, 3, 3.0)], schema)
    for _ in range(2):
        st.upsert_by_key(late, target, ["k", "valid_from"], "n", label="late")
    want = [("2024-03-01 00:00:00", 5.0), ("a-2024-03-01 00:00:00", 3.0), ("a-2024-04-01 00:00:00", 9.0)]
    assert rows(st.read_store(spark, target).select("id_key", "v")) == want
    assert rows(st.read_store(spark, target, without="late").select("id_key", "v"))[1][1] == 2.0
    assert rows(st.read_store(spark, target, months=["2024-04"]).select("v")) == [(9.0,)]
    st.upsert_by_key(spark.createDataFrame([("a", T0, 1, 8.0)], schema), target, ["k", "valid_from"], "n")  # older than what is stored
    assert rows(st.read_store(spark, target).select("id_key", "v")) == want
    assert sorted(st.compact_store(spark, target)) == ["2024-03", "2024-04"] and st.compact_store(spark, target) == []
    assert rows(st.read_store(spark, target).select("id_key", "v")) == want
    long_key = spark.createDataFrame([("x" * 600,)], "k string").select(F.length(st.composite_id("k"))).first()[0]
    assert long_key == 600


def test_store_appends_only_its_own_rows_and_compacts(spark):
    target, schema = scratch_path(spark, "store"), _store_schema()
    keys, months = ["k", "valid_from"], [datetime(2024, m, 1) for m in (1, 2, 3)]
    st.upsert_by_key(spark.createDataFrame([(f"k{i}", t, 0, float(i)) for i in range(20) for t in months], schema), target, keys, "n")
    before = set(spark.read.option("recursiveFileLookup", "true").parquet(f"{target}/deltas").inputFiles())
    for b in range(1, 6):
        st.upsert_by_key(spark.createDataFrame([("k3", months[1], b, 100.0 + b)], schema), target, keys, "n", label=f"b{b}", compact_every=4)
    after = st.read_store(spark, target)
    assert after.count() == 60 and [r.v for r in after.where("k = 'k3'").orderBy("valid_from").collect()] == [3.0, 105.0, 3.0]
    files = st._Files(spark, target)
    assert before and len(files.folders("deltas")) < 6 and files.folders("base/__month=2024-02") == ["upto=4"]
    assert len(files.folders("base/__month=2024-01")) == 1
    st.upsert_by_key(spark.createDataFrame([("k3", months[1], 9, None)], schema).withColumn("__deleted", F.lit(True)), target, keys, "n")
    st.compact_store(spark, target)
    st.upsert_by_key(spark.createDataFrame([("k3", months[1], 7, 1.0)], schema), target, keys, "n")  # older than its removal
    assert st.read_store(spark, target).where("k = 'k3'").count() == 2
    st.upsert_by_key(spark.createDataFrame([("k3", months[1], 10, 2.0, "new")], schema + ", extra string"), target, keys, "n")
    assert rows(st.read_store(spark, target).where("k = 'k3'").select("v", "extra")) == [(2.0, "new"), (3.0, None), (3.0, None)]
    with pytest.raises(ValueError):
        st.upsert_by_key(spark.createDataFrame([("k3", months[1], "x", 1.0)], "k string, valid_from timestamp_ntz, n string, v double"), target, keys, "n")


def test_store_without_rows_reads_as_a_table_and_ids_do_not_clash(spark):
    target, schema = scratch_path(spark, "store"), _store_schema()
    assert not st.store_exists(spark, target)
    st.upsert_by_key(spark.createDataFrame([], schema), target, ["k", "valid_from"], "n")
    empty = st.read_store(spark, target)
    assert st.store_exists(spark, target) and empty.columns == ["k", "valid_from", "n", "v", "id_key"] and empty.count() == 0
    pairs = spark.createDataFrame([("a-b", "c", T0, 1), ("a", "b-c", T0, 2), (None, "a-b-c", T0, 3), ("a-b-c", None, None, 4)], "p string, q string, valid_from timestamp_ntz, n int")
    st.upsert_by_key(pairs, f"{target}2", ["p", "q", "valid_from"], "n")
    assert rows(st.read_store(spark, f"{target}2").select("n")) == [(1,), (2,), (3,), (4,)]


def test_streams_equal_batch(spark, sf):
    assert rows(sq.stream_latest_by_key(spark, sf)) == rows(sq.v.bids(spark, sf).groupBy("valid_from", "area").agg(F.max("id").alias("id")))
    assert sq.drain_available(spark, sf).agg(F.sum("n")).first()[0] == sq.v.bids(spark, sf).count()


def test_first_by_key_within_watermark(spark):
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "out")
    spark.createDataFrame([("a", T0), ("a", T0), ("b", T0)], "k string, t timestamp_ntz").write.parquet(inbox)
    stream = spark.readStream.schema("k string, t timestamp_ntz").parquet(inbox)
    sm.drain_available(sm.first_by_key(stream, "k", "t").writeStream.format("parquet").option("path", out), scratch_path(spark, "progress"))
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_payload_kind_and_headers(spark):
    df = spark.createDataFrame([({"a": "1"}, " <x/>"), ({"a": "2"}, "[1]"), (None, "plain")], "headers map<string,string>, payload string")
    assert [r[0] for r in df.select(sm.payload_kind(F.col("payload"))).collect()] == ["xml", "json", None]
    assert sm.with_headers(df, {"a": "1"}).count() == 1


def test_registry_knows_the_operators():
    assert {"ADD", "SUBTRACT", "MIN", "MAX", "ATC_SUBTRACT"} <= set(registry.COMBINE) and {"PROPORTION", "CASCADE"} <= set(registry.EXCEEDANCE)
    with pytest.raises(ValueError):
        registry.aggregate("mystery")
