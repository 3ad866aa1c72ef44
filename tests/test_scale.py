"""Steps that must not cost more than their input: how often a plan does its work, and how large its files are."""

from pyspark.sql import functions as F

from headroom.catalog import document_queries as dq
from headroom.functions import durations as du
from headroom.functions import times as ti
from headroom.operators import series as s
from headroom.scale import scratch_path
from headroom.sources import documents as d


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_durations_are_matched_once_a_point(spark):
    texts = ["P1D", "-P1Y2M3W4DT5H6M7.5S", "P1,5D", " PT1H ", "P", "x", "1;2;3;4;5;6;7", "", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(du.parse_iso_duration(F.col("t")))
    assert [r[0] for r in found.collect()] == [86400, -38898367, 129600, 3600, None, None, None, None, None]
    points = spark.createDataFrame([(1, "P1D", "a", 5.0), (2, None, "b", 6.0), (2, "P1D", "c", 7.0)], "position int, resolution string, receiver string, quantity double")
    receivers = spark.createDataFrame([("a", "PT12H"), ("b", "PT8H"), ("c", None)], "receiver string, output_resolution string")
    fine = s.refine_points(points, receivers)
    assert sorted(map(tuple, fine.select("receiver", "position", "quantity").collect())) == [("a", 1, 5.0), ("a", 2, 5.0), ("b", 2, 6.0), ("c", 2, 7.0)]
    assert _plan(fine).count("(-?)P(?=.)") <= 4  # a test and a match for either resolution


def test_documents_are_parsed_once_and_their_files_are_bounded(spark, sf, monkeypatch):
    plan = _plan(dq.parse_market_xml(spark, sf))
    assert plan.count("from_xml(") == 1 and plan.count("to_xml(") == 1
    path, documents = scratch_path(spark, "bounded"), d.market_documents(dq._result_points(spark, sf), dq.DOC, max_points=50)
    monkeypatch.setattr(d, "FILE_POINTS", 5_000)
    d.write_documents(documents, dq.DOC, path, max_points=50, compression="gzip")
    read = spark.read.format("xml").option("rowTag", dq.DOC).schema(d.document_schema(dq.DOC)).load(path)
    per_file = read.groupBy(F.input_file_name()).count().agg(F.max("count"), F.sum("count")).first()
    assert per_file[0] <= 100 and per_file[1] == documents.count()


def test_odd_documents_are_never_one_text(spark, sf):
    """Files hold documents as rows of the writer, not one text that a task has put together."""
    path = dq._odd_documents(spark, sf)
    read = spark.read.format("xml").option("rowTag", dq.DOC).schema(d.document_schema(dq.DOC)).load(path)
    assert read.count() == dq._result_points(spark, sf).select("receiver", "period_from").distinct().count()
    assert not [f for f in read.inputFiles() if "year=" in f]


def test_times_are_taken_apart_once(spark):
    texts = ["2024-05-01T10:20Z", "2024-13-01T10:20Z", "2024-05-01T10:20+02:00", "2024-05-01T10:20A", "20240501T102030", "1 May 2024", "x", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(ti.parse_datetime_any(F.col("t")).cast("string").alias("t"))
    assert [r.t for r in found.collect()] == ["2024-05-01 10:20:00", None, "2024-05-01 08:20:00", "2024-05-01 11:20:00", "2024-05-01 10:20:30", "2024-05-01 00:00:00", None, None]
    assert 0 < _plan(spark.range(9).select(ti.parse_datetime_any(F.col("id").cast("string")))).count("RLIKE(") <= 14


def test_files_to_validate_are_bounded(spark, sf, monkeypatch):
    monkeypatch.setattr(dq, "FILE_ROWS", 500)
    rows = {r.valid: (r.n, r.quantity) for r in dq.validate_market_xml(spark, sf).collect()}
    files = spark.read.format("xml").option("rowTag", "Series").schema("mRID string").load(dq._to_validate(spark, sf)[0]).groupBy(F.input_file_name()).count()
    assert set(rows) == {True, False} and files.agg(F.max("count")).first()[0] <= 500


def test_chunks_are_filled_without_a_join(spark):
    rows = [("a", "2024-01-01", 1.0), ("a", "2024-01-02", None), ("a", "2024-02-01", None), ("a", "2024-02-02", 2.0), (None, "2024-01-05", 3.0), (None, "2024-03-01", None)]
    df = spark.createDataFrame(rows, "k string, t string, v double").withColumn("valid_from", F.col("t").cast("timestamp"))
    for direction, want in (("forward", [1.0, 1.0, 1.0, 2.0, 3.0, 3.0]), ("backward", [1.0, 2.0, 2.0, 2.0, 3.0, None])):
        filled = s.fill_ordered(df, "v", "k", direction=direction)
        assert [r.v for r in filled.orderBy(F.col("k").asc_nulls_last(), "t").collect()] == want
        assert filled.columns == df.columns and "Join" not in _plan(filled)
