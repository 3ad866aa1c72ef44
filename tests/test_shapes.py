"""Values of unknown shape, long chains, label index, documents of bounded size."""

from datetime import datetime

import pytest
from plain_rows import rows
from pyspark.sql import functions as F

from headroom.operators import areas as a
from headroom.operators import columns as c
from headroom.operators import triples as tr
from headroom.scale import literal_table, scratch_path
from headroom.sources import documents as d
from headroom.sources import points as p


@pytest.mark.parametrize("parents", [1, 3, 4, 7, 10, 11, 20])
def test_ancestors_by_doubling(spark, parents):
    """A chain of 14 objects over three leaves; the nearest value of a field wins."""
    chain = [(f"n{i}", f"n{i + 1}" if i < 13 else "top") for i in range(14)]
    data = [(i, "Type", f"T{n}", up) for n, (i, up) in enumerate(chain)] + [(i, f"own{n}", str(n), up) for n, (i, up) in enumerate(chain)]
    data += [(i, "near", str(n), up) for n, (i, up) in enumerate(chain) if n % 3 == 2]
    data += [(f"leaf{j}", "Type", "Leaf", "n0") for j in range(3)] + [("lone", "Type", "Leaf", "nowhere")]
    names = [f"own{n}" for n in range(14)] + ["near"] + [f"T{n}_ID" for n in range(14)]
    found = tr.triples_to_table(spark.createDataFrame(data, "ID string, KEY string, VALUE string, PARENT_ID string"), "Leaf", parents, child=False, columns=names)
    want = {**{f"own{n}": str(n) if n < parents else None for n in range(14)}, **{f"T{n}_ID": f"n{n}" if n < parents else None for n in range(14)}}
    want["near"] = "2" if parents > 2 else None
    for row in found.where("ID <> 'lone'").collect():
        assert {k: row[k] for k in names} == want
    assert [v for k, v in found.where("ID = 'lone'").first().asDict().items() if k in names] == [None] * len(names)


def test_labels_by_rarest_characters(spark):
    areas = literal_table(spark, [("1", "Northland", "NL"), ("2", "North", "NO"), ("3", "Ås", "AS"), ("4", "Landås", "LA")], "mrid string, name string, code string")
    labels = ["the north", "NORTHLAND|x", "nl", "X-ås-", "landås", "nor", "", None, "4", "northern landås"]
    got = a.align_labels(spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, l string"), "l", areas)
    assert [r.l for r in got.orderBy("i").collect()] == ["North", "Northland", "Northland", "Ås", "Ås", "nor", "", None, "Landås", "North"]


def test_long_form_and_lists_that_are_not_asked_for(spark):
    schema = "id int, a struct<b:double, c:array<struct<d:string, e:array<int>>>>, f array<string>"
    df = spark.createDataFrame([(1, (1.5, [("x", [7, None]), ("y", None)]), ["u", None, "7"]), (2, (None, None), None), (3, None, [])], schema)
    assert rows(p.flatten_long(df, "id").select("path", "position", "value", "number")) == sorted([
        ("a.b", [], "1.5", 1.5), ("a.c.d", [1], "x", None), ("a.c.e", [1, 1], "7", 7.0), ("a.c.d", [2], "y", None), ("f", [1], "u", None), ("f", [3], "7", 7.0)], key=repr)
    assert p.list_lengths(df, ["id", "a.b"]) == {} and p.list_lengths(df, ["f.2"]) == {"f": 3}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("no-lists", "")
    assert p.flatten_nested(df, ["id", "a.b"]).columns == ["id", "a.b"]
    assert list(tracker.getJobIdsForGroup("no-lists")) == []
    spark.sparkContext.setJobGroup("", "")
    assert p.flatten_nested(df, ["f.3", "a.c.2.d"]).columns == ["a.c.2.d", "f.3"]
    assert len(p.flatten_nested(df).columns) == 1 + 1 + 2 + 4 + 3


def test_text_among_numbers_stays(spark):
    df = spark.createDataFrame([("1.5", "a"), ("n/a", "b"), (None, "c")], "v string, k string")
    assert rows(c.convert_columns(df, "double", ["v"], keep_text=True)) == sorted([(1.5, None, "a"), (None, "n/a", "b"), (None, None, "c")], key=repr)


def _result_points(spark, series, each):
    day = datetime(2024, 5, 1)
    return spark.range(series * each).select(
        (F.col("id") / each).cast("int").alias("series_id"), (F.col("id") % each + 1).cast("int").alias("position"), F.lit(2.0).alias("value"), F.lit(99.0).alias("percentage_level"),
        F.lit(day).alias("series_from"), F.lit(day).alias("series_to"), F.lit("P1D").alias("resolution"), F.lit("A97").alias("business_type"), F.lit("x").alias("domain"),
        F.lit("A01").alias("direction"), F.lit("A14").alias("process_type"), F.lit("A24").alias("message_type"), F.lit("me").alias("sender"), F.lit(1).alias("version"),
        F.lit("B").alias("block"), F.lit("you").alias("receiver"), F.lit("s").alias("spacing"), F.lit(day).alias("period_from"), F.lit(day).alias("period_to"),
    )


def test_large_key_becomes_several_documents(spark):
    kind = "ReserveBid_MarketDocument"
    points, path = _result_points(spark, 100_000, 1), scratch_path(spark, "large")
    d.write_market_xml(points, kind, path, max_points=10_000)
    back = d.read_market_xml(spark, path, kind)
    per = back.groupBy("mRID").agg(F.count("*").alias("n"), F.count_distinct("`Bid_TimeSeries.mRID`").alias("s")).collect()
    assert len(per) == 10 and all(r.n == r.s == 10_000 for r in per)
    assert back.select("`Bid_TimeSeries.mRID`").distinct().count() == 100_000


def test_unlisted_elements_come_back(spark):
    kind, path = "Publication_MarketDocument", scratch_path(spark, "odd")
    text = f"""<{kind}><mRID>doc-1</mRID><grid.note lang="xx">free text</grid.note><TimeSeries><mRID>s1</mRID><curve.kind>steep</curve.kind>
<Period><timeInterval><start>2024-05-01T00:00Z</start><end>2024-05-01T02:00Z</end></timeInterval><resolution>PT60M</resolution>
<Point><position>1</position><quantity>5.5</quantity><mood>fine</mood></Point><Point><position>2</position><quantity>withdrawn</quantity></Point></Period></TimeSeries></{kind}>"""
    spark.createDataFrame([(text,)], "value string").write.text(path)
    got = rows(d.unlisted_elements(spark, path, kind))
    assert got == [("doc-1", "TimeSeries.Period.Point.mood", [1], "fine", None), ("doc-1", "TimeSeries.curve.kind", [], "steep", None),
                   ("doc-1", "grid.note", [], "free text", None), ("doc-1", "grid.note.lang", [], "xx", None)]
    points = d.read_market_xml(spark, path, kind).orderBy("`Point.position`")
    assert [(r["Point.quantity"], r["Point.quantity.text"]) for r in points.collect()] == [(5.5, None), (None, "withdrawn")]
    every = {r.path: r.number for r in d.document_elements(spark, path, kind).collect()}
    assert every["TimeSeries.Period.Point.position"] in (1.0, 2.0) and "TimeSeries.Period.timeInterval.start" in every
