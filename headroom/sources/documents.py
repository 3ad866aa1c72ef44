"""Market documents in XML: reading, checking, writing.

A document is one row (row tag = document type); its series, periods and
points are exploded with built-in generators.  Field names are dotted paths:
`TimeSeries.mRID`, `Period.resolution`, `Point.quantity`; an attribute is one
more part, e.g. `domain.mRID.codingScheme`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.functions.durations import parse_iso_duration
from headroom.functions.times import format_utc, parse_datetime_any
from headroom.operators.columns import quoted
from headroom.scale import as_columns, epoch

# Document types with the name of their series element and of their period element.
DOCUMENT_TYPES = {
    "ReserveBid_MarketDocument": ("Bid_TimeSeries", "reserveBid_Period.timeInterval"),
    "Capacity_MarketDocument": ("TimeSeries", "period.timeInterval"),
    "MeritOrderList_MarketDocument": ("TimeSeries", "period.timeInterval"),
    "Balancing_MarketDocument": ("TimeSeries", "period.timeInterval"),
    "ReserveAllocationResult_MarketDocument": ("TimeSeries", "reserveBid_Period.timeInterval"),
    "Publication_MarketDocument": ("TimeSeries", "period.timeInterval"),
}

_INTERVAL = "struct<start:string,end:string>"
_CODED = "struct<_codingScheme:string,_VALUE:string>"
_NUMBERS = ("quantity", "secondaryQuantity", "price.amount")  # of a point; read as text, so that none is lost
_POINT = f"struct<position:int,{','.join(f'`{n}`:string' for n in _NUMBERS)}>"
_REASONS = "array<struct<code:string,text:string>>"
_PERIOD = f"array<struct<timeInterval:{_INTERVAL},resolution:string,Point:array<{_POINT}>>>"
_SERIES_TEXT = (
    "mRID", "businessType", "auction.mRID", "auction.type", "contract_MarketAgreement.type", "marketAgreement.type",
    "quantity_Measurement_Unit.name", "measurement_Unit.name", "price_Measurement_Unit.name", "secondary_Measurement_Unit.name",
    "currency_Unit.name", "divisible", "flowDirection.direction", "curveType", "product", "exclusiveBidsIdentification",
    "classificationSequence_AttributeInstanceComponent.position", "standard_MarketProduct.marketProductType",
    "bid_Original_MarketDocument.mRID", "bid_Original_MarketDocument.revisionNumber", "bid_Original_MarketDocument.bid_BidTimeSeries.mRID",
)
_SERIES_CODED = ("acquiring_Domain.mRID", "connecting_Domain.mRID", "in_Domain.mRID", "out_Domain.mRID", "area_Domain.mRID")
_DOC_TEXT = (
    "mRID", "revisionNumber", "type", "process.processType", "sender_MarketParticipant.marketRole.type",
    "receiver_MarketParticipant.marketRole.type", "createdDateTime",
)
_DOC_CODED = ("sender_MarketParticipant.mRID", "receiver_MarketParticipant.mRID", "domain.mRID")


def document_schema(doc_type: str) -> T.StructType:
    """Explicit schema of a document type: no inference pass over the corpus."""
    series, interval = DOCUMENT_TYPES.get(doc_type, ("TimeSeries", "period.timeInterval"))
    inner = ",".join([*[f"`{n}`:string" for n in _SERIES_TEXT], *[f"`{n}`:{_CODED}" for n in _SERIES_CODED], f"Reason:{_REASONS}", f"Period:{_PERIOD}"])
    outer = ",".join(
        [*[f"`{n}` string" for n in _DOC_TEXT], *[f"`{n}` {_CODED}" for n in _DOC_CODED], f"`{interval}` {_INTERVAL}",
         "docStatus struct<value:string>", f"Reason {_REASONS}", f"`{series}` array<struct<{inner}>>"]
    )
    return T._parse_datatype_string(outer)


def _leaves(column: Column, kind: T.DataType, name: str, skip: str | None = None) -> list[tuple[str, Column]]:
    """Fields of a struct with their dotted names, but for the `skip` field; what repeats (reasons) stays an array."""
    if isinstance(kind, T.StructType):
        found = []
        for field in kind.fields:
            if field.name == skip:
                continue
            if field.name == "_VALUE":
                path = name
            else:
                path = ".".join(p for p in (name, field.name.removeprefix("_")) if p)
            found += _leaves(column.getField(field.name), field.dataType, path)
        return found
    return [(name, column)]


def _field(kind: T.StructType, ending: str) -> T.StructField:
    return next(f for f in kind.fields if f.name.endswith(ending))


def _as_array(kind: T.DataType) -> tuple[T.DataType, bool]:
    return (kind.elementType, True) if isinstance(kind, T.ArrayType) else (kind, False)


def points_from_documents(df: DataFrame, doc_type: str, document: str | None = None) -> DataFrame:
    """One row per Point of parsed documents (columns of `df`, or the struct column `document`).

    Adds `document_type`, `utc_start` and `utc_end`.  A point's numbers are
    doubles; a text that is none stands beside them as `<name>.text`.  A document
    field whose name differs from an inner one in case only gets `document.` in front.
    """
    if document is None:
        df = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("__doc"))
    else:
        df = df.select(F.col(document).alias("__doc"))
    doc_kind = df.schema["__doc"].dataType
    series_name = _field(doc_kind, "TimeSeries").name
    frame, parent, kind, name = df, "__doc", doc_kind, ""
    steps = ((series_name, "__series"), ("Period", "__period"), ("Point", "__point"))
    names: list[str] = []

    def taken(parent: str, kind: T.DataType, name: str, skip: str | None = None) -> list[Column]:
        """Fields of a level under numbers, as their names may clash; `names` keeps them."""
        found = _leaves(F.col(parent), kind, name, skip)
        names.extend(n for n, _ in found)
        return [c.alias(f"__c{len(names) - len(found) + i}") for i, (_, c) in enumerate(found)]

    for child, column in steps:
        inner, repeated = _as_array(_field(kind, child).dataType)
        value = F.col(parent).getField(child)
        # the fields of a level are taken out of it before its children are unfolded: no row carries the whole document
        kept = [quoted(c) for c in frame.columns if c != parent]
        # outer, then without nulls: for a plain explode Catalyst puts a filter on the list's size, and with it a parse of the text, below
        frame = frame.select(*kept, *taken(parent, kind, name, child), (F.explode_outer(value) if repeated else value).alias(column))
        frame = frame.where(F.col(column).isNotNull()) if repeated else frame
        if child == "Period":  # times are parsed once a period, not once a point
            frame = frame.withColumns({
                "__start": epoch(parse_datetime_any(F.col("__period.timeInterval.start"))), "__step": parse_iso_duration(F.col("__period.resolution")),
            })
        parent, kind, name = column, inner, child
    rows = frame.select("*", *taken(parent, kind, name)).drop(parent)
    later = {n.lower(): i for i, n in enumerate(names)}  # names that differ in case only: the outer one is the document's
    clear = [f"document.{n}" if later[n.lower()] != i else n for i, n in enumerate(names)]
    rows = rows.select(F.lit(doc_type).alias("document_type"), *[F.col(f"__c{i}").alias(n) for i, n in enumerate(clear)], "__start", "__step")
    start, step, place = F.col("__start"), F.col("__step"), quoted("Point.position").cast("bigint")
    texts = [f"Point.{n}" for n in _NUMBERS if f"Point.{n}" in rows.columns and isinstance(rows.schema[f"Point.{n}"].dataType, T.StringType)]
    added = {f"{n}.text": F.when(quoted(n).try_cast("double").isNull(), quoted(n)) for n in texts}
    return rows.withColumns(
        {
            **added,
            "utc_start": F.timestamp_seconds(start + F.greatest(place - 1, F.lit(0)) * step),
            "utc_end": F.timestamp_seconds(start + F.greatest(place, F.lit(0)) * step),
        }
    ).withColumns({n: quoted(n).try_cast("double") for n in texts}).drop("__start", "__step")


DEPTH = 10  # levels of elements, lists included


def document_elements(spark: SparkSession, path: str, doc_type: str, depth: int = DEPTH) -> DataFrame:
    """Every element and attribute of the documents, whatever the schema names: (document, path, position, value, number).

    `document` is the document's mRID, `path` is dotted like the columns of the points, `position` counts repeated
    elements from 1 on the way down.  `value` is the text (a text that reads as a number is that number's), `number` its
    number or null.  One pass: documents are read as VARIANT and unfolded level by level with built-in generators.
    """
    documents = spark.read.format("xml").option("rowTag", doc_type).option("singleVariantColumn", "doc").load(path)
    none = F.array().cast("array<int>")
    rows = documents.select(F.try_variant_get("doc", "$.mRID", "string").alias("document"), F.lit("").alias("path"), none.alias("position"), F.col("doc").alias("value"))
    for _ in range(depth):
        inner = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("value").outer()).toDF("__at", "__key", "__inner"))
        name = F.when(F.col("__key") == "_VALUE", "").otherwise(F.concat(F.lit("."), F.regexp_replace("__key", "^_", "")))
        rows = inner.select(
            "document", F.when(F.col("__key").isNotNull(), F.concat("path", name)).otherwise(F.col("path")).alias("path"),
            F.when(F.col("__at").isNotNull() & F.col("__key").isNull(), F.concat("position", F.array(F.col("__at") + 1))).otherwise(F.col("position")).alias("position"),
            F.when(F.col("__at").isNull(), F.col("value")).otherwise(F.col("__inner")).alias("value"),  # a plain value stays as it is
        )
    return rows.select(
        "document", F.substring("path", 2, 1_000_000).alias("path"), "position",
        F.try_variant_get("value", "$", "string").alias("value"), F.try_variant_get("value", "$", "double").alias("number"),
    )


def schema_paths(schema: T.StructType) -> list[str]:
    """Dotted paths of a schema's leaves, lists without their positions."""
    found = []

    def walk(kind: T.DataType, name: str) -> None:
        if isinstance(kind, T.ArrayType):
            walk(kind.elementType, name)
        elif isinstance(kind, T.StructType):
            for field in kind.fields:
                walk(field.dataType, name if field.name == "_VALUE" else ".".join(p for p in (name, field.name.removeprefix("_")) if p))
        else:
            found.append(name)

    walk(schema, "")
    return found


def unlisted_elements(spark: SparkSession, path: str, doc_type: str, schema: T.StructType | None = None) -> DataFrame:
    """The elements that the schema of the document type does not name, which `read_market_xml` leaves out."""
    return document_elements(spark, path, doc_type).where(~F.col("path").isin(schema_paths(schema or document_schema(doc_type))))


def read_market_xml(spark: SparkSession, path: str, doc_type: str, schema: T.StructType | None = None) -> DataFrame:
    """Corpus of market documents -> one row per Point with its period, series and document fields."""
    documents = spark.read.format("xml").option("rowTag", doc_type).schema(schema or document_schema(doc_type)).load(path)
    return points_from_documents(documents, doc_type)


def parse_market_xml(df: DataFrame, payload: str, doc_type: str, schema: T.StructType | None = None) -> DataFrame:
    """The same for documents held as text in a column (e.g. messages)."""
    kind = schema or document_schema(doc_type)
    parsed = df.select(F.from_xml(F.col(payload), kind, {"rowTag": doc_type}).alias("doc"))
    return points_from_documents(parsed, doc_type, "doc")  # a document that does not parse has no series to explode


def validate_market_xml(spark: SparkSession, path: str, xsd: str, doc_type: str, schema: T.StructType | None = None) -> DataFrame:
    """Documents flagged by an XSD: columns of the document, `valid`, and the text of the invalid ones.

    The schema file must be readable on every executor (ship it with `--files`
    or `SparkContext.addFile`).
    """
    kind = schema or document_schema(doc_type)
    with_bad = T.StructType([*kind.fields, T.StructField("_corrupt_record", T.StringType())])
    documents = (
        spark.read.format("xml").option("rowTag", doc_type).option("rowValidationXSDPath", xsd)
        .option("columnNameOfCorruptRecord", "_corrupt_record").schema(with_bad).load(path)
    )
    return documents.withColumn("valid", F.col("_corrupt_record").isNull())


def _coded(column: Column, scheme: str = "A01") -> Column:
    return F.struct(F.lit(scheme).alias("_codingScheme"), column.cast("string").alias("_VALUE"))


MAX_POINTS = 50_000


def _numbered_parts(series: DataFrame, totals: DataFrame, order: list[str], weight: str, limit: int) -> DataFrame:
    """`series` with `__part`: the running total of `weight` within `__group`, cut every `limit`.

    Series are dealt by a hash into chunks (`__chunk`): totals run inside a chunk, and `totals`, the chunks' own
    (`__total`, at most 1024 a group), are added up; no task sees a whole group, and a series is not moved for it.
    """
    running = W.partitionBy("__group", "__chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy("__group").orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = totals.withColumn("__base", F.coalesce(F.sum("__total").over(before), F.lit(0))).drop("__total")
    placed = series.withColumn("__run", F.sum(weight).over(running) - F.col(weight)).join(chunks, ["__group", "__chunk"])
    return placed.withColumn("__part", F.floor((F.col("__run") + F.col("__base")) / F.lit(limit)).cast("int")).drop("__run", "__base")


def market_documents(
    df: DataFrame, doc_type: str, keys=("receiver", "spacing", "period_from", "period_to"), max_points: int = MAX_POINTS
) -> DataFrame:
    """Result points -> one document struct per receiver, spacing and validity period.

    A group of more than `max_points` points becomes several documents, numbered
    in their ids from the second on; a series stays whole.

    Points need: series_id, position, value, percentage_level, series_from,
    series_to, resolution, business_type, and domain + direction (bids) or
    out_domain + in_domain (capacity); process_type, message_type, sender,
    version, block.  Quantities are rounded to one decimal and sorted by
    position.  A group is one calculation result: products × levels × slices.
    """
    keys = as_columns(keys)
    series_tag, interval_tag = DOCUMENT_TYPES[doc_type]
    bids = "domain" in df.columns
    place = ["domain", "direction"] if bids else ["out_domain", "in_domain"]
    head = ["process_type", "message_type", "sender", "block"]
    point = F.struct(
        F.col("position").cast("int").alias("position"), F.round("value", 1).alias("quantity"),
        F.round("percentage_level", 1).alias("secondaryQuantity"),
    )
    group, own = [*keys, *head], ["series_id", "series_from", "series_to", "resolution", "business_type", *place]
    # a struct of the group equals another whose fields are null in the same places, so plain joins and shuffles meet it
    dealt = df.where("value is not null").withColumns(
        {"__group": F.struct(*group), "__chunk": F.pmod(F.xxhash64(*own), F.lit(1024)).cast("int")}
    ).drop(*group)
    series = dealt.repartition("__group", "__chunk").groupBy("__group", "__chunk", *own).agg(
        F.array_sort(F.collect_list(point)).alias("__points"), F.max("version").alias("version")
    ).withColumn("__weight", F.size("__points"))
    totals = dealt.groupBy("__group", "__chunk").agg(F.count("*").alias("__total"))
    series = _numbered_parts(series, totals, own, "__weight", max_points)

    def body(one: Column) -> Column:
        def of(name: str) -> Column:
            return one.getField(name).alias(name)

        interval = F.struct(format_utc(of("series_from")).alias("start"), format_utc(of("series_to")).alias("end"))
        ends = (
            [_coded(F.col("block")).alias("acquiring_Domain.mRID"), _coded(of("domain")).alias("connecting_Domain.mRID"),
             F.lit("MAW").alias("quantity_Measurement_Unit.name"), F.lit("P1").alias("price_Measurement_Unit.name"),
             F.lit("A01").alias("divisible"), of("direction").alias("flowDirection.direction")]
            if bids else
            [_coded(of("in_domain")).alias("in_Domain.mRID"), _coded(of("out_domain")).alias("out_Domain.mRID"),
             F.lit("MAW").alias("measurement_Unit.name"), F.lit("P1").alias("secondary_Measurement_Unit.name")]
        )
        period = F.struct(interval.alias("timeInterval"), of("resolution"), of("__points").alias("Point"))
        return F.struct(
            of("series_id").cast("string").alias("mRID"), of("business_type").alias("businessType"), *ends,
            F.lit("A02").alias("curveType"), period.alias("Period"),
        )

    # the body is made after the shuffle: what is equal in all series is not moved
    documents = series.groupBy("__group", "__part").agg(F.collect_list(F.struct(*own, "__points")).alias("__series"), F.max("version").alias("version"))
    documents = documents.select(*[F.col("__group").getField(c).alias(c) for c in group], "__part", "__series", "version")
    documents = documents.withColumn("__series", F.array_sort(F.transform("__series", body)))
    whole = F.struct(format_utc(F.col("period_from")).alias("start"), format_utc(F.col("period_to")).alias("end"))
    identity = F.concat_ws("_", F.lit("from"), format_utc(F.col("period_from")), F.lit("to"), format_utc(F.col("period_to")), "spacing", "block",
                           F.when(F.col("__part") > 0, F.concat(F.lit("part"), F.col("__part") + 1)))
    return documents.select(
        *keys,
        F.struct(
            identity.alias("mRID"), F.col("version").cast("string").alias("revisionNumber"), F.col("message_type").alias("type"),
            F.col("process_type").alias("process.processType"), _coded(F.col("sender")).alias("sender_MarketParticipant.mRID"),
            _coded(F.col("receiver")).alias("receiver_MarketParticipant.mRID"), whole.alias(interval_tag),
            _coded(F.col("block")).alias("domain.mRID"), F.col("__series").alias(series_tag),
        ).alias("document"),
    )


def document_text(documents: DataFrame, doc_type: str) -> DataFrame:
    """Document structs as XML text, without white space between the elements."""
    return documents.withColumn("document", F.to_xml("document", {"rowTag": doc_type, "indent": ""}))


FILE_POINTS = 2_000_000  # of a file, which one task reads; documents of `max_points` points are counted


def write_documents(documents: DataFrame, doc_type: str, path: str, mode: str = "append", max_points: int = MAX_POINTS, compression: str | None = None) -> None:
    """Write document structs below `path`, one folder per receiver, in files of bounded size."""
    kind = documents.schema["document"].dataType
    rows = documents.select(
        F.col("receiver").alias("to"), *[F.col("document").getField(f.name).alias(f.name) for f in kind.fields]
    )
    options = {"rowTag": doc_type, "rootTag": f"{doc_type}s", "indent": "", "maxRecordsPerFile": max(1, FILE_POINTS // max_points)}
    options |= {"compression": compression} if compression else {}
    rows.write.format("xml").options(**options).partitionBy("to").mode(mode).save(path)


def write_market_xml(
    df: DataFrame, doc_type: str, path: str, mode: str = "append", max_points: int = MAX_POINTS, compression: str | None = None
) -> None:
    """Write result points as documents of bounded size below `path`, one folder per receiver."""
    write_documents(market_documents(df, doc_type, max_points=max_points), doc_type, path, mode, max_points, compression)
