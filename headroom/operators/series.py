"""Operators on ordered time series: grids, fills, slices, positions."""

from __future__ import annotations

import functools
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headroom.functions.durations import DAY, duration_seconds, format_iso_duration, parse_iso_duration
from headroom.registry import AGGREGATES
from headroom.scale import as_columns, epoch, from_epoch, join_null_safe, literal_table, time_literal, type_of


def fill_ordered(
    df: DataFrame, columns, by=None, time: str = "valid_from", direction: str = "forward", tie=None,
    chunk: int | None = None, split: bool | None = None,
) -> DataFrame:
    """Fill nulls of `columns` with the previous (or next) non-null value in time order.

    A group is cut into chunks of `chunk` seconds.  Each chunk is filled in a
    task of its own; one summary row per chunk carries the last known value to
    the chunks after it.  `split=False` says that every group is known to be small.
    """
    by, columns, tie = as_columns(by), as_columns(columns), as_columns(tie)
    forward = direction == "forward"
    split = split is not False
    pick = F.last if forward else F.first

    def filled(keys: list[str], frame: DataFrame, *place: Column) -> DataFrame:
        window = W.partitionBy(*keys).orderBy(*place, time, *tie)
        window = (
            window.rowsBetween(W.unboundedPreceding, W.currentRow) if forward
            else window.rowsBetween(W.currentRow, W.unboundedFollowing)
        )
        return frame.withColumns({c: pick(c, ignorenulls=True).over(window) for c in columns})

    if not split:
        return filled(by, df)
    chunk = chunk or 7 * DAY
    chunked = df.withColumn("__chunk", F.floor(epoch(time) / chunk))
    order = F.struct(time, *tie)
    edge = F.max_by if forward else F.min_by
    summary = chunked.groupBy(*by, "__chunk").agg(
        *[edge(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"__edge_{c}") for c in columns]
    )
    before = W.partitionBy(*by).orderBy("__chunk" if forward else F.col("__chunk").desc()).rowsBetween(
        W.unboundedPreceding, -1
    )
    carried = summary.select(
        *by, "__chunk", *[F.last(f"__edge_{c}", ignorenulls=True).over(before).alias(f"__carry_{c}") for c in columns]
    )
    # carried values stand in front of (behind) their chunk's rows in the same window: no join, which would deal all rows anew
    rows = chunked.withColumn("__carried", F.lit(False)).unionByName(
        carried.select(*by, "__chunk", *[F.col(f"__carry_{c}").alias(c) for c in columns], F.lit(True).alias("__carried")), allowMissingColumns=True
    )
    place = F.col("__carried").desc() if forward else F.col("__carried").asc()
    return filled([*by, "__chunk"], rows, place).where("not __carried").drop("__chunk", "__carried")


def fill_missing(df: DataFrame, value: str, by=None, time: str = "valid_from", method: str | None = "ffill", **options) -> DataFrame:
    """Forward (`ffill`) or backward (`bfill`) fill per product; no method, no change."""
    if method not in ("ffill", "bfill"):
        return df
    return fill_ordered(df, value, by, time, "forward" if method == "ffill" else "backward", **options)


def time_grid(bounds: DataFrame, step: int, first: str, last: str) -> DataFrame:
    """One row per grid cell between two epoch-second columns, both included.

    Cells are emitted in two steps (day, then cell within the day) so that no
    single row has to hold the whole range of a long series.
    """
    block = step * max(1, DAY // step)
    start = F.col("__block") * block
    days = bounds.withColumn("__block", F.explode(F.sequence(F.floor(F.col(first) / block), F.floor(F.col(last) / block))))
    cells = F.sequence(F.greatest(F.col(first), start), F.least(F.col(last), start + (block - step)), F.lit(step).cast("bigint"))
    return days.withColumn("cell", F.explode(cells)).drop("__block", first, last)


def _floor_to(seconds: Column, step: int) -> Column:
    return (F.floor(seconds / F.lit(step)) * step).cast("bigint")


# Grids this coarse hold at most half a million cells per year and product, however much data
# there is, so one task per product is enough; finer grids are cut into chunks of time.
COARSE_STEP = 60


def _cells(start: Column, stop: Column, step: int) -> Column:
    """Grid cells in [start, stop); none if empty."""
    return F.when(stop > start, F.sequence(start, stop - step, F.lit(step).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))


CHUNK_CELLS = 4096


def next_in_order(df: DataFrame, column: str, chunk: int, by=None, name: str = "__next") -> DataFrame:
    """`df` with the next larger `column` (a whole number) of its group as `name`, null for the last.

    The number line is cut into chunks of `chunk`.  Inside a chunk a window finds the next value; the first value of
    each chunk, one row a chunk, is handed to the chunk before it.  So no task sees all values of a group.
    """
    by = as_columns(by)
    chunked = df.withColumn("__chunk", F.floor(F.col(column) / F.lit(chunk)))
    inside = F.lead(column).over(W.partitionBy(*by, "__chunk").orderBy(column))
    firsts = chunked.groupBy(*by, "__chunk").agg(F.min(column).alias("__first"))
    order = W.partitionBy(*(by or [F.lit(0)])).orderBy("__chunk")
    handed = firsts.select(*by, "__chunk", F.lead("__first").over(order).alias("__handed"))
    joined = join_null_safe(chunked.withColumn(name, inside), handed, [*by, "__chunk"])
    return joined.withColumn(name, F.coalesce(name, "__handed")).drop("__chunk", "__handed")


def _shared_span(df: DataFrame, low: Column, high: Column) -> tuple[Column, Column]:
    """Lowest and highest of two columns over the whole table, as scalar subqueries of one aggregate."""
    span = df.agg(F.min(low).alias("__lo"), F.max(high).alias("__hi"))
    return span.select("__lo").scalar(), span.select("__hi").scalar()


def _out(frame: DataFrame, by: list[str], time: str, end: str | None, step: int, kind: str, value: str) -> DataFrame:
    columns = [*[F.col(k) for k in by], from_epoch(F.col("cell"), kind).alias(time)]
    if end:
        columns.append(from_epoch(F.col("cell") + step, kind).alias(end))
    return frame.select(*columns, value)


def resample_ffill(
    df: DataFrame, step: str | int, value: str, by=None, time: str = "valid_from", end: str | None = "valid_to",
    tie=None, shared_range: bool = False, split: bool | None = None,
) -> DataFrame:
    """Regular grid holding the last known value at or before each grid point.

    The grid is anchored at midnight UTC (steps divide a day); points before
    the first observation stay null.  With an `end` column the last interval is
    filled up to its own end.  `shared_range` gives every product the range of
    the whole table.

    Observations are first reduced to one per product and grid point (map-side
    combine).  Each then serves the points up to the next one, so there is no
    join with a grid.  `split` cuts products into chunks of time instead (the
    default for steps under a minute).
    """
    step, by, tie = duration_seconds(step), as_columns(by), as_columns(tie)
    end = end if end in df.columns else None
    split = step < COARSE_STEP if split is None else split
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    # an observation takes effect at the first grid point not before it
    cell = (F.ceil(micros / F.lit(step * 1_000_000)) * step).cast("bigint")
    low = _floor_to(epoch(time), step)
    high = F.greatest(low, _floor_to(epoch(end), step) - step) if end else low
    known = F.when(F.col(value).isNotNull(), F.struct(time, *tie))
    latest = df.groupBy(*by, cell.alias("cell")).agg(
        F.max_by(value, known).alias(value), F.min(low).alias("__low"), F.max(high).alias("__high")
    )
    kind = type_of(df, time)
    if split:
        return _out(_ffill_chunks(latest, step, value, by, shared_range), by, time, end, step, kind, value)
    product = W.partitionBy(*by)
    ordered = product.orderBy("cell")
    if shared_range:
        first, last = _shared_span(df, low, high)
    else:
        first, last = F.min("__low").over(product), F.max("__high").over(product)
    upto = F.last(value, ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow))
    served = latest.select(
        *by, "cell", upto.alias(value), first.alias("__first"), last.alias("__last"),
        F.row_number().over(ordered).alias("__rn"), F.lead("cell").over(ordered).alias("__next"),
    )
    stop = F.coalesce(F.col("__next"), F.col("__last") + step)
    spans = F.array(
        F.struct(_cells(F.col("cell"), F.least(stop, F.col("__last") + step), step).alias("cells"), F.col(value).alias(value)),
        # points before the first observation
        F.struct(
            F.when(F.col("__rn") == 1, _cells(F.col("__first"), F.least(F.col("cell"), F.col("__last") + step), step)).alias("cells"),
            F.lit(None).cast(df.schema[value].dataType).alias(value),
        ),
    )
    points = served.select(*by, F.inline(spans)).withColumn("cell", F.explode("cells"))
    return _out(points, by, time, end, step, kind, value)


def _ffill_chunks(latest: DataFrame, step: int, value: str, by: list[str], shared: bool) -> DataFrame:
    """The same from reduced observations, with every product cut into chunks of time."""
    bounds = latest.groupBy(*by).agg(F.min("__low").alias("__first"), F.max("__high").alias("__last"))
    if shared:
        first, last = _shared_span(latest, F.col("__low"), F.col("__high"))
        bounds = bounds.withColumns({"__first": first, "__last": last})
    grid = time_grid(bounds, step, "__first", "__last").withColumns(
        {value: F.lit(None).cast(latest.schema[value].dataType), "__grid": F.lit(1)}
    )
    seen = latest.select(*by, "cell", value).withColumn("__grid", F.lit(0))
    points = grid.unionByName(seen).withColumn("__at", F.timestamp_seconds("cell"))
    return fill_ordered(points, value, by, "__at", tie="__grid", split=True).where("__grid = 1")


def resample_mean(
    df: DataFrame, step: str | int, value: str, by=None, time: str = "valid_from", end: str | None = "valid_to",
    shared_range: bool = False,
) -> DataFrame:
    """Mean per grid cell; cells without data are null."""
    return _resample_by(F.avg, df, step, value, by, time, end, shared_range)


def resample_named(df: DataFrame, how: str, step: str | int, value: str, *args, **kwargs) -> DataFrame:
    """`resample_mean` with another aggregate of the registry (`sum`, `min`, `max` …); an unknown name leaves the data as they are."""
    how = AGGREGATES.get(how)
    return df if how is None else _resample_by(how, df, step, value, *args, **kwargs)


def _resample_by(how, df: DataFrame, step: str | int, value: str, by=None, time: str = "valid_from", end: str | None = "valid_to", shared_range: bool = False) -> DataFrame:
    """One aggregate per grid cell, from a product's first cell to the end of its last interval.

    Empty cells are emitted by the cell before them, not by a join with a grid; the cell after is found chunk by
    chunk, so a product is spread over tasks at any step.
    """
    step, by = duration_seconds(step), as_columns(by)
    end = end if end in df.columns else None
    cell = _floor_to(epoch(time), step)
    high = F.greatest(cell, _floor_to(epoch(end), step) - step) if end else cell
    means = df.groupBy(*by, cell.alias("cell")).agg(how(value).alias(value), F.max(high).alias("__high"))
    bounds = means.groupBy(*by).agg(F.min("cell").alias("__start"), F.max("__high").alias("__last"))
    follows = next_in_order(means, "cell", step * CHUNK_CELLS, by)
    if by:
        spread = join_null_safe(follows, bounds, by)
    else:
        spread = follows.withColumns({c: bounds.select(c).scalar() for c in ("__start", "__last")})
    first = F.col("__start")
    if shared_range:
        first, last = _shared_span(df, cell, high)
        spread = spread.withColumn("__last", last)
    stop = F.coalesce(F.col("__next"), F.greatest(F.col("__last"), F.col("cell")) + step)
    before = F.when(F.col("cell") == F.col("__start"), _cells(first, F.col("cell"), step)).otherwise(F.array().cast("array<bigint>"))
    points = spread.withColumn("__cell", F.explode(F.concat(before, _cells(F.col("cell"), stop, step))))
    filled = points.select(*by, F.when(F.col("__cell") == F.col("cell"), F.col(value)).alias(value), F.col("__cell").alias("cell"))
    return _out(filled, by, time, end, step, type_of(df, time), value)


def min_resolution(df: DataFrame, time: str = "valid_from", end: str | None = None) -> DataFrame:
    """One row: smallest step in seconds, from interval lengths or else from gaps between times."""
    if end is not None:
        return df.agg(F.min(F.abs(epoch(end) - epoch(time))).alias("resolution"))
    # distinct times first, then gaps inside each day and between neighbouring days
    times = df.select(epoch(time).alias("t")).distinct().withColumn("day", F.floor(F.col("t") / DAY))
    inside = times.withColumn("gap", F.col("t") - F.lag("t").over(W.partitionBy("day").orderBy("t")))
    per_day = inside.groupBy("day").agg(F.min("gap").alias("gap"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    across = F.col("lo") - F.lag("hi").over(W.partitionBy(F.lit(0)).orderBy("day"))  # one row per day
    return per_day.withColumn("across", across).agg(F.min(F.least("gap", "across")).alias("resolution"))


def resample_table(df: DataFrame, step: int, value: str, by=None, time: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """As-of resample of a whole table: each grid point takes the products of the latest table time.

    Unlike `resample_ffill` a product missing at that time stays missing.  Every
    table time serves the grid points up to the next table time (the last one up
    to its own end), so rows are joined to their time once and spread from there.
    """
    by = as_columns(by)
    kind = type_of(df, time)
    # an effective cell may be shared by several times below the step: the last one serves it
    cell = F.ceil(F.unix_micros(F.col(time).cast("timestamp")) / F.lit(step * 1_000_000)) * step
    ends = F.struct(F.col(time).alias("t"), epoch(end).alias("end"))  # of equal times the longest
    times = df.groupBy(cell.cast("bigint").alias("__cell")).agg(F.max(ends).alias("__at"))
    times = times.where("__cell is not null").select("__cell", F.col("__at.t").alias("__t"), F.col("__at.end").alias("__end"))
    served = next_in_order(times, "__cell", step * CHUNK_CELLS).withColumn(
        "__next", F.coalesce("__next", F.greatest(_floor_to(F.col("__end"), step), F.col("__cell") + step))
    ).select("__t", "__cell", "__next")
    cells = F.sequence(F.col("__cell"), F.col("__next") - step, F.lit(step).cast("bigint"))
    rows = df.join(served, df[time] == F.col("__t")).drop(time, end).withColumn("__at", F.explode(cells))
    return rows.select(from_epoch(F.col("__at"), kind).alias(time), from_epoch(F.col("__at") + step, kind).alias(end), *by, value)


def align_resolutions(
    tables: list[DataFrame], value: str = "value", by=None, to: str = "lower", time: str = "valid_from", end: str = "valid_to"
) -> list[DataFrame]:
    """All tables at the finest (`lower`, as-of fill) or coarsest (`upper`, mean) step among them.

    Runs one aggregate over the tables' time columns to learn their steps.
    """
    each = [min_resolution(t, time, end) for t in tables]
    found = functools.reduce(DataFrame.unionByName, each).collect()  # one row per table
    steps = [row.resolution for row in found if row.resolution]
    if not steps:
        return tables
    step = min(steps) if to == "lower" else max(steps)
    if to == "lower":
        return [resample_table(t, step, value, by, time, end) for t in tables]
    return [resample_mean(t, step, value, by, time, end) for t in tables]


def fill_steps(
    df: DataFrame, types=None, period=("series_from", "series_to"), time=("valid_from", "valid_to"),
    resolution: str = "resolution", start=None, end=None, tie=None,
) -> DataFrame:
    """Curves given as steps: every position between series start and end, fields filled forward.

    `start`/`end` clamp the emitted range (query window); rows outside it or
    off the grid do not count, and a series without a row on the grid is a grid
    of nulls.  Rows that share a series and time are all kept.  Rows are joined
    with the grid and long series are filled in chunks.
    """
    types, tie = as_columns(types), as_columns(tie)
    first, last = time
    keys = [*period, *types]
    kind = type_of(df, first)
    fields = [c for c in df.columns if c not in keys and c not in time]
    low, high = epoch(period[0]), epoch(period[1])
    if start is not None:
        low = F.greatest(low, epoch(time_literal(start)))
    if end is not None:
        high = F.least(high, epoch(time_literal(end)))
    step = parse_iso_duration(F.min(resolution)).alias("__step")
    series = df.groupBy(*keys).agg(step).withColumns({"__low": low, "__high": high})
    grid = (
        series.where("__high - __step >= __low")
        .withColumn("__at", F.explode(F.sequence(F.col("__low"), F.col("__high") - F.col("__step"), F.col("__step"))))
        .select(*keys, from_epoch(F.col("__at"), kind).alias(first), from_epoch(F.col("__at") + F.col("__step"), kind).alias(last))
    )
    placed = join_null_safe(grid, df, [*keys, *time], "left")
    return fill_ordered(placed, fields, keys, first, tie=tie, split=True)


def double_weight(df: DataFrame, end, period: str | int, time: str = "valid_from", weight: str | None = None) -> DataFrame:
    """Rows of the last `period` before `end` (both included) once more.

    With `weight` the copy is a count in that column instead of a second row,
    which keeps the later quantile shuffle at its original size.
    """
    seconds = duration_seconds(period)
    kind = type_of(df, time)
    stop = time_literal(end, kind)
    recent = F.col(time).between(stop - F.make_dt_interval(secs=F.lit(seconds)), stop)
    copies = F.when(recent, F.lit(2)).otherwise(F.lit(1))
    if weight:
        return df.withColumn(weight, copies)
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__copy")


def time_slices(
    spark: SparkSession, valid_from: datetime, valid_to: datetime, steps: int = 1, start: str | None = None,
    end: str | None = None, zone: str = "CET",
) -> DataFrame:
    """`steps` equal slices (at least 15 minutes) of a validity period.

    `start`/`end` are wall clock times in `zone` on the first day.  Columns:
    position, valid_from, valid_to, start_time, end_time (local HH:mm:ss, end
    one second before the slice end, both null when the day is not sliced),
    period_resolution, point_resolution, number_of_points, time_zone.
    """
    from zoneinfo import ZoneInfo

    utc, local = ZoneInfo("UTC"), ZoneInfo(zone)

    def at(text: str) -> datetime:
        clock = datetime.strptime(text, "%H:%M" if text.count(":") == 1 else "%H:%M:%S").time()
        return datetime.combine(valid_from.date(), clock, local).astimezone(utc).replace(tzinfo=None)

    low = at(start) if start else valid_from.replace(tzinfo=None)
    high = at(end) if end else valid_to.replace(tzinfo=None)
    schema = (
        "position int, valid_from timestamp_ntz, valid_to timestamp_ntz, start_time string, end_time string, "
        "period_resolution string, point_resolution string, number_of_points int, time_zone string"
    )
    if low == high and steps == 1:
        rows = [(1, valid_from.replace(tzinfo=None), valid_to.replace(tzinfo=None), None, None, None, None, 1, zone)]
        return literal_table(spark, rows, schema)
    low, high = min(low, high), max(low, high)
    width = max((high - low) / steps, timedelta(minutes=15))
    rows = []
    for i in range(steps):
        begin, stop = low + i * width, low + (i + 1) * width

        def clock(moment: datetime) -> str:
            return moment.replace(tzinfo=utc).astimezone(local).strftime("%H:%M:%S")

        rows.append((
            i + 1, begin, stop, clock(begin), clock(stop - timedelta(seconds=1)),
            int((high - low).total_seconds()), int(width.total_seconds()), steps, zone,
        ))
    table = literal_table(
        spark, rows, schema.replace("period_resolution string, point_resolution string", "period_resolution long, point_resolution long")
    )
    return table.withColumns(
        {c: format_iso_duration(F.col(c)) for c in ("period_resolution", "point_resolution")}
    )


def position_times(
    df: DataFrame, start: str = "series_from", resolution: str = "resolution", position: str = "position",
    time=("valid_from", "valid_to"),
) -> DataFrame:
    """Start and end of each point from the series start, resolution and 1-based position."""
    kind = type_of(df, start)
    step = parse_iso_duration(F.col(resolution))
    before = F.greatest(F.col(position).cast("bigint") - 1, F.lit(0))
    upto = F.greatest(F.col(position).cast("bigint"), F.lit(0))
    return df.withColumns(
        {time[0]: from_epoch(epoch(start) + before * step, kind), time[1]: from_epoch(epoch(start) + upto * step, kind)}
    )


def series_bounds(
    df: DataFrame, position: str = "position", resolution: str = "resolution", points: str = "number_of_points",
    time=("valid_from", "valid_to"), series=("series_from", "series_to"),
) -> DataFrame:
    """Fill in what is missing of series start/end, point start/end, resolution and point count."""
    names = set(df.columns)
    kind = type_of(df, time[0]) if time[0] in names else type_of(df, series[0])

    def have(name: str, cast: str) -> Column:
        return F.col(name) if name in names else F.lit(None).cast(cast)

    place = F.coalesce(F.col(position).cast("bigint"), F.lit(1))
    step = F.coalesce(
        parse_iso_duration(have(resolution, "string")), epoch(have(time[1], kind)) - epoch(have(time[0], kind))
    )
    low = F.coalesce(epoch(have(series[0], kind)), epoch(have(time[0], kind)) - F.greatest(place - 1, F.lit(0)) * step)
    count = F.coalesce(
        have(points, "int").cast("bigint"), F.floor((epoch(have(series[1], kind)) - low) / step), F.lit(1).cast("bigint")
    )
    high = F.coalesce(epoch(have(series[1], kind)), low + count * step)
    begin = F.coalesce(epoch(have(time[0], kind)), low + (place - 1) * step)
    return df.withColumns(
        {
            "__low": low, "__high": high, "__begin": begin, "__count": count,
            "__stop": F.coalesce(epoch(have(time[1], kind)), begin + step), "__res": format_iso_duration(step),
        }
    ).withColumns(
        {
            series[0]: from_epoch(F.col("__low"), kind), series[1]: from_epoch(F.col("__high"), kind),
            time[0]: from_epoch(F.col("__begin"), kind), time[1]: from_epoch(F.col("__stop"), kind),
            points: F.col("__count").cast("int"), resolution: F.coalesce(have(resolution, "string"), F.col("__res")),
        }
    ).drop("__low", "__high", "__begin", "__count", "__stop", "__res")


def refine_points(
    df: DataFrame, receivers: DataFrame, position: str = "position", resolution: str = "resolution",
    receiver_resolution: str = "output_resolution", key: str = "receiver",
) -> DataFrame:
    """Points repeated for receivers that want a finer resolution, renumbered from 1.

    A receiver without a resolution, or one not at least twice as fine, gets
    the points as they are.
    """
    # the wanted step is read once a receiver, the own one once a point
    wanted = receivers.withColumn("__wanted", parse_iso_duration(F.col(receiver_resolution)))
    steps = df.join(wanted, key, "left").withColumn("__own", parse_iso_duration(F.col(resolution)))
    times = F.floor(F.col("__own") / F.col("__wanted"))
    scale = F.when((F.col("__own") > F.col("__wanted")) & (times >= 2), times).otherwise(1)
    return (
        steps.withColumn("__scale", scale.cast("int")).drop("__own", "__wanted")
        .withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__scale"))))
        .withColumns(
            {
                position: ((F.col(position) - 1) * F.col("__scale") + F.col("__i")).cast("int"),
                resolution: F.when(F.col("__scale") > 1, F.col(receiver_resolution)).otherwise(F.col(resolution)),
            }
        )
        .drop("__scale", "__i", receiver_resolution)
    )


def period_bounds(df: DataFrame, now: str = "now") -> DataFrame:
    """Validity and data periods from `now` and ISO durations.

    Input columns (text, may be null): valid_offset, valid_delta, shift,
    data_offset, data_delta.  The validity period spans `valid_delta` around
    now − valid_offset (a negative delta reaches forward).  With `shift` the
    data period is coupled to the validity period, else it ends at
    now − data_offset; it spans `data_delta`, 60 days by default.
    """
    kind = type_of(df, now)
    zero = F.lit(0).cast("bigint")

    def seconds(name: str, default: int | None = None) -> Column:
        return F.coalesce(parse_iso_duration(F.col(name)), F.lit(default).cast("bigint") if default is not None else zero)

    anchor = epoch(now) - seconds("valid_offset")
    other = anchor - seconds("valid_delta", DAY)
    valid_from, valid_to = F.least(anchor, other), F.greatest(anchor, other)
    coupled = F.coalesce(parse_iso_duration(F.col("data_offset")), parse_iso_duration(F.col("shift")), zero)
    base = F.when(F.col("shift").isNotNull(), F.col("__to")).otherwise(epoch(now))
    return (
        df.withColumns({"__from": valid_from, "__to": valid_to})
        .withColumn("__end", base - coupled)
        .withColumn("__start", F.col("__end") - seconds("data_delta", 60 * DAY))
        .withColumns(
            {
                "valid_from": from_epoch(F.col("__from"), kind), "valid_to": from_epoch(F.col("__to"), kind),
                "data_from": from_epoch(F.col("__start"), kind), "data_to": from_epoch(F.col("__end"), kind),
            }
        )
        .drop("__from", "__to", "__end", "__start")
    )


def point_resolution(df: DataFrame, start: str = "series_from", end: str = "series_to", points: str = "number_of_points") -> DataFrame:
    """Adds `point_resolution`: (end − start) / points as ISO duration."""
    size = F.floor((epoch(end) - epoch(start)) / F.nullif(F.col(points), F.lit(0)))
    return df.withColumn("point_resolution", format_iso_duration(size))
