"""Column-level operators: roles, names, constants, casts, code lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headroom.functions.text import contains_any
from headroom.scale import as_columns

# Candidate source columns per role, first match wins.
BID_ROLES = {
    "valid_from": ["valid_from", "start_time"],
    "valid_to": ["valid_to", "end_time"],
    "area": ["domain.mRID", "in_domain.name"],
    "product": ["process_type", "type.description", "type.name"],
    "value": ["Point.quantity", "value.value"],
    "direction": ["direction.code", "direction"],
}
CAPACITY_ROLES = {
    "valid_from": ["valid_from", "utc_start"],
    "valid_to": ["valid_to", "utc_end"],
    "value": ["Point.quantity", "value.value", "quantity"],
    "out_area": ["out_domain.mRID", "TimeSeries.out_Domain.mRID"],
    "in_area": ["in_domain.mRID", "TimeSeries.in_Domain.mRID"],
}

# Market code lists (code -> name).
DIRECTIONS = {"A01": "UP", "A02": "DOWN", "A03": "UP_AND_DOWN", "A04": "STABLE"}
PRODUCTS = {"A47": "mFRR", "A51": "aFRR", "A60": "SA_mFRR", "A61": "DA_mFRR", "A67": "CA_aFRR", "A68": "LA_aFRR", "ATC": "ATC"}
PROCESSES = {
    "A07": "CAPACITY_ALLOCATION", "A14": "FORECAST", "A15": "CAPACITY_DETERMINATION", "A16": "REALISED",
    "A27": "RESERVE_RESOURCE_PROCESS", "A34": "CONTRACTED", "A37": "MODIFICATION", "A40": "INTRADAY_PROCESS",
    "A46": "REPLACEMENT_RESERVE", "A47": "MANUAL_FREQUENCY_RESTORATION_RESERVE", "A49": "INTRADAY_CAPACITY_DETERMINATION",
    "A51": "AUTOMATIC_FREQUENCY_RESTORATION_RESERVE", "A52": "FREQUENCY_CONTAINMENT_RESERVE",
    "A56": "FREQUENCY_RESTORATION_RESERVE", "A60": "SCHEDULED_ACTIVATION_MFRR", "A61": "DIRECT_ACTIVATION_MFRR",
    "A67": "CENTRAL_SELECTION_AFRR", "A68": "LOCAL_SELECTION_AFRR",
}
MESSAGES = {
    "A15": "ACQUIRING_SYSTEM_OPERATOR_RESERVE_SCHEDULE", "A24": "BID_DOCUMENT", "A26": "CAPACITY_DOCUMENT",
    "A32": "PROPOSED_CAPACITY", "A37": "RESERVE_TENDER_DOCUMENT", "A38": "RESERVE_ALLOCATION_RESULT",
    "A81": "CONTRACTED_RESERVES", "A82": "ACCEPTED_OFFERS", "A83": "ACTIVATED_BALANCING_QUANTITIES",
    "A86": "IMBALANCE_VOLUME", "A88": "CROSS_BORDER_BALANCING", "B39": "IMBALANCE_PROGNOSIS", "B45": "BID_AVAILABILITY",
}
BUSINESS_TYPES = {
    "A20": "IMBALANCE_VOLUME", "A22": "FREQUENCY_CONTROL", "A23": "BALANCE_MANAGEMENT", "A26": "AVAILABLE_TRANSFER_CAPACITY",
    "A31": "OFFERED_CAPACITY", "A95": "FREQUENCY_CONTAINMENT_RESERVE", "A96": "AUTOMATIC_FREQUENCY_RESTORATION_RESERVE",
    "A97": "MANUAL_FREQUENCY_RESTORATION_RESERVE", "A98": "REPLACEMENT_RESERVE", "B33": "AREA_CONTROL_ERROR", "B74": "OFFER",
    "B75": "NEED", "B95": "PROCURED_CAPACITY", "B96": "USED_CAPACITY", "C01": "REMAINING_CAPACITY", "C19": "CAPACITY_ALLOCATED",
    "C23": "SHARE_OF_RESERVE_CAPACITY", "C68": "PERCENTILE", "C76": "FORECASTED_CAPACITY", "C77": "MINIMUM_AVAILABLE_CAPACITY",
    "C89": "ENERGY_RESERVES",
}
# Words in a published table id -> codes.
ID_WORDS = {
    "message_type": {"VOLUMES": "A37", "PROCURED": "A15", "DEMAND": "A37", "BALANCING": "A86"},
    "business_type": {"VOLUMES": "B74", "PROCURED": "B95", "DEMAND": "B75", "BALANCING": "B33"},
    "process_type": {"RR": "A46", "BALANCING": "A16", "FCR": "A52", "AFRR": "A51", "MFRR": "A47"},
    "market_product_type": {"SA": "A05", "DA": "A07"},
}
# Activation variants counted as one product.
PRODUCT_MERGE = {"SA_mFRR": "mFRR", "DA_mFRR": "mFRR", "CA_aFRR": "aFRR", "LA_aFRR": "aFRR"}


def quoted(name: str) -> Column:
    """Column by its full name, dots included."""
    return F.col(f"`{name}`")


def resolve_roles(df: DataFrame, mapping: dict[str, str | list[str]]) -> DataFrame:
    """Project to roles: the first existing candidate column of each, case-insensitive."""
    lower = {}
    for name in df.columns:
        lower.setdefault(name.lower(), name)
    found = []
    for role, candidates in mapping.items():
        match = next((lower[c.lower()] for c in as_columns(candidates) if c.lower() in lower), None)
        if match is not None:
            found.append(quoted(match).alias(role))
    return df.select(*found)


def rename_by_mapping(df: DataFrame, mapping: dict[str, str], overwrite: bool = True) -> DataFrame:
    """Rename columns; an existing column with a new name becomes `…_2`, or is dropped if not `overwrite`."""
    renames = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    clashing = [c for c in df.columns if c in {v for k, v in mapping.items() if k != v} and c not in renames]
    columns = []
    for name in df.columns:
        if name in renames:
            columns.append(quoted(name).alias(renames[name]))
        elif name not in clashing:
            columns.append(quoted(name))
        elif overwrite:
            columns.append(quoted(name).alias(f"{name}_2"))
    return df.select(*columns)


def drop_columns(df: DataFrame, names=None, empty: bool = True) -> DataFrame:
    """Drop named and all-null columns; finding the empty ones is one aggregate over the table."""
    names = as_columns(names)
    kept = [c for c in df.columns if c not in names]
    if empty and kept:
        counts = df.agg(*[F.count(quoted(c)).alias(str(i)) for i, c in enumerate(kept)]).first()
        kept = [c for i, c in enumerate(kept) if counts[i] > 0]
    return df.select(*[quoted(c) for c in kept])


def add_constants(df: DataFrame, fields: dict, overwrite: bool = True) -> DataFrame:
    """Literal columns; without `overwrite` existing columns keep their values."""
    return df.withColumns({k: F.lit(v) for k, v in fields.items() if overwrite or k not in df.columns})


def convert_columns(df: DataFrame, kind: str = "string", included=None, excluded=None, keep_text: bool = False) -> DataFrame:
    """Cast columns chosen by name keyword (an excluded word wins); unparseable text becomes null.

    With `keep_text` such text stays beside the column, as `<name>_text` (null where the value did convert).
    """
    if included is None and excluded is None:
        return df
    included, excluded = as_columns(included), as_columns(excluded)

    def chosen(name: str) -> bool:
        lowered = name.lower()
        return (not included or any(w.lower() in lowered for w in included)) and not any(w.lower() in lowered for w in excluded)

    out = []
    for c in df.columns:
        out.append(quoted(c).try_cast(kind).alias(c) if chosen(c) else quoted(c))
        if keep_text and chosen(c):
            out.append(F.when(quoted(c).try_cast(kind).isNull(), quoted(c).cast("string")).alias(f"{c}_text"))
    return df.select(*out)


def replace_values(df: DataFrame, mapping: dict[str, dict]) -> DataFrame:
    """Replace values per column; other values stay."""
    changed = {}
    for name, values in mapping.items():
        if name in df.columns:
            pairs = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
            changed[name] = F.coalesce(F.try_element_at(pairs, F.col(name)), F.col(name))
    return df.withColumns(changed)


def decode(column: Column, codes: dict[str, str], to: str = "name", contained: bool = False) -> Column:
    """Code <-> name by a fixed list, case-insensitive; `contained` also finds them inside longer text.

    The first entry in list order that matches wins; no match gives null.
    """
    text = F.upper(column.cast("string"))
    result = None
    for code, name in codes.items():
        value = F.lit(name if to == "name" else code)
        if contained:
            test = F.contains(text, F.lit(name.upper())) | F.contains(text, F.lit(code.upper()))
        else:
            test = text.isin(name.upper(), code.upper())
        result = F.when(test, value) if result is None else result.when(test, value)
    return result


def decode_codes(df: DataFrame, column: str, codes: dict[str, str], to: str = "name", contained: bool = False, into: str | None = None) -> DataFrame:
    """Column decoded by `decode`, into `into` or in place."""
    return df.withColumn(into or column, decode(F.col(column), codes, to, contained))


def classify_id_tokens(df: DataFrame, column: str, mappings: dict[str, dict[str, str]] | None = None, delim: str = "_") -> DataFrame:
    """One column per mapping: code of the first mapping word among the id's tokens."""
    mappings = mappings or ID_WORDS
    tokens = F.split(F.upper(F.col(column)), F.lit(f"\\Q{delim}\\E"))
    return df.withColumns(
        {
            name: F.coalesce(*[F.when(F.array_contains(tokens, word.upper()), F.lit(code)) for word, code in words.items()])
            for name, words in mappings.items()
        }
    )


def infer_datetime_columns(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(column, share, is_datetime): share of non-numeric values that parse as a time, over all rows."""
    from headroom.functions.times import parse_datetime_any

    kinds = dict(df.dtypes)
    shares = []
    for name in df.columns:
        if kinds[name].startswith("timestamp") or kinds[name] == "date":
            share = F.lit(1.0)
        elif kinds[name] == "string":
            text = F.when(~quoted(name).rlike(r"^\d+$"), quoted(name))
            share = F.coalesce(F.count(parse_datetime_any(text)) / F.nullif(F.count(text), F.lit(0)), F.lit(0.0))
        else:
            share = F.lit(0.0)
        shares.append(share.alias(name))
    one_row = df.agg(F.count(F.lit(1)).alias("__rows"), *shares)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).alias("share")) for c in df.columns])
    return one_row.select(F.inline(pairs)).withColumn("is_datetime", F.col("share") >= threshold)


def keep_matching(df: DataFrame, column: str, included=None, excluded=None) -> DataFrame:
    """Rows whose text holds an included keyword and none of the excluded."""
    return df.where(contains_any(F.col(column), as_columns(included) or None, as_columns(excluded) or None))
