"""Triples (ID, KEY, VALUE, PARENT_ID) to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headroom.scale import cut_lineage, drop_scratch


def triples_roots(triples: DataFrame) -> DataFrame:
    """Parent ids that are no one's id."""
    parents = triples.select("PARENT_ID").where("PARENT_ID is not null").distinct()
    return parents.join(triples.select(F.col("ID").alias("PARENT_ID")).distinct(), "PARENT_ID", "left_anti")


def _objects(triples: DataFrame) -> DataFrame:
    """One row per object: its type, parent and a map of its fields (the first value of a repeated key)."""
    pairs = F.map_from_entries(
        F.array_sort(F.collect_set(F.struct("KEY", "VALUE")))
    )
    first = triples.groupBy("ID", "KEY").agg(F.min("VALUE").alias("VALUE"), F.min("PARENT_ID").alias("PARENT_ID"))
    return first.groupBy("ID").agg(
        F.min("PARENT_ID").alias("PARENT_ID"), F.max(F.when(F.col("KEY") == "Type", F.col("VALUE"))).alias("__type"), pairs.alias("__fields")
    )


def _joined(near: DataFrame, far: DataFrame) -> DataFrame:
    """`near` (ID, __up, __all) continued by the object its `__up` names: nearer fields win."""
    above = far.select(F.col("ID").alias("__id"), F.col("__up").alias("__next"), F.col("__all").alias("__far"))
    fresh = F.map_filter(F.col("__far"), lambda k, _: ~F.map_contains_key(F.col("__all"), k))
    found = F.col("__id").isNotNull()
    return near.join(above, F.col("__up") == F.col("__id"), "left").select(
        "ID", F.when(found, F.col("__next")).alias("__up"), F.when(found, F.map_concat("__all", fresh)).otherwise(F.col("__all")).alias("__all")
    )


def _ancestor_fields(inner: DataFrame, levels: int) -> DataFrame:
    """(ID, __all): fields of an object and its ancestors, `levels` objects in all, nearest first.

    By pointer doubling: a table that spans 1, 2, 4, 8 … objects upward is made
    by joining the one before with itself, and the spans that add up to `levels`
    are put together; ten levels take four joins, and none is made beyond the
    highest tree.  Works on objects that are someone's parent only: far fewer
    than the leaves, and unique by id, so no join has a hot key on both sides.
    """
    own = F.when(
        F.col("__type").isNotNull(), F.map_concat(
            F.col("__fields"), F.map_from_arrays(F.array(F.concat("__type", F.lit("_ID"))), F.array("ID"))
        )
    ).otherwise(F.col("__fields"))
    span = cut_lineage(inner.select("ID", F.col("PARENT_ID").alias("__up"), own.alias("__all")))
    written, reached, rest = [span], None, levels
    while rest:
        if rest & 1:
            reached = span if reached is None else _joined(reached, span)
        rest >>= 1
        if rest:
            span = cut_lineage(_joined(span, span))
            written.append(span)
            if span.where("__up is not null").isEmpty():  # every chain has ended: this span holds all
                reached = span
                break
    result = cut_lineage(reached.select("ID", "__all"))
    for table in written:
        drop_scratch(table)
    return result


def triples_to_table(
    triples: DataFrame, kind: str, parents: int = 10, child: bool = True, columns: list[str] | None = None
) -> DataFrame:
    """One row per object of type `kind` with its own, its ancestors' and its direct children's fields.

    An own field wins over an ancestor's, a nearer ancestor over a farther one,
    and both over a child's.  Also gives `<Type>_ID` of each ancestor and child
    and `<kind>_PARENT_ID`.  `columns` lists the output fields; without it one
    job finds them (a dictionary of field names).
    """
    objects = _objects(triples)
    wanted = objects.where(F.col("__type") == kind)
    result = wanted.select("ID", "PARENT_ID", F.col("__fields").alias("__all"))
    if parents > 0:
        inner = objects.join(triples.select(F.col("PARENT_ID").alias("ID")).distinct(), "ID", "left_semi")
        above = _ancestor_fields(inner, parents).select(F.col("ID").alias("__pid"), F.col("__all").alias("__above"))
        fresh = F.map_filter(F.col("__above"), lambda k, _: ~F.map_contains_key(F.col("__all"), k))
        # one parent may own most objects: the parent side is unique, and adaptive execution splits the object side
        result = result.join(above, F.col("PARENT_ID") == F.col("__pid"), "left").select(
            "ID", "PARENT_ID", F.when(F.col("__pid").isNotNull(), F.map_concat("__all", fresh)).otherwise(F.col("__all")).alias("__all")
        )
    if child:
        # first value per key over the children: reduced before it is shuffled
        kids = objects.select(F.col("PARENT_ID").alias("__of"), "ID", "__type", "__fields")
        typed = F.when(F.col("__type").isNotNull(), F.array(F.struct(F.concat("__type", F.lit("_ID")).alias("key"), F.col("ID").alias("value"))))
        entries = F.concat(F.map_entries("__fields"), F.coalesce(typed, F.expr("cast(array() as array<struct<key:string,value:string>>)")))
        owners = wanted.select(F.col("ID").alias("__of"))
        below = (
            kids.join(owners, "__of", "left_semi").select("__of", F.explode(entries).alias("e"))
            .groupBy("__of", "e.key").agg(F.min("e.value").alias("value"))
            .groupBy("__of").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("__below"))
        )
        fresh = F.map_filter(F.col("__below"), lambda k, _: ~F.map_contains_key(F.col("__all"), k))
        result = result.join(below, F.col("ID") == F.col("__of"), "left").select(
            "ID", "PARENT_ID", F.when(F.col("__of").isNotNull(), F.map_concat("__all", fresh)).otherwise(F.col("__all")).alias("__all")
        )
    if columns is None:
        names = result.select(F.explode(F.map_keys("__all")).alias("k")).distinct()
        columns = sorted(r.k for r in names.collect())  # field names: a small dictionary
    picked = [F.try_element_at("__all", F.lit(c)).alias(c) for c in columns if c != "ID"]
    return result.select("ID", F.col("PARENT_ID").alias(f"{kind}_PARENT_ID"), *picked)
