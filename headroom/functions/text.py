"""Text and array column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_subsequence(items: Column, lookup: Column) -> Column:
    """True when `items` occur in `lookup` in order, gaps allowed."""
    size = F.size(items)
    matched = F.aggregate(
        lookup,
        F.lit(0),
        lambda done, value: F.when((done < size) & (F.try_element_at(items, done + 1) == value), done + 1).otherwise(done),
    )
    return matched >= size


def contiguous_substrings(items: Column, lookup: Column) -> Column:
    """True when some run of `lookup` holds the `items` one by one as substrings."""
    starts = F.when(F.size(lookup) >= F.size(items), F.sequence(F.lit(0), F.size(lookup) - F.size(items)))
    hit = F.exists(
        starts,
        lambda start: F.forall(
            F.sequence(F.lit(1), F.size(items)),
            lambda i: F.contains(F.try_element_at(lookup, start + i), F.try_element_at(items, i)),
        ),
    )
    return F.when(F.size(items) == 0, F.lit(True)).otherwise(F.coalesce(hit, F.lit(False)))


def contains_any(text: Column, included: list[str] | None = None, excluded: list[str] | None = None) -> Column:
    """Case-insensitive keyword test; an excluded word wins over an included one."""
    lowered = F.lower(text)

    def any_of(words: list[str]) -> Column:
        return F.exists(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.contains(lowered, w))

    keep = any_of(included) if included else F.lit(True)
    return keep & ~any_of(excluded) if excluded else keep


def strip_direction_words(label: Column, words: list[str], replacement: str = ".") -> Column:
    """Label with each keyword replaced: labels that become equal belong together."""
    for word in words:
        label = F.regexp_replace(label, re.escape(word), replacement)
    return label


def order_label_words(parts: Column, words: list[str]) -> Column:
    """Label parts with the keyword parts merged, in keyword order, at the first keyword place."""
    keys = F.array(*[F.lit(w) for w in words])
    lowered = F.transform(keys, F.lower)

    def has_word(part: Column) -> Column:
        return F.exists(lowered, lambda w: F.contains(F.lower(part), w))

    found = F.filter(keys, lambda w: F.exists(parts, lambda p: F.contains(F.lower(p), F.lower(w))))
    flags = F.transform(parts, has_word)
    first = F.array_position(flags, F.lit(True)).cast("int")
    plain = F.filter(parts, lambda p: ~has_word(p))
    merged = F.concat(
        F.slice(plain, F.lit(1), F.greatest(first - 1, F.lit(0))),
        F.array(F.array_join(found, "_")),
        F.slice(plain, F.greatest(first, F.lit(1)), F.greatest(F.size(plain) - first + 1, F.lit(0))),
    )
    return F.when(first > 0, merged).otherwise(parts)
