"""String helpers whose white space is Unicode's, as Python's str.strip and str.split have it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def utrim(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse_spaces(text: Column) -> Column:
    return utrim(F.regexp_replace(text, r"(?U)\s+", " "))


def is_blank(text: Column) -> Column:
    """True for null and for white space only."""
    return F.coalesce(~text.rlike(r"(?U)\S"), F.lit(True))


def nonblank_parts(text: Column, separator: str) -> Column:
    """The text split at a literal separator, trimmed, without blanks."""
    return F.filter(F.transform(F.split(text, _literal(separator)), utrim), lambda part: part != "")


def _literal(text: str) -> str:
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def ordered_join(items: Column, separator: str) -> Column:
    """Join the second fields of an array of (order, text) structs, in order."""
    return F.array_join(F.transform(F.array_sort(items), lambda x: x[1]), separator)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body names it within functions of arrays."""
    return F.get(F.transform(F.array(value), body), 0)


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """The key's value, else the key itself."""
    if not mapping:
        return key
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, key), key)


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value. The parser takes a value with anything behind it, so the text is tried
    within an array and within an object: what follows a value breaks one of them."""
    within = lambda before, after: F.try_parse_json(F.concat(F.lit(before), text, F.lit(after))).isNotNull()
    return (utrim(text) != "") & within("[", "]") & within('{"v":', "}")


def one_of(values: Sequence[str], column: Column) -> Column:
    return F.coalesce(column.isin(*values), F.lit(False))


def canonical_map(attributes: Column) -> Column:
    """A map's entries in key order, so that equal maps compare equal."""
    return F.array_sort(F.map_entries(attributes))


def map_text(attributes: Column) -> Column:
    """`key=value` pairs in key order, joined by `;`."""
    return F.array_join(F.transform(canonical_map(attributes), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))), ";")


def without_keys(attributes: Column, keys: Sequence[str]) -> Column:
    return F.map_filter(attributes, lambda k, v: ~k.isin(*keys))


def overlay(old: Column, new: Column) -> Column:
    """Entries of new over those of old; entries of new with a null value remove the key."""
    names = F.map_keys(new)
    kept = F.map_filter(old, lambda k, v: ~F.array_contains(names, k))
    return F.map_filter(F.map_concat(kept, new), lambda k, v: v.isNotNull())
