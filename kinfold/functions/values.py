"""Rules on single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of "no value", compared after trimming and lower-casing.
PLACEHOLDERS = ("none", "null", "unknown", "na", "n/a", "")

# The characters counted as white space around a value.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def is_valid(value: Column) -> Column:
    return value.isNotNull() & ~F.lower(strip(value)).isin(*PLACEHOLDERS)


def as_text(value: Column) -> Column:
    """Default standardiser: the value as a string."""
    return value.cast("string")


def pubmed_curie(value: Column) -> Column:
    """``123.0`` becomes ``PMID:123``; an empty text stays empty."""
    text = value.cast("string")
    return F.when(text == "", F.lit("")).otherwise(F.concat(F.lit("PMID:"), F.split_part(text, F.lit("."), F.lit(1))))


def trailing_digits(value: Column) -> Column:
    """The number a value ends with, or null."""
    return F.regexp_extract(value.cast("string"), r"(\d+)$", 1).try_cast("bigint")


def format_like(raw: Column, dtype: Column, new_id: Column, prefix: Column) -> Column:
    """Write ``new_id`` in the shape of ``raw``: prefixed text, plain text or number.

    Text and number differ only by the dtype tag, which stays as it was.
    """
    prefixed = (dtype == "String") & (prefix != "") & raw.startswith(prefix)
    return F.when(prefixed, F.concat(prefix, new_id.cast("string"))).otherwise(new_id.cast("string"))


def is_upper_label(label: Column) -> Column:
    """Concept label: at least one letter and no lower-case one."""
    return (label == F.upper(label)) & (label != F.lower(label))


def is_source_node(labels: Column) -> Column:
    """No label equals its upper-case form; true for a node without labels."""
    return F.forall(labels, lambda label: label != F.upper(label))

