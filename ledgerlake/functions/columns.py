"""Scalar columns of the bronze, silver and gold layers. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the mask appends and what it shows for a missing value.
MASK_SUFFIX = "***"
MASK_EMPTY = "<empty>"
FENCE = "```"
# The characters that count as whitespace in Unicode text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def regex_class(chars: str) -> str:
    """A regular-expression class of exactly these characters."""
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(col: Column | str) -> Column:
    """Without leading and trailing Unicode whitespace (``trim`` alone drops only spaces).

    Trimming a set of characters walks the whole text, so it runs only where an end needs it.
    """
    text, blanks = as_column(col), F.lit(WHITESPACE)
    needed = blanks.contains(F.substring(text, 1, 1)) | blanks.contains(F.substring(text, -1, 1))
    return F.when(needed, F.btrim(text, blanks)).otherwise(text)


def with_upper(df: DataFrame, src: str, dst: str) -> DataFrame:
    return df.withColumn(dst, F.upper(src))


def with_lower(df: DataFrame, src: str, dst: str) -> DataFrame:
    return df.withColumn(dst, F.lower(src))


def moment(ts: datetime | str, type_name: str = "timestamp") -> Column:
    """A literal point in time, read as wall-clock text so no time zone shifts it."""
    return F.lit(str(ts)).cast(type_name)


def with_ingestion_ts(
    df: DataFrame, ts: Column | datetime | str | None = None, col: str = "ingestion_ts"
) -> DataFrame:
    """One timestamp for the whole run; pass ``ts`` so that several outputs agree."""
    if ts is None:
        value = F.current_timestamp()
    else:
        value = ts if isinstance(ts, Column) else moment(ts)
    return df.withColumn(col, value)


def with_record_source(df: DataFrame, value: str, col: str = "record_source") -> DataFrame:
    return df.withColumn(col, F.lit(value))


def with_initial(df: DataFrame, src: str, dst: str = "name_initial") -> DataFrame:
    """First letter, upper-cased: a partition key with few values."""
    return df.withColumn(dst, F.upper(src).substr(1, 1))


def mask(col: Column | str, visible: int = 3) -> Column:
    """The first ``visible`` characters and ``***``; empty and null become ``<empty>``."""
    value = as_column(col)
    return F.when(
        F.length(value) > 0, F.concat(F.substring(value, 1, visible), F.lit(MASK_SUFFIX))
    ).otherwise(F.lit(MASK_EMPTY))


def stable_id(*cols: Column | str) -> Column:
    """SHA-256 hex of the fields joined by ``|``: equal content gives an equal key.

    A null counts as empty text, since ``concat_ws`` would drop the field altogether.
    """
    fields = [F.coalesce(as_column(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws("|", *fields), 256)


def strip_code_fence(col: Column | str) -> Column:
    """Drop a leading code fence (with or without ``sql``) and a trailing one, and trim."""
    text = F.regexp_replace(strip(col), f"\\A(?:{FENCE}sql)?(?:{FENCE})?", "")
    return strip(F.regexp_replace(text, f"{FENCE}\\z", ""))


def source_line(rank: Column | str, path: Column | str, title: Column | str, score: Column | str) -> Column:
    """Citation line ``1. path :: section (score=0.000)``."""
    return F.format_string(
        "%d. %s :: %s (score=%.3f)", as_column(rank), as_column(path), as_column(title), as_column(score)
    )
