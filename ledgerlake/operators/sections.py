"""Markdown documents into titled sections, and sections into chunks of bounded size.

Both steps work inside one row (a document, then a section), on arrays, so neither shuffles
and no document has to wait for another however uneven their sizes or sources are.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import WHITESPACE, regex_class, stable_id, strip
from ..workspace import ship_code

# The title of text before the first heading, and the default chunk size.
INTRO_TITLE = "Introducción"
MAX_CHARS = 1800
# The characters that end a line of text, besides a carriage return with line feed.
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

SPACE_IN_LINE = regex_class("".join(c for c in WHITESPACE if c not in LINE_ENDS))
HEADING = f"#{{1,6}}{SPACE_IN_LINE}."
NOT_BLANK = regex_class(WHITESPACE).replace("[", "[^")
BLANK_LINES = "\\n" + regex_class(WHITESPACE) + "*\\n"


def _with_line_feeds(text: Column) -> Column:
    # Looking for single characters is far quicker than a regular expression, and most texts have
    # line feeds only. The engine's own class of line ends lacks the three separators.
    other = reduce(Column.__or__, [text.contains(c) for c in LINE_ENDS if c != "\n"])
    replaced = F.regexp_replace(F.regexp_replace(text, "\\R", "\n"), "[\\x1c-\\x1e]", "\n")
    return F.when(other, replaced).otherwise(text)


def split_sections(docs: DataFrame) -> DataFrame:
    """``(source_path, text)`` into one row per section with text.

    A section begins at a line of one to six ``#``, white space and a title, and keeps that line.
    Sections are numbered by heading from 1; what stands before the first heading is section 0,
    titled ``Introducción``. A code fence does not hide a heading.
    """
    # With a line break put in front, the first piece is always what precedes the first heading
    # (perhaps nothing), so the position of a piece is its section number.
    lines = F.concat(F.lit("\n"), _with_line_feeds(F.col("text")))
    pieces = docs.select(
        "source_path",
        F.posexplode(F.split(lines, f"\\n(?={HEADING})")).alias("section_no", "piece"),
    )
    title = strip(F.regexp_replace(F.substring_index("piece", "\n", 1), "\\A#{1,6}", ""))
    return pieces.where(F.col("piece").rlike(NOT_BLANK)).select(
        "source_path",
        "section_no",
        F.when(F.col("section_no") == 0, F.lit(INTRO_TITLE)).otherwise(title).alias("section_title"),
        strip("piece").alias("section_text"),
    )


def _chunk_numbers(max_chars: int):
    """Paragraph lengths to chunk numbers: the next chunk begins when a paragraph is too much.

    A running fold needs state that a built-in ``aggregate`` would copy at every paragraph, so its
    cost would grow with the square of the section. Only the lengths go to Python.
    """

    @F.pandas_udf("array<int>")
    def numbers(lengths: pd.Series) -> pd.Series:
        def of_section(paragraphs) -> list[int]:
            found, number, size = [], 0, 0
            for length in paragraphs.tolist():
                if size and size + length > max_chars:
                    number, size = number + 1, 0
                size += length
                found.append(number)
            return found

        return lengths.map(of_section, na_action="ignore")

    return numbers


def pack_chunks(sections: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """Pack the paragraphs of each section, in order, into chunks of at most ``max_chars``.

    Only paragraph lengths count, not the blank lines that join them. A paragraph is never cut, so
    one longer than the limit is a chunk by itself. ``chunk_index`` begins at 0 in every section.
    """
    # Text without blank ends falls into paragraphs of which none is empty.
    paragraphs = sections.select(
        "source_path",
        "section_no",
        "section_title",
        F.transform(F.split(strip("section_text"), BLANK_LINES), strip).alias("texts"),
        (F.length("section_text") > max_chars).alias("is_long"),
    )
    lengths = F.when(F.col("is_long"), F.transform("texts", lambda p: F.length(p)))
    numbered = paragraphs.withColumn("number", _chunk_numbers(max_chars)(lengths))
    # No paragraph has a blank line in it, so two blank lines can only stand between chunks.
    number = F.col("number")
    marked = F.transform(
        "texts",
        lambda p, i: F.when(i == 0, p)
        .when(number[i] == number[i - 1], F.concat(F.lit("\n\n"), p))
        .otherwise(F.concat(F.lit("\n\n\n"), p)),
    )
    parts = F.when(number.isNull(), F.array(F.array_join("texts", "\n\n"))).otherwise(
        F.split(F.array_join(marked, ""), "\n\n\n")
    )
    chunks = numbered.select(
        "source_path",
        "section_no",
        "section_title",
        F.posexplode(parts).alias("chunk_index", "chunk_text"),
    )
    return chunks.where(F.col("chunk_text") != "")


def with_chunk_id(chunks: DataFrame) -> DataFrame:
    """The key of a chunk depends on its place and text only, so indexing again repeats it."""
    return chunks.withColumn(
        "chunk_id", stable_id("source_path", "section_title", "chunk_index", "chunk_text")
    )


def chunk_documents(docs: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    return with_chunk_id(pack_chunks(split_sections(docs), max_chars))


def chunks_per_source(chunks: DataFrame) -> DataFrame:
    return (
        chunks.groupBy("source_path")
        .agg(F.count(F.lit(1)).alias("chunks"))
        .orderBy(F.desc("chunks"), "source_path")
    )


ship_code(__name__)
