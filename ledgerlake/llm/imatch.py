"""I-Match fingerprints: the terms of a document in a band of inverse document frequency, sorted, and
hashed over several randomised lexicon subsets.

Document frequencies are counted over all documents, by the 64-bit hash of a term. The band has two ends: terms
of more than a fifth of the documents go, and so do those of one document only, or of less than a
ten-thousandth. The terms left are at most the mean number of terms a document times 10,000, however large the
corpus, so their bitmap, sixteen bits a term looked up at two places, has a bound. A subset
at level l keeps a term whose hash has l given bits zero, so it holds a 2^-l share of the lexicon. A
document uses the levels at which two to four, and one to two, of its terms are left in a subset; prints
of documents of like length share a level, and their likeness is the share of its subsets that agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, text_of, work_folder

SUBSETS = 16
MAX_LEVEL = 18
LEAST_DOCUMENTS, MIN_SHARE, MAX_SHARE = 2, 1e-4, 0.2
BITS_PER_TERM, LEAST_BITS = 16, 1 << 12
LEAST_ID = -(1 << 63)
#: Ranges of ids for each shuffle partition, so that these come out even.
RANGES_PER_TASK = 4


def term_hashes(text: Column) -> Column:
    """Sorted distinct hashes of the words of a text, in lower case; none for a null text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    kept = F.filter(F.array_distinct(words), lambda w: w != "")
    return F.array_sort(F.transform(kept, lambda w: F.xxhash64(w)))


@dataclass(frozen=True)
class Lexicon:
    """The terms in the band, as a bitmap of ``bits`` bits in a constant array of 64-bit words."""

    bits: int
    words: Column

    def holds(self, h: Column) -> Column:
        def is_set(place: Column) -> Column:
            at = F.pmod(place, F.lit(self.bits)).cast("int")
            return F.getbit(F.get(self.words, F.shiftright(at, 6)), at.bitwiseAND(F.lit(63))) == 1

        return is_set(h) & is_set(F.xxhash64(h))


def lexicon(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> Lexicon:
    """The terms whose share of all documents lies in the band, and that stand in two documents at least.

    An inverse document frequency of ln(1 / share), so the band is -ln(max_share) to -ln(min_share).
    """
    folder = work_folder(docs.sparkSession, "lexicon")
    found = docs.select(F.explode(term_hashes(F.col("text"))).alias("h")).groupBy("h").agg(F.count("*").alias("df"))
    n = docs.count()
    least = max(LEAST_DOCUMENTS, min_share * n)
    kept = stored(found.filter((F.col("df") <= max_share * n) & (F.col("df") >= least)).select("h"), folder, "kept")
    wanted, bits = BITS_PER_TERM * kept.count(), LEAST_BITS
    while bits < wanted:
        bits *= 2
    place = F.explode(F.array(F.col("h"), F.xxhash64("h")))
    places = kept.select(place.alias("place")).select(F.pmod("place", F.lit(bits)).alias("bit"))
    words = places.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    bitmap = [0] * (bits // 64)
    for row in words.collect():
        bitmap[row["word"]] = row["bits"]
    return Lexicon(bits, F.split(F.lit(",".join(map(str, bitmap))), ",").cast("array<bigint>"))


_SUBSET = "filter({terms}, t -> (shiftrightunsigned(t, 3 * s) & (shiftleft(1L, {level}) - 1)) = 0)"


def fingerprint(df: DataFrame, text: str, known: Lexicon, name: str) -> DataFrame:
    """``df`` with ``name``: struct (level, low, high) of the text in column ``text``.

    The hashes of the subsets at ``level`` and at the next; a subset without terms is null, and so are all subsets
    of a text that the lexicon leaves no term.
    """
    last = SUBSETS - 1
    subsets = f"transform(sequence(0, {last}), s -> {_SUBSET.format(terms='_kept', level='_level')})"
    nexts = f"transform(sequence(0, {last}), s -> {_SUBSET.format(terms='get(_subsets, s)', level='_level + 1')})"
    hashed = "transform({0}, a -> if(size(a) > 0, xxhash64(a), null))"
    return (
        df.withColumn("_terms", term_hashes(F.col(text)))
        .withColumn("_kept", F.filter("_terms", known.holds))
        .withColumn("_level", F.expr(f"least(greatest(cast(floor(log2(greatest(size(_kept), 1))) as int) - 1, 0), {MAX_LEVEL - 1})"))
        .withColumn("_subsets", F.expr(subsets))
        .withColumn("_nexts", F.expr(nexts))
        .withColumn(name, F.struct(F.col("_level").alias("level"), F.expr(hashed.format("_subsets")).alias("low"), F.expr(hashed.format("_nexts")).alias("high")))
        .drop("_terms", "_kept", "_level", "_subsets", "_nexts")
    )


def as_text(print_: Column) -> Column:
    """A fingerprint as one string; a subset without terms is ``-``."""
    def joined(side: str) -> Column:
        return F.array_join(F.transform(print_[side], lambda h: F.coalesce(F.lower(F.lpad(F.hex(h), 16, "0")), F.lit("-"))), ".")

    return F.concat(print_["level"].cast("string"), F.lit(":"), joined("low"), F.lit(":"), joined("high"))


def likeness(a: Column, b: Column) -> Column:
    """The share, 0 to 1, of subsets with terms that agree, at the best level that both prints have.

    Two prints without any terms are alike; one with and one without are not.
    """
    def share(x: Column, y: Column) -> Column:
        used = F.size(F.filter(F.arrays_zip(x.alias("x"), y.alias("y")), lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
        same = F.size(F.filter(F.arrays_zip(x.alias("x"), y.alias("y")), lambda p: p["x"] == p["y"]))
        return F.when(used > 0, same / used).otherwise(0.0)

    gap = a["level"] - b["level"]
    none = (F.size(F.filter(a["low"], lambda h: h.isNotNull())) == 0) & (F.size(F.filter(b["low"], lambda h: h.isNotNull())) == 0)
    return (
        F.when(none & (gap == 0), 1.0)
        .when(gap == 0, F.greatest(share(a["low"], b["low"]), share(a["high"], b["high"])))
        .when(gap == 1, share(a["low"], b["high"]))
        .when(gap == -1, share(a["high"], b["low"]))
        .otherwise(0.0)
    )


def _bucket(bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at or below the id, by binary search in a constant."""
    if not bounds:
        return F.lit(0)
    steps = max(1, (len(bounds)).bit_length())
    padded = ",".join(map(str, bounds))
    array = f"cast(split('{padded}', ',') as array<bigint>)"
    return F.expr(
        f"aggregate(sequence(1, {steps}), 0, (lo, k) -> if(lo + shiftleft(1, {steps} - k) <= {len(bounds)} "
        f"and coalesce(get({array}, lo + shiftleft(1, {steps} - k) - 1) <= _id, false), lo + shiftleft(1, {steps} - k), lo))"
    )


def ranged(rows: DataFrame) -> DataFrame:
    """Rows (_id, _digest and others) with ``_range``, and copies (``_copy`` 1) of those that start a range.

    The order is descending, by _id and then _digest. Rows are dealt to ranges of ids, and the first row
    of each range is also put behind the last row of the range above (that of the first range behind the
    last of all), so that no task needs to see all rows. One id per range comes to the driver.
    """
    spark = rows.sparkSession
    n = RANGES_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("_id", "_digest")
    found = ids.agg(F.percentile_approx("_id", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0] or []
    bucket = _bucket(sorted(set(found)))
    firsts = ids.withColumn("_range", bucket).groupBy("_range").agg(F.max(F.struct("_id", "_digest")).alias("top"))
    tops = sorted((r["_range"], r["top"]["_id"], r["top"]["_digest"]) for r in firsts.collect())
    above = [(i, d, tops[(k + 1) % len(tops)][0]) for k, (_, i, d) in enumerate(tops)]
    small = spark.createDataFrame(above, "_top bigint, _top_digest bigint, _to int")
    same = (F.col("_id") == F.col("_top")) & (F.col("_digest") == F.col("_top_digest"))
    marked = rows.join(F.broadcast(small), same, "left")
    places = F.array(F.struct(bucket.alias("_range"), F.lit(0).alias("_copy")))
    copy = F.array(F.struct(F.col("_to").alias("_range"), F.lit(1).alias("_copy")))
    both = F.when(F.col("_to").isNull(), places).otherwise(F.concat(places, copy))
    return marked.select(*rows.columns, F.inline(both))


def with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` from ``ranged`` without its copies, with ``next_<c>``: columns of the next row in order."""
    order = Window.partitionBy("_range").orderBy("_copy", F.col("_id").desc(), F.col("_digest").desc())
    nexts = {f"next_{c}": F.lead(c).over(order) for c in columns}
    return df.withColumns(nexts).filter("_copy = 0").drop("_copy", "_range")


def edited(text: Column, following: Column) -> Column:
    """A text whose last third (floor, in code points) is replaced by as many of the start of the next."""
    part = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - part), F.substr(following, F.lit(1), part))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all rows and of their edited texts, and their likenesses.

    A null text is empty and a null ``doc_id`` comes after all others; rows of one ``doc_id`` follow the
    hash of their texts, and equal rows each other. A single row is its own next one. Other columns are
    not read; no rows give no rows.
    """
    known = lexicon(docs)
    text = text_of()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("_id"),
        F.xxhash64(text).alias("_digest"),
        text.alias("text"),
    )
    own = fingerprint(ranged(rows), "text", known, "print")
    chained = with_next(own, ["text", "print"])
    chained = chained.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    both = fingerprint(chained.drop("next_text"), "edited", known, "edited_print")
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
