"""Threshold-scaled document fingerprints (SQL functions only).

A fingerprint is the sorted array of all 64-bit shingle hashes in the lowest
``FRACTION`` of the hash space. As the threshold is the same for every text, a
fingerprint of a union is the union of the fingerprints, and intersections
estimate containment and likeness without bias however unequal the texts are;
a long text simply keeps more.

Shingles are five consecutive words; a shorter text is one shingle. Should no
hash lie below the threshold, the smallest one stays, so that only texts
without words have an empty fingerprint.

``next_in_order`` pairs each document with the one that follows in order of
doc_id. Only ids are sorted, in ranges; the last of a range learns the first
of the next from one row per range.

Edge cases: null texts count as empty; texts without words are like each
other and unlike all others; a null id comes before all; rows that share an
id are each compared with the next greater id, which the smallest of its texts
stands for; the last id's next is the first, a single id's is its own; very
long texts cost time in proportion; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.common import fresh, stored, text_or_empty, width

WORDS = 5
FRACTION = 0.25


def with_fingerprint(docs: DataFrame, text: str, column: str, fraction: float = FRACTION) -> DataFrame:
    """``docs`` plus the fingerprint of ``text``, array<bigint>."""
    below = -(2 ** 63) + int(fraction * 2 ** 64)
    words, hashes, marks = (fresh(docs, f"fl_{n}") for n in ("words", "hashes", "marks"))
    spaced = text_or_empty(F.col(f"`{text}`"))
    for c in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    step = docs.withColumn(words, F.transform(F.array_remove(F.split(spaced, " "), ""), lambda w: F.xxhash64(w)))
    window = ", ".join(f"get(`{words}`, i + {k})" for k in range(WORDS))
    step = step.select(*columns, F.expr(
        f"CASE WHEN size(`{words}`) = 0 THEN CAST(array() AS array<bigint>) "
        f"WHEN size(`{words}`) < {WORDS} THEN array(xxhash64(`{words}`)) "
        f"ELSE transform(sequence(0, size(`{words}`) - {WORDS}), i -> xxhash64({window})) END").alias(hashes))
    step = step.select(*columns, F.filter(hashes, lambda h: h < below).alias(marks), F.array_min(hashes).alias(hashes))
    return step.select(*columns, F.when((F.size(marks) > 0) | F.col(hashes).isNull(), F.sort_array(F.array_distinct(marks)))
                       .otherwise(F.array(hashes)).alias(column))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard likeness; 1 for two texts without words."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, 1.0).otherwise(shared / union)


def containment(a: str, b: str) -> Column:
    """Estimated share of a's shingles that b has; 1 where a has none."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merged(a: str, b: str) -> Column:
    """The fingerprint of two texts' shingles together, but for those across
    their seam. Smallest hashes kept for want of others stay harmlessly."""
    return F.sort_array(F.array_union(a, b))


def as_text(fingerprint: str) -> Column:
    """Sixteen hexadecimal digits a hash, in order."""
    return F.array_join(F.transform(fingerprint, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def next_in_order(ids: DataFrame) -> DataFrame:
    """``ids`` (doc_id distinct, further columns) plus ``next_id``."""
    spark = ids.sparkSession
    held = stored(ids.repartitionByRange(width(spark), F.col("doc_id").asc_nulls_first()).withColumn("fl_range", F.spark_partition_id()), "ids")
    # A row per range: as many as the session has shuffle partitions.
    heads = held.groupBy("fl_range").agg(F.min(F.struct("doc_id")).alias("head"))
    ranges = Window.orderBy("fl_range")
    after = heads.select("fl_range", F.coalesce(F.lead("head").over(ranges), F.first("head").over(ranges)).alias("after"))
    inside = Window.partitionBy("fl_range").orderBy(F.col("doc_id").asc_nulls_first())
    named = held.withColumn("fl_next", F.lead(F.struct("doc_id")).over(inside)).join(F.broadcast(after), "fl_range")
    return named.withColumn("next_id", F.coalesce("fl_next", "after")["doc_id"]).drop("fl_range", "fl_next", "after")


def compare_with_next(docs: DataFrame, share: int = 4, fraction: float = FRACTION) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_chars, ``edited`` (the last
    1/share of the characters replaced by as many first ones of the next
    document), the fingerprints of both, and of the next document."""
    # The id without nulls, in two columns, and the text: every step below is
    # partitioned by the former and reads just these, so that texts are
    # shuffled once, in an exchange that serves both sides.
    kind = docs.schema["doc_id"].dataType
    key = lambda name: (F.coalesce(F.col(name), F.lit(0).cast(kind)), F.col(name).isNull())
    named = lambda name, *to: [x.alias(n) for n, x in zip(to, key(name), strict=True)]
    plain = docs.select(text_or_empty("text").alias("text"), *named("doc_id", "key", "none"))
    cut = F.expr(f"length(text) div {share}")
    wanted = docs.select("doc_id", text_or_empty("text").alias("text")).groupBy("doc_id").agg(F.max(cut).alias("wanted"))
    order = stored(next_in_order(wanted), "order")
    before = order.select(*named("next_id", "key", "none"), *named("doc_id", "of", "of_none"), "wanted")
    first = Window.partitionBy("key", "none").orderBy("text")
    giving = plain.join(before, ["key", "none"]).withColumn("rank", F.row_number().over(first)).filter("rank = 1")
    giving = with_fingerprint(giving, "text", "next_fingerprint", fraction).select(
        F.col("of").alias("key"), F.col("of_none").alias("none"), F.expr("left(text, CAST(wanted AS int))").alias("beginning"), "next_fingerprint")
    both = plain.join(giving, ["key", "none"])
    both = both.select(F.when(~F.col("none"), F.col("key")).alias("doc_id"), "text", F.length("text").cast("long").alias("n_chars"), F.expr(
        f"concat(left(text, length(text) - CAST(length(text) div {share} AS int)), left(beginning, CAST(length(text) div {share} AS int)))").alias("edited"),
        "next_fingerprint")
    both = with_fingerprint(both, "text", "fingerprint", fraction).drop("text")
    return with_fingerprint(both, "edited", "edited_fingerprint", fraction)
