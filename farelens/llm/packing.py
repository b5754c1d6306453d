"""Best-fit packing of documents into sequences of fixed capacity.

Planning happens on a histogram of lengths, at most ``capacity`` rows
whatever the corpus: lengths go from long to short, each into the fullest
open sequences that still take it, and sequences that look alike are handled
as one range of ids with a count. What results is a list of slots: the
documents of one length with ranks from..to go to sequences first, first + 1,
..., ``each`` of them to one sequence, from offset ``at`` on.

The list is bounded too. A length opens or splits at most four ranges, so
there are at most 4 * capacity of them, and every time a range takes a length
what is left in it at least halves, which it can do log2(capacity) times:
200,000 slots for 4096 tokens. It is therefore broadcast.

Documents then find their slot by their rank within their length. Ranks are
counted within (length, salt), salts getting consecutive stretches of ranks,
so that a length that a third of all documents share is spread over as many
tasks as there are salts.

Edge cases: a null text counts as empty and is its end token alone; texts
longer than the capacity are cut into pieces, nothing else is; repeated rows
and null ids are packed each by itself; an empty table gives no pieces;
further columns pass through ``pieces`` and ``place``.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.common import fresh, stored, width
from farelens.llm.tokens import packed, spaceless

CAPACITY = 4096
END = 1
#: Bytes of texts encoded at once (or one text), and of ids in a batch that goes back.
_TEXTS, _BYTES = 8_000_000, 8_000_000


class Slot(NamedTuple):
    length: int
    rank_from: int
    rank_to: int  # exclusive
    sequence: int
    each: int
    at: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """Best fit, longest first, over counts of lengths 1 .. capacity."""
    slots: list[Slot] = []
    open_: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, how many)
    rooms: list[int] = []  # keys of open_, sorted
    n_sequences = 0

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[k]
                each = room // length
                full = min(n, left // each)
                part = left - full * each if full < n else 0
                add(room, first + full + (part > 0), n - full - (part > 0))
            else:
                room, first, each = capacity, n_sequences, capacity // length
                full, part = divmod(left, each)
                n_sequences += full + (part > 0)
            if full:
                slots.append(Slot(length, rank, rank + full * each, first, each, capacity - room))
                add(room - each * length, first, full)
            if part:
                slots.append(Slot(length, rank + full * each, rank + full * each + part, first + full, part, capacity - room))
                add(room - part * length, first + full, 1)
            rank += full * each + part
            left -= full * each + part
    return slots


#: Columns that ``pieces`` and ``place`` add.
MADE = ("piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset")


def slices(texts: pa.Array, size: int = _TEXTS) -> Iterator[tuple[int, pa.Array]]:
    """Slices of ``size`` bytes at most, or of one text, and where they begin."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield at, texts.slice(at, to - at)
        at = to


def pieces(docs: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Per piece: the other columns of ``docs``, ``piece``, ``start``,
    ``length`` and ``ids`` (little-endian unsigned 32-bit). A column of ``docs``
    that is named like one made here or in ``place`` gets underscores."""
    for c in [c for c in docs.columns if c != text and c.lower() in MADE]:
        docs = docs.withColumnRenamed(c, fresh(docs, c + "_"))
    rest = [c for c in docs.columns if c != text]
    stop = packed([end])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = spaceless(path)
        for b in batches:
            rows: list[tuple[int, int, int, int, bytes]] = []
            size = 0
            for i, some in slices(b.column(text)):
                for k, ids in enumerate(encoder.encode(some), i):
                    ids += stop
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[at:at + 4 * capacity]
                        rows.append((k, n, at // 4, len(cut) // 4, cut))
                    size += len(ids)
                    if size > _BYTES:
                        yield batch(b, rows)
                        rows, size = [], 0
            if rows:
                yield batch(b, rows)

    def batch(b: pa.RecordBatch, rows: list) -> pa.RecordBatch:
        of, n, at, length, ids = zip(*rows, strict=True)
        same = pa.array(of, pa.int64())
        return pa.RecordBatch.from_arrays(
            [*(b.column(c).take(same) for c in rest), pa.array(n, pa.int32()), pa.array(at, pa.int64()),
             pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=[*rest, "piece", "start", "length", "ids"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in rest]
    return docs.mapInArrow(run, ", ".join([*fields, "piece int, start long, length long, ids binary"]))


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``; any other columns, small ones) plus
    ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    row, salt = fresh(pieces, "fl_row"), fresh(pieces, "fl_salt")
    salts = 4 * width(spark)
    held = stored(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces").withColumn(
        salt, F.pmod(F.xxhash64(row), F.lit(salts)))
    counts = stored(held.groupBy("length", salt).agg(F.count("*").alias("fl_n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("fl_n").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(histogram, capacity), "fl_length long, fl_from long, fl_to long, fl_sequence long, fl_each long, fl_at long")
    before = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", salt, F.coalesce(F.sum("fl_n").over(before), F.lit(0)).alias("fl_first"))
    inside = Window.partitionBy("length", salt).orderBy(row)
    ranked = held.withColumn("fl_rank", F.row_number().over(inside) - 1).join(first, ["length", salt])
    ranked = ranked.withColumn("fl_rank", F.col("fl_rank") + F.col("fl_first"))
    # Bounded by the capacity, see above.
    taken = ranked.join(F.broadcast(slots), (F.col("length") == F.col("fl_length")) & (F.col("fl_rank") >= F.col("fl_from"))
                        & (F.col("fl_rank") < F.col("fl_to")))
    nth = F.col("fl_rank") - F.col("fl_from")
    return taken.select(
        *[F.col(f"`{c}`") for c in pieces.columns],
        (F.col("fl_sequence") + F.expr("(fl_rank - fl_from) div fl_each")).alias("sequence_id"),
        (F.col("fl_at") + (nth % F.col("fl_each")) * F.col("length")).alias("offset"))
