"""Exact n-gram Jaccard self-join by set-relation skipping, to components.

1. One pass over the texts turns each into a set of 64-bit hashes of its
   3-word shingles and keeps its size, a 128-bit digest of the whole set, a
   parity sketch and the members below a fixed share of the hash space
   (at least as many as a prefix needs). Equal sets become one vertex.
2. Prefix index. Members below the share are ordered by how many documents
   hold them, rarest first; those above it all come after, by hash, whatever
   their number (it is known in part only). Two sets that link
   share one of the first n - ceil(0.9 n) + 1. A document enters the lists of
   such members only where another document holds them too.
3. Lists are read in blocks, sorted by size and position. Whole blocks are
   skipped where sizes lie too far apart or where, from these positions on,
   too little of the sets is left. The parity sketch (each member flips one
   bit) bounds the symmetric difference of two sets from below.
4. Answers are derived from those of similar sets: pairs that proven links
   already join are never looked at, and a list yields at most a spanning
   forest of its candidates, the most similar first. Each candidate is then
   verified on the whole sets. What was refuted is told to the lists, and
   they are read again, each time with more candidates allowed between two
   components, until no list yields anything: every pair has then been ruled
   out, verified, or joined by links that were.

Lists longer than a block are dealt out as pairs of blocks, each to its own
group, so that no task holds a whole list; counts are summed up before they
are shuffled.

Edge cases: null texts and texts without words have the empty set, size 0,
and link with nothing; below ``WORDS`` words the whole sequence is the one
shingle; rows that share a doc_id are one document (their sets' links all
count for the id); rows with a null id get their size, and neither link nor
have a component; an empty table gives an empty result; very long texts take
time and memory in proportion to their own length only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.common import DOCUMENTS, forget_others, fresh, remembered, sifted, stored, width
from farelens.llm.components import components

WORDS = 3
#: Share of the hash space whose members can be in the index's first part.
SHARE = 0.15
#: Parity bits: twice the set, from .. to.
LEAST_BITS, MOST_BITS = 256, 4096
#: Entries of a list that one task's group holds, and of a block in it.
LIST_BLOCK, BLOCK = 768, 128
#: Lists so short are answered whole, many at once.
SHORT = 6
#: Words whose hash a worker remembers.
REMEMBERED = 600_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_BELOW = np.uint64(int(SHARE * 2 ** 64))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = remembered(_Hashes())


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """The set of a text, as sorted distinct hashes."""
    # bytes.lower and bytes.split know A-Z and ASCII white space only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if len(w) < WORDS:
        if not len(w):
            return w
        return _mixed(np.array([xxhash.xxh3_64_intdigest(b"\0" + b" ".join(words))], np.uint64))
    a, b, c = w[:-2] * _A, w[1:-1] * _B, w[2:] * _C
    return np.unique(_mixed(a ^ (b << np.uint64(23) | b >> np.uint64(41)) ^ (c << np.uint64(47) | c >> np.uint64(17))))


def digest(members: np.ndarray) -> bytes:
    return blake2b(members.tobytes(), digest_size=16).digest()


def prefix_length(n: int) -> int:
    """Members of which one at least is shared by sets that link."""
    return n - (9 * n + 9) // 10 + 1 if n else 0


def low_members(members: np.ndarray) -> np.ndarray:
    return members[:max(prefix_length(len(members)), int(np.searchsorted(members, _BELOW)))]


def parity(members: np.ndarray) -> bytes:
    """A bit for each class of members: whether their number is odd."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (2 * len(members) - 1).bit_length()))
    at = (_mixed(members + _B) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _signed(members: np.ndarray) -> np.ndarray:
    return members.view(np.int64)


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget_others(_hashes)
    for b in batches:
        texts = b.column("text")
        for i in range(0, b.num_rows, 512):
            sets = [shingles(t) for t in texts.slice(i, 512).to_pylist()]
            sig = [np.frombuffer(digest(s), np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(i, 512), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s[0] for s in sig], pa.int64()), pa.array([s[1] for s in sig], pa.int64()),
                 pa.array([_signed(low_members(s)) for s in sets], pa.list_(pa.int64())), pa.array([parity(s) if len(s) else b"" for s in sets], pa.binary())],
                names=["doc_id", "n", "s1", "s2", "low", "parity"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of the wanted texts; a row whose text is not the wanted one (an id that repeats) yields nothing."""
    for b in batches:
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            rows = [(v, s) for v, s, s1, s2 in zip(part.column("v").to_pylist(), map(shingles, part.column("text").to_pylist()),
                                                  part.column("s1").to_pylist(), part.column("s2").to_pylist(), strict=True)
                    if np.frombuffer(digest(s), np.int64).tolist() == [s1, s2]]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([_signed(r[1]) for r in rows], pa.list_(pa.int64()))],
                                             names=["v", "members"])


def _folded(rows: np.ndarray, words: int) -> np.ndarray:
    """Parity rows brought to fewer bits: halves laid on each other."""
    while rows.shape[1] > words:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def _candidates(v, n, pos, comp, side, sketch, refuted, allowed) -> list[tuple[int, int]]:
    """Pairs of one list (or of two blocks of one, ``side`` 0 and 1) that may
    link and are not joined yet: the most similar first, ``allowed`` between
    two components before they count as joined, so a spanning forest at 1."""
    order = np.lexsort((pos, n))
    v, n, pos, comp, side = (x[order] for x in (v, n, pos, comp, side))
    sketch = [np.frombuffer(sketch[i], np.uint64)[None, :] for i in order]
    blocks = []
    at = 0
    while at < len(v):  # blocks hold sketches of one width
        end = at + 1
        while end < len(v) and end - at < BLOCK and sketch[end].shape == sketch[at].shape:
            end += 1
        blocks.append((at, end, np.concatenate(sketch[at:end])))
        at = end
    two = side.min() != side.max()
    found_i, found_j, found_d = [], [], []
    for x, (a, b, left) in enumerate(blocks):
        for c, d, right in blocks[x:]:
            if 9 * n[c] > 10 * n[b - 1]:
                break  # sorted by size: the rest is larger still
            if 19 * min((n[a:b] - pos[a:b]).max(), (n[c:d] - pos[c:d]).max()) < 9 * (n[a] + n[c]):
                continue
            words = min(left.shape[1], right.shape[1])
            difference = np.bitwise_count(_folded(left, words)[:, None, :] ^ _folded(right, words)[None, :, :]).sum(2, dtype=np.int64)
            total = n[a:b, None] + n[None, c:d]
            room = np.minimum((n - pos)[a:b, None], (n - pos)[None, c:d])
            may = (19 * difference <= total) & (19 * room >= 9 * total) & (comp[a:b, None] != comp[None, c:d])
            if two:
                may &= side[a:b, None] != side[None, c:d]
            i, j = np.nonzero(may)
            if a == c:
                i, j = i[j > i], j[j > i]
            found_i.append(i + a), found_j.append(j + c), found_d.append(difference[i, j])
    if not found_i:
        return []
    i, j, d = map(np.concatenate, (found_i, found_j, found_d))
    low, high = np.minimum(v[i], v[j]), np.maximum(v[i], v[j])
    order = np.lexsort((high, low, d))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    forest, left = [], len(set(comp.tolist())) - 1
    between: Counter = Counter()
    for p, q, a, b in zip(comp[i[order]].tolist(), comp[j[order]].tolist(), low[order].tolist(), high[order].tolist(), strict=True):
        if not left:
            break
        if (p := find(p)) != (q := find(q)) and (a, b) not in refuted:
            forest.append((a, b))
            between[key := (min(p, q), max(p, q))] += 1
            if between[key] >= allowed:
                root[p] = q
                left -= 1
    return forest


def _small(t: pa.Table, column: dict, at: np.ndarray, size: np.ndarray, refuted) -> Iterator[tuple[int, int]]:
    """All pairs that may link in the short lists that start ``at``."""
    sketch = t.column("parity")
    v, n, pos, comp = (column[c] for c in ("v", "n", "pos", "comp"))
    room = n - pos
    for i in range(SHORT - 1):
        for j in range(i + 1, SHORT):
            x = at[size > j] + i
            y = x - i + j
            total = n[x] + n[y]
            may = (10 * np.minimum(n[x], n[y]) >= 9 * np.maximum(n[x], n[y])) & (19 * np.minimum(room[x], room[y]) >= 9 * total) & (comp[x] != comp[y])
            for p, q in zip(x[may].tolist(), y[may].tolist(), strict=True):
                left, right = (np.frombuffer(sketch[k].as_py(), np.uint64)[None, :] for k in (p, q))
                words = min(left.shape[1], right.shape[1])
                if 19 * int(np.bitwise_count(_folded(left, words) ^ _folded(right, words)).sum()) <= n[p] + n[q]:
                    pair = (min(v[p], v[q]), max(v[p], v[q]))
                    if pair not in refuted:
                        yield pair


def _reader(allowed: int):
    """Rows come sorted by (member, i, j); a list may go on in the next batch."""
    def answered(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        column = {c: t.column(c).to_numpy() for c in ("member", "i", "j", "v", "n", "pos", "comp", "side")}
        keys = [column[c] for c in ("member", "i", "j")]
        new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        at = np.nonzero(new)[0]
        size = np.diff(np.append(at, t.num_rows))
        refuted = {(min(a, b), max(a, b)) for a, bs in zip(column["v"].tolist(), t.column("refuted").to_pylist(), strict=True) for b in bs or ()}
        short = (size > 1) & (size <= SHORT) & (column["i"][at] == column["j"][at])
        got = set(_small(t, column, at[short], size[short], refuted))
        for a, k in zip(at[(size > 1) & ~short].tolist(), size[(size > 1) & ~short].tolist(), strict=True):
            got.update(_candidates(*(column[c][a:a + k] for c in ("v", "n", "pos", "comp", "side")),
                                   t.column("parity").slice(a, k).to_pylist(), refuted, allowed))
        if got:
            a, b = zip(*sorted(got), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            last = [t.column(c)[-1].as_py() for c in ("member", "i", "j")]
            same = np.all([t.column(c).to_numpy() == x for c, x in zip(("member", "i", "j"), last, strict=True)], axis=0)
            start = int(np.argmax(same))
            if start:
                yield from answered(t.slice(0, start))
            held = t.slice(start)
        if held is not None:
            yield from answered(held)

    return run


def _index(held: DataFrame, vertices: DataFrame) -> DataFrame:
    """The lists that two vertices or more stand in: (member, v, n, pos,
    parity, i, j, side)."""
    # The many rows of two numbers; the sizes join what is left of them.
    # Every low list holds all of its set's members in the share, so their
    # df is exact; beyond the share it is not, and the place by hash counts.
    beyond = F.col("member").between(-(2 ** 63), -1) | (F.col("member") >= F.lit(int(_BELOW)))  # as unsigned: not in the share
    rows = held.filter("n > 0").select("row", F.posexplode("low").alias("place", "member")).withColumn("place", F.when(beyond, F.col("place")))
    shared = rows.groupBy("member").agg(F.count("*").alias("df")).filter("df > 1")
    inside = F.size(F.filter("low", lambda m: m.between(0, int(_BELOW) - 1)))
    sizes = held.select("row", "n", inside.alias("inside"))
    common = rows.join(shared, "member").join(sizes, "row")
    each = Window.partitionBy("row")
    placed = (common.withColumn("alone", F.col("inside") - F.count(F.when(F.col("place").isNull(), 1)).over(each))
              .withColumn("rank", F.row_number().over(each.orderBy(F.col("place").isNotNull(), "df", "member")) - 1)
              .withColumn("pos", F.coalesce("place", F.col("rank") + F.col("alone")))
              .filter(F.col("pos") < F.expr("n - (9 * n + 9) div 10 + 1")))
    named = placed.join(held.join(vertices, ["n", "s1", "s2"]).select("row", "v"), "row")
    # Equal sets have equal prefixes; one entry stands for all of them.
    entries = stored(named.groupBy("member", "v").agg(F.min("pos").alias("pos")), "entries")
    lists = entries.groupBy("member").agg(F.count("*").alias("entries")).filter("entries > 1")
    sketches = held.select(F.col("row").alias("v"), "n", "parity")
    dealt = entries.join(lists, "member").withColumn("parts", F.expr(f"(entries + {LIST_BLOCK - 1}) div {LIST_BLOCK}"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
    return dealt.join(sketches, "v").select(
        "member", "v", "n", "pos", "parity", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        (F.col("part") > F.col("other")).cast("int").alias("side"))


def link(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) to one row a row: doc_id, n_shingles,
    component_id."""
    return classes(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def classes(docs: DataFrame, whole_ids: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, its set (n, s1, s2), the
    component (a number; null for empty sets) and component_id. Rows that share
    a doc_id are one document, or, without ``whole_ids``, linked only where
    their sets are."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    held = stored(docs.mapInArrow(_summarised, "doc_id long, n long, s1 long, s2 long, low array<long>, parity binary")
                  .withColumn("row", F.monotonically_increasing_id()), "sets")
    known = held.filter("doc_id IS NOT NULL")
    vertices = stored(known.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("row").alias("v"), F.min("doc_id").alias("least")), "vertices")
    index = stored(_index(known, vertices.select("n", "s1", "s2", "v")), "index")
    # Rows of one document: their vertices belong together from the start.
    several = known.filter("n > 0" if whole_ids else "false").select("doc_id", "n", "s1", "s2").join(
        known.groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1").select("doc_id"), "doc_id")
    several = several.join(vertices.select("n", "s1", "s2", "v"), ["n", "s1", "s2"])
    links = stored(several.join(several.groupBy("doc_id").agg(F.min("v").alias("a")), "doc_id")
                   .select("a", F.col("v").alias("b")).filter("a <> b").distinct(), "links")
    joined, refuted, sets, allowed = None, None, None, 1
    while True:
        if joined is None:
            lists = index.withColumn("comp", F.col("v")).withColumn("refuted", F.expr("CAST(NULL AS array<long>)"))
        else:
            both = refuted.union(refuted.select("b", "a")).toDF("v", "w")
            lists = (index.join(joined, "v", "left").withColumn("comp", F.coalesce("component", "v"))
                     .drop("component").join(both.groupBy("v").agg(F.collect_list("w").alias("refuted")), "v", "left"))
        grouped = lists.repartition(width(spark), "member", "i", "j").sortWithinPartitions("member", "i", "j")
        pairs = stored(grouped.mapInArrow(_reader(allowed), "a long, b long").distinct(), "pairs")
        if pairs.isEmpty():
            if joined is None:
                joined = components(links)
            break
        if sets is None:
            ends = pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct()
            wanted = stored(vertices.join(ends, "v").select("v", F.col("least").alias("doc_id"), "s1", "s2"), "wanted")
            sets = stored(sifted(docs, wanted, "doc_id")[0].join(wanted, "doc_id").select("v", "text", "s1", "s2").mapInArrow(_whole, "v long, members array<long>")
                          .dropDuplicates(["v"]), "members")
            # A set that no list yielded at first is in no candidate pair.
            index = stored(sifted(index, ends, "v")[0], "candidates")
        x, y = sets.toDF("a", "x"), sets.toDF("b", "y")
        shared = F.size(F.array_intersect("x", "y"))
        judged = stored(pairs.join(x, "a").join(y, "b").select(
            "a", "b", (100 * shared >= 90 * (F.size("x") + F.size("y") - shared)).alias("linked")), "judged")
        wrong = judged.filter("NOT linked").select("a", "b")
        refuted = wrong if refuted is None else stored(refuted.union(wrong), "refuted")
        links = links.union(judged.filter("linked").select("a", "b"))
        joined = stored(components(links), "joined")
        # The fewer pairs are left, the more each list may yield: the number
        # of rounds grows with the logarithm of what is refuted.
        allowed *= 16
    member = vertices.join(joined, "v", "left").withColumn("component", F.coalesce("component", "v"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    named = member.join(least, "component").select("n", "s1", "s2", "component", "component_id")
    return held.join(named, ["n", "s1", "s2"], "left").select(
        "doc_id", "n", "s1", "s2", "component",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _digested(docs: DataFrame, names: tuple[str, str, str]) -> DataFrame:
    """``docs`` plus the size and digest of each text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(_hashes)
        for b in batches:
            sets = [shingles(t) for t in b.column("text").to_pylist()]
            sig = [np.frombuffer(digest(s), np.int64).tolist() for s in sets]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([len(s) for s in sets], pa.int64()), *[pa.array([s[k] for s in sig], pa.int64()) for k in (0, 1)]],
                                             names=[*b.schema.names, *names])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(run, ", ".join([*fields, *[f"`{n}` long" for n in names]]))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component of linked texts: of the rows with
    its smallest id, the one with the smallest text. Rows that share an id but
    whose texts do not link are different documents; of rows of one id without
    words one stays; rows with a null id all stay."""
    linked = stored(classes(docs, whole_ids=False).filter("doc_id IS NOT NULL"), "linked")
    marks = linked.groupBy("doc_id").agg(F.min((F.col("component_id") == F.col("doc_id")).cast("int")).alias("first"), F.count("*").alias("rows"))
    first, rows, n, s1, s2, component = (fresh(docs, f"fl_{c}") for c in ("first", "rows", "n", "s1", "s2", "component"))
    marks = stored(marks.filter("first = 0 OR rows > 1").select("doc_id", F.col("first").alias(first), F.col("rows").alias(rows)), "marks")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    perhaps, surely = sifted(docs, marks, "doc_id")  # the texts of most rows stay where they are
    single = surely.unionByName(perhaps.join(marks, "doc_id", "left").filter(F.col(first).isNull()).select(*columns))
    # Where an id repeats, its rows go by their sets.
    repeated = marks.filter(F.col(rows) > 1).select("doc_id")
    chosen = linked.filter("component_id = doc_id").join(repeated, "doc_id").select(
        "doc_id", F.col("n").alias(n), F.col("s1").alias(s1), F.col("s2").alias(s2), F.coalesce("component", F.lit(-1)).alias(component)).distinct()
    again = _digested(perhaps.join(repeated, "doc_id", "left_semi").select(*columns), (n, s1, s2)).join(chosen, ["doc_id", n, s1, s2])
    order = F.struct(F.col("`text`"), *[F.col(f"`{c}`") for c in DOCUMENTS[2:] if c in docs.columns])
    # An aggregate with partial results: an id may hold a third of all rows.
    least = again.groupBy("doc_id", component).agg(F.min_by(F.struct(*columns), order).alias(first))
    return single.unionByName(least.select(f"`{first}`.*"))
