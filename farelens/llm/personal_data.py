"""Personal data: fixed patterns, and identifiers found by bootstrapping.

``extract`` finds the base entities (email, ip, card, phone) of each text and
every other place where an identifier may stand: a run of words that each hold
a digit, up to a line's end or a mark at a word's end. Every place is in the
lexical patterns of the words around it (two before, one on either side, two
after); its own shape is a pattern of another sort. The base entities are the
seeds. ``bootstrap`` scores the bipartite graph of patterns and instances over
the whole corpus: a pattern is as sure as its instances, with pseudo-counts
against rare ones; an instance is as sure as its patterns are on average, so
that a number that stands everywhere gains nothing from their number; again
and again. Places in a context above the threshold are identifiers, whatever
their form (kind ``other``). Shapes tell how sure an instance is, but no place
is taken for its shape alone.

Every score is an aggregate over (pattern, instance) rows with partial sums
before each shuffle, so that a very common pattern or instance costs no more
than others. Only mentions are stored and shuffled, never texts.

Edge cases: a null text counts as empty and has no spans; very long texts,
words and runs of digits or letters take linear time (a long word stands in a
pattern as a digest); repeated rows are kept, each with its own spans; null ids
are kept; without seeds nothing is added; an empty table gives an empty result;
``extract`` and ``find`` take further columns along, and where one is named as a
column they make, theirs gets underscores; ``mask`` passes all columns through.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import fresh, sifted, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone", "other")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot start inside a run of digits unless it can start at the run.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")
_EDGES = ".,;:!?\"'()[]{}<>|#*$%&"
_STOPS = ".,;:!?"
#: Longer words stand in a pattern as a digest.
LONG_WORD = 24
#: How a pattern begins that is an instance's own shape.
SHAPE = "S "


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of local@domain.tld, going from one @
    to the next, so that long words without one cost nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, (end := m.end())
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    found = [("email", *x) for x in emails(text)]
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(_at_most_255(x) for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def _at_most_255(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _named(word: str) -> str:
    return word if len(word) <= LONG_WORD else "#" + blake2b(word.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def shape(token: str) -> str:
    """Digits as 9, letters as a, runs cut to one."""
    return _named(re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", token))))


def _near(word: str) -> str:
    word = word.strip(_EDGES) or word
    return shape(word) if _DIGIT.search(word) else _named(word.lower())


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without the marks around, but with a bracket whose other half is inside."""
    while start < end and text[start] in _EDGES:
        start += 1
    while end > start and text[end - 1] in _EDGES:
        end -= 1
    opened, closed = text.find("(", start, end), text.find(")", start, end)
    if closed >= 0 and not 0 <= opened < closed and start and text[start - 1] == "(":
        start -= 1
    if opened >= 0 and text.rfind(")", start, end) < text.rfind("(", start, end) and text[end:end + 1] == ")":
        end += 1
    return start, end


def _open_places(text: str, tokens: list[tuple[int, int]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of words with digits that meet none of ``taken``."""
    k, start, last = 0, -1, 0
    for a, b in tokens:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        fits = _DIGIT.search(text, a, b) is not None and not (k < len(taken) and taken[k][0] < b)
        if start >= 0 and (not fits or text[last - 1] in _STOPS or text.find("\n", last, a) >= 0):
            yield _trimmed(text, start, last)
            start = -1
        if fits:
            start, last = a if start < 0 else start, b
    if start >= 0:
        yield _trimmed(text, start, last)


def mentions(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, str, list[str], bool]]:
    """(start, end, instance, patterns, seed) of the base spans and of every
    other place where an identifier may stand."""
    if not spans and not _DIGIT.search(text):
        return []
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    starts, ends = [a for a, _ in tokens], [b for _, b in tokens]
    taken: list[tuple[int, int]] = []
    for _, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if not taken or a >= taken[-1][1]:
            taken.append((a, b))
    slots = sorted([(a, b, True) for a, b in taken] + [(a, b, False) for a, b in _open_places(text, tokens, taken)])
    words: dict[int, str] = {}

    def word(i: int) -> str:
        if not 0 <= i < len(tokens):
            return "^" if i < 0 else "$"
        if i not in words:
            words[i] = _near(text[starts[i]:ends[i]])
        return words[i]

    out = []
    for k, (start, end, seed) in enumerate(slots):
        # The rest of a word that the place is part of, up to the next place, is a word.
        i, j = bisect_left(starts, start) - 1, bisect_left(ends, end + 1)
        before = slots[k - 1][1] if k else 0
        after = slots[k + 1][0] if k + 1 < len(slots) else len(text)
        left = word(i) if i < 0 or ends[i] <= start else _near(text[max(starts[i], before):start] or "|")
        right = word(j) if j == len(tokens) or starts[j] >= end else _near(text[end:min(ends[j], after)] or "|")
        patterns = [f"{sort} {a} {b}" for sort, a, b in (("LL", word(i - 1), left), ("LR", left, right), ("RR", right, word(j + 1)))
                    if any(map(str.isalnum, a + b))]  # marks alone say nothing
        token = text[start:end]
        out.append((start, end, token, [*patterns, SHAPE + shape(token)], seed))
    return out


def extract(docs: DataFrame, text: str = "text", seeds=base_spans) -> DataFrame:
    """Per row of ``docs``: its other columns, ``spans`` and ``mentions``.
    ``seeds`` finds the base spans of a text."""
    rest = [c for c in docs.columns if c != text]
    spans_name, mentions_name = fresh(docs, "spans"), fresh(docs, "mentions")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        mention = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()),
                                      ("patterns", pa.list_(pa.string())), ("seed", pa.bool_())]))
        for b in batches:
            spans, named = [], []
            for t in b.column(text).to_pylist():
                found = seeds(t or "")
                spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in found])
                named.append([dict(zip(("start", "end", "instance", "patterns", "seed"), s, strict=True)) for s in mentions(t or "", found)])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(spans, kind), pa.array(named, mention)],
                                             names=[*rest, spans_name, mentions_name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in rest)
    return docs.mapInArrow(run, fields + f"{', ' if rest else ''}`{spans_name}` array<struct<kind:string,start:int,end:int>>, "
                           f"`{mentions_name}` array<struct<start:int,end:int,instance:string,patterns:array<string>,seed:boolean>>")


def bootstrap(edges: DataFrame, rounds: int = 3, least: float = 0.8, doubt: float = 2.0) -> DataFrame:
    """Sure patterns: (pattern, sure). ``edges``: (pattern, instance, seed,
    n), one row per pattern and instance, already summed up.

    pattern: (sum of its instances' belief) / (its instances + doubt)
    instance: 1 for seeds, else the mean over its patterns of how sure they are
    """
    believed = edges.withColumn("belief", F.col("seed").cast("double"))
    for k in range(rounds):
        scores = believed.groupBy("pattern").agg((F.sum("belief") / (F.count("*") + doubt)).alias("sure"))
        if k == rounds - 1:
            return scores.filter(F.col("sure") >= least)
        beliefs = edges.join(scores, "pattern").groupBy("instance").agg(F.when(F.max("seed"), 1.0).otherwise(F.avg("sure")).alias("belief"))
        believed = stored(edges.join(beliefs, "instance"), f"beliefs{k}")
    raise ValueError("rounds must be at least 1")


def pattern_edges(single: DataFrame) -> DataFrame:
    """(pattern, instance, seed, n) of mentions ``m``, one a row."""
    return (single.select(F.explode("m.patterns").alias("pattern"), F.sha2("m.instance", 256).alias("instance"), "m.seed")
            .groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("n")))


def find(docs: DataFrame, text: str = "text", rounds: int = 3, least: float = 0.8) -> DataFrame:
    """Per row of ``docs``: its other columns and ``spans``, the base spans
    and those of kind ``other`` that the bootstrapped patterns add."""
    key, spans_name, mentions_name, more = (fresh(docs, n) for n in ("fl_row", "spans", "mentions", "fl_added"))
    # The numbers are written down with the rows, so that they stay.
    held = stored(extract(docs, text).withColumn(key, F.monotonically_increasing_id()), "mentions")
    single = held.select(F.col(key).alias("place"), F.explode(mentions_name).alias("m"))
    sure = bootstrap(stored(pattern_edges(single), "edges"), rounds, least).filter(~F.col("pattern").startswith(SHAPE)).select("pattern")
    open_ = single.filter(~F.col("m.seed")).select("place", F.col("m.start").alias("start"), F.col("m.end").alias("end"), F.explode("m.patterns").alias("pattern"))
    added = (open_.join(sure, "pattern").groupBy("place", "start", "end").agg(F.count("*").alias("n"))
             .groupBy(F.col("place").alias(key)).agg(F.array_sort(F.collect_list(F.struct(F.lit("other").alias("kind"), "start", "end"))).alias(more)))
    out = held.drop(mentions_name).join(added, key, "left")
    none = F.expr("CAST(array() AS array<struct<kind:string,start:int,end:int>>)")
    return out.withColumn(spans_name, F.concat(spans_name, F.coalesce(more, none))).drop(more, key)


def listed(spans: str = "spans", only: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(F.filter(spans, lambda s: s["kind"].isin(*only)),
                                    lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str, spans: list[dict]) -> str:
    """Each span as [KIND]; of overlapping ones, the first and longest names
    the place and all of their characters go."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at:s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, text: str = "text", length: str | None = "n_chars", rounds: int = 3, least: float = 0.8) -> DataFrame:
    """``docs`` with all personal data in ``text`` masked and the number of
    code points in ``length`` brought up to date where the text changed.

    Spans are found once per distinct text and joined back by the text's
    sha256; only texts that have spans are on the other side of the join.
    """
    digest = fresh(docs, "fl_digest")
    keyed = docs.withColumn(digest, F.sha2(text_or_empty(text), 256))
    spans = find(keyed.select(digest, F.col(f"`{text}`").alias("text"))).filter(F.size("spans") > 0)
    names, at = docs.columns, fresh(docs, "fl_spans")
    spans = stored(spans.groupBy(digest).agg(F.min("spans").alias(at)), "spans")
    perhaps, surely = sifted(keyed, spans, digest)  # the texts of most rows stay where they are
    joined = perhaps.join(spans, digest, "left").drop(digest)
    surely = surely.drop(digest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans = b.column(text).to_pylist(), b.column(at).to_pylist()
            new = [masked(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            columns = {c: b.column(c) for c in names} | {text: pa.array(new, pa.string())}
            if length in columns:
                lengths = [len(t) if s else n for t, s, n in zip(new, spans, columns[length].to_pylist(), strict=True)]
                columns[length] = pa.array(lengths, columns[length].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return joined.mapInArrow(run, docs.schema).unionByName(surely)
