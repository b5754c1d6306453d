"""License scans: exact set-similarity join of text blocks with templates.

Texts are read as runs of words in overlapping blocks, wide enough that any
passage as long as the longest template lies whole in one of them. Their
tokens are pairs of words that follow each other, so that the words of a notice
count in its own order only. A block matches a template when it holds at least
``LEAST`` of the template's distinct pairs (containment) and all pairs of the
license's name: near relatives share most of a notice, but not the name. Only
pairs of some template can count, so a block is the set of those; a pair lies
where its first word does.

The join is the usual exact one. Pairs are ordered by the number of blocks of
the whole corpus that hold them, rarest first. With ``need`` =
ceil(LEAST * |template|), a match shares one of the first |set| - need + 1
pairs on either side (prefix), has at least ``need`` pairs (length), and from
the places of the shared pair on enough pairs must be left on both sides
(position). What passes is counted exactly.

One pass over the texts yields the base phrases, the blocks that pass the
length filter and, for each template pair, the number of blocks that hold it;
the corpus reaches the driver only as these counts (one per template pair).
Templates are a parameter; their list, not the corpus, bounds what is
broadcast.

Edge cases: a null text counts as empty: no words, no labels, score 0; very
long texts give blocks in proportion; repeated rows and null ids are scanned
each by itself; an empty table gives an empty result; only doc_id and text
are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import stored

LEAST = 0.8
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: (label, notice, name). Words as in texts; a notice stands for its set of
#: pairs, all pairs of the name are compulsory. Fixed values.
TEMPLATES = (
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
            "as published by the free software foundation", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version 3", "gnu lesser general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license "
             "as published by the free software foundation", "gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license "
             "as published by the free software foundation", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
               "you may obtain a copy of the license at", "apache license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
            "the software to deal in the software without restriction", "free of charge to any person"),
    ("cc-by", "licensed under cc by 4 0", "cc by"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "attribution 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "attribution noncommercial 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "attribution sharealike 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("public-domain", "this is free and unencumbered software released into the public domain", "released into the public domain"),
)

#: A-Z to a-z; what is in no word to blanks.
_READ = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_READ).split()


def phrase_places(found: list[bytes], phrases=BASE) -> list[tuple[int, str]]:
    """(first word's place, label) of every place of every phrase."""
    out = []
    for phrase, label in phrases:
        want = phrase.encode().split()
        if not all(w in found for w in want):
            continue
        at = -1
        while True:
            try:
                at = found.index(want[0], at + 1)
            except ValueError:
                break
            if found[at:at + len(want)] == want:
                out.append((at, label))
    return out


def pairs(found: list[bytes]) -> list[tuple[bytes, bytes]]:
    return list(zip(found, found[1:]))


def need(size: int, least: float = LEAST) -> int:
    """Pairs of a template of ``size`` that a block must hold."""
    return max(1, -int(-(size * round(least * 1000)) // 1000))


class Scanner:
    def __init__(self, templates: tuple, least: float) -> None:
        sets = [frozenset(pairs(words(t))) for _, t, _ in templates]
        if not all(sets):
            raise ValueError("a template needs two words at least")
        self.vocabulary = {p: k for k, p in enumerate(sorted(frozenset().union(*sets)))}
        self.after: dict[bytes, dict[bytes, int]] = {}
        for (first, second), k in self.vocabulary.items():
            self.after.setdefault(first, {})[second] = k
        self.fewest = min(need(len(s), least) for s in sets)
        self.stride = max(len(words(t)) for _, t, _ in templates)

    def blocks(self, found: list[bytes]) -> tuple[dict[int, set[int]], Counter]:
        """Blocks by number (block k: from word k * stride, two strides) with
        their template pairs, and how many blocks hold each pair."""
        out: dict[int, set[int]] = {}
        get, stride, last = self.after.get, self.stride, len(found) - 1
        for at, w in enumerate(found):
            if (nexts := get(w)) is not None and at < last and (k := nexts.get(found[at + 1])) is not None:
                b = at // stride
                out.setdefault(b, set()).add(k)
                if b:
                    out.setdefault(b - 1, set()).add(k)
        counts: Counter = Counter()
        for s in out.values():
            counts.update(s)
        return {b: s for b, s in out.items() if len(s) >= self.fewest}, counts


@lru_cache(4)
def scanner(templates: tuple, least: float) -> Scanner:
    return Scanner(templates, least)


def read(docs: DataFrame, templates=TEMPLATES, least: float = LEAST, base=BASE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, ``base`` (place, label), the
    ``blocks`` long enough for a match and ``counts`` of blocks by word."""
    templates = tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(templates, least)
        places = pa.list_(pa.struct([("place", pa.int64()), ("label", pa.string())]))
        block = pa.list_(pa.struct([("block", pa.int64()), ("words", pa.list_(pa.int32()))]))
        count = pa.list_(pa.struct([("word", pa.int32()), ("n", pa.int64())]))
        for b in batches:
            texts = b.column("text")
            for i in range(0, b.num_rows, 256):
                n, hits, blocks, counts = [], [], [], []
                for t in texts.slice(i, 256).to_pylist():
                    found = words(t)
                    n.append(len(found))
                    hits.append([{"place": p, "label": name} for p, name in phrase_places(found, base)])
                    long, held = scan.blocks(found)
                    blocks.append([{"block": k, "words": sorted(s)} for k, s in sorted(long.items())])
                    counts.append([{"word": w, "n": c} for w, c in sorted(held.items())])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, 256), pa.array(n, pa.int64()), pa.array(hits, places), pa.array(blocks, block), pa.array(counts, count)],
                    names=["doc_id", "n_words", "base", "blocks", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, base array<struct<place:long,label:string>>, "
        "blocks array<struct<block:long,words:array<int>>>, counts array<struct<word:int,n:long>>")


def match(blocks: DataFrame, frequency: dict[int, int], templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``blocks`` (row, block, words) joined with the templates: row, block,
    label, score and the template pairs it holds (``held``, as numbers), one
    row per match."""
    spark = blocks.sparkSession
    scan = scanner(tuple(templates), least)
    ranked = sorted(scan.vocabulary.values(), key=lambda w: (frequency.get(w, 0), w))
    rank = {w: r for r, w in enumerate(ranked)}
    rows = []
    for number, (label, text, name) in enumerate(templates):
        held, named = (sorted(rank[scan.vocabulary[w]] for w in set(pairs(words(t)))) for t in (text, name))
        for place, r in enumerate(held[:len(held) - need(len(held), least) + 1]):
            rows.append((r, place, number, label, held, need(len(held), least), named))
    index = spark.createDataFrame(rows, "word int, t_place int, template int, label string, t_words array<int>, need int, named array<int>")
    order = F.create_map(*[F.lit(x) for w, r in rank.items() for x in (w, r)])
    sets = blocks.select("row", "block", F.array_sort(F.transform("words", lambda w: order[w])).alias("words"))
    entries = sets.select("row", "block", "words", F.posexplode("words").alias("b_place", "word"))
    left = F.least(F.size("t_words") - F.col("t_place"), F.size("words") - F.col("b_place"))
    # The templates are a parameter: their size does not follow the corpus.
    near = entries.join(F.broadcast(index), "word").filter(
        (F.size("words") >= F.col("need")) & (F.col("b_place") <= F.size("words") - F.col("need")) & (left >= F.col("need")))
    shared = F.array_intersect("words", "t_words")
    return near.withColumn("held", shared).filter("size(held) >= need AND size(array_except(named, held)) = 0").select(
        "row", "block", "template", "label", (F.size("held") / F.size("t_words")).alias("score"), "held").distinct()


def scan(docs: DataFrame, templates=TEMPLATES, least: float = LEAST, base=BASE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, ``base``, ``matches``, an array
    of (first word, last word, label, score, held) of every matching block, and
    ``best``, those whose pairs no better match explains. A notice can hold a
    shorter one of a relative: a match falls only to one in ``best`` that
    overlaps it, scores more and holds all the template pairs it holds."""
    stride = scanner(tuple(templates), least).stride
    held = stored(read(docs, templates, least, base).withColumn("row", F.monotonically_increasing_id()), "blocks")
    counts = held.select(F.explode("counts").alias("c")).groupBy("c.word").agg(F.sum("c.n").alias("n"))
    frequency = {r["word"]: r["n"] for r in counts.collect()}  # a row per template pair at most
    blocks = held.select("row", F.explode("blocks").alias("b")).select("row", "b.block", "b.words")
    first = F.col("block") * stride
    found = match(blocks, frequency, templates, least).groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct(first.alias("first"), (first + 2 * stride - 1).alias("last"), "label", "score", "held"))).alias("matches"))
    empty = "CAST(array() AS array<struct<first:long,last:long,label:string,score:double,held:array<int>>>)"
    better = lambda m: lambda o: ((o["first"] <= m["last"]) & (o["last"] >= m["first"]) & (o["score"] > m["score"])
                                  & (F.size(F.array_except(m["held"], o["held"])) == 0))
    falling = F.array_sort("matches", lambda x, y: F.when(x["score"] > y["score"], -1).when(x["score"] < y["score"], 1).otherwise(0))
    kept = F.aggregate(falling, F.expr(empty), lambda held, m: F.when(F.exists(held, better(m)), held).otherwise(F.concat(held, F.array(m))))
    return held.select("row", "doc_id", "n_words", "base").join(found, "row", "left").withColumn(
        "matches", F.coalesce("matches", F.expr(empty))).withColumn(
        "best", F.array_sort(kept)).drop("row")
