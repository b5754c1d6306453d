"""Operators over the corpus against brute force: 1, 2, 10, and the pipeline."""

import hashlib
import random
import re
import struct
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF0001
from llm_fixtures import PROSE, SCHEMA, clashing, edge_docs, no_docs, result, texts  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farelens.llm import common, components, fingerprints, ngram_join, packing

WORD = public_tokenizers.path("word_bpe_49k.json")


def five_words(t):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_fingerprints(spark, texts):
    rows = {r.doc_id: r for r in result(spark, "op1_fingerprints")}
    order = sorted(texts)
    errors = []
    for i, k in enumerate(order):
        t, after, r = texts[k], texts[order[(i + 1) % len(order)]], rows[k]
        n = len(t) // 4
        edited = t[:len(t) - n] + after[:n]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = five_words(t), five_words(edited)
        errors.append(r.near_edited - (len(a & b) / len(a | b) if a | b else 1))
        assert (r.fingerprint == "") == (not a) and (t != edited or r.near_edited == 1)
    assert len(rows) == len(order) and abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.12


def test_fingerprints_merge_and_contain(spark):
    rng = random.Random(2)
    long = [f"w{rng.randint(0, 9999)}" for _ in range(6000)]
    row = spark.createDataFrame([(" ".join(long), " ".join(long[:600]), " ".join(long[600:]))], "a string, b string, c string")
    for c in "abc":
        row = fingerprints.with_fingerprint(row, c, f"{c}_")
    r = row.select(fingerprints.containment("b_", "a_").alias("inside"), fingerprints.containment("a_", "b_").alias("share"),
                   F.size(F.array_except("a_", fingerprints.merged("b_", "c_"))).alias("across")).first()
    assert r.inside == 1 and abs(r.share - 0.1) < 0.03 and r.across <= 4


def test_fingerprint_edges(spark, edge_docs, no_docs):
    rows = fingerprints.compare_with_next(edge_docs).collect()
    assert len(rows) == edge_docs.count() and fingerprints.compare_with_next(no_docs).count() == 0
    of = lambda k: [r for r in rows if r.doc_id == k]
    assert all(r.edited == "wo" + "rd"[:1] + "t" for r in of(4))  # the next text is "two words"
    assert len(of(None)) == 2 and len(of(3)) == 2
    one = fingerprints.compare_with_next(spark.createDataFrame([(5, "abcdefgh", None, None, None)], SCHEMA)).collect()
    assert one[0].edited == "abcdefab"


def test_next_in_order_over_many_ranges(spark):
    ids = spark.range(0, 5000, 7).withColumnRenamed("id", "doc_id")
    got = {r.doc_id: r.next_id for r in fingerprints.next_in_order(ids).collect()}
    order = sorted(got)
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_gapless_and_like_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 4096])
    counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randint(0, 60))}
    sequences = {}
    for s in packing.plan(counts, capacity):
        for rank in range(s.rank_from, s.rank_to):
            nth = rank - s.rank_from
            sequences.setdefault(s.sequence + nth // s.each, []).append((s.at + nth % s.each * s.length, s.length, rank))
    placed = sorted((length, rank) for v in sequences.values() for _, length, rank in v)
    assert placed == sorted((n, r) for n, c in counts.items() for r in range(c))
    for v in sequences.values():
        at = 0
        for offset, length, _ in sorted(v):
            assert offset == at
            at += length
        assert at <= capacity
    rooms = []  # one document at a time
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(capacity - n)
        else:
            rooms[rooms.index(fit)] -= n
    assert len(sequences) == len(rooms)


def check_packed(rows, texts, capacity=4096):
    library = Tokenizer.from_file(WORD)
    want = {}
    for k, e in zip(texts, library.encode_batch(list(texts.values()), add_special_tokens=False), strict=True):
        ids = e.ids + [1]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[k, n] = (at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in sequences.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= 1 + 1.02 * sum(w[1] for w in want.values()) / capacity


def test_packing(spark, texts):
    check_packed(result(spark, "op2_best_fit_packing"), texts)


def test_packing_keeps_clashing_columns(spark, clashing):
    taken = clashing.withColumn("offset", F.lit("o")).withColumn("ids", F.lit("i"))
    made = packing.place(packing.pieces(taken, public_tokenizers.path("word_bpe_49k.json")).drop("ids"))
    assert {"length", "length_", "offset", "offset_", "ids_"} <= set(made.columns) and {r.length_ for r in made.collect()} == {"x5"}


def test_packing_edges(spark, edge_docs, no_docs):
    pieces = packing.pieces(edge_docs.select("doc_id", "text"), WORD)
    rows = packing.place(pieces.drop("ids")).collect()
    assert sum(r.piece == 0 for r in rows) == edge_docs.count() and max(r.length for r in rows) == 4096
    assert packing.place(packing.pieces(no_docs.select("doc_id", "text"), WORD).drop("ids")).count() == 0
    same = spark.createDataFrame([(i, "a") for i in range(3000)], "doc_id long, text string")  # one length
    placed = packing.place(packing.pieces(same, WORD).drop("ids")).collect()
    assert len({(r.sequence_id, r.offset) for r in placed}) == 3000 and len({r.sequence_id for r in placed}) == 2


def test_packing_slices_are_whole():
    texts = pa.array(["ab", None, "", "c" * 30, "\u00e9" * 4, "d", "e" * 9, None])
    for t in (texts, texts.slice(2), texts.cast(pa.large_string()), texts[:0]):
        for size in (0, 1, 9, 10, 1000):
            got = list(packing.slices(t, size))
            assert [x for _, s in got for x in s.to_pylist()] == t.to_pylist()
            assert [at for at, _ in got] == [sum(len(s) for _, s in got[:k]) for k in range(len(got))]
            assert all(len(s) == 1 or sum(len((x or "").encode()) for x in s.to_pylist()) <= size for _, s in got)


def brute_components(texts):
    sets = {}
    for k, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[k] = frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)] if w else [])
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def test_join(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in result(spark, "op10_ngram_jaccard_join")}
    assert got == brute_components(texts)


@pytest.mark.parametrize("block", [768, 16])
def test_join_near_copies(spark, block, monkeypatch):
    """Groups of near copies at and around the threshold, with and without
    their centre, many passages in common; lists in one block and in many."""
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", block)
    rng = random.Random(block)
    word = lambda: f"w{rng.randint(0, 400)}"
    passage = [word() for _ in range(60)]
    texts = {}
    for group in range(5):
        base = [word() for _ in range(rng.choice([12, 40, 90, 150]))] + (passage if group % 2 else [])
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randint(0 if group else 1, 4)):
                copy[rng.randrange(len(copy))] = f"n{rng.randint(0, 30)}"
            texts[len(texts) * 3 + 1] = " ".join(copy)
    texts |= {1000 + i: " ".join(passage + [word() for _ in range(rng.randint(0, 12))]) for i in range(60)}
    texts |= {2000: "", 2001: " ", 2002: "One", 2003: "one", 2004: "one two", 2005: "ONE\ttwo"}
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link(docs).collect()}
    assert got == brute_components(texts)


def test_join_appended_words(spark):
    """Pairs of a text and the same text with words appended, at and around
    the threshold, of 9 to 300 shingles."""
    rng = random.Random(12)
    texts = {}
    for k, n in enumerate([*range(9, 60), *range(60, 301, 6)] * 3):
        base = [f"p{k}w{rng.randint(0, 10 ** 6)}" for _ in range(n + 2)]
        texts[2 * k] = " ".join(base)
        texts[2 * k + 1] = " ".join(base + [f"q{k}w{i}" for i in range(max(1, n // 9 + rng.choice([0, 0, -1, 1])))])
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link(docs).collect()}
    assert got == brute_components(texts)


def test_join_edges(spark, clashing, no_docs):
    rows = ngram_join.link(clashing).collect()
    assert len(rows) == clashing.count() and ngram_join.link(no_docs).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert by[1] == {(0, 1)} and by[2] == {(0, 2)} and {c for _, c in by[8]} == {3} == {c for _, c in by[7]}  # id 3 also has a near copy
    assert {c for _, c in by[None]} == {None}
    kept = ngram_join.keep_first(clashing)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == clashing.columns and ids.count(2) == 1 and ids.count(3) == 2 and ids.count(None) == 2 and not {7, 8} & set(ids)


def test_unlike_texts_of_an_id_stay(spark):
    """One row of each component of texts stays, whatever their ids."""
    other = " ".join(f"other{i}" for i in range(40))
    rows = [(1, PROSE), (1, other), (1, PROSE + "Also."), (1, PROSE), (2, other + " more"), (2, "alone in two"), (3, ""), (3, " "), (3, "alone in two"), (4, PROSE), (5, "single")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    kept = sorted((r.doc_id, r.text) for r in ngram_join.keep_first(docs).collect())
    assert kept == sorted([(1, PROSE), (1, other), (2, "alone in two"), (3, ""), (5, "single")])
    many = docs.filter("doc_id = 1").withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("again")
    assert sorted(r.text for r in ngram_join.keep_first(many).collect()) == sorted([PROSE, other])


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2 ** 63, rng.integers(1, 900), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 2 ** 63, 20, dtype=np.uint64)]))
        x, y = (np.frombuffer(ngram_join.parity(s), np.uint64)[None, :] for s in (a, b))
        words = min(x.shape[1], y.shape[1])
        bound = np.bitwise_count(ngram_join._folded(x, words) ^ ngram_join._folded(y, words)).sum()
        assert bound <= len(np.setxor1d(a, b))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 80)] + [(7, 7), (900, 901)]
    got = {r.v: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(500, 580)} == {500} and got[901] == 900


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in spark.read.parquet(f"{SF0001}/labels.parquet").collect()}
    before = {r.doc_id for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, SF0001).cache()
        assert docs.columns == columns
        now = {r.doc_id: r.text for r in docs.collect()}
        assert set(now) <= before
        if k == 1:
            assert sum(labels.get(i) == 0 for i in now) <= 1
        if k == 2:
            left = brute_components({i: texts[i] for i in before})
            assert set(now) == {c for _, c in left.values()}
        if k == 3:
            assert set(now) == before and all("@mail" not in t for t in now.values())
        before = set(now)
    check_packed(corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).collect(), now)


@pytest.mark.parametrize("classes", [1, 3, 1 << 18])
def test_sifting_loses_nothing(spark, classes, monkeypatch):
    monkeypatch.setattr(common, "KEY_CLASSES", classes)
    rows, keys = spark.range(200).withColumnRenamed("id", "doc_id"), spark.range(0, 400, 7).withColumnRenamed("id", "doc_id")
    perhaps, surely = common.sifted(rows, keys, "doc_id")
    some, none = ({r.doc_id for r in x.collect()} for x in (perhaps, surely))
    assert some | none == set(range(200)) and not some & none and not none & set(range(0, 400, 7))
    nothing, everything = common.sifted(rows, keys.limit(0), "doc_id")
    assert nothing.count() == 0 and everything.count() == 200


def test_pipeline_edges(spark, clashing, no_docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing, SF0001).columns == clashing.columns
        assert stage(spark, no_docs, SF0001).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs, SF0001).count() == 0
    assert PROSE in {r.text for r in corpus_pipeline.rules_stage(spark, clashing, SF0001).collect()}
