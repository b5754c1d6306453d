"""Operators on single texts against brute force: 3, 4, 5, 6, 7, 8, 9."""

import hashlib
import math
import random
import re
import sys
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF0001
from llm_fixtures import clashing, edge_docs, no_docs, result, texts  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farelens.llm import bpe, chat_format, factorization, license_scan, personal_data, quality_rules, tokens, url_filter

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCRAPS = ["a", "the", " ", "  ", "\n", "\t", "'s", "'", "<|endoftext|>", "é", "́", "ß", "中", "文", "1", "23", "\x1c", "\x85", "\xa0",
          "\u2003", "\u200b", "İ", "ﬁ", "😀", "!", "??", "_", "\r\n", "\x00", "٣", "Ⅷ", "²", "가", "ᄀ", "ᅡ"]


def scrambled(n, seed, scraps=SCRAPS, most=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(scraps) for _ in range(rng.randint(0, most))) for _ in range(n)]


def rule_statistics(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(map(t.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_quality_rules(spark, texts):
    rows = result(spark, "op5_quality_rules")
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:7] == rule_statistics(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF0001}/labels.parquet").collect()}
    judged = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    assert all(kept for q, kept in judged if q == 1)
    assert sum(kept for q, kept in judged if q == 0) <= 0.1 * max(1, sum(q == 0 for q, _ in judged)) + 1


def test_quality_rules_edges(spark, edge_docs, clashing, no_docs):
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.collect()} >= {7, 8, 9}
    judged = quality_rules.judge(edge_docs).collect()
    assert len(judged) == edge_docs.count()
    assert all(r.base_failed for r in judged if r.doc_id in (1, 2, 4, 5))
    renamed = quality_rules.judge(clashing)
    assert {"stats", "stats_", "votes", "votes_", "posterior"} <= set(renamed.columns) and renamed.count() == clashing.count()
    assert quality_rules.judge(no_docs).count() == 0 and quality_rules.keep_good(no_docs).count() == 0


PATTERNS = {(1, 1, 1, 1): 8000, (-1, -1, 1, 1): 600, (1, 1, -1, -1): 300, (1, 1, 1, -1): 90, (1, 1, 0, -1): 8, (0, 0, 0, 0): 3, (-1, 1, 1, 1): 40,
            (1, 1, 0, 1): 900, (-1, -1, -1, -1): 20}
TWO_KINDS = ["a", "a", "b", "b"]


def plain_em(patterns, kinds, rounds):
    """By the definition, in NumPy."""
    start = quality_rules.beliefs(kinds)
    votes, n = np.array(list(patterns)), np.array(list(patterns.values()), float)
    first_shares, first_rates = np.array(start.shares), np.array(start.rates)
    shares, rates, weight = first_shares, first_rates, quality_rules.STRENGTH * n.sum()
    for _ in range(rounds):
        like = np.array([[s * np.prod(np.where(v == -1, r, np.where(v == 1, 1 - r, 1.0))) for s, r in zip(shares, rates, strict=True)] for v in votes])
        c = like / like.sum(axis=1, keepdims=True) * n[:, None]
        bad, voted = c.T @ (votes == -1), c.T @ (votes != 0)
        shares, rates = (c.sum(axis=0) + weight * first_shares) / (n.sum() + weight), (bad + weight * first_rates) / (voted + weight)
    like = np.array([[s * np.prod(np.where(v == -1, r, np.where(v == 1, 1 - r, 1.0))) for s, r in zip(shares, rates, strict=True)] for v in votes])
    return {tuple(v.tolist()): p for v, p in zip(votes, like[:, 0] / like.sum(axis=1), strict=True)}, shares


def posteriors(spark, patterns, **how):
    df = spark.createDataFrame([(list(v), n) for v, n in patterns.items()], "votes array<int>, n long").coalesce(1)
    found = quality_rules.fit(df, TWO_KINDS, **how)
    return {tuple(r.votes): r.p for r in df.withColumn("p", found.posterior("votes")).collect()}, found


def test_em_is_em_and_has_converged(spark):
    got, found = posteriors(spark, PATTERNS)
    for rounds in (20, 200, 1000):
        want, shares = plain_em(PATTERNS, TWO_KINDS, rounds)
        assert {v: p >= 0.5 for v, p in got.items()} == {v: p >= 0.5 for v, p in want.items()}
    assert np.allclose(list(got.values()), list(want.values()), atol=1e-3) and np.allclose(found.shares, shares, atol=1e-3)
    a_few, _ = posteriors(spark, PATTERNS, rounds=3, tolerance=0)
    assert np.allclose(list(a_few.values()), list(plain_em(PATTERNS, TWO_KINDS, 3)[0].values()), atol=1e-9)
    more, _ = posteriors(spark, {v: 1000 * n for v, n in PATTERNS.items()})
    assert np.allclose(list(more.values()), list(got.values()), atol=1e-9)
    good = sum(n for v, n in PATTERNS.items() if -1 not in v) / sum(PATTERNS.values())
    assert abs(found.shares[0] - good) < 0.05


def test_posterior_of_agreeing_rules_and_of_none(spark):
    """The rules of a kind together reject; a document without any vote stays."""
    got, _ = posteriors(spark, PATTERNS)
    assert got[0, 0, 0, 0] > 0.5
    assert max(got[-1, -1, 1, 1], got[1, 1, -1, -1], got[-1, -1, -1, -1]) < 0.1


def test_verdicts_differ_from_all_must_pass(spark):
    judged = quality_rules.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")).collect()
    held = [r for r in judged if not r.base_failed]
    assert all(r.kept for r in held if -1 not in r.votes) and any(r.kept for r in held if -1 in r.votes) and any(not r.kept for r in held)


def test_licenses(spark, texts):
    for r in result(spark, "op3_license_scan"):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id]))
        hits = [(i, label) for phrase, label in license_scan.BASE for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
        places = [h[0] for h in hits]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(hits), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({h[1] for h in hits})) and set(r.base_labels.split(",")) <= {*r.labels.split(","), ""}
        assert 0 <= r.score <= 1


def test_license_join_is_exact(spark):
    """Every block of every text against every template, one by one."""
    rng = random.Random(5)
    words = sorted({w for _, t, _ in license_scan.TEMPLATES for w in t.split()}) + ["zzz", "yyy"]
    made = []
    for i in range(160):
        label, t, _ = rng.choice(license_scan.TEMPLATES)
        w = rng.choices(words, k=rng.randint(0, 60)) * (i % 3) + [x for x in t.split() if rng.random() > 0.04] + rng.choices(words, k=rng.randint(0, 60))
        rng.shuffle(w) if i % 4 == 3 else None
        made.append((i, " ".join(w)))
    found = {r.doc_id: {(m["first"], m["label"], round(m["score"], 9)) for m in r.matches}
             for r in license_scan.scan(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    stride = license_scan.scanner(license_scan.TEMPLATES, license_scan.LEAST).stride
    for i, text in made:
        w, want = text.split(), set()
        for at in range(0, len(w), stride):
            block = set(zip(w[at:at + 2 * stride], w[at + 1:at + 2 * stride + 1]))
            for label, t, name in license_scan.TEMPLATES:
                t, name = (set(zip(x.split(), x.split()[1:])) for x in (t, name))
                if len(block & t) >= license_scan.need(len(t)) and name <= block:
                    want.add((at, label, round(len(block & t) / len(t), 9)))
        assert found[i] == want
    assert sum(map(len, found.values())) > 100


def test_near_misses_of_licenses(spark):
    """Relatives, and the words of a notice in another sense, give no label of the method."""
    misses = ["Licensed under the GNU General Public License version 3.", "Licensed under the GNU General Public License version 2.",
              "The report was released under the same license as before.", "The mit was released under license, the same.",
              "Licensed under the Mozilla license, version 2.0", "Licensed under the Educational Community License, Version 2.0",
              "Licensed under CC BY-NC-SA 4.0.", "Licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"]
    wanted = ["gpl", "gpl", "", "", "", "", "cc-by", ""]
    rows = [(i, t) for i, t in enumerate(misses)]
    found = {r.doc_id: {m["label"] for m in r.best} | {b["label"] for b in r.base} for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [",".join(sorted(found[i])) for i in range(len(rows))] == wanted


def test_separate_notices_keep_their_labels(spark):
    """A better match takes only what holds no word of its own."""
    notice = {}
    for label, t, _ in license_scan.TEMPLATES:
        notice.setdefault(label, t)
    bsd = notice["bsd"].replace("permitted", "allowed")
    rows = [(1, f"{bsd} {notice['apache']}"), (2, f"{notice['apache']} {'x ' * 30} {bsd}"), (3, notice["cc-by"]), (4, notice["agpl"]),
            (5, f"{notice['mpl'].replace('subject', 'under')} {notice['mit']}"), (6, f"{notice['public-domain'].replace('free', 'open')} {notice['cc-by']}")]
    found = {r.doc_id: {m["label"] for m in r.best} for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: {"bsd", "apache"}, 2: {"bsd", "apache"}, 3: {"cc-by"}, 4: {"agpl"}, 5: {"mpl", "mit"}, 6: {"public-domain", "cc-by"}}


def test_license_edges(spark, clashing, no_docs):
    rows = license_scan.scan(clashing).collect()
    assert len(rows) == clashing.count() and license_scan.scan(no_docs).count() == 0
    assert {m["label"] for r in rows if r.doc_id == 16 for m in r.best} == {"apache"}


def test_chat_round_trip():
    rng = random.Random(1)
    scraps = ["<|", "|>", "<\\|", "\\", "<", "|", "im_end", "<|im_end|>", "<|im_start|>", "<|im_sep|>", "a", " ", "\n", "é", "😀", "assistant"]
    encoder = chat_format.tokenizer(BYTE)
    for texts in zip(*[iter(scrambled(900, 2, scraps, 12))] * 3, strict=True):
        turns = [(rng.choice(["user", "assistant", "system", "<|im_sep|>x"]), t) for t in texts]
        formatted, spans = chat_format.render(turns)
        assert chat_format.parse(formatted) == turns
        whole = encoder.encode(formatted, add_special_tokens=False)
        ids, offsets = chat_format.encode(encoder, formatted, rng.choice([1, 7, 40, 10_000]))
        assert ids.tolist() == whole.ids and offsets.tolist() == [list(o) for o in whole.offsets]
        masked = chat_format.mask(offsets, spans)
        assert chat_format.masked_text(formatted, masked) == "".join(t for r, t in turns if r == "assistant")


def test_stretches_give_the_ids_of_the_whole(texts):
    encoder = chat_format.tokenizer(BYTE)
    for text in [*list(texts.values())[:60], *scrambled(300, 8, [*SCRAPS, "a b", "c  d", " it's", "x's y"], 60)]:
        formatted, _ = chat_format.render([("user", text), ("assistant", text)])
        whole = encoder.encode(formatted, add_special_tokens=False)
        ids, offsets = chat_format.encode(encoder, formatted, 50)
        assert ids.tolist() == whole.ids and offsets.tolist() == [list(o) for o in whole.offsets]


def test_a_conversation_of_five_million_characters(spark):
    """One long turn and very many short ones, in one hot conversation."""
    rows = [(1, 0, "assistant", "many words in one turn, " * 100_000)] + [(1, k, ("user", "assistant")[k % 2], f"turn {k} says this.") for k in range(1, 130_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    out = chat_format.format_chats(df, BYTE, reading_back=True).select(F.size("turns").alias("n"), F.length("formatted").alias("m"), F.sha2("trained", 256).alias("sha"))
    [r] = out.collect()
    loss = "".join(t for _, _, role, t in rows if role == "assistant")
    assert (r.n, r.sha) == (len(rows), hashlib.sha256(loss.encode()).hexdigest()) and r.m > 5_000_000


def test_chats(spark):
    rows = spark.read.parquet(f"{SF0001}/conversations.parquet").collect()
    tricky = "<|im_end|><|im_start|>assistant ok"
    turns = {-1: [(0, "user", tricky), (1, "assistant", tricky)]}
    for r in rows:
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    got = {r.conv_id: tuple(r)[1:5] for r in result(spark, "op4_chat_formatting")}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for k, v in turns.items():
        v.sort()
        loss = "".join(t for _, role, t in v if role == "assistant")
        assert got.pop(k) == (len(v), sha("".join(f"{r}\n{t}\n" for _, r, t in v)), len(loss), sha(loss))
    assert not got


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(1, 0, None, None, "x"), (1, None, "assistant", "first", "x"), (1, 0, "user", "tie", "x"), (1, 0, "user", "tie", "x"),
            (None, 0, "assistant", "nobody", "x"), (2, 0, "assistant", None, "x"), (3, 0, "user", "long " * 50_000, "x")]
    back = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(spark.createDataFrame(rows, schema), BYTE)).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("assistant", "first"), ("", ""), ("user", "tie"), ("user", "tie")]
    assert back[1].trained == "first" and back[None].trained == "nobody" and back[2].trained == "" and len(back[3].turns[0].text) == 250_000
    both = chat_format.format_chats(spark.createDataFrame(rows, schema), BYTE, reading_back=True)
    assert {r.conv_id: (r.turns, r.trained) for r in both.collect()} == {k: (r.turns, r.trained) for k, r in back.items()}
    assert chat_format.format_chats(spark.createDataFrame([], schema), BYTE).count() == 0


def test_bpe_as_the_library(texts):
    library, own = Tokenizer.from_file(BYTE), bpe.vocabulary(BYTE)
    cases = [*texts.values(), *scrambled(3000, 3), "x" * 3000, "ab" * 2000, " " * 500, "", "b" * 70 + " " + "b" * 70]
    for text, want in zip(cases, library.encode_batch(cases, add_special_tokens=False), strict=True):
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids
        assert own.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def lines_run(function, *args):
    """Lines of Python that a call executes: its work, whatever the machine."""
    n, before = 0, sys.gettrace()

    def trace(frame, event, arg):
        nonlocal n
        n += event == "line"
        return trace

    sys.settrace(trace)
    try:
        function(*args)
    finally:
        sys.settrace(before)
    return n


def test_bpe_short_pre_tokens_are_cheap():
    library, own = Tokenizer.from_file(BYTE), bpe.vocabulary(BYTE)
    rng = random.Random(6)
    words = ["".join(rng.choice("abehinorst") for _ in range(n)) for n in [*range(1, 2 * bpe.LISTED)] * 3]
    for word, want in zip(words, library.encode_batch(words, add_special_tokens=False), strict=True):
        assert own.merge(word.encode()) == own._tree(word.encode()) == want.ids
    # Words of a corpus, met for the first time.
    for word in ("thereing", " tiononand", "Reoush", " ontiontion"):
        assert lines_run(own.merge, word.encode()) < 12 * len(word)


def test_remembered_runs_as_the_library(texts):
    library, own = Tokenizer.from_file(WORD), tokens.SpacelessEncoder(WORD)
    own.known.generation = own.pieces.generation = 40_000  # generations change all the time
    cases = [*texts.values(), *scrambled(3000, 4, [*SCRAPS, "<|startoftext|>"]), "x" * 3000, ""]
    for got, want in zip([ids for i in range(0, len(cases), 100) for ids in own.encode(cases[i:i + 100])], library.encode_batch(cases, add_special_tokens=False), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == want.ids


def test_new_runs_are_cheap():
    library, own = Tokenizer.from_file(WORD), tokens.SpacelessEncoder(WORD)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abehinorst") for _ in range(9)) + rng.choice(["", "", ",", "'s"])
    cases = [" ".join(word() for _ in range(300)) for _ in range(10)]
    runs = {r for t in cases for r in t.split()}
    got = []
    assert lines_run(lambda: got.extend(own.encode(cases))) < 21 * len(runs)
    for ids, want in zip(got, library.encode_batch(cases, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids


def test_known_runs_make_no_objects():
    library, own = Tokenizer.from_file(WORD), tokens.SpacelessEncoder(WORD)
    rng = random.Random(5)
    words = ["".join(rng.choice("abehinorst") for _ in range(9)) + rng.choice(["", ",", "'s"]) for _ in range(300)]
    cases = [" ".join(rng.choices(words, k=2000)) for _ in range(50)]
    want = [e.ids for e in library.encode_batch(cases, add_special_tokens=False)]
    own.encode(cases)
    tracemalloc.start()
    got = own.encode(cases)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == want
    assert peak - sum(map(len, got)) < 4 * 100_000  # runs


def test_runs_of_many_kinds_at_once():
    library, own = Tokenizer.from_file(WORD), tokens.SpacelessEncoder(WORD)
    runs = ["don't", "!'s", "'st", "It's,", "\u00c9t\u00e9", "e\u0301", "\u0130I", "\u043f\u0440\u0438\u0432\u0435\u0442", "\u65e5\u672c\u8a9e", "a\u2019s", "x<|endoftext|>y", "12.5%", "\x00", "a\x1cb", "y" * 200, "\u01c5"]
    rng = random.Random(7)
    cases = [rng.choice(["", " ", "\n"]) + rng.choice([" ", "\t", "\u3000", "\x85", "\r\n"]).join(rng.choices(runs, k=rng.randint(0, 30))) for _ in range(400)]
    want = [e.ids for e in library.encode_batch(cases, add_special_tokens=False)]
    for generation in (0, 500, tokens.GENERATION):  # bytes
        own.known.generation = own.pieces.generation = generation
        got = [ids for i in range(0, 400, 50) for ids in own.encode(pa.array(cases).slice(i, 50))]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == want
        assert own.known.keys.nbytes + own.known.ids.nbytes <= generation
    assert max(map(len, own.known.keys.to_pylist())) <= tokens.LONGEST
    assert own.encode(pa.array([None, "", "a", None])) == [b"", b"", own.encode(["a"])[0], b""]


def test_bpe(spark, texts, clashing, no_docs):
    for r in result(spark, "op6_bpe"):
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    both = bpe.decode(bpe.encode(clashing, BYTE), BYTE)
    assert sorted((r.doc_id or 0, r.text) for r in both.collect()) == sorted((r.doc_id or 0, r.text or "") for r in clashing.collect())
    assert both.columns[:-1] == [c for c in clashing.columns if c != "text"] + ["ids"] and bpe.decode(bpe.encode(no_docs, BYTE), BYTE).count() == 0
    once = bpe.round_trip(clashing, BYTE)
    assert sorted((r.doc_id or 0, r.ids, r.decoded) for r in once.collect()) == sorted((r.doc_id or 0, r.ids, r.text) for r in both.collect())
    with pytest.raises(ValueError):
        bpe.encode(clashing, BYTE, ids="row")


def test_url_rules(spark):
    rows = spark.createDataFrame([
        (1, "http://WWW.Example.COM/en/x?a=/b#c"), (2, "https://example.com/en/"), (3, "https://a.example.com/en/y"), (4, "https://xexample.com/en/"),
        (5, "https://b.net/es/1"), (6, "https://b.net/esx"), (7, None), (8, "no scheme/x"), (9, "x://"), (10, "x://h?p=1"), (11, "x://H#/net/fr/"),
        (12, "https://example.com" + "/a" * 30_000), (None, "https://b.net/fr/"), (2, "https://example.com/en/"), (13, "x://a://b/c")],
        "page_id long, url string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(rows.withColumn("label", F.lit(1))).collect()]
    assert len(got) == 15 and got.count((2, "example.com", "/en/", "example.com/en/", "block")) == 2
    by = {g[0]: g[1:] for g in got}
    assert by[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow") and by[3][2] == "example.com/en/"
    assert by[4][2:] == ("com/", "allow") and by[5][2] == "net/es/" and by[6][2] is None
    assert by[7][:3] == ("", "", None) and by[8][:2] == ("", "") and by[9][:2] == ("", "") and by[10][:2] == ("h", "") and by[11][:2] == ("h", "")
    assert by[None][2] == "net/fr/" and by[13][:2] == ("a:", "//b/c") and by[12][2] == "com/"
    assert url_filter.judge(rows.limit(0)).count() == 0
    alone = url_filter.judge(rows.filter("page_id = 6")).collect()
    assert alone[0].verdict == "allow"


def test_url_model_learns(spark):
    """Held-out urls of rules that the model has not been told."""
    pages = spark.read.parquet(f"{SF0001.replace('0.001', '0.01')}/pages.parquet").select("page_id", "url")
    rule, verdict = url_filter.rule_of()
    named = url_filter.with_parts(pages).withColumn("verdict", verdict).filter("verdict is not null")
    fitted = url_filter.fit(named.filter("page_id % 3 > 0"))
    ready = url_filter._assembled(fitted.with_endings(url_filter.with_features(named.filter("page_id % 3 = 0"))))
    rows = fitted.model.transform(ready).select("verdict", "prediction").collect()
    assert sum((r.verdict == "block") == (r.prediction == 1) for r in rows) >= 0.8 * len(rows)


def test_url_model_decides_for_unseen_rules(spark):
    """Whole rules, hosts and endings are held out; what tells blocked urls
    from others is how they look."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows, rules = [], []
    for k in range(12):
        bad = k % 2 == 0
        rules.append(("block" if bad else "allow", f"end{k}/"))
        for _ in range(60):
            tail = f"{rng.randint(10**6, 10**9)}/{rng.randint(0, 9999)}?a={rng.randint(0, 99)}&b=1" if bad else f"{word(6)}/{word(8)}"
            rows.append((len(rows), f"http://{word(5)}.end{k}/{tail}"))
    unseen = [(10_000 + i, f"http://{word(5)}.new{i}/" + (f"{rng.randint(10**6, 10**9)}/{i}?a=1&b=2" if i % 2 else f"{word(6)}/{word(8)}")) for i in range(80)]
    out = url_filter.judge(spark.createDataFrame(rows + unseen, "page_id long, url string"), rules).collect()
    judged = [r for r in out if r.rule is None]
    assert len(judged) == 80 and len({r.score for r in judged}) > 1
    assert sum((r.verdict == "block") == (r.page_id % 2 == 1) for r in judged) >= 0.9 * len(judged)  # the overall rate gives half


def test_url_scores_vary(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    scores = [r.score for r in url_filter.judge(pages).filter("rule is null").collect()]
    assert len(scores) > 50 and len(set(scores)) > 1


def test_url_statistics_are_of_all_rows(spark):
    """Endings that no sampled url has; a hot url that would fill the sample."""
    rows = [(f"http://h{i}.e{i % 40}/s{i % 3}/x", "block" if i % 40 < 10 else "allow") for i in range(400)]
    labelled = url_filter.with_parts(spark.createDataFrame([*rows, *[("http://hot.e0/s0/y", "block")] * 200], "url string, verdict string"))
    fitted = url_filter.fit(labelled, max_train_rows=20)
    overall = 300 / 600
    seen = {r.suffix: r for r in fitted.endings["suffix"].collect()}
    assert len(seen) == 40 and fitted.model is not None and fitted.overall == overall
    for k, r in seen.items():
        n = 10 + 200 * (k == "e0")
        assert r.suffix_seen == pytest.approx(math.log1p(n)) and r.suffix_blocked == pytest.approx((n * (int(k[1:]) < 10) + 5 * overall) / (n + 5))
    ready = fitted.with_endings(url_filter.with_features(labelled.filter("host = 'hot.e0' OR host = 'h39.e39'"))).collect()
    assert len(ready) == 201 and {(r.suffix, round(r.suffix_seen, 6)) for r in ready} == {("e0", round(math.log1p(210), 6)), ("e39", round(math.log1p(10), 6))}
    # All sampled rows were the hot url's, of one verdict.
    assert url_filter.fit(labelled.filter("host = 'hot.e0' OR verdict = 'allow'"), max_train_rows=2).model is not None


def plain_spans(t):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) < 256 for x in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and personal_data.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans(texts):
    scraps = ["a", "b.", "@", "@@", "x@y.z", ".", "..", "-", "1", "22", "300", "4539 1488 0343 6467", "4539148803436467", "+", "+49 (30) 123-456", " ", "(", ")", "é", "%", "_"]
    for t in [*texts.values(), *scrambled(6000, 6, scraps, 14)]:
        assert personal_data.base_spans(t) == plain_spans(t), t
    assert personal_data.base_spans("1" * 200_000) == [] and personal_data.base_spans("a" * 200_000 + "@") == []


def test_personal_data(spark, texts):
    for r in result(spark, "op8_personal_data"):
        base = plain_spans(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in personal_data.KINDS[:4])
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and r.spans.startswith(listed)


def test_bootstrap_finds_unseen_identifiers(spark):
    """Ids in the contexts of seeds are found, the same digits elsewhere not."""
    rng = random.Random(9)
    rows = [(i, f"Please write to customer {rng.randint(1, 9)}.{i % 250}.3.4 soon, order {rng.randint(10_000, 99_999)} is late") for i in range(60)]
    rows += [(100 + i, f"Please write to customer 7.{300 + i}.3.4 soon") for i in range(5)]
    found = {r.doc_id: [s["kind"] for s in r.spans] for r in personal_data.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[100 + i] == ["other"] for i in range(5)) and all(found[i] == ["ip"] for i in range(60))


def test_bootstrap_finds_other_forms(spark):
    """What stands where phones stand is found whatever its form; the same
    tokens in unlike contexts, and numbers that stand everywhere, are not."""
    rows = [(i, f"Please call +1 555-123-{4000 + i} today, as in {2000 + i % 20} we moved.") for i in range(60)]
    forms = ["555-123-9999", "(555) 123-9999", "AB-123", "2007", "x7"]
    gap = " " * 500
    rows += [(100 + k, f"Please{gap}call {f}\ttoday!") for k, f in enumerate(forms)]
    rows += [(200 + k, f"Please paint {f} twice and then rest.") for k, f in enumerate(forms)]
    texts = dict(rows)
    found = {r.doc_id: [(s["kind"], texts[r.doc_id][s["start"]:s["end"]]) for s in r.spans]
             for r in personal_data.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all([k for k, _ in found[i]] == ["phone"] for i in range(60))
    assert [found[100 + k] for k in range(5)] == [[("other", f)] for f in forms]
    assert all(found[200 + k] == [] for k in range(5))


def test_bootstrap_scores_are_brute_force(spark, texts):
    edges = {}
    for t in texts.values():
        for _, _, instance, patterns, seed in personal_data.mentions(t, personal_data.base_spans(t)):
            for p in patterns:
                edges[p, instance] = edges.get((p, instance), False) or seed
    belief = {}
    for k in range(3):
        totals, means = {}, {}
        for (p, i), seed in edges.items():
            n, total = totals.get(p, (0, 0.0))
            totals[p] = n + 1, total + belief.get(i, float(seed))
        sure = {p: total / (n + 2) for p, (n, total) in totals.items()}
        for (p, i), seed in edges.items():
            means.setdefault(i, []).append(sure[p])
        seeds = {i for (_, i), seed in edges.items() if seed}
        belief = {i: 1.0 if i in seeds else sum(m) / len(m) for i, m in means.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    single = personal_data.extract(docs).select(F.explode("mentions").alias("m"))
    got = {r.pattern: r.sure for r in personal_data.bootstrap(personal_data.pattern_edges(single).cache(), least=0.0).collect()}
    assert got == pytest.approx(sure)


def test_places(spark):
    at = lambda t: [t[a:b] for a, b, _, _, seed in personal_data.mentions(t, personal_data.base_spans(t)) if not seed]
    assert at("in 2019, 12 34 men (555) 1-2 [7] x") == ["2019", "12 34", "(555) 1-2 [7"]
    assert at("a 1\n2 b") == ["1", "2"] and at("no digits") == [] and at("mail a@b.cd5 or 5") == ["5"]
    long = "x@y.zz1," * 20_000
    assert len(personal_data.mentions(long, personal_data.base_spans(long))) >= 1
    assert personal_data.mentions("9" * 200_000 + " " + "a1" * 100_000, [])


def test_personal_data_edges(spark, clashing, no_docs):
    assert personal_data.find(clashing.select("doc_id", "text")).count() == clashing.count()
    found = personal_data.find(clashing)
    assert set(found.columns) == {*clashing.columns, "spans_"} - {"text"} and found.count() == clashing.count()
    masked = personal_data.mask(clashing)
    rows = masked.collect()
    assert masked.columns == clashing.columns and len(rows) == clashing.count()
    one = next(r for r in rows if r.doc_id == 13)
    assert one.text.startswith("[EMAIL] The") and one.n_chars == len(one.text)
    assert personal_data.mask(no_docs).count() == 0 and personal_data.find(no_docs).count() == 0
    assert personal_data.masked("ab cd ef", [{"kind": "ip", "start": 0, "end": 4}, {"kind": "card", "start": 3, "end": 5}]) == "[IP] ef"


def test_classifier_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF0001}/labels.parquet").collect()}
    rows = result(spark, "op9_quality_classifier")
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert held and sum(a == b for a, b in held) >= 0.9 * len(held) and all(0 <= r.score <= 1 for r in rows)


def test_classifier_is_a_factorisation_machine():
    """The linear-time score equals the sum over all pairs."""
    rng = np.random.default_rng(1)
    model = factorization.Model(0.3, rng.normal(size=factorization.WIDTH), rng.normal(size=(factorization.WIDTH, factorization.RANK)))
    at, x = factorization.features("The cat sat on the mat. Then it left!")
    slow = model.bias + (model.linear[at] * x).sum() + sum(
        model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i + 1, len(at)))
    # Two words of one bucket are two features of it, as in the fast form.
    assert np.isclose(model.raw(at, x, np.array([0]))[0], slow)


def test_classifier_edges(spark, clashing, no_docs):
    labels = spark.createDataFrame([(7, 1, 0), (15, 0, 0), (None, 1, 0), (8, None, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    model = factorization.fit(clashing, labels)
    assert factorization.keep_good(clashing, model).columns == clashing.columns
    assert factorization.score(clashing, model).count() == clashing.count()
    nothing = factorization.fit(no_docs, labels)
    assert {r.score for r in factorization.score(clashing.drop("score"), nothing).collect()} == {0.5}
    assert factorization.score(no_docs, model).count() == 0
