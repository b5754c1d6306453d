"""Quality rules by weak supervision (SQL functions only).

Each rule looks at cheap statistics of one text and votes *bad* (-1) beyond one
bound, *good* (1) well within another, and abstains (0) in between. Rules come in
kinds of defect (symbols, shouting, repetition, wording), as texts go wrong in
one way at a time. Nothing says how far a rule is to be trusted:
expectation-maximisation estimates, from the votes alone, a mixture of good
documents and of documents with each kind of defect, and in each of these the
rate at which every rule that votes at all votes bad. An abstention is as likely
in all of them and so no evidence. A document's posterior probability of being
good replaces the usual all-rules-must-pass filter: rules of a kind that agree
reject it, a lone vote of a rule that is often alone does not.

The corpus enters EM only as counts of vote patterns, at most 3 ** rules rows
whatever its size, which the driver holds; it goes round until the estimates no
longer move. Beliefs held at the start weigh ``STRENGTH`` of the documents, so
that the estimates are the same for a corpus and for a thousand copies of it.

Edge cases: null texts count as empty; a text without words has no votes, a
posterior equal to the prior and fails the base rules; repeated rows and null
ids stay, each is judged by itself; an empty table gives an empty result;
columns besides ``text`` are neither read nor changed (a made column that
clashes gets an underscore).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from math import log, log1p, prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import SPACE, fresh, stored, text_or_empty

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: (name, kind of defect, bad if, good if) in SQL over the statistics below;
#: neither or NULL: abstain.
RULES: tuple[tuple[str, str, str, str], ...] = (
    ("symbols", "symbols", "n_symbols > 0.10 * n_words", "n_symbols <= 0.02 * n_words"),
    ("density", "symbols", "n_symbols > 0.04 * word_chars", "n_symbols <= 0.01 * word_chars"),
    ("capitals", "shouting", "n_capitals > 0.40 * word_chars", "n_capitals <= 0.15 * word_chars"),
    ("shouts", "shouting", "n_shouts > 0.20 * n_words", "n_shouts <= 0.02 * n_words"),
    ("variety", "repetition", "n_distinct < 0.20 * n_words", "n_distinct >= 0.35 * n_words"),
    ("repeats", "repetition", "n_repeat_words > 0.10 * n_words", "n_repeat_words <= 0.02 * n_words"),
    ("word_length", "wording", "word_chars < 2.0 * n_words or word_chars > 15.0 * n_words", "word_chars between 3.0 * n_words and 10.0 * n_words"),
    ("stops", "wording", "n_words >= 30 and n_stops < 0.01 * n_words", "n_stops >= 0.02 * n_words"),
)
#: What EM starts from: the share of good documents, how often a rule votes bad
#: on good ones, on its own kind of defect and on others; and their weight.
GOOD, ALARM, OWN, OTHER, STRENGTH = 0.85, 0.01, 0.70, 0.05, 0.01


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus one struct column ``stats``; one pass, no shuffle.

    The steps are separate projections, and every array is used more than
    once, so that Catalyst keeps them apart and computes each array once.
    """
    t, words, marks, hashes, lines, pairs, starts = (
        fresh(docs, f"fl_{n}") for n in ("text", "words", "marks", "hashes", "lines", "pairs", "starts"))
    spaced = F.col(t)
    for c in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    step = docs.withColumn(t, text_or_empty(text)).withColumn(words, F.array_remove(F.split(spaced, " "), ""))
    # What is left of the text are the characters that some rule counts.
    step = step.withColumn(marks, F.regexp_replace(t, f"[^{SYMBOLS}!.A-Z]+", ""))
    step = step.withColumn(lines, F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    word_hashes = fresh(docs, "fl_word_hashes")
    step = step.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w)).cast("long").alias("word_chars_"),
        F.size(words).alias("n_words_"), F.size(F.array_distinct(words)).alias("n_distinct_"),
        marks, (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines_"),
        F.transform(words, lambda w: F.xxhash64(w)).alias(word_hashes))
    step = step.withColumn(hashes, F.expr(
        f"CASE WHEN size(`{word_hashes}`) < {WINDOW} THEN array() ELSE transform(sequence(0, size(`{word_hashes}`) - {WINDOW}), "
        f"i -> xxhash64({', '.join(f'get(`{word_hashes}`, i + {k})' for k in range(WINDOW))})) END"))
    step = step.drop(word_hashes)
    # Windows sorted by (hash, place), only where some window repeats; those
    # with an equal neighbour, back in order of place, are the repeated ones.
    step = step.withColumn(pairs, F.expr(
        f"CASE WHEN size(array_distinct(`{hashes}`)) < size(`{hashes}`) "
        f"THEN sort_array(transform(`{hashes}`, (h, i) -> struct(h AS h, i AS i))) END")).drop(hashes)
    step = step.withColumn(starts, F.expr(
        f"sort_array(filter(transform(`{pairs}`, (x, k) -> CASE WHEN x.h = get(`{pairs}`, k - 1).h "
        f"OR x.h = get(`{pairs}`, k + 1).h THEN x.i END), i -> i IS NOT NULL))")).drop(pairs)
    # Each covers words up to the next one, at most its own width.
    covered = F.expr(f"coalesce(aggregate(transform(`{starts}`, (x, k) -> least({WINDOW}, "
                     f"coalesce(get(`{starts}`, k + 1) - x, {WINDOW}))), 0L, (a, b) -> a + b), 0L)")
    lacking = lambda chars: sum(
        (F.length(marks) - F.length(F.replace(F.col(marks), F.lit(c))) for c in chars), F.lit(0)).cast("long")
    stats = F.struct(
        F.col("n_words_").cast("long").alias("n_words"), F.col("word_chars_").alias("word_chars"),
        lacking(SYMBOLS).alias("n_symbols"), F.col("n_dup_lines_").cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), F.col("n_distinct_").cast("long").alias("n_distinct"),
        F.length(F.regexp_replace(marks, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        lacking("!").alias("n_shouts"), lacking(".").alias("n_stops"),
    )
    return step.select(*[F.col(f"`{c}`") for c in docs.columns], stats.alias(fresh(docs, "stats")))


def base_failed(stats: str = "stats") -> Column:
    s = F.col(stats)
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


_NAMES = re.compile(r"\b(n_words|word_chars|n_symbols|n_dup_lines|n_repeat_words|n_distinct|n_capitals|n_shouts|n_stops)\b")


def votes(stats: str = "stats", rules: Sequence = RULES) -> Column:
    """array<int> of the rules' votes; all abstain on a text without words."""
    inside = lambda sql: _NAMES.sub(rf"`{stats}`.\1", sql)
    return F.array(*[F.expr(f"CASE WHEN `{stats}`.n_words = 0 THEN 0 WHEN {inside(bad)} THEN -1 WHEN {inside(good)} THEN 1 ELSE 0 END")
                     for _, _, bad, good in rules])


@dataclass(frozen=True)
class Estimates:
    """What EM found: the shares of good documents and of each kind of defect,
    and in each of these how often every rule that votes votes bad."""

    shares: tuple[float, ...]
    rates: tuple[tuple[float, ...], ...]

    def posterior(self, votes: str) -> Column:
        """Probability that a document is good: the odds of each kind of defect
        against it, summed up."""
        listed = lambda numbers: f"array({', '.join(f'{x!r}D' for x in numbers)})"
        shares = listed(log(x / self.shares[0]) for x in self.shares[1:])
        bad = f"array({', '.join(listed(log(x / y) for x, y in zip(r, self.rates[0], strict=True)) for r in self.rates[1:])})"
        good = f"array({', '.join(listed(log1p(-x) - log1p(-y) for x, y in zip(r, self.rates[0], strict=True)) for r in self.rates[1:])})"
        return F.expr(f"""1D / aggregate(transform({shares}, (s, c) -> least(700D, aggregate(
            transform(`{votes}`, (v, k) -> CASE v WHEN -1 THEN get(get({bad}, c), k) WHEN 1 THEN get(get({good}, c), k) ELSE 0D END),
            s, (t, x) -> t + x))), 1D, (t, x) -> t + exp(x))""")

    def classes(self, votes: Sequence[int]) -> list[float]:
        """Of one pattern: probability of good, and of each kind of defect."""
        like = [share * prod(r if v == -1 else 1 - r for v, r in zip(votes, rates, strict=True) if v)
                for share, rates in zip(self.shares, self.rates, strict=True)]
        total = sum(like)
        return [x / total for x in like]

    def flat(self) -> tuple[float, ...]:
        return (*self.shares, *(x for rates in self.rates for x in rates))


def beliefs(kinds: Sequence[str]) -> Estimates:
    """Where EM starts, for rules of these ``kinds``."""
    each = list(dict.fromkeys(kinds))
    rates = [tuple(OWN if k == kind else OTHER for k in kinds) for kind in each]
    return Estimates((GOOD, *((1 - GOOD) / len(each) for _ in each)), (tuple(ALARM for _ in kinds), *rates))


def fit(patterns: DataFrame, kinds: Sequence[str], rounds: int = 10_000, tolerance: float = 1e-9, strength: float = STRENGTH) -> Estimates:
    """EM over ``patterns`` (votes array<int>, n long), at most 3 ** rules rows,
    until no estimate moves by ``tolerance`` (some hundred rounds; ``rounds``
    only ends it where it would not). Without documents the beliefs are all
    there is."""
    counts = [(tuple(r["votes"]), r["n"]) for r in patterns.groupBy("votes").agg(F.sum("n").alias("n")).collect()]
    start = now = beliefs(kinds)
    many, rules, total = range(len(start.shares)), range(len(kinds)), sum(n for _, n in counts)
    weight = strength * total
    for _ in range(rounds if total else 0):
        judged = [(votes, [n * p for p in now.classes(votes)]) for votes, n in counts]
        held = [sum(p[c] for _, p in judged) for c in many]
        bad = [[sum(p[c] for votes, p in judged if votes[k] == -1) for k in rules] for c in many]
        voted = [[sum(p[c] for votes, p in judged if votes[k]) for k in rules] for c in many]
        then = Estimates(tuple((held[c] + weight * start.shares[c]) / (total + weight) for c in many),
                         tuple(tuple((bad[c][k] + weight * start.rates[c][k]) / (voted[c][k] + weight) for k in rules) for c in many))
        moved = max(abs(x - y) for x, y in zip(now.flat(), then.flat(), strict=True))
        now = then
        if moved < tolerance:
            break
    return now


def kinds_of(rules: Sequence) -> list[str]:
    return [kind for _, kind, _, _ in rules]


def patterns(judged: DataFrame, column: str = "votes") -> DataFrame:
    return judged.groupBy(F.col(column).alias("votes")).agg(F.count("*").alias("n"))


def with_votes(docs: DataFrame, text: str = "text", rules: Sequence = RULES) -> DataFrame:
    """``docs`` plus ``stats`` and ``votes``."""
    out = statistics(docs, text)
    return out.withColumn(fresh(docs, "votes"), votes(out.columns[-1], rules))


def fit_documents(docs: DataFrame, text: str = "text", rules: Sequence = RULES) -> Estimates:
    only = docs.select(F.col(f"`{text}`").alias("text"))
    return fit(stored(patterns(with_votes(only, "text", rules)).coalesce(1), "patterns"), kinds_of(rules))


def judge(docs: DataFrame, text: str = "text", rules: Sequence = RULES, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs`` its columns but the text, ``stats``, ``votes``,
    ``posterior``, ``base_failed`` and ``kept``. The texts are read once; the
    statistics are stored between the two steps."""
    rest = [c for c in docs.columns if c != text]
    named = with_votes(docs, text, rules)
    s, v = named.columns[-2:]
    held = stored(named.select(*[F.col(f"`{c}`") for c in rest], F.col(s), F.col(v)), "rules")
    model = fit(stored(patterns(held, v).coalesce(1), "patterns"), kinds_of(rules))
    p = model.posterior(v)
    failed = base_failed(s)
    named_as = lambda c: fresh(docs.drop(text), c)
    return held.select(*[F.col(f"`{c}`") for c in rest], F.col(s).alias(named_as("stats")), F.col(v).alias(named_as("votes")),
                       p.alias(named_as("posterior")), failed.alias(named_as("base_failed")), (~failed & (p >= threshold)).alias(named_as("kept")))


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence = RULES, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Two passes
    over the texts, so that they are never shuffled."""
    model = fit_documents(docs, text, rules)
    named = with_votes(docs, text, rules)
    s, v = named.columns[-2:]
    # A column that differs by row keeps the optimiser from moving the filter
    # below the projections, where it would compute the statistics once more
    # for each of its terms.
    row = fresh(named, "fl_row")
    judged = named.withColumn(row, F.monotonically_increasing_id()).filter(
        (F.col(row) >= 0) & ~base_failed(s) & (model.posterior(v) >= threshold))
    return judged.select(*[F.col(f"`{c}`") for c in docs.columns])
