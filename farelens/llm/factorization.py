"""Quality classifier: a factorisation machine over one text's features.

Features are hashed words (log counts, scaled to length one), statistics of
the text's make-up and metadata derived from it, each cut into bins. The
score is a sigmoid of

    b + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

The bracket is the sum of all pairwise interactions <v_i, v_j> x_i x_j, in
time linear in the number of features (the sum-of-squares identity).

Training reads a bounded sample of labelled rows (``max_train_rows``, those
with the smallest hashed ids): features are made on the executors, and at
most that many sparse rows meet in one task, which runs mini-batch Adam.
Scoring is a map over Arrow batches with the model broadcast; the model has
a fixed size of (buckets + bins) * (rank + 1) numbers.

Edge cases: null texts count as empty; empty texts are scored by their
statistics alone; very long texts take time in proportion; repeated rows and
null ids are scored each by itself; without usable labels every score is the
0.5 of an untrained model; an empty table gives an empty result; further
columns pass through.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.llm.common import forget_others, fresh, remembered

BUCKETS = 1 << 13
BINS = 12
STATISTICS = 10
WIDTH = BUCKETS + BINS * STATISTICS
RANK = 8
#: Distinct words whose bucket a worker remembers.
REMEMBERED = 400_000
CHUNK = 256


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS
        return found


_buckets = remembered(_Buckets())


def _bin(x: float) -> int:
    """0 for nothing, then by halves: 1 is at least a half, 2 a quarter ..."""
    return 0 if x <= 0 else min(BINS - 1, max(1, int(1 - np.log2(min(x, 1.0)))))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of one text: places (int32) and values (float32)."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    n = max(1, len(words))
    size = max(1, len(text))
    statistics = (
        _bin(sum(map(text.count, "#*$%&|<>")) / n),
        _bin(sum(c for w, c in counts.items() if w.isupper() and len(w) > 1) / n),
        _bin(text.count("!") / n),
        _bin((text.count(".") + text.count("?")) / n),
        _bin(text.count(",") / n),
        min(BINS - 1, int(12 * len(counts) / n)) if words else 0,
        _bin(sum(map(eq, words, words[1:])) / n),
        min(BINS - 1, (len(text) - text.count(" ")) // n),
        _bin(text.count("\n") / size * 20),
        min(BINS - 1, len(words).bit_length() // 2),
    )
    at = np.fromiter(map(_buckets.__getitem__, counts), np.int32, len(counts))
    x = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    if len(x):
        x /= np.sqrt(float(x @ x))
    fixed = np.arange(STATISTICS, dtype=np.int32) * BINS + BUCKETS + np.array(statistics, np.int32)
    return np.concatenate([at, fixed]), np.concatenate([x, np.ones(STATISTICS, np.float32)])


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, at: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid; ``starts``: each row's first place."""
        vx = self.factors[at] * x[:, None]
        sums = np.add.reduceat(vx, starts)
        squares = np.add.reduceat((vx * vx).sum(1), starts)
        return self.bias + np.add.reduceat(self.linear[at] * x, starts) + 0.5 * ((sums * sums).sum(1) - squares)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        forget_others(_buckets)
        out = [np.zeros(0)]
        for i in range(0, len(texts), CHUNK):
            rows = [features(t) for t in texts[i:i + CHUNK]]
            at, x = (np.concatenate(part) for part in zip(*rows, strict=True))
            starts = np.cumsum([0, *(len(r[0]) for r in rows[:-1])])
            out.append(1 / (1 + np.exp(-np.clip(self.raw(at, x, starts), -30, 30))))
        return np.concatenate(out).astype(float)


def untrained() -> Model:
    return Model(0.0, np.zeros(WIDTH, np.float32), np.zeros((WIDTH, RANK), np.float32))


def train(at: np.ndarray, x: np.ndarray, ends: np.ndarray, labels: np.ndarray, epochs: int = 8, step: float = 0.02,
          decay: float = 1e-4, batch: int = 128, seed: int = 7) -> Model:
    """Mini-batch Adam on the logistic loss, the classes weighted alike at
    half strength so that the rarer one counts. Row i of the sample has the
    features from ends[i - 1] to ends[i]."""
    if not len(labels) or labels.min() == labels.max():
        return untrained()
    rng = np.random.default_rng(seed)
    begins = np.concatenate([[0], ends[:-1]])
    share = labels.mean()
    weight = np.where(labels == 1, (0.5 / share) ** 0.5, (0.5 / (1 - share)) ** 0.5)
    params = [np.zeros(1), np.zeros(WIDTH), rng.normal(0, 0.02, (WIDTH, RANK))]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        for part in np.array_split(order := rng.permutation(len(labels)), max(1, len(order) // batch)):
            lengths = ends[part] - begins[part]
            starts = np.cumsum(lengths) - lengths
            places = np.repeat(begins[part] - starts, lengths) + np.arange(lengths.sum())
            at_, x_ = at[places], x[places]
            model = Model(float(params[0][0]), params[1], params[2])
            vx = model.factors[at_] * x_[:, None]
            sums = np.add.reduceat(vx, starts)
            error = (1 / (1 + np.exp(-np.clip(model.raw(at_, x_, starts), -30, 30))) - labels[part]) * weight[part] / len(part)
            each = np.repeat(error, lengths)
            g_linear = np.bincount(at_, each * x_, WIDTH) + decay * params[1]
            g_factor = (each * x_)[:, None] * (np.repeat(sums, lengths, axis=0) - vx)
            g_factors = np.stack([np.bincount(at_, g_factor[:, f], WIDTH) for f in range(RANK)], 1) + decay * params[2]
            t += 1
            for p, g, a, b in zip(params, (np.array([error.sum()]), g_linear, g_factors), m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= step * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
    return Model(float(params[0][0]), params[1].astype(np.float32), params[2].astype(np.float32))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [features(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("label"), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float32()))],
            names=["label", "at", "x"])


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row, the model of all rows; none without rows."""
    found = [b for b in batches if b.num_rows]
    if not found:
        return
    t = pa.Table.from_batches(found).combine_chunks()
    at, x = (t.column(c).combine_chunks() for c in ("at", "x"))
    ends = np.cumsum(at.value_lengths().to_numpy()).astype(np.int64)
    m = train(at.flatten().to_numpy(), x.flatten().to_numpy(), ends, t.column("label").to_numpy().astype(float))
    yield pa.RecordBatch.from_arrays([pa.array([m.bias], pa.float64()), pa.array([m.linear.astype(np.float32).tobytes()], pa.binary()),
                                      pa.array([m.factors.astype(np.float32).tobytes()], pa.binary())], names=["bias", "linear", "factors"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train_rows: int = 8_000) -> Model:
    """Learn ``label`` (0 or 1) of ``labels`` (doc_id, label) from the texts
    of ``docs``. The caller decides which labels may be seen; of those, at
    most ``max_train_rows`` are used."""
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
             .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_train_rows))
    # At most max_train_rows pairs of numbers: bounded whatever the input.
    seen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("label", "text")
    # The limit only bites where ids repeat in docs. The bounded sample meets
    # in one task, in the order of the query and so the same on every run.
    made = seen.mapInArrow(_featured, "label int, at array<int>, x array<float>")
    sample = made.orderBy(F.xxhash64("at", "x"), "label").limit(2 * max_train_rows).coalesce(1)
    models = sample.mapInArrow(_trained, "bias double, linear binary, factors binary").collect()
    if not models:
        return untrained()
    got = models[0]
    return Model(got["bias"], np.frombuffer(got["linear"], np.float32), np.frombuffer(got["factors"], np.float32).reshape(WIDTH, RANK))


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score", drop_text: bool = False) -> DataFrame:
    """``docs`` plus its score in (0, 1)."""
    column = fresh(docs, column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if not (drop_text and c == text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = pa.array(shared.value.scores(b.column(text).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), s], names=[*rest, column])

    schema = T.StructType([*(f for f in docs.schema.fields if f.name in rest), T.StructField(column, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` scored ``threshold`` or more, columns unchanged."""
    scored = score(docs, model)
    return scored.filter(F.col(scored.columns[-1]) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
