"""Byte-level BPE encoding and decoding.

A text is cut into pre-tokens; each is merged on its own. A short one keeps the
merge ranks of its pairs in a list, whose least is looked for before every merge.
For a longer one a segment tree over the pairs of neighbouring symbols keeps in
its root the lowest merge rank and, among equals, the leftmost place; a merge
touches three leaves, so that a pre-token of n bytes takes O(n log n) however
long it is. Workers remember the ids of short pre-tokens, in two generations
bounded in bytes.

The vocabulary is a file of the tokenizers library, read as data: nothing of
the library encodes or decodes here.

Edge cases: null texts count as empty and have no ids; the vocabulary's added
tokens are single ids wherever their strings stand in a text; very long texts
or pre-tokens need memory in proportion; repeated rows and null ids are
handled each by itself; an empty table gives an empty result; further columns
pass through.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from farelens.llm.common import forget_others, fresh
from farelens.llm.tokens import Remembered

#: White space as the vocabulary's pattern means it (the Unicode property).
_S = r"\t-\r \x85\xa0  -     　"
PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: Bytes of a generation of pre-tokens, and the longest that is remembered.
GENERATION, LONGEST = 64_000_000, 48
#: Bytes of the longest pre-token whose ranks are a list.
LISTED = 64
_NONE = 1 << 62


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a vocabulary:
    itself where it is printable, else the next unused one from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Vocabulary:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        ids, stands = data["model"]["vocab"], byte_characters()
        self.byte_ids = [ids[c] for c in stands]
        self.ranks, self.made = {}, []  # of a pair of ids; the id that a rank makes
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(ids[a] << 32 | ids[b], rank)
            self.made.append(ids[a + b])
        byte_of = {c: b for b, c in enumerate(stands)}
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*ids.values(), *self.added.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.known = Remembered(GENERATION)

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        return self._listed(raw) if len(raw) <= LISTED else self._tree(raw)

    def _listed(self, raw: bytes) -> list[int]:
        symbols = [self.byte_ids[b] for b in raw]
        rank_of, made = self.ranks.get, self.made
        ranks = [rank_of(a << 32 | b, _NONE) for a, b in zip(symbols, symbols[1:], strict=False)]
        while ranks and (least := min(ranks)) != _NONE:
            place = ranks.index(least)  # the leftmost
            symbols[place] = new = made[least]
            del symbols[place + 1], ranks[place]
            if place < len(ranks):
                ranks[place] = rank_of(new << 32 | symbols[place + 1], _NONE)
            if place:
                ranks[place - 1] = rank_of(symbols[place - 1] << 32 | new, _NONE)
        return symbols

    def _tree(self, raw: bytes) -> list[int]:
        symbols = [self.byte_ids[b] for b in raw]
        n = len(symbols)
        if n < 2:
            return symbols
        rank_of, made = self.ranks.get, self.made
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        # A leaf holds rank and place of the pair that starts there.
        tree = [_NONE] * (2 * size)
        for k in range(n - 1):
            if (rank := rank_of(symbols[k] << 32 | symbols[k + 1])) is not None:
                tree[size + k] = rank << 32 | k
        for k in range(size - 1, 0, -1):
            left, right = tree[2 * k], tree[2 * k + 1]
            tree[k] = left if left < right else right
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (least := tree[1]) != _NONE:
            place = least & 0xFFFFFFFF
            gone = after[place]
            symbols[place] = made[least >> 32]
            symbols[gone] = -1
            after[place] = right = after[gone]
            if right < n:
                before[right] = place
                rank = rank_of(symbols[place] << 32 | symbols[right])
                value = _NONE if rank is None else rank << 32 | place
            else:
                value = _NONE
            k = size + place
            while k and tree[k] != value:
                tree[k] = value
                if k > 1 and tree[k ^ 1] < value:
                    value = tree[k ^ 1]
                k >>= 1
            if gone < n - 1:
                k, value = size + gone, _NONE
                while k and tree[k] != value:
                    tree[k] = value
                    if k > 1 and tree[k ^ 1] < value:
                        value = tree[k ^ 1]
                    k >>= 1
            if (left := before[place]) >= 0:
                rank = rank_of(symbols[left] << 32 | symbols[place])
                k, value = size + left, _NONE if rank is None else rank << 32 | left
                while k and tree[k] != value:
                    tree[k] = value
                    if k > 1 and tree[k ^ 1] < value:
                        value = tree[k ^ 1]
                    k >>= 1
        return [s for s in symbols if s >= 0]

    def _plain(self, text: str) -> list[bytes]:
        cut, known = PATTERN.findall(text), self.known
        known.age()
        young = known.young
        found = list(map(young.get, cut))
        if None not in found:
            return found
        new = known.gather({token for token, ids in zip(cut, found, strict=True) if ids is None})
        known.put_all(new, [array("I", self.merge(token.encode("utf-8"))).tobytes() for token in new])
        found = [young[token] if ids is None else ids for token, ids in zip(cut, found, strict=True)]
        for token in new:
            if len(token) > LONGEST:
                del young[token]
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text, little-endian unsigned 32-bit."""
        if not self.cut or not any(t in text for t in self.added):
            return b"".join(self._plain(text))
        out = []
        for part in self.cut.split(text):
            out += [self.added[part].to_bytes(4, "little")] if part in self.added else self._plain(part)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I").tolist())).decode("utf-8", "replace")


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _encoded(docs: DataFrame, path: str, text: str, ids: str, decoded: str | None) -> DataFrame:
    """``docs`` with ``ids`` in the place of ``text``, and what they decode to
    in the same pass if ``decoded`` names a column for it."""
    rest = [f for f in docs.schema.fields if f.name != text]
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        forget_others(vocab.known)
        for b in batches:
            for i in range(0, b.num_rows, 200):
                part = b.slice(i, 200)
                made = [vocab.encode(t.as_py() or "") for t in part.column(text)]
                columns = [*(part.column(c) for c in names), pa.array(made, pa.binary())]
                if decoded:
                    columns.append(pa.array(map(vocab.decode, made), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=out)

    clash = {ids.lower(), *([decoded.lower()] if decoded else ())} & {c.lower() for c in names}
    if clash:
        raise ValueError(f"docs has a column {', '.join(clash)}; name another for the results")
    out = [*names, ids, *([decoded] if decoded else ())]
    made = [T.StructField(ids, T.BinaryType()), *([T.StructField(decoded, T.StringType())] if decoded else ())]
    return docs.mapInArrow(run, T.StructType([*rest, *made]))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` (binary) in the place of ``text``."""
    return _encoded(docs, path, text, ids, None)


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with ``ids`` in the place of ``text`` and their decoded text, in
    one pass: one worker a task, one vocabulary."""
    return _encoded(docs, path, text, ids, decoded)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` plus the text of its ids; null ids give the empty text."""
    text = fresh(encoded, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = vocabulary(path).decode
        for b in batches:
            made = pa.array([decoder(x) if x else "" for x in b.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, text])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())]))
