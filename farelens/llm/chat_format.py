"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole by one template:

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>  for every turn, in order

and every character is encoded once, with the offsets of every token. Control
tokens are borders that no token reaches over, so a long conversation is
encoded in stretches of whole turns, and a long turn in stretches that end where
the vocabulary parts words anyhow; ids are those of the whole. The spans of the
assistant texts are sorted, as are the tokens' spans, so a binary search finds
for each text its first and last token; the mask holds those token places and
the exact characters (a token that reaches over an edge counts with its part).
Ids and masks are packed 32-bit integers.

Spark sorts the rows by conversation and turn; one Python pass renders, masks
and, where asked to, reads back.

Inside roles and texts, ``<|`` becomes ``<\\|`` and ``<\\...\\|`` gets one more
backslash, so that no control string can stand there; undoing takes one away.

Edge cases: a null text counts as empty, a null role as the empty role; turns
that tie are ordered by role, then text; a null turn comes first; repeated
rows are repeated turns; rows with a null conversation id form one
conversation; an empty table gives no rows; further columns are not read. A
conversation is one training example, a row of the result, and takes about 30
bytes of memory a character while it is made.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import AddedToken, Tokenizer

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
#: Characters that are encoded together.
STRETCH = 100_000
_BACK = "turns array<struct<role:string,text:string>>, trained string"

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_BETWEEN = re.compile(r"[A-Za-z](?= [A-Za-z])")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEPARATOR) + "(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]], trained: str = TRAINED_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the sorted spans of its trained texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEPARATOR}", escape(text)
        out += [head, body, END]
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Rows (token, start, end) of every token that has characters of a span.
    ``offsets`` (tokens, 2) and ``spans`` are sorted; tokens that share a
    character (its bytes) overlap."""
    starts, ends = (np.ascontiguousarray(offsets[:, k], "i4") for k in (0, 1))
    edges = np.array(spans, "i4").reshape(-1, 2)
    first, past = np.searchsorted(ends, edges[:, 0], "right"), np.searchsorted(starts, edges[:, 1], "left")
    many = np.maximum(past - first, 0)
    of = np.repeat(np.arange(len(edges)), many)  # the span of each row
    token = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + first[of]
    found = np.stack([token, np.maximum(starts[token], edges[of, 0]), np.minimum(ends[token], edges[of, 1])], axis=1).astype("i4")
    return found[found[:, 1] < found[:, 2]]


def masked_text(formatted: str, masked: np.ndarray) -> str:
    """What stands under a mask, every character once, as it was before
    rendering."""
    if not len(masked):
        return ""
    covered = np.maximum.accumulate(masked[:, 2])
    fresh_at = np.flatnonzero(np.append(True, masked[1:, 1] > covered[:-1]))  # where a stretch begins
    last = np.append(fresh_at[1:], len(masked)) - 1
    return "".join(unescape(formatted[a:b]) for a, b in zip(masked[fresh_at, 1].tolist(), covered[last].tolist(), strict=True))


@lru_cache(2)
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.add_special_tokens([AddedToken(s, special=True, normalized=False) for s in (START, SEPARATOR, END)])
    return t


def stretches(formatted: str, size: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Where ``formatted`` may be encoded part by part: after a turn, or between
    a letter and a blank that a letter follows."""
    at = 0
    while len(formatted) - at > size:
        to = formatted.rfind(END + START, at, at + size)
        if to > at:
            to += len(END)
        elif m := _BETWEEN.search(formatted, at + size):
            to = m.end()
        else:
            to = len(formatted)
        yield at, to
        at = to
    if at < len(formatted):
        yield at, len(formatted)


def encode(encoder: Tokenizer, formatted: str, size: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and offsets (tokens, 2), of the whole text."""
    ids, offsets = [np.zeros(0, "u4")], [np.zeros((0, 2), "i4")]
    for start, end in stretches(formatted, size):
        e = encoder.encode(formatted[start:end], add_special_tokens=False)
        ids.append(np.array(e.ids, "u4"))
        offsets.append(np.array(e.offsets, "i4").reshape(-1, 2) + start)
    return np.concatenate(ids), np.concatenate(offsets)


def _rows(rows: DataFrame) -> DataFrame:
    """Turns in order, each conversation's together."""
    held = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return held.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[str, str]]]]:
    of, turns = None, []
    for b in batches:
        for conv, role, text in zip(*(b.column(c) for c in ("conv_id", "role", "text")), strict=True):
            conv = conv.as_py()
            if turns and conv != of:
                yield of, turns
                turns = []
            of = conv
            turns.append((role.as_py(), text.as_py()))
    if turns:
        yield of, turns


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _read(formatted: str, masked: np.ndarray) -> tuple[list[dict], str]:
    return [dict(zip(("role", "text"), t, strict=True)) for t in parse(formatted)], masked_text(formatted, masked)


def _batches(found: Iterator[list], types: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    """``found``: rows whose second value is the formatted text."""
    held, size = [], 0
    for row in found:
        held.append(row)
        size += len(row[1])
        if size > 500_000 or len(held) >= 500:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def format_chats(rows: DataFrame, path: str, trained: str = TRAINED_ROLE, reading_back: bool = False) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text): ``formatted``,
    ``ids`` of its tokens (packed 32-bit) and ``mask``, the tokens that count in
    the loss with their characters in ``formatted`` (packed triples of 32 bits).
    With ``reading_back`` also what ``read_back`` finds in these."""
    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    names = ["conv_id", "formatted", "ids", "mask", *(("turns", "trained") if reading_back else ())]
    types = [kind, pa.string(), pa.binary(), pa.binary(), _TURNS, pa.string()][:len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)

        def made() -> Iterator[list]:
            for conv, turns in _conversations(batches):
                formatted, spans = render(turns, trained)
                ids, offsets = encode(encoder, formatted)
                masked = mask(offsets, spans)
                row = [conv, formatted, ids.astype("<u4").tobytes(), masked.astype("<i4").tobytes()]
                yield [*row, *_read(formatted, _unpacked(row[3]))] if reading_back else row

        yield from _batches(made(), types, names)

    shape = [f"conv_id {rows.schema['conv_id'].dataType.simpleString()}", "formatted string", "ids binary", "mask binary", _BACK][:5 if reading_back else 4]
    return _rows(rows).mapInArrow(run, ", ".join(shape))


def _unpacked(mask: bytes) -> np.ndarray:
    return np.frombuffer(mask, "<i4").reshape(-1, 3)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation: ``turns`` (role, text) parsed from the formatted
    text and ``trained`` text under the mask."""
    kind = to_arrow_type(formatted.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ([conv.as_py(), text.as_py(), *_read(text.as_py(), _unpacked(masked.as_py()))]
                for b in batches for conv, text, masked in zip(*(b.column(c) for c in ("conv_id", "formatted", "mask")), strict=True))
        yield from _batches(rows, [kind, pa.string(), _TURNS, pa.string()], ["conv_id", "formatted", "turns", "trained"])

    return formatted.select("conv_id", "formatted", "mask").mapInArrow(
        run, f"conv_id {formatted.schema['conv_id'].dataType.simpleString()}, formatted string, {_BACK}")
