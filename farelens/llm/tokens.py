"""Token ids of whole texts, by the tokenizers library, at corpus speed.

A vocabulary whose pre-tokeniser drops white space and never joins what
stands on either side of it can be asked for each run of other characters
alone. Texts are split into runs and runs told apart by Arrow, many texts at
once, and workers remember the ids of the runs they have met. A new run is cut
as the vocabulary itself would cut it (letters, single digits, other signs);
the pieces are remembered too, and those never met go to the library many at a
time, as words of one text, whose ids part where a token ends a word. Runs with
characters beyond the Latin blocks, and vocabularies of another kind, are asked
for one by one.

What a worker remembers is bounded in bytes: when it is more, only what the
texts at hand hold is kept.

Edge cases: an empty text has no ids; very long runs are encoded but not
remembered; whatever the library makes of control characters, unusual spaces and
added tokens is asked of it.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer, pre_tokenizers

from farelens.llm.common import forget_others, remembered

os.environ["TOKENIZERS_PARALLELISM"] = "false"

#: Bytes of runs that are remembered, half as many of pieces, and the longest.
GENERATION, LONGEST = 32_000_000, 64
#: Pieces asked for in one text.
_JOINED = 500
#: Arrow, as Python, splits here too, but the vocabularies' pattern does not.
_UNLIKE = r"[\x1c-\x1f]"
#: Runs whose characters are lower-cased one by one and need no normalisation.
_LATIN = "^[!-~\u00a1-\u012f\u0131-\u024f]+$"
#: As the split of ``word_bpe_49k.json``.
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PIECES = regex.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


@lru_cache(2)
def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def packed(ids: Iterable[int]) -> bytes:
    """Little-endian unsigned 32-bit."""
    return b"".join(i.to_bytes(4, "little") for i in ids)


class Remembered:
    """Two generations of what was met, each of about ``generation`` bytes."""

    def __init__(self, generation: int = GENERATION) -> None:
        self.young, self.old, self.size, self.generation = {}, {}, 0, generation
        remembered(self)

    def put(self, key: str, ids: bytes) -> None:
        self.young[key] = ids
        # Objects and the table's slot take about 190 bytes.
        self.size += 190 + len(key) + len(ids)

    def age(self) -> None:
        """Let the older generation go if the younger is full."""
        if self.size > self.generation:
            self.old, self.young, self.size = self.young, {}, 0

    def put_all(self, keys: list[str], ids: list[bytes]) -> None:
        """``put`` of distinct keys."""
        self.young.update(zip(keys, ids, strict=True))
        self.size += 190 * len(keys) + sum(map(len, keys)) + sum(map(len, ids))

    def gather(self, keys: set[str]) -> list[str]:
        """Bring what is known of ``keys`` to the younger generation; those
        that are not known."""
        young, old = self.young, self.old
        missing = [k for k in keys if k not in young]
        back = [k for k in missing if k in old]
        if not back:
            return missing
        self.put_all(back, [old[k] for k in back])
        return [k for k in missing if k not in old]

    def clear(self) -> None:
        self.young, self.old, self.size = {}, {}, 0


def _strings(array: pa.Array) -> list[str]:
    """As ``to_pylist``, which makes a scalar of each."""
    return array.to_numpy(zero_copy_only=False).tolist()


class Table:
    """Packed ids of strings met, of about ``generation`` bytes."""

    def __init__(self, generation: int = GENERATION) -> None:
        self.generation = generation
        self.clear()
        remembered(self)

    def clear(self) -> None:
        self.keys, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def look_up(self, asked: pa.Array, learn: Callable[[pa.Array], pa.Array]) -> tuple[np.ndarray, memoryview]:
        """The ids of ``asked`` one after another, and where those of each
        begin (and the last end); ``learn`` makes them for new strings."""
        n = len(self.keys)
        coded = pa.concat_arrays([self.keys, asked]).dictionary_encode()
        codes, keys = coded.indices.slice(n), coded.dictionary
        ids = pa.concat_arrays([self.ids, learn(keys.slice(n))]) if len(keys) > n else self.ids
        taken = ids.take(codes)
        self._keep(keys, ids, codes)
        _, offsets, data = taken.buffers()
        return np.frombuffer(offsets, np.int64, len(taken) + 1), memoryview(data or b"")

    def _keep(self, keys: pa.Array, ids: pa.Array, codes: pa.Array) -> None:
        kept = pc.less_equal(pc.utf8_length(keys), LONGEST)
        if keys.nbytes + ids.nbytes > self.generation:
            met = np.zeros(len(keys), bool)
            met[codes.to_numpy()] = True
            kept = pc.and_(kept, pa.array(met))
        if not pc.all(kept).as_py():
            keys, ids = keys.filter(kept), ids.filter(kept)
        self.keys, self.ids = keys, ids
        if keys.nbytes + ids.nbytes > self.generation:
            self.clear()


class SpacelessEncoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        self.known, self.pieces = Table(), Table(GENERATION // 2)
        self.added = "|".join(regex.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if suffix and _SPLIT in self.tokenizer.to_str().replace("\\\\", "\\"):
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.ends[i] = token.endswith(suffix)
            # For pieces, which are normalised and cut already.
            self.plain = Tokenizer(self.tokenizer.model)
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def _ids(self, texts: list[str]) -> Iterator[list[int]]:
        return (e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))

    def _each(self, runs: pa.Array) -> pa.Array:
        """Ids of strings asked for one by one."""
        return pa.array(map(packed, self._ids(_strings(runs))), pa.large_binary())

    def _parts(self, pieces: pa.Array) -> pa.Array:
        """Ids of pieces that the vocabulary does not cut; of a line feed none."""
        made: list[bytes] = []
        words = [p for p in _strings(pieces) if p != "\n"]
        groups = [words[i:i + _JOINED] for i in range(0, len(words), _JOINED)]
        for group, e in zip(groups, self.plain.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(ends) == len(group):
                whole = ids.tobytes()
                made += [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            else:
                made += map(packed, self._ids(group))
        if len(words) < len(pieces):
            made.insert(pc.index(pieces, "\n").as_py(), b"")
        return pa.array(made, pa.large_binary())

    def _cut(self, runs: pa.Array) -> pa.Array:
        """Ids of runs by those of their pieces."""
        together = "".join([r + "\n" for r in _strings(runs)])
        pieces = pa.array(_PIECES.findall(together.lower()), pa.large_string())
        offsets, data = self.pieces.look_up(pieces, self._parts)
        feeds = np.flatnonzero(pc.equal(pieces, "\n").to_numpy(zero_copy_only=False))
        bounds = np.concatenate([offsets[:1], offsets[feeds]])
        return pa.Array.from_buffers(pa.large_binary(), len(runs), [None, pa.py_buffer(bounds), pa.py_buffer(data)])

    def _learn(self, runs: pa.Array) -> pa.Array:
        """Ids of runs not met before."""
        if self.ends is None:
            return self._each(runs)
        alike = pc.match_substring_regex(runs, _LATIN)
        if self.added:
            alike = pc.and_not(alike, pc.match_substring_regex(runs, self.added))
        other = pc.invert(alike)
        ids = pa.concat_arrays([self._cut(runs.filter(alike)), self._each(runs.filter(other))])
        places = np.concatenate([pc.indices_nonzero(alike).to_numpy(), pc.indices_nonzero(other).to_numpy()])
        return ids.take(pa.array(np.argsort(places)))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Per text its ids, packed; a null has none."""
        forget_others(self.known, self.pieces)
        texts = (pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())).fill_null("")
        unlike = pc.match_substring_regex(texts, _UNLIKE)
        runs = pc.utf8_split_whitespace(pc.if_else(unlike, "", texts))
        offsets, data = self.known.look_up(runs.flatten(), self._learn)
        bounds = offsets[np.concatenate([[0], np.cumsum(pc.list_value_length(runs).to_numpy())])].tolist()
        found = [bytes(data[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        for i in np.flatnonzero(unlike.to_numpy(zero_copy_only=False)).tolist():
            found[i] = packed(next(self._ids([texts[i].as_py()])))
        return found


@lru_cache(2)
def spaceless(path: str) -> SpacelessEncoder:
    return SpacelessEncoder(path)
