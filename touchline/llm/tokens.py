"""Token ids of whole text columns by the tokenizers library, each distinct chunk of a batch once."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from touchline.llm.text import slices, utf8

#: Chunks whose ids a Python worker remembers in each of two generations, some 250 bytes each.
REMEMBERED = 150_000
#: Chunks that are encoded in one text.
GROUP = 64
#: A chunk that may stand between marks: one leading space at most, and no other white space or control.
_SIMPLE = re.compile(r" ?[^\s\x00-\x20\x7f]+")

_B = np.arange(256)
_LETTER, _SIGN, _SOLID, _DOUBTFUL, _SPACE, _BREAK, _HIGH = (1 << k for k in range(7))


def _kinds() -> np.ndarray:
    """What a byte says about a cut beside it, as bits."""
    letter = ((_B >= 0x41) & (_B <= 0x5A)) | ((_B >= 0x61) & (_B <= 0x7A))
    solid = (_B > 0x20) & (_B != 0x7F)  # no white space in any definition, unless what is before says otherwise
    sign = solid & (_B < 0x80) & ~letter & ~((_B >= 0x30) & (_B <= 0x39))
    doubtful = np.isin(_B, [0xC2, 0xE1, 0xE2, 0xE3, 0xEF])  # begin the white space and invisible marks beyond ASCII
    flags = (letter, sign, solid, doubtful, _B == 0x20, _B == 0x0A, _B >= 0x80)
    return sum(np.where(f, 1 << k, 0) for k, f in enumerate(flags)).astype(np.uint8)


_KIND = _kinds()


def cuts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions at which texts may be cut without changing their ids; the start of each text is one.

    Byte-level and word-level tokenizers of this family begin a new piece, whatever comes before, at a
    single space or line break between characters that are surely not white space, behind such a line
    break, and at an ASCII sign that follows an ASCII letter. All else stays inside its chunk.
    """
    low, high = int(bounds[0]), int(bounds[-1])
    n = high - low
    kind = np.zeros(n + 4, np.uint8)  # three before, one behind
    kind[3:-1] = _KIND[raw[low:high]]
    here, left, left2, left3, right = kind[3:-1], kind[2:-2], kind[1:-3], kind[:-4], kind[4:]
    unsure = ((left & _HIGH) != 0) & (((left2 | left3) & _DOUBTFUL) != 0)
    lone = ((left & _SOLID) != 0) & ((right & _SOLID) != 0) & ((right & _DOUBTFUL) == 0) & ~unsure
    lone &= (here & (_SPACE | _BREAK)) != 0
    edge = (bounds[1:-1] - low)[(bounds[1:-1] > low) & (bounds[1:-1] < high)]
    lone[edge] = False  # what stands beside is another text
    lone[edge - 1] = False
    sign = (here & _SIGN) != 0
    out = lone | (sign & ((left & _LETTER) != 0))
    late = np.flatnonzero(sign & ((left & _HIGH) != 0)) + low
    late = late[late >= low + 2]
    last = raw[late - 1]
    out[late[(raw[late - 2] == 0xC3) & (last != 0x97) & (last != 0xB7)] - low] = True  # U+00D7 and U+00F7 are signs
    out[1:] |= lone[:-1] & ((here[:-1] & _BREAK) != 0)
    out[edge] = True
    if n:
        out[0] = True
    return np.flatnonzero(out) + low


@dataclass
class Ids:
    """Token ids of a run of texts; those of text i are ``ids[first[i]:first[i + 1]]``."""

    ids: np.ndarray
    first: np.ndarray


class Encoder:
    """Encodes runs of texts; made once in each Python worker."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # in a text their strings are ordinary text
        self.remembered, self.known, self.older = remembered, {}, {}
        self.mark, self.mark_id = self._marks()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _marks(self) -> tuple[str, int]:
        """A string that is one id of its own between any two chunks without it, or none."""
        for mark, alone in (("\n", "\n"), (" \x01 ", "\x01")):
            ids = self._ids(alone)
            if len(ids) == 1 and all(self._ids(mark.join(t)) == [i for k, c in enumerate(t) for i in (ids * (k > 0) + self._ids(c))]
                                     for t in (("a", "b"), (" a", " b", "."), ("a1", ".", "é", " é"))):
                return mark, ids[0]
        return "", -1

    def _fresh(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks: GROUP of them in one text with marks between, which costs the library less than each alone.

        A chunk with white space but a leading space, or with a mark's character, goes alone.
        """
        out: list[bytes] = [b""] * len(chunks)
        plain = [i for i, c in enumerate(chunks) if self.mark and _SIMPLE.fullmatch(c)]
        alone = sorted(set(range(len(chunks))).difference(plain))
        for i, e in zip(alone, self.tokenizer.encode_batch_fast([chunks[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, np.uint32).tobytes()
        groups = [plain[k:k + GROUP] for k in range(0, len(plain), GROUP)]
        joined = [self.mark.join([chunks[i] for i in g]) for g in groups]
        for g, e in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            at = np.flatnonzero(ids == self.mark_id)
            if len(at) != len(g) - 1:
                raise ValueError("a mark was lost between chunks")
            data, past = ids.tobytes(), 0
            for i, end in zip(g, [*(at * 4).tolist(), len(data)], strict=True):
                out[i] = data[past:end]
                past = end + 4
        return out

    def _learn(self, chunks: list[str]) -> list[bytes]:
        known, older = self.known, self.older
        out = list(map(known.get, chunks))
        absent = [i for i, v in enumerate(out) if v is None]
        for i in absent:
            out[i] = older.get(chunks[i])
        new = [i for i in absent if out[i] is None]
        if new:
            for i, ids in zip(new, self._fresh([chunks[i] for i in new]), strict=True):
                out[i] = ids
        if len(known) + len(absent) > self.remembered:
            self.older = known
            known = self.known = {}
        known.update((chunks[i], out[i]) for i in absent[:self.remembered])
        return out

    def encode(self, raw: np.ndarray, bounds: np.ndarray, end: int) -> Ids:
        """Ids of the texts that ``bounds`` cut from ``raw``, each followed by the id ``end``."""
        count = len(bounds) - 1
        if bounds[-1] > bounds[0]:
            at = np.append(cuts(raw, bounds), bounds[-1])
            offsets = pa.py_buffer(np.ascontiguousarray(at, np.int64))
            chunks = pa.LargeStringArray.from_buffers(len(at) - 1, offsets, pa.py_buffer(raw))
            coded = chunks.dictionary_encode()
            code = coded.indices.to_numpy()
            pieces = self._learn(coded.dictionary.to_numpy(zero_copy_only=False).tolist())  # to_pylist boxes each first
            flat = np.frombuffer(b"".join(pieces), np.uint32)
            size = np.fromiter(map(len, pieces), np.int64, len(pieces)) >> 2
        else:
            at, code = bounds[-1:], np.empty(0, np.int64)
            flat, size = np.empty(0, np.uint32), np.empty(0, np.int64)
        # one more piece of one id closes every text
        flat, origin = np.append(flat, np.uint32(end)), np.append(np.cumsum(size) - size, size.sum())
        size = np.append(size, 1)
        before = np.searchsorted(at[:-1], bounds[1:])  # chunks up to the end of each text
        order = np.full(len(code) + count, len(size) - 1, np.int64)
        ends = before + np.arange(count)
        is_end = np.zeros(len(order), bool)
        is_end[ends] = True
        order[~is_end] = code
        each = size[order]
        past = np.cumsum(each)
        source = np.repeat(origin[order] - (past - each), each)
        source += np.arange(len(source))
        return Ids(flat[source], np.append(0, past[ends]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]



#: Bytes of text that are encoded at once.
RUN = 4 << 20


def encoded_texts(path: str, column: pa.Array, end: int, run: int = RUN):
    """(first row, Ids) of runs of a column's texts, about ``run`` bytes each; null counts as empty."""
    raw, bounds = utf8(column)
    for a, b in slices(bounds, run):
        yield a, encoder(path).encode(raw, bounds[a:b + 1], end)
