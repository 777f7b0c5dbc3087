"""Static range asymmetric numeral system over blocks of interleaved lanes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LANES = 32
STEPS = 512
#: Ids in a block; every block can be decoded without the others.
BLOCK = LANES * STEPS
_LEAST = np.uint64(1 << 31)  # a state is in [2^31, 2^63) and takes or gives words of 32 bits


@dataclass
class Coded:
    """``symbols`` and ``freqs`` are the table that all blocks share; the rest is by block."""

    count: int
    bits: int
    symbols: np.ndarray  # ids, ascending
    freqs: np.ndarray  # sum to 2^bits
    words: np.ndarray  # all blocks' words, one block after the other
    offsets: np.ndarray  # where each block's words begin
    states: np.ndarray  # blocks x LANES


def table(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies that sum to 2^bits, none zero, near the counts' shares."""
    total = 1 << bits
    freqs = np.maximum(1, np.floor(counts * (total / counts.sum()))).astype(np.int64)
    over = int(freqs.sum()) - total
    order = np.argsort(-counts, kind="stable")
    if over < 0:
        freqs[order[0]] -= over
    for i in order:
        if over <= 0:
            break
        take = min(over, int(freqs[i]) // 2)
        freqs[i] -= take
        over -= take
    return freqs


def encode(ids: np.ndarray) -> Coded:
    """Code a run of ids; an empty run has no blocks."""
    count = len(ids)
    if not count:
        none = np.empty(0, np.int64)
        return Coded(0, 0, none, none, none.astype(np.uint32), none, np.empty((0, LANES), np.uint64))
    if int(ids.max()) < 1 << 22:
        tally = np.bincount(ids)
        symbols = np.flatnonzero(tally)
        counts, place = tally[symbols], np.zeros(len(tally), np.int32)
        place[symbols] = np.arange(len(symbols))
        index = place[ids]
    else:
        symbols, index, counts = np.unique(ids, return_inverse=True, return_counts=True)
    bits = max(20, int(len(symbols)).bit_length() + 2)
    freqs = table(counts, bits)
    freq = freqs.astype(np.uint64)
    start = np.cumsum(freq) - freq
    blocks = -(-count // BLOCK)
    padded = np.full(blocks * BLOCK, int(np.argmax(counts)), np.int64)  # the last block is filled up with the cheapest id
    padded[:count] = index
    grid = padded.reshape(blocks, STEPS, LANES)
    state = np.full((blocks, LANES), _LEAST, np.uint64)
    row = np.broadcast_to(np.arange(blocks, dtype=np.int32)[:, None], state.shape)
    words, owners = [], []
    for step in range(STEPS - 1, -1, -1):  # decoded in the other direction
        at = grid[:, step, :]
        f = freq[at]
        full = state >= (f << np.uint64(63 - bits))
        words.append(state[full].astype(np.uint32))
        owners.append(row[full])
        state = np.where(full, state >> np.uint64(32), state)
        whole = state // f
        state = (whole << np.uint64(bits)) + (state - whole * f) + start[at]
    words, owners = np.concatenate(words[::-1]), np.concatenate(owners[::-1])
    words = words[np.argsort(owners, kind="stable")]
    sizes = np.bincount(owners, minlength=blocks)
    return Coded(count, bits, symbols.astype(np.int64), freqs, words, np.cumsum(sizes) - sizes, state)


def decode(coded: Coded, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` up to ``last``, by default of all."""
    last = len(coded.states) if last is None else last
    if last <= first:
        return np.empty(0, np.uint32)
    bits = np.uint64(coded.bits)
    freq = coded.freqs.astype(np.uint64)
    start = np.cumsum(freq) - freq
    by_slot = np.repeat(np.arange(len(freq), dtype=np.int32), coded.freqs)
    low = np.uint64((1 << coded.bits) - 1)
    state = coded.states[first:last].copy()
    words = np.append(coded.words, np.uint32(0)).astype(np.uint64)
    at = coded.offsets[first:last].astype(np.int64)
    out = np.empty((last - first, STEPS, LANES), np.int32)
    for step in range(STEPS):
        slot = state & low
        symbol = by_slot[slot]
        out[:, step, :] = symbol
        state = freq[symbol] * (state >> bits) + slot - start[symbol]
        need = state < _LEAST
        rank = np.cumsum(need, axis=1)
        source = np.where(need, at[:, None] + rank - 1, len(words) - 1)
        state = np.where(need, (state << np.uint64(32)) | words[source], state)
        at += rank[:, -1]
    ids = coded.symbols.astype(np.uint32)[out.reshape(-1)]
    return ids[:max(0, min(coded.count, last * BLOCK) - first * BLOCK)]
