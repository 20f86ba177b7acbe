"""Simple-8b word-aligned coding of unsigned integers, vectorised.

A 64-bit word has a 4-bit selector and up to 60 bits of values: selector s packs COUNT[s] values of BITS[s] bits.
Selector 15 is an escape: the next word holds one raw 64-bit value. Values are cut into blocks of BLOCK, each coded
on its own; a block's words are found by its offset, so blocks decode independently and all at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
COUNT = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30])
_U = np.uint64
ESCAPE = 15
# selectors 0 to 14 hold 240, 120, 60, ... 2 values; a lone value of up to 60 bits takes selector 14 padded with a zero
# if it fits in 30 bits, and the escape otherwise


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths; exact for all 64 bits."""
    high = (values >> _U(32)).astype(np.float64)
    low = (values & _U(0xFFFFFFFF)).astype(np.float64)
    _, eh = np.frexp(high)
    _, el = np.frexp(low)
    return np.where(high > 0, eh + 32, el)


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, offsets): offsets has the first word of each block and, last, the number of words."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // block)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    padded = np.zeros(blocks * block + int(COUNT.max()), np.uint64)
    padded[:n] = values
    need = _bits(padded[: blocks * block]).astype(np.int16)
    stop = np.minimum(np.arange(1, blocks + 1) * block, n)
    # the selector for each position: the one with most values that all fit; past a block's end zeros are packed
    grid = np.zeros((blocks, block + int(COUNT.max())), np.int16)
    grid[:, :block] = need.reshape(blocks, block)
    best = np.full((blocks, block), ESCAPE, np.int8)
    widest: dict[int, np.ndarray] = {1: grid}
    k = 1
    while 2 * k <= COUNT.max():
        a = widest[k]
        widest[2 * k] = np.maximum(a[:, : a.shape[1] - k], a[:, k:])
        k *= 2
    for s in range(14, -1, -1):
        c = int(COUNT[s])
        p = 1 << (c.bit_length() - 1)
        w = widest[p]
        top = np.maximum(w[:, :block], w[:, c - p : c - p + block])
        best[top <= BITS[s]] = s
    best = best.ravel()
    pos = np.arange(blocks) * block
    live = np.arange(blocks)
    at, of = [], []
    while len(live):
        at.append(pos[live])
        of.append(live)
        pos[live] += COUNT[best[pos[live]]]
        live = live[pos[live] < stop[live]]
    at, of = np.concatenate(at), np.concatenate(of)
    by = np.argsort(at)
    at, of = at[by], of[by]
    selector = best[at].astype(np.int64)
    words_of = np.where(selector == ESCAPE, 2, 1)
    where = np.cumsum(words_of) - words_of
    out = np.zeros(int(words_of.sum()), np.uint64)
    # a word may reach past its block's end; what lies there must pack as zero
    limit = stop[of]
    for s in np.unique(selector):
        chosen = selector == s
        p = at[chosen]
        if s == ESCAPE:
            out[where[chosen]] = _U(ESCAPE) << _U(60)
            out[where[chosen] + 1] = padded[p]
            continue
        word = np.full(len(p), _U(int(s)) << _U(60), np.uint64)
        if BITS[s]:
            span = p[:, None] + np.arange(COUNT[s])
            v = np.where(span < limit[chosen][:, None], padded[span], _U(0))
            word |= np.bitwise_or.reduce(v << (np.arange(COUNT[s]) * BITS[s]).astype(np.uint64), axis=1)
        out[where[chosen]] = word
    offsets = np.zeros(blocks + 1, np.int64)
    np.cumsum(np.bincount(of, weights=words_of, minlength=blocks).astype(np.int64), out=offsets[1:])
    return out, offsets


def decode(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values of consecutive blocks; all but the last block are full."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> _U(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (selector == ESCAPE).any():  # a raw word follows each escape; a raw word may itself look like one
        e = np.flatnonzero(selector == ESCAPE)
        new = np.ones(len(e), bool)
        new[1:] = (np.diff(e) > 1) | np.isin(e[1:], offsets)
        first = np.maximum.accumulate(np.where(new, np.arange(len(e)), 0))
        real = (np.arange(len(e)) - first) % 2 == 0
        raw[e[real] + 1] = True
    head = np.flatnonzero(~raw)
    selector = selector[head]
    count = COUNT[selector]
    block_of = np.searchsorted(offsets, head, "right") - 1
    before = np.cumsum(count) - count
    first = np.searchsorted(head, offsets[:-1])
    place = before - before[first][block_of] + block_of * block
    out = np.zeros((len(offsets) - 1) * block + int(COUNT.max()), np.uint64)
    stop = np.minimum((block_of + 1) * block, n)
    for s in np.unique(selector):
        chosen = selector == s
        p, w = place[chosen], words[head[chosen]]
        if s == ESCAPE:
            out[p] = words[head[chosen] + 1]
        elif BITS[s]:
            span = p[:, None] + np.arange(COUNT[s])
            v = (w[:, None] >> (np.arange(COUNT[s]) * BITS[s]).astype(np.uint64)) & _U((1 << int(BITS[s])) - 1)
            ok = span < stop[chosen][:, None]
            out[span[ok]] = v[ok]
    return out[:n]
