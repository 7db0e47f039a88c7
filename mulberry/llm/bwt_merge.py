"""Repeated substrings of a collection of byte strings by merging Burrows-Wheeler transforms of its shards.

Strings are read as symbols of ``q`` bytes, one sequence for each of the q offsets, each sequence ended by a terminator of its own
that sorts before all symbols. Each shard's transform lists, in the order of the shard's suffixes, the symbol before each suffix.
To merge, only an interleave is refined: which shard each place of the merged order belongs to. Starting from the shards one after
another, each round reads the shards' transforms in the order of the interleave and deals the places out again by the symbols read,
stably; after h rounds the places are in the order of the first h symbols of their suffixes. Places that still agree in h symbols
form an interval, and the round in which two neighbours part is their common prefix. After as many rounds as the sought length has
symbols, or when no interval parts any more, intervals of two or more suffixes are the repeated substrings. No suffix is compared
or sorted again.
"""

from __future__ import annotations

import numpy as np

SHARDS = 4
#: Bytes in a symbol, most first; taken if the collection has few enough distinct symbols for 16 bits.
WIDTHS = (25, 20, 8, 5, 4, 2, 1)


def _ranked(code: np.ndarray, ends: np.ndarray, starts: np.ndarray, q: int) -> np.ndarray | None:
    """The 1-based rank of the code at each place, 0 where no symbol of ``q`` bytes begins; None if 16 bits don't hold the ranks."""
    begins = np.ones(len(code), bool)
    for k in range(q - 1):  # the last q - 1 places of each string
        begins[np.maximum(ends - 1 - k, starts)] = False
    if q > 1:
        begins[starts[ends - starts < q]] = False
    seen, rank = np.unique(code[begins], return_inverse=True)
    if len(seen) >= 65535:
        return None
    out = np.zeros(len(code), np.uint16)
    out[begins] = rank + 1
    return out


def _symbols(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int) -> tuple[int, np.ndarray]:
    """Width, and the 1-based rank of the symbol at each place; places where none begins hold 0.

    A symbol of over 8 bytes is spelled by the ranks of up to four of 8 bytes in it; the last overlaps the one before, where they
    agree, so that the order is still that of the bytes.
    """
    for q in WIDTHS:
        if length % q:
            continue
        code = np.zeros(len(data), np.uint64)
        for k in range(min(q, 8)):
            code[: len(data) - k] = code[: len(data) - k] * 256 + data[k:]
        out = _ranked(code, ends, starts, min(q, 8))
        if out is not None and q > 8:
            spelled = np.zeros(len(data), np.uint64)
            for k in (*range(0, q - 8, 8), q - 8):
                spelled <<= np.uint64(16)
                spelled[: max(0, len(data) - k)] |= out[k:]
            out = _ranked(spelled, ends, starts, q)
        if out is not None:
            return q, out
    raise AssertionError("single bytes always fit")


def _shard(symbols: np.ndarray, lengths: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffix order, transform and number of terminators of one shard.

    ``symbols`` holds each string's places and one more at its end; the last q of these are terminators' places.
    """
    n, stops = len(symbols), np.cumsum(lengths + 1)
    ended = np.zeros(n, bool)
    for k in range(q):
        ended[stops - 1 - k] = True
    count = int(ended.sum())
    rank = np.empty(n, np.int64)
    rank[ended] = np.arange(count)
    rank[~ended] = count + symbols[~ended].astype(np.int64)
    step, most = q, int(rank.max()) + 1
    while True:
        after = rank[np.minimum(np.arange(n) + step, n - 1)]
        key = rank * most + after
        key[ended] = rank[ended] * most
        order = np.argsort(key)  # the order of equal keys does not matter: they get one rank
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            break
        step, most = step * 2, n
    place = np.arange(n) - np.repeat(stops - lengths - 1, lengths + 1)
    before = np.where(place >= q, symbols[np.maximum(np.arange(n) - q, 0)], 0).astype(np.uint16)
    return order, before[order], count


def repeated(strings: list[bytes], weights: np.ndarray, length: int, shards: int = SHARDS) -> list[list[tuple[int, int]]]:
    """For each string the ranges [from, to) of places where a substring of ``length`` bytes starts that occurs at least twice.

    ``weights``: how often each string occurs, so that equal strings need to be given once.
    """
    lengths = np.array([len(x) for x in strings], np.int64)
    # each string is followed by one byte more, for the terminators' places
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    stops = np.cumsum(lengths + 1)
    starts = stops - lengths - 1
    q, symbols = _symbols(data, stops - 1, starts, length)
    if q > 1 and lengths.min() < q:
        raise ValueError("strings must not be shorter than a symbol")
    symbols[stops - 1] = 0
    cuts = np.linspace(0, len(strings), min(shards, len(strings)) + 1).astype(int)
    orders, befores, counts, offsets = [], [], [], []
    for a, b in zip(cuts, cuts[1:], strict=False):
        low, high = int(starts[a]), int(stops[b - 1])
        order, before, count = _shard(symbols[low:high], lengths[a:b], q)
        orders.append(order)
        befores.append(before)
        counts.append(count)
        offsets.append(low)
    sizes = [len(x) for x in orders]
    ended = sum(counts)
    interleave = np.repeat(np.arange(len(sizes), dtype=np.uint8), sizes)
    fixed = np.repeat(np.arange(len(sizes), dtype=np.uint8), counts)
    interval, parted = np.zeros(len(data), np.int32), 1
    read = np.empty(len(data), np.uint16)
    for _ in range(length // q):
        for s, before in enumerate(befores):
            read[interleave == s] = before
        dealt = np.argsort(read, kind="stable")[ended:]  # terminators' suffixes stand first, in the order of the strings
        symbol, source = read[dealt], interval[dealt]
        interleave = np.concatenate([fixed, interleave[dealt]])
        parts = np.empty(len(dealt), np.int32)
        parts[:1] = 1
        parts[1:] = (symbol[1:] != symbol[:-1]) | (source[1:] != source[:-1])
        interval = np.concatenate([np.arange(ended, dtype=np.int32), np.cumsum(parts, dtype=np.int32) + (ended - 1)])
        if (now := int(interval[-1])) == parted:
            break
        parted = now
    at = np.empty(len(data), np.int64)
    for s, order in enumerate(orders):
        at[interleave == s] = order + offsets[s]
    string = np.repeat(np.arange(len(strings)), lengths + 1)
    whole = np.arange(len(data)) - starts[string] <= lengths[string] - length
    weight = np.where(whole[at], np.asarray(weights)[string[at]], 0)
    total = np.bincount(interval, weights=weight)
    marked = np.zeros(len(data) + 1, np.int8)
    marked[at] = (total[interval] >= 2) & whole[at]
    edges = np.diff(marked, prepend=np.int8(0))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    for k, a, b in zip(string[begin].tolist(), begin.tolist(), end.tolist(), strict=True):
        out[k].append((a - int(starts[k]), b - int(starts[k])))
    return out
