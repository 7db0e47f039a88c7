"""Cutting a text where byte-level pre-tokenisation is bound to cut it, so that equal pieces need encoding once.

A space between two characters that are not white space always starts a new pre-token, whatever stands around it. Pieces cut
there can be encoded apart from each other and their ids joined. Longer runs of white space stay inside one piece.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RUN = re.compile(r" (?:\s|(?<=\s ))")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACES = "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace()) + "]"
#: ``_RUN`` without looking back, and with Python's white space spelled out, for Arrow.
_ARROW_RUN = f" {_SPACES}|{_SPACES} "
#: Pieces kept in memory by a worker; of a full store those used last stay, which changes no result.
KEPT = 300_000
#: Longer pieces are not kept.
LONGEST = 48


def pieces(text: str) -> list[str]:
    """Pieces that joined by single spaces give the text; each is encoded with its space, but for the first."""
    return _CUT.split(text) if _RUN.search(text) else text.split(" ")


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``pieces`` of all texts one after another, and where each text's begin, with their end."""
    lists = pc.split_pattern(texts, " ")
    runs = np.flatnonzero(pc.match_substring_regex(texts, _ARROW_RUN).to_numpy(zero_copy_only=False))
    if len(runs):  # rows of these are replaced
        others = pa.array([pieces(x) for x in texts.take(pa.array(runs)).to_pylist()], lists.type)
        order = np.arange(len(texts))
        order[runs] = len(texts) + np.arange(len(runs))
        lists = pa.concat_arrays([lists, others]).take(pa.array(order))
    return lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])


class PieceStore:
    """Ids of pieces as little-endian unsigned 32-bit integers, encoded by ``encode`` in bulk, where new. Two halves: when the newer is full, the older one is let go."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], kept: int = KEPT):
        self.encode, self.kept, self.known, self.older = encode, kept, {}, {}

    def flat_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all whole texts one after another, and how many each has."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        flat, bounds = cut(texts)
        firsts = bounds[:-1]
        coded = flat.dictionary_encode()
        words, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        begin = [words[i] for i in codes[firsts].tolist()]  # encoded without a space, and not kept
        codes[firsts] = len(words) + np.arange(len(firsts))
        used = np.bincount(codes, minlength=len(words) + len(firsts))[: len(words)] > 0
        of_word = self._words(words, used, begin)
        sizes = np.fromiter(map(len, of_word), np.int64, len(of_word)) // 4
        starts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(of_word), "<u4")
        n = sizes[codes]
        ends = np.cumsum(n)
        place = np.repeat(starts[codes] - (ends - n), n)
        place += np.arange(len(place))
        return ids[place], np.add.reduceat(n, firsts)

    def _words(self, words: list[str], used: np.ndarray, begin: list[str]) -> list[bytes]:
        """Ids of each different piece after a space (none, if not used so), and of those that begin texts."""
        found, older = list(map(self.known.get, words)), self.older
        missing = np.flatnonzero(used & np.fromiter((x is None for x in found), bool, len(found))).tolist()
        fresh = []
        for i in missing:
            if (old := older.get(words[i])) is None:
                fresh.append(i)
            else:
                found[i] = self.known[words[i]] = old
        new = [words[i] for i in fresh]
        *coded, = self.encode([*begin, *[" " + x for x in new]])
        own = coded[len(begin) :]
        self.known.update(zip(new, own, strict=True))
        for i, x, ids in zip(fresh, new, own, strict=True):
            found[i] = ids
            if len(x) > LONGEST:
                del self.known[x]
        if 2 * len(self.known) > self.kept:
            self.known, self.older = {}, self.known
        for i in np.flatnonzero(~used).tolist():
            found[i] = b""
        return found + coded[: len(begin)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text."""
        ids, n = self.flat_ids(pa.array(texts, pa.string()))
        data, ends = ids.tobytes(), (4 * np.cumsum(n)).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]
