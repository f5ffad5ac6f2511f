"""Token ids of whole texts by a byte-level BPE file of ``tokenizers``.

Such a tokenizer first cuts a text at letter, digit, punctuation and space runs
and encodes each cut on its own. The cuts are found here with array operations,
each distinct cut is encoded once per worker by the library itself, and the ids
are gathered from that table. Texts with characters beyond U+052F or with a
special token's string are encoded whole by the library.
"""

from __future__ import annotations

import os
import unicodedata
from itertools import chain

import numpy as np

from .common import mix, powers, ranges

FAST_BELOW = 0x530
CACHE_CUTS = 1_000_000

# fixed value: how byte-level BPE vocabularies of this family cut a text
CUT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Unicode white space below FAST_BELOW
_SPACES = (9, 10, 11, 12, 13, 0x20, 0x85, 0xA0)
_KIND = np.array([0 if c in _SPACES else {"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 3) for c in range(FAST_BELOW)], np.uint8)
_VALUE = np.random.RandomState(7).randint(0, 2**63 - 1, FAST_BELOW, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def cut_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the cuts of adjacent texts begin. points: code points below
    FAST_BELOW; text_starts: first place of each non-empty text."""
    kind = _KIND[points]
    n = len(points)
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    space = kind == 0
    new = np.ones(n, bool)
    new[1:] = kind[1:] != kind[:-1]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = points[:-1] == 32
    next_text = np.zeros(n, bool)  # something other than a space follows in this text
    next_text[:-1] = ~space[1:] & ~first[1:n]
    start = np.where(space, new | next_text, new & ~after_blank) | first[:n]
    # 's 't 'm 'd 're 've 'll after a cut that begins with the apostrophe
    for i in np.flatnonzero((points == 39) & start):
        i = int(i)
        if i + 1 >= n or first[i + 1] or kind[i + 1] != 1:
            continue
        a = points[i + 1]
        k = 0
        if a in (115, 116, 109, 100):
            k = 1
        elif i + 2 < n and not first[i + 2] and (int(a), int(points[i + 2])) in ((114, 101), (118, 101), (108, 108)):
            k = 2
        if k:
            start[i + 1] = False
            if i + 1 + k < n and not first[i + 1 + k] and kind[i + 1 + k] == 1:
                start[i + 1 + k] = True
    return np.flatnonzero(start)


def _from_ranks(path: str):
    """tiktoken's encoding of a rank file and the byte length of each id."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=CUT_PATTERN, mergeable_ranks=ranks, special_tokens={}), size


class Encoder:
    """Ids of many texts; keeps the ids of distinct cuts between calls, in a hash
    table probed with array operations. ranks_path: the same vocabulary as a
    tiktoken rank file, with which new cuts that begin with a blank are encoded
    (three times as fast, same ids)."""

    TABLE_BITS = 21

    def __init__(self, path: str, ranks_path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.ranks = _from_ranks(ranks_path) if ranks_path else None
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(1 << self.TABLE_BITS, np.uint64)  # 0: free
        self.values = np.zeros(1 << self.TABLE_BITS, np.int32)
        self.cuts = self.stored = 0  # how much of the next three is in use
        self.first = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.uint32)

    def _probe(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int32)
        at = (hashes >> np.uint64(64 - self.TABLE_BITS)).astype(np.int64)
        here = self.keys[at]
        hit = here == hashes
        out[hit] = self.values[at[hit]]
        todo = np.flatnonzero(~hit & (here != 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            here = self.keys[at[todo]]
            hit = here == hashes[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (here != 0)]
        return out

    def _insert(self, hashes: np.ndarray, slots: np.ndarray) -> None:
        """Distinct hashes that are not there yet."""
        at = (hashes >> np.uint64(64 - self.TABLE_BITS)).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):
            free = todo[self.keys[at[todo]] == 0]
            self.keys[at[free]] = hashes[free]  # of several with one place, the last stays
            won = free[self.keys[at[free]] == hashes[free]]
            self.values[at[won]] = slots[won]
            todo = todo[self.keys[at[todo]] != hashes[todo]]
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)

    def _ids(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of these cuts in order, and how many each has."""
        blank = [i for i, c in enumerate(cuts) if c[0] == " " and len(c) > 1 and c[1] != " " and not c[1].isspace()] if self.ranks else []
        n = np.zeros(len(cuts), np.int64)
        if len(blank) == len(cuts):
            rest, other = [], []
        else:
            marked = set(blank)
            rest = [i for i in range(len(cuts)) if i not in marked]
            other = [e.ids for e in self.model.encode_batch_fast([cuts[i] for i in rest], add_special_tokens=False)]
            n[rest] = [len(x) for x in other]
        if not blank:
            return np.fromiter(chain.from_iterable(other), np.uint32, int(n.sum())), n
        model, size = self.ranks
        chosen = [cuts[i] for i in blank]
        ids = np.array(model.encode_ordinary("".join(chosen)), np.uint32)  # each blank begins a cut again
        ends = np.cumsum(np.fromiter((len(c.encode()) for c in chosen), np.int64, len(chosen)))
        upto = np.searchsorted(np.cumsum(size[ids]), ends) + 1
        n[blank] = np.diff(upto, prepend=0)
        first = np.cumsum(n) - n
        out = np.zeros(int(n.sum()), np.uint32)
        out[ranges(first[blank], n[blank])] = ids
        for i, x in zip(rest, other, strict=True):
            out[first[i] : first[i] + len(x)] = x
        return out, n

    def _add(self, cuts: list[str]) -> np.ndarray:
        """Store the ids of new cuts; returns their slots."""
        ids, n = self._ids(cuts)
        while self.cuts + len(n) > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        while self.stored + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        slots = np.arange(self.cuts, self.cuts + len(n))
        self.first[slots] = self.stored + np.cumsum(n) - n
        self.count[slots] = n
        self.flat[self.stored : self.stored + len(ids)] = ids
        self.cuts, self.stored = self.cuts + len(n), self.stored + len(ids)
        return slots

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each text's ids begin (one more entry)."""
        counts = np.zeros(len(texts), np.int64)
        whole: dict[int, np.ndarray] = {}
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        fast = [i for i, t in enumerate(texts) if t]
        if any(s in joined for s in self.special) or (len(points) and points.max() >= FAST_BELOW):
            whole = {i: np.zeros(0) for i in fast if ord(max(texts[i])) >= FAST_BELOW or any(s in texts[i] for s in self.special)}
            for i in whole:
                whole[i] = np.array(self.model.encode(texts[i], add_special_tokens=False).ids, np.uint32)
                counts[i] = len(whole[i])
            fast = [i for i in fast if i not in whole]
            joined = "".join(texts[i] for i in fast)
            points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ids = np.zeros(0, np.uint32)
        if fast:
            sizes = np.fromiter((len(texts[i]) for i in fast), np.int64, len(fast))
            begin = np.cumsum(sizes) - sizes
            starts = cut_starts(points, begin)
            ends = np.append(starts[1:], len(points))
            total = np.zeros(len(points) + 1, np.uint64)
            np.cumsum(_VALUE[points] * powers(_P, len(points)), out=total[1:])
            hashes = mix((total[ends] - total[starts]) * powers(_P_INV, len(points) + 1)[starts] + (ends - starts).astype(np.uint64))
            hashes |= np.uint64(1)
            if self.cuts > CACHE_CUTS:
                self._clear()
            slots = self._probe(hashes)
            missing = np.flatnonzero(slots < 0)
            if len(missing):
                new, where, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
                where = missing[where]
                added = self._add([joined[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
                self._insert(new, added)
                slots[missing] = added[which]
            n = self.count[slots]
            ids = self.flat[ranges(self.first[slots], n)]
            done = np.concatenate(([0], np.cumsum(n)))
            at = np.searchsorted(starts, np.append(begin, len(points)))
            counts[fast] = np.diff(done[at])
        first = np.concatenate(([0], np.cumsum(counts)))
        if not whole:
            return ids, first
        out = np.zeros(int(first[-1]), np.uint32)
        quick = np.ones(len(out), bool)
        for i, x in whole.items():
            out[first[i] : first[i + 1]] = x
            quick[first[i] : first[i + 1]] = False
        out[quick] = ids
        return out, first


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, ranks_path: str | None = None) -> Encoder:
    """One encoder per worker process and file."""
    if (path, ranks_path) not in _ENCODERS:
        _ENCODERS[path, ranks_path] = Encoder(path, ranks_path)
    return _ENCODERS[path, ranks_path]
