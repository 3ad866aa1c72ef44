"""A cuckoo filter of 64-bit keys on numpy arrays: batches are inserted, looked up and deleted in rounds.

Every key has a 16-bit fingerprint and two buckets of four cells; either bucket
and the fingerprint give the other bucket, so fingerprints can move without
their keys.  One copy is held per inserted key: deleting a key takes one copy
out and never harms another key that shares its fingerprint.  What finds no
cell after `ROUNDS` moves waits in a stash that look-ups also search.
"""

from __future__ import annotations

import numpy as np

from headroom.llm.texts import U, mix

SLOTS = 4
ROUNDS = 400
FULL = 0.8  # share of cells in use for which a filter is laid out


def buckets_for(keys: int) -> int:
    """Buckets (a power of two) that hold `keys` at no more than `FULL`."""
    need = max(keys, 64) / (SLOTS * FULL)
    return 1 << int(np.ceil(np.log2(need)))


def _ranks(groups: np.ndarray) -> np.ndarray:
    """Position of every entry among the entries of its value."""
    order = np.argsort(groups, kind="stable")
    ordered = groups[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
    out = np.empty(len(groups), np.int64)
    out[order] = np.arange(len(groups)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(groups)]))))
    return out


class Cuckoo:
    def __init__(self, buckets: int, cells: bytes | None = None, stash: bytes = b"", load: int = 0):
        self.buckets, self.load = buckets, load
        held = np.zeros((buckets, SLOTS), np.uint16) if cells is None else np.frombuffer(cells, np.uint16).reshape(buckets, SLOTS).copy()
        self.cells = held
        self.stash = np.frombuffer(stash, np.int64).reshape(-1, 2).copy()  # (bucket, fingerprint)

    def _places(self, keys: np.ndarray):
        """(first bucket, fingerprint); fingerprints are not 0, which marks a free cell."""
        spread = mix(keys.astype(np.uint64))
        fingers = (spread >> U(48)).astype(np.uint16)
        return (spread & U(self.buckets - 1)).astype(np.int64), np.where(fingers == 0, np.uint16(1), fingers)

    def _other(self, bucket: np.ndarray, fingers: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(fingers.astype(np.uint64) + U(77)) & U(self.buckets - 1)).astype(np.int64)

    def _put(self, bucket: np.ndarray, fingers: np.ndarray) -> np.ndarray:
        """Fill free cells of `bucket`; returns which entries are left over."""
        rank, rows = _ranks(bucket), self.cells[bucket] == 0
        turn = np.cumsum(rows, axis=1)
        fits = rank < turn[:, -1]
        slot = np.argmax((turn == (rank + 1)[:, None]) & rows, axis=1)
        self.cells[bucket[fits], slot[fits]] = fingers[fits]
        return ~fits

    def insert(self, keys: np.ndarray) -> None:
        bucket, fingers = self._places(keys)
        self.load += len(keys)
        left = self._put(bucket, fingers)
        bucket, fingers = self._other(bucket[left], fingers[left]), fingers[left]
        for turn in range(ROUNDS):
            left = self._put(bucket, fingers)
            bucket, fingers = bucket[left], fingers[left]
            if not len(bucket):
                return
            first = _ranks(bucket) == 0  # one eviction per bucket and round; the others try their second bucket
            at, slot = bucket[first], (fingers[first].astype(np.int64) + turn) % SLOTS
            evicted = self.cells[at, slot].copy()
            self.cells[at, slot] = fingers[first]
            fingers = np.concatenate((evicted, fingers[~first]))
            bucket = self._other(np.concatenate((at, bucket[~first])), fingers)
        self.stash = np.concatenate((self.stash, np.stack([bucket, fingers.astype(np.int64)], axis=1)))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """False: certainly not inserted.  True: inserted, or alike by chance (about 8 in 65,536)."""
        bucket, fingers = self._places(keys)
        other = self._other(bucket, fingers)
        found = (self.cells[bucket] == fingers[:, None]).any(axis=1) | (self.cells[other] == fingers[:, None]).any(axis=1)
        if len(self.stash):
            waiting = {tuple(x) for x in self.stash.tolist()}
            for i in np.flatnonzero(~found):
                found[i] = (int(bucket[i]), int(fingers[i])) in waiting or (int(other[i]), int(fingers[i])) in waiting
        return found

    def delete(self, keys: np.ndarray) -> None:
        """Take one copy of every key out; all keys have to be inserted ones."""
        bucket, fingers = self._places(keys)
        self.load -= len(keys)
        for side in (bucket, self._other(bucket, fingers)):
            todo = np.arange(len(side))
            while len(todo):
                todo = todo[fingers[todo] > 0]
                first = _ranks(side[todo]) == 0  # one removal per bucket and round
                now, later = todo[first], todo[~first]
                match = self.cells[side[now]] == fingers[now][:, None]
                hit = match.any(axis=1)
                self.cells[side[now][hit], np.argmax(match, axis=1)[hit]] = 0
                fingers[now[hit]] = 0  # done
                todo = later
        rest = np.flatnonzero(fingers)
        if len(rest) and len(self.stash):
            entries = [tuple(x) for x in self.stash.tolist()]
            first, finger = self._places(keys[rest])
            other = self._other(first, finger)
            for a, b, f in zip(first.tolist(), other.tolist(), finger.tolist()):
                entry = (a, f) if (a, f) in entries else (b, f)
                if entry in entries:
                    entries.remove(entry)
            self.stash = np.array(entries, np.int64).reshape(-1, 2)

    def parts(self) -> tuple[int, bytes, bytes, int]:
        """(buckets, cells, stash, load), as the constructor takes them."""
        return self.buckets, self.cells.tobytes(), self.stash.astype(np.int64).tobytes(), self.load
