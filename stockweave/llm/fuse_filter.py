"""Binary fuse filters (Graf and Lemire, 2022): static sets of 64-bit keys in about 9 bits a key."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 over key + seed."""
    h = keys + np.uint64(seed)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):  # fixed values
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


@dataclass
class FuseFilter:
    """Three places for each key in neighbouring segments; one-byte fingerprints."""

    seed: int
    segment_length: int
    table: np.ndarray

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = len(self.table) - 2 * self.segment_length
        mask = np.uint64(self.segment_length - 1)
        first = ((hashes >> np.uint64(32)) * np.uint64(starts)) >> np.uint64(32)
        second = (first + np.uint64(self.segment_length)) ^ ((hashes >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * self.segment_length)) ^ (hashes & mask)
        return first.astype(np.int64), second.astype(np.int64), third.astype(np.int64)

    @staticmethod
    def _fingerprints(hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.table):
            return np.zeros(len(keys), dtype=bool)
        hashes = _mix(keys, self.seed)
        a, b, c = self._places(hashes)
        return (self.table[a] ^ self.table[b] ^ self.table[c]) == self._fingerprints(hashes)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        if not n:
            return cls(0, 1, np.zeros(0, dtype=np.uint8))
        length = 1 << max(2, int(np.floor(np.log(n) / np.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        segments = max(1, int(np.ceil(max(n * factor, 8) / length)) - 2) + 2
        for seed in range(1, 1000):
            made = cls(seed, length, np.zeros(segments * length, dtype=np.uint8))
            if made._fill(_mix(keys, seed)):
                return made
            if seed % 10 == 0:
                segments += 1 + segments // 10
        raise ValueError("no seed places all keys")

    def _fill(self, hashes: np.ndarray) -> bool:
        """Peel keys that are alone in a place, all at once, and set those places in reverse."""
        places = np.stack(self._places(hashes))
        alive = np.ones(len(hashes), dtype=bool)
        rounds: list[tuple[np.ndarray, np.ndarray]] = []
        while alive.any():
            left = np.flatnonzero(alive)
            degree = np.bincount(places[:, left].ravel(), minlength=len(self.table))
            alone = degree[places[:, left]] == 1
            peeled = alone.any(axis=0)
            if not peeled.any():
                return False
            rounds.append((left[peeled], alone[:, peeled].argmax(axis=0)))
            alive[left[peeled]] = False
        fingerprints = self._fingerprints(hashes)
        for keys, own in reversed(rounds):
            others = places[:, keys].copy()
            mine = others[own, np.arange(len(keys))]
            values = self.table[others]
            values[own, np.arange(len(keys))] = 0
            self.table[mine] = fingerprints[keys] ^ values[0] ^ values[1] ^ values[2]
        return True
