"""Bags of word shingles, and their BagMinHash signatures, in numpy."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import xxhash

TOKEN = re.compile(r"\w+")
REMEMBERED = 1 << 16
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1] from the upper 53 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) / (1 << 53)


@lru_cache(REMEMBERED)
def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.lower())


class Bags(NamedTuple):
    """Bags of many texts end to end: the text each entry is of, its shingle's hash, how often it occurs."""

    count: int
    owner: np.ndarray
    shingle: np.ndarray
    times: np.ndarray

    def totals(self) -> np.ndarray:
        return np.bincount(self.owner, self.times, self.count).astype(np.int64)

    def bounds(self) -> np.ndarray:
        return np.searchsorted(self.owner, np.arange(self.count + 1))


def bags_of(texts: Sequence[str], width: int) -> Bags:
    """Bags of shingles of `width` words, in lower case; fewer words than that are one shingle, none give an empty bag."""
    words = [TOKEN.findall(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    total = int(sizes.sum())
    hashes = np.zeros(total + width, np.uint64)
    hashes[:total] = np.fromiter((h for w in words for h in map(word_hash, w)), np.uint64, total)
    owner = np.repeat(np.arange(len(texts)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    begins = ends - np.repeat(sizes, sizes)
    at = np.arange(total)
    shingle = np.zeros(total, np.uint64)
    for k in range(width):
        inside = at + k < ends
        shingle = mixed(shingle + _GOLDEN + np.where(inside, hashes[k : k + total], np.uint64(k + 1)))
    whole = (at + width <= ends) | (at == begins)
    owner, shingle = owner[whole], shingle[whole]
    order = np.argsort(shingle, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    owner, shingle = owner[order], shingle[order]
    if not len(owner):
        return Bags(len(texts), owner, shingle, np.zeros(0, np.int64))
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])]))
    return Bags(len(texts), owner[first], shingle[first], np.diff(np.append(first, len(owner))))


def nodes_of(bags: Bags) -> list[int | None]:
    """A 64-bit name of each bag, the same for equal bags; none for empty ones."""
    bounds, names = bags.bounds(), []
    for a, b in zip(bounds, bounds[1:]):
        told = bags.shingle[a:b].tobytes() + bags.times[a:b].astype(np.int64).tobytes()
        names.append(int(np.uint64(xxhash.xxh3_64_intdigest(told)).astype(np.int64)) if b > a else None)
    return names


def signatures(bags: Bags, parts: int, seed: int) -> np.ndarray:
    """BagMinHash: an array (text, part) of which two agree in a part as often as their weighted Jaccard similarity.

    A shingle that occurs w times owns the weights up to w. The weights are cut at 1, 2, 4, 8, ...;
    each interval has a Poisson process of its own, seeded by shingle and interval, of as many
    points a unit of time as it is wide, for each part. A point carries the weight at which it
    lies and counts for a bag whose weight of the shingle reaches it. A part of the signature is
    the time of its first point. Points are drawn in order of time and only as long as they may
    come before the last first point, so a text of many shingles needs about one point for each.
    """
    found = np.full((bags.count, parts), np.inf)
    if not len(bags.owner):
        return found
    levels = np.where(bags.times > 1, np.ceil(np.log2(np.maximum(bags.times, 1))).astype(np.int64), 0) + 1
    entry = np.repeat(np.arange(len(bags.owner)), levels)
    level = np.arange(len(entry)) - np.repeat(np.cumsum(levels) - levels, levels)
    owner, weight = bags.owner[entry], bags.times[entry].astype(float)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    wide = np.where(level > 0, low, 1.0)
    state = mixed(bags.shingle[entry] + _GOLDEN * (level.astype(np.uint64) + np.uint64(1)) + mixed(np.array([seed + 1], np.uint64)))
    rate = wide * parts

    # Enough time for all parts to get a point in all but a few texts; those get more.
    until = (np.log(parts) + 4.0) / np.maximum(bags.totals(), 1)
    state = mixed(state + _GOLDEN)
    time = -np.log(_unit(state)) / rate
    empty = np.bincount(owner, minlength=bags.count) == 0
    while True:
        live = np.flatnonzero(time <= until[owner])
        while len(live):
            lies = low[live] + wide[live] * _unit(mixed(state[live] ^ np.uint64(0xA0761D6478BD642F)))
            counts = lies <= weight[live]
            part = (mixed(state[live] ^ np.uint64(0xE7037ED1A0B428DB)) % np.uint64(parts)).astype(np.int64)
            np.minimum.at(found, (owner[live][counts], part[counts]), time[live][counts])
            state[live] = mixed(state[live] + _GOLDEN)
            time[live] -= np.log(_unit(state[live])) / rate[live]
            live = live[time[live] <= until[owner[live]]]
        short = np.isinf(found).any(axis=1) & ~empty
        if not short.any():
            return found
        until[short] *= 2.0


def band_keys(found: np.ndarray, bands: int, seed: int) -> np.ndarray:
    """A 64-bit key of each band of each signature, different in different bands."""
    parts = found.view(np.uint64).reshape(len(found), bands, -1)
    keys = np.arange(bands, dtype=np.uint64)[None, :] + np.uint64((seed << 20) + 1)
    keys = np.broadcast_to(mixed(keys), parts.shape[:2])
    for k in range(parts.shape[2]):
        keys = mixed(keys + _GOLDEN + parts[:, :, k])
    return keys.astype(np.int64)


def overlap(bags: Bags, a: int, b: int, bounds: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags: the lesser counts over the larger ones."""
    sa, sb = slice(bounds[a], bounds[a + 1]), slice(bounds[b], bounds[b + 1])
    ta, tb = bags.times[sa], bags.times[sb]
    _, ia, ib = np.intersect1d(bags.shingle[sa], bags.shingle[sb], assume_unique=True, return_indices=True)
    both = np.minimum(ta[ia], tb[ib]).sum()
    either = ta.sum() + tb.sum() - both
    return float(both / either) if either else 0.0
