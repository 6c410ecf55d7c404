"""Suffix array of byte strings by two-stage sorting.

Stage one sorts directly only the suffixes that are smaller than their successors. Stage
two scans the buckets of first bytes upwards: a suffix greater than its successor stands
in a later place of the array than the successor, so when a bucket is reached, the order
in which its such suffixes were met is their sorted order. The scan of a bucket is a few
vector operations: within it, runs of one byte are followed step by step.

Suffixes are told apart on their first DEPTH bytes; equal ones lie side by side.
"""

from __future__ import annotations

import numpy as np

DEPTH = 200
#: Suffixes with equal first bytes that are compared in one go, about.
TIES = 1 << 16


def words_at(data: np.ndarray) -> np.ndarray:
    """For each position the next eight bytes as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(DEPTH + 8, dtype=np.uint8)])
    view = np.ndarray((len(padded) - 7,), dtype=">u8", buffer=padded, strides=(1,))
    return view.astype(np.uint64)


def strings_at(data: np.ndarray, kind: str) -> np.ndarray:
    """For each position the next DEPTH bytes, as items of a type of that size; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(DEPTH, dtype=np.uint8)])
    return np.ndarray((len(data),), dtype=kind, buffer=padded, strides=(1,))


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one a byte on; those that equal bytes to the end are told so too."""
    small = np.ones(len(data), dtype=bool)
    differ = data[:-1] != data[1:]
    differs = np.flatnonzero(differ)
    if len(differs):
        # A run of equal bytes goes by the byte after it.
        at = np.concatenate([[0], np.cumsum(differ)])
        inside = at < len(differs)
        end = differs[at[inside]]
        small[inside] = data[end] < data[end + 1]
    return small


def _sort_directly(data: np.ndarray, words: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Suffixes in order of their first DEPTH bytes: by eight bytes, then ties by the rest."""
    key = words[suffixes]
    order = np.argsort(key)
    out, key = suffixes[order], key[order]
    tied = np.flatnonzero(key[1:] == key[:-1])
    if len(tied):
        cut = np.diff(tied) > 1
        first = tied[np.concatenate([[True], cut])]
        last = tied[np.concatenate([cut, [True]])] + 2
        among = np.zeros(len(key), dtype=bool)
        among[tied] = among[tied + 1] = True
        among = np.flatnonzero(among)
        # Whole runs of ties, about TIES suffixes at a time, compared as strings.
        strings = strings_at(data, f"S{DEPTH}")
        ends = np.cumsum(last - first)
        cuts = np.flatnonzero(np.diff(ends // TIES, append=-1))
        for a, b in zip([0, *ends[cuts].tolist()], ends[cuts].tolist()):
            at = among[a:b]
            own = out[at]
            out[at] = own[np.argsort(strings[own], kind="stable")]
    return out


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order of their first DEPTH bytes."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    words = words_at(data)
    small = smaller_than_next(data)
    direct = _sort_directly(data, words, np.flatnonzero(small))
    edges = np.searchsorted(data[direct], np.arange(257))
    met: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for byte in np.unique(data).tolist():
        induced = met[byte]
        new = induced[-1:] and np.concatenate(induced)
        parts = [new] if len(new) else []
        while len(new):  # runs of this byte
            before = new[new > 0] - 1
            new = before[(data[before] == byte) & ~small[before]]
            if len(new):
                parts.append(new)
        parts.append(direct[edges[byte]:edges[byte + 1]])
        bucket = np.concatenate(parts)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[data[before] > byte]
        order = np.argsort(data[before], kind="stable")
        before = before[order]
        bytes_before = data[before]
        cuts = np.flatnonzero(np.diff(bytes_before)) + 1
        for part in np.split(before, cuts):
            if len(part):
                met[data[part[0]]].append(part)
    return np.concatenate(out)


def equal_to_last(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether each suffix in order shares its first DEPTH bytes with the one before."""
    same = np.zeros(len(order), dtype=bool)
    words = words_at(data)
    # Most of those that differ do so in their last eight bytes.
    end = words[np.minimum(order + DEPTH - 8, len(words) - 1)]
    open_ = np.flatnonzero(end[1:] == end[:-1]) + 1
    strings = strings_at(data, f"V{DEPTH}")
    for k in range(0, len(open_), TIES // 8):
        at = open_[k:k + TIES // 8]
        a, b = (strings[order[x]].view(np.uint64).reshape(-1, DEPTH // 8) for x in (at, at - 1))
        same[at] = (a == b).all(axis=1)
    return same


def repeated_starts(strings: list[bytes], texts: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a run of DEPTH bytes begins that lies within a string and begins at another place too,
    ascending, and where the strings begin; in all strings joined with a byte after each. A string
    comes from a text and begins there at its first; one place of a text may be in several strings
    and counts once."""
    # A zero byte parts the strings; runs that hold it are left out.
    data = np.frombuffer(b"".join(s + b"\0" for s in strings), dtype=np.uint8)
    lengths = np.array([len(s) + 1 for s in strings], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    whole = np.repeat(begins + lengths - 1, lengths) - np.arange(len(data)) >= DEPTH
    order = suffix_array(data)
    order = order[whole[order]]
    same = equal_to_last(data, order)
    many = same.copy()
    many[:-1] |= same[1:]
    order, new = order[many], np.flatnonzero(~same[many])
    if not len(order):
        return order, begins
    # Places of all texts, one text after another.
    _, text = np.unique(texts, return_inverse=True)
    shift = text * (int(firsts.max()) + len(data)) + firsts - begins
    place = order + np.repeat(shift, lengths)[order]
    twice = np.minimum.reduceat(place, new) != np.maximum.reduceat(place, new)
    return np.sort(order[np.repeat(twice, np.diff(new, append=len(order)))]), begins


def repeated_places(strings: list[bytes], at: list[tuple[int, int]]) -> list[np.ndarray]:
    """For each string, where a run of DEPTH bytes begins that is repeated (see repeated_starts).
    `at` tells the text a string comes from and where it begins there."""
    texts, firsts = np.array(at, dtype=np.int64).reshape(-1, 2).T
    starts, begins = repeated_starts(strings, texts, firsts)
    hit = np.zeros(sum(len(s) + 1 for s in strings), dtype=bool)
    hit[starts] = True
    return [hit[b:b + len(s)] for b, s in zip(begins.tolist(), strings)]
