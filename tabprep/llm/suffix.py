"""Suffix arrays by two-stage sorting, and where a string of fixed length occurs again, in one task's memory.

First stage: only suffixes smaller than their successors are sorted directly, seven characters at a time and only where
they still tie. Second stage: buckets are scanned in character order, and the suffixes before those scanned that are
larger than their successors follow from the scan. Comparisons stop at a depth that the caller sets; `repeats` takes the
strings' length, rounded up to whole words.
"""

from __future__ import annotations

import numpy as np

PACK, BITS = 7, 9  # characters in a machine word, bits of a character: a byte plus one, zero separates texts
DEPTH = 105  # where the caller sets none


def _depth(length: int) -> int:
    return -(-length // PACK) * PACK


def _packed(t: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For each place its next seven characters as one number."""
    padded = np.concatenate([t, np.zeros(depth + PACK, t.dtype)]).astype(np.uint64)
    out = np.zeros(len(padded), np.uint64)
    for k in range(PACK):
        out[:len(out) - k] |= padded[k:] << np.uint64(BITS * (PACK - 1 - k))
    return out


def _smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a place later; the last one counts as smaller."""
    n = len(t)
    up = np.ones(n, bool)
    up[:-1] = t[:-1] < t[1:]
    decides = np.ones(n, bool)  # places whose next character differs
    decides[:-1] = t[:-1] != t[1:]
    next_ = np.where(decides, np.arange(n), n)
    return up[np.minimum.accumulate(next_[::-1])[::-1]]


def _sort_directly(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Sort suffixes by their first `depth` characters, one word at a time among those that tie so far."""
    first = words[places]
    order = np.argsort(first, kind="stable")
    places, first = places[order], first[order]
    tie = np.flatnonzero(first[1:] == first[:-1])
    group = np.cumsum(np.r_[True, first[1:] != first[:-1]]) if len(places) else np.empty(0, int)
    open_ = np.zeros(len(places), bool)
    open_[tie] = open_[tie + 1] = True
    at = np.flatnonzero(open_)
    label = group[at]
    for offset in range(PACK, depth, PACK):
        if not len(at):
            break
        word = words[places[at] + offset]
        order = np.lexsort((word, label))
        places[at] = places[at][order]
        word = word[order]
        new = np.r_[True, (label[1:] != label[:-1]) | (word[1:] != word[:-1])]
        label = np.cumsum(new)
        still = ~new | ~np.r_[new[1:], True]
        at, label = at[still], label[still]
    return places


def suffix_array(t: np.ndarray, words: np.ndarray | None = None, depth: int = DEPTH) -> np.ndarray:
    """Places of all suffixes of `t` (characters 1 to 256, 0 between texts), sorted by `depth` characters at least."""
    if not len(t):
        return np.empty(0, np.int64)
    words = _packed(t, depth) if words is None else words
    direct = _smaller_than_next(t)
    sorted_ = _sort_directly(np.flatnonzero(direct), words, depth)
    top = 1 << BITS
    first = t[sorted_]
    cuts = np.searchsorted(first, np.arange(top + 1))
    induced: dict[int, list[np.ndarray]] = {}
    out = []
    for c in range(int(t.max()) + 1):
        wave = np.concatenate(induced.pop(c)) if c in induced else np.empty(0, np.int64)
        waves = []
        while len(wave):  # runs of the bucket's own character
            waves.append(wave)
            before = wave[wave > 0] - 1
            wave = before[~direct[before] & (t[before] == c)]
        bucket = np.concatenate([*waves, sorted_[cuts[c]:cuts[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~direct[before] & (t[before] > c)]
        order = np.argsort(t[before], kind="stable")
        before = before[order]
        chars, starts = np.unique(t[before], return_index=True)
        for d, part in zip(chars.tolist(), np.split(before, starts[1:])):
            induced.setdefault(d, []).append(part)
    return np.concatenate(out)


def common_prefixes(places: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """Whether each place's first `length` characters equal those of the place before it."""
    a, b = places[:-1], places[1:]
    same = np.ones(len(a), bool)
    for offset in [*range(0, length - PACK + 1, PACK), length - PACK]:
        at = np.flatnonzero(same)
        same[at] = words[a[at] + offset] == words[b[at] + offset]
    return np.r_[False, same] if len(places) else np.empty(0, bool)


def repeats(texts: list[bytes], starts: np.ndarray, length: int) -> np.ndarray:
    """Class of equal strings of `length` bytes from the given places of the joined texts (one place apart)."""
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + 1
    joined[np.cumsum([len(x) + 1 for x in texts]) - 1] = 0
    depth = _depth(length)
    words = _packed(joined, depth)
    order = suffix_array(joined, words, depth)
    asked = np.full(len(joined), -1, np.int64)
    asked[starts] = np.arange(len(starts))
    who = asked[order]
    places, who = order[who >= 0], who[who >= 0]
    classes = np.empty(len(starts), np.int64)
    classes[who] = np.cumsum(~common_prefixes(places, words, length))
    return classes
