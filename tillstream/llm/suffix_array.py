"""Suffix arrays by induced sorting, and their permuted common prefixes, in numpy.

A suffix is small (S) if it is less than the next one, else large (L); a leftmost small one follows a large one. The
substrings between leftmost small positions are sorted by one induction from their first characters, named by their
rank, and the shorter text of names is sorted in the same way, level after level, until the names differ. From the sorted
leftmost small suffixes one pass over the buckets in ascending order places all large suffixes, and one in descending
order all small ones. A bucket that the buckets before it have filled needs no look at its own entries, so runs of
such buckets are handled together; that keeps the numpy calls few on the large alphabets of names. What a bucket places
in itself are runs of one character, and these are placed together, too.
"""

from __future__ import annotations

import numpy as np

AHEAD = 4096


def run_starts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    first = np.flatnonzero(values[1:] != values[:-1]) + 1
    ends = np.empty(len(first) + 2, first.dtype)
    ends[0], ends[1:-1], ends[-1] = 0, first, len(values)
    return ends[:-1], ends[1:] - ends[:-1]


def runs_before(key: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How many wanted suffixes in a row before each one begin with the same character."""
    stop = np.arange(1, len(key), dtype=np.int32)
    stop[(key[:-1] == key[1:]) & wanted[:-1]] = 0
    out = np.arange(len(key), dtype=np.int32)
    out[1:] -= np.maximum.accumulate(stop)
    return out


def induced(key: np.ndarray, wanted: np.ndarray, seeds: np.ndarray, size: int, first: int | None = None) -> np.ndarray:
    """The wanted suffixes in ascending order of (key, order of the suffix after them).

    ``seeds`` are the sorted other suffixes they can follow; ``first`` is placed before all.
    """
    base = np.concatenate(([0], np.cumsum(np.bincount(key[wanted], minlength=size))))
    free = base[:-1].copy()
    out = np.empty(base[-1], np.int32)
    cuts = np.searchsorted(key[seeds], np.arange(size + 1))
    target_of = key.astype(np.int32)
    target_of[~wanted] = -1
    runs = runs_before(key, wanted)
    sortable = np.uint16 if size <= 1 << 16 else np.int32  # short numbers are sorted by their digits
    if first is not None:
        out[free[key[first]]] = first
        free[key[first]] += 1
    c = 0
    while c < size:
        full = free[c:c + AHEAD] == base[c + 1:c + 1 + AHEAD]
        end = c + (len(full) if full.all() else int(full.argmin()))
        alone = end == c
        if alone:
            # Suffixes of the bucket before suffixes of the same bucket: nearer ones first, each in the order of the last.
            end = c + 1
            last = out[base[c]:free[c]]
            last = last[runs[last] > 0]
            if len(last):
                lengths = runs[last]
                back = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                before = np.repeat(last, lengths) - 1 - back
                before = before[np.argsort(back, kind="stable")]
                out[free[c]:free[c] + len(before)] = before
                free[c] += len(before)
        sources = np.concatenate((out[base[c]:base[end]], seeds[cuts[c]:cuts[end]]))
        if end > c + 1:
            sources = sources[np.argsort(key[sources].astype(sortable), kind="stable")]
        before = sources[sources > 0] - 1
        target = target_of[before]
        live = target > (c if alone else -1)
        before, target = before[live], target[live]
        if len(before):
            order = np.argsort(target.astype(sortable), kind="stable")
            before, target = before[order], target[order]
            starts, lengths = run_starts(target)
            out[np.repeat(free[target[starts]] - starts, lengths) + np.arange(len(target))] = before
            free[target[starts]] += lengths
        c = end
    return out


def from_leftmost(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """All suffixes, from the leftmost small ones in their order."""
    large = induced(text, ~small, seeds, size, len(text) - 1)
    mirror = (size - 1 - text).astype(text.dtype)
    smalls = induced(mirror, small, large[::-1], size)[::-1]
    n_large, n_small = (np.bincount(text[x], minlength=size) for x in (large, smalls))
    start = np.cumsum(n_large + n_small) - n_large - n_small
    out = np.empty(len(text), np.int32)
    out[np.arange(len(large)) + (start - (np.cumsum(n_large) - n_large))[text[large]]] = large
    out[np.arange(len(smalls)) + (start + n_large - (np.cumsum(n_small) - n_small))[text[smalls]]] = smalls
    return out


def types(text: np.ndarray) -> np.ndarray:
    """True for small suffixes; the last one is large."""
    step = np.empty(len(text), np.int8)
    step[:-1] = (text[1:] > text[:-1]).astype(np.int8) - (text[1:] < text[:-1]).astype(np.int8)
    step[-1] = -1
    decided = np.where(step != 0, np.arange(len(text), dtype=np.int32), np.int32(len(text)))
    return step[np.minimum.accumulate(decided[::-1])[::-1]] > 0


def named(text: np.ndarray, leftmost: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The rank of each leftmost small substring, in text order; equal ones share it."""
    place = np.empty(len(text), np.int32)
    place[leftmost] = np.arange(len(leftmost))
    at = place[order]
    lengths = np.append(np.diff(leftmost), 0)[at]
    # The last substring runs to the end of the text and equals no other.
    same = (lengths[1:] == lengths[:-1]) & (lengths[1:] > 0)
    live, offset = np.flatnonzero(same), 0
    while len(live):
        differ = text[order[1:][live] + offset] != text[order[:-1][live] + offset]
        same[live[differ]] = False
        offset += 1
        live = live[~differ]
        live = live[lengths[1:][live] >= offset]
    names = np.empty(len(leftmost), np.int32)
    names[at] = np.concatenate(([0], np.cumsum(~same)))
    return names


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """The starts of all suffixes of ``text`` (integers below ``size``) in ascending order."""
    if len(text) < 2:
        return np.arange(len(text), dtype=np.int32)
    small = types(text)
    leftmost = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    if len(leftmost) > 1:
        seeds = leftmost[np.argsort(text[leftmost], kind="stable")]
        found = from_leftmost(text, small, seeds, size)
        is_leftmost = np.zeros(len(text), bool)
        is_leftmost[leftmost] = True
        order = found[is_leftmost[found]]
        names = named(text, leftmost, order)
        count = int(names.max()) + 1
        leftmost = leftmost[suffix_array(names, count)] if count < len(leftmost) else order
    return from_leftmost(text, small, leftmost, size)


def common_prefixes(text: np.ndarray, suffixes: np.ndarray, asked: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes, cut at ``most``: what each asked position shares with the suffix sorted before it.

    Positions that are not asked for have 0. An asked one has ``most`` characters from 1 to 255 before the next 0.
    """
    before = np.full(len(text), -1, np.int32)
    before[suffixes[1:]] = suffixes[:-1]
    out = np.zeros(len(text), np.int16)
    live = np.flatnonzero(asked & (before >= 0))
    # What is sorted before may be short; an asked position shares no 0 with it.
    padded = np.concatenate((text.astype(np.uint8), np.zeros(most, np.uint8)))
    word = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(padded) - 7,), (1,))
    for offset in range(0, most - 7, 8):
        same = word[live + offset] == word[before[live] + offset]
        out[live[same]] += 8
        rest = live[~same]
        for k in range(8):
            rest = rest[padded[rest + offset + k] == padded[before[rest] + offset + k]]
            out[rest] += 1
        live = live[same]
    for k in range(most - most % 8, most):
        live = live[padded[live + k] == padded[before[live] + k]]
        out[live] += 1
    return out
