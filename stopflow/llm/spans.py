"""Hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash

# Texts are read in slabs of about this many bytes, cut after white space;
# words of at least LONG bytes are hashed one by one.
SLAB, LONG = 4 << 20, 256

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _cuts(data: np.ndarray, begin: int, end: int) -> list[int]:
    """Places after white space that split data[begin:end] into slabs; a word longer than a slab stays whole."""
    out, at = [begin], begin
    while end - at > SLAB:
        reach, found = at + SLAB, None
        while reach <= end:
            white = np.flatnonzero(_WHITE[data[reach - SLAB:reach]])
            if len(white):
                found = reach - SLAB + int(white[-1]) + 1
                break
            reach += SLAB
        if found is None:
            break
        out.append(found)
        at = found
    return [*out, end]


def _slab_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of the bytes; equal words have equal hashes wherever they stand."""
    part = np.zeros(len(data) + 8, np.uint8)
    part[:-8] = _LOWER[data]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_WHITE[data]
    edge = np.diff(inside)
    start = np.flatnonzero(edge == 1)
    size = np.flatnonzero(edge == -1) - start
    eights = np.ndarray(len(data), "<u8", part.tobytes(), strides=(1,)) if len(data) else np.zeros(0, np.uint64)
    h = size.astype(np.uint64)
    at, done = np.flatnonzero(size < LONG), 0
    while len(at):
        left = np.minimum(size[at] - done, 8).astype(np.uint64)
        cut = (np.uint64(8) - left) * np.uint64(8)
        x = (h[at] ^ ((eights[start[at] + done] << cut) >> cut)) * np.uint64(0x9E3779B97F4A7C15)
        h[at] = x ^ (x >> np.uint64(31))
        done += 8
        at = at[size[at] > done]
    for i in np.flatnonzero(size >= LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(part[start[i]:start[i] + size[i]].tobytes())
    return start, h


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts data[bounds[i]:bounds[i + 1]], and where each text's begin.

    Words are runs without ASCII white space, A-Z lower-cased.  A word never
    runs over the end of a text.
    """
    found, counts = [], np.zeros(len(bounds), np.int64)
    k, n = 0, len(bounds) - 1
    while k < n:
        last = max(k + 1, int(np.searchsorted(bounds, bounds[k] + SLAB, "right")) - 1)
        begin, end = int(bounds[k]), int(bounds[last])
        if last == k + 1:
            for a, b in zip((cuts := _cuts(data, begin, end))[:-1], cuts[1:], strict=True):
                h = _slab_hashes(data[a:b])[1]
                found.append(h)
                counts[k + 1] += len(h)
        else:
            # a break between neighbouring texts, as they stand side by side
            sizes = np.diff(bounds[k:last + 1])
            spaced = np.full(end - begin + len(sizes), 0x20, np.uint8)
            shift = np.repeat(np.arange(len(sizes)), sizes)
            spaced[np.arange(end - begin) + shift] = data[begin:end]
            start, h = _slab_hashes(spaced)
            found.append(h)
            own = bounds[k:last] - begin + np.arange(len(sizes))
            counts[k + 1:last + 1] = np.bincount(np.searchsorted(own, start, "right") - 1, minlength=len(sizes))
        k = last
    return np.concatenate([np.zeros(0, np.uint64), *found]), np.cumsum(counts)
