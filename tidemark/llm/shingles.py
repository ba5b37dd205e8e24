"""Word shingles of many texts at once, as 64-bit hashes, and their one-permutation sketches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_DRAW = np.random.Generator(np.random.PCG64(20240101))
_BYTES = _DRAW.integers(0, 1 << 64, 256, np.uint64)
_BASE, _LENGTH, _SECOND, _BAND = (_DRAW.integers(0, 1 << 64, 4, np.uint64) | np.uint64(1)).tolist()
_PLACES = _DRAW.integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)
SLICE_BYTES = 1 << 20
EMPTY = np.uint64((1 << 64) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the argument."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about SLICE_BYTES; a longer text by itself."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > SLICE_BYTES:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The text's number and the hash of every word. A word's hash is a polynomial in its
    bytes, so all come from differences of one running sum."""
    joined = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    gap = _SPACE[joined]
    edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
    start, stop = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    stop = stop[: len(start)]
    power = _powers(_BASE, len(joined))
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[joined] * power)])
    shift = _powers(pow(_BASE, -1, 1 << 64), len(joined))[start]
    value = (total[stop] - total[start]) * shift
    value = mixed(value + (stop - start).astype(np.uint64) * np.uint64(_LENGTH))
    return np.searchsorted(begins, start, side="right") - 1, value


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def shingle_sets(texts: Sequence[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of every text, sorted. Shingles are k words,
    or all words of a shorter text."""
    doc, word = word_hashes(texts)
    if not len(doc):
        return doc, word
    n_words = np.bincount(doc, minlength=len(texts))
    total = np.zeros(len(word), np.uint64)
    padded = np.concatenate([word, np.zeros(k, np.uint64)])
    first = np.cumsum(n_words) - n_words
    after = np.arange(len(word)) - first[doc]
    width = np.minimum(n_words, k)[doc]
    for j in range(k):
        part = padded[j : j + len(word)] * _PLACES[j]
        total += np.where(j < width, part, np.uint64(0))
    whole = after + width <= n_words[doc]
    value = mixed(total + width.astype(np.uint64) * np.uint64(_LENGTH))[whole]
    doc = doc[whole]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])])
    return doc[new], value[new]


def set_digests(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """128 bits that tell sets apart: two sums of differently mixed hashes, per text."""
    out = np.zeros((n, 2), np.uint64)
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    if len(first):
        out[doc[first], 0] = np.add.reduceat(mixed(value), first)
        out[doc[first], 1] = np.add.reduceat(mixed(value ^ np.uint64(_SECOND)), first)
    return out


def probes(bins: int) -> np.ndarray:
    """For each bin, the others in an order of its own."""
    draw = np.random.Generator(np.random.PCG64(bins))
    return draw.permuted(np.tile(np.arange(bins), (bins, 1)), axis=1)


def sketches(
    doc: np.ndarray, value: np.ndarray, n: int, order: np.ndarray
) -> np.ndarray:
    """One permutation cut into equal bins, the smallest hash of each. An empty bin takes
    the value of the first full one in its own order, so that two sets agree in a bin with
    the probability of their similarity, however few shingles they have. Texts without
    shingles keep empty bins."""
    bins = len(order)
    sketch = np.full(n * bins, EMPTY, np.uint64)
    place = doc * bins + ((value >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(
        np.int64
    )
    new = np.concatenate([[True], place[1:] != place[:-1]]) if len(place) else np.zeros(0, bool)
    sketch[place[new]] = value[new]
    full = sketch != EMPTY
    some = np.repeat(full.reshape(n, bins).any(axis=1), bins)
    open_ = np.flatnonzero(~full & some)
    row, column = open_ - open_ % bins, open_ % bins
    for attempt in range(bins):
        if not len(open_):
            break
        source = row + order[column, attempt]
        hit = full[source]
        sketch[open_[hit]] = sketch[source[hit]]
        open_, row, column = open_[~hit], row[~hit], column[~hit]
    return sketch.reshape(n, bins)


def band_hashes(sketch: np.ndarray, bands: int) -> np.ndarray:
    """One hash for each run of bins, with the run's number in it."""
    parts = sketch.reshape(len(sketch), bands, -1)
    out = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(_BAND)
    for r in range(parts.shape[2]):
        out = mixed(out ^ parts[:, :, r])
    return out
