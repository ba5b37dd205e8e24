"""Suffix arrays over shards of training words, searched with every test suffix.

A shard is the word ids of whole documents, 0 after each document and for every word
that no test item has. Its array holds only suffixes whose first words begin some test
window; no other suffix can match one. It is ordered to the depth of the longest test
item, which is all that comparing test suffixes with it can see.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import repeat

import numpy as np

_NOT_WORD = bytes(
    ord(" ") if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Runs of digits, letters a-z and characters beyond ASCII, A-Z lower-cased."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").lower().translate(_NOT_WORD).split()


class TestSuffixes:
    """Word ids of all test items, their distinct windows, and which items have which.

    A window is ``width`` consecutive words, or all words of a shorter item."""

    __test__ = False  # not a test class

    def __init__(self, items: Iterable[tuple[str, str | None]], width: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.names: list[str] = []
        number: dict[str, int] = {}
        ids, owner, starts, sizes, item_words = [], [], [], [], []
        for name, text in items:
            found = words(text)
            if not found:
                continue
            if name not in number:
                number[name] = len(self.names)
                self.names.append(name)
            at, size = len(ids), min(width, len(found))
            ids.extend(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found)
            for start in range(at, at + len(found) - size + 1):
                starts.append(start)
                sizes.append(size)
                item_words.append(start - at)
                owner.append(number[name])
            ids.append(0)
        self.bits = max(1, (len(self.vocabulary) + 1).bit_length())
        self.longest = max(np.diff(np.flatnonzero(np.array([0, *ids]) == 0)), default=0)
        self.ids = np.array(ids + [0] * (width + 1), np.int64)
        # For each suffix that begins a window: its place, item, word in it, window's size.
        self.starts, self.owner, self.item_words, self.sizes = (
            np.array(x, np.int64) for x in (starts, owner, item_words, sizes)
        )
        self._windows(width)

    def _windows(self, width: int) -> None:
        """Distinct windows: where one stands, its size, and the items that have it."""
        owner, sizes = self.owner, self.sizes
        if not len(owner):
            self.at = self.size = self.first_item = self.items = np.zeros(0, np.int64)
            self.first_words = self.pairs = np.zeros(0, np.int64)
            return
        table = self.ids[self.starts[:, None] + np.arange(width)]
        table[np.arange(width) >= sizes[:, None]] = 0
        _, first, of = np.unique(table, axis=0, return_index=True, return_inverse=True)
        of = of.ravel()
        self.at, self.size = self.starts[first], sizes[first]
        both = np.unique(np.stack([of, owner], axis=1), axis=0)
        self.items = both[:, 1]
        self.first_item = np.searchsorted(both[:, 0], np.arange(len(first) + 1))
        single = self.size == 1
        self.singles = np.zeros(len(self.vocabulary) + 1, bool)
        self.singles[self.ids[self.at[single]]] = True
        self.begins = np.zeros(len(self.vocabulary) + 1, bool)
        self.begins[self.ids[self.at]] = True
        self.pairs = np.unique(self.pair(self.ids, self.at[~single]))

    def pair(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ids[at] << self.bits | ids[at + 1]

    def word_ids(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.int64, len(found))


class Shard:
    """The suffix array of a list of documents, each an array of word ids."""

    def __init__(self, documents: list[np.ndarray], tests: TestSuffixes) -> None:
        self.tests = tests
        self.sizes = np.array([len(d) for d in documents], np.int64)
        self.begins = np.cumsum(np.concatenate([[0], self.sizes + 1]))
        stop = np.zeros(1, np.int64)
        parts = [x for d in documents for x in (d, stop)]
        self.ids = np.concatenate([*parts, np.zeros(tests.longest + 64, np.int64)])
        self.order = self._ordered(self._starts())

    def _starts(self) -> np.ndarray:
        t = self.tests
        if not len(t.at):
            return np.zeros(0, np.int64)
        at = np.flatnonzero(t.begins[self.ids[: self.begins[-1]]])
        pairs = t.pair(self.ids, at)
        hit = np.searchsorted(t.pairs, pairs)
        hit[hit == len(t.pairs)] = 0
        known = t.pairs[hit] == pairs if len(t.pairs) else np.zeros(len(at), bool)
        return at[known | t.singles[self.ids[at]]]

    def _ordered(self, at: np.ndarray) -> np.ndarray:
        """By words; each round sorts by some words more, only within what still ties."""
        per = 62 // self.tests.bits
        group = np.zeros(len(at), np.int64)
        tied = np.arange(len(at))
        for depth in range(0, int(self.tests.longest), per):
            if not len(tied):
                break
            key, alive = np.zeros(len(tied), np.int64), np.ones(len(tied), bool)
            for j in range(per):
                word = self.ids[np.minimum(at[tied] + depth + j, len(self.ids) - 1)]
                alive &= word > 0
                key = key << self.tests.bits | np.where(alive, word, 0)
            order = np.lexsort((key, group[tied]))
            at[tied], key, alive = at[tied][order], key[order], alive[order]
            g = group[tied]
            new = np.concatenate([[True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])])
            # A group is named by the place of its first member.
            group[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
            last = np.concatenate([new[1:], [True]])
            tied = tied[~(new & last) & alive]
        return at

    def _common(self, test: np.ndarray, place: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words each test suffix shares with the suffix at a place, up to most."""
        shared = np.zeros(len(test), np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):
            word = self.tests.ids[test[live] + shared[live]]
            same = (word > 0) & (word == self.ids[place[live] + shared[live]])
            shared[live] += same
            live = live[same & (shared[live] < most[live])]
        return shared

    def _bound(self, test: np.ndarray, most: np.ndarray, after: bool) -> np.ndarray:
        """Binary search: the first place whose suffix is not before the first ``most``
        words of the test suffix, or, with ``after``, the first that is beyond them."""
        low = np.zeros(len(test), np.int64)
        high = np.full(len(test), len(self.order), np.int64)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            place, t, m = self.order[middle], test[open_], most[open_]
            shared = self._common(t, place, m)
            whole = shared == m
            ours = self.ids[place + shared]
            theirs = self.tests.ids[t + np.minimum(shared, m - 1)]
            right = np.where(whole, after, ours < theirs)
            low[open_] = np.where(right, middle + 1, low[open_])
            high[open_] = np.where(right, high[open_], middle)
        return low

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which word places are hit and, as two parallel arrays, (document, item)."""
        t = self.tests
        low = self._bound(t.at, t.size, False)
        high = self._bound(t.at, t.size, True)
        count = high - low
        window = np.repeat(np.arange(len(count)), count)
        place = self.order[_ranges(low, count)]
        edge = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + t.size[window], -1)
        covered = np.cumsum(edge)[: self.begins[-1]] > 0
        doc = np.searchsorted(self.begins, place, side="right") - 1
        both = np.unique(doc * max(1, len(count)) + window)
        doc, window = np.divmod(both, max(1, len(count)))
        n = t.first_item[window + 1] - t.first_item[window]
        pairs = np.stack([np.repeat(doc, n), t.items[_ranges(t.first_item[window], n)]], axis=1)
        pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
        return covered, pairs[:, 0], pairs[:, 1]

    def per_document(self, marks: np.ndarray) -> np.ndarray:
        """How many of the places are marked, for each document."""
        total = np.concatenate([[0], np.cumsum(marks)])
        return total[self.begins[1:]] - total[self.begins[:-1]]

    def longest_matches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each test suffix that begins a window: its longest match in this shard,
        the document and the word where that stands. The longest match of a suffix is
        with a neighbour of the place where it would be inserted."""
        t = self.tests
        far = np.full(len(t.starts), self.tests.longest, np.int64)
        if not len(self.order) or not len(t.starts):
            none = np.zeros(len(t.starts), np.int64)
            return none, none, none
        at = self._bound(t.starts, far, False)
        best, where = np.zeros(len(far), np.int64), np.zeros(len(far), np.int64)
        for neighbour in (at - 1, at):
            place = self.order[np.clip(neighbour, 0, len(self.order) - 1)]
            shared = self._common(t.starts, place, far)
            where = np.where(shared > best, place, where)
            best = np.maximum(best, shared)
        doc = np.searchsorted(self.begins, where, side="right") - 1
        return best, doc, where - self.begins[doc]


def _ranges(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """low[0], low[0] + 1, ... count[0] of them, then the same from low[1], ..."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - count), count)
