"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.plain import DOCS, awkward_rows, lower
from tidemark.llm import spelling

NAMES = ["word", "form", "root", "n", "n_near", "form_n"]


def vocabulary(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower(text)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    return {w: n for w, n in counts.items() if n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain(rows):
    counts = vocabulary(rows)
    forms, near = {}, {}
    for word, n in counts.items():
        found = [w for w in counts if one_edit(word, w)]
        best = min(found, key=lambda w: (-counts[w], w), default=None)
        near[word] = len(found)
        forms[word] = best if best and counts[best] >= 2 * n else None
    out = []
    for word, form in forms.items():
        root = word
        while forms[root]:
            root = forms[root]
        out.append((word, form, root, counts[word], near[word], form and counts[form]))
    return Counter(out)


def rows():
    draw = random.Random(2)
    letters = "abeilnorstéÉÿ"
    bases = ["".join(draw.choice(letters) for _ in range(draw.randint(4, 12))) for _ in range(60)]
    bases += ["aaaaa", "aaaaaa", "aaaaaaa", "aaaab", "baaaa", "ababab", "ababa", "bababa"]
    words = []
    for base in bases:
        words += [base] * draw.choice([1, 3, 9, 40])
        for _ in range(8):
            at, kind = draw.randrange(len(base)), draw.randrange(3)
            middle = ["", draw.choice(letters), base[at] + draw.choice(letters)][kind]
            words += [base[:at] + middle + base[at + 1 :]] * draw.choice([1, 3, 4, 8, 20])
    draw.shuffle(words)
    out = awkward_rows()
    out += [(i, " ".join(words[i::50]).replace("ab", "AB"), "en", "a", 1) for i in range(50)]
    return out + [(None, "wordy " * 5, None, None, None)] * 2


@pytest.mark.parametrize("most", [spelling.MOST, 3])
def test_variants_equal_all_pairs(spark, most):
    """With blocks cut as far as they go, too."""
    got = spelling.spelling_variants(spark.createDataFrame(rows(), DOCS), most=most)
    assert got.columns == NAMES
    assert Counter(map(tuple, got.collect())) == plain(rows())


def test_scans_find_what_is_one_edit_away():
    draw = random.Random(1)
    words = sorted({"".join(draw.choice("abc") for _ in range(draw.randint(0, 7))) for _ in range(800)})
    scan = spelling.SortedList(words)
    for word in words[::7] + ["", "abcabcabc"]:
        want = [i for i, w in enumerate(words) if w == word or one_edit(w, word)]
        assert scan.within_one_edit(word) == want


def test_empty_and_clashing(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame([(1, "hello " * 3, 5, 6)], "doc_id long, text string, word long, n long")
    got = spelling.spelling_variants(docs).collect()
    assert list(map(tuple, got)) == [("hello", None, "hello", 3, 0, None)]
