"""Spelling variants against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import LOW, TEXTS, documents

from plantmart.llm import spelling


def counted(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{i}:{run}".encode())
            out[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def apart(a, b):
    """Whether one letter inserted, deleted or replaced leads from a to b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def answer(words):
    near = {w: [x for x in words if apart(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def check(spark, words):
    found = spelling.spelling_groups(frame(spark, words))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = list(map(tuple, found.collect()))
    assert len(got) == len(words) and set(got) == answer(words)


def some_words(seed, n, letters="abcdeè", most=9):
    pick = random.Random(seed)
    return {"".join(pick.choices(letters, k=pick.randint(5, most))): pick.randint(3, 200) for _ in range(n)}


@pytest.mark.parametrize("part", [20_000, 5])
def test_groups(ready, monkeypatch, part):
    monkeypatch.setattr(spelling, "PART", part)
    monkeypatch.setattr(spelling, "LOOK", 50)
    words = some_words(1, 400) | some_words(2, 60, "xyzÿ×ß") | {"aaaaa": 9, "aaaaaa": 20, "aaaaaaa": 50, "aaaaaaaa": 200, "b" * 5000: 3, "b" * 5001: 7}
    check(ready, words)


def test_long_way_to_the_root(ready):
    words = {"a" * 5 + "bcdefghijklmnopqrst"[:k]: 3 * 2**k for k in range(19)}
    check(ready, words)
    assert {r["root"] for r in spelling.spelling_groups(frame(ready, words)).collect()} == {"aaaaabcdefghijklmnopqrs"}


def test_counts(ready, odd, empty):
    pick = random.Random(4)
    letters = "abcdeèÀ×"
    lines = [(k, " ".join("".join(pick.choices(letters, k=pick.randint(1, 6))) for _ in range(200)) + " Hello HELLO x1hello") for k in range(60)]
    for rows, docs in ((TEXTS, odd), (lines, documents(ready, lines).repartition(3))):
        got = {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()}
        assert got == counted(rows)
    assert spelling.word_counts(empty).collect() == []
    assert spelling.spelling_groups(spelling.word_counts(empty)).collect() == []
    check(ready, counted(TEXTS))


def test_search_finds_what_the_budget_allows():
    pick = np.random.default_rng(3)
    stored = np.unique(pick.integers(0, 3, (80, 6)), axis=0)
    asking = pick.integers(0, 3, (50, 6))
    got = Counter((int(a), int(b)) for who, found in spelling.search(stored, asking) for a, b in zip(who, found))
    want = Counter()
    for a, v in enumerate(asking):
        for b, w in enumerate(stored):
            change = [x for x in (w - v) if x]
            if change in ([], [1], [1, -1]):
                want[a, b] += 1
    assert got == want


def test_one_apart():
    words = sorted(some_words(5, 120, "ab", 7)) + ["aaaaaa", "aaaaab", "aaaab"]
    data, at = spelling._codes(pa.array(words))
    size = np.diff(at)
    pairs = [(a, b) for a in range(len(words)) for b in range(len(words)) if size[b] - size[a] in (0, 1)]
    a, b = map(np.array, zip(*pairs))
    got = spelling.one_apart(data, at[a], size[a], data, at[b], size[b])
    assert got.tolist() == [apart(words[x], words[y]) for x, y in pairs]
