"""Divergence of sources against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from odd_rows import LOW, documents
from pyspark.sql import functions as F

from plantmart.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCALE = 1_000_000_000


def answer(rows, ranks):
    rows = [tuple(x or "" for x in r) for r in rows]
    held, documents_of = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = Counter(TERM.findall(text.translate(LOW)))
        held[lang, source].update(terms)
        documents_of[lang].update(terms.keys())
    out = set()
    for lang in {x for x, _ in held}:
        kept = [t for t, n in documents_of[lang].items() if n >= 3]
        sources = [s for x, s in held if x == lang]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + SCALE * (counts[t] + 1) // (total + len(kept)) for t in kept}

        whole = shares(sum((held[lang, s] for s in sources), Counter()))
        own = {s: shares(held[lang, s]) for s in sources}
        f = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pairs = [(sum(f(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(own[s][t], whole[t]), t) for t in kept if held[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found[:most], 1)}
    return out


def frame(spark, rows):
    kind = "text string, lang string, source string, n long, term string, row string, rank string, p0 string"
    return spark.createDataFrame([(*r, 1, "x", "x", "x", "x") for r in rows], kind)


ROWS = [
    ("The cat, the dog; THE end.", "en", "a"), ("the cat's cat (cat) é É 漢字", "en", "a"), ("cat the dog É", "en", "b"),
    ("the the the", "en", "b"), ("the the the", "en", "b"), (None, "en", "c"), ("", "en", None), ("1 2 3 ...", "en", "d"),
    ("dog" + " x-dog" * 30, None, "a"), ("dog dog!", None, None), ("a DOG", "", "b"), ("alone", "fr", "a"), (None, None, None),
    ("ein Wort", "de", "a"), ("kein wort", "de", "b"), ("mehr " * 2000, "de", "b"),
    # A term whose documents are only seen over several chunks, in one source and in two.
    ("rare1 rare!", "en", "a"), ("(rare", "en", "a"), ("rare?", "en", "b"), ("few! few? few.", "en", "a"), ("few,", "en", "b"),
]


@pytest.mark.parametrize("ranks", [2, 200])
def test_divergence(ready, ranks):
    found = divergence.source_divergence(frame(ready, ROWS).repartition(3), ranks)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == sorted(answer(ROWS, ranks))


def test_counts_handed_on_early_and_pairs_compared_in_slices(ready, monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS", 3)
    monkeypatch.setattr(divergence, "BLOCK", 4)
    monkeypatch.setattr(divergence, "BUCKET_BYTES", 100)
    rows = ROWS + [(f"w{k % 7} w{k % 5} the", "en", f"s{k % 6}") for k in range(40)]
    assert set(map(tuple, divergence.source_divergence(frame(ready, rows)).collect())) == answer(rows, 200)


def test_odd_rows_and_empty_tables(ready, odd, empty):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd.collect()]
    assert set(map(tuple, divergence.source_divergence(odd).collect())) == answer(rows, 200)
    mixed = odd.withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3))
    rows = [(r["text"], r["lang"], r["source"]) for r in mixed.collect()]
    assert set(map(tuple, divergence.source_divergence(mixed).collect())) == answer(rows, 200)
    assert divergence.source_divergence(empty).collect() == []
    assert divergence.source_divergence(documents(ready, [(1, None)])).collect() == []
