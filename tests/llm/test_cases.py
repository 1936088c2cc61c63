"""Odd rows, empty tables and clashing columns through every operator, against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import LOW, TEXTS, WORD, documents, near_components

from plantmart.llm import bpe, exact_dedup, jaccard, language_model, licenses, line_quality, packing, page_text, quality_rules, toxicity

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"


def rows(frame):
    return [r.asDict() for r in frame.collect()]


def test_exact_copies(odd, empty):
    got = rows(exact_dedup.exact_copies(odd))
    assert len(got) == len(TEXTS)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in TEXTS]
    groups = defaultdict(list)
    for (i, _), t in zip(TEXTS, norm):
        groups[t].append(i)
    want = []
    for (i, _), t in zip(TEXTS, norm):
        known = [x for x in groups[t] if x is not None]
        keep = min(known) if known else None
        want.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    found = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got]
    assert Counter(found) == Counter(want)
    assert rows(exact_dedup.exact_copies(empty)) == []


def test_exact_copies_keeps_texts_with_one_digest_apart(odd):
    """With a digest that is the same for all texts only the comparison of texts is left."""
    same = exact_dedup.exact_copies(odd, digest=lambda text: F.md5(F.lit("x")))
    right = exact_dedup.exact_copies(odd)
    assert Counter(map(tuple, same.collect())) == Counter(map(tuple, right.collect()))


@pytest.mark.parametrize("slices", [1, 3, 256])
def test_exact_copies_of_hot_texts(ready, monkeypatch, slices):
    """A third of all rows hold one text, ids repeat or are missing, and hashes of one letter are shared by different texts."""
    monkeypatch.setattr(exact_dedup, "SLICES", slices)
    texts = ["alpha  hot" if i % 3 == 0 else f"{'abc'[i % 7 % 3]} {i % 50}" for i in range(600)]
    ids = [None if i % 11 == 0 else i // 2 for i in range(600)]
    data = list(zip(ids, texts))
    norm = [t.replace("  ", " ") for t in texts]
    least, size = {}, Counter(norm)
    for i, t in zip(ids, norm):
        if i is not None:
            least[t] = min(least.get(t, i), i)
    want = Counter((i, least.get(t), size[t], i == least.get(t)) for i, t in zip(ids, norm))
    docs = ready.createDataFrame(data, "doc_id long, text string").repartition(7)
    for digest in (F.md5, lambda text: F.md5(F.substring(text, 1, 1))):
        got = exact_dedup.exact_copies(docs, digest=digest).drop("text_sha256")
        assert Counter(map(tuple, got.collect())) == want


def test_licenses(ready, odd, empty):
    assert rows(licenses.license_units(odd)) == []
    assert rows(licenses.license_units(empty)) == []
    body = licenses.MIT_BODY
    docs = documents(
        ready,
        [
            (1, "Copyright (c) 2020 Someone\n\n" + body.upper()), (2, "text\nReleased under the MIT LICENCE\nmore"),
            (2, "text\nReleased under the MIT LICENCE\nmore"), (None, "Licensed under the Apache Licence, version 2.0"), (4, body + " not"),
            (5, "© me"), (6, "lorem " * 50_000 + "\nSPDX-License-Identifier: ISC"),
        ],
    )
    got = sorted(((r["doc_id"], r["unit"], r["license_id"]) for r in rows(licenses.license_units(docs))), key=repr)
    assert got == [
        (1, 0, "MIT"), (2, 2, "MIT"), (2, 2, "MIT"), (6, 2, "ISC"), (None, 0, "Apache-2.0"), (None, 1, "Apache-2.0"),
    ]


def statistics(text):
    words = re.findall(WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    count = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if count[tuple(words[k : k + 3])] > 1 for j in range(3)}
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(covered),
    )


def test_text_statistics(odd, empty):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = Counter((r["doc_id"], *(r[n] for n in names)) for r in rows(quality_rules.text_statistics(odd)))
    assert got == Counter((i, *statistics(t)) for i, t in TEXTS)
    assert rows(quality_rules.text_statistics(empty)) == []


def test_rules_are_learned_pruned_and_ordered(odd):
    sample = []
    for k in range(300):
        row = dict.fromkeys(quality_rules.MEASURES, 0.0) | {"fold": k % 3, "doc_id": k, "bad": int(k % 5 == 0)}
        row["symbol_rate"] = 1.0 + k / 300 if k % 10 == 0 else 0.01 * (k % 7)
        row["upper_rate"] = 0.9 if k % 10 == 5 else 0.1
        sample.append(row)
    rules = quality_rules.learn_rules(sample)
    assert {c.measure for r in rules for c in r.conditions} == {"symbol_rate", "upper_rate"}
    assert all(any(r.holds(x) for r in rules) == bool(x["bad"]) for x in sample)
    assert quality_rules.learn_rules([]) == []
    decided = rows(quality_rules.decide(quality_rules.text_statistics(odd), rules))
    for r in decided:
        number = next((k for k, rule in enumerate(rules, 1) if rule.holds(r)), None)
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert (r["rule"], r["base_failed"], r["kept"]) == (number, failed, not failed and number is None)


def test_packing(odd, empty):
    from tokenizers import Tokenizer

    text = packing.tokenizer_text(WORDS)
    whole = Tokenizer.from_str(text)
    for capacity in (64, 2048):
        got = rows(packing.pack(odd, text, capacity=capacity))
        want = Counter()
        for i, t in TEXTS:
            ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
            for s in range(0, len(ids), capacity):
                part = ids[s : s + capacity]
                want[i, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
        assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
        places = defaultdict(list)
        for r in got:
            places[r["sequence_id"]].append((r["offset"], r["length"]))
        assert sorted(places) == list(range(len(places)))
        for held in places.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= capacity
    assert rows(packing.pack(empty, text)) == []


def test_numbers_have_no_gaps_in_any_number_of_buckets(odd):
    pieces = packing.token_pieces(odd, packing.tokenizer_text(WORDS), "doc_id", "text", 64, 1)
    for size in (1, 3, 1000):
        by = defaultdict(list)
        for r in rows(packing.numbered(pieces, size)):
            by[r["length"]].append(r["rank"])
        assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_byte_pairs(odd, empty):
    from tokenizers import Tokenizer

    text = packing.tokenizer_text(BYTES)
    whole = Tokenizer.from_str(text)
    lexicon = bpe.lexicon_of(odd, text)
    ids = [whole.encode(t or "", add_special_tokens=False).ids for _, t in TEXTS]
    got = bpe.encode(odd, text, lexicon)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows(got)) == Counter((i, tuple(x)) for (i, _), x in zip(TEXTS, ids))
    assert Counter((r["doc_id"], r["text"]) for r in rows(bpe.decode(got, text))) == Counter((i, t or "") for i, t in TEXTS)
    want = Counter(
        (i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for (i, t), x in zip(TEXTS, ids)
    )
    found = rows(bpe.digests(odd, text, lexicon))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found) == want
    nothing = bpe.lexicon_of(empty, text)
    assert rows(bpe.digests(empty, text, nothing)) == []
    assert len(rows(bpe.digests(odd, text, nothing))) == len(TEXTS)


def test_jaccard(odd, empty):
    got = rows(jaccard.jaccard_components(odd))
    sizes, least, same = near_components(TEXTS, 4, 85)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["n_same"]) for r in got) == Counter(
        (i, s, c, m) for (i, _), s, c, m in zip(TEXTS, sizes, least, same)
    )
    assert rows(jaccard.jaccard_components(empty)) == []


def test_language_model(odd, empty):
    model, counts = language_model.learn(odd)
    got = rows(language_model.score(odd, model, counts))
    tokens = [re.findall(WORD, (t or "").translate(LOW)) + [None] for _, t in TEXTS]
    count = Counter(x for t in tokens for x in t)
    total, distinct = sum(count.values()), len(count)
    base = [sum(np.log10((count[x] + 1) / (total + distinct + 1)) for x in t) for t in tokens]
    want = sorted(((i, len(t), len(t), total, round(b, 6)) for (i, _), t, b in zip(TEXTS, tokens, base)), key=repr)
    found = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got]
    assert sorted(found, key=repr) == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert rows(language_model.score(empty, model, counts)) == []
    nothing, none = language_model.learn(empty)
    for r in rows(language_model.score(odd, nothing, none)):
        assert r["n_known"] == 0 and r["base_score"] == 0 and np.isfinite(r["score"])


def labels(spark, marks):
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("module, name", [(toxicity, "toxic"), (line_quality, "quality")])
def test_classifiers_take_odd_rows(ready, odd, empty, module, name):
    marks = [(i, int(i != 8), int(i == 8), "x") for i in range(1, 12)] + [(None, 1, 0, None), (4, None, None, None)]
    for known in (labels(ready, marks), labels(ready, [])):
        model = module.train(odd, known)
        scored = rows(odd.withColumn("own", module.scorer(ready, model)(F.col("text"))))
        assert len(scored) == len(TEXTS) and all(0 <= r["own"] <= 1 for r in scored)
        by = defaultdict(set)
        for r in scored:
            by[r["text"]].add(r["own"])
        assert all(len(v) == 1 for v in by.values())
        assert by[None] == by[""] == by[" \n\t "]
        assert rows(empty.withColumn("own", module.scorer(ready, model)(F.col("text")))) == []


def test_classifiers_learn_from_an_empty_table(ready, odd, empty):
    for module in (toxicity, line_quality):
        model = module.train(empty, labels(ready, [(1, 1, 1, "x"), (2, 0, 0, "x")]))
        assert odd.withColumn("own", module.scorer(ready, model)(F.col("text"))).where("own between 0 and 1").count() == len(TEXTS)


PAGES = [
    (1, "http://a.example/x/1", "<nav>menu</nav><article><h1>Head &amp; tail</h1><p>one\n two<p>three</article><footer>f</footer>"),
    (2, "http://www.a.example/y/1?q=1", "<p>Site name</p><p>own text</p><p>Made by us</p>"),
    (3, "https://a.example/y/2#top", "<p>Site name</p><p>other text</p><script>if (a<b) x='</p>'</script><p>Made by us</p>"),
    (4, "https://a.example/y/2", None),
    (5, None, "<p>no url"),
    (6, "https://b.example/", ""),
    (None, "https://b.example/z", "<p>Site name</p>no id"),
    (7, "https://c.example/1", "<p>" + "long text " * 50_000 + "</p>"),
    (8, "https://d.example/1", "<div class='cookie-notice'>we use cookies</div><main>m<br>n<div id=comments>c</div></main><p>after"),
    (8, "https://d.example/1", "<div class='cookie-notice'>we use cookies</div><main>m<br>n<div id=comments>c</div></main><p>after"),
]
PAGE_TEXTS = [
    (1, "Head & tail\none two\nthree"), (2, "own text"), (3, "other text"), (4, ""), (5, "no url"), (6, ""), (None, "Site name\nno id"),
    (7, ("long text " * 50_000).strip()), (8, "m n"), (8, "m n"),
]


def test_page_texts(ready):
    extra = ", text string, n_chars string, id string, host string, path string"
    pages = ready.createDataFrame([(*p, "x", "x", "x", "x", "x") for p in PAGES], "page_id long, url string, html string" + extra)
    got = [(r["page_id"], r["text"]) for r in rows(page_text.page_texts(pages)) if r["n_chars"] == len(r["text"])]
    assert sorted(got, key=repr) == sorted(PAGE_TEXTS, key=repr)
    assert rows(page_text.page_texts(pages.limit(0))) == []


def test_pipeline_stages_take_odd_rows(ready, odd, empty, tmp_path):
    import corpus_pipeline

    odd.write.parquet(f"{tmp_path}/documents.parquet")
    labels(ready, [(8, 0, 1, "x"), (1, 1, 0, "x"), (11, 1, 0, "x")]).write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, empty):
            got = stage(ready, docs, str(tmp_path))
            found = rows(got)
            if name == "packing":
                assert (len(found) > 0) == (docs is odd)
                continue
            assert got.columns == docs.columns
            assert Counter(map(repr, found)) <= Counter(map(repr, rows(docs)))
    kept = [r["doc_id"] for r in rows(corpus_pipeline.exact_dedup(ready, odd, str(tmp_path)))]
    # One of the rows without id has the text of document 1.
    assert sorted(kept, key=repr) == sorted([1, 4, 6, 7, 8, 9, 10, 11, 12, None], key=repr)
