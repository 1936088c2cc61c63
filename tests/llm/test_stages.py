"""The pipeline's stages against brute force."""

from __future__ import annotations

from collections import Counter

import pytest
from odd_rows import documents, near_components

import corpus_pipeline

FOLDER = "/root/testdata/sf0.01"


def test_near_dedup_links_five_words_at_four_fifths(ready, tmp_path):
    words = [f"w{k}" for k in range(50)]
    rows = [
        (1, " ".join(words)),
        (2, " ".join([*words[:25], "x", *words[26:]])),  # 41 of 51 shingles of five words, 43 of 51 of four
        (3, " ".join(f"u{k}" for k in range(50))),
    ]
    least = near_components(rows, 5, 80)[1]
    assert least != near_components(rows, 4, 85)[1]
    kept = [r["doc_id"] for r in corpus_pipeline.near_dedup(ready, documents(ready, rows), str(tmp_path)).collect()]
    assert sorted(kept) == sorted(i for (i, _), n in zip(rows, least) if i == n)


ROWS = [(1, "alpha beta"), (1, "beta gamma"), (2, "alpha  beta"), (None, "gamma"), (None, "gamma"), (None, "alpha beta"), (3, None), (4, "")]


def stay(ready, stage, rows, tmp_path):
    docs = documents(ready, rows)
    kept = stage(ready, docs, str(tmp_path))
    assert kept.columns == docs.columns
    return sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)


def test_rows_with_one_id_or_none_are_documents_of_their_own(ready, tmp_path):
    assert stay(ready, corpus_pipeline.exact_dedup, ROWS, tmp_path) == [(1, "alpha beta"), (1, "beta gamma"), (3, None), (None, "gamma")]
    assert stay(ready, corpus_pipeline.exact_dedup, [], tmp_path) == []
    long = [(i, t and " ".join(t.split() * 9)) for i, t in ROWS]
    want = [(1, long[0][1]), (1, long[1][1]), (3, None), (4, ""), (None, long[3][1])]
    assert stay(ready, corpus_pipeline.near_dedup, long, tmp_path) == sorted(want, key=repr)
    assert stay(ready, corpus_pipeline.near_dedup, [], tmp_path) == []


def test_packing_stage_places_each_token_once(ready, tmp_path):
    from tokenizers import Tokenizer

    from plantmart.llm import packing

    whole = Tokenizer.from_str(packing.tokenizer_text("word_bpe_49k.json"))
    rows = [*ROWS, (5, "many words " * 3000)]
    found = corpus_pipeline.packed(ready, documents(ready, rows), str(tmp_path)).collect()
    want = Counter()
    for i, text in rows:
        want[i] += len(whole.encode(text or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in found:
        got[r["doc_id"]] += r["length"]
    assert got == want


@pytest.mark.parametrize("name", ["not_toxic", "good_quality"])
def test_classifying_stages_keep_what_the_classifier_keeps(ready, name):
    """The stage against the score that the classifier gives each text by itself."""
    from pyspark.sql import functions as F

    from plantmart.llm import line_quality, toxicity
    from plantmart.llm.registry import table

    module, keeps = {"not_toxic": (toxicity, lambda s: s < 0.5), "good_quality": (line_quality, lambda s: s >= line_quality.THRESHOLD)}[name]
    whole, labels = (table(ready, FOLDER, t) for t in ("documents", "labels"))
    docs = whole.where("doc_id < 300").select("doc_id", "text").unionByName(documents(ready, ROWS).select("doc_id", "text"))
    score = module.scorer(ready, module.train(whole, labels))
    want = Counter((r["doc_id"], r["text"]) for r in docs.withColumn("own", score(F.col("text"))).collect() if keeps(r["own"]))
    got = Counter((r["doc_id"], r["text"]) for r in getattr(corpus_pipeline, name)(ready, docs, FOLDER).collect())
    assert got == want and 0 < sum(got.values())


def test_pipeline_is_its_stages_one_after_another(ready):
    """Every document that the first four stages keep is packed whole, and no other."""
    from plantmart.llm.registry import table

    docs = table(ready, FOLDER, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = ready.createDataFrame(stage(ready, docs, FOLDER).collect(), docs.schema)
    packed = corpus_pipeline.run(ready, FOLDER).collect()
    tokens = {}
    for r in packed:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
    assert sorted(tokens) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert all(tokens[r["doc_id"]] == r["doc_tokens"] for r in packed)
