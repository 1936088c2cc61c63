"""The language model keeps the same n-grams at any corpus size."""

from __future__ import annotations

import random

import numpy as np
import pytest
from odd_rows import documents
from pyspark.sql import functions as F

from plantmart.llm import language_model


def test_n_grams_do_not_depend_on_their_share(ready):
    pick = random.Random(5)
    rows = [(k, " ".join(pick.choices([f"w{j}" for j in range(200)], k=30))) for k in range(60)]
    docs = documents(ready, rows)
    found = []
    for share in (language_model.MIN_SHARE, 0.004, 1.0):
        model, weights = language_model.learn(docs, min_share=share)
        found.append({r["doc_id"]: r["score"] for r in language_model.score(docs, model, weights).collect()})
    assert found[1] == pytest.approx(found[0], rel=1e-9)
    assert found[2] == pytest.approx(found[0], rel=1e-9)


def test_corpus_is_scored_as_by_a_model_of_its_training_rows(ready, monkeypatch):
    pick = random.Random(6)
    rows = [(k, " ".join(pick.choices([f"w{j}" for j in range(40)], k=pick.choice([0, 5, 60, 1500])))) for k in range(50)]
    docs = documents(ready, rows).repartition(3)
    training = F.col("doc_id") % 3 > 0
    model, weights = language_model.learn(docs.where(training))
    want = {r["doc_id"]: r for r in language_model.score(docs, model, weights).collect()}
    # Small blocks and buckets: many messages, and n-grams shared by blocks.
    monkeypatch.setattr(language_model, "BLOCK", 200)
    monkeypatch.setattr(language_model, "BUCKET_BYTES", 1000)
    got = language_model.score_corpus(docs, training).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(50))
    for r in got:
        assert tuple(r)[:4] == tuple(want[r["doc_id"]])[:4]
        assert (r["base_score"], r["score"]) == pytest.approx(tuple(want[r["doc_id"]])[4:], rel=1e-9)


def test_numbers_survive_packing():
    for x in ([], [0], [255, 0, 3], [1 << 40, 7], [(1 << 56) - 1] * 3):
        assert language_model.from_planes(language_model.planes(np.array(x, np.int64))).tolist() == x
    hashes = np.sort(np.array([0, 5, 5, 1 << 55, (1 << 56) - 1], np.uint64))
    assert language_model.from_rising(language_model.rising(hashes)).tolist() == hashes.tolist()
    cut = language_model.bounds(hashes, 3).tolist()
    assert cut == [0, 3, 4, 5]
