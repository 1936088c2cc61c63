"""The classifier of toxicity learns from all labelled documents, however they are dealt out."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from plantmart.llm import toxicity


def labelled(spark, n):
    """``n`` documents of each mark; of the toxic ones, those whose hashed ids come after the first 1500 have a word of their own."""
    rows = spark.range(2 * n).withColumn("toxic", (F.col("id") % 2).cast("int"))
    marked = rows.where(~toxicity.held_out(F.col("id")) & (F.col("toxic") == 1)).orderBy(F.xxhash64("id"), "id").limit(1500).select("id", F.lit(True).alias("early"))
    word = F.when(F.col("toxic") == 0, "kind").when(F.col("early"), "vile").otherwise("foul")
    docs = rows.join(marked, "id", "left").select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some text number"), (F.col("id") % 7).cast("string"), word).alias("text"), "toxic"
    )
    return docs.select("doc_id", "text"), docs.select("doc_id", "toxic")


def test_words_outside_any_sample_are_learned(ready):
    docs, labels = labelled(ready, 3000)
    score = toxicity.scorer(ready, toxicity.train(docs, labels))
    texts = ready.createDataFrame([("some text foul",), ("some text vile",), ("some text kind",), ("some text",)], "text string")
    found = {r["text"]: r["s"] >= 0.5 for r in texts.withColumn("s", score(F.col("text"))).collect()}
    assert found["some text foul"] and found["some text vile"] and not found["some text kind"]


def test_every_labelled_document_is_counted(ready):
    docs, labels = labelled(ready, 2000)
    texts = toxicity.all_labelled(docs, labels, "toxic").withColumn("left_out", F.col("doc_id") % 5 == 1)
    totals = {r["bucket"]: (r["n"], r["toxic"]) for r in toxicity.counted(texts).where(F.col("bucket") >= toxicity.BUCKETS).collect()}
    known = [(r["doc_id"] % 5 == 1, r["mark"]) for r in texts.select("doc_id", "mark").collect()]
    assert totals[toxicity.BUCKETS + 1] == (len(known), sum(m for _, m in known)) and len(known) > 3000
    assert totals[toxicity.BUCKETS] == (sum(not o for o, _ in known), sum(m for o, m in known if not o))


def test_the_network_does_not_depend_on_partitions(ready):
    docs, labels = labelled(ready, 1500)
    one, other = (toxicity.train(docs.repartition(k), labels.repartition(k)) for k in (1, 7))
    assert np.array_equal(one.vectors, other.vectors) and np.array_equal(one.out, other.out) and np.array_equal(one.shifts, other.shifts)
