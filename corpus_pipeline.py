"""Corpus pipeline: stages over ``documents``, each reading all that the one before kept.

Toxic documents go, then documents of poor quality, then exact copies, then near copies; what is left is packed into sequences. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmart.llm import line_quality, packing, toxicity
from plantmart.llm.exact_dedup import exact_copies
from plantmart.llm.jaccard import jaccard_components
from plantmart.llm.registry import prepare, table
from plantmart.session import work_path

# Near copies: texts whose sets of shingles of so many words have at least this Jaccard similarity in percent.
NEAR_WIDTH, NEAR_PERCENT = 5, 80
# Names that no column of a table is likely to have.
VERDICT, LEAST, KEY = "__verdict__", "__least__", "__key__"


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold. The classifier learns from the labelled ones among all documents.

    A null text is scored like an empty one, repeated rows are judged alike and all stay or all go, and an empty table gives no rows.
    """
    prepare(spark)
    net = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = toxicity.scorer(spark, net)
    return docs.withColumn(VERDICT, score(F.col("text"))).where(F.col(VERDICT) < 0.5).drop(VERDICT)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality reaches the threshold. The classifier learns from the labelled ones among all documents.

    A null text is scored like an empty one, repeated rows are judged alike and all stay or all go, and an empty table gives no rows.
    """
    prepare(spark)
    field = line_quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = line_quality.scorer(spark, field)
    return docs.withColumn(VERDICT, score(F.col("text"))).where(F.col(VERDICT) >= line_quality.THRESHOLD).drop(VERDICT)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row: its id (rows without one come last) and 128 bits of hash over all columns.

    The key follows from the row alone, so it is the same whenever the table is read; only rows equal in all columns share it.
    """
    columns = [*docs.columns, *(F.col(c).isNull() for c in docs.columns)]
    parts = [F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")]
    parts += [F.xxhash64(F.lit(seed), *columns).alias(f"h{seed}") for seed in (1, 2)]
    return docs.withColumn(KEY, F.struct(*parts))


def _one_of_each(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key is the smallest of their group (``groups`` has ``KEY`` and ``LEAST``); of equal rows one."""
    kept = groups.where(F.col(KEY) == F.col(LEAST)).select(KEY).distinct()
    return keyed.join(kept, KEY, "left_semi").dropDuplicates([KEY]).drop(KEY)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id, or any one of those without id if none has one.

    A null text equals an empty one. Rows with one id and different texts are different documents; equal rows are one. An empty table
    gives no rows.
    """
    prepare(spark)
    keyed = _keyed(docs)
    groups = exact_copies(keyed, id_column=KEY).select(KEY, F.col("keep_id").alias(LEAST))
    return _one_of_each(keyed, groups)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of Jaccard similarity connect the one with the smallest id, or one of those without id if none has one.

    Documents without words, null ones among them, are linked with nothing and stay; but of rows equal in all columns one stays. Rows
    with one id and different texts are different documents. An empty table gives no rows.
    """
    prepare(spark)
    keyed = _keyed(docs)
    groups = jaccard_components(keyed, width=NEAR_WIDTH, percent=NEAR_PERCENT, id_column=KEY)
    return _one_of_each(keyed, groups.select(KEY, F.col("component_id").alias(LEAST)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences, see ``packing.pack``.

    A null text is an empty one and has its end token; rows without id and repeated rows are packed each on their own; an empty table
    gives no rows.
    """
    prepare(spark)
    return packing.pack(docs, packing.tokenizer_text("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", not_toxic),
    ("quality classifier", good_quality),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("packing", packed),
]

# Learned classifiers and tokenizers cannot be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is written to the shared folder and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
