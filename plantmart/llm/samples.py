"""Labelled texts: all of them, and bounded samples for fitting classifiers on the driver."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import first_by_hash
from .words import id_remainder

FOLDS, HELD_OUT_FOLD = 5, 0


def held_out(doc_id):
    """Rows that no classifier learns from: crc32 of the id as text leaves 0 modulo 5."""
    return id_remainder(doc_id, FOLDS) == HELD_OUT_FOLD


def _marks(labels: DataFrame, label: str) -> DataFrame:
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("mark"))
    )


def all_labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``doc_id``, ``text`` and ``mark`` of every document with mark 0 or 1 outside the held-out fold.

    Labels without id or mark are left out; an id with several marks has the smallest one.
    """
    learned = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Marks grow with the table, so they are not broadcast at any size.
    return learned.join(_marks(labels, label).hint("merge"), "doc_id")


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, most: int) -> pa.Table:
    """``doc_id``, ``text`` and ``mark`` of at most ``most`` documents of each mark 0 and 1, in order of the id.

    Only ids outside the held-out fold are taken, the ones whose hashes are smallest. Labels without id or mark are left out; an
    id with several marks has the smallest one.
    """
    marks = _marks(labels, label)
    few = first_by_hash(marks.where("mark = 0"), "doc_id", most).unionByName(first_by_hash(marks.where("mark = 1"), "doc_id", most))
    # At most 2 * most narrow rows, so they may be broadcast.
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), "doc_id")
    return found.orderBy("doc_id", "text").toArrow()
