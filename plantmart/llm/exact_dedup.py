"""Exact dedup: rows whose texts are equal after white space is made uniform; the smallest id of each group stays.

Rows are grouped by a 128-bit content hash on narrow rows. Texts themselves are only grouped for hashes that occur twice or
more; there the grouping key holds the text, so unequal texts with one hash fall apart. Copies meet in the map tasks first, so
a group of any size sends one row a task.

No join has the hash alone as its key on rows: the rows of a hash are dealt to slices by their id, and rows and verdicts meet by
hash and slice. Only slices, at most ``SLICES`` to a hash, meet by hash alone. A hash shared by different texts is the one case in
which rows meet their verdict by text. Rows without id, or with one id, and one text share a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .registry import query, table
from .words import SPACES

# The rows of one hash are dealt to so many slices, so that a third of all rows may share it.
SLICES = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _classes(rows: DataFrame) -> DataFrame:
    """Each different text once, with its smallest id and its number of rows."""
    return rows.groupBy("digest", "norm").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("size"))


def exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", digest=F.md5) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    A null text counts as empty. Rows without id count in their group, never stay if another row has an id, and a group of
    such rows only has a null ``keep_id`` and keeps them. A repeated row (same id, same text) is a row of its own and gets the
    same verdict each time. An empty table gives no rows. Other columns are not read.
    ``digest`` makes the hex content hash; texts are compared whatever it is.
    """
    rows = docs.select(F.col(id_column).alias("id"), normalised(F.col(text_column)).alias("norm"))
    dealt = F.pmod(F.xxhash64("id"), F.lit(SLICES)).cast("int")
    keyed = rows.withColumns({"digest": F.unhex(digest("norm")), "slice": dealt})
    prints = cut_lineage(keyed.select("id", "digest", "slice", F.unhex(F.sha2("norm", 256)).alias("sha")))
    slices = prints.groupBy("digest", "slice").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("digest"))
    repeated = cut_lineage(slices.select("digest", "slice", total.alias("total")).where("total > 1").drop("total"))

    # Merge joins at any size: a plan that broadcasts while the copies are few would move no texts then and all of them later.
    classes = _classes(keyed.join(repeated.hint("merge"), ["digest", "slice"], "left_semi"))
    settled = classes.groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.min("keep").alias("keep"), F.min("size").alias("size")
    )
    settled = cut_lineage(settled)
    verdicts = repeated.join(settled.hint("merge"), "digest")
    found = prints.join(verdicts.hint("merge"), ["digest", "slice"], "left")
    alone = F.col("texts").isNull()
    agreed = found.where(alone | (F.col("texts") == 1)).select(
        "id", F.when(alone, F.col("id")).otherwise(F.col("keep")).alias("keep"), F.coalesce("size", F.lit(1)).alias("size"), "sha"
    )
    # Different texts with one hash. Stored, so that Spark sees that there are hardly ever any and moves no text for them.
    collided = cut_lineage(settled.where("texts > 1").select("digest"))
    mixed = keyed.join(collided, "digest", "left_semi")
    parted = mixed.join(_classes(mixed), ["digest", "norm"]).select(
        "id", "keep", "size", F.unhex(F.sha2("norm", 256)).alias("sha")
    )
    return agreed.unionByName(parted).select(
        F.col("id").alias(id_column),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


@query(
    "op10_exact_dedup",
    r"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
         g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
    """,
)
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_copies(table(spark, folder, "documents"))
