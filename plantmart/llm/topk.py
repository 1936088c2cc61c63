"""Exact top-k search by distributed histogram selection.

Queries and vectors are dealt evenly into blocks of bounded size, and every block of queries meets every block of vectors in a task of
its own, which scores them all. A round gives, for each query, a histogram of its scores over all vectors, summed over the blocks; the
bin that holds the k-th value becomes the range of the next round, until a bin is one value wide. A last round lists what reaches this
value, and ties are broken by the smaller id.

A block leaves out bins below its own k-th value, and rows behind its own first k: the k-th value of all vectors is no smaller than that
of some of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .registry import query, table

K = 20
BINS = 1024
BLOCK = 4096  # vectors, and queries, of a block
TOGETHER = 128  # queries that are scored at once
EXACT = 1 << 53


def whole_numbers(vector: Column, scale: int = 64) -> Column:
    """Components as floor(scale * x), null unless the vector and all its components are there and finite."""
    real = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(real, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.when(fine, F.transform(real, lambda x: F.floor(x * F.lit(float(scale)))))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors are filled with 0."""
    column = column.combine_chunks()
    size = np.asarray(column.value_lengths(), np.int64)
    values = np.asarray(column.flatten(), np.int64)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = values
    return out


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where all sums fit their 53 bits, else in 64-bit integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])
    if most < EXACT:
        return np.rint(queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    return queries @ vectors.T


def _met(vectors: DataFrame, queries: DataFrame, n_vectors: int, n_queries: int, work, kind: str) -> DataFrame:
    """``work(queries, vectors)`` for each block of queries and each block of vectors. Rows fall evenly into blocks by their number."""
    across, down = math.ceil(n_vectors / BLOCK) or 1, math.ceil(n_queries / BLOCK) or 1
    part = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    right = vectors.select("*", part(across).alias("across"), every(down).alias("down"))
    left = queries.select("*", part(down).alias("down"), every(across).alias("across"))

    def apply(key: tuple, some: pa.Table, others: pa.Table) -> pa.Table:
        return work(some, others)

    return left.groupBy("down", "across").cogroup(right.groupBy("down", "across")).applyInArrow(apply, kind)


def _histogram():
    """A round: scores of each query from ``lo`` to below ``hi``, counted by bin; bins are ``wide``."""

    def work(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        rows, bins, counts = [], [], []
        if queries.num_rows and vectors.num_rows:
            width = max(queries["size"].combine_chunks().to_numpy().max(), vectors["size"].combine_chunks().to_numpy().max())
            v, q = _matrix(vectors["whole"], width), _matrix(queries["whole"], width)
            vector_row = vectors["row"].to_numpy()
            row, lo, hi, wide, need = (queries[c].to_numpy() for c in ("row", "lo", "hi", "wide", "need"))
            for at in range(0, len(q), TOGETHER):
                to = min(len(q), at + TOGETHER)
                scores = _scores(q[at:to], v)
                place = (scores - lo[at:to, None]) // wide[at:to, None]
                inside = (place >= 0) & (scores < hi[at:to, None]) & (vector_row != row[at:to, None])
                whose = np.broadcast_to(np.arange(to - at)[:, None], place.shape)[inside]
                found = np.bincount(whose * BINS + place[inside], minlength=(to - at) * BINS).reshape(to - at, BINS)
                above = np.cumsum(found[:, ::-1], axis=1)[:, ::-1] - found
                a, b = np.nonzero((found > 0) & (above < need[at:to, None]))
                rows.append(row[at:to][a])
                bins.append(b)
                counts.append(found[a, b])
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        return pa.table({"row": join(rows), "bin": join(bins), "n": join(counts)})

    return work


def _listing(k: int):
    """The last round: the first ``k`` of each query's vectors in this block that reach its k-th value ``lo``."""

    def work(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        rows, ids, at_rows, found = [], [], [], []
        id_type = vectors.schema.field("vec_id").type
        if queries.num_rows and vectors.num_rows:
            # By id, so that the first of equal scores is the one with the smallest id; a null id comes last.
            vectors = vectors.sort_by([("vec_id", "ascending"), ("row", "ascending")])
            width = max(queries["size"].combine_chunks().to_numpy().max(), vectors["size"].combine_chunks().to_numpy().max())
            v, q = _matrix(vectors["whole"], width), _matrix(queries["whole"], width)
            vector_row = vectors["row"].to_numpy()
            row, lo = queries["row"].to_numpy(), queries["lo"].to_numpy()
            for at in range(0, len(q), TOGETHER):
                to = min(len(q), at + TOGETHER)
                scores = _scores(q[at:to], v)
                a, b = np.nonzero((scores >= lo[at:to, None]) & (vector_row != row[at:to, None]))
                value = scores[a, b]
                order = np.lexsort((b, -value, a))
                a, b, value = a[order], b[order], value[order]
                start = np.searchsorted(a, a, side="left")
                first = np.arange(len(a)) - start < k
                rows.append(row[at:to][a[first]])
                at_rows.append(b[first])
                found.append(value[first])
            ids = vectors["vec_id"].take(pa.array(np.concatenate(at_rows)))
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        where = vectors["row"].to_numpy()[join(at_rows)] if at_rows else np.zeros(0, np.int64)
        return pa.table({"row": join(rows), "vec_id": ids if at_rows else pa.array([], id_type), "vec_row": where, "score": join(found)})

    return work


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The ``k`` vectors with the highest inner product for each query: query_id, rank, vec_id, score.

    Queries are the rows for which ``is_query`` holds; each is compared with every other row. Components are floor(scale * x); a vector
    that is null or holds a null or a number that is not finite takes no part. A shorter vector counts as filled with 0. Ties go to
    the smaller id, a null id comes last, and then to either of two rows with one id, which give the same row. A repeated row is
    a query, or a vector, of its own. With fewer than ``k`` other rows there are fewer ranks. Scores are exact as far as they fit 64 bits.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        whole_numbers(F.col(vector_column), scale).alias("whole"),
    ).where(F.col("whole").isNotNull())
    squares = F.aggregate("whole", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = cut_lineage(rows.withColumns({"size": F.size("whole"), "norm": F.sqrt(squares)}))
    spark = rows.sparkSession
    kind = rows.schema["vec_id"].dataType.simpleString()
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asking"), F.max("norm").alias("norm")).first()
    n, asking = sizes["n"], sizes["asking"]
    plain = rows.select("row", "vec_id", "whole", "size")
    # By Cauchy and Schwarz no score is beyond the product of the norms. With fewer than k others the least score is the k-th value.
    bound = F.ceil(F.col("norm") * F.lit(float(sizes["norm"] or 0.0)) * F.lit(1.0 + 1e-9)) + 1
    state = rows.where("asks").select(
        "row", "vec_id", "whole", "size", (-bound).alias("lo"), (bound + 1).alias("hi"),
        F.ceil((2 * bound + 1) / F.lit(float(BINS))).cast("long").alias("wide"),
        F.lit(min(k, max(n - 1, 0))).cast("long").alias("need"),
    )
    done: list[DataFrame] = []
    left = asking if n > 1 else 0
    while left:
        found = _met(plain.drop("vec_id"), state.drop("vec_id"), n, left, _histogram(), "row long, bin long, n long")
        bars = found.groupBy("row", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("row").orderBy(F.col("bin").desc()))
        # At most BINS bars a query: the first one down to which there are as many as needed.
        bars = bars.withColumn("reached", above).join(state, "row").where(F.col("reached") >= F.col("need"))
        at = bars.groupBy("row").agg(F.max_by(F.struct("bin", "n", "reached"), "bin").alias("at")).join(state, "row")
        low = F.col("lo") + F.col("at.bin") * F.col("wide")
        narrowed = at.select(
            "row", "vec_id", "whole", "size", low.alias("lo"), F.least(low + F.col("wide"), F.col("hi")).alias("hi"), F.col("wide").alias("was"),
            F.ceil(F.col("wide") / F.lit(float(BINS))).cast("long").alias("wide"),
            (F.col("need") - (F.col("at.reached") - F.col("at.n"))).alias("need"),
        )
        narrowed = cut_lineage(narrowed)
        done.append(narrowed.where("was = 1").select("row", "vec_id", "whole", "size", "lo"))
        state = narrowed.where("was > 1").drop("was")
        left = state.count()
    if not done:
        nothing = f"query_id {kind}, rank int, vec_id {kind}, score long"
        return spark.createDataFrame([], nothing)
    settled = done[0]
    for more in done[1:]:
        settled = settled.unionByName(more)
    names = rows.select("row", F.col("vec_id").alias("query_id")).where("asks")
    listed = _met(plain, settled.drop("vec_id"), n, asking, _listing(k), f"row long, vec_id {kind}, vec_row long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "vec_row")
    first = listed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return first.join(names, "row").select("query_id", "rank", "vec_id", "score")


@query(
    "op12_exact_top_k",
    r"""
    WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS whole
               FROM embeddings
               WHERE embedding IS NOT NULL AND coalesce(len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))), 0) = 0),
         s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.whole, c.whole)::BIGINT AS score, c.r AS other
               FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, other) AS rank FROM s)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
)
def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
