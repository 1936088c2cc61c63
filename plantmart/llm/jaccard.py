"""N-gram Jaccard join: documents whose shingle sets are within a Jaccard distance are linked, exactly.

Jaccard distance is a metric, and the join divides its space with pivots, level by level. Almost all documents are at distance
1 from each other, so document pivots cannot divide the whole table; three kinds of pivots follow one another.

1. **Single shingles as pivots.** A document is nearer than 1 to the pivot {s} only if it has s. It is replicated to the regions of
   its first ``n - ceil(p n) + k`` shingles in one global order (rare ones first): documents that share fewer than k of these differ
   in too many shingles to be within the radius, so linked documents meet in k regions at least. Regions of one document, nearly
   all, go away, and so does a document that is in fewer regions than a partner of any allowed size would share with it.
2. **The empty set as pivot** (set size). A region is divided by size into rings whose bounds grow by the threshold; a document also
   goes to the ring below its own, as linked documents are at most one ring apart.
3. **Documents as pivots.** A region's first pivot gets exact distances to all its members. By the triangle inequality members
   further apart than the radius in these distances cannot be linked, so later pivots only meet the members of their own
   and the neighbouring windows. A second bound is at hand for any two members: parity vectors differ in at most as many places as the
   sets do, see ``parities``. Each level takes several times as many pivots of the regions that are still open; a region is done
   when all its members are in one component. When no more members are outside its largest component than the level has pivots,
   these are its last pivots: they meet all other components, and members of one need not meet. A dense group of near copies
   therefore ends after its first pivots, without its pairs, and a few strangers in it cost one level.

Documents with equal sets are one class first, so copies cost nothing further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .registry import query, table
from .words import U, Words, mix, word_slices

WIDTH, PERCENT = 4, 85
PLACES = 16
BITS = [f"b{k}" for k in range(PLACES)]
BLOCK = 2_000_000  # shingles that are counted together when looking for common ones
COMMON_IN_BLOCK = 3
COMMON_KEPT = 200_000
SIEVES = 1  # how often documents in too few regions are taken out


def shingles(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, rising, and the offsets of the texts in them.

    A text with fewer words than ``width`` has one shingle, all its words; a text without words has none.
    """
    first = words.first
    n = np.diff(first)
    runs = max(0, len(words.hash) - width + 1)
    text, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        if runs:
            values = np.full(runs, U(width), np.uint64)
            for k in range(width):
                values = mix(values * U(3) + words.hash[k : k + runs])
            inside = np.arange(runs) + width <= first[words.text[:runs] + 1]
            text, values = words.text[:runs][inside], values[inside]
        for size in range(1, width):
            few = np.flatnonzero(n == size)
            one = np.full(len(few), U(size), np.uint64)
            for k in range(size):
                one = mix(one * U(3) + words.hash[first[few] + k])
            text, values = np.concatenate([text, few]), np.concatenate([values, one])
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text[fresh], minlength=words.n))]).astype(np.int64)
    return values[fresh], offsets


def _longs(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def parities(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A vector of ``64 * PLACES`` bits for each set, ``PLACES`` longs: a bit is whether the set has an odd number of shingles there.

    Shingles that two sets share cancel out, so their vectors differ in at most as many bits as the sets differ in shingles.
    """
    n, wide = len(offsets) - 1, 64 * PLACES
    text = np.repeat(np.arange(n), np.diff(offsets))
    odd = np.bincount(text * wide + (values % U(wide)).astype(np.int64), minlength=n * wide).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, wide), axis=1).view(np.int64).reshape(n, PLACES)


def _digests(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    raw = values.tobytes()
    found = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(offsets, offsets[1:])]
    return pa.array(found, pa.binary())


def common_shingles(docs: DataFrame, width: int = WIDTH, kept: int = COMMON_KEPT) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many texts have, rising, and about how many. Only orders shingles, so it never changes a result."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            values, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= COMMON_IN_BLOCK
            return pa.RecordBatch.from_arrays(
                [pa.array(values[often].view(np.int64)), pa.array(times[often], pa.int64())], ["shingle", "n"]
            )

        for batch in batches:
            for _, _, words in word_slices(batch.column(0)):
                values, _ = shingles(words, width)
                held.append(values)
                n += len(values)
                if n >= BLOCK:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    found = docs.select("text").mapInArrow(count, "shingle long, n long")
    often = found.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(kept).toArrow()
    values = np.asarray(often.column("shingle").to_numpy(), np.int64).view(np.uint64)
    times = np.asarray(often.column("n").to_numpy(), np.int64)
    order = np.argsort(values)
    return values[order], times[order]


def meetings(n):
    """In how many regions two linked documents of ``n`` shingles or more meet at least."""
    return n // 50 + 1


def prefixes(docs: DataFrame, common, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """A row per text: id, n, digest of the set, and the shingles of its prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = shared.value
        for batch in batches:
            for at, to, words in word_slices(batch.column(1)):
                values, offsets = shingles(words, width)
                n = np.diff(offsets)
                weight = np.zeros(len(values), np.int64)
                if len(known):
                    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
                    weight = np.where(known[place] == values, times[place], 0)
                text = np.repeat(np.arange(words.n), n)
                order = np.lexsort((values, weight, text))
                rank = np.arange(len(values)) - offsets[text]
                size = np.where(n > 0, np.minimum(n, n - (percent * n + 99) // 100 + meetings(n)), 0)
                chosen = values[order][rank < size[text]]
                bounds = np.concatenate([[0], np.cumsum(size)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, to - at), pa.array(n, pa.int64()), _digests(values, offsets),
                        _longs(chosen, bounds),
                    ],
                    ["id", "n", "digest", "prefix"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(read, f"id {kind}, n long, digest binary, prefix array<long>")


def whole_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row per text: n, digest, all shingles of its set, and its parity vector."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in word_slices(batch.column(0)):
                values, offsets = shingles(words, width)
                bits = parities(values, offsets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.diff(offsets), pa.int64()), _digests(values, offsets), _longs(values, offsets)]
                    + [pa.array(np.ascontiguousarray(bits[:, k])) for k in range(PLACES)],
                    ["n", "digest", "set", *BITS],
                )

    kinds = ", ".join(f"{b} long" for b in BITS)
    return docs.select("text").mapInArrow(read, f"n long, digest binary, set array<long>, {kinds}")


def node_of(seed: int) -> Column:
    """A number for a set, from its size and digest."""
    return F.xxhash64("n", "digest", F.lit(seed))


def classes_of(texts: DataFrame) -> tuple[DataFrame, int]:
    """A row per distinct set: n, digest, ``low`` (smallest id), ``copies``, ``node``; and the seed that makes nodes distinct."""
    found = cut_lineage(texts.groupBy("n", "digest").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies")))
    seed = 0
    while not found.groupBy(node_of(seed).alias("node")).count().where("count > 1").isEmpty():
        seed += 1
    return found.withColumn("node", node_of(seed)), seed


def regions_of(texts: DataFrame, classes: DataFrame, seed: int, percent: int = PERCENT) -> DataFrame:
    """Members of regions: shingle, ring, node, n. Regions with the same members as another are left out."""
    rows = texts.where("n > 0").select(node_of(seed).alias("node"), F.explode("prefix").alias("shingle"))
    # Dealt out once; counting and joining below find the rows of a shingle together.
    rows = rows.repartition("shingle")
    # Regions are alike if all of this is; a node that copies repeat is repeated equally in all its regions.
    total = lambda seed: F.sum(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 31)))
    marks = [F.count(F.lit(1)).alias("m"), F.min("node").alias("least"), F.max("node").alias("most")]
    marks += [total(1).alias("x"), total(2).alias("y")]
    alike = ["m", "least", "most", "x", "y"]
    shared = rows.groupBy("shingle").agg(*marks).where("least < most")
    # Of shingles with the same members one stands for all; ``twins`` is how many.
    shared = shared.groupBy(*alike).agg(F.min("shingle").alias("shingle"), F.count(F.lit(1)).alias("twins"))
    # Copies of a set give equal rows.
    held = rows.join(shared.select("shingle", "twins"), "shingle").distinct().join(classes.select("node", "n"), "node")
    step = float(np.log(100 / percent))
    # Rounding cannot part linked documents: rings are a little wider than the threshold asks for.
    ring = F.floor(F.log(F.col("n").cast("double")) / F.lit(step * 1.000001))
    rings = cut_lineage(held.withColumn("ring", F.explode(F.array(ring, ring - 1))))
    # A partner has at least ``percent`` of a document's shingles.
    least = F.floor(F.floor(F.col("n") * percent / 100) / 50) + 1
    for _ in range(SIEVES):
        full = rings.groupBy("shingle", "ring").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
        rings = rings.join(full.select("shingle", "ring"), ["shingle", "ring"])
        often = rings.groupBy("node", "ring").agg(F.sum("twins").alias("met"), F.first("n").alias("n")).where(F.col("met") >= least)
        rings = cut_lineage(rings.join(often.select("node", "ring"), ["node", "ring"]))
    full = rings.groupBy("shingle", "ring").agg(*marks).where("m > 1")
    # Of regions with the same members one is enough.
    full = full.groupBy(*alike).agg(F.min(F.struct("shingle", "ring")).alias("r")).select("r.*")
    return rings.drop("twins").join(full, ["shingle", "ring"])


def _neighbours(edges: DataFrame) -> DataFrame:
    """Edges (a, b) in both directions."""
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def hooked(edges: DataFrame) -> DataFrame:
    """``node`` and ``to``, a node of the same component, for the nodes of ``edges`` (a, b): the first by ``_turn`` of it and its neighbours.

    What is linked to an early pivot gets the pivot in one pass. Not one for a whole component, so it only saves work; ``components``
    is exact.
    """
    first = _neighbours(edges).groupBy("a").agg(F.min(F.struct(_turn("b").alias("turn"), F.col("b").alias("to"))).alias("first"))
    to = F.when(F.col("first.turn") < _turn("a"), F.col("first.to")).otherwise(F.col("a"))
    return first.select(F.col("a").alias("node"), to.alias("to"))


def _turn(node: str) -> Column:
    """Nodes become pivots in this order, spread evenly over the longs."""
    return F.xxhash64(node)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) for the nodes of ``edges`` (a, b)."""
    both = cut_lineage(_neighbours(edges).distinct())
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
    while True:
        # The smallest label among the neighbours, then the label of that label.
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        new = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.least("label", "near").alias("to"), F.col("label").alias("old")
        )
        jump = new.select(F.col("node").alias("to"), F.col("to").alias("further"))
        new = cut_lineage(
            new.join(jump, "to").select("node", F.least("to", "further").alias("label"), "old")
        )
        if new.where("label < old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _linked(common: Column, a: Column, b: Column, percent: int) -> Column:
    return common * 100 >= (a + b - common) * percent


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b, na, nb and others) with ``common``, the exact number of shingles that both have."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    found = pairs.join(one, "a").join(two, "b")
    return found.select(*pairs.columns, F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"))


def _distance(common: Column, a: Column, b: Column) -> Column:
    return F.lit(1.0) - common / (a + b - common)


def links(regions: DataFrame, sets: DataFrame, percent: int = PERCENT, growth: int = 8) -> DataFrame:
    """Edges (a, b) that connect exactly the components of all links among the members of ``regions``."""
    radius = 1 - percent / 100 + 1e-9
    regions = regions.withColumn("turn", F.struct(_turn("node").alias("order"), F.col("node").alias("node")))
    key = ["shingle", "ring"]
    heads = regions.groupBy(*key).agg(F.min(F.struct("turn", "n")).alias("head"), F.count(F.lit(1)).alias("m"))
    first = heads.select(*key, "m", F.col("head.turn.node").alias("pivot"), F.col("head.n").alias("pn"))
    held = cut_lineage(regions.join(first, key))
    pairs = held.where("node <> pivot").select(
        F.col("node").alias("a"), F.col("pivot").alias("b"), F.col("n").alias("na"), F.col("pn").alias("nb")
    ).distinct()
    found = cut_lineage(measured(pairs, sets))
    edges = found.where(_linked(F.col("common"), F.col("na"), F.col("nb"), percent)).select("a", "b")
    fresh = edges
    away = found.select(
        F.col("a").alias("node"), F.col("b").alias("pivot"), _distance(F.col("common"), F.col("na"), F.col("nb")).alias("d")
    )
    # The members that are still to meet, with their distance to the first pivot; the pivot itself is done.
    bits = sets.select("node", *BITS)
    rest = held.drop("pn").join(away, ["node", "pivot"]).drop("pivot").join(bits, "node").withColumn("label", F.col("node"))
    # Turns are hashes, spread evenly over the longs; a level takes the pivots up to a bound that each region has in this range.
    floor, span = float(-(1 << 63)), float(1 << 64)
    pivots = 1
    while True:
        # Members with one label are in one component; links between labels since the level before join these labels.
        joined = hooked(fresh).withColumnRenamed("node", "label")
        pivots *= growth
        upto = F.lit(floor) + F.least(F.lit(1.0), F.lit(float(pivots)) / F.col("m")) * span
        named = rest.join(joined, "label", "left").withColumn("label", F.coalesce("to", "label")).drop("to")
        # The label that most members of a region have, and how many have others; a region of one label is done.
        sizes = named.groupBy(*key, "label").agg(F.count(F.lit(1)).alias("c"))
        state = sizes.groupBy(*key).agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("left")).where("top.c < left")
        state = state.select(*key, F.col("top.label").alias("main"), (F.col("left") - F.col("top.c")).alias("others"))
        rest = cut_lineage(named.join(state, key).withColumn("window", F.floor(F.col("d") / F.lit(radius))))
        if rest.isEmpty():
            return edges
        # No more members with other labels than a level has pivots: they are the last pivots, and the region is done.
        last = F.col("others") <= pivots
        now = rest.where(F.when(last, F.col("label") != F.col("main")).otherwise(F.col("turn.order") <= upto))
        w = F.col("window")
        probes = now.select(
            *key, F.explode(F.array(w - 1, w, w + 1)).alias("window"), F.col("node").alias("b"), F.col("n").alias("nb"),
            F.col("turn").alias("tb"), F.col("label").alias("lb"), F.col("d").alias("db"), *[F.col(b).alias(f"p{b}") for b in BITS],
        )
        few, many = F.least("n", "nb"), F.greatest("n", "nb")
        apart = reduce(lambda x, y: x + y, (F.bit_count(F.col(b).bitwiseXOR(F.col(f"p{b}"))) for b in BITS))
        pairs = (
            rest.join(probes, [*key, "window"])
            .where((F.col("label") != F.col("lb")) & ((F.col("turn") > F.col("tb")) | (last & (F.col("label") == F.col("main")))))
            .where((F.abs(F.col("d") - F.col("db")) <= radius) & (few * 100 >= many * percent))
            .where(apart * (100 + percent) <= (F.col("n") + F.col("nb")) * (100 - percent))
            .select(F.col("node").alias("a"), "b", F.col("n").alias("na"), "nb", F.col("label").alias("la"), "lb")
            .distinct()
        )
        found = cut_lineage(
            measured(pairs, sets).where(_linked(F.col("common"), F.col("na"), F.col("nb"), percent)).select("a", "b", "la", "lb")
        )
        edges = edges.unionByName(found.select("a", "b"))
        fresh = found.select(F.col("la").alias("a"), F.col("lb").alias("b"))
        # A member whose turn as a pivot is over has met all later ones; earlier ones met it as pivots themselves.
        rest = rest.where(~last & (F.col("turn.order") > upto)).drop("window", "main", "others")


def jaccard_components(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``n_same`` (rows with the same set, itself included).

    Words are runs outside ASCII white space with A-Z lower-cased. Two texts are linked when
    ``100 * intersection >= percent * union`` of their distinct shingles of ``width`` words (a shorter text has one shingle, all
    its words). A text without words, or a null, is linked with nothing. ``component_id`` is the smallest id that links reach.
    Rows without id take part; a component of only such rows has a null id. Repeated rows have equal sets and are linked. An
    empty table gives no rows. Other columns are not read.
    """
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    texts = cut_lineage(prefixes(docs, common_shingles(docs, width), width, percent))
    classes, seed = classes_of(texts)
    regions = cut_lineage(regions_of(texts, classes, seed, percent))
    wanted = regions.select("node").distinct().join(classes.select("node", "low"), "node")
    # Texts of the classes that are left, by their smallest ids; a class without an id is looked for among rows without one.
    ids = wanted.where("low is not null").select(F.col("low").alias("id")).distinct()
    # One plan at any size: texts and ids are sorted and merged, so no side has to fit anywhere.
    some = docs.join(ids.hint("merge"), "id", "left_semi").unionByName(docs.where("id is null"))
    sets = cut_lineage(whole_sets(some, width).select(node_of(seed).alias("node"), "set", *BITS))
    if not sets.groupBy("node").count().where("count > 1").isEmpty():  # repeated rows
        sets = cut_lineage(sets.dropDuplicates(["node"]))
    labels = components(links(regions, sets, percent))
    named = classes.join(labels, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("low").alias("component"))
    named = named.join(least, "label").select("n", "digest", "copies", "component")
    alone = F.col("n") == 0
    return texts.select("id", "n", "digest").join(named, ["n", "digest"]).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("component")).alias("component_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("copies")).cast("long").alias("n_same"),
    )


@query("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))
