"""How the terms of sources differ from each other and from their language, by chunk factorization.

White-space chunks are counted inside each document; each distinct chunk of all documents is split into terms once, and these are
joined with the chunk's counts. Terms never reach over a chunk's end, as white space is no part of a term, so a term's occurrences are
sums over chunks. Documents are not: a document may hold a term in several chunks. Counts of chunks and terms therefore keep their first
``LEAST`` documents in each language and source, which say exactly whether a term is in so many.

Counts travel compressed, one row for each task and bucket; a frequent chunk or term has one entry from each task, language and source.

Shares are integers out of ``SCALE``. The divergence of two sources sums over all kept terms, most of which neither has. With p(c) the
share of a term that occurs c times, f(p, q) splits into the part of a term that neither has, the two parts that depend on one count
only (sums over the sources' histograms of counts), and a correction for terms that both have.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .registry import query, table

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE = 1_000_000_000
LEAST = 3  # documents of a language that a kept term is in
RANKS = 200
BLOCK = 250_000  # chunks that a task counts together; after ten times as many counts it adds them up or hands them on
BUCKET_BYTES = 16 << 20  # text for each bucket of chunks, and of terms
GROUP_BITS = 24  # of the number of an item and its group
PAIRS = 1 << 20  # pairs of sources that are compared together


class Tally:
    """Occurrences of items in groups: entries of item, group, document and count, of which each pair of item and group has ``LEAST``
    at most. They hold the first documents, and the count of all; so pairs that have more are known to have enough."""

    def __init__(self) -> None:
        self.items: dict[bytes, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, item: np.ndarray, group: np.ndarray, row: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((item << GROUP_BITS | group, row, n))
        self.size += len(item)

    def folded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All entries: item and group in one number, document, count."""
        if len(self.parts) > 1 or self.size:
            key, row, n = (np.concatenate(x) for x in zip(*self.parts))
            order = np.lexsort((row, key))
            key, row, n = key[order], row[order], n[order]
            fresh = np.r_[True, key[1:] != key[:-1]][: len(key)]
            start = np.flatnonzero(fresh)
            sums = np.add.reduceat(n, start) if len(start) else n
            once = np.flatnonzero(fresh | np.r_[True, row[1:] != row[:-1]][: len(row)])
            key, row, n = key[once], row[once], np.zeros(len(once), np.int64)
            fresh = np.r_[True, key[1:] != key[:-1]][: len(key)]
            start = np.flatnonzero(fresh)
            n[start] = sums
            first = np.arange(len(key)) - np.repeat(start, np.diff(np.r_[start, len(key)])) < LEAST
            self.parts, self.size = [(key[first], row[first], n[first])], 0
        return self.parts[0] if self.parts else (np.zeros(0, np.int64),) * 3

    def packed(self, buckets: int) -> Iterator[pa.RecordBatch]:
        """The entries by bucket of their item, compressed: bucket, entries."""
        key, row, n = self.folded()
        item, group = key >> GROUP_BITS, key & ((1 << GROUP_BITS) - 1)
        names = pa.array(list(self.items), pa.binary())
        langs, sources = (pa.array([g[k] for g in self.groups], pa.string()) for k in (0, 1))
        bucket = np.fromiter((zlib.crc32(x) % buckets for x in self.items), np.int64, len(self.items))[item]
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(ends)).tolist():
            at = order[ends[k] : ends[k + 1]]
            distinct, place = np.unique(item[at], return_inverse=True)
            columns = [
                pa.DictionaryArray.from_arrays(pa.array(place.astype(np.int32)), names.take(pa.array(distinct))),
                *(pa.DictionaryArray.from_arrays(pa.array(group[at].astype(np.int32)), x) for x in (langs, sources)),
                pa.array(row[at]), pa.array(n[at]),
            ]
            batch = pa.RecordBatch.from_arrays(columns, ["item", "lang", "source", "row", "n"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([sink.getvalue().to_pybytes()])], ["bucket", "entries"])

    def unpack(self, batches: Iterator[pa.RecordBatch]) -> None:
        """Add what tasks have packed."""
        for batch in batches:
            for entries in batch.column(1):
                with pa.ipc.open_stream(entries.as_buffer()) as stream:
                    found = stream.read_next_batch()
                item, lang, source, row, n = found.columns
                own = np.array([self.items.setdefault(x, len(self.items)) for x in item.dictionary.to_pylist()], np.int64)
                pairs = zip(lang.dictionary.to_pylist(), source.dictionary.to_pylist())
                whose = np.array([self.groups.setdefault(x, len(self.groups)) for x in pairs], np.int64)
                self.add(own[item.indices.to_numpy()], whose[lang.indices.to_numpy()], row.to_numpy(), n.to_numpy())
                if self.size > 10 * BLOCK:
                    self.folded()


PACKED = "bucket int, entries binary"


def chunk_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """Counts of chunks, packed. ``docs`` has text, lang, source (no nulls) and row."""

    def fold(tally: Tally, words: list[list[bytes]], rows: list[int], whose: list[int]) -> None:
        """Count each document's chunks."""
        items = tally.items
        own = np.repeat(np.arange(len(words)), [len(x) for x in words])
        item = np.fromiter((items.setdefault(x, len(items)) for some in words for x in some), np.int64, len(own))
        key = item * len(words) + own
        key.sort()
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        item, own = key[start] // len(words), key[start] % len(words)
        tally.add(item, np.array(whose)[own], np.array(rows)[own], np.diff(np.r_[start, len(key)]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, words, rows, whose, size = Tally(), [], [], [], 0
        for batch in batches:
            columns = [batch.column(0).cast(pa.binary()), *map(batch.column, range(1, 4))]
            for text, lang, source, row in zip(*(c.to_pylist() for c in columns)):
                words.append(text.split())  # without arguments, split() parts bytes at [\x20\x09-\x0D]+
                rows.append(row)
                whose.append(tally.groups.setdefault((lang, source), len(tally.groups)))
                size += len(words[-1])
                if size >= BLOCK:
                    fold(tally, words, rows, whose)
                    words, rows, whose, size = [], [], [], 0
                    if tally.size >= 10 * BLOCK or len(tally.items) >= 3 * BLOCK:
                        yield from tally.packed(buckets)
                        tally = Tally()
        if words:
            fold(tally, words, rows, whose)
        yield from tally.packed(buckets)

    return docs.select("text", "lang", "source", "row").mapInArrow(count, PACKED)


def term_counts(chunks: DataFrame, buckets: int) -> DataFrame:
    """Counts of terms, packed, from all counts of chunks: each distinct chunk is split into its terms once."""
    term, low = re.compile(TERM), str.maketrans(UPPER, LOWER)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, tally = Tally(), Tally()
        chunks.unpack(batches)
        key, row, n = chunks.folded()
        terms = tally.items
        found = [[terms.setdefault(x.encode(), len(terms)) for x in term.findall(c.decode().translate(low))] for c in chunks.items]
        tally.groups = chunks.groups
        size = np.array([len(x) for x in found], np.int64)
        flat = np.fromiter((x for some in found for x in some), np.int64, size.sum())
        chunk = key >> GROUP_BITS
        # An entry of a chunk is one of each of its terms.
        own = np.repeat(np.arange(len(key)), size[chunk])
        nth = np.arange(len(own)) - np.repeat(np.cumsum(size[chunk]) - size[chunk], size[chunk])
        tally.add(flat[(np.cumsum(size) - size)[chunk[own]] + nth], key[own] & ((1 << GROUP_BITS) - 1), row[own], n[own])
        yield from tally.packed(buckets)

    return chunks.repartition(buckets, "bucket").mapInArrow(split, PACKED)


def kept_terms(terms: DataFrame, buckets: int) -> DataFrame:
    """Terms that ``LEAST`` documents of a language have: lang, term, n, found (each source that has it, and its count there)."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        tally.unpack(batches)
        key, _, n = tally.folded()
        langs: dict[str, int] = {}
        lang_of = np.array([langs.setdefault(lang, len(langs)) for lang, _ in tally.groups], np.int64)
        group = key & ((1 << GROUP_BITS) - 1)
        # A document has one source, so those of several sources are different ones.
        whole = (key >> GROUP_BITS) * max(len(langs), 1) + lang_of[group]
        order = np.argsort(whole, kind="stable")
        whole, key, n, group = whole[order], key[order], n[order], group[order]
        _, size = np.unique(whole, return_counts=True)
        keep = np.repeat(size >= LEAST, size)
        whole, key, n, group = whole[keep], key[keep], n[keep], group[keep]
        fresh = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        if not len(fresh):
            return
        n, whole, group = np.add.reduceat(n, fresh), whole[fresh], group[fresh]
        start = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]])
        sources = pa.array([source for _, source in tally.groups], pa.string())
        offsets = np.r_[start, len(whole)]
        names = pa.array(list(tally.items), pa.binary()).cast(pa.string())
        for at in range(0, len(start), 20_000):
            to = min(len(start), at + 20_000)
            a, b = offsets[at], offsets[to]
            entries = pa.StructArray.from_arrays([sources.take(pa.array(group[a:b])), pa.array(n[a:b])], ["source", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(langs), pa.string()).take(pa.array(whole[start[at:to]] % len(langs))),
                 names.take(pa.array(whole[start[at:to]] // len(langs))), pa.array(np.add.reduceat(n[a:b], start[at:to] - a)),
                 pa.ListArray.from_arrays(pa.array((offsets[at : to + 1] - a).astype(np.int32)), entries)],
                ["lang", "term", "n", "found"],
            )

    kind = "lang string, term string, n long, found array<struct<source: string, n: bigint>>"
    return terms.repartition(buckets, "bucket").mapInArrow(merge, kind)


def term_table(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept terms (``kept_terms``), and all groups (lang, source).

    A null text, lang or source counts as empty. Each row is a document of its own.
    """
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    rows = docs.select(*named, F.monotonically_increasing_id().alias("row"))
    # A bucket is held in one task: its counts are at most those of so much text, and a task sends one for each chunk and group.
    length = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + length // BUCKET_BYTES
    kept = cut_lineage(kept_terms(term_counts(chunk_counts(rows, buckets), buckets), buckets))
    return kept, rows.select("lang", "source").distinct()


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact: in 64 bits as far as they go, and beyond in decimals."""
    wide = lambda c: c.cast("decimal(19,0)")
    long = F.call_function("div", (count + 1) * F.lit(SCALE), total + terms)
    longer = F.call_function("div", wide(count + 1) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + terms))
    return F.when(count < 2**63 // SCALE - 1, long).otherwise(longer).cast("long") + 1


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def _shared_terms(rows: DataFrame) -> DataFrame:
    """For terms that two sources have, what their pair adds to the sums of single counts: lang, source, item, value.

    ``rows`` has lang and found: source, p (the source's share of this term), p0 (that of a term it lacks).
    """
    kind = "lang string, source string, item string, value long"

    def add(sums: Counter, langs: np.ndarray, names: np.ndarray, size: np.ndarray, first: np.ndarray, p: np.ndarray, p0: np.ndarray):
        # All ordered pairs of entries of one row: each entry as often as its row has entries, and these in turn.
        own = np.repeat(np.arange(len(p)), np.repeat(size, size))
        row = np.repeat(np.arange(len(size)), size * size)
        start = np.repeat(np.cumsum(size * size) - size * size, size * size)
        other = first[row] + (np.arange(len(own)) - start) % size[row]
        keep = own != other
        own, other, row = own[keep], other[keep], row[keep]

        def f(a, b):
            return (a - b) ** 2 // b

        value = f(p[own], p[other]) - f(p[own], p0[other]) - f(p0[own], p[other]) + f(p0[own], p0[other])
        n_names, key = names.max() + 1 if len(names) else 1, langs[row]
        key = (key * n_names + names[own]) * n_names + names[other]
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        for k, v in zip(key[at].tolist(), np.add.reduceat(value, at).tolist() if len(at) else []):
            sums[k // (n_names * n_names), k // n_names % n_names, k % n_names] += v

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, found = batch.column(0).dictionary_encode(), batch.column(1)
            entries = found.flatten()
            source = entries.field("source").dictionary_encode()
            langs = np.asarray(lang.indices, np.int64)
            names, p, p0 = (np.asarray(x, np.int64) for x in (source.indices, entries.field("p"), entries.field("p0")))
            size = np.asarray(found.value_lengths(), np.int64)
            first = np.cumsum(size) - size
            sums: Counter = Counter()
            work = np.cumsum(size * size)
            at = 0
            while at < len(size):
                done = work[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(work, done + PAIRS, side="right")))
                a, b = first[at], first[to - 1] + size[to - 1]
                add(sums, langs[at:to], names[a:b], size[at:to], first[at:to] - a, p[a:b], p0[a:b])
                at = to
            if sums:
                l, s, i = (np.array(x) for x in zip(*sums))
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(l)), source.dictionary.take(pa.array(s)), source.dictionary.take(pa.array(i)),
                     pa.array(list(sums.values()), pa.int64())],
                    ["lang", "source", "item", "value"],
                )

    return rows.mapInArrow(pairs, kind).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """How far each source's terms are from those of other sources, and which terms it has more of than its language.

    Rows: lang, source, part, item, value, rank. Part ``pair`` has each other source of the language as item, with the sum of
    floor((p - q)^2 / q) over the language's kept terms; part ``term`` has the terms whose share in the source is above that in the
    language, the ``ranks`` with the largest value. Ties go by the item's UTF-8 bytes. Null text, lang and source count as empty; a
    group without terms still has its pairs, which are 0 if the language keeps no term. Repeated rows are documents of their own. An
    empty table gives no rows. Other columns are not read.
    """
    kept, groups = term_table(docs)
    held = kept.select("lang", "term", F.inline("found"))
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    none = F.lit(0).cast("long")
    sizes = (
        groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, none).alias(c) for c in ("total", "terms", "lang_total")))
        .withColumn("p0", F.when(F.col("terms") > 0, share(none, F.col("total"), F.greatest("terms", F.lit(1)))))
    )
    sizes = cut_lineage(sizes)
    shared = held.join(sizes, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))

    # Part term.
    whole = kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("found").alias("own"))
    whole = whole.select("lang", "term", "lang_n", "own.source", "own.n").join(sizes, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    over = whole.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    over = over.select("lang", "source", F.lit("term").alias("part"), "item", excess(F.col("p"), F.col("q")).alias("value"))

    # Part pair: a source's histogram of shares with the share of a lacking term in each other source, both ways.
    bars = shared.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("times"))
    others = sizes.select("lang", F.col("source").alias("other"), F.col("p0").alias("other_p0"))
    met = bars.join(others, "lang").where(F.col("source") != F.col("other"))
    zero, own, other = F.col("p0"), F.col("p"), F.col("other_p0")
    ahead = met.select(
        "lang", "source", F.col("other").alias("item"), (F.col("times") * (excess(own, other) - excess(zero, other))).alias("value")
    )
    behind = met.select(
        "lang", F.col("other").alias("source"), F.col("source").alias("item"),
        (F.col("times") * (excess(other, own) - excess(other, zero))).alias("value"),
    )
    left = sizes.select("lang", "source", "p0", "terms")
    both = left.join(others, "lang").where(F.col("source") != F.col("other"))
    neither = both.select(
        "lang", "source", F.col("other").alias("item"),
        F.when(F.col("terms") > 0, F.col("terms") * excess(zero, other)).otherwise(none).alias("value"),
    )
    entry = F.struct("source", "p", "p0")
    vectors = shared.groupBy("lang", "term").agg(F.collect_list(entry).alias("found")).where(F.size("found") > 1).select("lang", "found")
    parts = neither.unionByName(ahead).unionByName(behind).unionByName(_shared_terms(vectors))
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(over).where(F.col("rank") <= ranks))


@query(
    "op11_source_divergence",
    r"""
    WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                      coalesce(source, '') AS source FROM documents),
         t AS (SELECT id, lang, source, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
         kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 3),
         langs AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM kept GROUP BY lang),
         groups AS (SELECT DISTINCT lang, source FROM d),
         c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
         sums AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
         shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.total, 0) + l.terms)::HUGEINT AS p,
                           1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.terms)::HUGEINT AS q
                    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
                    LEFT JOIN sums s USING (lang, source) LEFT JOIN c USING (lang, source, term)),
         pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
                   FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
         parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
                   FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
                   LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
                   UNION ALL
                   SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
)
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(table(spark, folder, "documents"))
