"""Packing: documents become sequences of at most ``CAPACITY`` tokens with little padding.

A document is cut into full sequences and one rest. The histogram of piece lengths (at most ``CAPACITY`` rows) is packed on
the driver, longest length first, always into the shortest open pack; packs are kept as patterns with counts, so the work does
not depend on the number of documents. Pieces of one length are numbered by two-level counting, and the number tells the pack.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import cut_lineage
from .merges import IdTable, Merger, spread
from .registry import query, table
from .words import LOWER, SYMBOL, Words, slices, words_of

CAPACITY = 2048
END_ID = 1
ROWS_PER_BUCKET = 20_000

PIECES = "doc_tokens long, pieces array<struct<start: long, length: long, ids_crc32: long>>"
_encoders: dict[int, WordIds] = {}

# What ``WordIds`` cuts itself, as classes of bytes: printable ASCII but the apostrophe and the less-than sign, and the
# letters that are a byte 0xC3 and another one.
LETTER, DIGIT, OTHER, REST = 0, 1, 2, 3
BYTE_CLASS = np.full(256, REST, np.uint8)
BYTE_CLASS[0x21:0x7F] = OTHER
BYTE_CLASS[[ord("'"), ord("<")]] = REST
BYTE_CLASS[0x30:0x3A] = DIGIT
BYTE_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
AFTER_C3 = np.zeros(256, bool)
AFTER_C3[0x80:0xC0] = True
AFTER_C3[[0x97, 0xB7]] = False  # the multiplication and division signs


class WordIds:
    """Ids of texts, as the tokenizer gives them.

    White space separates tokens in this tokenizer, so a text's ids are the ids of its words (between ASCII spaces) in order. Each
    distinct word is looked up once. Plain words, of ASCII and Western European letters, are cut and merged here, many at a time; all others
    go to the tokenizer itself.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        model = json.loads(tokenizer_json)["model"]
        self.merger = Merger(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.table = IdTable()

    def _merge_plain(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words: runs of letters, single digits and runs of other signs are merged one by one, in lower case."""
        size = end - start
        at = spread(start, size)
        raw = LOWER[data[at]]
        word = np.repeat(np.arange(len(size)), size)
        after = np.zeros(len(raw), bool)
        after[1:] = raw[:-1] == 0xC3
        raw[after & (raw >= 0x80) & (raw < 0x9F)] += 0x20
        kind = BYTE_CLASS[raw]
        kind[raw >= 0x80] = LETTER
        cut = np.ones(len(raw), bool)
        cut[1:] = (word[1:] != word[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(raw))
        flat, offsets = self.merger.merge(raw, first, last)
        n = np.bincount(word[first], weights=np.diff(offsets), minlength=len(size)).astype(np.int64)
        return flat, np.concatenate([[0], np.cumsum(n)])

    def _numbers(self, words: Words) -> np.ndarray:
        """Place of each word in the table; new words are put there first."""
        hashes, firsts, kind = np.unique(words.hash, return_index=True, return_inverse=True)
        number = self.table.find(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            start, end = words.start[firsts[new]], words.end[firsts[new]]
            byte = words.data
            good = BYTE_CLASS[byte] != REST
            lead = np.flatnonzero(byte[:-1] == 0xC3)
            lead = lead[AFTER_C3[byte[lead + 1]]]
            good[lead] = good[lead + 1] = True
            bad = np.concatenate([[0], np.cumsum(~good)])
            plain = bad[end] == bad[start]
            some = new[plain]
            number[some] = self.table.add(hashes[some], *self._merge_plain(byte, start[plain], end[plain]))
            some = new[~plain]
            texts = [byte[a:b].tobytes().decode() for a, b in zip(start[~plain], end[~plain])]
            found = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)])
            number[some] = self.table.add(hashes[some], np.concatenate([np.zeros(0, np.int32), *found]), offsets)
        return number[kind]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, and the offsets of the texts in them."""
        words = words_of(data, offsets, SYMBOL)
        flat, n = self.table.ids(self._numbers(words))
        total = np.bincount(words.text, weights=n, minlength=words.n).astype(np.int64)
        return flat, np.concatenate([[0], np.cumsum(total)])


def piece_bounds(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids: full ones, then the rest."""
    return [(at, min(capacity, n - at)) for at in range(0, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer_json: str, id_column: str, text_column: str, capacity: int, end_id: int):
    """A row per piece: id, start, length, ids_crc32, doc_tokens. A document without text has its end id only."""
    tokenizer = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    end = np.array([end_id], "<u4").tobytes()
    size = zlib.crc32(tokenizer_json.encode())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if size not in _encoders:  # kept for later tasks of this worker
            _encoders[size] = WordIds(tokenizer.value)
        for batch in batches:
            for at, to, data, offsets in slices(batch.column(1), 2 << 20):
                flat, bounds = _encoders[size].encode(data, offsets)
                raw = flat.astype("<u4").tobytes()
                totals, counts, starts, lengths, sums = [], [], [], [], []
                for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                    ids = raw[4 * a : 4 * b] + end
                    pieces = piece_bounds(b - a + 1, capacity)
                    totals.append(b - a + 1)
                    counts.append(len(pieces))
                    starts += [s for s, _ in pieces]
                    lengths += [n for _, n in pieces]
                    sums += [zlib.crc32(ids[4 * s : 4 * (s + n)]) for s, n in pieces]
                held = pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in (starts, lengths, sums)], ["start", "length", "ids_crc32"]
                )
                where = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array(totals, pa.int64()), pa.ListArray.from_arrays(where, held)],
                    ["id", "doc_tokens", "pieces"],
                )
        _encoders[size].table.clear()  # the worker may go on with other work

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = rows.mapInArrow(encode, f"id {rows.schema['id'].dataType.simpleString()}, {PIECES}")
    return found.select("id", "doc_tokens", F.inline("pieces"))


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Shortest-pack-first over a histogram of lengths.

    Returns runs (length, first rank, number of ranks, first sequence, offset): the pieces of a length with these ranks lie at
    ``offset`` in consecutive sequences. Every rank of every length is in exactly one run.
    """
    open_packs: list[tuple[int, int, int, tuple]] = []  # (-room, order, packs with this pattern, pattern)
    order, done = 0, []
    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left, grown = counts[length], []
        per_pack = 1
        while left:
            if open_packs and -open_packs[0][0] >= length:
                room, _, packs, pattern = heapq.heappop(open_packs)
                room = -room
            else:
                # No open pack has room: new packs, as many pieces of this length in each as fit.
                room, pattern, packs = capacity, (), -(-left // (capacity // length))
            per_pack = max(1, min(room // length, -(-left // packs)))
            full, rest = min(packs, left // per_pack), left % per_pack if packs > left // per_pack else 0
            for used, each in ((full, per_pack), (1 if rest else 0, rest)):
                if used:
                    grown.append((room - each * length, used, (*pattern, *([length] * each))))
                    left -= used * each
                    packs -= used
            if packs and pattern:
                grown.append((room, packs, pattern))
        for room, packs, pattern in grown:
            if room:
                heapq.heappush(open_packs, (-room, order, packs, pattern))
                order += 1
            else:
                done.append((packs, pattern))
    done += [(packs, pattern) for _, _, packs, pattern in sorted(open_packs)]
    runs, ranks, sequence = [], dict.fromkeys(counts, 0), 0
    for packs, pattern in done:
        offset = 0
        for length in pattern:
            runs.append((length, ranks[length], packs, sequence, offset))
            ranks[length] += packs
            offset += length
        sequence += packs
    return runs


def numbered(pieces: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``pieces`` with ``rank``, from 0 without gaps among the pieces of a length.

    Pieces are numbered inside (length, bucket of the id); the buckets' sizes give each bucket its first number. Buckets
    grow in number with the table, so no length is gathered in one task.
    """
    buckets = max(1, -(-pieces.count() // rows_per_bucket))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "start"), F.lit(buckets)))
    sizes = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("id", "start", "doc_tokens", "ids_crc32")
    ranked = pieces.withColumn("at", F.row_number().over(inside) - 1)
    return ranked.join(first, ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("at")).drop("bucket", "at", "first")


def pack(
    docs: DataFrame,
    tokenizer_json: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is a document of one id, the end. Rows without id and repeated rows are documents of their own. An
    empty table gives no rows. Other columns are not read.
    """
    pieces = cut_lineage(token_pieces(docs, tokenizer_json, id_column, text_column, capacity, end_id))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = sorted(pack_histogram(histogram, capacity))
    # A run is found by one number made of length and rank; ranks stay below 2**48.
    at = np.array([(length << 48) + rank for length, rank, *_ in runs], np.int64)
    first = np.array([r[3] for r in runs], np.int64)
    offset = np.array([r[4] for r in runs], np.int64)

    @pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key = (length.to_numpy(np.int64) << 48) + rank.to_numpy(np.int64)
        run = np.searchsorted(at, key, side="right") - 1
        return pd.DataFrame({"sequence_id": first[run] + key - at[run], "offset": offset[run]})

    return (
        numbered(pieces)
        .withColumn("place", place("length", "rank"))
        .select(F.col("id").alias(id_column), "start", "length", "ids_crc32", "doc_tokens", "place.sequence_id", "place.offset")
    )


def tokenizer_text(name: str) -> str:
    """The text of a public tokenizer's file, read on the driver and sent to the executors from there."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query("op8_packing")
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_text("word_bpe_49k.json"))
