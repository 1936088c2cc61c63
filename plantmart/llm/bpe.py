"""Byte-pair encoding and decoding with a lexicon of frequent words.

Words that are frequent in the corpus are compiled with their ids into a minimal acyclic transducer (``lexicon``); all other words
go through the merges, exactly. Frequent means a share of all words of at least ``MIN_SHARE``, so the lexicon has at most
``1 / MIN_SHARE`` words at any corpus size, which bounds what is sent to the executors.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .lexicon import Lexicon, build
from .merges import Merger, byte_characters
from .packing import tokenizer_text
from .registry import query, table

MIN_SHARE = 4e-6
CACHED_WORDS = 300_000
COUNTED_WORDS = 500_000  # distinct words that are counted together before they are handed on
# Fixed value: how this tokenizer cuts text into words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Codec:
    """A byte-level tokenizer: cutting, looking up, merging, and the way back."""

    def __init__(self, tokenizer_json: str, lexicon: bytes | None = None):
        parsed = json.loads(tokenizer_json)
        vocabulary = parsed["model"]["vocab"]
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.merger = Merger(vocabulary, parsed["model"]["merges"])
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.token_bytes = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, number in vocabulary.items():
            self.token_bytes[number] = bytes(byte_of[c] for c in token)
        for content, number in self.special.items():
            self.token_bytes[number] = content.encode()
        self.cut = regex.compile(PATTERN)
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.decimal = [str(i) for i in range(len(self.token_bytes))]
        self.lexicon = Lexicon.mapped(lexicon) if lexicon else None
        self.cache: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not text.isascii() and any(c > "\u0557" and unicodedata.category(c) == "Cn" for c in set(text)):
            # Characters that are newer than the tokenizer's own tables: the tokenizer's cutter knows how it sees them.
            from tokenizers import pre_tokenizers

            cutter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
            return [text[a:b] for _, (a, b) in cutter.pre_tokenize_str(text)]
        return self.cut.findall(text)

    def parts(self, text: str) -> list[str]:
        """Words and special tokens of a text in order."""
        if any(s in text for s in self.special):
            found: list[str] = []
            for part in self.cut_special.split(text):
                found += [part] if part in self.special else self.words(part)
            return found
        return self.words(text)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of words by the merges alone, as little-endian 32-bit numbers."""
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        starts = ends - np.array([len(w) for w in words], np.int64)
        flat, offsets = self.merger.merge(np.frombuffer(b"".join(words), np.uint8), starts, ends)
        raw, at = flat.astype("<u4").tobytes(), (4 * offsets).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def learn(self, words: Iterable[str]) -> None:
        """Make sure that the ids of all ``words`` are at hand: from the lexicon, else by the merges."""
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        new = [w for w in words if w not in self.cache and w not in self.special]
        raw = [w.encode() for w in new]
        found = self.lexicon.ids(raw) if self.lexicon and new else [None] * len(new)
        unseen = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(unseen, self.merge([raw[i] for i in unseen])):
            self.cache[new[i]] = ids
        for word, ids in zip(new, found):
            if ids is not None:
                self.cache[word] = ids
        for content, number in self.special.items():
            self.cache[content] = np.array([number], "<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        parts = [self.parts(t) for t in texts]
        self.learn(set().union(*parts))
        cache = self.cache
        return [np.frombuffer(b"".join([cache[w] for w in p]), "<u4") for p in parts]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        token = self.token_bytes
        return b"".join([token[i] for i in ids]).decode("utf-8", "replace")


_codecs: dict[tuple, Codec] = {}


def codec_of(tokenizer, lexicon=None) -> Codec:
    """The codec of this worker for broadcast files; made once and kept for later tasks."""
    held = lexicon.value if lexicon is not None else b""
    key = (zlib.crc32(tokenizer.value.encode()), zlib.crc32(held), len(held))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(tokenizer.value, held or None)
    return _codecs[key]


def runs(batch: pa.RecordBatch, column: int, size: int = 2 << 20) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of runs of about ``size`` characters; null counts as empty."""
    at, run, held = 0, [], 0
    for i, text in enumerate(batch.column(column)):
        value = text.as_py() or ""
        if run and held + len(value) > size:
            yield at, run
            at, run, held = i, [], 0
        run.append(value)
        held += len(value)
    if run:
        yield at, run


def frequent_words(docs: DataFrame, tokenizer, text_column: str, min_share: float = MIN_SHARE) -> list[str]:
    """Words with at least ``min_share`` of all words of all texts: at most ``1 / min_share`` of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(tokenizer)
        seen: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
            )
            seen.clear()
            return batch

        for batch in batches:
            for _, texts in runs(batch, 0):
                for text in texts:
                    seen.update(codec.parts(text))
                if len(seen) > COUNTED_WORDS:
                    yield flush()
        if seen:
            yield flush()

    counts = docs.select(text_column).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where(F.col("n") >= max(2.0, total * min_share)).select("word").toArrow()
    return sorted(often.column("word").to_pylist())


def lexicon_of(docs: DataFrame, tokenizer_json: str, text_column: str = "text", min_share: float = MIN_SHARE) -> bytes:
    """The transducer of the corpus' frequent words."""
    tokenizer = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    codec = Codec(tokenizer_json)
    words = [w.encode() for w in frequent_words(docs, tokenizer, text_column, min_share) if w not in codec.special]
    words.sort()
    return build((w, tuple(np.frombuffer(ids, "<u4").tolist())) for w, ids in zip(words, codec.merge(words)))


def encode(docs: DataFrame, tokenizer_json: str, lexicon: bytes, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per row of ``docs``: its id and ``ids``. A null or empty text has no ids."""
    sc = docs.sparkSession.sparkContext
    tokenizer, words = sc.broadcast(tokenizer_json), sc.broadcast(lexicon)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(tokenizer, words)
        for batch in batches:
            for at, texts in runs(batch, 1):
                found = [pa.array(i.astype(np.int32)) for i in codec.encode_all(texts)]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in found])])
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(found))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], [id_column, "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(read, f"`{id_column}` {kind}, ids array<int>")


def decode(rows: DataFrame, tokenizer_json: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """A row per row of ``rows``: its id and the ``text`` of its ids; null ids give an empty text."""
    tokenizer = rows.sparkSession.sparkContext.broadcast(tokenizer_json)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(tokenizer)
        for batch in batches:
            texts = [codec.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_column, "text"])

    kind = rows.schema[id_column].dataType.simpleString()
    return rows.select(id_column, ids_column).mapInArrow(read, f"`{id_column}` {kind}, text string")


def digests(docs: DataFrame, tokenizer_json: str, lexicon: bytes, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, ``n_tokens``, SHA-256 of the decimal ids, SHA-256 of the text decoded from them.

    A null or empty text has no ids and the digests of nothing. Repeated rows give repeated results; an empty table gives none.
    """
    sc = docs.sparkSession.sparkContext
    tokenizer, words = sc.broadcast(tokenizer_json), sc.broadcast(lexicon)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(tokenizer, words)
        decimal = codec.decimal
        for batch in batches:
            for at, texts in runs(batch, 1):
                n, one, two = [], [], []
                for ids in codec.encode_all(texts):
                    numbers = ids.tolist()
                    n.append(len(numbers))
                    one.append(hashlib.sha256(",".join([decimal[i] for i in numbers]).encode()).hexdigest())
                    two.append(hashlib.sha256(codec.decode(numbers).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(one), pa.array(two)],
                    [id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        read, f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


@query("op5_byte_pair_encoding")
def op5_byte_pair_encoding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tokenizer = tokenizer_text("byte_bpe_50k.json")
    return digests(docs, tokenizer, lexicon_of(docs, tokenizer))
