"""Language model scoring with a weighted backoff automaton.

States are contexts (n-grams shorter than ``ORDER``), an arc carries a word's discounted log-probability, and a failure arc leads to the
next shorter context and carries the backoff weight. All words have arcs from the empty context, and every n-gram that occurs ``LEAST``
times has one, at any corpus size. A text is read once from left to right, carrying the state (``walk``).

Texts are held in blocks, each with its own numbered words. A block asks for the distinct n-grams that it holds, one sorted list of hashes
for each bucket of hashes; the buckets add the training counts up and answer with the totals in the same order. So an n-gram that many
texts share is sent once by each block, rare ones cost six bytes, and no task holds more than a block or a bucket. What the failure arcs
need are whole numbers: how many arcs leave a context, the sum of their counts, and the sum of the counts of the same n-grams without
their first words. One of the blocks that hold an arc is its owner and adds it to its context, so each arc is counted once; the contexts
are added up and answered like the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .registry import query, table
from .words import U, Words, id_remainder, mix, word_slices

ORDER = 3
LEAST = 2  # occurrences that give an n-gram of two words or more an arc
MIN_SHARE = 4e-6
DISCOUNT = 0.75
BLOCK = 1 << 20  # tokens of a block of texts
BUCKET_BYTES = 4 << 20  # text for each bucket of hashes
LANE = 512  # tokens of a text that are read one after another; lanes of a block are read together
BITS = 56  # of a hash
END = mix(np.array([0xE0F], np.uint64))[0]  # the hash of the end token; words are hashed from their bytes


def with_ends(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words, then an end for each text) and the offsets of the texts in them."""
    first = words.first
    offsets = first + np.arange(words.n + 1)
    tokens = np.full(offsets[-1], END, np.uint64)
    tokens[np.arange(len(words.hash)) + words.text] = words.hash
    return tokens, offsets


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of an n-gram by those of its first and its last n - 1 words."""
    return mix(mix(left * U(3)) + right) >> U(64 - BITS)


def planes(x: np.ndarray) -> bytes:
    """An array of whole numbers from 0, compressed: width of a number, length, then the first bytes of all numbers, the second ones, and
    so on, which leaves small numbers little to store."""
    width = next(w for w in (1, 2, 4, 8) if int(x.max(initial=0)) < 1 << 8 * w)
    flat = x.astype(f"<u{width}").view(np.uint8).reshape(len(x), width).T.tobytes()
    return bytes([width]) + len(x).to_bytes(8, "little") + (pa.compress(flat, "zstd", asbytes=True) if flat else b"")


def length(data: bytes) -> int:
    return int.from_bytes(data[1:9], "little")


def from_planes(data: bytes, kind=np.int64) -> np.ndarray:
    width, n = data[0], length(data)
    if not n:
        return np.zeros(0, kind)
    flat = np.frombuffer(pa.decompress(memoryview(data)[9:], n * width, "zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(width, n).T).view(f"<u{width}").reshape(n).astype(kind)


def rising(x: np.ndarray) -> bytes:
    """A sorted array of hashes, by differences."""
    return planes(np.diff(x, prepend=U(0)))


def from_rising(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, U), dtype=U)


def bounds(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets begin and end in sorted hashes; a bucket is a range of hashes."""
    return np.searchsorted(hashes, np.array([-(-(k << BITS) // buckets) for k in range(buckets + 1)], np.uint64))


BLOCKS = "block long, vocabulary binary, codes binary, sizes binary, trained binary"


def blocks_of(docs: DataFrame, id_column: str, text_column: str, train: Column) -> DataFrame:
    """Texts in blocks: block (its number), vocabulary (hashes, frequent words first), codes of the tokens, sizes of the texts in tokens,
    trained (whether a text is a training text), ids."""
    kind = docs.schema[id_column].dataType.simpleString()

    def pack(held: list[tuple]) -> pa.RecordBatch:
        tokens, sizes, trained, ids, rows = zip(*held)
        hashes, code, n = np.unique(np.concatenate(tokens) >> U(64 - BITS), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        ids = pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in ids])
        data = [
            planes(hashes[order]), planes(place[code]), planes(np.concatenate(sizes)),
            planes(np.concatenate(trained)),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[0]], pa.int64()), *(pa.array([x], pa.binary()) for x in data), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)],
            ["block", "vocabulary", "codes", "sizes", "trained", "ids"],
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            trained = np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool)
            for at, to, words in word_slices(batch.column(1)):
                tokens, offsets = with_ends(words)
                held.append((tokens, np.diff(offsets), trained[at:to], batch.column(0).slice(at, to - at), batch.column(3)[at].as_py()))
                size += len(tokens)
                if size >= BLOCK:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)

    # The number of a block is that of its first row.
    rows = docs.select(id_column, text_column, F.coalesce(train, F.lit(False)), F.monotonically_increasing_id())
    return cut_lineage(rows.mapInArrow(read, f"{BLOCKS}, ids array<{kind}>"))


@dataclass
class Level:
    """Distinct n-grams of one size in a block: hash, first and last n - 1 words (numbers in the level below), occurrences in training
    texts; and for each token the n-gram that begins there, or -1."""

    hash: np.ndarray
    left: np.ndarray
    right: np.ndarray
    n: np.ndarray
    at: np.ndarray


class Block:
    """The n-grams of a block, and the order in which it asks for them."""

    def __init__(self, row: dict, order: int) -> None:
        self.number = row["block"]
        self.sizes = from_planes(row["sizes"])
        codes = from_planes(row["codes"])
        vocabulary = from_planes(row["vocabulary"], U)
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        trained = (from_planes(row["trained"]) > 0)[text]
        none = np.zeros(0, np.int64)
        self.levels = [Level(vocabulary, none, none, np.bincount(codes[trained], minlength=len(vocabulary)), codes)]
        for size in range(2, order + 1):
            below = self.levels[-1]
            inside = np.flatnonzero(text[: max(len(text) - size + 1, 0)] == text[size - 1 :])
            key = below.at[inside].astype(np.int64) * len(vocabulary) + codes[inside + size - 1]
            _, first, place = np.unique(key, return_index=True, return_inverse=True)
            left, right = below.at[inside[first]], below.at[inside[first] + 1]
            at = np.full(len(text), -1, np.int32)
            at[inside] = place
            n = np.bincount(place[trained[inside]], minlength=len(first))
            self.levels.append(Level(_pair(below.hash[left], below.hash[right]), left, right, n, at))
        self.word_order = np.argsort(vocabulary)
        grams = np.concatenate([x.hash for x in self.levels[1:]]) if order > 1 else np.zeros(0, U)
        self.gram_order = np.argsort(grams)
        self.words, self.grams = vocabulary[self.word_order], grams[self.gram_order]

    def asked(self, buckets: int) -> Iterator[dict]:
        """A row for each bucket: words and longer n-grams, with their counts in the block's training texts."""
        word_n, gram_n = self.levels[0].n[self.word_order], self._joined([x.n for x in self.levels[1:]])
        w, g = bounds(self.words, buckets), bounds(self.grams, buckets)
        for k in np.flatnonzero(np.diff(w) + np.diff(g)).tolist():
            one, two = slice(w[k], w[k + 1]), slice(g[k], g[k + 1])
            yield {
                "bucket": k, "block": self.number, "words": rising(self.words[one]), "grams": rising(self.grams[two]),
                "word_n": planes(word_n[one]), "gram_n": planes(gram_n[two]),
            }

    def _joined(self, parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(parts)[self.gram_order] if parts else np.zeros(0, np.int64)

    def answered(self, words: np.ndarray, grams: np.ndarray) -> list[np.ndarray]:
        """Answers by level from answers in the order asked."""
        out = [np.empty(len(words), words.dtype)]
        out[0][self.word_order] = words
        flat = np.empty(len(grams), grams.dtype)
        flat[self.gram_order] = grams
        ends = np.cumsum([len(x.hash) for x in self.levels[1:]])
        return out + (np.split(flat, ends[:-1]) if len(ends) else [])

    def contexts(self, n: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """N-grams of the block that can be contexts, given the totals: sorted hashes, and for each level the places of its n-grams there
        (-1 for others)."""
        known = [np.flatnonzero(n[k] >= LEAST) for k in range(len(self.levels) - 1)]
        hashes = np.concatenate([np.zeros(0, U), *(self.levels[k].hash[some] for k, some in enumerate(known))])
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        places, at = [], 0
        for k, some in enumerate(known):
            place = np.full(len(n[k]), -1)
            place[some] = rank[at : at + len(some)]
            places.append(place)
            at += len(some)
        return hashes[order], places


FIGURES = ["arcs", "arc_n", "shorter_n"]
PARTS = ["words", "word_n", "grams", "gram_n", "owner", "contexts", *FIGURES]
MESSAGE = "bucket int, block long, tokens long, distinct_words long, " + ", ".join(f"{c} binary" for c in PARTS)
SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64()), ("tokens", pa.int64()), ("distinct_words", pa.int64()), *((c, pa.binary()) for c in PARTS)]
)


def _message(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, SCHEMA)


def _requests(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from _message(list(Block(batch.slice(k, 1).to_pylist()[0], order).asked(buckets))).to_batches()

    return blocks.select("block", "vocabulary", "codes", "sizes", "trained").mapInArrow(ask, MESSAGE)


def _added(hashes: list[np.ndarray], values: list[list[np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sums of each list of values by hash, the place of each entry in them, and whether it is the first of its hash that has a value."""
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes, kind="stable")
    fresh = np.r_[True, hashes[order][1:] != hashes[order][:-1]][: len(hashes)]
    start = np.flatnonzero(fresh)
    flat = [np.concatenate(v) for v in values]
    sums = [np.add.reduceat(v[order], start) if len(start) else v for v in flat]
    place, owner = np.empty(len(hashes), np.int64), np.zeros(len(hashes), bool)
    place[order] = np.cumsum(fresh) - 1
    holds = np.flatnonzero(flat[0][order] > 0)
    _, first = np.unique(place[order][holds], return_index=True)
    owner[order[holds[first]]] = True
    return sums, place, owner


def _totals(rows: pa.Table) -> pa.Table:
    """Answers for blocks, and a row without block with the number of training tokens and of distinct ones."""
    held = rows.to_pylist()
    answers = [{"bucket": r["bucket"], "block": r["block"]} for r in held]
    whole = {"bucket": held[0]["bucket"]}
    for name, n_name, least in (("words", "word_n", 1), ("grams", "gram_n", LEAST)):
        parts = [from_rising(r[name]) for r in held]
        (n,), place, owner = _added(parts, [[from_planes(r[n_name]) for r in held]])
        if name == "words":
            whole |= {"tokens": int(n.sum()), "distinct_words": int((n > 0).sum())}
        n[n < least] = 0
        ends = np.cumsum([len(x) for x in parts])[:-1]
        for answer, at, own in zip(answers, np.split(place, ends), np.split(owner, ends)):
            answer |= {n_name: planes(n[at])} | ({"owner": planes(own)} if name == "grams" else {})
    return _message([*answers, whole])


def _answers(rows: list[dict], names: list[str]) -> list[np.ndarray]:
    """A block's answers of all buckets, one after another."""
    rows = sorted((r for r in rows if r[names[0]] is not None), key=lambda r: r["bucket"])
    return [np.concatenate([np.zeros(0, np.int64), *(from_planes(r[c]) for r in rows)]) for c in names]


def _contexts(order: int, buckets: int):
    """A block's contexts by bucket, with what the arcs that the block owns add to them."""

    def add(block: pa.Table, answers: pa.Table) -> pa.Table:
        own = Block(block.to_pylist()[0], order)
        word_n, gram_n, owner = _answers(answers.to_pylist(), ["word_n", "gram_n", "owner"])
        n, owner = own.answered(word_n, gram_n), own.answered(np.zeros(len(word_n), np.int64), owner)
        hashes, places = own.contexts(n)
        sums = [np.zeros(len(hashes), np.int64) for _ in FIGURES]
        for size in range(1, order):
            level = own.levels[size]
            arcs = np.flatnonzero((owner[size] > 0) & (n[size] > 0))
            context = places[size - 1][level.left[arcs]]
            for k, weight in enumerate((np.ones(len(arcs)), n[size][arcs], n[size - 1][level.right[arcs]])):
                sums[k] += np.bincount(context, weight, len(hashes)).astype(np.int64)
        cut, rows = bounds(hashes, buckets), []
        for k in np.flatnonzero(np.diff(cut)).tolist():
            some = slice(cut[k], cut[k + 1])
            rows.append({"bucket": k, "block": own.number, "contexts": rising(hashes[some])} | {c: planes(v[some]) for c, v in zip(FIGURES, sums)})
        return _message(rows)

    return add


def _context_totals(rows: pa.Table) -> pa.Table:
    held = rows.to_pylist()
    parts = [from_rising(r["contexts"]) for r in held]
    sums, place, _ = _added(parts, [[from_planes(r[c]) for r in held] for c in FIGURES])
    ends = np.cumsum([len(x) for x in parts])[:-1]
    at = np.split(place, ends)
    return _message([{"bucket": r["bucket"], "block": r["block"]} | {c: planes(v[x]) for c, v in zip(FIGURES, sums)} for r, x in zip(held, at)])


@dataclass
class Model:
    """The training texts in blocks, for n-grams of up to ``order`` words, and the size of the texts in bytes."""

    order: int
    size: int


@dataclass
class Sizes:
    """Of the training texts: tokens and distinct tokens."""

    total: int
    distinct: int

    @property
    def unseen(self) -> tuple[float, float]:
        """Weights of a word that the training texts do not have, in the model and in its base."""
        if not self.total:
            return 0.0, 0.0
        return float(np.log10(DISCOUNT * self.distinct / self.total)), float(-np.log10(self.total + self.distinct + 1.0))


def _bytes(docs: DataFrame, text_column: str) -> int:
    return docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0


def learn(train: DataFrame, order: int = ORDER, min_share: float = MIN_SHARE, text_column: str = "text") -> tuple[Model, DataFrame]:
    """What a model is made of: its size, and its training texts in blocks, whose n-grams are counted when texts are scored.

    ``min_share`` is without effect: frequent and rare n-grams are treated alike.
    """
    numbered = train.select(F.lit(0).alias("id"), F.col(text_column).alias("text"))
    return Model(order, _bytes(numbered, "text")), blocks_of(numbered, "id", "text", F.lit(True))


def walk(block: Block, n: list[np.ndarray], arcs: list[np.ndarray], fails: list[np.ndarray]) -> np.ndarray:
    """The sum of weights on each text's way through the automaton.

    The state is the longest context known, here its size; ``arcs`` and ``fails`` are the weights of n-grams and contexts by size.
    From a state without arc for the next word the failure arc leads to the next shorter state. All texts are read together, long ones
    in lanes: the state depends on the last words only, so a lane begins as many words early and does not count them.
    """
    order = len(block.levels)
    early = order - 1
    lanes = -(-block.sizes // LANE)
    text = np.repeat(np.arange(len(lanes)), lanes)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    begin = (np.cumsum(block.sizes) - block.sizes)[text]
    first, last = nth * LANE, np.minimum((nth + 1) * LANE, block.sizes[text])
    start = np.maximum(first - early, 0)
    length = last - start
    by_length = np.argsort(-length, kind="stable")
    begin, first, start, length, text = (x[by_length] for x in (begin, first, start, length, text))
    state, sums = np.zeros(len(text), np.int64), np.zeros(len(text))
    live = np.searchsorted(-length, -np.arange(length.max(initial=0)), side="left")
    for step, count in enumerate(live.tolist()):
        at = (begin + start)[:count] + step
        left, weight, after = state[:count].copy(), np.zeros(count), np.zeros(count, np.int64)
        for size in range(order - 1, 0, -1):
            who = np.flatnonzero(left == size)
            if not len(who):
                continue
            gram = block.levels[size].at[at[who] - size]
            arc = n[size][gram] > 0
            there, gone = who[arc], who[~arc]
            weight[there] += arcs[size][gram[arc]]
            after[there] = min(size + 1, order - 1)
            left[there] = -1
            weight[gone] += fails[size - 1][block.levels[size - 1].at[at[gone] - size]]
            left[gone] = size - 1
        who = np.flatnonzero(left == 0)
        word = block.levels[0].at[at[who]]
        weight[who] += arcs[0][word]
        after[who] = (n[0][word] >= LEAST) & (order > 1)
        sums[:count] += np.where(start[:count] + step >= first[:count], weight, 0.0)
        state[:count] = after
    return np.bincount(text, sums, len(block.sizes))


def _scores(sizes: Sizes, order: int, kind: str, id_column: str):
    out = f"{id_column} {kind}, n_tokens long, n_known long, base_score double, score double"

    def read(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:  # answers for training texts that are not scored
            empty = pa.array([], rows.schema.field("ids").type.value_type)
            return pa.table([empty, *(pa.array([], x) for x in (pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
                            [id_column, "n_tokens", "n_known", "base_score", "score"])
        block, held = Block(rows.to_pylist()[0], order), answers.to_pylist()
        n = block.answered(*_answers(held, ["word_n", "gram_n"]))
        _, places = block.contexts(n)
        figures = [np.append(x, 0) for x in _answers(held, FIGURES)]  # place -1 has none
        total, d = max(sizes.total, 1), DISCOUNT
        with np.errstate(divide="ignore", invalid="ignore"):
            arcs = [np.where(n[0] > 0, np.log10((n[0] - d) / total), sizes.unseen[0])]
            base = np.log10((n[0] + 1) / (sizes.total + sizes.distinct + 1.0))
            fails = []
            for size in range(1, order):
                arcs.append(np.log10((n[size] - d) / n[size - 1][block.levels[size].left]))
                # Probability that the context's arcs leave over, and that the same words have in the next shorter context.
                count, own, shorter = (x[places[size - 1]] for x in figures)
                whole = total if size == 1 else n[size - 2][block.levels[size - 1].right]
                free = np.maximum(1 - (own - d * count) / n[size - 1], 1e-12) / np.maximum(1 - (shorter - d * count) / whole, 1e-12)
                fails.append(np.where(count > 0, np.log10(free), 0.0))
        if not sizes.total:
            arcs[0], base = np.zeros(len(n[0])), np.zeros(len(n[0]))
        score = walk(block, n, arcs, fails)
        text = np.repeat(np.arange(len(block.sizes)), block.sizes)
        add = lambda x: np.bincount(text, x[block.levels[0].at], len(block.sizes))
        columns = [rows["ids"].combine_chunks().flatten(), block.sizes, add((n[0] > 0).astype(float)).astype(np.int64), add(base), score]
        return pa.table([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], [id_column, "n_tokens", "n_known", "base_score", "score"])

    return read, out


def score_blocks(scored: DataFrame, more: DataFrame | None, order: int, size: int, kind: str, id_column: str) -> DataFrame:
    """Scores of all texts in the blocks ``scored`` by the training texts in these and in the blocks ``more``; see ``score``."""
    columns = ["block", "vocabulary", "codes", "sizes", "trained"]
    # Blocks are numbered by rows of their table; those of the other table get numbers below zero.
    all_blocks = scored.select(columns)
    if more is not None:
        all_blocks = all_blocks.unionByName(more.select(columns).withColumn("block", -1 - F.col("block")))
    buckets = 1 + size // BUCKET_BYTES
    told = cut_lineage(_requests(all_blocks, order, buckets).groupBy("bucket").applyInArrow(_totals, MESSAGE))
    answers = told.where("block IS NOT NULL").select("bucket", "block", "word_n", "gram_n", "owner")
    whole = told.agg(F.sum("tokens"), F.sum("distinct_words")).first()
    sizes = Sizes(whole[0] or 0, whole[1] or 0)
    asked = all_blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_contexts(order, buckets), MESSAGE)
    figures = cut_lineage(asked.groupBy("bucket").applyInArrow(_context_totals, MESSAGE).select("bucket", "block", *FIGURES))
    read, out = _scores(sizes, order, kind, id_column)
    both = answers.drop("owner").unionByName(figures, allowMissingColumns=True)
    found = scored.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(read, out)
    total = F.lit(sizes.total).cast("long").alias("train_tokens")
    return found.select(id_column, "n_tokens", "n_known", total, "base_score", "score")


def score(docs: DataFrame, model: Model, weights: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text has one token, its end. Rows without id and repeated rows are scored one by one. Without training texts
    nothing is known and both scores are those of an empty model. An empty table gives no rows. Other columns are not read.
    """
    blocks = blocks_of(docs, id_column, text_column, F.lit(False))
    kind = docs.schema[id_column].dataType.simpleString()
    return score_blocks(blocks, weights, model.order, model.size + _bytes(docs, text_column), kind, id_column)


def score_corpus(docs: DataFrame, train: Column, order: int = ORDER, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``score`` of all rows of ``docs`` by a model of the rows for which ``train`` holds; texts are read once."""
    blocks = blocks_of(docs, id_column, text_column, train)
    kind = docs.schema[id_column].dataType.simpleString()
    return score_blocks(blocks, None, order, _bytes(docs, text_column), kind, id_column)


@query("op7_language_model")
def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    return score_corpus(docs, ~held_out).withColumn("held_out", held_out)
