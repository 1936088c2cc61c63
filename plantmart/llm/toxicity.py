"""Toxicity: a convolutional text classifier, trained by Spark on all labelled documents.

A word's vector is the sum of the hashed vectors of the word and of its first bytes. Filters of several widths slide over the whole
text, each keeps its largest value, and a linear layer gives the logit. Each language gets a threshold of its own, found on
training documents that were left out of the fit; the logit is shifted by it, so that 0.5 is the threshold in any language. The
language is guessed from the text's function words.

The buckets that tell the marks apart are counted over all texts. Then the texts, as the places of these words, are dealt to at most
``PARTS`` tasks; in each round every task trains the network on its texts in numpy, and the driver averages the networks. Only
counts, networks and histograms of logits reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import cut_lineage, shuffles_released
from .registry import query, table
from .samples import all_labelled, held_out
from .words import U, Words, buffers, mix, word_slices, words_of

BUCKETS = 1 << 20
PREFIXES = (4, 6)  # bytes
WIDTHS, FILTERS, SIZE = (1, 2, 3), 8, 12
ROUNDS, BATCH, RATE, DECAY = 4, 64, 0.02, 1e-4
PARTS, PART_TEXTS = 32, 2048  # tasks that train, and texts for each until there are so many tasks
PASSES, FEW_TEXTS = 3, 2 * PART_TEXTS  # passes of a task over its texts in a round if they are not more than this; else one
MIN_TEXTS = 3  # a bucket has a vector if so many training texts have it,
MIN_GAP = 3.0  # if the marks differ by so many standard deviations in their share of it,
MIN_EFFECT = 0.1  # and by this times the deviation of one text, so that the vocabulary does not grow with the table
MIN_CALIBRATION = 20  # documents of each mark that a language needs for a threshold of its own
LOGIT_STEPS = 100  # logits are counted in steps of this part of one
CLEAN_WEIGHT = 3.0  # share of clean texts above the threshold against share of toxic texts below it
# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on be by this from are not at or an have which",
    "fr": "le la les de des du un une et est que qui dans pour par sur pas au avec il elle ce se ne",
    "de": "der die das und ist nicht mit den von zu ein eine im auf dem des sich als auch für an es wird",
    "es": "el la los las de del que y en un una por con para es no se su al lo como más pero sus",
}
LANGUAGES = list(FUNCTION_WORDS)


def _hashes(words: list[str]) -> np.ndarray:
    return np.sort(words_of(*buffers(pa.array(words))).hash)


def buckets(words: Words, which: np.ndarray) -> np.ndarray:
    """Buckets of the words at ``which``: of the whole word, then of its first bytes; a column for each."""
    some = Words(words.n, words.data, words.offsets, words.text[which], words.start[which], words.end[which], words.hash[which], words.prefix)
    with np.errstate(over="ignore"):
        columns = [some.hash, *(some.prefixes(width, salt) for salt, width in enumerate(PREFIXES, 1))]
        return np.stack([mix(c + U(k)) % U(BUCKETS) for k, c in enumerate(columns)], 1).astype(np.int64)


@dataclass
class Vocabulary:
    """Buckets with a vector, rising; the vector's number is the position."""

    known: np.ndarray

    def rows(self, found: np.ndarray) -> np.ndarray:
        """Vector numbers of buckets; the number after the last one stands for none."""
        if not len(self.known):
            return np.zeros(found.shape, np.int64)
        at = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
        return np.where(self.known[at] == found, at, len(self.known))


@dataclass
class Windows:
    """For each width, the windows that hold a word with a vector: their word kinds (blank behind the text's end) and texts."""

    n: int
    kinds: list[np.ndarray]  # for each width: windows x width
    text: list[np.ndarray]  # rising


def windows_of(kind: np.ndarray, text: np.ndarray, n: int, blank: int) -> Windows:
    """Windows over words of kind ``kind``; ``blank`` is the kind without a vector. All other windows hold blanks only."""
    size = len(kind)
    place = np.flatnonzero(kind != blank)
    kind, text = kind.astype(np.int32), text.astype(np.int32)
    kinds, texts = [], []
    for width in WIDTHS:
        begins = np.zeros(size, bool)
        for j in range(width):
            begins[place[place >= j] - j] = True
        start = np.flatnonzero(begins)
        # A window may begin in the text before; then it is none.
        reach = np.minimum(start[:, None] + np.arange(width), max(size - 1, 0))
        inside = (text[reach] == text[start][:, None]) & (start[:, None] + np.arange(width) < size)
        held = np.where(inside, kind[reach], blank)
        some = (held != blank).any(1)
        kinds.append(held[some])
        texts.append(text[start][some])
    return Windows(n, kinds, texts)


@dataclass
class Network:
    vocabulary: Vocabulary
    vectors: np.ndarray  # one more row than the vocabulary, of zeros
    filters: list[np.ndarray]  # for each width: width x SIZE x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    shifts: np.ndarray  # logit threshold of each language, at the end that of others

    def pooled(self, kinds: np.ndarray, windows: Windows) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest value of each filter in each text, and the window that has it (-1: one of blanks). ``kinds``: their vectors."""
        values, places = [], []
        for held, text, filters, bias in zip(windows.kinds, windows.text, self.filters, self.bias):
            best = np.tile(bias, (windows.n, 1))
            place = np.full((windows.n, FILTERS), -1, np.int64)
            if len(text):
                # A word kind is multiplied once for each place in the filter.
                total = sum((kinds @ filters[j])[held[:, j]] for j in range(held.shape[1])) + bias
                first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                top, owner = np.maximum.reduceat(total, first, axis=0), text[first]
                # The first window that reaches the largest value.
                rows = np.arange(len(text))[:, None]
                equal = np.where(total == np.repeat(top, np.diff(np.r_[first, len(text)]), axis=0), rows, len(text))
                at = np.minimum.reduceat(equal, first, axis=0)
                place[owner] = np.where(top > best[owner], at, -1)
                best[owner] = np.maximum(best[owner], top)
            values.append(np.maximum(best, 0))
            places.append(place)
        return np.concatenate(values, 1), places

    def logits(self, words: Words) -> np.ndarray:
        """Logit of each text less its language's threshold."""
        table, kind = kinds_of(words, self.vocabulary)
        pooled, _ = self.pooled(self.vectors[table].sum(1), windows_of(kind, words.text, words.n, len(table) - 1))
        return pooled @ self.out + self.out_bias - self.shifts[languages(words)]


def kinds_of(words: Words, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Vector numbers of each kind of word (the last kind has no vector), and the kind of each word."""
    found, inverse = distinct_buckets(words)
    return _kinds(found, inverse, vocabulary)


def distinct_buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct words, and the number of each word among these."""
    hashes, firsts, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    return buckets(words, firsts).astype(np.int32), inverse.astype(np.int32)


def _kinds(found: np.ndarray, inverse: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    none = len(vocabulary.known)
    rows = vocabulary.rows(found)
    some = (rows != none).any(1)
    table = np.vstack([rows[some], np.full((1, rows.shape[1]), none)])
    number = np.full(len(found), len(table) - 1, np.int32)
    number[some] = np.arange(some.sum())
    return table, number[inverse]


def languages(words: Words) -> np.ndarray:
    """Number of the language with the most function words in each text; after the last one: none has any."""
    hits = np.zeros((words.n, len(LANGUAGES)), np.int64)
    for k, name in enumerate(LANGUAGES):
        known = _hashes(FUNCTION_WORDS[name].split())
        at = np.minimum(np.searchsorted(known, words.hash), len(known) - 1)
        hits[:, k] = np.bincount(words.text[known[at] == words.hash], minlength=words.n)
    return np.where(hits.any(1), hits.argmax(1), len(LANGUAGES))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Texts:
    """Training texts as the places of their words with a vector: marks, where each text's places begin, places, vector numbers."""

    marks: np.ndarray
    first: np.ndarray
    place: np.ndarray
    vectors: np.ndarray  # places x columns of ``buckets``

    def some(self, low: int, high: int) -> tuple[np.ndarray, Windows]:
        """Vector numbers of the word kinds (each place is one, the last is the blank) and windows of texts ``low`` to ``high``."""
        first = self.first[low : high + 1]
        place = self.place[first[0] : first[-1]]
        n = np.diff(first)
        # Behind a text's last place there are blanks only.
        size = np.zeros(high - low, np.int64)
        size[n > 0] = place[first[1:][n > 0] - first[0] - 1] + 1
        begin = np.cumsum(size) - size
        blank = len(place)
        kind = np.full(size.sum(), blank, np.int32)
        kind[np.repeat(begin, n) + place] = np.arange(blank)
        return self.vectors[first[0] : first[-1]], windows_of(kind, np.repeat(np.arange(high - low), size), high - low, blank)


def texts_of(batch: pa.RecordBatch) -> Texts:
    place, vectors = (batch.column(batch.schema.get_field_index(c)) for c in ("place", "vectors"))
    first = place.offsets.to_numpy().astype(np.int64)
    return Texts(
        np.asarray(batch.column(batch.schema.get_field_index("mark"))).astype(np.int64), first - first[0],
        place.flatten().to_numpy(), vectors.flatten().to_numpy().reshape(-1, 1 + len(PREFIXES)),
    )


class Learner:
    """Adam on a network's values; ``weight`` has the weights of texts of mark 0 and 1."""

    def __init__(self, net: Network, weight: np.ndarray, rate: float):
        self.net, self.weight, self.rate, self.step = net, weight, rate, 0
        self.bias = np.full(1, net.out_bias)
        self.values = [net.vectors, *net.filters, *net.bias, net.out, self.bias]
        self.moments = [(np.zeros_like(v), np.zeros_like(v)) for v in self.values]
        self.texts, self.seen = 0, np.zeros(len(net.vectors), np.int64)

    def learn(self, texts: Texts) -> None:
        for low in range(0, len(texts.marks), BATCH):
            self._batch(texts, low, min(low + BATCH, len(texts.marks)))

    def _batch(self, texts: Texts, low: int, high: int) -> None:
        net, none, marks = self.net, len(self.net.vocabulary.known), texts.marks[low:high]
        rows, windows = texts.some(low, high)
        self.texts += high - low
        self.seen += np.bincount(rows.ravel(), minlength=none + 1)
        vectors = np.vstack([net.vectors[rows].sum(1), np.zeros((1, SIZE))])
        pooled, places = net.pooled(vectors, windows)
        error = (_sigmoid(pooled @ net.out + self.bias[0]) - marks) * self.weight[marks] / (high - low)
        back = error[:, None] * net.out * (pooled > 0)
        grads = [np.zeros_like(v) for v in self.values]
        grads[-2], grads[-1][0] = pooled.T @ error, error.sum()
        pull = np.zeros_like(vectors)
        for k, (held, place) in enumerate(zip(windows.kinds, places)):
            part = back[:, k * FILTERS : (k + 1) * FILTERS]
            grads[1 + len(WIDTHS) + k] = part.sum(0)
            own, column = np.nonzero((place >= 0) & (part != 0))
            if not len(own):
                continue
            amount, window = part[own, column], held[place[own, column]]
            for j in range(held.shape[1]):
                word = window[:, j]
                np.add.at(grads[1 + k][j].T, column, vectors[word] * amount[:, None])
                np.add.at(pull, word, net.filters[k][j].T[column] * amount[:, None])
        moved = np.flatnonzero(pull[:-1].any(1))
        for column in range(rows.shape[1]):
            np.add.at(grads[0], rows[moved, column], pull[moved])
        grads[0] += DECAY * net.vectors
        grads[0][none] = 0
        self.step += 1
        for value, grad, (m, v) in zip(self.values, grads, self.moments):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            value -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def _threshold(logits: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """The logit that parts the marks best, in the middle of the gap; a clean text above it weighs ``CLEAN_WEIGHT`` times.

    ``clean`` and ``toxic`` are the numbers of texts at each of the rising ``logits``.
    """
    good = np.cumsum(clean) / max(1, clean.sum())  # clean texts at or below
    bad = np.cumsum(toxic) / max(1, toxic.sum())  # toxic texts at or below
    gain = np.concatenate([[0], CLEAN_WEIGHT * good - bad])
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    middle = best[len(best) // 2]
    low = logits[middle - 1] if middle > 0 else logits[0] - 1
    high = logits[middle] if middle < len(logits) else logits[-1] + 1
    return float((low + high) / 2)


def _thresholds(found: pa.Table) -> np.ndarray:
    """Threshold of each language on the texts left out of the fit; languages with few of them get the one of all.

    ``found`` counts the texts of each left_out, language, logit.
    """
    left_out, language, logit, clean, toxic = (found.column(c).to_numpy() for c in ("left_out", "language", "logit", "clean", "toxic"))
    left_out = left_out.astype(bool)

    def enough(rows: np.ndarray) -> bool:
        return min(clean[rows].sum(), toxic[rows].sum()) >= MIN_CALIBRATION

    def threshold(rows: np.ndarray) -> float:
        logits, at = np.unique(logit[rows], return_inverse=True)
        return _threshold(logits / LOGIT_STEPS, np.bincount(at, clean[rows]), np.bincount(at, toxic[rows]))

    out = np.full(len(LANGUAGES) + 1, threshold(left_out if enough(left_out) else np.ones(len(logit), bool)))
    for k in range(len(LANGUAGES)):
        some = left_out & (language == k)
        if enough(some):
            out[k] = threshold(some)
    return out


def scorer(spark: SparkSession, net: Network):
    """A function of a text column: toxicity from 0 to 1, 0.5 being the threshold of the text's language."""
    shared = spark.sparkContext.broadcast(net)

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        net = shared.value
        found = [_sigmoid(net.logits(words)) for _, _, words in word_slices(texts)]
        return pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return score


def counted(texts: DataFrame) -> DataFrame:
    """For each bucket the number of texts and of toxic texts of the fit that have it: bucket, n, toxic.

    Bucket ``BUCKETS`` counts all texts of the fit, the one after it those left out as well.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, toxic = np.zeros(BUCKETS + 2, np.int64), np.zeros(BUCKETS + 2, np.int64)
        for batch in batches:
            marks, left_out = (np.asarray(batch.column(i)).astype(np.int64) for i in (1, 2))
            n += np.bincount([BUCKETS, BUCKETS + 1], [(1 - left_out).sum(), len(marks)], BUCKETS + 2).astype(np.int64)
            toxic += np.bincount([BUCKETS, BUCKETS + 1], [marks[left_out == 0].sum(), marks.sum()], BUCKETS + 2).astype(np.int64)
            for at, to, words in word_slices(batch.column(0)):
                found, word = distinct_buckets(words)
                learned = left_out[at:to][words.text] == 0
                pairs = np.unique(words.text[learned, None].astype(np.int64) * BUCKETS + found[word[learned]])
                bucket, mark = pairs % BUCKETS, marks[at:to][pairs // BUCKETS]
                n += np.bincount(bucket, minlength=BUCKETS + 2)
                toxic += np.bincount(bucket[mark == 1], minlength=BUCKETS + 2)
        some = np.flatnonzero(n)
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (part.astype(np.int32), n[part], toxic[part])], ["bucket", "n", "toxic"])

    rows = texts.select("text", "mark", F.col("left_out").cast("int").alias("left_out"))
    return rows.mapInArrow(count, "bucket int, n long, toxic long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def telling(counts: DataFrame, clean: int, toxic: int) -> np.ndarray:
    """Buckets that at least ``MIN_TEXTS`` texts of the fit have, and that have clearly different shares of the two marks."""
    rate, other = F.col("toxic") / max(toxic, 1), (F.col("n") - F.col("toxic")) / max(clean, 1)
    share, middle = (F.col("n") + 0.5) / (clean + toxic + 1), (rate + other) / 2
    gap = F.abs(rate - other)
    known = counts.where(
        (F.col("bucket") < BUCKETS) & (F.col("n") >= MIN_TEXTS)
        & (gap >= MIN_GAP * F.sqrt(share * (1 - share) * (1 / max(toxic, 1) + 1 / max(clean, 1))))
        & (gap >= MIN_EFFECT * F.sqrt(middle * (1 - middle)))
    )
    return np.sort(known.select("bucket").toArrow().column(0).to_numpy())


def placed(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each text as the places of its words with a vector: doc_id, mark, left_out, language, place, vectors (see ``Texts``)."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for at, to, words in word_slices(batch.column(1)):
                rows, number = kinds_of(words, vocabulary)
                some = np.flatnonzero(number != len(rows) - 1)
                first = words.first
                bounds = np.searchsorted(some, first).astype(np.int32)
                places = (some - first[words.text[some]]).astype(np.int32)
                vectors = rows[number[some]].astype(np.int32)
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2), part.column(3), pa.array(languages(words).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(places)),
                        pa.ListArray.from_arrays(pa.array(bounds * np.int32(vectors.shape[1])), pa.array(vectors.ravel())),
                    ],
                    ["doc_id", "mark", "left_out", "language", "place", "vectors"],
                )

    rows = texts.select("doc_id", "text", "mark", "left_out")
    schema = f"doc_id {kind}, mark int, left_out boolean, language int, place array<int>, vectors array<int>"
    return rows.mapInArrow(place, schema)


def _round(rows: DataFrame, net: Network, weight: np.ndarray, rate: float, passes: int) -> Network:
    """The mean of the networks that the partitions of ``rows`` train from ``net``, each on its own texts.

    A word's vector counts by how often the partition has the word, the other values by the partition's texts.
    """
    shared = rows.sparkSession.sparkContext.broadcast((net, weight))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(*shared.value, rate)
        parts = (texts_of(batch) for batch in batches)
        # More than one pass is only for few texts.
        held = list(parts) if passes > 1 else parts
        for _ in range(passes):
            for texts in held:
                learner.learn(texts)
        if learner.texts:
            values = np.concatenate([v.ravel() for v in learner.values]).astype(np.float32)
            columns = [[TaskContext.get().partitionId()], [learner.texts], [learner.seen.astype(np.int32).tobytes()], [values.tobytes()]]
            types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "n", "seen", "vals"])

    trained = rows.select("mark", "place", "vectors").mapInArrow(learn, "part int, n long, seen binary, vals binary")
    with shuffles_released(rows.sparkSession):
        found = trained.toArrow().sort_by("part").to_pylist()
    shared.destroy()
    values = Learner(net, weight, rate).values
    total, own = np.zeros(sum(v.size for v in values)), np.zeros(len(net.vectors))
    texts, width = sum(r["n"] for r in found), net.vectors.size
    for r in found:
        vals, seen = np.frombuffer(r["vals"], np.float32), np.frombuffer(r["seen"], np.int32)
        total[:width] += vals[:width] * np.repeat(seen, SIZE)
        total[width:] += vals[width:] * (r["n"] / texts)
        own += seen
    used = np.repeat(own, SIZE)
    total[:width] = np.where(used > 0, total[:width] / np.maximum(used, 1), net.vectors.ravel())
    ends = np.cumsum([v.size for v in values])
    vectors, *rest = (part.reshape(v.shape) for part, v in zip(np.split(total, ends[:-1]), values))
    return Network(net.vocabulary, vectors, rest[: len(WIDTHS)], rest[len(WIDTHS) : -2], rest[-2], float(rest[-1][0]), net.shifts)


def logit_counts(rows: DataFrame, net: Network) -> pa.Table:
    """The number of clean and of toxic texts of each left_out, language and rounded logit: at most some thousand rows."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            texts = texts_of(batch)
            found = []
            for low in range(0, len(texts.marks), BATCH):
                numbers, windows = texts.some(low, min(low + BATCH, len(texts.marks)))
                pooled, _ = net.pooled(np.vstack([net.vectors[numbers].sum(1), np.zeros((1, SIZE))]), windows)
                found.append(pooled @ net.out + net.out_bias)
            logits = np.clip(np.concatenate(found) if found else np.zeros(0), -30, 30)
            columns = [batch.column(i) for i in (0, 1, 2)] + [pa.array(np.rint(logits * LOGIT_STEPS).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["mark", "left_out", "language", "logit"])

    scored = rows.select("mark", "left_out", "language", "place", "vectors").mapInArrow(
        score, "mark int, left_out boolean, language int, logit int"
    )
    with shuffles_released(rows.sparkSession):
        return scored.groupBy("left_out", "language", "logit").agg(
            F.sum(1 - F.col("mark")).alias("clean"), F.sum("mark").alias("toxic")
        ).toArrow()


def train(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Network:
    """A network for the marks of all labelled documents. A fifth of them is left out of the fit and calibrates the thresholds.

    Without texts of both marks the network gives every text the share of marks (a half without any text).
    """
    # The hash also tells apart what the held-out fold's remainder leaves.
    texts = all_labelled(docs, labels, "toxic").withColumn("left_out", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 4)
    counts = cut_lineage(counted(texts))
    totals = {r["bucket"]: (r["n"], r["toxic"]) for r in counts.where(F.col("bucket") >= BUCKETS).collect()}
    (n, toxic), (every, marked) = (totals.get(k, (0, 0)) for k in (BUCKETS, BUCKETS + 1))
    both = 0 < toxic < n
    vocabulary = Vocabulary(telling(counts, n - toxic, toxic) if both else np.zeros(0, np.int32))
    none, share = len(vocabulary.known), (marked + 1) / (every + 2)
    random = np.random.default_rng(seed)
    net = Network(
        vocabulary, np.vstack([random.normal(0, 0.05, (none, SIZE)), np.zeros((1, SIZE))]),
        [random.normal(0, 1, (w, SIZE, FILTERS)) / np.sqrt(SIZE) for w in WIDTHS], [np.zeros(FILTERS) for _ in WIDTHS],
        random.normal(0, 0.3, FILTERS * len(WIDTHS)), 0.0, np.zeros(len(LANGUAGES) + 1),
    )
    if not both:
        net.out[:], net.out_bias = 0, float(np.log(share / (1 - share)))
        return net
    rows = cut_lineage(placed(texts, vocabulary))
    parts = min(PARTS, -(-n // PART_TEXTS))
    # Dealt by id and read in order of its hash, so that the network depends on the rows alone.
    dealt = rows.where(~F.col("left_out")).repartition(parts, "doc_id").sortWithinPartitions(F.xxhash64("doc_id", F.lit(1)), "doc_id", "mark", "place", "vectors")
    weight = np.array([0.5 / (n - toxic), 0.5 / toxic]) * n
    passes = PASSES if n <= parts * FEW_TEXTS else 1
    for k in range(ROUNDS):
        net = _round(dealt, net, weight, RATE * (1 - k / ROUNDS), passes)
    net.shifts = _thresholds(logit_counts(rows, net))
    return net


def toxicity(docs: DataFrame, labels: DataFrame, text_column: str = "text") -> Column:
    """Toxicity of a text column of ``docs``, learned from ``labels``.

    A null or empty text has no words and gets the score of a text without any known word. Repeated rows get equal scores.
    """
    return scorer(docs.sparkSession, train(docs, labels))(F.col(text_column))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    score = toxicity(docs, table(spark, folder, "labels"))
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
