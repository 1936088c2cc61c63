"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is good or bad. Its evidence is a weighted sum of figures of the line and of its neighbours; a second set of weights says
how readily good follows bad. Forward-backward gives each line's probability of being good, and the mean over lines, weighted by
their lengths, is turned into the document's quality by a logistic function fitted on the training documents. Lines
learn from the label of their document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .registry import query, table
from .samples import held_out, labelled_texts
from .words import Words, word_slices

SAMPLE_ROWS = 1500  # bound of the labelled sample for each mark
STEPS, RATE, DECAY = 160, 0.08, 1e-3
FEW = 4  # words that a line's rates are held back by
THRESHOLD = 0.3

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
BANG = np.zeros(256, bool)
BANG[[ord(c) for c in "!?"]] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True


@dataclass
class Lines:
    """Lines that hold a word: their text, their length in bytes, and their figures."""

    n: int
    text: np.ndarray
    size: np.ndarray
    figures: np.ndarray


def _sums(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[end] - total[start]


def lines_of(words: Words) -> Lines:
    """Lines of texts, parted by line feeds. Lines of white space are left out."""
    data = words.data
    feeds = np.concatenate([[0], np.cumsum(data == 0x0A)])
    row = feeds[words.start] + words.text  # line feeds and text ends before a word tell its line apart
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][: len(row)])
    if not len(first):
        return Lines(words.n, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 3 * FIGURES)))
    last = np.r_[first[1:], len(row)] - 1
    start, end, text = words.start[first], words.end[last], words.text[first]
    n_words = (last - first + 1).astype(float)
    size = (end - start).astype(float)
    again = np.zeros(len(row), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (row[1:] == row[:-1])
    single = words.end - words.start == 1
    # Distinct words of each line.
    line = np.repeat(np.arange(len(first)), last - first + 1)
    order = np.lexsort((words.hash, line))
    fresh = np.r_[True, (words.hash[order][1:] != words.hash[order][:-1]) | (line[order][1:] != line[order][:-1])]
    distinct = np.bincount(line[order][fresh], minlength=len(first))
    # A line is a copy if an earlier line of its text has the same words in the same order.
    with np.errstate(over="ignore"):
        place = (np.arange(len(row)) - first[line] + 1).astype(np.uint64)
        mark = np.add.reduceat(words.hash * (place * np.uint64(2) + np.uint64(1)), first)
    order = np.lexsort((np.arange(len(first)), mark, text))
    copy = np.zeros(len(first), bool)
    copy[order[1:]] = (mark[order[1:]] == mark[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    # In a line of few words one sign or one chance repetition says little.
    rate = lambda flags: np.minimum(_sums(flags, start, end) / (n_words + FEW), 2.0)
    word_rate = lambda flags: _sums(flags, first, last + 1) / (n_words + FEW)
    often = lambda n, share: ((n > share * n_words) & (n >= FEW - 1)).astype(float)
    own = np.stack(
        [
            rate(SYMBOL[data]), rate(BANG[data]), _sums(UPPER[data], start, end) / size, _sums(DIGIT[data], start, end) / size,
            word_rate(again), word_rate(single), (distinct + FEW) / (n_words + FEW), np.minimum(size / n_words, 20) / 10,
            np.log1p(n_words) / 5, copy.astype(float), (n_words < 4).astype(float),
            often(_sums(SYMBOL[data], start, end), 0.1), often(_sums(again, first, last + 1), 0.2),
        ],
        1,
    )
    # Neighbours of the same text; outside it there is a line of zeros.
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = text[1:] == text[:-1]
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    return Lines(words.n, text, end - start, np.concatenate([own, before, after], 1))


FIGURES = 13


def chains(text: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each place in a text the lines at it, with the texts that go on so far; longest texts first."""
    count = np.bincount(text, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    order = np.argsort(-count, kind="stable")
    high = count[order]
    out = []
    for place in range(int(high[0]) if n else 0):
        live = int(np.searchsorted(-high, -place))
        out.append(first[order[:live]] + place)
    return out


@dataclass
class Field:
    """Weights of the figures (the last one is the constant), of staying bad and staying good, and of the logistic function."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    stay: np.ndarray
    slope: float
    shift: float
    empty: float

    def evidence(self, figures: np.ndarray) -> np.ndarray:
        return ((figures - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def passed(self, odds: np.ndarray) -> np.ndarray:
        """Log-odds of good that a neighbour with log-odds ``odds`` sends."""
        return np.logaddexp(odds + self.stay[1], 0) - np.logaddexp(odds, self.stay[0])

    def odds(self, evidence: np.ndarray, steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of good from the lines before with the line itself, and from the lines behind."""
        forward, backward = evidence.copy(), np.zeros_like(evidence)
        for near, far in zip(steps, steps[1:]):
            forward[far] += self.passed(forward[near[: len(far)]])
        for near, far in reversed(list(zip(steps, steps[1:]))):
            backward[near[: len(far)]] = self.passed(evidence[far] + backward[far])
        return forward, backward

    def share(self, lines: Lines) -> np.ndarray:
        """Mean probability of good over the lines of each text, weighted by their lengths; NaN without lines."""
        forward, backward = self.odds(self.evidence(lines.figures), chains(lines.text, lines.n))
        good = _sigmoid(forward + backward)
        weight = np.bincount(lines.text, weights=lines.size, minlength=lines.n)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.bincount(lines.text, weights=lines.size * good, minlength=lines.n) / weight

    def score(self, words: Words) -> np.ndarray:
        share = self.share(lines_of(words))
        return np.where(np.isnan(share), self.empty, _sigmoid(self.slope * _logit(share) + self.shift))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(np.nan_to_num(p, nan=0.5), 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _together(parts: list[Lines]) -> Lines:
    at = np.cumsum([0, *(p.n for p in parts)])
    return Lines(
        int(at[-1]), np.concatenate([p.text + a for p, a in zip(parts, at)]), np.concatenate([p.size for p in parts]),
        np.concatenate([p.figures for p in parts]),
    )


def fit(texts: pa.Array, marks: np.ndarray) -> Field:
    """A field for ``marks`` (1 good, 0 bad). Without lines of both marks every text gets the share of good ones."""
    share = float((marks.sum() + 1) / (len(marks) + 2))
    field = Field(np.zeros(3 * FIGURES + 1), np.zeros(3 * FIGURES), np.ones(3 * FIGURES), np.zeros(2), 0.0, float(np.log(share / (1 - share))), share)
    parts = [lines_of(w) for _, _, w in word_slices(texts)]
    if not parts:
        return field
    lines = _together(parts)
    good = marks[lines.text].astype(float)
    if not len(good) or good.min() == good.max():
        return field
    field.mean, field.scale = lines.figures.mean(0), lines.figures.std(0) + 1e-6
    inputs = np.concatenate([(lines.figures - field.mean) / field.scale, np.ones((len(good), 1))], 1)
    steps = chains(lines.text, lines.n)
    # Both marks weigh the same, and each text as much as another.
    per_text = np.bincount(lines.text, minlength=lines.n)[lines.text]
    weight = np.where(good == 1, 0.5 / (marks == 1).sum(), 0.5 / (marks == 0).sum()) / per_text
    pairs = [(near[: len(far)], far) for near, far in zip(steps, steps[1:])]
    left = np.concatenate([a for a, _ in pairs]) if pairs else np.zeros(0, np.int64)
    right = np.concatenate([b for _, b in pairs]) if pairs else np.zeros(0, np.int64)
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in (field.weights, field.stay)]
    for step in range(1, STEPS + 1):
        evidence = inputs @ field.weights
        forward, backward = field.odds(evidence, steps)
        missing = (good - _sigmoid(forward + backward)) * weight
        # Probabilities of staying good and of staying bad between neighbours.
        a, b = forward[left], evidence[right] + backward[right]
        logs = np.stack([np.full(len(a), field.stay[0]), b, a, a + b + field.stay[1]])
        logs -= np.logaddexp.reduce(logs, axis=0) if len(a) else 0
        both = np.exp(logs)
        stay_gap = np.array(
            [(((1 - good[left]) - both[0]) * weight[right]).sum(), ((good[left] - both[3]) * weight[right]).sum()]
        )
        grads = (inputs.T @ missing - DECAY * field.weights, stay_gap - 10 * DECAY * field.stay)
        rate = RATE * (1 - step / (STEPS + 1))
        for value, grad, (m, v) in zip((field.weights, field.stay), grads, moments):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    held = field.share(lines)
    some = ~np.isnan(held)
    field.slope, field.shift = _logistic(_logit(held[some]), marks[some].astype(float))
    return field


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic function, by Newton steps with a small penalty on the slope."""
    inputs = np.stack([x, np.ones_like(x)], 1)
    beta = np.array([1.0, 0.0])
    penalty = np.array([1.0, 0.01])
    for _ in range(40):
        p = _sigmoid(inputs @ beta)
        hessian = (inputs * (p * (1 - p))[:, None]).T @ inputs + np.diag(penalty)
        beta = beta + np.clip(np.linalg.solve(hessian, inputs.T @ (y - p) - penalty * (beta - [1.0, 0.0])), -2, 2)
    return float(max(beta[0], 0.0)), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Field:
    sample = labelled_texts(docs, labels, "quality", most)
    return fit(sample.column("text").combine_chunks(), np.asarray(sample.column("mark").to_numpy(), np.int64))


def scorer(spark: SparkSession, field: Field):
    """A function of a text column: quality from 0 to 1."""
    shared = spark.sparkContext.broadcast(field)

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        field = shared.value
        found = [field.score(words) for _, _, words in word_slices(texts)]
        return pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return score


def quality(docs: DataFrame, labels: DataFrame, text_column: str = "text") -> Column:
    """Quality of a text column of ``docs``, learned from ``labels``.

    A null text, an empty one or one of white space has no lines and gets the share of good training documents. Repeated rows get
    equal scores.
    """
    return scorer(docs.sparkSession, train(docs, labels))(F.col(text_column))


@query("op1_line_quality")
def op1_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    score = quality(docs, table(spark, folder, "labels"))
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
