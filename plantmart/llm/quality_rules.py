"""Quality rules: a learned decision list over text statistics, run as ordered Spark conditions.

Sequential covering grows one conjunction of thresholds at a time on two thirds of a labelled sample, prunes it on the other
third, keeps it if it is precise there, and goes on with the rows it leaves. The first rule that holds rejects a text; a text
that no rule covers is kept. Statistics come from array functions on the row itself; nothing is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import first_by_hash, query, table
from .words import SPACES

SYMBOLS = "#*$%&|<>"
BLANK = "\t\n\x0b\x0c\r "
LABELLED_ROWS = 8000  # bound of the labelled sample on the driver
MIN_PRECISION, MIN_COVER, MAX_CONDITIONS, MAX_RULES, CUTS = 0.93, 5, 3, 16, 48
# Measures that mean the same in any language and at any length; lengths of words and texts are left out on purpose.
MEASURES = ["symbol_rate", "repeat_rate", "dup_line_rate", "bang_rate", "upper_rate"]


def _count(text: Column, characters: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")


def _repeated_words(words: Column, n: Column) -> Column:
    """Words inside a window of three words that the text has twice or more. ``words`` must be a column, not an expression."""
    at = F.sequence(F.lit(0), n - 3)
    windows = F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n >= 3, windows)


def text_statistics(docs: DataFrame, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the rates of ``MEASURES``.

    A null text counts as one without words: all counts are 0 and all rates 0.
    """
    keep = ["doc_id"] if keep is None else keep
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(*keep, text.alias("_t"))
    bare = F.btrim("_t", F.lit(BLANK))
    rows = rows.select(
        *keep, "_t",
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES)).alias("_w"),
        F.filter(F.split("_t", "\n"), lambda line: F.btrim(line, F.lit(BLANK)) != "").alias("_l"),
    )
    rows = rows.withColumn("n_words", F.size("_w").cast("long")).withColumn(
        "_h", _repeated_words(F.col("_w"), F.size("_w"))
    )
    has = F.coalesce(F.size("_h") > F.size(F.array_distinct("_h")), F.lit(False))
    pairs = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_s", F.when(has, pairs))
    s = F.col("_s")
    first = F.filter(
        F.transform(
            s,
            lambda e, k: F.when(
                (e["h"] == F.get(s, k + 1)["h"]) | ((k > 0) & (e["h"] == F.get(s, k - 1)["h"])), e["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    rows = rows.withColumn("_i", first)
    covered = F.array_union(
        F.array_union("_i", F.transform("_i", lambda i: i + 1)), F.transform("_i", lambda i: i + 2)
    )
    rows = rows.select(
        *keep, "n_words",
        F.char_length(F.translate("_t", BLANK, "")).cast("long").alias("word_chars"),
        _count(F.col("_t"), SYMBOLS).alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_i").isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        _count(F.col("_t"), "!?").alias("_bang"),
        _count(F.col("_t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("_upper"),
    )

    def rate(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    return rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rate("n_symbols", "n_words").alias("symbol_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"),
        rate("n_dup_lines", "n_lines").alias("dup_line_rate"),
        rate("_bang", "n_words").alias("bang_rate"),
        rate("_upper", "word_chars").alias("upper_rate"),
    )


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool  # greater than the threshold, else at most
    threshold: float

    def holds(self, row: dict) -> bool:
        return (row[self.measure] > self.threshold) == self.above

    def column(self) -> Column:
        value = F.col(self.measure).cast("double")
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def holds(self, row: dict) -> bool:
        return all(c.holds(row) for c in self.conditions)

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, (c.column() for c in self.conditions))


def _thresholds(rows: list[dict], measure: str) -> list[float]:
    values = sorted({r[measure] for r in rows})
    if len(values) < 2:
        return []
    cuts = {values[int(i * (len(values) - 1) / CUTS)] for i in range(CUTS)}
    after = dict(zip(values, values[1:]))
    return sorted((c + after[c]) / 2 for c in cuts if c in after)


def _gain(rows: list[dict], before: tuple[int, int], condition: Condition) -> float:
    """Information gained on the bad rows when a rule with ``before`` (bad, good) rows gets one more condition."""
    bad = sum(1 for r in rows if r["bad"] and condition.holds(r))
    good = sum(1 for r in rows if not r["bad"] and condition.holds(r))
    if bad < MIN_COVER:
        return 0.0
    return bad * (math.log((bad + 0.01) / (bad + good + 0.02)) - math.log((before[0] + 0.01) / (sum(before) + 0.02)))


def _grow(rows: list[dict]) -> list[Condition]:
    conditions: list[Condition] = []
    while len(conditions) < MAX_CONDITIONS:
        bad = sum(r["bad"] for r in rows)
        if bad == len(rows):
            break
        options = [Condition(m, a, t) for m in MEASURES for t in _thresholds(rows, m) for a in (True, False)]
        best = max(options, key=lambda c: _gain(rows, (bad, len(rows) - bad), c), default=None)
        if best is None or _gain(rows, (bad, len(rows) - bad), best) <= 0:
            break
        conditions.append(best)
        rows = [r for r in rows if best.holds(r)]
    return conditions


def _precision(rows: list[dict], conditions: list[Condition]) -> tuple[float, int]:
    """Share of bad rows among the covered ones, held back by one row of each kind; bad rows covered."""
    covered = [r for r in rows if all(c.holds(r) for c in conditions)]
    bad = sum(r["bad"] for r in covered)
    return (bad + 1) / (len(covered) + 2), bad


def _prune(prune: list[dict], rows: list[dict], conditions: list[Condition]) -> list[Condition]:
    """Drop conditions as long as the rule gets no less precise on the rows it was not grown on, and stays precise on all."""
    for condition in reversed(conditions):
        fewer = [c for c in conditions if c != condition]
        if not fewer or _precision(rows, fewer)[0] < min(MIN_PRECISION, _precision(rows, conditions)[0]):
            continue
        if _precision(prune, fewer)[0] >= _precision(prune, conditions)[0]:
            conditions = fewer
    return conditions


def learn_rules(rows: list[dict]) -> list[Rule]:
    """Rules for bad rows, in order. ``rows`` have the measures, ``bad`` and ``fold`` (0 to 2; fold 2 prunes)."""
    rules: list[Rule] = []
    left = rows
    while len(rules) < MAX_RULES:
        grow, prune = [r for r in left if r["fold"] != 2], [r for r in left if r["fold"] == 2]
        if sum(r["bad"] for r in grow) < MIN_COVER:
            break
        conditions = _grow(grow)
        if not conditions:
            break
        conditions = _prune(prune, left, conditions)
        precise, bad = _precision(left, conditions)
        if precise < MIN_PRECISION or bad < MIN_COVER:
            break
        rule = Rule(tuple(conditions))
        rules.append(rule)
        left = [r for r in left if not rule.holds(r)]
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> list[dict]:
    """Statistics of at most ``rows`` labelled documents, with their labels."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("mark"))
    few = first_by_hash(marks, "doc_id", rows)  # bounded, so it may be broadcast
    sample = text_statistics(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id"), keep=["doc_id", "mark"])
    fold = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)).alias("fold")
    found = sample.select(*MEASURES, (F.col("mark") == 0).cast("int").alias("bad"), fold, "doc_id").collect()
    return sorted((r.asDict() for r in found), key=lambda r: (r["doc_id"], *(r[m] for m in MEASURES)))


def decide(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """``statistics`` with ``rule`` (number of the first rule that holds, from 1; null without one) and ``kept``."""
    verdict = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        verdict = F.when(rule.column(), F.lit(number)).otherwise(verdict)
    failed = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    return (
        statistics.withColumn("base_failed", failed)
        .withColumn("rule", verdict)
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rules = learn_rules(labelled_sample(docs, table(spark, folder, "labels")))
    return decide(text_statistics(docs), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
