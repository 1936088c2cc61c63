"""Spelling variants: words that differ by one letter, found in a trie of letter counts.

A word's vector counts its letters by group, and the trie branches on one count after the other. One letter inserted, deleted or replaced
changes the vector by a surplus of one at most and a deficit of one at most, so a search goes down to the word's own count at each level,
and to the count above or below as long as its budget lasts. Leaves hold words with one vector, which are then compared.

The first levels divide the trie among tasks: each word is sent to the branches that its budget reaches there, and the search goes on
below. A branch with many words is dealt into parts, and so are the words that search it, so no task holds more than a part of each.
Each pair is met once: a word looks for words that are one longer, and for words of its own length whose first other count is higher (or
that have the same vector).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .registry import query, table

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Levels of the trie; the last one holds all letters that no other has. The first ones divide the work.
GROUPS = ["e", "a", "i", "n", "o", "r", "t", "s", "l", "u", "d", "c", "m", "p", "g", "bk", "hv", "fw", "jqxyz", ""]
TOP = 5
PART = 20_000  # words of a branch, and words that search it, in a task
BLOCK = 400_000  # distinct words that a task counts before it hands them on
SLIP = 97  # a run whose hash this number divides loses a letter
LETTERS, COUNT = 5, 3  # least length and number of occurrences of a word
LOOK = 1 << 20  # pairs that are compared together


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Words with their numbers of occurrences: word, n.

    A run of letters with A-Z lower-cased is a word as it stands, but loses a letter if ``SLIP`` divides its hash with the document's id.
    """
    run, low = re.compile(RUN), str.maketrans(UPPER, LOWER)

    def emit(held: Counter) -> Iterator[pa.RecordBatch]:
        words, n = list(held), list(held.values())
        for at in range(0, len(words), 50_000):
            some = [pa.array(words[at : at + 50_000], pa.string()), pa.array(n[at : at + 50_000], pa.int64())]
            yield pa.RecordBatch.from_arrays(some, ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                begun = zlib.crc32(f"{i}:".encode())
                found = Counter(run.findall(text.translate(low)))
                for word in [w for w in found if zlib.crc32(w.encode(), begun) % SLIP == 0]:
                    at = zlib.crc32(word.encode(), begun) % len(word)
                    n, less = found.pop(word), word[:at] + word[at + 1 :]
                    held[less] += n
                held.update(found)
                if len(held) >= BLOCK:
                    yield from emit(held)
                    held = Counter()
        yield from emit(held)

    counted = docs.select(F.col(id_column).cast("string"), text_column).mapInArrow(count, "word string, n long")
    return counted.where(F.length("word") >= LETTERS).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= COUNT)


def _top_counts(word: Column) -> Column:
    """Counts of the letters of the first groups."""
    return F.array(*(F.length(word) - F.length(F.translate(word, group, "")) for group in GROUPS[:TOP]))


def _reached() -> list[list[int]]:
    """Changes of the first counts that a search may make: none, a surplus, and a surplus with a deficit in a later group."""
    out = [[0] * TOP]
    for up in range(TOP):
        out.append([int(k == up) for k in range(TOP)])
        out.extend([int(k == up) - int(k == down) for k in range(TOP)] for down in range(up + 1, TOP))
    return out


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after another, and the words' offsets; all code points are below 256."""
    size = np.asarray(pc.utf8_length(words), np.int64)
    data = np.frombuffer("".join(words.to_pylist()).encode("latin-1"), np.uint8)
    return data, np.concatenate([[0], np.cumsum(size)])


_GROUP = np.full(256, len(GROUPS) - 1)
for _k, _letters in enumerate(GROUPS[:-1]):
    _GROUP[[ord(c) for c in _letters]] = _k


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Letter counts by group of each word."""
    n = len(offsets) - 1
    word = np.repeat(np.arange(n), np.diff(offsets))
    return np.bincount(word * len(GROUPS) + _GROUP[data], minlength=n * len(GROUPS)).reshape(n, len(GROUPS))


def search(stored: np.ndarray, asking: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (positions in ``asking`` and in ``stored``) whose counts differ by a surplus and a deficit of one at most.

    ``stored`` is sorted by its counts; equal beginnings lie together and are the trie's branches. The search goes depth first and takes
    all askers that reach a branch along, each with its budget. The surplus of the stored word must come before the deficit.
    """
    depth = stored.shape[1]
    todo = [(0, 0, len(stored), np.arange(len(asking)), np.zeros(len(asking), np.int8))]
    while todo:
        level, first, last, who, spent = todo.pop()  # spent: 0 nothing, 1 the surplus, 2 both
        while level < depth and stored[first, level] == stored[last - 1, level]:  # the only branch
            by = stored[first, level] - asking[who, level]
            keep = (by == 0) | (by == 1) & (spent == 0) | (by == -1) & (spent == 1)
            who, spent, by = who[keep], spent[keep], by[keep]
            spent = np.where(by == 0, spent, spent + 1).astype(np.int8)
            level += 1
            if not len(who):
                break
        if not len(who):
            continue
        if level == depth:
            yield np.repeat(who, last - first), np.tile(np.arange(first, last), len(who))
            continue
        counts = stored[first:last, level]
        starts = np.flatnonzero(np.r_[True, counts[1:] != counts[:-1]])
        ends = np.r_[starts[1:], last - first]
        own = asking[who, level]
        for a, b in zip(starts.tolist(), ends.tolist()):
            by = counts[a] - own
            keep = (by == 0) | (by == 1) & (spent == 0) | (by == -1) & (spent == 1)
            if keep.any():
                some = np.where(by[keep] == 0, spent[keep], spent[keep] + 1).astype(np.int8)
                todo.append((level + 1, first + a, first + b, who[keep], some))


def one_apart(data: np.ndarray, start: np.ndarray, size: np.ndarray, more: np.ndarray, more_start: np.ndarray, more_size: np.ndarray) -> np.ndarray:
    """Whether words (``size`` code points from ``start`` in ``data``) differ by one letter from words as long or one longer.

    The words' equal beginnings and equal ends must leave one letter of the other word, and at most one of their own.
    """
    head, tail = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    for ahead, count in ((True, head), (False, tail)):
        live = np.arange(len(start))
        step = 0
        while len(live):
            live = live[step < size[live]]
            a = start[live] + (step if ahead else size[live] - 1 - step)
            b = more_start[live] + (step if ahead else more_size[live] - 1 - step)
            live = live[data[a] == more[b]]
            step += 1
            count[live] = step
    longer = more_size - size
    return np.where(longer == 0, head + tail == size - 1, (longer == 1) & (head + tail >= size))


def _pairs(stored: pa.Table, asking: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of near words, each pair once."""
    (a_data, a_at), (s_data, s_at) = _codes(asking["word"].combine_chunks()), _codes(stored["word"].combine_chunks())
    a_vector, s_vector = vectors(a_data, a_at), vectors(s_data, s_at)
    order = np.lexsort(s_vector.T[::-1])
    a_size, s_size = np.diff(a_at), np.diff(s_at)
    a_row, s_row = asking["number"].to_numpy(), stored["number"].to_numpy()
    for who, found in search(s_vector[order], a_vector):
        for at in range(0, len(who), LOOK):
            a, s = who[at : at + LOOK], order[found[at : at + LOOK]]
            longer = s_size[s] - a_size[a]
            # Words with one vector meet twice; the smaller number asks.
            right = (longer == 1) | (longer == 0) & ((a_vector[a] != s_vector[s]).any(axis=1) | (a_row[a] < s_row[s]))
            a, s = a[right], s[right]
            near = one_apart(a_data, a_at[a], a_size[a], s_data, s_at[s], s_size[s])
            yield a[near], s[near]


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of ``words`` (word, n; each word once) that differ by one letter, both ways: word, n, near, near_n."""
    numbered = words.select("word", "n", F.monotonically_increasing_id().alias("number"), _top_counts(F.col("word")).alias("branch"))
    numbered = cut_lineage(numbered)
    changes = F.array(*(F.array(*map(F.lit, c)) for c in _reached()))
    reach = F.transform(changes, lambda c: F.zip_with("branch", c, lambda x, y: x + y))
    # A branch is known by its counts; how many words it has says into how many parts they go.
    sizes = cut_lineage(numbered.groupBy("branch").agg(F.count(F.lit(1)).alias("held")))
    sent = numbered.select("word", "n", "number", F.explode(reach).alias("branch")).join(sizes, "branch")
    asked = sent.groupBy("branch").agg(F.count(F.lit(1)).alias("asked"))
    sizes = cut_lineage(sizes.join(asked, "branch"))
    parts = lambda c: F.ceil(F.col(c) / F.lit(float(PART))).cast("int")
    own = lambda c: F.pmod(F.xxhash64("word"), parts(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), parts(c) - 1))
    stored = numbered.join(sizes, "branch").select("word", "n", "number", "branch", "asked", own("held").alias("part"))
    stored = stored.select("word", "n", "number", "branch", "part", each("asked").alias("asker"))
    asking = sent.drop("held").join(sizes, "branch").select("word", "n", "number", "branch", "held", own("asked").alias("asker"))
    # Columns of their own, as both sides come from one table.
    asking = asking.select(*(F.col(c).alias(c) for c in ("word", "n", "number", "branch", "asker")), each("held").alias("part"))

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            pairs = list(_pairs(left, right))
            s, a = (pa.array(np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64)) for k in (1, 0))
            one, two = (t.select(["word", "n"]).take(x).columns for t, x in ((left, s), (right, a)))
            out = [pa.table([*x, *y], ["word", "n", "near", "near_n"]) for x, y in ((one, two), (two, one))]
        empty = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])
        return pa.concat_tables(x.cast(empty) for x in out) if out else empty.empty_table()

    key = ("branch", "part", "asker")
    kind = "word string, n long, near string, near_n long"
    return stored.groupBy(*key).cogroup(asking.groupBy(*key)).applyInArrow(meet, kind)


def spelling_groups(words: DataFrame) -> DataFrame:
    """Words with the form that they are a variant of: word, form, root, n, n_near, form_n.

    ``words`` has word (letters of the first 256 code points, each word once) and n. Two words are near if they differ by one letter
    inserted, deleted or replaced. A word's form is the near word with the largest n (of several the smallest in order of code points), if
    that is at least twice the word's own; root follows forms to the end. An empty table gives no rows.
    """
    words = cut_lineage(words.select("word", "n"))
    near = near_words(words)
    # Counts are positive, so the smallest of (-n, word) is the form.
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.n")).alias("near_n")
    )
    has = F.col("near_n") >= 2 * F.col("n")
    found = cut_lineage(found.select("word", "n", "n_near", F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")))
    # Each form counts at least twice as often as the word, so a path has at most 63 steps; each round doubles the way followed.
    roots = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = cut_lineage(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if roots.where("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return found.join(roots.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


@query(
    "op13_spelling_variants",
    r"""
    WITH RECURSIVE
         crcs AS (SELECT list(list_reduce(list_concat([k], range(8)), lambda a, _: CASE WHEN a & 1 = 1
                       THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY k) AS crc FROM (SELECT unnest(range(256)) AS k)),
         d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
         r AS (SELECT doc_id, run, count(*) AS n FROM d GROUP BY ALL),
         b AS (SELECT doc_id, run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, 'None') || ':' || run, ''),
                   lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                                  ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END)) AS bytes FROM r),
         h AS (SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], bytes),
                   lambda a, x: xor(a >> 8, crc[(xor(a, x) & 255) + 1])), 4294967295) AS h FROM b, crcs),
         w AS (SELECT CASE WHEN h % 97 <> 0 THEN run
                           ELSE left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) END AS word, n FROM h),
         words AS (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
         -- One byte for each letter, as levenshtein compares bytes.
         plain AS (SELECT word, n, length(word) AS size, translate(word,
                   'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ',
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~') AS ascii FROM words),
         near AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM plain a JOIN plain b
                  ON b.size BETWEEN a.size - 1 AND a.size + 1 AND levenshtein(a.ascii, b.ascii) = 1),
         best AS (SELECT word, count(*) AS n_near, min(struct_pack(n := -near_n, near := near)) AS best FROM near GROUP BY word),
         forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 2 * n THEN best.near END AS form,
                          CASE WHEN -best.n >= 2 * n THEN -best.n END AS form_n FROM words LEFT JOIN best USING (word)),
         way AS (SELECT word, word AS reached, 0 AS step FROM forms
                 UNION ALL SELECT way.word, f.form, step + 1 FROM way JOIN forms f ON f.word = way.reached WHERE f.form IS NOT NULL),
         roots AS (SELECT word, max_by(reached, step) AS root FROM way GROUP BY word)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
    """,
)
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_groups(word_counts(table(spark, folder, "documents")))
