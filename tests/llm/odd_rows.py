"""Odd rows, and plain Python answers that several tests use."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import types as T

LONG = 200_000

# A null in each column, empty and blank texts, one very long text, repeated rows, equal texts, and a row without id.
TEXTS = [
    (1, "The cat sat on the mat and looked at the dog.\nIt was a fine day."),
    (2, "The cat sat on the mat and looked at the dog.\nIt was a fine day."),
    (3, "The  cat sat on the mat\tand looked at the dog.\nIt was a fine day."),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "word"),
    (7, "word"),
    (8, "buy!! NOW!! $$$ ### " * 40),
    (9, "lorem ipsum dolor sit amet " * (LONG // 27)),
    (10, "Éléphant straße ÿ £5 漢字 é 'll don't <|endoftext|> 🙂"),
    (None, "a text without an id"),
    (None, "The cat sat on the mat and looked at the dog.\nIt was a fine day."),
    (11, "one two three four five six seven eight nine ten eleven twelve thirteen"),
    (12, "one two three four five six seven eight nine ten eleven twelve fourteen"),
]
# Extra columns whose names operators use themselves.
CLASHES = ["id", "n", "node", "kept", "keep_id", "score", "text_sha256", "pieces", "rank", "bucket", "norm", "gram", "row"]


def documents(spark, rows=TEXTS, extra=CLASHES):
    kind = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
         T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in extra]
    )
    return spark.createDataFrame([(i, t, None, None, None, *["x"] * len(extra)) for i, t in rows], kind)

WORD = r"[^\x20\x09-\x0D]+"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(WORD, (text or "").translate(LOW))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def near_components(rows, width, percent):
    """Set size, smallest linked id and number of equal sets of each row, by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    group = list(range(len(rows)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group[top(a)] = top(b)
    least = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(k) and rows[j][0] is not None]
        least.append(min(ids) if ids and sets[k] else i)
    count = Counter(s for s in sets if s)
    return [len(s) for s in sets], least, [count[s] if s else 1 for s in sets]
