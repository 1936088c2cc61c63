"""Checked scans, counts of what is written, keyed buckets, and loads as a stream."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plantmart.operators.reshape import complement_pairs
from plantmart.operators import reshape
from plantmart.plans import jobs, shapes
from plantmart.session import cut_lineage, remove_table, shared_folder, work_path, work_removed
from plantmart.sources import history, stream
from plantmart.sources.files import read_csv
from plantmart.sources.history import upsert
from plantmart.sources.sink import Published, write_table
from plantmart.sources.spec import REJECTED, Field, TableSpec, fields
from plantmart.sources.stream import batch_merger, load_arrived

SPEC = TableSpec(
    fields("Id:id:int", "Name", "At:at:timestamp", "Day:day:date", "Amount:amount:double", Field("Kind", "kind", "int", missing=("nan",), default=0))
)


def test_checked_scan_keeps_what_has_no_value(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "Id,Name,At,Day,Amount,Kind\n1,a,2024-01-01 08:00:00,2024-01-01,1.5,nan\nx1,b,yesterday,2024-13-01,1.5.6,7\n,,, ,,\n3,d,2024-01-01 08:00:00,,9e2,many\n"
    )
    plain = read_csv(spark, str(tmp_path), SPEC)
    found = read_csv(spark, str(tmp_path), SPEC, checked=True)
    assert found.columns == [REJECTED, *plain.columns]
    assert found.drop(REJECTED).collect() == plain.collect()
    assert [r[REJECTED] for r in found.collect()] == [
        None, {"id": "x1", "at": "yesterday", "day": "2024-13-01", "amount": "1.5.6"}, None, {"kind": "many"},
    ]
    counts = write_table(found, str(tmp_path / "out"), figures=SPEC.reject_counts())
    assert counts == {"rows": 4, "rejected_id": 1, "rejected_at": 1, "rejected_day": 1, "rejected_amount": 1, "rejected_kind": 1}
    texts = TableSpec(fields("Name"))
    assert [r[REJECTED] for r in read_csv(spark, str(tmp_path / "t.csv"), texts, checked=True).collect()] == [None] * 4


def jobs_of(spark, work):
    """Number of Spark jobs that ``work`` starts."""
    context, group = spark.sparkContext, f"g{random.random()}"
    context.setJobGroup(group, "test")
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_rows_are_counted_by_the_job_that_writes_them(spark, tmp_path):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("k")).groupBy("k").agg(F.sum("id").alias("s"))
    counted = {}
    plain = jobs_of(spark, lambda: rows.write.parquet(str(tmp_path / "plain")))
    more = jobs_of(spark, lambda: counted.update(write_table(rows, str(tmp_path / "counted"), figures={"s": F.sum("s")})))
    assert counted == {"rows": 7, "s": sum(range(1000))} and more == plain
    assert write_table(rows.filter("k > 9"), str(tmp_path / "none")) == {"rows": 0}
    assert write_table(spark.createDataFrame([], "a int"), str(tmp_path / "empty")) == {"rows": 0}


def test_few_files_without_fewer_tasks(spark, tmp_path):
    rows = spark.range(0, 10_000, 1, 6)
    write_table(rows, str(tmp_path / "few"), few_files=True)
    write_table(rows, str(tmp_path / "many"), most_rows=1000, few_files=True)
    files = lambda name: len(list((tmp_path / name).glob("part-*")))
    assert files("few") == 1 and files("many") >= 10
    assert spark.read.parquet(str(tmp_path / "many")).count() == 10_000


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("part-*")}


def test_a_load_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = spark.range(400).select(F.lit("s").alias("site"), F.col("id").cast("string").alias("k"), F.lit(0).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([("s", None, 0)], "site string, k string, v int"))
    upsert(spark, rows, path, ["site", "k"], ["site"], buckets=32)
    before = files_of(path)
    assert len({f.split("key_bucket_of_32=")[1].split("/")[0] for f in before}) == 32
    load = spark.createDataFrame([("s", "7", 1), ("s", "8", 1), ("s", None, 1), ("s", "new", 1)], "site string, k string, v int")
    stored = upsert(spark, load, path, ["site", "k"], ["site"], buckets=32)
    assert stored.columns == ["site", "k", "v"] and stored.count() == 402
    assert {r.k for r in stored.filter("v = 1").collect()} == {"7", "8", None, "new"}
    touched = load.select(history.key_bucket(["site", "k"], 32)).distinct().count()
    kept = {f for f, t in files_of(path).items() if before.get(f) == t}
    assert len({f.split("key_bucket_of_32=")[1].split("/")[0] for f in kept}) == 32 - touched
    with pytest.raises(ValueError, match="stored columns differ"):
        upsert(spark, load, path, ["site", "k"], ["site"], buckets=16)


def split(rows, seed):
    """The rows in any order, some of them twice, in parts of any size."""
    pick = random.Random(seed)
    rows = rows + pick.sample(rows, len(rows) // 4)
    pick.shuffle(rows)
    cuts = sorted(pick.sample(range(1, len(rows)), pick.choice([1, 3, 6])))
    return [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]


def test_any_split_of_a_stream_is_one_load(spark, tmp_path):
    kind = "site string, k int, release int, v string"
    rows = [(f"s{k % 2}", k % 30 or None, r, f"{k}-{r}") for k in range(45) for r in (1, 2, 3) if (k + r) % 3]
    rows = list({(s, k, r): (s, k, r, v) for s, k, r, v in rows}.values())
    one = spark.createDataFrame(rows, kind)
    want = sorted(map(tuple, upsert(spark, one, str(tmp_path / "one"), ["site", "k"], ["site"], ["release"]).collect()), key=repr)
    for seed, at_once in ((1, None), (2, 1)):
        source, path, checkpoint = (str(tmp_path / f"{x}{seed}") for x in ("in", "h", "c"))
        parts = split(rows, seed)
        load = lambda: load_arrived(
            spark, source, one.schema, path, checkpoint, ["site", "k"], ["site"], ["release"], buckets=4 * (seed == 2), files_at_once=at_once
        )
        for part in parts[:2]:
            spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(source)
        load()
        for part in parts[2:]:
            spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(source)
        stored = load()
        assert sorted(map(tuple, stored.collect()), key=repr) == want
        before = files_of(path)
        assert sorted(map(tuple, load().collect()), key=repr) == want and files_of(path) == before


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "h")
    merge = batch_merger(path, str(tmp_path / "done"), ["k"], [], ["release"], buckets=2)
    batch = spark.createDataFrame([(1, 2, "a"), (2, 1, "b")], "k int, release int, v string")
    merge(batch, 0)
    before = files_of(path)
    merge(batch, 0)
    merge(batch.limit(0), 1)
    assert files_of(path) == before
    # An older release in a later batch is no news.
    merge(spark.createDataFrame([(1, 1, "old"), (3, 1, "c")], batch.schema), 2)
    assert sorted(map(tuple, spark.read.parquet(path).select(*batch.columns).collect())) == [(1, 2, "a"), (2, 1, "b"), (3, 1, "c")]


def test_a_stream_without_files(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, release int").schema
    (tmp_path / "in").mkdir()
    found = load_arrived(spark, str(tmp_path / "in"), schema, str(tmp_path / "h"), str(tmp_path / "c"), ["k"], [], ["release"])
    assert found.schema == schema and found.count() == 0
    assert stream.ARRIVED not in found.columns


def test_complement_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(reshape, "CHUNK", 3)
    pick = random.Random(1)
    values = [f"v{k}" for k in range(11)]
    pairs = {(k, v) for k in ["a", "b", None, "c"] for v in pick.sample(values, pick.choice([1, 5, 11]))} | {("d", None)}
    frame = spark.createDataFrame(sorted(pairs, key=repr) * 2, "k string, v string")
    every = spark.createDataFrame([(v,) for v in [*values, "w", None]], "v string")
    keys = spark.createDataFrame([("e",), ("a",)], "k string")
    want = {(k, v) for k in ["a", "b", None, "c", "d", "e"] for v in [*values, "w"]} - pairs
    got = [tuple(r) for r in complement_pairs(frame, "k", "v", keys, every).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert complement_pairs(frame.limit(0), "k", "v").collect() == []


def test_work_is_removed_when_a_job_fails(spark):
    shared = Path(shared_folder(spark).removeprefix("file:"))
    outer = cut_lineage(spark.range(3))
    before = set(shared.iterdir())
    with pytest.raises(RuntimeError), work_removed(spark):
        cut_lineage(spark.range(5))
        with work_removed(spark):
            spark.range(2).write.parquet(work_path(spark, "inner"))
        raise RuntimeError
    assert set(shared.iterdir()) == before and outer.count() == 3
    remove_table(outer)
    assert len(set(shared.iterdir())) == len(before) - 1


def test_published_shapes_are_complete():
    assert set(shapes.COLUMNS) - set(shapes.SOURCES) == set()
    assert isinstance(Published({}, {}), dict) and jobs.RAW_MOVEMENTS == "sap_mseg"
