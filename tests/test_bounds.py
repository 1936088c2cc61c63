"""What bounds a task, and what is computed once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plantmart import session
from plantmart.sources.files import literal_rows
from plantmart.workload import plant, pricing, stored
from plantmart.workload.registry import Tables

FOLDER = "/root/testdata/sf0.001"
NAMES = [*session.TASK_SETTINGS, session.FIRST_PARTITIONS]


@pytest.fixture
def restored(spark):
    before = {name: spark.conf.get(name, None) for name in NAMES}
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_tasks_read_a_bounded_size(restored):
    for name in session.TASK_SETTINGS:
        restored.conf.set(name, "128m")
    restored.conf.unset(session.FIRST_PARTITIONS)
    session.bound_tasks(restored)
    assert [restored.conf.get(n) for n in NAMES] == [f"{session.TASK_BYTES}b"] * 2 + [str(session.LEAST_PARTITIONS)]


def test_smaller_sizes_and_more_partitions_stay(restored):
    for name, value in zip(NAMES, ["1m", "64k", "5000"]):
        restored.conf.set(name, value)
    session.bound_tasks(restored)
    assert [session._bytes(restored.conf.get(n)) for n in NAMES[:2]] == [1 << 20, 64 << 10]
    assert restored.conf.get(NAMES[2]) == "5000"


def test_queries_run_bounded(restored):
    for name in session.TASK_SETTINGS:
        restored.conf.set(name, "128m")
    from plantmart.workload import QUERIES

    QUERIES["batch_rates"](restored, FOLDER)
    assert all(session._bytes(restored.conf.get(n)) <= session.TASK_BYTES for n in session.TASK_SETTINGS)


def test_given_rows_have_a_known_size(spark):
    rows = literal_rows(spark, [("a", 1, 0.5), ("b", None, 2.0)], "k string, n int, x double")
    assert [tuple(r) for r in rows.collect()] == [("a", 1, 0.5), ("b", None, 2.0)]
    assert literal_rows(spark, [], "k string, d date").count() == 0
    assert int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < 1000


@pytest.mark.parametrize("keys", ["step_description", "explanationcategory"])
def test_steps_and_reasons_do_not_deal_out_the_lines(spark, keys):
    """Seven steps and five reasons as keys of an exchange would put all lines into as many tasks."""
    from plantmart.plans import batch

    plan = batch.unit_procedures(plant.batch_inputs(Tables(spark, FOLDER)))._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if f"hashpartitioning({keys}#" in x]


def test_orders_of_the_oee_table_are_computed_once(spark, monkeypatch):
    made = []
    inner = plant.production_orders
    monkeypatch.setattr(plant, "production_orders", lambda t: made.append(1) or inner(t))
    plant.oee_rows(Tables(spark, FOLDER))
    assert len(made) == 1


def test_enrichment_computes_the_products_once(spark, monkeypatch):
    made = []
    inner = pricing.product_tables
    monkeypatch.setattr(pricing, "product_tables", lambda t: made.append(1) or inner(t))
    pricing.product_enrichment(Tables(spark, FOLDER))
    assert len(made) == 1


def test_readings_are_sorted_without_derived_columns(spark):
    plan = plant.readings(Tables(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window [") :]
    assert "ve_machine" in below
    assert not [c for c in ("ve_check", "ve_explanation", "ve_remark", "ve_materialdescription", "materialnumber") if c in below]


def test_movement_files_are_packed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(stored, "FILE_ROWS", 1000)
    made = spark.read.option("header", True).csv(stored._movement_files(Tables(spark, FOLDER)))
    files = made.groupBy(F.input_file_name().alias("file")).count().collect()
    assert files and all(r["file"].endswith(".csv.gz") and r["count"] <= 1000 for r in files)
    assert sum(r["count"] for r in files) == Tables(spark, FOLDER).lineitem.count()
