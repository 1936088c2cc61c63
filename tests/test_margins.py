"""Margins totalled by group against the rows of the matrix, and what the totals shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plantmart.workload import QUERIES, pricing
from plantmart.workload.registry import Tables

FOLDER = "/root/testdata/sf0.001"


def test_groups_total_the_rows_of_the_matrix(spark):
    t = Tables(spark, FOLDER)
    sums = ["new_cm_abs", "avg_rxcxp_cm_kg_eur", "avg_rxcxp_cm_perc"]
    by = ["rxcxp", "prod_grp", "volume_index", "account_manager", "cust_segment", "country_grp", "yearly_volume_bracket"]
    rows = pricing.matrix(t)["base"].withColumn("firsts", (F.col("instance_rxcxp") == 1).cast("int"))
    rows = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count("avg_rxcxp_cm_perc").alias("figures"), F.sum("firsts").alias("firsts"), *[F.sum(c).alias(c) for c in sums])
    names = [*by, "n", "figures", "firsts", *sums]

    def found(df):
        return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*names).collect()), key=repr)

    want = found(rows)
    assert found(pricing.margin_groups(t)) == want and sum(r[names.index("firsts")] for r in want) > 50


@pytest.mark.parametrize("name", ["margin_matrix", "margin_summaries", "margin_outliers"])
def test_totals_write_no_rows(spark, name, monkeypatch):
    """The stored tables are groups, and no window goes over rows."""
    stored = []
    cut = pricing.margin.cut_lineage
    for module in (pricing, pricing.margin):
        monkeypatch.setattr(module, "cut_lineage", lambda df: stored.append(df) or cut(df))
    QUERIES[name](spark, FOLDER).collect()
    rows = Tables(spark, FOLDER).lineitem.count()
    assert all(df.count() < rows / 2 for df in stored)
    assert not any("Window" in df._jdf.queryExecution().optimizedPlan().toString() for df in stored)
