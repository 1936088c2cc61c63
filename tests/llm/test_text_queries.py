"""The registered queries on driver tables: against SQL, and held-out figures of what is learned."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def queries():
    import __spark_entry__ as contract

    return contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op3_license_scans", "op10_exact_dedup", "op11_source_divergence", "op12_exact_top_k", "op13_spelling_variants"])
def test_query_agrees_with_sql(ready, con, queries, name):
    found, sql = queries
    frame = found[name](ready, FOLDER)
    answer = con.execute(f"SELECT {', '.join(frame.columns)} FROM ({sql[name]})").fetchall()
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(answer, key=repr)


def area(scores, marks):
    order = np.argsort(scores)
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    good = marks == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_of_held_out_documents(ready, con, queries):
    got = {r["doc_id"]: r for r in queries[0]["op1_line_quality"](ready, FOLDER).collect()}
    rows = [(got[i], q) for i, q in con.execute("SELECT doc_id, quality FROM labels").fetchall() if got[i]["held_out"]]
    assert area(np.array([r["score"] for r, _ in rows]), np.array([q for _, q in rows])) > 0.98
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_language_model_beats_its_base(ready, queries):
    rows = [r for r in queries[0]["op7_language_model"](ready, FOLDER).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.85 * sum(r["base_score"] for r in rows)


def test_packing_pads_little(ready, queries):
    rows = queries[0]["op8_packing"](ready, FOLDER).collect()
    total: dict[int, int] = {}
    for r in rows:
        total[r["sequence_id"]] = total.get(r["sequence_id"], 0) + r["length"]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in total.values())
    assert padding < 0.01 * sum(total.values())


def test_all_are_registered(queries):
    found, sql = queries
    assert sorted(int(q[2:].split("_")[0]) for q in found if q.startswith("op") and q[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in found and set(sql) <= set(found)
