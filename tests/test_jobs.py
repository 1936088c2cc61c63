"""Both jobs end to end on generated inputs."""

from __future__ import annotations

import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plantmart.plans import jobs, oee, shapes
from plantmart.plans.inputs import BATCH_FILES, LINE_FILES
from plantmart.session import shared_folder
from plantmart.sources.files import Catalog, scan_sites
from plantmart.workload import pricing
from plantmart.workload.registry import Tables

PATH = {"Enterprise": "E", "Plant": "P", "ProcessCell": "C", "Unit": "U1"}


def write(folder, files, name, rows):
    file, spec = files[name]
    headers = [f.source for f in spec.fields]
    path = folder / file
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as out:
        writer = csv.DictWriter(out, headers, restval="")
        writer.writeheader()
        unknown = {k for r in rows for k in r} - set(headers)
        assert not unknown, unknown
        writer.writerows(rows)


def event(site, recid, time, state, order="", release="1", **more):
    return {
        **PATH, "Site": site, "RecId": recid, "EventTime": time, "RunningState": state, "ProcessOrderNo": order,
        "TargetProdRate": "10" if order else "", "Shift": "OD", "Reason": "r", "ReasonGroupDesc1": "g",
        "ReasonGroupDesc2": "NULL", "Category": "c", "Comment": "why/what", "StepDesc": "s", "StepNumber": "1",
        "TargetDuration": "60", "ReleaseTS": release, "IsProcessed": "true", **more,
    }


def line_site(root, site, events):
    folder = root / "line" / site
    write(folder, LINE_FILES, "availability", events)
    write(folder, LINE_FILES, "rate", [{**PATH, "Site": site, "RecId": 1, "ProcessOrderNo": "100", "StartTS": "2024-01-01 08:00:00", "Capacity": 5, "QuantityProd": 50, "QuantityGood": 50, "RunTime": 60, "DownTime": 0, "ReleaseTS": "1"}])
    order = {**PATH, "Site": site, "ProcessOrderNo": "100", "ProductId": "PR", "MaterialGrade": "G", "MaterialColor": "K", "ActualStartTime": "2024-01-01 06:00:00", "ActualEndTime": "2024-01-02 06:00:00", "FTR_Perc": 90, "QuantityProd": 50, "QuantityRequired": 100, "TargetProdRate": 10, "Bottleneck": "true"}
    write(folder, LINE_FILES, "orders", [{**order, "ReleaseTS": "1", "ProductId": "OLD"}, {**order, "ReleaseTS": "2"}])
    write(folder, LINE_FILES, "readings", [{**PATH, "Site": site, "ProcessOrderNo": "100", "ReleaseTS": "2024-01-01 00:00:00", "ve_machine": "U1", "MaterialNumber": "M9", "ve_dosedscanned": 7, "ve_check": "true"}])
    write(folder, LINE_FILES, "alarms", [
        {**PATH, "Site": site, "KOP": "k", "EventTS": "2024-01-01 09:00:00", "EventType": "hi", "ProcessOrderNo": "100", "ReleaseTS": "2024-01-01 00:00:00"},
        {**PATH, "Site": site, "KOP": "k", "EventTS": "2024-01-01 09:30:00", "EventType": "", "ProcessOrderNo": "100", "ReleaseTS": "2024-01-01 00:00:00"},
    ])
    move = {"AUFNR": "000100", "CHARG": "B1", "MATNR": "M1", "MEINS": "KG", "SHKZG": "S", "BUDAT_MKPF": "2024-01-01", "CPUDT_MKPF": "2024-01-01", "CPUTM_MKPF": "10:11:12"}
    write(folder, LINE_FILES, "movements", [
        {**move, "MBLNR": "1", "ZEILE": "1", "BWART": "101", "MENGE": 50},
        {**move, "MBLNR": "2", "ZEILE": "1", "BWART": "261", "MENGE": 5, "MATNR": "M2"},
        {**move, "MBLNR": "3", "ZEILE": "1", "BWART": "322", "MENGE": 10, "AUFNR": "", "BUDAT_MKPF": "2024-01-08"},
        {**move, "MBLNR": "4", "ZEILE": "1", "BWART": "322", "MENGE": 10, "AUFNR": "", "BUDAT_MKPF": "2024-01-09"},
        {**move, "MBLNR": "5", "ZEILE": "1", "BWART": "309", "MENGE": 10, "AUFNR": "", "CHARG": "B7", "UMCHA": "B1"},
        {**move, "MBLNR": "6", "ZEILE": "1", "BWART": "309", "MENGE": 10, "AUFNR": "", "CHARG": "B7"},
    ])
    write(folder, LINE_FILES, "units", [{**PATH, "Site": site, "default_bottleneck": "true", "MPC": 20}])
    write(folder, LINE_FILES, "categories", [{"Enterprise": "E", "Site": site, "Reason": "r", "reason_group_desc_1": "g", "reason_group_desc_2": "nan", "oee_category": "Operations", "iscosted": "Costed"}])
    write(folder, LINE_FILES, "shifts", [{"Shift": "OD", "Modulo": -m, "shift_letter": "A"} for m in range(14)])


def batch_site(root, site):
    folder = root / "batch" / site

    def facts(sub, number):
        target = folder / sub
        write(target, BATCH_FILES, "procedure", [{"Id": number, "Area": "A", "Production Order": f"9{number}", "Product Name": "X", "Start": "2024-01-01 08:00:00.123", "End": "2024-01-01 12:00:00"}])
        write(target, BATCH_FILES, "yield", [{"Id": 1, "ProcedureId": number, "Actual": 100, "Target": 120}])
        write(target, BATCH_FILES, "unit_procedure", [{"Id": number, "ProcedureId": number, "Name": "n", "Unit": "R1", "Start": "2024-01-01 08:00:00", "End": "2024-01-01 12:00:00"}])
        write(target, BATCH_FILES, "operation", [{"Id": number, "Unit_ProcedureId": number, "Start": "2024-01-01 08:00:00", "End": "2024-01-01 10:00:00", "Name": "mix"}])
        write(target, BATCH_FILES, "operation_duration", [{"OperationId": number, "DurationId": number}])
        write(target, BATCH_FILES, "duration", [{"Id": number, "Actual": 120, "Target": 90, "Loss": 30, "Cost": 0, "GM": 0}])
        write(target, BATCH_FILES, "explanation", [
            {"Id": 1, "Instance": 1, "Loss": 20, "Cost": 1, "Category": "c", "DurationId": number},
            {"Id": 2, "Instance": 2, "Loss": 10, "Cost": 1, "Category": "c", "DurationId": number},
        ])

    facts(".", 1)
    facts("unapproved", 2)
    write(folder, BATCH_FILES, "operations", [{"Step Description": "mix", "Type": "Running", "Step Number": 1}])
    write(folder, BATCH_FILES, "reporting_categories", [{"Category": "c", "Subcategory": "nan", "Group": "nan", "Reporting Category": "External"}])
    write(folder, BATCH_FILES, "equipment", [{"ProcedureArea": "A", "Unit": "R1", "Enterprise": "E", "Site": site, "Plant": "P", "Process Cell": "C", "Bottleneck": "true", "MPC": 10}])
    write(folder, BATCH_FILES, "movements", [{"MBLNR": "8", "ZEILE": "1", "BWART": "101", "AUFNR": "00091", "CHARG": "Z", "MENGE": 9, "MEINS": "LB", "SHKZG": "S", "BUDAT_MKPF": "2024-01-01"}])


@pytest.fixture(scope="module")
def plant(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plant")
    first = [
        event("north", 1, "2024-01-01 07:00:00", "RUNNING", "100"), event("north", 2, "2024-01-01 07:10:00", "DELAY"),
        event("north", 3, "2024-01-01 07:30:00", "IDLE"), event("north", 4, "2024-01-01 08:00:00", "RUNNING", "999"),
    ]
    line_site(root, "north", first)
    line_site(root, "south", [event("south", 1, "2024-01-01 07:00:00", "RUNNING", "100")])
    batch_site(root, "east")
    (root / "settings.csv").write_text("Site,Start Date\nnorth,1-12-2023\n")
    out = root / "out"
    jobs.run_plant_job(spark, str(root), str(out), str(root / "settings.csv"))
    # Second load: the delay is corrected, a later day appears.
    line_site(root, "north", [
        *first[:1], event("north", 5, "2024-01-01 07:10:00", "CHANGE-OVER"), first[2],
        event("north", 6, "2024-01-02 07:00:00", "RUNNING", "100"),
    ])
    jobs.run_plant_job(spark, str(root), str(out), str(root / "settings.csv"))
    return lambda name: spark.read.parquet(f"{out}/{name}")


def test_tables_have_their_published_columns(plant):
    for name, columns in oee.PUBLISHED.items():
        found = plant(name).columns
        assert found[: len(columns.split())] == columns.split()
        assert set(found[len(columns.split()) :]) <= set(oee.ORIGIN)


def test_movement_files_are_read_once_and_work_is_removed(spark, tmp_path, monkeypatch):
    """After the first write of the movements no plan goes back to the files."""
    line_site(tmp_path, "north", [event("north", 1, "2024-01-01 07:00:00", "RUNNING", "100")])
    read, write_outputs = {}, jobs.write_outputs

    def watched(outputs, root):
        read.update({name: df.inputFiles() for name, df in outputs.items()})
        write_outputs(outputs, root)

    monkeypatch.setattr(jobs, "write_outputs", watched)
    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    stored = jobs.run_plant_job(spark, str(tmp_path), str(tmp_path / "out"))
    assert read and not [f for files in read.values() for f in files if LINE_FILES["movements"][0] in f]
    assert set(shared.iterdir()) == before and stored["mseg"].count() > 0


def test_a_scan_of_some_sites(spark, tmp_path):
    for site in ("north", "south"):
        line_site(tmp_path, site, [event(site, 1, "2024-01-01 07:00:00", "RUNNING", "100")])
    file, spec = LINE_FILES["orders"]
    found = scan_sites(spark, str(tmp_path / "line"), file, spec, sites=["south"])
    assert {r.source_site for r in found.collect()} == {"south"} and all("/south/" in f for f in found.inputFiles())


def test_history_keeps_old_events_and_takes_corrections(plant):
    rows = {str(r.event_time)[5:16]: r.running_state for r in plant("history/availability").filter("source_site = 'north'").collect()}
    assert rows == {"01-01 07:00": "RUNNING", "01-01 07:10": "CHANGE-OVER", "01-01 07:30": "IDLE", "01-01 08:00": "RUNNING", "01-02 07:00": "RUNNING"}
    assert [r.productid for r in plant("history/orders").collect()] == ["PR", "PR"]


def test_line_events(plant):
    rows = {str(r.event_time)[5:16]: r for r in plant("availability").filter("site = 'north'").collect()}
    assert rows["01-01 07:00"].process_order_number == "100" and rows["01-01 07:00"].productid == "PR"
    assert rows["01-01 07:00"].duration_s == 600 and rows["01-01 07:00"].available == 600
    # The change-over before an idle spell has no order; an order nobody planned becomes the placeholder.
    assert rows["01-01 07:10"].process_order_number == "0000000"
    assert rows["01-01 08:00"].productid == "UNKNOWN MATERIAL"
    # Durations belong to a load: in the second one the idle spell lasts until the next morning.
    assert rows["01-01 07:30"].runtime_loss == pytest.approx(23.5 * 3600 * 20 / 3600)


def test_batch_events_add_up(plant):
    rows = plant("availability").filter("site = 'east'")
    assert {r.source_status for r in rows.collect()} == {"approved", "unapproved"}
    per_batch = rows.groupBy("source_status").agg(F.sum("duration_s").alias("s")).collect()
    assert {r.s for r in per_batch} == {(90 + 20 + 10) * 60}
    further = rows.filter("running_state = 'IDLE'").orderBy("event_time").select("event_time").distinct().collect()
    assert [str(r[0])[11:16] for r in further] == ["08:20", "09:30"]


def test_genealogy_and_quality(plant):
    lines = plant("mseg").filter("site = 'north'").select("mblnr").collect()
    assert sorted(r[0] for r in lines) == ["1", "2", "3", "4", "5"]
    assert str(plant("mseg").filter("mblnr = '1'").first().entry_ts) == "2024-01-01 10:11:12"
    q1 = {r.process_order_number: (r.produced, r.good, r.q1) for r in plant("q1_summary").collect()}
    # Both sites made order 100: 50 received, 10 blocked on the seventh day, 10 on the eighth.
    assert q1 == {"100": (100.0, 80.0, 0.8), "91": (9.0, 9.0, 1.0)}


def test_summaries_and_consumption(plant):
    oee = plant("oee").filter("site = 'south'").first()
    assert oee.sum_quantity_prod == 50 and oee.sum_quantity_ftr == 45 and oee.sum_quantity_q1 == pytest.approx(40)
    assert {r.bwart: r.ve_dosedscanned for r in plant("ve").filter("site = 'north'").collect()} == {"101": 50.0, "261": 5.0}
    assert plant("opn").count() == 2
    for name in ("po", "rt_ftr", "po_summary", "step_summary", "keys", "mseg_q1"):
        assert plant(name).count() > 0


def test_pricing_job(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    prepared = pricing.transactions(t)
    inputs = {
        **pricing.customer_inputs(t), **pricing.product_inputs(t),
        **{k: v for k, v in pricing.price_inputs(t).items() if k not in ("customers", "products", "customer_sales")},
        "exchange_rates": t.orders.select(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("fcurr"), F.lit("EUR").alias("tcurr"),
            F.lit(79799468).alias("gdatu"), F.col("o_totalprice").alias("ukurs"), F.lit("DM").alias("kurst"),
        ),
        "exchange_factors": spark.createDataFrame([], "fcurr string, tcurr string, ffact int, tfact int, kurst string"),
        "prepared_transactions": prepared,
        "forward_costs": pricing.forward_costs(t),
        "positions": spark.createDataFrame([], "prod_grp string, pg_cost string, pg_cm string"),
        "volume_brackets": spark.createDataFrame([("V1", 0.0, 1e12, "all")], "volume_index string, min double, max double, bracket string"),
        "account_managers": spark.createDataFrame([], "ml2 string, customer string, sales_org string, am_responsible string"),
        "complete_list": prepared.withColumns({"valid_price_kg_eur": F.lit(1.0), "last_transaction_per_cxp": F.lit("Yes")}),
        "competitive_chemistry": spark.createDataFrame([("m", "c", "p")], "ms_new string, chemistry string, competitive_position_chemistry string"),
        "competitive_geography": spark.createDataFrame([("m", "r", "g")], "ms_new string, region_ship_to string, competitive_position_geography string"),
        "chemistry_factors": spark.createDataFrame([("p", 1.0)], "competitive_position_chemistry string, adjustment_factor_chemistry double"),
        "geography_factors": spark.createDataFrame([("g", 2.0)], "competitive_position_geography string, adjustment_factor_geography double"),
    }
    tables = jobs.pricing_tables(Catalog(spark, inputs), F.lit("2001-07-15").cast("timestamp"))
    counts = {name: df.count() for name, df in tables.items()}
    empty = {n for n, c in counts.items() if c == 0}
    assert empty <= {"products_missing_business", "customers_missing_mail", "blacklist"}, empty
    assert counts["price_scales"] == counts["price_master"]
    assert counts["enriched_customers"] == counts["customers"]
    assert counts["margin_base"] == prepared.filter("rolling_12_month = 'Yes'").count()
    for name, df in tables.items():
        audit = ["upload_date", "source_system"] if name in shapes.SOURCES else []
        if name in shapes.COLUMNS:
            assert df.columns == [*shapes.COLUMNS[name].split(), *audit]
        assert df.columns[len(df.columns) - len(audit) :] == audit
        if audit:
            assert {r[0] for r in df.select("source_system").distinct().collect()} <= {shapes.SOURCES[name]}


def test_pricing_job_writes_and_counts(spark, tmp_path, monkeypatch):
    rows = {"fx_rates": spark.range(3).toDF("n"), "blacklist": spark.range(0).toDF("n")}
    monkeypatch.setattr(jobs, "pricing_tables", lambda catalog, as_of, loaded: rows)
    stored = jobs.run_pricing_job(Catalog(spark, {}), F.lit(None), str(tmp_path))
    assert stored.counts == {"fx_rates": {"rows": 3}, "blacklist": {"rows": 0}} and stored["fx_rates"].count() == 3


def test_raw_movements_and_counts_of_a_plant_job(spark, tmp_path):
    line_site(tmp_path, "north", [event("north", 1, "2024-01-01 07:00:00", "RUNNING", "100")])
    batch_site(tmp_path, "east")
    file = tmp_path / "line" / "north" / LINE_FILES["movements"][0]
    file.write_text(file.read_text().replace(",50,", ",fifty,").replace("2024-01-08", "soon"))
    stored = jobs.run_plant_job(spark, str(tmp_path), str(tmp_path / "out"))
    assert {name: df.count() for name, df in stored.items()} == {name: found["rows"] for name, found in stored.counts.items()}
    raw, counts = stored[jobs.RAW_MOVEMENTS], stored.counts[jobs.RAW_MOVEMENTS]
    _, spec = LINE_FILES["movements"]
    assert {f.name for f in spec.fields} <= set(raw.columns)
    assert {r.plant_family for r in raw.collect()} == {"line", "batch"}
    rejected = {k: v for k, v in counts.items() if v and k != "rows"}
    assert rejected == {"rejected_menge": 1, "rejected_budat_mkpf": 1}
    found = {r.mblnr: r.rejected for r in raw.filter("rejected IS NOT NULL").collect()}
    assert found == {"1": {"menge": "fifty"}, "3": {"budat_mkpf": "soon"}}
