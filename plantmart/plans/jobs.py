"""End-to-end jobs: read declared inputs, build lazy result tables, write them in a thin runner."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reshape import value_list
from ..session import cut_lineage, work_removed
from ..sources.files import Catalog, path_exists, read_csv, scan_optional_sites, scan_sites
from ..sources.history import upsert
from ..sources.sink import Published, write_outputs, write_table
from ..sources.spec import REJECTED
from . import batch, customers, line, margin, movements, oee, prices, products, shapes
from .common import ORDER, PATH, movement_orders
from .inputs import BATCH_FACTS, BATCH_FILES, LINE_FILES, MOVEMENTS, SETTINGS

SITE = "source_site"
FAMILY = "plant_family"
RAW_MOVEMENTS = "sap_mseg"
# Orders and readings have no day that a later release keeps, so their histories are divided by a hash of the key.
KEY_BUCKETS = 64
APPROVED, UNAPPROVED = "approved", "unapproved"
DAY_PARTITIONS = [SITE, "calendar_day"]


def site_settings(spark: SparkSession, path: str) -> DataFrame:
    """site, start_date from a settings file with day-month-year dates."""
    rows = read_csv(spark, path, SETTINGS)
    return rows.select("site", F.try_to_date("start_date_text", "d-M-yyyy").alias("start_date"))


def read_line_inputs(spark: SparkSession, root: str, shared_movements: str | None = None) -> dict[str, DataFrame]:
    """All line-plant inputs, one scan per file kind over every site folder below ``root``.

    ``shared_movements`` names one movements file for all sites instead of one per site.
    """
    out = {}
    for name, (file, spec) in LINE_FILES.items():
        if name == "movements" and shared_movements is not None:
            out[name] = read_csv(spark, shared_movements, spec, checked=True)
        else:
            out[name] = scan_sites(spark, root, file, spec, SITE, checked=name == "movements")
    out["shifts"] = out["shifts"].withColumnRenamed(SITE, "site")
    for name in ("units", "categories"):
        out[name] = out[name].drop(SITE)
    return out


def read_batch_inputs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All batch-plant inputs; an ``unapproved`` sub-folder of a site is a second, optional source of facts."""
    out = {}
    for name, (file, spec) in BATCH_FILES.items():
        frame = scan_sites(spark, root, file, spec, SITE, checked=name == "movements")
        if name in BATCH_FACTS:
            second = scan_optional_sites(spark, root, f"unapproved/{file}", spec, SITE)
            frame = frame.withColumn("source_status", F.lit(APPROVED)).unionByName(
                second.withColumn("source_status", F.lit(UNAPPROVED))
            )
        out[name] = frame
    return out


def publish_movements(spark: SparkSession, families: Mapping[str, Mapping[str, DataFrame]], path: str) -> dict[str, int]:
    """Write the raw movements of all plants, typed, with all their columns and the texts that no value could be made of.

    The files are parsed once: the families' movements are read back from this table. Returns its rows and the rejects by column.
    """
    raw = [inputs["movements"].withColumn(FAMILY, F.lit(name)) for name, inputs in families.items()]
    whole = raw[0]
    for more in raw[1:]:
        whole = whole.unionByName(more, allowMissingColumns=True)
    counts = write_table(whole, path, [FAMILY], figures=MOVEMENTS.reject_counts())
    for name, inputs in families.items():
        mine = spark.read.schema(whole.schema).parquet(path).filter(F.col(FAMILY) == name)
        inputs["movements"] = movement_orders(mine.select([c for c in inputs["movements"].columns if c != REJECTED]))
    return counts


def store_line_history(
    spark: SparkSession, inputs: Mapping[str, DataFrame], history_root: str, settings: DataFrame | None
) -> dict[str, DataFrame]:
    """Merge one load into the five history tables and return the stored tables.

    Availability, rates and alarms are kept per site and production day, so a load rewrites only its own days.
    Orders and readings may move to another day with a later release and are kept per site and bucket of the key, so a load rewrites
    only the buckets of its keys.
    """
    root = history_root.rstrip("/")
    steps = {
        "availability": (line.clean_availability(inputs["availability"]), [*PATH, "event_time"], DAY_PARTITIONS),
        "rate": (line.newest_rates(inputs["rate"]), [*PATH, ORDER, "start_ts"], DAY_PARTITIONS),
        "orders": (line.newest_orders(inputs["orders"], settings), [*PATH, ORDER], [SITE]),
        "readings": (line.newest_readings(inputs["readings"]), [*PATH, ORDER, "ve_machine"], [SITE]),
        "alarms": (line.newest_alarms(inputs["alarms"]), [*PATH, "kop", "eventts"], DAY_PARTITIONS),
    }
    return {
        name: upsert(spark, new, f"{root}/{name}", [SITE, *keys], partitions, buckets=0 if partitions == DAY_PARTITIONS else KEY_BUCKETS)
        for name, (new, keys, partitions) in steps.items()
    }


def line_tables(
    stored: Mapping[str, DataFrame], inputs: Mapping[str, DataFrame], settings: DataFrame | None
) -> dict[str, DataFrame]:
    """Result tables of the line plants from stored history and current movements."""
    scope = [SITE] if SITE in inputs["movements"].columns else []
    orders, moved = stored["orders"], inputs["movements"]
    availability = line.availability_table(
        stored["availability"], orders, inputs["units"], inputs["categories"], inputs["shifts"], settings
    )
    rates = line.rate_table(stored["rate"], orders, inputs["units"], settings)
    wanted = movements.bottleneck_orders(orders, scope)
    return {
        "availability": availability,
        "rate": rates,
        "orders": orders,
        "oee": oee.oee_table(availability, rates, capacity_from_events=True),
        "consumption": movements.consumption(stored["readings"], wanted, moved, scope),
        "movements": movements.genealogy(wanted, moved, scope=scope),
        "quality_movements": movements.quality_movements(wanted, moved, scope),
        "quality_summary": movements.quality_summary(wanted, moved, scope),
        "alarms": line.alarm_table(stored["alarms"], orders, settings),
    }


def batch_tables(inputs: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Result tables of the batch plants, approved and unapproved rows side by side (``source_status``).

    The unit procedures feed all tables; they are written to the shared folder once.
    """
    inputs = batch.with_shared_parents(inputs)
    procedures = cut_lineage(batch.unit_procedures(inputs))
    availability = batch.availability_table(batch.hierarchy(inputs), procedures)
    rates = batch.rate_table(procedures)
    orders = batch.order_table(procedures)
    approved = orders.filter(F.col("source_status") == APPROVED) if "source_status" in orders.columns else orders
    scope = [SITE] if SITE in orders.columns else []
    wanted = approved.select(
        *scope, *PATH, "calendar_day", ORDER, "productid", "bottleneck", "logsheet_number"
    ).distinct()
    moved = inputs["movements"]
    return {
        "availability": availability,
        "rate": rates,
        "orders": orders,
        "oee": oee.oee_table(availability, rates, capacity_from_events=False),
        "movements": movements.genealogy(wanted, moved, per_order=True, scope=scope),
        "quality_movements": movements.quality_movements(wanted, moved, scope),
        "quality_summary": movements.quality_summary(wanted, moved, scope),
    }


def combined(*families: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Both plant families in one table per name; columns only one family has are null for the other."""
    out: dict[str, DataFrame] = {}
    for family in families:
        for name, df in family.items():
            out[name] = df if name not in out else out[name].unionByName(df, allowMissingColumns=True)
    return out


def plant_outputs(tables: Mapping[str, DataFrame], refreshed: Column | None = None) -> dict[str, DataFrame]:
    """The published tables in their published shape: output measures, keys, and the summaries.

    ``refreshed`` is the load time that alarms and consumption carry.
    """
    t = tables
    refreshed = F.current_timestamp() if refreshed is None else refreshed
    sums = t["quality_summary"].groupBy(ORDER).agg(F.sum("produced").alias("produced"), F.sum("good").alias("good"))
    q1 = cut_lineage(movements.with_quality_ratio(sums))
    out = {
        "availability": oee.availability_output(t["availability"]),
        "mseg": oee.movement_output(t["movements"]),
        "mseg_q1": oee.quality_output(t["quality_movements"]),
        "oee": oee.oee_output(oee.with_quality_split(t["oee"], q1)),
        "po": oee.order_output(t["orders"]),
        "rt_ftr": oee.rate_output(t["rate"]),
    }
    if "alarms" in t:
        out["opn"] = oee.alarm_output(t["alarms"]).withColumn("data_refresh_dt", refreshed)
    if "consumption" in t:
        out["ve"] = oee.consumption_output(t["consumption"]).withColumn("data_refresh_dt", refreshed)
    return {
        **{name: oee.published(name, df) for name, df in out.items()},
        "q1_summary": q1,
        "po_summary": oee.order_summary(t["oee"]),
        "step_summary": oee.step_summary(t["availability"]),
        "keys": oee.key_calendar(t["oee"]),
    }


def run_plant_job(
    spark: SparkSession, source: str, destination: str, settings_path: str | None = None,
    shared_movements: str | None = None,
) -> Published:
    """Line plants below ``source/line/<site>``, batch plants below ``source/batch/<site>`` (optional).

    Returns the stored tables, with the rows of each as counted while it was written, and the rejects of the raw movements. What the job
    wrote to the shared folder on the way is removed at its end.
    """
    with work_removed(spark):
        counts = _plant_job(spark, source, destination, settings_path, shared_movements)
    return Published({name: spark.read.parquet(f"{destination.rstrip('/')}/{name}") for name in counts}, counts)


def _plant_job(
    spark: SparkSession, source: str, destination: str, settings_path: str | None, shared_movements: str | None
) -> dict[str, dict[str, int]]:
    settings = None if settings_path is None else site_settings(spark, settings_path)
    inputs = read_line_inputs(spark, f"{source}/line", shared_movements)
    second = read_batch_inputs(spark, f"{source}/batch") if path_exists(spark, f"{source}/batch/*") else None
    # The largest input is parsed once; several tables read it, and it is published itself.
    both = {"line": inputs} if second is None else {"line": inputs, "batch": second}
    raw = publish_movements(spark, both, f"{destination.rstrip('/')}/{RAW_MOVEMENTS}")
    stored = store_line_history(spark, inputs, f"{destination}/history", settings)
    families = [line_tables(stored, inputs, settings)]
    if second is not None:
        families.append(batch_tables(second))
    tables = combined(*families)
    # The two tables most others are built from are computed once.
    tables["availability"] = cut_lineage(tables["availability"])
    tables["oee"] = cut_lineage(tables["oee"])
    outputs = plant_outputs(tables)
    counts = write_outputs(outputs, destination)
    return {**{name: (counts or {}).get(name, {}) for name in outputs}, RAW_MOVEMENTS: raw}


def run_pricing_job(catalog: Catalog, as_of: Column, destination: str, loaded: Column | None = None) -> Published:
    """Write all pricing tables below ``destination``; returns them with the rows of each as counted while it was written.

    What the job wrote to the shared folder on the way is removed at its end.
    """
    spark = catalog.spark
    with work_removed(spark):
        counts = write_outputs(pricing_tables(catalog, as_of, loaded), destination)
    return Published({name: spark.read.parquet(f"{destination.rstrip('/')}/{name}") for name in counts}, counts)


def pricing_tables(catalog: Catalog, as_of: Column, loaded: Column | None = None) -> dict[str, DataFrame]:
    """All pricing tables in dependency order and published shape; ``catalog`` names the inputs listed in each function.

    Tables that several others read (rates, both dimensions, positions, prices, the matrix rows) are written to the shared folder
    once; the rest stays lazy. ``loaded`` is the load time that published tables carry (by default that of the query).
    """
    def pick(*names: str) -> dict[str, DataFrame]:
        return {n: catalog(n) for n in names}

    fx = cut_lineage(prices.fx_rates(catalog("exchange_rates"), catalog("exchange_factors"), as_of))
    sized = customers.segments(pick("transactions", "group_mapping", "customer_sales", "customer_master"), as_of)
    dimension = customers.customer_dimension(
        {
            **pick(
                "customer_sales", "customer_master", "transactions", "group_mapping", "scope", "classification",
                "addresses", "countries", "districts", "offices", "country_groups", "order_cost", "mails", "sales_orgs",
            ),
            "segments": sized,
            "fx": fx,
        }
    )
    dimension["customers"] = cut_lineage(dimension["customers"])
    goods = products.product_dimension(
        pick(
            "materials", "hierarchy_texts", "sales_status", "product_types", "volume_index", "material_plants",
            "plants", "sales_orgs",
        )
    )
    goods["products"] = cut_lineage(goods["products"])
    offered = {
        **pick(
            "customer_sales", "group_conditions", "customer_conditions", "items", "scales", "units",
            "material_units",
        ),
        "products": goods["products"],
        "customers": dimension["customers"],
    }
    priced = prices.price_tables(offered, fx, as_of)
    prepared = catalog("prepared_transactions")
    # One column per sales unit: the table's header comes from the products.
    units = value_list(goods["products"], "sales_org")
    positions = cut_lineage(
        products.positioning(prepared, goods["products"], catalog("forward_costs"), catalog("positions"), units)
    )
    enriched = products.enriched_products(goods["products"], positions, prepared, catalog("scope"))
    matrix = margin.margin_matrix(
        prepared, catalog("volume_index"), catalog("volume_brackets"), catalog("account_managers")
    )
    tables = {
        "fx_rates": fx,
        "customer_segments": sized,
        "customers": dimension["customers"],
        "customers_missing_mail": dimension["missing_mail"],
        "customers_data_check": dimension["data_check"],
        "products": goods["products"],
        "products_data_check": goods["data_check"],
        "price_scales": priced["scales"],
        "price_master": priced["master"],
        "positioning": positions,
        "blacklist": products.blacklist(goods["products"], prepared),
        "enriched_products": enriched["products"],
        "products_missing_business": enriched["missing_business"],
        "enriched_customers": customers.enriched_customers(
            dimension["customers"], catalog("complete_list"), prices.customer_terms(offered, fx, as_of), as_of
        ),
        "competitiveness": products.competitiveness(
            catalog("competitive_chemistry"), catalog("competitive_geography"),
            catalog("chemistry_factors"), catalog("geography_factors"),
        ),
        **{f"margin_{name}": df for name, df in matrix.items()},
    }
    return shapes.published(tables, loaded)
