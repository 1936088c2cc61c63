"""Exchange rates and price scales."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import from_inverted, validity_state
from ..functions.missing import first_valid, number_or_null
from ..functions.units import signed_rate, unit_factor
from ..operators.dedup import first_by, latest_by
from ..operators.joins import neighbours_by_window, only_members
from ..operators.ranking import total_in_front
from ..operators.reshape import with_inverse
from ..session import compile_large_stages, cut_lineage

# Fixed values.
RATE_TYPE = "DM"
BASE_CURRENCY = "EUR"
BASE_UNIT = "KG"
PIECE = "ST"
MASS = "MASS"
CUSTOMER_CONDITIONS = ("YP00", "YP11")
DELETED = "X"
OPEN_END = 1_000_000_000_000.0
FIRST_ID = 880
# Names of the sources a price comes from.
GROUP_SOURCE, CUSTOMER_SOURCE, ITEM_SOURCE, SCALE_SOURCE = "a970", "a701", "konp", "konm"


def fx_rates(rates: DataFrame, factors: DataFrame, as_of: Column) -> DataFrame:
    """Newest rate per currency pair, its inverse, and EUR to EUR.

    ``rates``: fcurr, tcurr, gdatu (inverted date), ukurs, kurst. ``factors``: fcurr, tcurr, ffact, tfact, kurst.
    """
    per_pair = first_by(
        factors.filter((F.col("kurst") == RATE_TYPE) & (F.col("fcurr") == BASE_CURRENCY)).select(
            F.col("tcurr").alias("from_currency"),
            F.col("fcurr").alias("to_currency"),
            F.col("ffact").cast("double").alias("to_fact"),
            F.col("tfact").cast("double").alias("from_fact"),
        ),
        ["from_currency", "to_currency"],
        ["to_fact", "from_fact"],
    )
    quoted = rates.filter(F.col("kurst") == RATE_TYPE).select(
        F.col("fcurr").alias("from_currency"),
        F.col("tcurr").alias("to_currency"),
        from_inverted(F.col("gdatu")).alias("first_date"),
        signed_rate(F.col("ukurs")).alias("rate"),
    )
    # The newest quote first: factors then meet one row per pair.
    newest = latest_by(quoted, ["from_currency", "to_currency"], ["first_date", "rate"])
    to_fact, from_fact = (F.coalesce(c, F.lit(1.0)) for c in ("to_fact", "from_fact"))
    priced = newest.join(per_pair, ["from_currency", "to_currency"], "left").select(
        "from_currency",
        "to_currency",
        F.col("first_date").cast("timestamp").alias("first_date"),
        F.try_divide(F.col("rate") * to_fact, from_fact).alias("exchange_rate"),
    )
    both = with_inverse(priced, "from_currency", "to_currency", "exchange_rate")
    identity = rates.sparkSession.range(1).select(
        F.lit(BASE_CURRENCY).alias("from_currency"),
        F.lit(BASE_CURRENCY).alias("to_currency"),
        as_of.cast("timestamp").alias("first_date"),
        F.lit(1.0).alias("exchange_rate"),
    )
    return both.unionByName(identity)


def mass_factors(units: DataFrame) -> DataFrame:
    """Kilograms per unit: msehi, zaehl, nennr, exp10, dimid -> uom, factor."""
    mass = units.filter(F.col("dimid") == MASS)
    return mass.groupBy(F.col("msehi").alias("uom")).agg(
        F.max(unit_factor(F.col("zaehl"), F.col("nennr"), F.col("exp10"))).alias("factor")
    )


def _unit(column: Column) -> Column:
    return F.when(column.isin("K", "EUR"), BASE_UNIT).otherwise(column)


@dataclass(frozen=True)
class Prices:
    """Priced conditions, and the customers that those of a group hold for.

    ``of_groups``: konda, vkorg, inco1, matnr and what the price says. ``buyers``: konda, vkorg, inco1, kunag and what is known of the
    customer (inco2, ibg, cust_region). ``own``: kunag, vkorg, inco1, matnr and what the price says; ``known`` adds the customer's columns.
    """

    of_groups: DataFrame
    buyers: DataFrame
    own: DataFrame
    known: Callable[[DataFrame], DataFrame]


def price_parts(t: Mapping[str, DataFrame], fx: DataFrame, store: Callable[[DataFrame], DataFrame] = cut_lineage) -> Prices:
    """Price conditions of both sources with scales, units and price per unit.

    ``t``: customer_sales (kunnr, vkorg, vtweg, konda, inco1, inco2), group_conditions (konda, ...),
    customer_conditions (kunag, ...), items (knumh, kstbm, kbetr, kmein, konms, kpein, konwa, loevm_ko), scales
    (knumh, kstbm, kbetr), units, material_units (matnr, meinh, umrez, umren), products, customers.

    Three lookups multiply rows on purpose, as published: a group price holds for each customer of the group, a price for each
    different second delivery term and for each different (line of business, region) of its customer, and for each item and scale.

    What a price says (items, scales, units, rates) is looked up on the conditions of both sources at once and stored (by ``store``,
    which may reduce the rows); a group's conditions meet its customers, with what is known of these, last.
    """
    sales = t["customer_sales"]
    terms = ["inco1", "matnr", "vkorg", "knumh", "datbi", "datab", "kschl"]
    items = t["items"].withColumns({"kbetr": F.col("kbetr").cast("double"), "kstbm": F.col("kstbm").cast("double")})
    item = F.struct(
        F.col("kstbm").alias("kstbm_p"),
        F.col("kbetr").alias("kbetr_p"),
        F.col("kmein").alias("uom_p"),
        F.coalesce(F.nullif("konms", F.lit("")), F.col("kmein")).alias("uom_scale_p"),
        F.col("kpein").cast("double").alias("per_p"),
        F.col("konwa").alias("konwa_p"),
        F.lit(ITEM_SOURCE).alias("type2_p"),
    )
    # The few items of a condition in one row: whether it is in force and what it says then come from one shuffle of the items.
    valid = (F.col("kbetr") != 0) & (F.col("loevm_ko") != DELETED)
    items = items.groupBy("knumh").agg(F.max("loevm_ko").alias("__deleted"), F.collect_list(F.when(valid, item)).alias("__items"))
    scale = t["scales"].select(
        "knumh",
        F.col("kstbm").cast("double").alias("kstbm_m"),
        F.col("kbetr").cast("double").alias("kbetr_m"),
        F.lit(SCALE_SOURCE).alias("type2_m"),
    )
    to_eur = latest_by(
        fx.filter((F.col("from_currency") != BASE_CURRENCY) & (F.col("to_currency") == BASE_CURRENCY)),
        ["from_currency"],
        ["first_date", "exchange_rate"],
    ).select(F.col("from_currency").alias("konwa"), F.col("exchange_rate").alias("__fx"))
    mass = mass_factors(t["units"])
    pieces = t["material_units"].filter(F.col("meinh") == PIECE).groupBy("matnr").agg(
        F.max(F.try_divide(F.col("umrez"), F.col("umren"))).alias("__piece")
    )

    members = t["customers"].select(F.col("cust_number").alias("kunag"), F.col("sales_org").alias("vkorg")).distinct()
    regions = t["customers"].select(F.col("cust_number").alias("kunag"), "ibg", "cust_region").distinct()
    delivery = sales.select(F.col("kunnr").alias("kunag"), "vkorg", "inco1", "inco2").distinct()

    def known(rows: DataFrame) -> DataFrame:
        return rows.join(delivery, ["kunag", "vkorg", "inco1"], "left").join(regions, "kunag", "left")

    of_groups = t["group_conditions"].select("konda", *terms, F.lit(GROUP_SOURCE).alias("type1"))
    by_customer = t["customer_conditions"].filter(F.col("kschl").isin(*CUSTOMER_CONDITIONS))
    own = only_members(by_customer, members, ["kunag", "vkorg"]).select("kunag", *terms, F.lit(CUSTOMER_SOURCE).alias("type1"))
    conditions = only_members(own.unionByName(of_groups, allowMissingColumns=True), t["products"], {"matnr": "prod_number"})
    # A customer's own condition needs an item, and none with the highest mark deleted.
    met = conditions.join(items, "knumh", "left").filter((F.col("type1") == GROUP_SOURCE) | (F.col("__deleted") != DELETED))
    met = met.withColumn("__item", F.explode_outer("__items")).select(*conditions.columns, "__item.*")
    priced = store(_priced(met.join(scale, "knumh", "left"), mass, pieces, to_eur))

    in_group = sales.dropna(subset=["vkorg", "vtweg", "konda"]).select("konda", F.col("kunnr").alias("kunag"))
    offered = t["group_conditions"].select("konda", "vkorg", "inco1").distinct()
    return Prices(
        priced.filter(F.col("type1") == GROUP_SOURCE).drop("kunag"),
        cut_lineage(known(in_group.join(members, "kunag").join(offered, ["konda", "vkorg"]))),
        priced.filter(F.col("type1") == CUSTOMER_SOURCE).drop("konda"),
        known,
    )


def _same_price_group(left: str, right: str) -> Column:
    """Rows of two frames, by their aliases, in one customer group, sales unit and delivery term (which may be missing)."""
    one, other = (lambda c, side=side: F.col(f"{side}.{c}") for side in (left, right))
    return (one("konda") == other("konda")) & (one("vkorg") == other("vkorg")) & one("inco1").eqNullSafe(other("inco1"))


def _priced(rows: DataFrame, mass: DataFrame, pieces: DataFrame, to_eur: DataFrame) -> DataFrame:
    """Conditions with their items and scales, in one price: unit, quantity, currency, rate into EUR."""
    scaled = F.col("type2_m").isNotNull()
    rows = rows.withColumns(
        {
            "uom": _unit(F.coalesce("uom_p", F.when(scaled, BASE_UNIT))),
            "uom_scale": _unit(F.coalesce("uom_scale_p", F.when(scaled, BASE_UNIT))),
            "per": F.coalesce(number_or_null(F.col("per_p")), F.when(scaled, F.lit(1.0))),
            "konwa": F.coalesce("konwa_p", F.when(scaled, BASE_CURRENCY)),
            "kbetr": first_valid(F.col("kbetr_m"), F.col("kbetr_p"), numeric=True),
            "scales_qty": first_valid(F.col("kstbm_m"), F.col("kstbm_p"), numeric=True),
            "type2": F.coalesce("type2_p", "type2_m"),
        }
    )
    rows = (
        rows.join(mass.select("uom", F.col("factor").alias("weight_rate_to_apply")), "uom", "left")
        .join(mass.select(F.col("uom").alias("uom_scale"), F.col("factor").alias("weight_rate_to_apply_scale")), "uom_scale", "left")
        .join(pieces, "matnr", "left")
        .join(to_eur, "konwa", "left")
    )

    def factor(unit: str, column: str) -> Column:
        return F.when(F.col(unit) == PIECE, F.col("__piece")).otherwise(F.col(column))

    rows = rows.withColumns(
        {
            "weight_rate_to_apply": factor("uom", "weight_rate_to_apply"),
            "weight_rate_to_apply_scale": factor("uom_scale", "weight_rate_to_apply_scale"),
            "valid_price_base_currency": F.round(F.try_divide(F.col("kbetr"), F.col("per")), 2),
        }
    )
    rows = rows.withColumns(
        {
            "per": F.col("per") * F.col("weight_rate_to_apply"),
            "fx_rate_into_eur": F.when(F.col("konwa") == BASE_CURRENCY, 1.0).otherwise(F.col("__fx")),
            "valid_from": F.to_date("datab"),
            "valid_to": F.to_date("datbi"),
            "cond_type": F.col("kschl"),
        }
    )
    return rows.drop(
        "knumh", "datab", "datbi", "kschl", "kstbm_p", "kbetr_p", "uom_p", "uom_scale_p", "per_p", "konwa_p", "type2_p", "kstbm_m", "kbetr_m",
        "type2_m", "__piece", "__fx",
    )


SCALE_KEYS = ["kunag", "matnr", "cust_region", "ibg", "inco1"]


def with_next_threshold(base: DataFrame) -> DataFrame:
    """``max_vol``: the next higher scale quantity of the same customer, product, region, group and delivery term.

    Nulls in the key count as a value, so rows without region or group get a threshold too.
    """
    quantity = F.col("scales_qty")
    by = Window.partitionBy(*SCALE_KEYS)
    rows = base.withColumn("__next", F.lead("scales_qty").over(by.orderBy(quantity.asc_nulls_first())))
    # Of rows with one quantity, only the last one is followed by a higher quantity.
    higher = F.max(F.when(~F.col("__next").eqNullSafe(quantity), F.col("__next"))).over(Window.partitionBy(*SCALE_KEYS, "scales_qty"))
    return rows.withColumn("max_vol", F.when(quantity.isNotNull(), F.coalesce(higher, F.lit(OPEN_END)))).drop("__next")


ID_KEYS = ["kunag", "matnr", "inco1"]


def with_ids(base: DataFrame) -> DataFrame:
    """``unique_id``: a dense id per customer, product and delivery term, ascending in that order from ``FIRST_ID``.

    Its place within the customer comes from the customer's own rows; in front of it are the ids of all customers before.
    """
    counts = base.select(*ID_KEYS).repartition("kunag").distinct().groupBy("kunag").agg(F.count(F.lit(1)).alias("__ids"))
    before = total_in_front(counts, ["kunag"], "__ids", "__before")
    within = F.dense_rank().over(Window.partitionBy("kunag").orderBy(*[F.col(c).asc_nulls_first() for c in ID_KEYS[1:]]))
    rows = base.join(before.select("kunag", "__before"), "kunag", "left")
    return rows.withColumn("unique_id", F.col("__before") + within + (FIRST_ID - 1)).drop("__before")


def with_price_states(base: DataFrame, as_of: Column) -> DataFrame:
    """Price in EUR per kilogram, and whether it is past, current or future."""
    rate = F.try_divide(F.col("kbetr"), F.col("per")) * F.col("fx_rate_into_eur")
    return base.withColumns({"rate_eur": rate, "scale_type": validity_state(F.col("valid_from"), F.col("valid_to"), as_of)})


def price_terms(prices: DataFrame) -> DataFrame:
    """Newest price and number of rates (``__rates``) of each kind of terms of a customer."""
    return prices.groupBy("cust_number", "sales_org", "uom", "scale_type", "cond_type").agg(
        F.max("valid_from").alias("valid_from"), F.count("scales_rate").alias("__rates")
    )


def customer_terms(t: Mapping[str, DataFrame], fx: DataFrame, as_of: Column) -> DataFrame:
    """``price_terms`` of the price master without making its rows: a group's prices are reduced before they meet its customers."""
    kind = ["uom", "scale_type", "cond_type"]

    def reduced(rows: DataFrame) -> DataFrame:
        kinds = with_price_states(rows, as_of).groupBy("type1", "konda", "kunag", "vkorg", "inco1", *kind)
        return cut_lineage(kinds.agg(F.max("valid_from").alias("valid_from"), F.count("rate_eur").alias("__rates")))

    parts = price_parts(t, fx, reduced)
    times = parts.buyers.groupBy("konda", "vkorg", "inco1", "kunag").agg(F.count(F.lit(1)).alias("__times"))
    bought = parts.of_groups.alias("o").join(times.alias("b"), _same_price_group("o", "b")).select(
        "b.kunag", "o.vkorg", *kind, "valid_from", (F.col("__rates") * F.col("__times")).alias("__rates")
    )
    both = bought.unionByName(parts.known(parts.own).select(*bought.columns))
    return both.groupBy(F.col("kunag").alias("cust_number"), F.col("vkorg").alias("sales_org"), *kind).agg(
        F.max("valid_from").alias("valid_from"), F.sum("__rates").alias("__rates")
    )


# Products of a list of prices that make one key of the join with its customers.
LIST_CHUNK = 32
NEAR_KEYS = ["kunag", "matnr", "vkorg", "inco1"]


def _with_neighbours(rows: DataFrame, as_of: Column) -> DataFrame:
    """Price rows with validity neighbours, threshold and state."""
    near = neighbours_by_window(rows, NEAR_KEYS, "valid_from", "valid_to", ["valid_price_base_currency"], as_of)
    return with_price_states(with_next_threshold(near), as_of)


def _price_lists(parts: Prices, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Customers with the same groups and sales units share a list of group prices.

    Returns the list of each customer (kunag, list; named by the least of its customers), and the rows of each list with all that
    its own rows say: neighbours, thresholds, states, and ``__rank``, dense by product and delivery term.
    """
    pairs = F.array_sort(F.collect_set(F.struct("konda", "vkorg")))
    groups = parts.buyers.groupBy("kunag").agg(pairs.alias("__pairs"))
    named = groups.groupBy("__pairs").agg(F.min("kunag").alias("list"))
    of_customer = cut_lineage(groups.join(named, "__pairs").select("kunag", "list"))
    offers = named.select("list", F.explode("__pairs").alias("p")).select(F.col("list").alias("kunag"), "p.*")
    no_text = F.lit(None).cast("string")
    rows = parts.of_groups.join(offers, ["konda", "vkorg"]).withColumns({"ibg": no_text, "cust_region": no_text})
    within = Window.partitionBy("kunag").orderBy(*[F.col(c).asc_nulls_first() for c in ID_KEYS[1:]])
    rows = _with_neighbours(rows, as_of).withColumn("__rank", F.dense_rank().over(within))
    return of_customer, cut_lineage(rows.drop("ibg", "cust_region").withColumnRenamed("kunag", "list"))


def _null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equal keys of two frames by their aliases; the last key may be missing and is compared, not joined on."""
    equal = [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys[:-1]]
    last = F.coalesce(F.col(f"{left}.{keys[-1]}").eqNullSafe(F.col(f"{right}.{keys[-1]}")), F.lit(False))
    return reduce(lambda a, b: a & b, [*equal, last])


def _own_keys(own: DataFrame, of_customer: DataFrame, rows: DataFrame) -> DataFrame:
    """Products and delivery terms that customers have prices of their own for, and their place.

    ``__pos``: how many of the keys of the customer's list are lower; ``__listed``: whether the key is one of these; ``__within``: the
    key's place among all keys of the customer, from 1.
    """
    listed = rows.select("list", *ID_KEYS[1:]).distinct().withColumn("__n", F.lit(1))
    keys = cut_lineage(own.select(*ID_KEYS).distinct().join(of_customer, "kunag", "left"))
    asked = keys.filter("list IS NOT NULL").select("list", *ID_KEYS[1:], F.lit(0).alias("__n"))
    both = listed.unionByName(asked).groupBy("list", *ID_KEYS[1:]).agg(F.max("__n").alias("__n"))
    placed = total_in_front(both, ["list", *ID_KEYS[1:]], "__n", "__before")
    starts = placed.groupBy(F.col("list").alias("__list")).agg(F.min("__before").alias("__start"))
    placed = placed.join(starts, F.col("list") == F.col("__list")).withColumn("__pos", F.col("__before") - F.col("__start"))
    found = keys.alias("k").join(placed.alias("p"), _null_safe("k", "p", ["list", *ID_KEYS[1:]]), "left").select(
        *[f"k.{c}" for c in ("list", *ID_KEYS)],
        F.coalesce("__pos", F.lit(0).cast("long")).alias("__pos"), F.coalesce(F.col("__n") == 1, F.lit(False)).alias("__listed"),
    )
    order = Window.partitionBy("kunag").orderBy(*[F.col(c).asc_nulls_first() for c in ID_KEYS[1:]])
    # Keys not in the list, up to this one.
    more = F.sum(F.when(F.col("__listed"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return cut_lineage(found.withColumn("__within", F.col("__pos") + more + F.col("__listed").cast("int")))


def _stretches(keys: DataFrame, buyers: DataFrame) -> DataFrame:
    """Stretches of a customer's list (ranks from ``__low`` to below ``__high``) that no price of the customer's own touches.

    ``__shift``: how many keys outside the list stand before the stretch. ``buyers``: kunag, list, ``__listed_keys``. A stretch lies in one
    chunk of the list.
    """
    cut = F.sequence(F.lit(0), F.floor((F.col("__listed_keys") - 1) / LIST_CHUNK))
    no, yes, more = F.lit(False).alias("__hole"), F.lit(True).alias("__hole"), F.lit(0).alias("__more")
    chunks = buyers.select("kunag", F.explode(cut).alias("c")).select("kunag", (F.col("c") * LIST_CHUNK + 1).alias("__low"), more, no)
    place = F.col("__pos")
    beside = keys.filter("list IS NOT NULL AND NOT __listed").select("kunag", (place + 1).alias("__low"), F.lit(1).alias("__more"), no)
    inside = keys.filter("list IS NOT NULL AND __listed")
    holes = inside.select("kunag", (place + 1).alias("__low"), more, yes).unionByName(inside.select("kunag", (place + 2).alias("__low"), more, no))
    # A narrow row stands for many prices, so small partitions are not put together.
    cuts = chunks.unionByName(beside).unionByName(holes)
    cuts = cuts.repartition(int(cuts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "kunag")
    cuts = cuts.groupBy("kunag", "__low").agg(F.sum("__more").alias("__more"), F.max("__hole").alias("__hole"))
    order = Window.partitionBy("kunag").orderBy("__low")
    found = cuts.withColumns({"__shift": F.sum("__more").over(order), "__high": F.lead("__low").over(order)}).filter("NOT __hole")
    return found.withColumn("__chunk", F.floor((F.col("__low") - 1) / LIST_CHUNK)).drop("__hole", "__more")


def price_rows(parts: Prices, as_of: Column) -> DataFrame:
    """All prices of all customers, each with its id, validity neighbours, threshold and state.

    Group prices are far more than conditions, as each holds for all customers of its group. What neighbours, thresholds and ids depend
    on is the customer's rows of one product and delivery term, and how many such keys come before. Customers of the same groups
    share all of it, so it is found once on their list of prices, and the list meets its customers last, unsorted and unstored. Only
    keys for which a customer has prices of its own are looked at for the customer, together with the group prices of the same key.
    """
    compile_large_stages(parts.own.sparkSession)
    of_customer, rows = _price_lists(parts, as_of)
    keys = _own_keys(parts.own, of_customer, rows)
    sizes = rows.groupBy("list").agg(F.max("__rank").cast("long").alias("__listed_keys"))
    counted = keys.groupBy(F.col("kunag").alias("__kunag")).agg(F.sum(F.when(F.col("__listed"), 0).otherwise(1)).alias("__own_keys"))
    customers = of_customer.join(sizes, "list").join(counted, F.col("kunag") == F.col("__kunag"), "full").select(
        F.coalesce("kunag", "__kunag").alias("kunag"), "list", "__listed_keys",
        (F.coalesce("__listed_keys", F.lit(0)) + F.coalesce("__own_keys", F.lit(0))).alias("__ids"),
    )
    customers = total_in_front(customers, ["kunag"], "__ids", "__before").withColumn("__before", F.col("__before") + (FIRST_ID - 1))

    # Keys with prices of the customer's own.
    inside = keys.filter("__listed").select(*ID_KEYS).alias("k")
    buyers = parts.buyers.alias("b")
    same = (F.col("k.kunag") == F.col("b.kunag")) & F.col("k.inco1").eqNullSafe(F.col("b.inco1"))
    asked = inside.join(buyers, same).select("b.*", F.col("k.matnr").alias("__matnr")).alias("b")
    offers = parts.of_groups.alias("o")
    beside = offers.join(asked, _same_price_group("o", "b") & (F.col("o.matnr") == F.col("b.__matnr")))
    beside = beside.select("o.*", "b.kunag", "b.inco2", "b.ibg", "b.cust_region").drop("konda")
    mixed = parts.known(parts.own).unionByName(beside).alias("m")
    place = keys.join(customers.select("kunag", "__before"), "kunag").select(*ID_KEYS, (F.col("__before") + F.col("__within")).alias("unique_id"))
    mixed = mixed.join(place.alias("k"), _null_safe("m", "k", ID_KEYS)).select("m.*", "unique_id")
    mixed = _with_neighbours(mixed, as_of)

    # Stretches of the lists that the group prices alone decide.
    listed = customers.filter("list IS NOT NULL AND __listed_keys IS NOT NULL")
    spans = _stretches(keys, listed).join(listed.select("kunag", "list", "__before"), "kunag").join(parts.buyers, "kunag").alias("b")
    chunked = rows.withColumn("__chunk", F.floor((F.col("__rank") - 1) / LIST_CHUNK)).alias("o")
    met = (F.col("o.list") == F.col("b.list")) & (F.col("o.__chunk") == F.col("b.__chunk")) & _same_price_group("o", "b")
    met &= (F.col("__rank") >= F.col("__low")) & (F.col("__high").isNull() | (F.col("__rank") < F.col("__high")))
    number = (F.col("__before") + F.col("__shift") + F.col("__rank")).alias("unique_id")
    given = {"kunag", "inco2", "ibg", "cust_region"}
    plain = spans.join(chunked, met).select(
        *[number if c == "unique_id" else F.col(f"{'b' if c in given else 'o'}.{c}") for c in mixed.columns]
    )
    return plain.unionByName(mixed)


def price_tables(t: Mapping[str, DataFrame], fx: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """Price scales in the condition's currency and unit, and the price master in EUR and kilograms."""
    priced = price_rows(price_parts(t, fx), as_of)
    priced = priced.withColumnsRenamed(
        {
            "kunag": "cust_number", "matnr": "prod_number", "vkorg": "sales_org", "inco1": "incoterm1",
            "inco2": "incoterm2", "konwa": "currency",
            "future_valid_price_base_currency": "future_valid_price",
            "previous_valid_price_base_currency": "previous_valid_price",
        }
    )
    shared = [
        "unique_id", "cust_number", "prod_number", "sales_org", "scales_qty", "max_vol", "valid_from", "valid_to",
        "future_valid_from", "future_valid_to", "future_valid_price", "previous_valid_from", "previous_valid_to",
        "previous_valid_price", "incoterm1", "incoterm2", "scale_type", "currency", "uom",
    ]
    in_kg = {c: F.col(c) * F.col("weight_rate_to_apply_scale") for c in ("scales_qty", "max_vol")}
    return {
        "scales": priced.select(*shared, "uom_scale", F.col("valid_price_base_currency").alias("scales_rate")),
        "master": priced.withColumns(in_kg).select(
            *shared, F.col("rate_eur").alias("scales_rate"), F.lit(1).alias("per"), "valid_price_base_currency",
            F.lit(BASE_CURRENCY).alias("currency_output"), F.lit(BASE_UNIT).alias("uom_output"),
            "weight_rate_to_apply", "fx_rate_into_eur", "cond_type", "type1", "type2",
        ),
    }
