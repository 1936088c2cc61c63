"""Published shape of the pricing tables: their columns in order, load time and origin."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from ..sources.sink import with_audit

# Published column names, in order, and source labels.
COLUMNS = {
    "fx_rates": "from_currency to_currency first_date exchange_rate",
    "customer_segments": "cust_grp_adj cust_number cust_descrp cust_segment",
    "customers": "cust_grp_adj_id cust_grp_adj cust_size cust_number cust_descrp cust_descrp_chi country_soldto country_grp "
    "cust_classification old_am account_mgr ibg ibg_type cust_region order_cost_eur cust_payment_term base_currency base_unit "
    "condition_type order_cost_base_currency sales_org sales_off sales_off_descrp sales_off_email incoterm1 incoterm2 "
    "average_reb_kg_eur average_frght_kg_eur average_com_kg_eur",
    "customers_missing_mail": "sales_off sales_off_descrp sales_off_email",
    "products": "prod_grp prod_number prod_descrp prod_type unpacked_product_code pfam pfam_descrp pline pline_descrp bu sales_org "
    "volume_index plant_of_origin prod_chemistry vmsta",
    "price_scales": "unique_id cust_number prod_number sales_org scales_qty max_vol valid_from valid_to scales_rate future_valid_from "
    "future_valid_to future_valid_price previous_valid_from previous_valid_to previous_valid_price incoterm1 incoterm2 scale_type "
    "uom uom_scale currency",
    "price_master": "unique_id cust_number prod_number sales_org scales_qty max_vol valid_from valid_to scales_rate future_valid_from "
    "future_valid_to future_valid_price previous_valid_from previous_valid_to previous_valid_price incoterm1 incoterm2 scale_type "
    "currency per uom valid_price_base_currency currency_output uom_output weight_rate_to_apply fx_rate_into_eur cond_type type1 type2",
    "blacklist": "prod_grp sales_org",
    "enriched_products": "prod_grp prod_number prod_descrp prod_type unpacked_product_code pfam pfam_descrp pline pline_descrp bu ibg "
    "ibg_descrp sales_org volume_index plant_of_origin prod_chemistry average_vpc_kg_eur average_cm_kg_eur",
    "products_missing_business": "produced_material ml2",
    "enriched_customers": "cust_grp_adj_id cust_grp_adj cust_size cust_number cust_descrp cust_descrp_chi country_soldto country_grp "
    "cust_classification account_mgr ibg cust_region order_cost_eur cust_payment_term base_currency base_unit condition_type "
    "order_cost_base_currency sales_org sales_off sales_off_descrp sales_off_email incoterm1 incoterm2 average_reb_kg_eur "
    "average_frght_kg_eur average_com_kg_eur",
    "competitiveness": "ms_new chemistry competitive_position_chemistry adjustment_factor_chemistry region "
    "competitive_position_geography adjustment_factor_geography",
    "margin_by_bracket": "volume_bracket percentage",
    "margin_by_segment": "customer_size percentage",
    "margin_by_region": "country_grp percentage",
}
SOURCES = {
    "fx_rates": "sap_p1p_tcurr",
    "customer_segments": "Customer Size classification",
    "customers": "customer_details_mendix",
    "customers_missing_mail": "mapping_sales_off_cwid",
    "customers_data_check": "customer_details_mendix",
    "products": "product_details_mendix",
    "products_data_check": "product_details_mendix",
    "price_scales": "cxp_scale_rate_qty_mendix",
    "price_master": "cxp_master",
    "blacklist": "Mendix blacklist prodgrp salesorg",
    "enriched_products": "product_details_mendix",
    "products_missing_business": "product_ml2",
    "enriched_customers": "customer_details_mendix",
    "competitiveness": "Competitiveness factor",
    "margin_by_bracket": "base_info_for_matrix_volume_brackets",
    "margin_by_segment": "base_info_for_matrix_customer_size",
    "margin_by_region": "base_info_for_matrix_country_grp",
}


def published(tables: Mapping[str, DataFrame], at: Column | None = None) -> dict[str, DataFrame]:
    """The tables in their published shape, with load time and origin where they are published with them.

    ``at`` is the load time; by default that of the query. A check table is its table's shape and the remarks.
    """
    out = {}
    for name, df in tables.items():
        if name in COLUMNS:
            df = df.select(*COLUMNS[name].split())
        out[name] = with_audit(df, SOURCES[name], at) if name in SOURCES else df
    return out
