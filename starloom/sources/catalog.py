"""Schemas of the 25 raw tables, read by position from delimited files.

Columns follow the published TPC-DS specification.  Adaptations for
Spark: TIME becomes STRING, surrogate keys and ticket/order numbers are
BIGINT (they pass 2^31 at large scale factors), keys are not enforced
(uniqueness is a data test, see :mod:`starloom.operators.datatests`).

Type codes: k bigint key, i int, s string, d date, m decimal(7,2),
g decimal(5,2), c decimal(15,2).
"""

from __future__ import annotations

_TYPES = {"k": "BIGINT", "i": "INT", "s": "STRING", "d": "DATE", "m": "DECIMAL(7,2)",
          "g": "DECIMAL(5,2)", "c": "DECIMAL(15,2)"}

_SPEC = {
    "call_center": "cc_call_center_sk:k cc_call_center_id:s cc_rec_start_date:d cc_rec_end_date:d "
                   "cc_closed_date_sk:k cc_open_date_sk:k cc_name:s cc_class:s cc_employees:i cc_sq_ft:i "
                   "cc_hours:s cc_manager:s cc_mkt_id:i cc_mkt_class:s cc_mkt_desc:s cc_market_manager:s "
                   "cc_division:i cc_division_name:s cc_company:i cc_company_name:s cc_street_number:s "
                   "cc_street_name:s cc_street_type:s cc_suite_number:s cc_city:s cc_county:s cc_state:s "
                   "cc_zip:s cc_country:s cc_gmt_offset:g cc_tax_percentage:g",
    "catalog_page": "cp_catalog_page_sk:k cp_catalog_page_id:s cp_start_date_sk:k cp_end_date_sk:k "
                    "cp_department:s cp_catalog_number:i cp_catalog_page_number:i cp_description:s cp_type:s",
    "catalog_returns": "cr_returned_date_sk:k cr_returned_time_sk:k cr_item_sk:k cr_refunded_customer_sk:k "
                       "cr_refunded_cdemo_sk:k cr_refunded_hdemo_sk:k cr_refunded_addr_sk:k "
                       "cr_returning_customer_sk:k cr_returning_cdemo_sk:k cr_returning_hdemo_sk:k "
                       "cr_returning_addr_sk:k cr_call_center_sk:k cr_catalog_page_sk:k cr_ship_mode_sk:k "
                       "cr_warehouse_sk:k cr_reason_sk:k cr_order_number:k cr_return_quantity:i "
                       "cr_return_amount:m cr_return_tax:m cr_return_amt_inc_tax:m cr_fee:m "
                       "cr_return_ship_cost:m cr_refunded_cash:m cr_reversed_charge:m cr_store_credit:m "
                       "cr_net_loss:m",
    "catalog_sales": "cs_sold_date_sk:k cs_sold_time_sk:k cs_ship_date_sk:k cs_bill_customer_sk:k "
                     "cs_bill_cdemo_sk:k cs_bill_hdemo_sk:k cs_bill_addr_sk:k cs_ship_customer_sk:k "
                     "cs_ship_cdemo_sk:k cs_ship_hdemo_sk:k cs_ship_addr_sk:k cs_call_center_sk:k "
                     "cs_catalog_page_sk:k cs_ship_mode_sk:k cs_warehouse_sk:k cs_item_sk:k cs_promo_sk:k "
                     "cs_order_number:k cs_quantity:i cs_wholesale_cost:m cs_list_price:m cs_sales_price:m "
                     "cs_ext_discount_amt:m cs_ext_sales_price:m cs_ext_wholesale_cost:m cs_ext_list_price:m "
                     "cs_ext_tax:m cs_coupon_amt:m cs_ext_ship_cost:m cs_net_paid:m cs_net_paid_inc_tax:m "
                     "cs_net_paid_inc_ship:m cs_net_paid_inc_ship_tax:m cs_net_profit:m",
    "customer": "c_customer_sk:k c_customer_id:s c_current_cdemo_sk:k c_current_hdemo_sk:k c_current_addr_sk:k "
                "c_first_shipto_date_sk:k c_first_sales_date_sk:k c_salutation:s c_first_name:s c_last_name:s "
                "c_preferred_cust_flag:s c_birth_day:i c_birth_month:i c_birth_year:i c_birth_country:s "
                "c_login:s c_email_address:s c_last_review_date:i",
    "customer_address": "ca_address_sk:k ca_address_id:s ca_street_number:s ca_street_name:s ca_street_type:s "
                        "ca_suite_number:s ca_city:s ca_county:s ca_state:s ca_zip:s ca_country:s "
                        "ca_gmt_offset:g ca_location_type:s",
    "customer_demographics": "cd_demo_sk:k cd_gender:s cd_marital_status:s cd_education_status:s "
                             "cd_purchase_estimate:i cd_credit_rating:s cd_dep_count:i cd_dep_employed_count:i "
                             "cd_dep_college_count:i",
    "date_dim": "d_date_sk:k d_date_id:s d_date:d d_month_seq:i d_week_seq:i d_quarter_seq:i d_year:i d_dow:i "
                "d_moy:i d_dom:i d_qoy:i d_fy_year:i d_fy_quarter_seq:i d_fy_week_seq:i d_day_name:s "
                "d_quarter_name:s d_holiday:s d_weekend:s d_following_holiday:s d_first_dom:i d_last_dom:i "
                "d_same_day_ly:i d_same_day_lq:i d_current_day:s d_current_week:s d_current_month:s "
                "d_current_quarter:s d_current_year:s",
    "dbgen_version": "dv_version:s dv_create_date:d dv_create_time:s dv_cmdline_args:s",
    "household_demographics": "hd_demo_sk:k hd_income_band_sk:k hd_buy_potential:s hd_dep_count:i "
                              "hd_vehicle_count:i",
    "income_band": "ib_income_band_sk:k ib_lower_bound:i ib_upper_bound:i",
    "inventory": "inv_date_sk:k inv_item_sk:k inv_warehouse_sk:k inv_quantity_on_hand:i",
    "item": "i_item_sk:k i_item_id:s i_rec_start_date:d i_rec_end_date:d i_item_desc:s i_current_price:m "
            "i_wholesale_cost:m i_brand_id:i i_brand:s i_class_id:i i_class:s i_category_id:i i_category:s "
            "i_manufact_id:i i_manufact:s i_size:s i_formulation:s i_color:s i_units:s i_container:s "
            "i_manager_id:i i_product_name:s",
    "promotion": "p_promo_sk:k p_promo_id:s p_start_date_sk:k p_end_date_sk:k p_item_sk:k p_cost:c "
                 "p_response_target:i p_promo_name:s p_channel_dmail:s p_channel_email:s p_channel_catalog:s "
                 "p_channel_tv:s p_channel_radio:s p_channel_press:s p_channel_event:s p_channel_demo:s "
                 "p_channel_details:s p_purpose:s p_discount_active:s",
    "reason": "r_reason_sk:k r_reason_id:s r_reason_desc:s",
    "ship_mode": "sm_ship_mode_sk:k sm_ship_mode_id:s sm_type:s sm_code:s sm_carrier:s sm_contract:s",
    "store": "s_store_sk:k s_store_id:s s_rec_start_date:d s_rec_end_date:d s_closed_date_sk:k s_store_name:s "
             "s_number_employees:i s_floor_space:i s_hours:s s_manager:s s_market_id:i s_geography_class:s "
             "s_market_desc:s s_market_manager:s s_division_id:i s_division_name:s s_company_id:i "
             "s_company_name:s s_street_number:s s_street_name:s s_street_type:s s_suite_number:s s_city:s "
             "s_county:s s_state:s s_zip:s s_country:s s_gmt_offset:g s_tax_precentage:g",
    "store_returns": "sr_returned_date_sk:k sr_return_time_sk:k sr_item_sk:k sr_customer_sk:k sr_cdemo_sk:k "
                     "sr_hdemo_sk:k sr_addr_sk:k sr_store_sk:k sr_reason_sk:k sr_ticket_number:k "
                     "sr_return_quantity:i sr_return_amt:m sr_return_tax:m sr_return_amt_inc_tax:m sr_fee:m "
                     "sr_return_ship_cost:m sr_refunded_cash:m sr_reversed_charge:m sr_store_credit:m "
                     "sr_net_loss:m",
    "store_sales": "ss_sold_date_sk:k ss_sold_time_sk:k ss_item_sk:k ss_customer_sk:k ss_cdemo_sk:k "
                   "ss_hdemo_sk:k ss_addr_sk:k ss_store_sk:k ss_promo_sk:k ss_ticket_number:k ss_quantity:i "
                   "ss_wholesale_cost:m ss_list_price:m ss_sales_price:m ss_ext_discount_amt:m "
                   "ss_ext_sales_price:m ss_ext_wholesale_cost:m ss_ext_list_price:m ss_ext_tax:m "
                   "ss_coupon_amt:m ss_net_paid:m ss_net_paid_inc_tax:m ss_net_profit:m",
    "time_dim": "t_time_sk:k t_time_id:s t_time:i t_hour:i t_minute:i t_second:i t_am_pm:s t_shift:s "
                "t_sub_shift:s t_meal_time:s",
    "warehouse": "w_warehouse_sk:k w_warehouse_id:s w_warehouse_name:s w_warehouse_sq_ft:i w_street_number:s "
                 "w_street_name:s w_street_type:s w_suite_number:s w_city:s w_county:s w_state:s w_zip:s "
                 "w_country:s w_gmt_offset:g",
    "web_page": "wp_web_page_sk:k wp_web_page_id:s wp_rec_start_date:d wp_rec_end_date:d wp_creation_date_sk:k "
                "wp_access_date_sk:k wp_autogen_flag:s wp_customer_sk:k wp_url:s wp_type:s wp_char_count:i "
                "wp_link_count:i wp_image_count:i wp_max_ad_count:i",
    "web_returns": "wr_returned_date_sk:k wr_returned_time_sk:k wr_item_sk:k wr_refunded_customer_sk:k "
                   "wr_refunded_cdemo_sk:k wr_refunded_hdemo_sk:k wr_refunded_addr_sk:k "
                   "wr_returning_customer_sk:k wr_returning_cdemo_sk:k wr_returning_hdemo_sk:k "
                   "wr_returning_addr_sk:k wr_web_page_sk:k wr_reason_sk:k wr_order_number:k "
                   "wr_return_quantity:i wr_return_amt:m wr_return_tax:m wr_return_amt_inc_tax:m wr_fee:m "
                   "wr_return_ship_cost:m wr_refunded_cash:m wr_reversed_charge:m wr_account_credit:m "
                   "wr_net_loss:m",
    "web_sales": "ws_sold_date_sk:k ws_sold_time_sk:k ws_ship_date_sk:k ws_item_sk:k ws_bill_customer_sk:k "
                 "ws_bill_cdemo_sk:k ws_bill_hdemo_sk:k ws_bill_addr_sk:k ws_ship_customer_sk:k "
                 "ws_ship_cdemo_sk:k ws_ship_hdemo_sk:k ws_ship_addr_sk:k ws_web_page_sk:k ws_web_site_sk:k "
                 "ws_ship_mode_sk:k ws_warehouse_sk:k ws_promo_sk:k ws_order_number:k ws_quantity:i "
                 "ws_wholesale_cost:m ws_list_price:m ws_sales_price:m ws_ext_discount_amt:m "
                 "ws_ext_sales_price:m ws_ext_wholesale_cost:m ws_ext_list_price:m ws_ext_tax:m "
                 "ws_coupon_amt:m ws_ext_ship_cost:m ws_net_paid:m ws_net_paid_inc_tax:m "
                 "ws_net_paid_inc_ship:m ws_net_paid_inc_ship_tax:m ws_net_profit:m",
    "web_site": "web_site_sk:k web_site_id:s web_rec_start_date:d web_rec_end_date:d web_name:s "
                "web_open_date_sk:k web_close_date_sk:k web_class:s web_manager:s web_mkt_id:i web_mkt_class:s "
                "web_mkt_desc:s web_market_manager:s web_company_id:i web_company_name:s web_street_number:s "
                "web_street_name:s web_street_type:s web_suite_number:s web_city:s web_county:s web_state:s "
                "web_zip:s web_country:s web_gmt_offset:g web_tax_percentage:g",
}

TABLE_NAMES = tuple(sorted(_SPEC))

# primary keys (dropped by the loader, checked as data)
PRIMARY_KEYS = {
    "call_center": ("cc_call_center_sk",), "catalog_page": ("cp_catalog_page_sk",),
    "catalog_returns": ("cr_item_sk", "cr_order_number"), "catalog_sales": ("cs_item_sk", "cs_order_number"),
    "customer": ("c_customer_sk",), "customer_address": ("ca_address_sk",),
    "customer_demographics": ("cd_demo_sk",), "date_dim": ("d_date_sk",),
    "household_demographics": ("hd_demo_sk",), "income_band": ("ib_income_band_sk",),
    "inventory": ("inv_date_sk", "inv_item_sk", "inv_warehouse_sk"), "item": ("i_item_sk",),
    "promotion": ("p_promo_sk",), "reason": ("r_reason_sk",), "ship_mode": ("sm_ship_mode_sk",),
    "store": ("s_store_sk",), "store_returns": ("sr_item_sk", "sr_ticket_number"),
    "store_sales": ("ss_item_sk", "ss_ticket_number"), "time_dim": ("t_time_sk",),
    "warehouse": ("w_warehouse_sk",), "web_page": ("wp_web_page_sk",),
    "web_returns": ("wr_item_sk", "wr_order_number"), "web_sales": ("ws_item_sk", "ws_order_number"),
    "web_site": ("web_site_sk",),
}


def columns(table: str) -> list[tuple[str, str]]:
    """[(column, SQL type)] in file order."""
    out = []
    for token in _SPEC[table].split():
        name, code = token.split(":")
        out.append((name, _TYPES[code]))
    return out


def ddl(table: str) -> str:
    """Spark DDL column list, e.g. ``a BIGINT, b STRING``."""
    return ", ".join(f"{n} {t}" for n, t in columns(table))


def schema(table: str):
    """The table's StructType."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl(table))


def create_tables_sql(database: str, location: str | None = None) -> list[str]:
    """CREATE TABLE IF NOT EXISTS statements for all 25 tables (parquet)."""
    out = [f"CREATE DATABASE IF NOT EXISTS {database}"]
    for t in TABLE_NAMES:
        loc = f" LOCATION '{location.rstrip('/')}/{t}'" if location else ""
        out.append(f"CREATE TABLE IF NOT EXISTS {database}.{t} ({ddl(t)}) USING parquet{loc}")
    return out


# fixed values: exact row counts of the 25 raw tables at scale factor 1
SF1_ROW_COUNTS = {
    "call_center": 6, "catalog_page": 11718, "catalog_returns": 144067, "catalog_sales": 1441548,
    "customer": 100000, "customer_address": 50000, "customer_demographics": 1920800, "date_dim": 73049,
    "dbgen_version": 1, "household_demographics": 7200, "income_band": 20, "inventory": 11745000,
    "item": 18000, "promotion": 300, "reason": 75, "ship_mode": 20, "store": 12, "store_returns": 287514,
    "store_sales": 2880404, "time_dim": 86400, "warehouse": 5, "web_page": 60, "web_returns": 71763,
    "web_sales": 719384, "web_site": 30,
}
