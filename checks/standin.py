"""A scored population made from the test tables.

Orders stand for scored applications, customers for applicants, line items for features. Some values
are turned into nulls, bad text or malformed JSON, because the test tables have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bandloom import Metadata

METADATA = Metadata(
    score_cuts=[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    fills={"sum_qty": -1.0, "max_discount": 0.0, "n_items": 1.0, "acctbal": 0.0, "totalprice": 0.0},
    feature_cuts={
        "sum_qty": [0.0, 20.0, 80.0, 150.0, 400.0],
        "max_discount": [0.0, 0.05, 0.1],
        "n_items": [2.0, 5.0],
        "acctbal": [-1000.0, 0.0, 1000.0, 2500.0, 2500.0, 5000.0, 7500.0, 10000.0],
    },
)
SEGMENT_NAMES = [
    "employment_type",
    "bureau_score",
    "tenure",
    "bureau_vintage",
    "no_of_cc_loan_entries",
    "active_cc_count",
    "active_pl_count",
    "unsecured_enquiries_in_last_1_mon",
    "months_since_last_90_dpd",
]
ALL_METRICS = {
    "PSI": ["score", "total_population"],
    "DRIFT_IN_MB": ["total_population", "fa", "ca", "d1", "d2", "ca/fa", "d1/fa"],
    "CSI": list(METADATA.feature_cuts),
    "FEATURE_RANGE_DRIFT": list(METADATA.feature_cuts),
    "NULL_RATE": "all_features",
    "DISTINCT_RATE": "all_features",
    "SEGMENT_DISTRIBUTION": SEGMENT_NAMES,
    "INVALID_SCORE": None,
}


# Schemas of the test tables, so that opening one needs no job to read a file footer.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def item_features(spark: SparkSession, folder: str) -> DataFrame:
    """Three features of an order, from its line items."""
    items = table(spark, folder, "lineitem").groupBy("l_orderkey")
    return items.agg(
        F.expr("CAST(count(*) AS DOUBLE) AS n_items"),
        F.expr("sum(l_quantity) AS sum_qty"),
        F.expr("max(l_discount) AS max_discount"),
    )


# The population's columns, from an order (o_), its customer (c_) and its line items.
COLUMNS = {
    "id": "o_orderkey",
    "ref_no": "o_custkey",
    "created_at": "o_orderdate",
    "platform": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'APP_A' "
    "WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'APP_B' ELSE 'WEB_AGG' END",
    "user_type": "if(c_mktsegment IN ('BUILDING', 'MACHINERY'), 'REPEAT', 'NEW')",
    "output_value": "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN 0D "
    "ELSE (o_totalprice - 5000D) / 450000D END",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'FINAL_APPROVED' WHEN 'O' THEN 'COND_APPROVED' "
    "ELSE if(o_orderkey % 2 = 0, 'DENIED_1', 'DENIED_2') END",
    "employment_type": "CASE WHEN o_orderkey % 11 = 0 THEN 'none' WHEN o_orderkey % 13 = 0 THEN ' ' "
    "WHEN o_orderkey % 17 != 0 THEN c_mktsegment END",
    "bureau_score": "if(o_orderkey % 19 = 0, 'n/a', string(680 + c_custkey % 100))",
    "tenure": "double(o_orderkey % 12)",
    "bureau_vintage": "double(c_custkey % 90)",
    "no_of_cc_loan_entries": "double(o_orderkey % 4 - 1)",
    "unsecured_enquiries_in_last_1_mon": "double(o_orderkey % 14)",
    "months_since_last_90_dpd": "double(c_custkey % 16)",
    "bureau_json": "CASE WHEN o_orderkey % 23 = 0 THEN 'bad' WHEN o_orderkey % 29 != 0 THEN "
    """concat('{"active_cc_count": ', o_orderkey % 4, ', "active_pl_count": "', o_orderkey % 8, '"}') END""",
    "acctbal": "c_acctbal",
    "totalprice": "o_totalprice",
}
ITEM_COLUMNS = ["n_items", "sum_qty", "max_discount"]


def scored(spark: SparkSession, folder: str, items: bool = True) -> DataFrame:
    """One row per order. Queries that use no line-item feature leave that join out."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    df = orders.join(customer, F.expr("o_custkey = c_custkey"))
    if items:
        df = df.join(item_features(spark, folder), F.expr("o_orderkey = l_orderkey"), "left")
    columns = [f"{value} AS {name}" for name, value in COLUMNS.items()]
    return df.selectExpr(*columns, *(ITEM_COLUMNS if items else []))
