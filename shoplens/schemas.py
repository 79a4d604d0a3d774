"""Schemas of the model tables (the shapes the operators consume)."""

from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.TimestampNTZType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.ArrayType(T.LongType())),
    T.StructField("order_product_ids", T.ArrayType(T.LongType())),
    T.StructField("pay_category_ids", T.ArrayType(T.LongType())),
    T.StructField("pay_product_ids", T.ArrayType(T.LongType())),
    T.StructField("city_id", T.LongType()),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("sex", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_AREA = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

AD_LOG = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("userid", T.LongType()),
    T.StructField("adid", T.LongType()),
])


# Declared schemas of the input tables. Reading with a declared schema skips
# footer sampling for inference (which on a large table touches many files
# on the driver) and fails fast when a table's layout drifts.
INPUT_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}
