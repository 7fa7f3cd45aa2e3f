"""Schemas, column lists and the fixed values the scoring semantics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference application's for identical results).
# ---------------------------------------------------------------------------------------------
# Processed feature table: 67 nullable fields, in the order of the typed schema.
FEATURE_FIELDS = [
    ("TransactionAmt", "double"), ("EVENT_TIMESTAMP", "double"), ("ENTITY_ID", "string"),
    ("ProductCD", "string"), ("card1", "int"), ("card2", "double"), ("card3", "double"),
    ("card5", "double"), ("card6", "string"), ("addr1", "double"), ("dist1", "double"),
    ("C1", "double"), ("C2", "double"), ("C4", "double"), ("C5", "double"), ("C6", "double"),
    ("C7", "double"), ("C8", "double"), ("C9", "double"), ("C10", "double"), ("C11", "double"),
    ("C12", "double"), ("C13", "double"), ("C14", "double"),
    ("V62", "double"), ("V70", "double"), ("V76", "double"), ("V78", "double"), ("V82", "double"),
    ("V91", "double"), ("V127", "double"), ("V130", "double"), ("V139", "double"),
    ("V160", "double"), ("V165", "double"), ("V187", "double"), ("V203", "double"),
    ("V207", "double"), ("V209", "double"), ("V210", "double"), ("V221", "double"),
    ("V234", "double"), ("V257", "double"), ("V258", "double"), ("V261", "double"),
    ("V264", "double"), ("V266", "double"), ("V267", "double"), ("V271", "double"),
    ("V274", "double"), ("V277", "double"), ("V283", "double"), ("V285", "double"),
    ("V289", "double"), ("V291", "double"), ("V294", "double"),
    ("id_01", "double"), ("id_02", "double"), ("id_05", "double"), ("id_06", "double"),
    ("id_09", "double"), ("id_13", "double"), ("id_17", "double"), ("id_19", "double"),
    ("id_20", "double"), ("DeviceType", "string"), ("DeviceInfo", "string"),
]
# Base epoch added to the transaction second offset (2021-01-01 11:02:05 UTC).
BASE_EPOCH_SECONDS = 1609498925
SECONDS_PER_DAY = 24 * 60 * 60
# Day-offset columns D1..D15: these are shifted by the transaction day; 1, 2, 3, 5 and 9 are not.
OFFSET_COLUMNS = ["D4", "D6", "D7", "D8", "D10", "D11", "D12", "D13", "D14", "D15"]
ENTITY_DAY_COLUMN = "D1"
# Fill values for missing data.
STRING_FILL = "unknown"
NUMERIC_FILL = 0
# Encoders.
HASH_BUCKETS = 1000
WORD2VEC_SIZE = 20
WORD2VEC_MIN_COUNT = 1
WORD2VEC_PARTITIONS = 4
DEVICE_TOKEN_SEPARATOR = " "
ENTITY_TOKEN_SEPARATOR = "_"
# Scoring.
HIGH_RISK_THRESHOLD = 0.4
FRAUD_PREDICTION = 1.0
# Batch-duration histogram bucket upper bounds, seconds (+Inf is implied).
DURATION_BUCKETS = [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 30.0, 60.0]
# Dashboard threshold bands: below 100 green, from 100 yellow, from 500 red.
BAND_WARN = 100
BAND_CRIT = 500
# Training.
SPLIT_SEED = 1409
GBT_SPLIT = [0.7, 0.3]
RF_SPLIT = [0.8, 0.2]
GRID_MAX_DEPTH = [5, 8, 12]
GRID_MAX_BINS = [32, 64]
GRID_STEP_SIZE = [0.05, 0.1, 0.2]
RF_NUM_TREES = 100
RF_MAX_DEPTH = 12
RF_MAX_BINS = 32
# Stream sink trigger.
SINK_TRIGGER = "10 seconds"
# Columns kept by the preparation step, in output order (label appended when present).
SELECTED_FEATURES = [
    "TransactionAmt", "EVENT_TIMESTAMP", "ENTITY_ID", "ProductCD", "DeviceType", "DeviceInfo",
    "addr1", "dist1", "card1", "card2", "card3", "card5", "card6",
    "C1", "C2", "C4", "C5", "C6", "C7", "C8", "C9", "C10", "C11", "C12", "C13", "C14",
    "V62", "V70", "V76", "V78", "V82", "V91", "V127", "V130", "V139", "V160", "V165", "V187",
    "V203", "V207", "V209", "V210", "V221", "V234", "V257", "V258", "V261", "V264", "V266",
    "V267", "V271", "V274", "V277", "V283", "V285", "V289", "V291", "V294",
    "id_01", "id_02", "id_05", "id_06", "id_09", "id_13", "id_17", "id_19", "id_20",
]
LABEL = "isFraud"
# ---------------------------------------------------------------------------------------------


_TYPES = {"double": T.DoubleType(), "int": T.IntegerType(), "string": T.StringType(),
          "long": T.LongType(), "boolean": T.BooleanType()}


def struct_of(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in fields])


FEATURE_SCHEMA = struct_of(FEATURE_FIELDS)
TRAINING_SCHEMA = struct_of(FEATURE_FIELDS + [(LABEL, "int")])


def string_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


# Declared schemas of the driver tables (no inference pass on read).
DRIVER_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

# Declared types of the raw transaction / identity columns the preparation reads (by name).
RAW_TYPES = {
    **{n: t for n, t in FEATURE_FIELDS if n not in ("EVENT_TIMESTAMP", "ENTITY_ID")},
    "TransactionID": "long", "TransactionDT": "int", LABEL: "int",
    **{f"D{i}": "double" for i in range(1, 16)},
}

# JSON payload carried by events.props.
PROPS_SCHEMA = "k INT"
