"""Small raw tables with the reference's column names (FIXTURES F1/F2 shapes), built from a rule."""

from pyspark.sql import types as T

from txnscore.schema import FEATURE_FIELDS, SELECTED_FEATURES


def write_reference_raw(spark, txn_path: str, id_path: str, n: int = 40):
    """Write header CSVs of n transactions and a sparse identity table; return the schemas and
    the identity row count. addr1 is null for every fifth row; labels alternate."""
    types = dict(FEATURE_FIELDS)
    ident_cols = [c for c in SELECTED_FEATURES if c.startswith("id_")] + ["DeviceType", "DeviceInfo"]
    txn_cols = [c for c in SELECTED_FEATURES if c not in ident_cols and c not in ("EVENT_TIMESTAMP", "ENTITY_ID")]
    d_cols = [f"D{i}" for i in range(1, 16)]

    def field(name):
        t = {"double": T.DoubleType(), "int": T.IntegerType(), "string": T.StringType()}[types.get(name, "double")]
        return T.StructField(name, t, True)

    txn_schema = T.StructType([T.StructField("TransactionID", T.LongType()), T.StructField("TransactionDT", T.IntegerType())]
                              + [field(c) for c in txn_cols + d_cols] + [T.StructField("isFraud", T.IntegerType())])
    id_schema = T.StructType([T.StructField("TransactionID", T.LongType())] + [field(c) for c in ident_cols])
    txn_rows, id_rows = [], []
    for i in range(n):
        vals = []
        for f in txn_schema.fields[2:-1]:
            if isinstance(f.dataType, T.StringType):
                vals.append(["W", "C", "H"][i % 3] if f.name == "ProductCD" else ["debit", "credit"][i % 2])
            elif isinstance(f.dataType, T.IntegerType):
                vals.append(1000 + i % 7)
            else:
                vals.append(None if (f.name == "addr1" and i % 5 == 0) else float((i * 7 + len(f.name)) % 11))
        txn_rows.append((i, 86400 * (i + 1) + i, *vals, i % 2))
        if i % 3:
            id_rows.append((i, *[float(i % 4) for _ in ident_cols[:-2]], ["mobile", "desktop"][i % 2], f"SM-{i % 3} Build"))
    spark.createDataFrame(txn_rows, txn_schema).write.option("header", "true").csv(txn_path)
    spark.createDataFrame(id_rows, id_schema).write.option("header", "true").csv(id_path)
    return txn_schema, id_schema, id_rows
