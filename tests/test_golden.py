"""Golden values from the sample input and scored messages (FIXTURES F5)."""

import math

from pyspark.ml import Pipeline
from pyspark.sql import Row
from pyspark.sql import functions as F

from txnscore.functions.columns import entity_key, event_timestamp, probability_from_margin
from txnscore.operators import features as fe
from txnscore.operators.prepare import column_roles
from txnscore.schema import FEATURE_SCHEMA, string_columns


def test_entity_key_and_timestamp(spark):
    df = spark.createDataFrame([Row(card1=10409, addr1=170.0, TransactionDT=18403224, D1=419.0)])
    r = df.select(entity_key("card1", "addr1", "TransactionDT", "D1").alias("e"),
                  event_timestamp("TransactionDT").alias("t")).first()
    assert r.e == "10409_170.0_-206"
    assert r.t == 1627902149


def test_tokens_and_hash_buckets(spark):
    df = spark.createDataFrame([Row(ENTITY_ID="10409_170.0_-206")])
    stages = [fe.tokenizer_stage("ENTITY_ID", "tok", "_"), fe.hashing_stage("tok", "h", 1000)]
    out = Pipeline(stages=stages).fit(df).transform(df)
    r = out.select("tok", fe.vector_nonzero_indices("h").alias("idx"), fe.vector_entry_sum("h").alias("s")).first()
    assert r.tok == ["10409", "170.0", "-206"]
    assert sorted(r.idx) == [342, 624, 908]
    assert r.s == 3.0


def test_vector_entries_as_text_and_by_place(spark):
    """Counts by bucket, zeros left out, the same for sparse and dense vectors; an empty vector is an empty text."""
    from pyspark.ml.linalg import Vectors
    rows = [(0, Vectors.sparse(6, [1, 4], [2.0, 1.0])), (1, Vectors.dense([0.0, 2.0, 0.0, 0.0, 1.0, 0.0])),
            (2, Vectors.sparse(6, [], [])), (3, Vectors.sparse(6, [1, 4], [0.0, 3.0]))]
    df = spark.createDataFrame(rows, ["id", "v"])
    got = {r.id: (r.t, r.s) for r in df.select("id", fe.vector_entry_text("v").alias("t"), fe.vector_place_sum("v").alias("s")).collect()}
    assert got == {0: ("1:2,4:1", 9.0), 1: ("1:2,4:1", 9.0), 2: ("", 0.0), 3: ("4:3", 15.0)}


def test_event_time_of_the_numeric_timestamp(spark):
    import datetime as dt
    from txnscore.functions.columns import event_time
    df = spark.createDataFrame([(1627902149.0,), (0.0,), (-0.5,), (None,)], "t double")
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = [r.e for r in df.select(event_time("t").alias("e")).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == [dt.datetime(2021, 8, 2, 11, 2, 29), dt.datetime(1970, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59), None]


def test_probability_from_margin(spark):
    p1 = spark.range(1).select(probability_from_margin(F.lit(-1.4997453800075105)).alias("p")).first().p
    assert math.isclose(1 - p1, 0.9525511157580744, rel_tol=1e-12)


def test_reference_layout_width_1065(spark):
    """62 numeric inputs + 1000 hashed + 3 indexed; hashed block starts at offset 62."""
    roles = column_roles(FEATURE_SCHEMA)
    numeric = [c for c, r in roles.items() if r == "assemble"]
    index_cols = [c for c in string_columns(FEATURE_SCHEMA) if c not in ("DeviceInfo", "ENTITY_ID")]
    assert len(numeric) == 62 and index_cols == ["ProductCD", "card6", "DeviceType"]
    values = {f.name: 0.0 for f in FEATURE_SCHEMA.fields}
    values.update(card1=10409, ENTITY_ID="10409_170.0_-206", ProductCD="W", card6="debit",
                  DeviceType="mobile", DeviceInfo="SM-G950F Build/NRD90M")
    row = {f.name: (int(values[f.name]) if f.dataType.simpleString() == "int" else values[f.name])
           for f in FEATURE_SCHEMA.fields}
    df = spark.createDataFrame([row], FEATURE_SCHEMA)
    pipe = fe.feature_pipeline(numeric, index_cols, "ENTITY_ID", "DeviceInfo")
    out = pipe.fit(df).transform(df)
    r = out.select(fe.vector_width("features").alias("w"), fe.vector_nonzero_indices("features").alias("nz")).first()
    assert r.w == 1065
    assert {404, 686, 970} <= set(r.nz)
    # the Word2Vec document vector exists (size 20) but is not assembled
    assert out.select(fe.vector_width("DeviceInfoVector")).first()[0] == 20


def test_relational_average_equals_word2vec_transform(spark):
    """FE3 against FE2: averaging the fitted word vectors per document (relational form, misses
    in the divisor) gives MLlib's Word2Vec document vectors."""
    from pyspark.ml.functions import vector_to_array
    from conftest import SF_SMALL
    from txnscore.sources.tables import read_table
    parts = read_table(spark, SF_SMALL, "part", ["p_partkey", "p_name"])
    model = Pipeline(stages=[fe.tokenizer_stage("p_name", "tokens", " "),
                             fe.word2vec_stage("tokens", "v", vector_size=8, min_count=2)]).fit(parts)
    w2v = model.stages[-1]
    docs = model.transform(parts).select("p_partkey", vector_to_array("v").alias("v"))
    counts = (parts.select("p_partkey", F.explode(fe.tokenize("p_name", " ")).alias("word"))
              .groupBy("p_partkey", "word").agg(F.count(F.lit(1)).alias("c")))
    vectors = w2v.getVectors().select("word", vector_to_array("vector").alias("vector"))
    avg = fe.average_vectors(counts, vectors, "p_partkey", "word", "c", "vector")
    got = {r.p_partkey: r.avg_vector for r in avg.collect()}
    want = {r.p_partkey: r.v for r in docs.collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(a, b, abs_tol=1e-6) for k in want for a, b in zip(got[k], want[k]))
