"""Registered encoder queries: tokens, hashing, indexing, one-hot, assembly, vector averaging."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round6
from ..operators import features as fe
from ..operators import prepare as prep
from ..sources.tables import read_table
from .registry import register
from .views import TXN_COLUMNS, ev, ident, ml_events, txn


@register("tokenize")
def q_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE1: part names split on spaces, one row per token with its position."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return p.select("p_partkey", F.posexplode(fe.tokenize("p_name", " ")).alias("pos", "token"))


@register("hash_tokens")
def q_hash_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE4: entity keys split on '_' and hashed into 1000 buckets; ``buckets`` lists bucket:count by bucket."""
    prepared = prep.prepare(txn(spark, sf_dir), ident(spark, sf_dir), TXN_COLUMNS)
    stages = [fe.tokenizer_stage("entity_id", "entity_tokens", "_"),
              fe.hashing_stage("entity_tokens", "entity_hashed")]
    h = Pipeline(stages=stages).fit(prepared).transform(prepared)
    return h.select("txn_id", "entity_id", F.size("entity_tokens").alias("n_tokens"),
                    fe.vector_entry_sum("entity_hashed").alias("count_sum"),
                    fe.vector_entry_text("entity_hashed").alias("buckets"))


@register("index_categories")
def q_index_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN1/FE5: event types ranked by frequency, ties alphabetical."""
    return fe.category_index_table(ev(spark, sf_dir), "event_type")


@register("one_hot")
def q_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE10: indexed event type -> one-hot (last category dropped): position of the hot bit."""
    e = ev(spark, sf_dir).select("event_id", "event_type")
    model = Pipeline(stages=[fe.indexer_stage(["event_type"]), fe.one_hot_stage(["event_type_indexed"])]).fit(e)
    out = model.transform(e)
    hot = fe.vector_nonzero_indices("event_type_indexed_onehot")
    return out.select("event_id", F.col("event_type_indexed").alias("event_type_index"),
                      F.get(hot, 0).cast("double").alias("hot_index"))


@register("assemble_features")
def q_assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE6: numeric + hashed entity + indexed category -> one vector: width, sum of the entries, positions of
    the entries other than zero, and the sum of the entries times their place (1, 2, ...)."""
    m = ml_events(spark, sf_dir)
    pipe = fe.feature_pipeline(["value", "k"], ["user_bucket"], "entity_id", None)
    out = pipe.fit(m).transform(m)
    return out.select("event_id", fe.vector_width("features").alias("width"),
                      round6(fe.vector_entry_sum("features")).alias("entries_sum"),
                      F.array_join(fe.vector_nonzero_indices("features").cast("array<string>"), ",").alias("positions"),
                      round6(fe.vector_place_sum("features")).alias("place_sum"))


@register("average_vectors")
def q_average_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE3: each user's events point at an embedding (k -> vec_id); average per user, misses
    counted in the divisor."""
    pairs = ev(spark, sf_dir).groupBy("user_id", F.col("k").cast("long").alias("vec_id")).agg(
        F.count(F.lit(1)).alias("c"))
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    avg = fe.average_vectors(pairs, emb, "user_id", "vec_id", "c", "embedding")
    return avg.select("user_id", F.posexplode("avg_vector").alias("dim", "value")).withColumn("value", round6("value"))


@register("word2vec_docs")
def q_word2vec_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE2: Word2Vec (size 20, minCount 1, fixed seed) on part-name tokens; document vectors."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    pipe = Pipeline(stages=[fe.tokenizer_stage("p_name", "tokens", " "),
                            fe.word2vec_stage("tokens", "doc_vector")])
    out = pipe.fit(p).transform(p)
    return out.select("p_partkey", vector_to_array("doc_vector").alias("doc_vector"))


@register("word2vec_averages")
def q_word2vec_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE2 + FE3: document vectors as averages over the fitted vocabulary table, and whether each agrees with
    the model's own document vector (within 1e-6 per entry; MLlib adds in single precision)."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"]).filter("p_name is not null")
    model = Pipeline(stages=[fe.tokenizer_stage("p_name", "tokens", " "), fe.word2vec_stage("tokens", "v")]).fit(p)
    docs = model.transform(p).select("p_partkey", vector_to_array("v").alias("v"))
    counts = (p.select("p_partkey", F.explode(fe.tokenize("p_name", " ")).alias("word"))
              .groupBy("p_partkey", "word").agg(F.count(F.lit(1)).alias("c")))
    vectors = model.stages[-1].getVectors().select("word", vector_to_array("vector").alias("vector"))
    avg = fe.average_vectors(counts, vectors, "p_partkey", "word", "c", "vector")
    near = F.forall(F.zip_with("v", "avg_vector", lambda a, b: F.abs(a - b)), lambda d: d < 1e-6)
    return docs.join(avg, "p_partkey").select("p_partkey", "n_tokens", F.size("avg_vector").alias("width"), near.alias("same_as_model"))
