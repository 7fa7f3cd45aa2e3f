"""Feature encoders (FE1-FE10, WN1) as MLlib stages in one Pipeline, plus relational forms.

Tokenizing is a ``SQLTransformer`` (JVM ``split``) so the whole chain - tokens, Word2Vec,
HashingTF, StringIndexer, VectorAssembler - is one fitted, saved and reloaded artifact shared by
training and streaming.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (HashingTF, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler,
                                Word2Vec)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import (DEVICE_TOKEN_SEPARATOR, ENTITY_TOKEN_SEPARATOR, HASH_BUCKETS, SPLIT_SEED,
                      WORD2VEC_MIN_COUNT, WORD2VEC_PARTITIONS, WORD2VEC_SIZE)
from .ordering import global_row_index


# --- FE1 ----------------------------------------------------------------------------------------

def tokenize(col: str | Column, separator: str = DEVICE_TOKEN_SEPARATOR) -> Column:
    """``split`` on a regex separator, as the reference does (empty strings are kept)."""
    return F.split(F.col(col) if isinstance(col, str) else col, separator)


def tokenizer_stage(input_col: str, output_col: str, separator: str) -> SQLTransformer:
    sep = separator.replace("\\", "\\\\").replace("'", "\\'")
    return SQLTransformer(statement=f"SELECT *, split(`{input_col}`, '{sep}') AS `{output_col}` FROM __THIS__")


# --- FE2 / FE4 / FE5 / FE6 / FE10 stages --------------------------------------------------------

def word2vec_stage(input_col: str, output_col: str, vector_size: int = WORD2VEC_SIZE,
                   min_count: int = WORD2VEC_MIN_COUNT, seed: int = SPLIT_SEED,
                   num_partitions: int = WORD2VEC_PARTITIONS, max_iter: int = 1) -> Word2Vec:
    """Document vector = sum of known word vectors / number of tokens (unknown ones included).

    ``num_partitions`` is part of the model: the vectors depend on it, so it is a parameter saved
    with the stage and never follows the cluster or the input files. MLlib's own default (1)
    trains every sentence in one task. The vocabulary (words seen ``min_count`` times or more)
    times the vector size is what MLlib keeps on the driver; ``min_count`` bounds it.
    """
    w2v = Word2Vec(inputCol=input_col, outputCol=output_col, vectorSize=vector_size, minCount=min_count,
                   seed=seed, maxIter=max_iter, numPartitions=num_partitions)
    return w2v


def hashing_stage(input_col: str, output_col: str, buckets: int = HASH_BUCKETS) -> HashingTF:
    """Term counts in ``buckets`` murmur3 buckets (MLlib's hash, not SQL ``hash()``)."""
    return HashingTF(inputCol=input_col, outputCol=output_col, numFeatures=buckets)


def indexer_stage(input_cols: list[str], handle_invalid: str = "skip", suffix: str = "_indexed") -> StringIndexer:
    """One multi-column indexer: frequency descending, ties alphabetical; unseen/null -> skip."""
    return StringIndexer(inputCols=input_cols, outputCols=[c + suffix for c in input_cols],
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def one_hot_stage(input_cols: list[str], suffix: str = "_onehot", drop_last: bool = True) -> OneHotEncoder:
    return OneHotEncoder(inputCols=input_cols, outputCols=[c + suffix for c in input_cols], dropLast=drop_last)


def assembler_stage(input_cols: list[str], output_col: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=input_cols, outputCol=output_col, handleInvalid=handle_invalid)


def feature_pipeline(numeric_cols: list[str], index_cols: list[str], entity_col: str | None,
                     text_col: str | None, use_text_vector: bool = False, buckets: int = HASH_BUCKETS,
                     features_col: str = "features", word2vec_partitions: int = WORD2VEC_PARTITIONS) -> Pipeline:
    """FE7/FE8: tokens -> Word2Vec -> HashingTF -> StringIndexer -> VectorAssembler.

    Assembler order follows the reference: numeric columns, hashed entity, indexed categories;
    the Word2Vec vector is computed but only assembled when ``use_text_vector``.
    """
    stages, assembled = [], list(numeric_cols)
    if text_col:
        stages += [tokenizer_stage(text_col, f"{text_col}Tokens", DEVICE_TOKEN_SEPARATOR),
                   word2vec_stage(f"{text_col}Tokens", f"{text_col}Vector", num_partitions=word2vec_partitions)]
    if entity_col:
        stages += [tokenizer_stage(entity_col, f"{entity_col}_tokens", ENTITY_TOKEN_SEPARATOR),
                   hashing_stage(f"{entity_col}_tokens", f"{entity_col}_hashed", buckets)]
        assembled.append(f"{entity_col}_hashed")
    if index_cols:
        stages.append(indexer_stage(index_cols))
        assembled += [c + "_indexed" for c in index_cols]
    if text_col and use_text_vector:
        assembled.append(f"{text_col}Vector")
    stages.append(assembler_stage(assembled, features_col))
    return Pipeline(stages=stages)


# --- vector inspection without densifying -------------------------------------------------------

def vector_parts(vec: str | Column) -> Column:
    """The stored form of an MLlib vector (sparse: size/indices/values; dense: values) as a
    struct; cost follows the non-zeros, not the width."""
    return F.unwrap_udt(F.col(vec) if isinstance(vec, str) else vec)


def vector_width(vec: str | Column) -> Column:
    p = vector_parts(vec)
    return F.coalesce(p.getField("size"), F.size(p.getField("values")))


def vector_entry_sum(vec: str | Column) -> Column:
    return F.aggregate(vector_parts(vec).getField("values"), F.lit(0.0), lambda a, x: a + x)


def vector_nonzero_indices(vec: str | Column) -> Column:
    """Indices of non-zero entries (sparse indices, or positions of non-zeros if dense)."""
    p = vector_parts(vec)
    dense_nz = F.filter(F.sequence(F.lit(0), F.size(p.getField("values")) - 1),
                        lambda i: F.element_at(p.getField("values"), i + 1) != 0)
    return F.when(p.getField("type") == 0, p.getField("indices")).otherwise(dense_nz)


def vector_nonzeros(vec: str | Column) -> Column:
    """Array of structs (i, x) of the non-zero entries, by index."""
    p = vector_parts(vec)
    at = F.coalesce(p.getField("indices"), F.transform(p.getField("values"), lambda _, i: i))
    pairs = F.transform(at, lambda i, k: F.named_struct(F.lit("i"), i, F.lit("x"), F.get(p.getField("values"), k)))
    return F.filter(pairs, lambda e: e["x"] != 0)


def vector_entry_text(vec: str | Column) -> Column:
    """Non-zero entries of a vector of counts as text: ``index:count``, comma-joined by index."""
    return F.array_join(F.transform(vector_nonzeros(vec), lambda e: F.concat_ws(":", e["i"].cast("string"), e["x"].cast("long").cast("string"))), ",")


def vector_place_sum(vec: str | Column) -> Column:
    """Sum of the entries, each times its place (the first counts once), so that two entries that change
    places change the sum."""
    return F.aggregate(vector_nonzeros(vec), F.lit(0.0), lambda s, e: s + (e["i"] + 1) * e["x"])


# --- relational forms ---------------------------------------------------------------------------

def category_index_table(df: DataFrame, col: str) -> DataFrame:
    """WN1: the indexer's label order as a table: count descending, label ascending, index
    0.. as double. The ranking is a distributed global index, not a one-task window."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    ranked = global_row_index(counts, [F.col("n").desc(), F.col(col).asc()], "__idx")
    return ranked.select(col, "n", F.col("__idx").cast("double").alias(f"{col}_index"))


def average_vectors(token_counts: DataFrame, vectors: DataFrame, key: str, token: str, count: str,
                    vector: str) -> DataFrame:
    """FE3: per ``key``, sum of the vectors of its tokens / number of its tokens (tokens with no
    vector count in the divisor, like Word2Vec's transform). ``token_counts`` is pre-aggregated
    to (key, token, count); the join strategy is left to AQE, which measures bytes. The weighted
    vector sum is MLlib's Summarizer (JVM), so no per-dimension explode is needed."""
    width = vectors.select(F.max(F.size(vector))).scalar()      # scalar subquery
    vecs = vectors.select(F.col(token), array_to_vector(F.col(vector)).alias("__vec"))
    joined = token_counts.join(vecs, [token], "left")
    zero = array_to_vector(F.array_repeat(F.lit(0.0), width))
    # one aggregate per key: token total (misses included) and count-weighted vector sum
    sums = joined.groupBy(key).agg(
        F.sum(count).alias("n_tokens"),
        Summarizer.sum(F.coalesce(F.col("__vec"), zero), F.col(count).cast("double")).alias("__sum"))
    avg = F.transform(vector_to_array(F.col("__sum")), lambda x: x / F.col("n_tokens"))
    return sums.select(key, "n_tokens", avg.alias("avg_vector"))
