"""Batch preparation of transaction tables: JN1, PR1-PR5, PR12, PR13, PR15, PR16.

Every step is a DataFrame transformation on one lazy plan; nothing is collected. Column roles
are parameters (``TxnColumns``) so the same code runs on the reference's raw schema and on any
table mapped onto it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import entity_key, event_time, event_timestamp
from ..schema import (ENTITY_DAY_COLUMN, LABEL, NUMERIC_FILL, OFFSET_COLUMNS, SECONDS_PER_DAY,
                      SELECTED_FEATURES, STRING_FILL)
from ..session import ensure_checkpoint_dir


@dataclass(frozen=True)
class TxnColumns:
    """Names of the columns each preparation step reads or writes."""
    key: str = "TransactionID"
    offset_seconds: str = "TransactionDT"
    card: str = "card1"
    addr: str = "addr1"
    entity_day: str = ENTITY_DAY_COLUMN
    offsets: tuple[str, ...] = tuple(OFFSET_COLUMNS)
    label: str = LABEL
    event_timestamp: str = "EVENT_TIMESTAMP"
    entity_id: str = "ENTITY_ID"
    features: tuple[str, ...] = field(default=tuple(SELECTED_FEATURES))


REFERENCE_COLUMNS = TxnColumns()


#: Rows of one key from which a join treats the key apart, and rows of the other side that such keys may have at most
#: to be broadcast.
HEAVY_ROWS, HEAVY_MATCHES = 1_000_000, 100_000


def join_identity(txns: DataFrame, identities: DataFrame, key: str = "TransactionID", heavy: int | None = None) -> DataFrame:
    """JN1: left outer equi join USING ``key``; the key appears once, misses give nulls.

    Both sides grow with the data, so this is a shuffle (sort-merge) join on the key; AQE turns
    it into a broadcast at run time only if the identity side turns out small. With ``heavy`` the keys of more
    rows than that are counted first (at most rows / ``heavy`` of them) and their rows meet their identities, if
    these are counted to be few, where they are, without a shuffle: a hot key then loads no single task.
    """
    if heavy is None:
        return txns.join(identities, [key], "left")
    ensure_checkpoint_dir(txns.sparkSession)
    hot = txns.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter((F.col("__n") > heavy) & F.col(key).isNotNull()).select(key).checkpoint()
    matches = identities.join(hot, [key], "left_semi").checkpoint()
    if hot.isEmpty() or hot.count() + matches.count() > HEAVY_MATCHES:
        return txns.join(identities, [key], "left")
    few = F.broadcast(hot)
    apart = txns.join(few, [key], "left_semi").join(F.broadcast(matches), [key], "left")
    return apart.unionByName(txns.join(few, [key], "left_anti").join(identities, [key], "left"))


def normalize_offsets(df: DataFrame, offsets: tuple[str, ...] | list[str] = tuple(OFFSET_COLUMNS),
                      offset_seconds: str = "TransactionDT") -> DataFrame:
    """PR2: ``D_i - offset/86400`` for the listed day-offset columns present; nulls stay null."""
    day = F.col(offset_seconds) / F.lit(SECONDS_PER_DAY)
    return df.withColumns({c: F.col(c) - day for c in offsets if c in df.columns})


def fill_missing(df: DataFrame) -> DataFrame:
    """PR3: strings -> 'unknown', numerics (and NaN) -> 0; booleans and timestamps untouched."""
    return df.na.fill(STRING_FILL).na.fill(NUMERIC_FILL)


def with_event_timestamp(df: DataFrame, cols: TxnColumns = REFERENCE_COLUMNS) -> DataFrame:
    """PR4: base epoch + offset seconds, as long."""
    return df.withColumn(cols.event_timestamp, event_timestamp(cols.offset_seconds))


def with_event_time(df: DataFrame, cols: TxnColumns = REFERENCE_COLUMNS, name: str = "event_time") -> DataFrame:
    """``df`` with the numeric event timestamp (a model feature) repeated as a time column ``name``, for windows."""
    return df.withColumn(name, event_time(cols.event_timestamp))


def with_entity_key(df: DataFrame, cols: TxnColumns = REFERENCE_COLUMNS) -> DataFrame:
    """PR5: ``card _ addr _ floor(day - D1)``; run after ``fill_missing`` like the reference."""
    return df.withColumn(cols.entity_id,
                         entity_key(cols.card, cols.addr, cols.offset_seconds, cols.entity_day))


def select_features(df: DataFrame, names: list[str] | tuple[str, ...] = tuple(SELECTED_FEATURES),
                    label: str | None = LABEL) -> DataFrame:
    """PR1: the fixed feature list, with the label appended when the frame carries one."""
    cols = list(names)
    if label and label in df.columns and label not in cols:
        cols.append(label)
    return df.select(*cols)


def prepare(txns: DataFrame, identities: DataFrame, cols: TxnColumns = REFERENCE_COLUMNS) -> DataFrame:
    """Join -> normalize offsets -> fill -> event timestamp -> entity key -> select: one plan."""
    joined = join_identity(txns, identities, cols.key)
    out = fill_missing(normalize_offsets(joined, cols.offsets, cols.offset_seconds))
    out = with_entity_key(with_event_timestamp(out, cols), cols)
    return select_features(out, cols.features, cols.label)


# --- PR13: schema-driven column roles ---------------------------------------------------------

def column_roles(schema: T.StructType, label: str = LABEL,
                 token_columns: tuple[str, ...] = ("DeviceInfo", "ENTITY_ID")) -> dict[str, str]:
    """String columns are indexed except the token sources; the label is excluded; numerics
    are assembled; other types (arrays, vectors, timestamps) are not model inputs."""
    roles = {}
    for f in schema.fields:
        if f.name == label:
            roles[f.name] = "label"
        elif isinstance(f.dataType, T.StringType):
            roles[f.name] = "tokens" if f.name in token_columns else "index"
        elif isinstance(f.dataType, T.NumericType):
            roles[f.name] = "assemble"
        else:
            roles[f.name] = "other"
    return roles


def profile_columns(df: DataFrame, label: str = LABEL,
                    token_columns: tuple[str, ...] = ("DeviceInfo", "ENTITY_ID")) -> DataFrame:
    """One row per column: name, Spark type, role and non-null count (a single aggregate pass)."""
    roles = column_roles(df.schema, label, token_columns)
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.lit(roles[f.name]).alias("role"),
                     F.col(f"n{i}").alias("n_non_null"))
            for i, f in enumerate(df.schema.fields)]
    return counts.select(F.inline(F.array(*rows)))


# --- PR15: holdout split ----------------------------------------------------------------------

def with_split(df: DataFrame, key: str, weights: list[float], seed: int, col: str = "split") -> DataFrame:
    """Deterministic split by a seeded hash of ``key``: the same row lands in the same split
    however the input is partitioned (``randomSplit`` does not promise that), and any engine with
    md5 can reproduce it."""
    from ..functions.columns import hash_fraction
    total = float(sum(weights))
    u = hash_fraction(key, seed)
    expr, acc = None, 0.0
    for i, w in enumerate(weights[:-1]):
        acc += w / total
        expr = (F.when(u < F.lit(acc), F.lit(i)) if expr is None else expr.when(u < F.lit(acc), F.lit(i)))
    expr = F.lit(len(weights) - 1) if expr is None else expr.otherwise(F.lit(len(weights) - 1))
    return df.withColumn(col, expr)


def holdout_split(df: DataFrame, weights: list[float], seed: int, key: str | None = None) -> list[DataFrame]:
    """PR15: ``randomSplit`` (reference parity) when ``key`` is None, else the hash split."""
    if key is None:
        return df.randomSplit(weights, seed)
    tagged = with_split(df, key, weights, seed, "__split")
    return [tagged.where(F.col("__split") == i).drop("__split") for i in range(len(weights))]


# --- PR6 / PR16: JSON parse with quarantine ---------------------------------------------------

CORRUPT = "_corrupt_record"


def parse_json(df: DataFrame, json_col: str, schema: T.StructType | str, keep: list[str] | None = None) -> DataFrame:
    """PR6: parse ``json_col`` with a fixed schema (by name; unknown fields dropped, missing ones
    null) and flatten; malformed text is kept in ``_corrupt_record`` instead of being lost."""
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    with_corrupt = T.StructType(list(st.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    from ..sources.publish import JSON_OPTIONS
    parsed = F.from_json(F.col(json_col), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **JSON_OPTIONS})
    keep = keep or []
    return df.select(*keep, F.col(json_col), parsed.alias("__data")).select(*keep, json_col, "__data.*")


def quarantine_reason(df: DataFrame, json_col: str, required: list[str]) -> F.Column:
    """PR16: why a parsed row cannot be scored, or null when it can."""
    expr = F.when(F.col(json_col).isNull(), F.lit("null_message")).when(
        F.col(CORRUPT).isNotNull(), F.lit("malformed_json"))
    for c in required:
        expr = expr.when(F.col(c).isNull(), F.lit(f"missing_{c}"))
    return expr


def split_quarantine(df: DataFrame, reason_col: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows; together they are exactly the input rows."""
    return df.where(F.col(reason_col).isNull()).drop(reason_col), df.where(F.col(reason_col).isNotNull())


# --- PR12: keep rows whose category was seen at fit time --------------------------------------

def category_labels(fit_df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of ``col`` in the fit data (the indexer's label set)."""
    return fit_df.where(F.col(col).isNotNull()).select(col).distinct()


def filter_known_categories(df: DataFrame, labels: DataFrame, col: str) -> DataFrame:
    """Left-semi join on the label set: null or unseen categories drop out (``handleInvalid
    ='skip'``). The join strategy is left to AQE, which measures bytes."""
    return df.join(labels, [col], "left_semi")


def unknown_categories(df: DataFrame, labels: DataFrame, col: str) -> DataFrame:
    """The complement of ``filter_known_categories`` (left-anti), so no row is lost silently."""
    return df.join(labels, [col], "left_anti")
