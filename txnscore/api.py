"""Public entry points (the reference's three programs and its helper calls), composed from the
operators. Nothing here collects data to the driver except one-row metric records."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .operators import aggregates, models
from .operators.artifacts import load_or_fit, stage_parameters
from .operators.evaluate import evaluate  # noqa: F401  (re-export)
from .operators.features import feature_pipeline as _feature_pipeline
from .operators.prepare import REFERENCE_COLUMNS, TxnColumns, column_roles, holdout_split
from .operators.prepare import prepare as _prepare
from .operators.scoring import with_score_flags
from .schema import (FEATURE_SCHEMA, GBT_SPLIT, LABEL, RF_SPLIT, SPLIT_SEED, string_columns)
from .sources.files import materialize_if_missing
from .sources.publish import publish_json
from .streaming.scoring import ScoringOutputs, categories_from_model, start_scoring


def prepare(txns: DataFrame, identities: DataFrame, cols: TxnColumns = REFERENCE_COLUMNS) -> DataFrame:
    """preProcessData: join, normalize offsets, fill, event timestamp, entity key, select."""
    return _prepare(txns, identities, cols)


def prepare_split(spark: SparkSession, txns: DataFrame, identities: DataFrame, out_path: str,
                  cols: TxnColumns = REFERENCE_COLUMNS) -> bool:
    """Materialize one split's processed table unless it already exists (per split, D12)."""
    return materialize_if_missing(spark, out_path, lambda: _prepare(txns, identities, cols))


def feature_pipeline(schema=FEATURE_SCHEMA, label: str = LABEL, use_text_vector: bool = False):
    """assembleData / assembleStreamingData as one Pipeline: 62 numerics + 1000 hashed entity
    buckets + 3 indexed categories (Word2Vec on DeviceInfo computed, not assembled)."""
    strings = string_columns(schema)
    numeric = [f.name for f in schema.fields if f.name not in strings and f.name != label]
    index_cols = [c for c in strings if c not in ("DeviceInfo", "ENTITY_ID")]
    return _feature_pipeline(numeric, index_cols, "ENTITY_ID", "DeviceInfo", use_text_vector)


def with_class_weights(df: DataFrame, label: str = LABEL, normalize: bool = False) -> DataFrame:
    """addClassWeights: weight = N / n_class (N / (k n_class) with ``normalize``)."""
    return aggregates.with_class_weights(df, label, normalize=normalize)


@dataclass
class TrainConfig:
    model_path: str
    label: str = LABEL
    split: list = field(default_factory=lambda: list(GBT_SPLIT))
    seed: int = SPLIT_SEED
    grid: list | None = None            # None -> the reference's 18-point grid
    parallelism: int = 1
    weight_col: str | None = None       # GBT ignores weights in the reference
    hash_split_key: str | None = None   # None -> randomSplit (reference parity)
    features: object | None = None      # encoder Pipeline; None -> the reference layout


def train_gbt(spark: SparkSession, data: DataFrame, cfg: TrainConfig):
    """trainAndEvaluate (GBT): load the pipeline that was saved for this data and these parameters and
    evaluate it on the holdout; otherwise grid-search on the holdout and save the best pipeline. A saved
    model that cannot be read raises; one of other data or parameters is set aside, never overwritten.
    Returns (model, metrics frame)."""
    train, test = holdout_split(data, cfg.split, cfg.seed, cfg.hash_split_key)
    stages = cfg.features or feature_pipeline(label=cfg.label)
    grid = cfg.grid if cfg.grid is not None else models.param_grid()
    make = lambda **p: models.gbt(cfg.label, weight_col=cfg.weight_col, **p)
    found = []

    def fit() -> PipelineModel:
        feats = stages.fit(train)
        train_f = feats.transform(train)
        if cfg.weight_col:
            train_f = with_class_weights(train_f, cfg.label)
        best, candidates = models.grid_search(train_f, feats.transform(test), grid, make, cfg.label, cfg.parallelism)
        found.append(candidates)
        return PipelineModel(stages=[*feats.stages, best])

    parameters = {"split": [*cfg.split, cfg.seed, cfg.hash_split_key], "grid": grid, "weight": cfg.weight_col,
                  **stage_parameters(stages)}
    model, loaded = load_or_fit(spark, cfg.model_path, data, fit, parameters)
    return model, evaluate(model.transform(test), label=cfg.label) if loaded else found[0]


def train_rf(spark: SparkSession, data: DataFrame, model_path: str, label: str = LABEL,
             split=None, seed: int = SPLIT_SEED, features=None, hash_split_key: str | None = None,
             **rf_params):
    """trainAndEvaluate (random forest, class-weighted): load the forest that was trained on this data with
    the stated parameters, or train one; then evaluate."""
    split = split or list(RF_SPLIT)
    train, test = holdout_split(data, split, seed, hash_split_key)
    stages = features or feature_pipeline(label=label)

    def fit() -> PipelineModel:
        feats = stages.fit(train)
        rf = models.fit_persisted(models.random_forest(label, **rf_params),
                                  with_class_weights(feats.transform(train), label))
        return PipelineModel(stages=[*feats.stages, rf])

    parameters = {"split": [*split, seed, hash_split_key], **rf_params, **stage_parameters(stages)}
    model, _ = load_or_fit(spark, model_path, data, fit, parameters)
    return model, evaluate(model.transform(test), label=label)


def score_stream(spark: SparkSession, messages: DataFrame, model_dir: str, outputs: ScoringOutputs,
                 checkpoint: str, required: list[str] | None = None, trigger: dict | None = None,
                 schema=FEATURE_SCHEMA, query_name: str = "transactions_scoring",
                 drop_cols: tuple[str, ...] = ()) -> StreamingQuery:
    """The listener: JSON messages -> parse (quarantine bad rows) -> saved pipeline -> flags ->
    scored sink + quarantine + KPI rows, as one named query with its own checkpoint."""
    model = PipelineModel.load(model_dir)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if required is None:
        # every model input: a null numeric would make the assembler fail the whole batch and a
        # null token source would break Word2Vec, so such rows are quarantined instead
        required = [c for c, role in column_roles(schema).items() if role in ("assemble", "tokens")]
    return start_scoring(messages, ddl, required,
                         lambda df: with_score_flags(model.transform(df)), outputs, checkpoint,
                         query_name=query_name, trigger=trigger, drop_cols=drop_cols,
                         known_categories=categories_from_model(model))


def publish(df: DataFrame, sink: str = "text", path: str | None = None, options: dict | None = None) -> None:
    """The producer: one JSON message per row, written by the executors."""
    publish_json(df, sink, path, options)


def batch_kpis(df: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """generateBatchMetrics as a frame: n, n_fraud, n_high_risk, approval_rate."""
    return aggregates.batch_kpis(df, group_cols=group_cols)


def train(spark: SparkSession, cfg: TrainConfig, txns: DataFrame, identities: DataFrame, processed_path: str,
          cols: TxnColumns = REFERENCE_COLUMNS):
    """The training program: materialize the processed table if it is missing (per split), read
    it back by name, then train-or-load and evaluate (``train_gbt``)."""
    prepare_split(spark, txns, identities, processed_path, cols)
    from .sources.files import scan_features
    data = scan_features(spark, processed_path, list(cols.features), label=cols.label)
    return train_gbt(spark, data, cfg)
