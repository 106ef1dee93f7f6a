"""Training candidates, ranking them and keeping the best."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.columns import drop_columns, feature_names
from tablewright.operators.evaluate import accuracy, auc_exact, best_model, leaderboard, score_table
from tablewright.operators.features import binarize_label
from tablewright.operators.models import fold_table, refit_scaler, score, search_folds
from tablewright.operators.split import exact_split, stratified_split
from tablewright.sources.models import save_model
from tablewright.sources.tables import require_columns


@dataclass(frozen=True)
class Candidate:
    """A classifier with its grid; ``table`` replaces the common table, e.g. an enriched one."""

    name: str
    estimator: Estimator
    grid: Mapping[str, Sequence] = field(default_factory=dict)
    table: DataFrame | None = None
    drop: Sequence[str] = ()


@dataclass(frozen=True)
class Selection:
    leaderboard: DataFrame
    models: Mapping[str, PipelineModel]
    best: str | None
    tests: Mapping[str, DataFrame]


def select_model(df: DataFrame, candidates: Sequence[Candidate], *, label: str,
                 key: Sequence[str] | str, drop: Sequence[str] = (), folds: int = 5,
                 train: float = 0.9, exact: bool = False, scale_scope: str = "train",
                 parallelism: int = 4, seed: int = 42, model_dir: str | None = None) -> Selection:
    """Split by key, search every candidate on the train part and rank by exact area on the test part.

    A text label becomes 1.0 for the second class in sorted order. All candidates
    see the same rows on each side, because the split is a function of the key. A table that
    several candidates use is read and split once, and candidates with the same features
    share assembled vectors and folds; both are held in memory or on disk until all are scored.
    ``scale_scope="each"`` fits the scaler on the test part as well; the default applies the training
    scale. The models returned and stored are those that were scored.
    """
    if scale_scope not in ("train", "each"):
        raise ValueError(f"unknown scale scope {scale_scope!r}")
    keys = [key] if isinstance(key, str) else list(key)
    models: dict[str, PipelineModel] = {}
    tests: dict[str, DataFrame] = {}
    scores = []
    split_tables: dict[int, DataFrame] = {}
    fold_tables: dict[tuple, DataFrame] = {}
    try:
        for cand in candidates:
            source = cand.table if cand.table is not None else df
            if id(source) not in split_tables:
                split_tables[id(source)] = _split(source, label, keys, drop, train, exact, seed).persist(StorageLevel.MEMORY_AND_DISK)
            parts = drop_columns(split_tables[id(source)], cand.drop)
            features = [f for f in feature_names(parts, label, keys) if f != "split"]
            shared = (id(source), cand.estimator.getLabelCol(), *features)
            if shared not in fold_tables:
                fold_tables[shared] = fold_table(parts.filter(F.col("split") == "train"), features, cand.estimator.getLabelCol(), keys,
                                                 folds=folds, seed=seed).persist(StorageLevel.MEMORY_AND_DISK)
            searched = search_folds(cand.estimator, cand.grid, fold_tables[shared], features=features, folds=folds,
                                    parallelism=parallelism, seed=seed)
            tests[cand.name] = parts.filter(F.col("split") == "test").drop("split")
            used = searched.bestModel
            if scale_scope == "each":
                used = refit_scaler(used, tests[cand.name])
            models[cand.name] = used
            scored = score(used, tests[cand.name]).select("decision", "prediction", label).persist()
            area = auc_exact(scored, "decision", label).first()["auc"]
            scores.append((cand.name, area, accuracy(scored, "prediction", label).first()["accuracy"]))
            scored.unpersist()
            if model_dir:
                save_model(used, f"{model_dir.rstrip('/')}/{cand.name}")
    finally:
        for held in (*fold_tables.values(), *split_tables.values()):
            held.unpersist()
    board = leaderboard(score_table(df.sparkSession, scores))
    return Selection(board, models, best_model(board), tests)


def _split(source: DataFrame, label: str, keys: Sequence[str], drop: Sequence[str], train: float, exact: bool, seed: int) -> DataFrame:
    table = drop_columns(require_columns(source, [label, *keys]), list(drop))
    if table.schema[label].dataType.typeName() == "string":
        table = binarize_label(table, label)
    if exact:
        return exact_split(table, label, keys, test=1 - train, seed=seed)
    return stratified_split(table, label, keys, train=train, seed=seed)
