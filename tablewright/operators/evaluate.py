"""Measures over scored tables, and choosing the best of several models."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.operators.models import score
from tablewright.sources.models import load_model

MIN_BUCKETS = 64
ROWS_PER_BUCKET = 1_000_000


def auc_binned(scored: DataFrame, label: str, raw: str = "rawPrediction") -> float:
    """Area under the ROC curve over Spark's 1000-bin curve."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw).evaluate(scored)


def auc_exact(df: DataFrame, score_col: str, label: str) -> DataFrame:
    """(n_pos, n_neg, auc), tied scores counting half; auc is null without both classes.

    The area is the share of (positive, negative) pairs ranked rightly. Rows are
    first counted per score, then ranked inside value buckets whose limits come
    from a sketch of the scores; only one total row per bucket is brought
    together. A score shared by many rows is one row when it is ranked.
    """
    rows = (df.select(F.col(score_col).cast("double").alias("score"), (F.col(label) == 1).alias("is_pos"))
            .filter(F.col("score").isNotNull() & ~F.isnan("score") & F.col("is_pos").isNotNull()))
    counts = rows.groupBy("score").agg(F.count_if("is_pos").alias("pos"),
                                       F.count_if(~F.col("is_pos")).alias("neg"))
    before = Window.partitionBy("bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(before), F.lit(0))
    wins = F.col("pos").cast("double") * (F.col("below") + F.col("neg") / 2)
    parts = (_bucketed(rows, counts).withColumn("below", below)
             .groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                                    F.sum(wins).alias("wins")))
    # One row per bucket from here on.
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "pos", "neg", "wins")))
    start = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg"),
                     F.lit(0.0).alias("wins"))

    def add(total: Column, part: Column) -> Column:
        across = part["pos"].cast("double") * total["neg"]
        return F.struct((total["pos"] + part["pos"]).alias("pos"), (total["neg"] + part["neg"]).alias("neg"),
                        (total["wins"] + part["wins"] + across).alias("wins"))

    total = parts.agg(F.aggregate(ordered, start, add).alias("total"))
    pairs = F.col("total.pos").cast("double") * F.col("total.neg")
    return total.select(F.col("total.pos").alias("n_pos"), F.col("total.neg").alias("n_neg"),
                        F.try_divide(F.col("total.wins"), pairs).alias("auc"))


def _bucketed(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Number the value ranges that hold about equally many rows each."""
    wanted = max(MIN_BUCKETS, -(-rows.count() // ROWS_PER_BUCKET))
    shares = [i / wanted for i in range(1, wanted)]
    found = rows.agg(F.percentile_approx("score", shares, 10 * wanted).alias("cuts")).first()["cuts"]
    cuts = sorted({c for c in found or [] if abs(c) != float("inf")})
    if not cuts:
        return counts.withColumn("bucket", F.lit(0.0))
    limits = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(splits=limits, inputCol="score", outputCol="bucket").transform(counts)


def accuracy(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """(accuracy) over rows with a label."""
    return df.agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"))


def score_table(spark: SparkSession, scores: Iterable[tuple]) -> DataFrame:
    """(pos, model, rocauc), with accuracy where scores are (model, rocauc, accuracy), in candidate order."""
    rows = [(i, *score) for i, score in enumerate(scores)]
    further = ", accuracy double" if rows and len(rows[0]) > 3 else ""
    return spark.createDataFrame(rows, f"pos int, model string, rocauc double{further}")


def leaderboard(scores: DataFrame) -> DataFrame:
    """(model, rocauc, is_best) from (pos, model, rocauc); the first of equal scores wins.

    Candidates without a score are listed and never best. Further columns are kept.
    """
    scored = F.col("rocauc").isNotNull() & ~F.isnan("rocauc")
    ranking = F.when(scored, F.struct(F.col("rocauc"), -F.col("pos")))
    best = scores.agg(F.max_by("model", ranking)).scalar()
    further = [c for c in scores.columns if c not in ("pos", "model", "rocauc")]
    return scores.select("model", "rocauc", *further, F.coalesce(F.col("model") == best, F.lit(False)).alias("is_best"))


def best_model(board: DataFrame) -> str | None:
    row = board.filter("is_best").first()
    return row["model"] if row else None


def evaluate_best(models: Mapping[str, PipelineModel | str], board: DataFrame, test: DataFrame,
                  label: str, measure: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """(model, accuracy, n_pos, n_neg, auc) of the winning model on a test table, without refitting.

    Models are fitted pipelines or paths of stored ones.
    """
    winner = best_model(board)
    if winner is None:
        raise ValueError("no candidate has a score")
    model = models[winner]
    if isinstance(model, str):
        model = load_model(model)
    measure = measure or (lambda scored, y: auc_exact(scored, "decision", y))
    scored = score(model, test)
    right = accuracy(scored, "prediction", label).first()["accuracy"]
    return measure(scored, label).select(F.lit(winner).alias("model"), F.lit(right).cast("double").alias("accuracy"), "*")
