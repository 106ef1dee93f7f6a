"""Train/test splits that depend on row keys only, and set difference."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.values import hash_hex
from tablewright.operators.ranks import checkpointed
from tablewright.operators.statistics import label_counts

MAX_CLASSES = 10_000  # default of the argument max_classes: classes that the driver holds; more are joined as a table
BOUNDARY_ROWS = 100_000
HASH_DIGITS = 8
DIGITS_PER_PASS = 3
COPIES_PER_ROW = 100_000


def with_row_key(df: DataFrame, out: str = "row_key") -> DataFrame:
    """Add a hash of all columns, for tables without an id; equal rows get equal keys."""
    return df.withColumn(out, F.xxhash64(*df.columns))


def _classes(df: DataFrame, label: str, most: int | None = None) -> dict[object, int] | None:
    """Row count per class, or None where there are more classes than the driver should hold."""
    most = MAX_CLASSES if most is None else most
    rows = label_counts(df, label).limit(most + 1).collect()
    return None if len(rows) > most else {r[label]: r["n"] for r in rows}


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    """(_class, _n), stored: a join with it meets a plain exchange, of which Spark splits a hot class's part."""
    return checkpointed(label_counts(df, label).select(F.col(label).alias("_class"), F.col("n").alias("_n")))


def train_fractions(counts: Mapping[object, int], train: float) -> dict[object, float]:
    """Whole-row share per class: int(train * n) / n."""
    return {value: int(train * n) / n for value, n in counts.items()}


def _with_class_values(df: DataFrame, label: str, table: Mapping[object, Sequence] | DataFrame,
                       schema: str = "") -> DataFrame:
    """Attach fixed values per class; those of a mapping are bounded by max_classes rows, so they are broadcast."""
    if isinstance(table, DataFrame):
        return df.join(table, df[label].eqNullSafe(table["_class"]), "left").drop("_class")
    type_ = df.schema[label].dataType.simpleString()
    small = df.sparkSession.createDataFrame(
        [(value, *rest) for value, rest in table.items()], f"_class {type_}, {schema}")
    return df.join(F.broadcast(small), df[label].eqNullSafe(small["_class"]), "left").drop("_class")


def stratified_sample(df: DataFrame, label: str, fractions: Mapping | None = None, *,
                      train: float = 0.9, seed: int = 42, max_classes: int | None = None) -> DataFrame:
    """Bernoulli sample per class; the rows drawn change with the partitioning.

    Use `stratified_split` where a repeatable choice is wanted.
    """
    if fractions is None:
        present = df.filter(F.col(label).isNotNull())
        counts = _classes(present, label, max_classes)
        if counts is None:
            share = F.floor(F.lit(train) * F.col("_n")) / F.col("_n")
            shares = _class_counts(present, label).select("_class", share.alias("_share"))
            return _with_class_values(df, label, shares).filter(F.rand(seed) < F.col("_share")).drop("_share")
        fractions = train_fractions(counts, train)
    return df.sampleBy(label, fractions=dict(fractions), seed=seed)


def stratified_split(df: DataFrame, label: str, key: Sequence[str] | str, *, train: float = 0.9,
                     seed: int = 42, max_classes: int | None = None) -> DataFrame:
    """Add ``split`` ("train" or "test") by comparing the key's hash to its class's share.

    No shuffle for up to ``max_classes`` classes (10,000 by default), whose shares the driver
    holds; the shares of more are a table that is joined. Rows with equal keys fall on the
    same side.
    """
    counts = _classes(df, label, max_classes)
    if counts is None:
        first = F.ceil(F.floor(F.lit(train) * F.col("_n")) / F.col("_n") * 16.0 ** HASH_DIGITS).cast("long")
        cut = F.when(first < 16 ** HASH_DIGITS, F.lower(F.lpad(F.hex(first), HASH_DIGITS, "0"))).otherwise("g")
        cuts = _class_counts(df, label).select("_class", cut.alias("_cut"))
    else:
        cuts = {value: (_cut(share),) for value, share in train_fractions(counts, train).items()}
    side = F.when(hash_hex(key, seed) < F.col("_cut"), "train").otherwise("test")
    return (_with_class_values(df, label, cuts, "_cut string")
            .withColumn("split", side).drop("_cut"))


def _cut(share: float) -> str:
    """Hash digits such that a hash lies below them exactly if hash / 2^32 < share."""
    first = math.ceil(share * 16 ** HASH_DIGITS)
    return f"{first:0{HASH_DIGITS}x}" if first < 16 ** HASH_DIGITS else "g"


@dataclass(frozen=True)
class ExactSplit:
    """Per class the last (hash, key) that still belongs to the test part; of many classes as a table."""

    label: str
    key: Sequence[str]
    seed: int
    last: Mapping[object, Sequence] | DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        names = [f"_last{i}" for i in range(len(self.key))]
        types = [df.schema[k].dataType.simpleString() for k in self.key]
        schema = ", ".join(["_last_hash string", *[f"{n} {t}" for n, t in zip(names, types)]])
        ours, theirs = F.struct(*self.key), F.struct(*[F.col(n).alias(k) for n, k in zip(names, self.key)])
        test = ((F.col("_hash") < F.col("_last_hash"))
                | ((F.col("_hash") == F.col("_last_hash")) & (ours <= theirs)))
        return (_with_class_values(df.withColumn("_hash", hash_hex(self.key, self.seed)), self.label, self.last, schema)
                .withColumn("split", F.when(test, "test").otherwise("train"))
                .drop("_hash", "_last_hash", *names))


def fit_exact_split(df: DataFrame, label: str, key: Sequence[str] | str, *, test: float = 0.1,
                    seed: int = 42, boundary_rows: int = BOUNDARY_ROWS,
                    max_classes: int | None = None) -> ExactSplit:
    """Find the test boundary per class without ordering a class in one task.

    Hash prefixes are counted, which map-side combine reduces to a few thousand
    rows per class; the bucket holding the boundary is split further by the next
    hash bits until it is small, and only its rows are ranked.
    """
    key = [key] if isinstance(key, str) else list(key)
    counts = _classes(df, label, max_classes)
    if counts is None:
        return ExactSplit(label, key, seed, _last_by_class(df, label, key, test, seed, boundary_rows))
    quota = {value: int(n * test + 0.5) for value, n in counts.items()}
    # Per class: hash prefix known so far, and how many of its rows are still wanted.
    state = {value: ("", want) for value, want in quota.items() if want > 0}
    if not state:
        return ExactSplit(label, key, seed, {})
    rows = df.select(F.col(label), *key, hash_hex(key, seed).alias("_hash"))
    digits = 0
    largest = max(counts.values())
    while largest > boundary_rows and digits < HASH_DIGITS:
        inside = _inside(rows, label, state, digits)
        digits = min(digits + DIGITS_PER_PASS, HASH_DIGITS)
        prefix = F.substring("_hash", 1, digits).alias("_bucket")
        edge = _edges(inside, label, [prefix], ["_bucket"])
        state = {r[label]: (r["_bucket"], r["_want"] - (r["_upto"] - r["_n"])) for r in edge}
        largest = max(r["_n"] for r in edge)
    place = ["_hash", *key]
    edge = _edges(_inside(rows, label, state, digits), label, place, place)
    return ExactSplit(label, key, seed, {r[label]: tuple(r[c] for c in place) for r in edge})


def _last_by_class(df: DataFrame, label: str, key: list[str], test: float, seed: int, boundary_rows: int) -> DataFrame:
    """(_class, _last_hash, _last0, ...): the boundaries of any number of classes, as a table.

    The state is a row per class: the hash prefix that holds its boundary, the rows wanted
    of that, and the rows in it. Classes with too many there get a longer prefix from the
    counts of the next ones; then only rows behind the prefixes are ranked, at most
    ``boundary_rows`` a class.
    """
    rows = df.select(F.col(label).alias("_label"), *key, hash_hex(key, seed).alias("_hash"))
    want = F.floor(F.col("_n") * F.lit(test) + 0.5).cast("long")
    state = checkpointed(_class_counts(df, label).select("_class", F.lit("").alias("_prefix"), want.alias("_want"), F.col("_n").alias("_rows"))
                         .filter("_want > 0"))

    def inside(of: DataFrame) -> DataFrame:
        return rows.join(of, rows["_label"].eqNullSafe(of["_class"]) & rows["_hash"].startswith(of["_prefix"]))

    def reached(sizes: DataFrame, order: Sequence[str]) -> DataFrame:
        running = Window.partitionBy("_class").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        upto = sizes.withColumn("_upto", F.sum("_n").over(running))
        return upto.filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))

    for digits in range(DIGITS_PER_PASS, HASH_DIGITS + DIGITS_PER_PASS, DIGITS_PER_PASS):
        large = state.filter(F.col("_rows") > boundary_rows)
        if large.isEmpty():
            break
        prefix = F.substring("_hash", 1, min(digits, HASH_DIGITS)).alias("_bucket")
        edge = reached(inside(large).groupBy("_class", "_want", prefix).agg(F.count(F.lit(1)).alias("_n")), ["_bucket"])
        deeper = edge.select("_class", F.col("_bucket").alias("_prefix"), (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_want"),
                             F.col("_n").alias("_rows"))
        state = checkpointed(state.filter(F.col("_rows") <= boundary_rows).unionByName(deeper))
    place = ["_hash", *key]
    edge = reached(inside(state).groupBy("_class", "_want", *place).agg(F.count(F.lit(1)).alias("_n")), place)
    return checkpointed(edge.select("_class", F.col("_hash").alias("_last_hash"), *[F.col(k).alias(f"_last{i}") for i, k in enumerate(key)]))


def _edges(rows: DataFrame, label: str, by: Sequence, order: Sequence[str]) -> list:
    """Per class, the group in which the running count reaches the wanted one.

    Rows are counted per group first, so a group of many rows is one row when it
    is ordered.
    """
    running = Window.partitionBy(label).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sizes = rows.groupBy(label, "_want", *by).agg(F.count(F.lit(1)).alias("_n"))
    upto = sizes.withColumn("_upto", F.sum("_n").over(running))
    reached = (F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want"))
    return upto.filter(reached).collect()


def _inside(rows: DataFrame, label: str, state: Mapping[object, Sequence], digits: int) -> DataFrame:
    """Rows whose hash starts with their class's prefix."""
    joined = _with_class_values(rows, label, state, "_prefix string, _want long")
    if not digits:
        return joined.filter(F.col("_want").isNotNull())
    return joined.filter(F.substring("_hash", 1, digits) == F.col("_prefix"))


def exact_split(df: DataFrame, label: str, key: Sequence[str] | str, *, test: float = 0.1,
                seed: int = 42, boundary_rows: int = BOUNDARY_ROWS,
                max_classes: int | None = None) -> DataFrame:
    """Add ``split`` with exactly round(test * n) test rows per class; the key must be unique.

    Class totals and boundaries are held on the driver for up to ``max_classes`` classes (10,000 by
    default), as a table for more.
    """
    fitted = fit_exact_split(df, label, key, test=test, seed=seed, boundary_rows=boundary_rows, max_classes=max_classes)
    return fitted.transform(df)


def set_difference(df: DataFrame, other: DataFrame, *, distinct: bool = True) -> DataFrame:
    """Rows of df not in other, matched over all columns by position; nulls match nulls.

    As a set, or with ``distinct=False`` keeping duplicates by count. Both sides
    go through one grouped count, so repeated rows are combined before the only
    shuffle however many copies there are.
    """
    cols = df.columns
    ours = df.withColumn("_n", F.lit(1).cast("long"))
    theirs = other.toDF(*cols).withColumn("_n", F.lit(-1).cast("long"))
    grouped = ours.union(theirs).groupBy(*cols)
    if distinct:
        return grouped.agg(F.min("_n").alias("_n")).filter(F.col("_n") > 0).select(*cols)
    left = grouped.agg(F.sum("_n").alias("_n")).filter(F.col("_n") > 0)
    few = left.filter(F.col("_n") <= COPIES_PER_ROW)
    # A row with very many copies is cut into pieces that different tasks write out.
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES_PER_ROW)),
                         lambda i: F.least(F.lit(COPIES_PER_ROW).cast("long"), F.col("_n") - i * COPIES_PER_ROW))
    many = (left.filter(F.col("_n") > COPIES_PER_ROW)
            .select(*cols, F.posexplode(pieces).alias("_piece", "_n")).repartition("_piece", *cols).drop("_piece"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))
    return few.unionByName(many).select(*cols, copies.alias("_copy")).drop("_copy")
