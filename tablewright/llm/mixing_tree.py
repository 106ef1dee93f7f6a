"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm import query
from tablewright.llm.documents import WORD, documents, whole_text
from tablewright.llm.durable import durable, numbered, rank_of_keys, unused

#: numpy draws exactly up to this population; beyond, the normal limit is used.
_EXACT_POPULATION = 10**9
#: Sources that the splitting tree treats one by one, and whose tables are broadcast.
MAX_SOURCES = 100_000
#: Groups that more sources are put in.
_GROUPS = 1024
#: Rows that share a bucket of a source's permutation, about.
_BUCKET_ROWS = 8192


@dataclass(frozen=True)
class Mix:
    """``rows``: (row, id, source, size, key); ``sources``: (name, source, source_size, weight, target);
    ``draws``: (row, name, pass, block, start, length, shard, position), spans in words."""

    rows: DataFrame
    sources: DataFrame
    draws: DataFrame


def n_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")


def _name(source: str) -> Column:
    """A source's name that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def repeating_weights(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """(name, weight): these weights in turn, over the sources by code point, null last."""
    ranked = rank_of_keys(sources.select("name", "source"), ["source"], F.lit(1), "rank")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return ranked.select("name", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"))


def fill_targets(sized: DataFrame, share: float, max_repeat: float) -> DataFrame:
    """Adds ``target`` to (name, source_size, weight, ...).

    Targets are proportional to weights and sum to ``share`` of all sizes; a target
    above ``max_repeat`` times its source's size stops there and its excess is shared out again.
    Targets are min(cap, weight * level): each round sums what the level fills,
    so one row per round reaches the driver however many sources there are.
    """
    cap, weight = F.col("source_size") * F.lit(float(max_repeat)), F.col("weight")
    total, weights = sized.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full_before = (share * (total or 0) / weights if weights else 0.0), -1
    while True:
        full = weight * F.lit(level) > cap
        n_full, filled, open_weight = sized.agg(
            F.count_if(full), F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(weight))).first()
        if n_full == full_before or not open_weight:
            break
        level, full_before = (share * total - filled) / open_weight, n_full
    return sized.withColumn("target", F.when(weight * F.lit(level) > cap, cap).otherwise(weight * F.lit(level)))


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    if good + bad < _EXACT_POPULATION:
        return int(rng.hypergeometric(good, bad, drawn))
    n, p = good + bad, good / (good + bad)
    deviation = math.sqrt(drawn * p * (1 - p) * (n - drawn) / (n - 1))
    return min(max(round(rng.normal(drawn * p, deviation)), drawn - bad, 0), good, drawn)


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (columns) for each shard (rows); exact in both margins.

    A node halves its shards; how many of each source's blocks go left is one draw from
    the multivariate hypergeometric law, source by source given what room is left.
    """
    rng, out = np.random.default_rng(seed), np.zeros((shards, len(quotas)), np.int64)

    def split(low: int, high: int, counts: np.ndarray) -> None:
        if high - low == 1:
            out[low] = counts
            return
        middle, rest = (low + high) // 2, int(counts.sum())
        room, left = rest * (middle - low) // (high - low), np.zeros_like(counts)
        for i, count in enumerate(counts.tolist()):
            rest -= count
            left[i] = _hypergeometric(rng, count, rest, room) if room else 0
            room -= int(left[i])
        split(low, middle, left)
        split(middle, high, counts - left)

    split(0, shards, np.array(quotas, np.int64))
    return out


def _before(of: str, *partition: str) -> Column:
    window = Window.partitionBy(*partition).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(of).over(window), F.lit(0))


def _last_start(shards: int) -> Column:
    """The shard whose range holds the slot: the last start up to it, by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(shards.bit_length()))])

    def further(at: Column, step: Column) -> Column:
        inside = (at + step <= shards) & (F.get("starts", at + step - 1) <= F.col("slot"))
        return F.when(inside, at + step).otherwise(at)

    return (F.aggregate(steps, F.lit(0), further) - 1).cast("long")


def mix_sources(
    rows: DataFrame, sources: DataFrame, block_words: int = 256, shard_words: int = 1 << 24, seed: int = 42,
    max_sources: int = MAX_SOURCES,
) -> DataFrame:
    """Draws from (row, name, size, key) that bring sources (name, source_size, target) to their targets.

    A document is cut into blocks of ``block_words`` words. A source is passed over whole
    as often as its target allows; the last, partial pass takes blocks in a keyed random
    order up to the target, cutting the last block, so the words taken are the target
    rounded down. The blocks so drawn are each source's quota. ``split_quotas`` shares the
    quotas among shards of about ``shard_words`` words; shards take disjoint ranges of
    each source's permutation, and ``position`` shuffles a shard within itself.

    Permutations are ranked by hash bucket: bucket totals are summed over buckets,
    and only blocks of one bucket are sorted together, so a source with most of the
    blocks is many small sorts. Tables of one row per source are broadcast, and the tree on the
    driver holds one number per source and shard, for up to ``max_sources`` sources. More
    sources are joined by name, and share permutations by hash groups: what a group's permuted
    range holds of each source is one draw from the same law, so the tree has a
    leaf per group and shard, and the words taken of each source stay exact.
    """
    size, longest = F.col("size"), F.lit(block_words)
    plans = durable(sources.select("name", "source_size", "target").withColumn(
        "passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)).withColumn(
        "rest", F.floor(F.col("target") - F.col("passes") * F.col("source_size"))))
    n_sources, taken = plans.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("passes") * F.col("source_size") + F.col("rest")), F.lit(0))).first()
    few = n_sources <= max_sources

    def small(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if few else table

    # What the tree calls a source.
    unit = F.col("name") if few else F.pmod(F.xxhash64(F.lit(seed), "name"), F.lit(min(max_sources, _GROUPS))).cast("string")
    n_blocks = rows.agg(F.coalesce(F.sum(F.ceil(size / longest)), F.lit(0))).first()[0]
    bits = max(1, min(32, math.ceil(math.log2(max(2, n_blocks / _BUCKET_ROWS)))))

    def order(turn: Column) -> Column:
        return F.xxhash64(F.lit(seed), "key", "block", turn)

    bucket = F.shiftrightunsigned("order", 64 - bits)
    blocks = (rows.filter(size > 0).join(small(plans), "name")
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((size - 1) / longest))))
              .withColumn("start", F.col("block") * longest).withColumn("length", F.least(longest.cast("long"), size - F.col("start")))
              .select("row", "name", "key", "block", "start", "length", "passes", "rest"))
    whole = blocks.filter("passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)))
    part = blocks.filter("rest > 0").withColumn("pass", F.col("passes")).withColumn("order", order(F.col("pass"))).withColumn("bucket", bucket)
    totals = part.groupBy("name", "bucket").agg(F.sum("length").alias("words"), F.first("rest").alias("rest"))
    cuts = (totals.withColumn("filled", _before("words", "name"))
            .filter("filled < rest AND filled + words >= rest").select("name", F.col("bucket").alias("cut"), "filled"))
    part = part.join(small(durable(cuts)), "name").filter("bucket <= cut")
    within = Window.partitionBy("name").orderBy("order", "row", "block").rowsBetween(Window.unboundedPreceding, -1)
    last = part.filter("bucket = cut").withColumn("filled", F.col("filled") + F.coalesce(F.sum("length").over(within), F.lit(0)))
    last = last.withColumn("length", F.least("length", F.col("rest") - F.col("filled"))).filter("length > 0")
    columns = ["row", "name", "pass", "block", "start", "length", "order", "bucket"]
    slots = (whole.withColumn("order", order(F.col("pass"))).withColumn("bucket", bucket).select(*columns)
             .unionByName(part.filter("bucket < cut").select(*columns)).unionByName(last.select(*columns)))
    slots = durable(slots.withColumn("unit", unit))
    counts = slots.groupBy("unit", "bucket").agg(F.count(F.lit(1)).alias("n"))
    bases = counts.select("unit", "bucket", _before("n", "unit").alias("base"))
    own = Window.partitionBy("unit", "bucket").orderBy("order", "row", "pass", "block")
    ranked = (slots.withColumn("own", F.row_number().over(own) - 1).join(bases, ["unit", "bucket"])
              .withColumn("slot", F.col("base") + F.col("own")))
    shards = max(1, math.ceil(taken / shard_words))
    quotas = sorted((r["unit"], r["n"]) for r in counts.groupBy("unit").agg(F.sum("n").alias("n")).collect())
    tree = split_quotas([n for _, n in quotas], shards, seed)
    starts = np.vstack([np.zeros((1, len(quotas)), np.int64), np.cumsum(tree, axis=0)[:-1]])
    ranges = rows.sparkSession.createDataFrame(
        [(name, starts[:, i].tolist()) for i, (name, _) in enumerate(quotas)], "unit string, starts array<long>")
    draws = ranked.join(ranges, "unit").withColumn("shard", _last_start(shards))
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "order"), "row", "pass", "block")
    draws = draws.withColumn("position", F.row_number().over(local) - 1)
    return draws.select("row", "name", "pass", "block", "start", "length", "shard", "position")


def mix_to_weights(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, max_repeat: float = 2.0, **options,
) -> Mix:
    """The mix of a table whose sources, by code point and null last, weigh ``weights`` in turn.

    Sizes are words. Null text has none; null is a source of its own; documents without
    words are never drawn. Equal rows are drawn each for itself. The same rows give
    the same mix, wherever they lie: orders are hashes of id, text and block. An
    empty table gives an empty mix. Other columns are not read. No Python runs on executors.
    """
    text = whole_text(text_col)
    rows = numbered(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), _name(source_col).alias("name"),
                              n_words(text).alias("size"), F.xxhash64(F.col(id_col), text).alias("key")), "row")
    return _mix_rows(rows, weights, share, max_repeat, **options)


def _mix_rows(rows: DataFrame, weights: tuple[float, ...], share: float, max_repeat: float, **options) -> Mix:
    sized = durable(rows.groupBy("name").agg(F.max("source").alias("source"), F.sum("size").alias("source_size")))
    sized = durable(sized.join(repeating_weights(sized, weights), "name"))
    targets = fill_targets(sized, share, max_repeat)
    return Mix(rows, targets, mix_sources(rows.select("row", "name", "size", "key"), targets, **options))


def mixed_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, max_repeat: float = 2.0, **options,
) -> DataFrame:
    """The documents of the mix, with the columns of ``df``: one row per document and pass.

    A pass that takes all blocks gives the text as it is, a partial one the words of its
    blocks in the document's order with the white space behind them. What is not drawn goes.
    """
    row, words, size, key, name = (unused(df, c) for c in ("row", "words", "size", "key", "name"))
    text = whole_text(text_col)
    docs = numbered(df.withColumns({name: _name(source_col), size: n_words(text), key: F.xxhash64(F.col(id_col), text)}), row)
    rows = docs.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.col(name).alias("name"), F.col(size).alias("size"), F.col(key).alias("key"))
    draws = _mix_rows(rows, weights, share, max_repeat, **options).draws
    spans = unused(df, "spans")
    passes = draws.groupBy(F.col("row").alias(row), "pass").agg(
        F.sum("length").alias(words), F.sort_array(F.collect_list(F.struct("start", "length"))).alias(spans)).drop("pass")
    pieces = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    # The outer array binds the split text, so it is split once however many blocks are cut from it.
    cut = F.transform(F.array(pieces), lambda p: F.array_join(F.flatten(F.transform(
        F.col(spans), lambda s: F.slice(p, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""))[0]
    whole = F.when(F.col(words) == F.col(size), text).otherwise(cut)
    return docs.join(passes, row).select(*[whole.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])


@query()
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mix_to_weights(documents(spark, folder))
    # Where the mix first has the document: its shard, and its place in the shard's local shuffle.
    place = F.min(F.struct("shard", "position"))
    taken = mix.draws.groupBy("row").agg(F.sum("length").alias("taken"), place.alias("place"))
    targets = mix.sources.select("name", "source_size", "target")
    return (mix.rows.join(taken, "row", "left").join(targets, "name")
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
                    F.col("place.shard").alias("first_shard"), F.col("place.position").alias("first_position")))
