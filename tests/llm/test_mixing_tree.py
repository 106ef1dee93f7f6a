import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm.mixing_tree import (
    _hypergeometric,
    _last_start,
    fill_targets,
    mix_to_weights,
    mixed_documents,
    op9_mixing,
    split_quotas,
)
from tests.llm.conftest import text_table


def words(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_targets_by_hand(spark):
    df = spark.createDataFrame([("a", 100, 5.0), ("b", 100, 2.0), ("c", 100, 1.0), ("d", 0, 5.0)],
                               "name string, source_size long, weight double")
    target = {r.name: r.target for r in fill_targets(df, 1.5, 2.0).collect()}
    assert target == {"a": 200.0, "b": pytest.approx(500 / 3), "c": pytest.approx(250 / 3), "d": 0.0}


def test_splits_are_exact_and_random():
    quotas = [1000, 70, 3, 0]
    tree = split_quotas(quotas, 7, 1)
    assert tree.sum(0).tolist() == quotas and np.ptp(tree.sum(1)) <= 7 and (tree >= 0).all()
    assert (split_quotas(quotas, 7, 1) == tree).all() and (split_quotas(quotas, 7, 2) != tree).any()
    first = [split_quotas([50, 50], 2, s)[0, 0] for s in range(400)]
    assert abs(np.mean(first) - 25) < 0.5 and 1.8 < np.std(first) < 3.2  # hypergeometric: 2.51


def test_draws_from_huge_populations_stay_in_range():
    rng = np.random.default_rng(0)
    for good, bad, drawn in ((10**12, 5, 10**12), (10**10, 10**11, 10**9), (3, 10**12, 10**6)):
        k = _hypergeometric(rng, good, bad, drawn)
        assert max(0, drawn - bad) <= k <= min(good, drawn)


def test_mix_meets_targets_and_shards_are_disjoint(spark):
    texts = [words(n, f"d{k}x") for k, n in enumerate([700, 300, 40, 1, 900, 333, 256, 257, 0])]
    sources = ["a", "a", "b", "b", "b", "c", None, None, "z"]
    docs = text_table(spark, texts, sources)
    mix = mix_to_weights(docs, block_words=32, shard_words=500)
    target = {r.name: r.target for r in mix.sources.collect()}
    draws = mix.draws.collect()
    taken = {n: sum(d.length for d in draws if d["name"] == n) for n in target}
    assert taken == {n: int(t) for n, t in target.items()}
    assert len({(d.row, d["pass"], d.block) for d in draws}) == len(draws)
    sizes = {r.row: r["size"] for r in mix.rows.collect()}
    for d in draws:
        assert 0 <= d.start and d.start + d.length <= sizes[d.row] and d.length > 0
    by_shard = {}
    for d in draws:
        by_shard.setdefault(d.shard, []).append(d.position)
    assert all(sorted(p) == list(range(len(p))) for p in by_shard.values()) and len(by_shard) > 3
    per_row = {row: sum(d.length for d in draws if d.row == row) for row in sizes}
    assert all(per_row[row] <= 2 * sizes[row] for row in sizes)


def test_the_same_rows_give_the_same_mix(spark):
    texts = [words(50 + 13 * k, f"t{k}y") for k in range(30)]
    docs = text_table(spark, texts, [f"s{k % 4}" for k in range(30)])
    def taken(df):
        mix = mix_to_weights(df, block_words=16)
        per_row = mix.draws.groupBy("row").agg(F.sum("length").alias("n"), F.min("shard").alias("s"))
        return sorted((r.id, r.n, r.s) for r in mix.rows.join(per_row, "row").collect())

    assert taken(docs.repartition(7)) == taken(docs.coalesce(1).orderBy(F.desc("doc_id")))


def test_mixed_texts_hold_the_words_drawn(spark):
    texts = [words(500, "a"), "  lead " + words(90, "b"), words(400, "c")]
    docs = text_table(spark, texts, ["p", "q", "q"])
    mix = mix_to_weights(docs, block_words=64)
    drawn = mix.draws.agg(F.sum("length")).first()[0]
    out = mixed_documents(docs, block_words=64)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sum(len(r.text.split()) for r in rows) == drawn
    assert all(set(r.text.split()) <= set(texts[r.doc_id].split()) for r in rows)
    assert texts[0] in {r.text for r in rows}


def test_awkward_rows(awkward, nothing):
    mix = mix_to_weights(awkward)
    assert mix.rows.count() == awkward.count()
    assert mix.draws.agg(F.sum("length")).first()[0] == sum(int(r.target) for r in mix.sources.collect())
    out = mixed_documents(awkward)
    assert out.columns == awkward.columns and not {3, 4, 5} & {r.doc_id for r in out.collect()}
    assert mix_to_weights(nothing).draws.count() == 0 == mixed_documents(nothing).count()
    many = mix_to_weights(awkward, max_sources=2)
    assert many.draws.agg(F.sum("length")).first()[0] == mix.draws.agg(F.sum("length")).first()[0]


def test_more_sources_than_the_tree_has_leaves(spark):
    texts = [words(40 + 7 * (k % 11), f"s{k}w") for k in range(300)]
    docs = text_table(spark, texts, [f"host{k % 120}" for k in range(300)])
    few, many = (mix_to_weights(docs, block_words=16, shard_words=900, max_sources=n) for n in (1000, 10))

    def taken(mix):
        return {(r.row, r["pass"], r.block): r.length for r in mix.draws.collect()}

    assert taken(few) == taken(many) and len(taken(few)) > 500
    shards = {}
    for d in many.draws.collect():
        shards.setdefault(d.shard, []).append(d.position)
    assert len(shards) > 10 and all(sorted(p) == list(range(len(p))) for p in shards.values())


@pytest.mark.parametrize("shards", [1, 2, 3, 7, 64, 1000])
def test_shards_are_found_by_halving(spark, shards):
    starts = sorted(3 * (k * 7919 % 101) for k in range(shards - 1))
    starts = [0, *starts]
    df = spark.createDataFrame([(starts, s) for s in range(0, 310)], "starts array<long>, slot long")
    assert [r.at for r in df.select(_last_start(shards).alias("at"), "slot").orderBy("slot").collect()] == [
        sum(x <= s for x in starts) - 1 for s in range(310)]


def test_the_query_has_the_local_shuffle_in_its_plan(spark, folder):
    plan = op9_mixing(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number() windowspecdefinition(shard" in plan.replace("#", " ").replace("shard ", "shard") or "position" in plan
