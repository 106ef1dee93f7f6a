import math
import random
from collections import Counter

import numpy as np
import pytest

from tablewright.llm.toxicity import (
    BUCKETS,
    LENGTHS,
    TIMES,
    Toxicity,
    buckets,
    facts,
    held_out,
    labelled_sample,
    log_count_ratios,
    op12_toxicity,
    scored,
    toxicity_scores,
    train,
)


def grams(text):
    text = f" {' '.join(text.lower().split())} "
    return Counter(text[i:i + n] for n in LENGTHS for i in range(len(text) - n + 1))


def test_facts_are_those_of_the_ngrams_in_whole_texts():
    def bucket(gram):
        """The bucket of one n-gram, found in a text that is nothing else."""
        n = len(gram)
        mask, h = 2**64 - 1, 0
        for c in gram:
            h = ((h ^ ord(c)) * 0x9E3779B97F4A7C15) & mask
            h ^= h >> 32
        return (h + n & mask) % BUCKETS

    def by_hand(text):
        counts = Counter()
        for gram, n in grams(text).items():
            counts[bucket(gram)] += n
        return sorted(b + k * BUCKETS for b, n in counts.items() for k, times in enumerate(TIMES) if n >= times)

    long = " ".join(f"word{i}" for i in range(30_000))  # several parts
    for text in ["", "a", "Ab  c\n\tÄÖ ☃", "\U0001F600 end", "x" * 10, "haha haha", long]:
        assert facts(text).tolist() == by_hand(text), text[:20]


def test_ratios_by_hand(spark):
    rows = [("you scum", 1), ("scum again", 1), ("a fine day", 0), ("fine again", 0), ("again", 0)]
    found = log_count_ratios(spark.createDataFrame(rows, "text string, toxic int"), most=10**6)
    p, q = (Counter(b for t, y in rows if y == kind for b in facts(t).tolist()) for kind in (1, 0))
    norm = math.log((sum(p.values()) + BUCKETS * len(TIMES)) / (sum(q.values()) + BUCKETS * len(TIMES)))
    expected = {b: math.log((p[b] + 1) / (q[b] + 1)) - norm for b in p | q}
    assert found.fact.tolist() == sorted(expected)
    assert np.allclose(found.ratio, [expected[b] for b in found.fact.tolist()])
    few = log_count_ratios(spark.createDataFrame(rows, "text string, toxic int"), most=8)
    # What both toxic texts and no other hold tell most.
    assert set(few.fact.tolist()) <= {b for b in p if p[b] == 2 and not q[b]}


def planted(spark, n=600, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        toxic = int(rng.random() < 0.15)
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["grumbold", "Zwackig", "Grumbolds!"]))
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_planted_words_are_learnt_and_held_out_rows_scored(spark):
    docs, labels = planted(spark)
    rows = toxicity_scores(docs, labels).join(labels, "doc_id").collect()
    assert len(rows) == 600
    held = [r for r in rows if r.held_out]
    assert 60 < len(held) < 180
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_held_out_labels_change_nothing(spark):
    docs, labels = planted(spark, 200)
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (sorted((r.doc_id, r.score) for r in toxicity_scores(docs, y).collect()) for y in (labels, flipped))
    assert np.allclose([s for _, s in first], [s for _, s in second])


def test_sample_is_bounded_and_leaves_contradictions_out(spark):
    docs, labels = planted(spark, 500)
    assert labelled_sample(docs, labels, "doc_id", "text", "toxic", 10**6).count() == 500
    assert 60 <= labelled_sample(docs, labels, "doc_id", "text", "toxic", 100).count() <= 150
    odd = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (3, None), (4, 7), (None, 1)], "doc_id long, toxic int")
    assert labelled_sample(docs, odd, "doc_id", "text", "toxic", 10).count() == 1


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (4, 0), (6, 0), (8, 1), (9, 1)], "doc_id long, toxic int")
    rows = toxicity_scores(awkward, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in awkward.collect())
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1 and not any(r.held_out for r in rows if r.doc_id is None)
    assert toxicity_scores(nothing, labels).count() == 0
    one_kind = toxicity_scores(awkward, labels.filter("toxic = 0")).collect()
    assert {r.predicted for r in one_kind} == {0} and toxicity_scores(awkward, labels.limit(0)).filter("predicted = 1").count() == 0


def test_scores_equal_the_linear_model_by_hand(spark):
    docs, labels = planted(spark, 120)
    sample = docs.join(labels, "doc_id").select("text", "toxic")
    model = train(sample, most=300)
    assert isinstance(model, Toxicity) and len(model.fact) == 300
    weight = dict(zip(model.fact.tolist(), model.weight.tolist()))
    for r in scored(docs, model).join(docs.withColumnRenamed("doc_id", "id"), "id").limit(20).collect():
        f = model.intercept + sum(weight.get(b, 0.0) for b in facts(r.text).tolist())
        assert r.score == pytest.approx(1 / (1 + math.exp(-f)))
    assert [len(list(buckets("")))] == [0]


def test_query_finds_held_out_toxic_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = op12_toxicity(spark, folder).filter("held_out").select("doc_id", "predicted")
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert len(rows) > 60 and sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows)
