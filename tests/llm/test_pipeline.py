from collections import Counter

import pytest

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("labels")
    spark.createDataFrame([(6, 1, 0), (8, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder)


def ids(df):
    return sorted(str(r.doc_id) for r in df.select("doc_id").collect())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_and_no_rows(spark, awkward, nothing, labelled, name, stage):
    out = stage(spark, awkward, labelled)
    rows = out.collect()
    if name != "packing":
        assert out.columns == awkward.columns
    if name == "quality_classifier":
        # Two trusted rows teach little: what stays are rows as they were, equal rows together.
        before = Counter(awkward.collect())
        assert all(n == before[r] for r, n in Counter(rows).items())
    elif name == "line_dedup":
        texts = {r.doc_id: r.text for r in rows}
        assert ids(out) == ids(awkward) and texts[7] == "and an end" and texts[9] == "Before it.\nAfter it." and texts[3] == ""
    elif name == "near_dedup":
        # One of the equal texts, one of the wordless ones, and every other text.
        assert {r.doc_id for r in rows} == {1, 3, 6, 8, 9, 10} or {r.doc_id for r in rows} == {1, 3, 6, 7, 8, 9, 10}
        assert len(rows) == len({r.doc_id for r in rows})
    elif name == "mixing":
        assert {r.doc_id for r in rows} <= {1, 2, 6, 7, 8, 9, 10, None} and all(r.text.strip() for r in rows)
    else:
        kept = {(r.doc_id, r.doc_tokens) for r in rows}
        assert {(3, 1), (4, 1)} <= kept and {r.doc_id for r in rows} == {r.doc_id for r in awkward.collect()}
        assert all(r.offset + r.length <= 2048 for r in rows)
    if name in ("line_dedup", "mixing"):
        assert all(r.n_chars == len(r.text) for r in rows)
    assert stage(spark, nothing, labelled).count() == 0


def test_run_equals_the_stages_written_and_read(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    columns = ["doc_id", "start", "length", "ids_crc32"]

    def rows(df):
        return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())

    assert rows(corpus_pipeline.run(spark, folder)) == rows(docs)


def test_stages_follow_the_order_and_take_effect(spark):
    folder = "/root/testdata/sf0.01"
    docs, counts = spark.read.parquet(f"{folder}/documents.parquet"), []
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "near_dedup", "mixing", "packing"]
    good = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == COLUMNS
        counts.append(docs.count())
        if name == "quality_classifier":
            left = {r.doc_id for r in docs.select("doc_id").collect()}
            assert len(good & left) >= 0.98 * len(good)
    assert 1000 > counts[0] == counts[1] > counts[2] > 700
