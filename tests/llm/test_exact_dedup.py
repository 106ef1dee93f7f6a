import hashlib

from pyspark.sql import functions as F

from tablewright.llm.exact_dedup import exact_duplicates


def test_awkward_rows(awkward, nothing):
    rows = exact_duplicates(awkward, keep="largest").collect()
    assert len(rows) == awkward.count()
    plain = [r for r in rows if r.text_sha256 == hashlib.sha256(b"plain text with a few words").hexdigest()]
    assert {r.keep_id for r in plain} == {2} and {r.group_size for r in plain} == {4}
    assert [r.doc_id for r in plain if r.kept] == [2]
    empty = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert {(r.doc_id, r.keep_id, r.kept) for r in empty} == {(None, 4, False), (3, 4, False), (4, 4, True)}
    assert exact_duplicates(nothing).count() == 0


def test_smallest_id_stays_by_default(awkward):
    kept = {r.doc_id for r in exact_duplicates(awkward).collect() if r.kept}
    assert 1 in kept and 2 not in kept and 3 in kept and 4 not in kept


def test_all_null_ids_stay(spark):
    df = spark.createDataFrame([(None, "x"), (None, "x")], "doc_id long, text string")
    assert [(r.keep_id, r.kept, r.group_size) for r in exact_duplicates(df).collect()] == [(None, True, 2)] * 2


def test_collisions_do_not_join_texts(awkward):
    short = exact_duplicates(awkward, digest=lambda t: F.substring(F.unhex(F.md5(t)), 1, 0))
    whole = exact_duplicates(awkward)
    assert sorted(map(str, short.collect())) == sorted(map(str, whole.collect()))
