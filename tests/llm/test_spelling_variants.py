import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from checks.compare import difference
from tablewright.llm import ORACLES
from tablewright.llm.spelling_variants import (
    _ends,
    _numbered_batches,
    op11_spelling_variants,
    partition_starts,
    slipped_words,
    spelling_variants,
)


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def by_hand(words, ratio=10):
    form, near_n = {}, {}
    for w, n in words.items():
        near = [x for x in words if one_apart(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        near_n[w] = len(near)
        form[w] = best if best is not None and words[best] >= ratio * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, near_n[w], words[form[w]] if form[w] else None) for w, n in words.items()}


def result(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_variants_equal_all_pairs_of_words(spark):
    rng = random.Random(5)
    words = {}
    for _ in range(60):
        base = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 8)))
        words[base] = rng.choice([1, 2, 20, 20, 200, 2000])
        for _ in range(4):
            i, c = rng.randrange(len(base) + 1), rng.choice("abé")
            for other in (base[:i] + base[i + 1:], base[:i] + c + base[i:], base[:i] + c + base[i + 1:]):
                if other:
                    words.setdefault(other, rng.choice([1, 1, 2, 5, 20]))
    words |= {"straße": 3, "strasse": 40, "straßen": 400, "\U0001F600x": 2, "\U0001F600y": 30}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = by_hand(words)
    assert sum(f is not None for f, *_ in expected.values()) > 20 and any(r[1] != r[0] for r in expected.values() if r[0])
    assert result(spelling_variants(df)) == expected


def test_paths_number_prefixes_whatever_the_partitions():
    rng = random.Random(6)
    for _ in range(200):
        words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 25))})
        cuts = sorted(rng.randrange(len(words) + 1) for _ in range(rng.randrange(4)))
        parts = [words[a:b] for a, b in zip([0, *cuts], [*cuts, len(words)])]
        tables = [[pa.record_batch([pa.array([k] * len(p), pa.int32()), pa.array(p, pa.string()), pa.array([0] * len(p), pa.int64())],
                                   ["part", "word", "n"])] for k, p in enumerate(parts)]
        ends = [row for t in tables for b in _ends(iter(t)) for row in b.to_pylist()]
        starts = partition_starts(ends)
        rows = [row for t in tables for b in _numbered_batches(starts)(iter(t)) for row in b.to_pylist()]
        assert [r["word"] for r in rows] == words and [r["rank"] for r in rows] == list(range(len(words)))
        node = {}
        for r in rows:
            assert len(r["path"]) == len(r["word"]) + 1
            for i, number in enumerate(r["path"]):
                assert node.setdefault(r["word"][:i], number) == number
        assert sorted(node.values()) == list(range(len(node)))  # distinct and without gaps


def test_a_long_word_costs_rows_in_proportion(spark):
    long = "ab" * 10_000
    words = {long: 3, long[:777] + long[778:]: 50, long + "c": 400}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = result(spelling_variants(df))
    assert [len(v[0] or "") for v in (found[w] for w in words)] == [20001, 0, 0]
    assert [v[3] for v in (found[w] for w in words)] == [2, 1, 1]


def slipped_by_hand(rows, least=7):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= least and n >= 2}


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    words = slipped_words(awkward, min_length=4)
    assert {r.word: r.n for r in words.collect()} == slipped_by_hand(rows, 4) != {}
    assert result(spelling_variants(words)) == by_hand(slipped_by_hand(rows, 4))
    assert spelling_variants(slipped_words(nothing)).count() == 0
    empty = spark.createDataFrame([("", 3), (None, 4), ("abc", None), ("abd", 5)], "word string, n long")
    assert result(spelling_variants(empty)) == {"abd": (None, "abd", 5, 0, None)}
    with pytest.raises(ValueError):
        spelling_variants(empty, ratio=1)


def test_slips_lose_the_letter_that_the_hash_names(spark):
    rows = [(i, f"Wörtlich PLAINLY déjàvuish {'x' * (i % 9 + 4)} x÷yzabcd under_score seven77 Ägypten") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = slipped_by_hand(rows)
    assert {r.word: r.n for r in slipped_words(df).collect()} == expected
    assert len(expected) > 12 and result(spelling_variants(slipped_words(df))) == by_hand(expected)


def test_query_equals_sql(spark, folder):
    assert difference(op11_spelling_variants(spark, folder), folder, ORACLES["op11_spelling_variants"]) is None
