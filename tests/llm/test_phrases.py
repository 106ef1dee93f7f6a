import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from checks.compare import difference
from tablewright.llm import ORACLES
from tablewright.llm.phrases import (
    Shards,
    ShardIndex,
    collocations,
    op13_phrase_collocations,
    phrase_counts,
    spaced,
    suffix_order,
    tokens,
)


def pieces(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", text)]


def counts_by_hand(rows, longest=3):
    f = defaultdict(Counter)
    for lang, text in rows:
        for words in pieces(text):
            for n in range(1, longest + 1):
                f[lang or "und"].update(" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
    return f


def by_hand(rows, longest=3, least=10, percent=50, top=2000):
    out = {}
    for lang, f in counts_by_hand(rows, longest).items():
        n = sum(c for p, c in f.items() if " " not in p)
        candidates = {p: c for p, c in f.items() if " " in p and c >= least}
        kept = []
        for p, a in candidates.items():
            words = p.split(" ")
            cuts = []
            for k in range(1, len(words)):
                left, right = f[" ".join(words[:k])], f[" ".join(words[k:])]
                cuts.append((1000000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            inside = [c for q, c in candidates.items() if len(q.split(" ")) > len(words) and f" {p} " in f" {q} "]
            if not any(100 * c >= percent * a for c in inside):
                kept.append((-score, -a, p.encode(), (lang, p, a, left, right, n, score)))
        for rank, (*_, row) in enumerate(sorted(kept)[:top], 1):
            out[row[0], rank] = row[1:]
    return out


def result(df):
    rows = df.collect()
    found = {(r["group"], r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows}
    assert len(found) == len(rows)
    return found


def some_texts(seed=3, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["New", "York", "É", "a-b", "\x00", "日本"]
    out = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randrange(60)):
            text += rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"])
            if rng.random() < 0.1:
                text += "the New york Times "
        out.append((rng.choice(["en", "en", "de", None]), text))
    return out


def test_suffix_order_and_intervals():
    rng = np.random.default_rng(1)
    for depth in (1, 2, 3, 4, 5):
        words = np.concatenate(([0], rng.integers(0, 5, 200), [0]))
        order = suffix_order(words, depth)
        padded = [*words.tolist(), *[-1] * depth]
        begins = [padded[i:i + depth] for i in order.tolist()]
        assert sorted(order.tolist()) == list(range(len(words))) and begins == sorted(begins)
        for once in (False, True):
            index = ShardIndex(words, 5, depth, depth)
            phrases = index.single()
            for n in range(1, depth + 1):
                if n > 1:  # side by side, the last two need no rows of their own
                    phrases = index.extend(phrases, right=n % 2 == 0 if once else bool(rng.integers(2)), once=once and n + 2 > depth)
                seen = Counter(tuple(words[i:i + n].tolist()) for i in range(len(words) - n + 1) if words[i:i + n].all())
                assert {tuple(w): c for w, c in zip(phrases.words.tolist(), phrases.count.tolist())} == seen
                for w, at, c in () if once else zip(phrases.words.tolist(), phrases.forward.tolist(), phrases.count.tolist()):
                    assert {tuple(padded[i:i + n]) for i in order[at:at + c].tolist()} == {tuple(w)}


def test_tokens():
    texts = ["", " ", "A b\tc", "x.Y,z", "É b\x1cc\x85d e", "a\x00b \x0b c"]
    number, sizes, word = tokens([spaced(t.encode()) for t in texts])
    flat, at = word.take(number).to_pylist(), 0
    for text, size in zip(texts, sizes):
        assert [w.decode() for w in flat[at:at + size] if w != b"\xff"] == [w for p in pieces(text) for w in p], text
        assert flat[at + size - 1] == b"\xff"
        at += size
    assert at == len(flat)


@pytest.mark.parametrize("shard_bytes", [1, 5, 9, 40, 300, 10**6])
def test_counts_do_not_depend_on_the_shards(shard_bytes):
    rows = [(g or "und", t) for g, t in some_texts(n=40)] + [("en", "a b " * 200), ("de", "x"), ("en", ""), ("en", "longword" * 9)]
    expected = counts_by_hand(rows)
    n_words = {g: sum(c for p, c in f.items() if " " not in p) for g, f in expected.items()}
    for lengths in ([1, 2], [3], [1, 2, 3]):
        shards, found = Shards(lengths, {}, shard_bytes), defaultdict(Counter)
        batches = [b for g, t in rows for b in shards.add(g, t.encode())] + list(shards.emit())
        for b in batches:
            for row in b.to_pylist():
                assert row["words"] == len(row["phrase"].split(" ")) in lengths or (row["words"] == 0 and row["phrase"] == "")
                found[row["group"]][row["phrase"]] += row["n"]
        for g, f in expected.items():
            assert found[g].pop("", 0) == (n_words[g] if 1 in lengths else 0)
            assert {p: c for p, c in found[g].items() if c} == {p: c for p, c in f.items() if len(p.split(" ")) in lengths}


@pytest.mark.parametrize("longest, least, bits, shard_bytes", [(2, 3, 25, 1 << 20), (3, 4, 6, 40), (4, 3, 20, 100)])
def test_frequent_phrases_equal_plain_counts(spark, longest, least, bits, shard_bytes):
    """A filter of 64 bits is full and lets everything through; counts stay as they are."""
    rows = some_texts(n=120)
    df = spark.createDataFrame([(g or "und", t) for g, t in rows], "group string, text string")
    frequent, totals = phrase_counts(df, longest, least, shard_bytes, bits)
    expected = counts_by_hand(rows, longest)
    assert {(r.group, r.phrase): (r.words, r.f) for r in frequent.collect()} == {
        (g, p): (len(p.split(" ")), c) for g, f in expected.items() for p, c in f.items() if c >= least}
    assert {r.group: r.n for r in totals.collect()} == {
        g: sum(c for p, c in f.items() if " " not in p) for g, f in expected.items()}


@pytest.mark.parametrize("longest, least, percent, top", [(3, 10, 50, 2000), (4, 5, 80, 7), (2, 2, 50, 30)])
def test_collocations_equal_brute_force(spark, longest, least, percent, top):
    rows = some_texts()
    df = spark.createDataFrame(rows, "lang string, text string")
    expected = by_hand(rows, longest, least, percent, top)
    assert len(expected) > 10
    assert result(collocations(df, max_words=longest, min_count=least, percent=percent, top=top, shard_bytes=500)) == expected


def test_large_products_are_exact(spark):
    from tablewright.llm.phrases import scored

    a, left, right = 3_000_000_000_001, 4_000_000_000_007, 9_000_000_000_011
    df = spark.createDataFrame([("x", "p q", 2, a), ("x", "p", 1, left), ("x", "q", 1, right)], "group string, phrase string, words int, f long")
    assert scored(df).first().score == 1000000 * a * a // (left * right)


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.lang, r.text) for r in awkward.collect()]
    assert result(collocations(awkward)) == by_hand(rows) != {}
    assert result(collocations(awkward, min_count=2, top=5)) == by_hand(rows, least=2, top=5)
    assert collocations(nothing).count() == 0
    with pytest.raises(ValueError):
        collocations(awkward, shard_bytes=0)


def test_query_equals_sql(spark, folder):
    assert difference(op13_phrase_collocations(spark, folder), folder, ORACLES["op13_phrase_collocations"]) is None
