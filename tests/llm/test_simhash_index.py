import random

import xxhash

from tablewright.llm.components import components
from tablewright.llm.simhash_index import close_pairs, drop_near_duplicates, fingerprint, near_duplicate_classes
from tests.llm.conftest import text_table


def by_hand(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ["", " \n", "One", "one TWO three", "a b c d", "É a É a É a É a", "x\x0by z w v u", "to be or not " * 30]:
        assert fingerprint(text.encode()) == by_hand(text), text
    assert fingerprint(b"", 4) == 0


def pairs_by_hand(prints, distance):
    return {(min(a, b), max(a, b)) for i, a in enumerate(prints) for b in prints[:i] if ((a ^ b) % 2**64).bit_count() <= distance}


def test_close_pairs_equal_all_pairs(spark):
    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for base in list(prints)[:40]:
        for k in (1, 2, 3, 4, 5, 6):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), k)))
    prints = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    expected = pairs_by_hand(prints, 4)
    for segments in (2, 3, 4, 5):
        found = [(min(r.a, r.b), max(r.a, r.b)) for r in close_pairs(df, 4, segments).collect()]
        assert set(found) == expected, segments
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in close_pairs(df, 6, 3).collect()} == pairs_by_hand(prints, 6)


def test_components_equal_a_search(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500 + i, 501 + i) for i in range(120)]
    links += [(900, 900 + i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    low = {n: n for a, b in links if a is not None and a != b for n in (a, b)}
    for _ in range(200):
        for a, b in links:
            if a is not None and a != b:
                low[a] = low[b] = min(low[a], low[b])
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.root for r in components(df, "a", "b").collect()} == low
    assert components(df.limit(0), "a", "b").count() == 0


def test_classes_and_one_of_each(spark):
    base = [f"word{i % 61} other{i * 7 % 53}" for i in range(300)]
    near = list(base)
    near[100] = "changed here"
    texts = [" ".join(base), " ".join(near), " ".join(base), "something else altogether", "", None, " \n"]
    df = text_table(spark, texts)
    component = {r.doc_id: r.component_id for r in near_duplicate_classes(df).collect()}
    assert component == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 4, 6: 4}
    assert sorted(r.doc_id for r in drop_near_duplicates(df).collect()) == [0, 3, 4]


def test_classes_equal_all_pairs_on_the_table(spark, folder):
    rows = near_duplicate_classes(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    prints = sorted({r.fp for r in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in pairs_by_hand(prints, 4):
        root[find(a)] = find(b)
    low = {}
    for r in rows:
        low[find(r.fp)] = min(low.get(find(r.fp), r.doc_id), r.doc_id)
    assert all(r.component_id == low[find(r.fp)] for r in rows)


def test_awkward_rows(awkward, nothing):
    rows = near_duplicate_classes(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.component_id for r in rows if r.doc_id in (3, 4, 5)} == {3}
    one = drop_near_duplicates(awkward)
    assert one.columns == awkward.columns
    ids = [r.doc_id for r in one.collect()]
    assert sorted(ids) == sorted(set(ids)) and {1, 3, 6, 8, 10} <= set(ids) and not {2, 4, 5} & set(ids)
    assert drop_near_duplicates(nothing).count() == 0 == near_duplicate_classes(nothing).count()
