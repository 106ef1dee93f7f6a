import random

import pytest

from tablewright.llm.line_runs import delete_runs, drop_repeated_runs, line_ids, suffix_ranks
from tests.llm.conftest import text_table


def by_hand(texts, depth):
    """Lines at the place where the same run of ``depth`` lines was seen before are gone."""
    seen, out = set(), []
    for text in texts:
        lines = (text or "").split("\n")
        worded = [i for i, line in enumerate(lines) if line.strip()]
        gone = set()
        for s in range(len(worded) - depth + 1):
            run = tuple(lines[i] for i in worded[s:s + depth])
            if run in seen:
                gone |= set(worded[s:s + depth])
            seen.add(run)
        kept, fate = [], False
        for i, line in enumerate(lines):
            fate = i in gone if line.strip() else fate
            if not fate:
                kept.append(line)
        out.append("\n".join(kept))
    return out


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_equals_a_scan_in_order(spark, depth):
    rng = random.Random(depth)
    texts = ["\n".join(rng.choice(["a", "b", "c d", "", " "] if rng.random() < 0.7 else [f"u{rng.random()}"])
                       for _ in range(rng.randrange(0, 25))) for _ in range(40)]
    texts += [None, "", texts[3], "a\na\na\na\na\na"]
    out = drop_repeated_runs(text_table(spark, texts).repartition(3), min_lines=depth).orderBy("doc_id").collect()
    assert [r.text for r in out] == by_hand(texts, depth)


def test_ranks_order_suffixes(spark):
    texts = ["\n".join(x) for x in ("abcab", "abcab", "cabca", "xyz")]
    ranks = suffix_ranks(line_ids(text_table(spark, texts), "doc_id", "text"), 3).collect()
    # Among suffixes that share three lines with another, equal ranks mean equal lines.
    starts = {}
    keys = {k: t for k, t in zip(sorted({r.key for r in ranks}), texts[:3])}
    for r in ranks:
        starts.setdefault(r["rank"], set()).add(tuple(keys[r.key].split("\n")[r.at:r.at + 3]))
    assert all(len(s) == 1 for s in starts.values())
    assert set().union(*starts.values()) == {tuple("abc"), tuple("bca"), tuple("cab")}


def test_runs_join_up_where_their_sources_do():
    text, runs = delete_runs("k\na\n\nb\nc\nz", [(1, 2, "x"), (2, 2, "x")])
    assert (text, runs) == ("k\nz", [(1, 3)])
    assert delete_runs("a\nb\nc\nd", [(0, 2, "x"), (2, 2, "y")]) == ("", [(0, 2), (2, 2)])
    assert delete_runs("a\nb\nc\nd", [(0, 1, "w"), (0, 2, "x"), (1, 2, "y"), (2, 2, "y")]) == ("", [(0, 2), (1, 3)])
    assert delete_runs("a\nb\nc", [(0, 3, "x"), (1, 1, "y")]) == ("", [(0, 3)])


def runs_by_hand(texts, depth):
    """Per text the maximal runs copied in one piece from the first places of their windows."""
    first, out = {}, []
    for d, text in enumerate(texts):
        lines = [line for line in (text or "").split("\n") if line.strip()]
        found = []
        for s in range(len(lines) - depth + 1):
            place = first.setdefault(tuple(lines[s:s + depth]), (d, s))
            if place != (d, s):
                where = (place[0], place[1] - s)
                if found and found[-1][2] == where and s <= found[-1][0] + found[-1][1]:
                    found[-1] = (found[-1][0], s + depth - found[-1][0], where)
                else:
                    found.append((s, depth, where))
        out.append([(a, n) for a, n, _ in found])
    return out


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_runs_equal_a_scan(spark, depth):
    rng = random.Random(20 + depth)
    pieces = [[f"p{k}l{i}" for i in range(rng.randrange(1, 7))] for k in range(12)]
    texts = ["\n".join(line for _ in range(rng.randrange(1, 6)) for line in rng.choice(pieces)) for _ in range(30)]
    out = drop_repeated_runs(text_table(spark, texts), min_lines=depth, min_words=10**6).orderBy("doc_id").collect()
    assert [[(r.line, r.lines) for r in row.removed_runs] for row in out] == runs_by_hand(texts, depth)


def test_awkward_rows(awkward, nothing):
    out = drop_repeated_runs(awkward, runs_col="key")
    assert out.columns == [*awkward.columns, "_key"]
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == awkward.count()
    assert rows[7].text == "and an end" and rows[7]._key[0]["lines"] == 3000
    assert rows[9].text == "Before it.\nAfter it." and rows[3].text == "" and rows[5].text == " \n\t "
    assert drop_repeated_runs(nothing).count() == 0


def test_runs_of_few_lines_go_when_they_hold_enough_words(spark):
    long = " ".join(f"w{i}" for i in range(60))
    six, more = "one two three four five six", "seven eight nine ten"
    texts = [f"{long}\nb", f"x\n{long}\ny", long, "a b", "z\na b", f"{six}\n{more}\nc", f"{more}\nd\n{six}\n{more}"]
    out = drop_repeated_runs(text_table(spark, texts)).orderBy("doc_id").collect()
    assert [r.text for r in out] == [texts[0], "x\ny", "", "a b", "z\na b", texts[5], f"{more}\nd"]
    assert [(r.line, r.lines) for r in out[1].removed_runs] == [(1, 1)]
    # Below a depth of three, two lines of ten words together go as well.
    deep = drop_repeated_runs(text_table(spark, texts), min_lines=4).orderBy("doc_id").collect()
    assert [r.text for r in deep] == [r.text for r in out]
