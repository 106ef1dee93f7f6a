import random

from tablewright.llm.unit_dedup import cut, drop_repeated_passages, removable, split_units
from tests.llm.conftest import text_table


def test_units():
    text = " One two.  Three four! five\n\nSix, seven and so on Eight nine.\r\n"
    assert [text[a:b] for a, b in split_units(text)] == ["One two.", "Three four!", "five", "Six, seven and so on", "Eight nine."]
    assert split_units("") == split_units(" \n ") == []


def by_hand(texts, least_unit, least_run):
    seen, out = {}, []
    for doc, text in enumerate(texts):
        text, copies = text or "", set()
        for i, (a, b) in enumerate(split_units(text)):
            unit = tuple(text[a:b].lower().split())
            if len(unit) >= least_unit:
                if unit in seen:
                    copies.add(i)
                seen.setdefault(unit, doc)
        out.append(cut(text, removable(text, copies, least_unit, least_run))[0])
    return out


def test_equals_a_scan_in_order(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("ab cd ef gh ij".split()) for _ in range(rng.randrange(1, 9))).capitalize() + "." for _ in range(25)]
    texts = [rng.choice([" ", "\n"]).join(rng.choice(pool) if rng.random() < 0.6 else f"New {rng.random()} thing is here."
                                          for _ in range(rng.randrange(0, 12))) for _ in range(60)] + [None, ""]
    out = drop_repeated_passages(text_table(spark, texts).repartition(3), min_run_words=6).orderBy("doc_id").collect()
    assert [r.text for r in out] == by_hand(texts, 3, 6)


def test_offsets_point_into_the_original(spark):
    passage = "Here begins a passage of a good many words. It goes on for one more sentence, and that was all of it."
    texts = [f"Start of one. {passage} End of one.", f"some words in the middle {passage} of another text.", "Clean and short."]
    rows = drop_repeated_passages(text_table(spark, texts)).orderBy("doc_id").collect()
    assert [r.text for r in rows] == [texts[0], "some words in the middle of another text.", texts[2]]
    for r, text in zip(rows, texts):
        assert "".join(text[s["start"]:s["start"] + s["length"]] for s in r.kept_spans) == r.text


def test_awkward_rows(awkward, nothing):
    out = drop_repeated_passages(awkward, spans_col="key")
    assert out.columns == [*awkward.columns, "_key"] and out.count() == awkward.count()
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[8].text.startswith("This is one passage") and rows[9].text == "Before it.\nAfter it."
    assert rows[3].text == rows[4].text == "" and rows[1].text == rows[2].text == "plain text with a few words"
    assert drop_repeated_passages(nothing).count() == 0


def test_text_without_spaces(spark):
    rng = random.Random(5)
    chinese = ["".join(chr(rng.randrange(0x4e00, 0x9fa5)) for _ in range(n)) + "。" for n in (30, 25, 40, 20, 8)]
    thai = "".join(chr(rng.randrange(0x0e01, 0x0e2e)) for _ in range(80))
    passage = "".join(chinese[:3])
    texts = [passage + chinese[3], passage + chinese[3], "前言在此。" + passage + "后记在此。", thai, thai, chinese[4], chinese[4]]
    out = drop_repeated_passages(text_table(spark, texts)).orderBy("doc_id").collect()
    assert [r.text for r in out] == [texts[0], "", "前言在此。后记在此。", thai, "", chinese[4], chinese[4]]
