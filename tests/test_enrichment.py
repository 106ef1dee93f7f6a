"""Band lookups and reading rates from pages."""

import time

import pytest
from pyspark.sql import functions as F

from tablewright.functions import elements, text_of
from tablewright.operators import enrich as E
from tablewright.operators import extract as X
from tablewright.plans import PageSources, age_bands, enrich_from_pages, rates_from_pages
from tablewright.sources import bands

BANDS = [(18, 24, 5.0), (25, 66, 10.0), (65, 200, 20.0)]


def looked_up(spark, keys, rows, **options):
    df = spark.createDataFrame([(float(k), None) for k in keys], "k double, v double")
    return {r["k"]: r["v"] for r in E.impute_by_band(df, "v", "k", rows, **options).collect()}


def test_first_band_wins_and_gaps_stay(spark):
    assert looked_up(spark, [17, 18, 24.5, 65, 66, 67, 201], BANDS) == {
        17: None, 18: 0.05, 24.5: None, 65: 0.1, 66: 0.1, 67: 0.2, 201: None}


def test_half_open_bands_cover_fractions(spark):
    assert looked_up(spark, [24.5, 66.9, 17.9], BANDS, half_open=True) == {24.5: 0.05, 66.9: 0.1, 17.9: None}


@pytest.mark.parametrize("half_open", [False, True])
def test_search_equals_case_chain(spark, monkeypatch, half_open):
    rows = [((i * 37) % 90, (i * 37) % 90 + i % 6, float(i + 1)) for i in range(80)]
    keys = [k / 4 for k in range(-8, 420)]
    chain = looked_up(spark, keys, rows, half_open=half_open)
    monkeypatch.setattr(E, "CASE_BANDS", 3)
    assert looked_up(spark, keys, rows, half_open=half_open) == chain
    assert None in chain.values() and len(set(chain.values())) > 20


def test_search_leaves_missing_keys(spark, monkeypatch):
    monkeypatch.setattr(E, "CASE_BANDS", 0)
    df = spark.createDataFrame([(None, None), (20.0, None), (20.0, 7.0)], "k double, v double")
    got = [tuple(r) for r in E.impute_by_band(df, "v", "k", BANDS).collect()]
    assert sorted(got, key=str) == sorted([(None, None), (20.0, 0.05), (20.0, 7.0)], key=str)


def test_band_table_keeps_its_order(spark):
    table = bands(spark, BANDS).orderBy(F.desc("idx"))
    assert E.band_list(table) == BANDS


def test_groups_without_factor_keep_gaps(spark):
    df = spark.createDataFrame([(20.0, 0.0), (20.0, 1.0), (20.0, 2.0)], "k double, g double").withColumn(
        "v", F.lit(None).cast("double"))
    out = E.impute_by_band_and_group(df, "v", "k", BANDS, "g", {0: 1.0, 1: 2.0})
    assert {r["g"]: r["v"] for r in out.collect()} == {0.0: 0.05, 1.0: 0.1, 2.0: None}


def test_rate_ratio_of_table_and_mapping(spark):
    rates = spark.createDataFrame([(1, 13.1), (0, 10.1)], "key int, rate double")
    assert E.rate_ratio(rates) == E.rate_ratio({1: 13.1, 0: 10.1}) == 10.1 / 13.1


def found(spark, html, tag, class_=None):
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    return [r["inner"] for r in X.extract_elements(df, tag, class_).orderBy("pos").collect()]


@pytest.mark.parametrize("html,tag,class_,expected", [
    ("<li>a</li><LI x=1>b</LI >", "li", None, ["a", "b"]),
    ("<div>a<div>b</div>c</div>", "div", None, ["a<div>b</div>c", "b"]),
    ("<div class='x row'>a<div class=row>b</div></div><div class='rows'>c</div>", "div", "row",
     ["a<div class=row>b</div>", "b"]),
    ('<span class="p y17">a</span><span class="y17 p">b</span>', "span", "p y17", ["a"]),
    ("<p>a<p>b</p>", "p", None, ["a", "b"]),  # unclosed elements are kept
    ("</p><p>a</p></p>", "p", None, ["a"]),
    ("<script>'<p>no</p>'</script><!-- <p>no</p> --><style>p{}</style><p>yes</p>", "p", None, ["yes"]),
    ("<pre>a</pre><p>b</p>", "p", None, ["b"]),
    ("<p></p>", "p", None, [""]),
    ("no tags", "p", None, []),
    ("<p data-class='row'>a</p>", "p", "row", []),
    ("<p class=\"it's\">a</p>", "p", "it's", ["a"]),
    ("ünï <p>é–<b>x</b></p>", "p", None, ["é–<b>x</b>"]),
    ('<p title="a>b">c</p>', "p", None, ["c"]),
    ("<p title = 'a>b' class=x>c<img alt=\"</p>\">d</p>", "p", "x", ["c<img alt=\"</p>\">d"]),
    ("<p don't>c</p><p it's>d</p>", "p", None, ["c", "d"]),  # a quote that begins no value
    ('<p title="a>c</p>', "p", None, ["c"]),  # a quote that is never closed
    ("<p>a</p><p title='", "p", None, ["a"]),
])
def test_elements(spark, html, tag, class_, expected):
    assert found(spark, html, tag, class_) == expected


def test_deeply_nested_and_long_pages(spark):
    deep = "<div>" * 300 + "x" + "</div>" * 300
    assert len(found(spark, deep, "div")) == 300
    assert len(found(spark, "<li>y</li>" * 3000, "li")) == 3000
    assert found(spark, "<td>" + "z " * 200_000 + "</td>", "td") == ["z " * 200_000]


@pytest.mark.parametrize("html,expected", [
    ("a &amp;lt; <b>b</b>", "a &lt; b"),
    ("25&ndash;34 &#8211; &#x2013;", "25–34 – –"),
    ("it&apos;s &quot;q&quot; &#65;;x", "it's \"q\" A;x"),
    ("&# &#zz; &", "&# &#zz; &"),
    ("<!-- c -->t", "t"),
    ('<a title="x > y">t</a> 1 < 2', "t 1 < 2"),
    ("<a title='x > y'>t &amp; u</a>", "t & u"),
    ('<a title="x>t</a>', "t"),
    ("<p><!doctype x>t</p>", "t"),
    (None, None),
])
def test_text(spark, html, expected):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(text_of("h")).first()[0] == expected


def test_tags_are_found_in_linear_time():
    from tablewright.functions.html import plain_text, scan_elements

    for page in ("<p title=\"" * 60_000, "<p title='x>" * 60_000, "<a" * 120_000, "<p a= b=\"'\" c='" * 40_000, "<" * 200_000):
        began = time.perf_counter()
        scan_elements(page, "p")
        plain_text(page)
        assert time.perf_counter() - began < 6, page[:20]


def test_tag_names_are_checked():
    with pytest.raises(ValueError):
        elements("html", "li' or '1")


def test_band_and_percent_texts(spark):
    rows = [("25–34 years (12.6%)",), ("75+ (8%)",), ("none",)]
    out = X.parse_percent(X.parse_band(spark.createDataFrame(rows, "text string")))
    assert [tuple(r)[1:] for r in out.collect()] == [(25.0, 34.0, 12.6), (75.0, 200.0, 8.0), (None, None, None)]


def stored_pages(spark):
    ages = "".join(f'<tr class="even"><th>{b}</th><td>{r}</td></tr><tr class="odd"><th>x</th><td>0</td></tr>'
                   for b, r in (("18–24", "8.3"), ("25–34", "10.6"), ("75+", "3.4")))
    items = "".join(f"<li>{t}</li>" for t in (
        "13.1 of 100 men (13.1%)", "women (10.1%)", "18–24 (5.3%)", "25–44 (12.6%)", "45–66 (14.9%)", "65+ (8.3%)",
        "other 30–40 (99%)"))
    rows = '<div class="row"><div>x</div></div>' * 7 + f'<div class="row"><ul>{items}</ul></div>'
    points = "".join(f'<span class="ds-data-point ds-2017"><span class="dp-data-estimate">{v}</span></span>'
                     for v in ("90", "10", "", "12", "14", "16"))
    data = (f'<div class="ds-data-table-container">{points}</div>'
            '<div class="ds-data-table-container"><span class="ds-data-point ds-2017">'
            '<span class="dp-data-estimate">1</span></span></div>')
    return spark.createDataFrame([(1, "a", ages), (2, "b", rows), (3, "c", data)], "page_id int, url string, html string")


def test_rates_are_read_from_pages(spark):
    whole = rates_from_pages(stored_pages(spark), PageSources("a", "b", "c"))
    rates = rates_from_pages(stored_pages(spark), PageSources("a", "b", "c", group_rows=4))
    assert whole.second[:5] == rates.second and len(whole.second) == 6
    assert rates.first == [(18.0, 24.0, 8.3), (25.0, 34.0, 10.6), (75.0, 200.0, 3.4)]
    assert rates.second == [(14.0, 17.0, 13.0), (18.0, 24.0, 5.3), (25.0, 44.0, 12.6), (45.0, 66.0, 14.9), (65.0, 200.0, 8.3)]
    assert rates.groups == {1: 13.1, 0: 10.1}


def test_enrichment_from_pages(spark):
    rows = [(20.0, 0.0, None), (20.0, 1.0, None), (66.0, 0.0, None), (15.0, 1.0, None), (30.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "age double, sex double, smoke double")
    out = enrich_from_pages(df, stored_pages(spark), PageSources("a", "b", "c"))
    got = [(r["smoke_source1"], r["smoke_source2"]) for r in out.collect()]
    ratio = 10.1 / 13.1
    assert got == [(0.083, 0.053), (0.083, 5.3 * ratio / 100), (None, 0.149), (None, 13.0 * ratio / 100), (1.0, 1.0)]


def test_age_bands_keep_only_the_first_rows(spark):
    assert age_bands(stored_pages(spark).filter("url = 'a'"), rows=2).count() == 2


def test_pages_are_read_a_few_at_a_time(spark):
    import pyarrow as pa

    from tablewright.functions import html as H

    pages = pa.array(["<p>x</p>" * 50_000, None, "", "<p>y", "<p>z</p>" * 200_000, "<p>w</p>"])  # 0.4 and 1.6 MB
    assert list(H.parts_of(pages)) == [(0, 5), (5, 6)]
    assert list(H.parts_of(pages[:0])) == [] and list(H.parts_of(pages[1:3])) == [(0, 2)]
    at_once = []
    found = H.by_parts(pages, lambda t: at_once.append(t) or (None if t is None else len(t)), pa.int64())
    assert found.to_pylist() == [400_000, None, 0, 4, 1_600_000, 8] and len(at_once) == 6
    rows = [(f"{k}", page) for k, page in enumerate(pages.to_pylist())]
    out = X.extract_elements(spark.createDataFrame(rows, "url string, html string").coalesce(1), "p", id_col="url")
    assert "MapInArrow" in out._jdf.queryExecution().executedPlan().toString()
    assert {r.url: r["count"] for r in out.groupBy("url").count().collect()} == {"0": 50_000, "3": 1, "4": 200_000, "5": 1}
    inside = X.nested_elements(out.filter("url <> '4'").withColumn("inner", F.concat(F.lit("<b>"), "inner", F.lit("</b>"))), "b", id_col="url")
    assert inside.columns == ["url", "outer_pos", "pos", "inner"] and inside.count() == 50_002
    assert inside.agg(F.max("outer_pos"), F.max("pos")).first() == (49_999, 0)


def test_pages_of_parts_are_made_by_all_tasks(spark, tmp_path):
    from checks.pages import part_pages

    spark.range(200).select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size")).coalesce(1).write.parquet(
        str(tmp_path / "part.parquet"))
    tasks = part_pages(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(r["count"] for r in tasks) == 200
