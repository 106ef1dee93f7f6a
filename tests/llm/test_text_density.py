import time

import pytest

from tablewright.llm.text_density import extract_main_text, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header><a href=x>Home</a></header><nav><ul><li><a href=a>one</a><li><a href=b>two</a></ul></nav><div class="ad">Buy now this fine thing.</div>
<article><h1>A &amp; B</h1><p><b>First  part<br>of it.<p>Second&nbsp;one &lt;here&gt; with <a href=z>a link</a>.</p><ul><li>x<li>y</ul>
<!-- <p>hidden</p> --><aside>More to read</aside><form><p>Your name</p></form></article>
<div id="comments"><p>I liked this very much, thank you all for writing it down.</p></div><footer>&copy; us</footer></body></html>"""


def test_article_alone_remains():
    assert main_text(PAGE) == "A & B\n\nFirst part of it.\n\nSecond one <here> with a link.\n\nx\n\ny"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<p>", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("<script>x = '<p>y</p>'", ""), ("<!-- open", ""),
    ("a < b and c > d", "a < b and c > d"), ("<table><tr><td>x<td>y<tr><td>z</table>", "x\n\ny\n\nz"), ("<p>cut</p><p class=\"x", "cut"),
    ("<p title='a>b'>c</p>", "c"), ("<div hidden><p>no</p></div><p>yes</p>", "yes"), ("<body><div><p>one</div>two", "one\n\ntwo"),
    ("<article><header><h1>T</h1></header><p>x</article>", "T\n\nx"), ("</p></div>x", "x"), ("<p>&#8217;&rsquo;&eacute;&am", "’’é&am")])
def test_pages(page, text):
    assert main_text(page) == text


STORY = "<h1>Title</h1>" + "".join(f"<p>Sentence {i} of the article has quite a few plain words in it.</p>" for i in range(12))


@pytest.mark.parametrize("begin, end", [
    ("<form id=aspnetForm>", "</form>"), ("<form method=post action=/x>", ""), ('<div class="page menu-closed">', "</div>"),
    ("<div id=wrap class='search-enabled'>", "</div>"), ('<div class="post comments-open">', "</div>"),
    ("<div id=modal-root>", "</div>"), ("<div class='widget'><div class='share'>", "</div></div>"), ("<div class=search><main>", "</main></div>")])
def test_a_wrapper_around_the_page_does_not_lose_the_article(begin, end):
    page = (f"<body>{begin}<nav><a href=x>Home</a></nav><div id=content>{STORY}<form><p>Your name</p><input></form></div>"
            f"<div class='comments'><p>I liked reading this very much.</p></div><div class=sidebar><p>Most read today</p></div>{end}</body>")
    assert main_text(page) == "\n\n".join(["Title"] + [f"Sentence {i} of the article has quite a few plain words in it." for i in range(12)])


def test_long_comments_do_not_replace_an_article():
    thread = "".join(f"<p>Comment {i} says something about the article at some length.</p>" for i in range(60))
    page = f"<body><div>{STORY}</div><div id=comments>{thread}</div><div class='menu-closed'></div></body>"
    assert "Comment" not in main_text(page) and "Sentence 11" in main_text(page)


def test_links_weigh_less_than_text():
    menu = "".join(f"<p><a href={i}>chapter {i}</a></p>" for i in range(40))
    body = "".join(f"<p>{'words of the story go on ' * 12}</p>" for _ in range(6))
    assert "chapter" not in main_text(f"<body><div>{menu}</div><div>{body}</div></body>")


def test_time_grows_with_length_alone():
    def seconds(n):
        page, began = "<article><ul>" + "<li>item <a href=x>word</a> text" * n, time.process_time()
        main_text(page)
        return time.process_time() - began

    seconds(1000)
    assert seconds(40000) < 12 * max(0.02, seconds(8000))
    began = time.process_time()
    main_text("<p title=\"" * 50000)
    main_text("<div>" * 50000 + "deep")
    assert time.process_time() - began < 5


def test_tables(spark):
    rows = [(1, "u", PAGE, "a"), (1, "u", PAGE, "b"), (None, None, None, None), (2, "v", "", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract_main_text(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in out) == [(0, 0), (1, len(main_text(PAGE))), (1, len(main_text(PAGE))), (2, 0)]
    assert extract_main_text(df.limit(0)).count() == 0


def test_every_article_of_the_pages(spark, folder):
    """The driver's pages mark their article; nothing else may come out, and all of it must."""
    import html
    import re

    for row in spark.read.parquet(f"{folder}/pages.parquet").collect():
        inside = row.html[row.html.find("<article>") + 9:] if "<article>" in row.html else ""
        inside = re.split("</article>|<footer", inside)[0]
        inside = re.sub(r"<[^>]*$", "", re.sub("<br>", " ", re.sub("</?b>", "", inside)))
        parts = [" ".join(html.unescape(p).split()) for p in re.split("</?(?:p|h1)>", inside)]
        assert main_text(row.html) == "\n\n".join(p for p in parts if p)


def test_elements_count_at_any_depth():
    words = "The article itself goes on with many plain words for its readers. " * 20
    deep = "<span>" * 3000
    page = f"<body><div>{deep}<p>{words}</p><nav>Menu of the site</nav><div class='comments'>A comment <div>in a thread</div> here</div></body>"
    assert main_text(page) == " ".join(words.split())
    # The end of a deep element closes that element, not an outer one of its tag.
    page = f"<body><div class='sidebar'>Side {'<i>' * 600}<div>inner</div> side text again</div><p>{words}</p></body>"
    assert main_text(page) == " ".join(words.split())


def test_deep_pages_take_linear_time():
    began = time.perf_counter()
    main_text("<body><p><button>" + "<font>x<hr>" * 50_000)
    main_text("<body>" + "<span>a<header>b</i>" * 30_000)
    main_text("<body><div>" + "<b>word " * 100_000 + "</div>")
    assert time.perf_counter() - began < 12
