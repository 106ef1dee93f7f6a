"""Elements, bands and rates out of HTML, on the stored pages and on fragments built from parts."""

from pyspark.sql import functions as F

from checks import query
from checks.inputs import table
from tablewright.operators import extract as X
from tablewright.operators.ranks import partitions

LI = "regexp_replace(html, '(?s)<script.*?</script>', '', 'g')"


def list_positions(body: str, tag: str, cls: str | None = None) -> str:
    attrs = f'[^>]*class="{cls}"[^>]*' if cls else "[^>]*"
    return (f"SELECT page_id, unnest(regexp_extract_all({body}, '(?s)<{tag}{attrs}>(.*?)</{tag}>', 1)) AS inner_html, "
            f"generate_subscripts(regexp_extract_all({body}, '(?s)<{tag}{attrs}>(.*?)</{tag}>', 1), 1) - 1 AS pos FROM pages")


@query(f'SELECT page_id, pos::INT AS pos, inner_html AS "inner" FROM ({list_positions(LI, "li")})')
def extract_elements(spark, folder):
    return X.extract_elements(table(spark, folder, "pages"), "li")


@query(f'SELECT page_id, pos::INT AS pos, inner_html AS "inner" FROM ({list_positions(LI, "div", "ad")})')
def extract_elements_of_class(spark, folder):
    return X.extract_elements(table(spark, folder, "pages"), "div", "ad")


@query(f"""SELECT page_id, pos::INT AS pos, regexp_replace(inner_html, '<[^>]*>', '', 'g') AS text
           FROM ({list_positions(LI, "li")})""")
def child_text(spark, folder):
    items = X.extract_elements(table(spark, folder, "pages"), "li")
    return X.child_text(items, "a", 0).select("page_id", "pos", "text")


# A paragraph without an end tag ends at the next one or with the article around it.
@query("""SELECT page_id, generate_subscripts(parts, 1)::INT - 1 AS pos,
  regexp_extract(unnest(parts), '(?s)^(.*?)(?:</p>|</article>|$)', 1) AS "inner" FROM (
  SELECT page_id, string_split(regexp_replace(html, '(?s)<script.*?</script>', '', 'g'), '<p>')[2:] AS parts FROM pages)""")
def extract_unclosed_paragraphs(spark, folder):
    return X.extract_elements(table(spark, folder, "pages"), "p")


DECODED = """replace(replace(replace(replace(regexp_replace(inner_html, '<[^>]*>', '', 'g'),
  '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&')"""


@query(f"""SELECT page_id, pos::INT AS pos, {DECODED} AS text FROM (
  {list_positions(LI, "footer")} UNION ALL {list_positions(LI, "title")} UNION ALL {list_positions(LI, "article")})""")
def own_text(spark, folder):
    pages = table(spark, folder, "pages")
    parts = [X.extract_elements(pages, tag) for tag in ("footer", "title", "article")]
    return X.own_text(parts[0].unionByName(parts[1]).unionByName(parts[2])).select("page_id", "pos", "text")


def part_text(spark, folder):
    """'Aged 26-31 years (12.5%)' with an en dash, or 'Aged 65+ (..%)' for every fifth part."""
    lo = (F.col("p_size") + 14).cast("string")
    hi = (F.col("p_size") + 14 + F.col("p_partkey") % 6).cast("string")
    rate = F.format_string("%d.%d", F.col("p_partkey") % 90, F.col("p_partkey") % 10)
    band = F.when(F.col("p_partkey") % 5 == 0, F.concat(lo, F.lit("+"))).otherwise(F.concat(lo, F.lit("–"), hi))
    return table(spark, folder, "part").select(
        "p_partkey", "p_size", F.concat(F.lit("Aged "), band, F.lit(" years ("), rate, F.lit("%)")).alias("text"))


@query("""SELECT p_partkey, (p_size + 14)::DOUBLE AS lo,
  CASE WHEN p_partkey % 5 = 0 THEN 200 ELSE p_size + 14 + p_partkey % 6 END::DOUBLE AS hi FROM part""")
def parse_band(spark, folder):
    return X.parse_band(part_text(spark, folder)).select("p_partkey", "lo", "hi")


@query("SELECT p_partkey, (p_partkey % 90 || '.' || p_partkey % 10)::DOUBLE AS rate FROM part")
def parse_percent(spark, folder):
    return X.parse_percent(part_text(spark, folder)).select("p_partkey", "rate")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 120 ELSE p_size END::DOUBLE AS hi FROM part""")
def open_ended_band(spark, folder):
    bands = part_text(spark, folder).withColumn("hi", F.col("p_size").cast("double"))
    return X.open_ended_band(bands, top=120).select("p_partkey", "hi")


def part_pages(spark, folder):
    """One page per part: a nested container with two group rates and four estimates, one empty."""
    k, size, at = F.col("p_partkey"), F.col("p_size"), "p_partkey"

    def num(a, b):
        return F.format_string("%d.%d", a, b)

    html = F.concat(
        F.lit('<html><!-- <ul><li>no</li></ul> --><div class="outer row"><div>x</div><ul>'),
        F.lit("<li>About "), size.cast("string"), F.lit(" of every 100 men ("), num(k % 50, k % 7), F.lit("%)</li>"),
        F.lit("<LI class='b'>women&nbsp;("), num(size, k % 3), F.lit("%)</LI></ul></div>"),
        F.lit('<span class="point y17"><span class="est">'), num(k % 40, k % 9),
        F.lit('</span><span class="ci">9</span></span><span class="point y17"><span class="est">'),
        num(size, k % 10), F.lit('</span></span><span class="point y17"><span class="est"></span></span>'),
        F.lit('<span class="point y18"><span class="est">99</span></span></html>'))
    # A part is a few bytes and a page much work, so as many tasks as the file has row groups would be too few.
    part = table(spark, folder, "part").select(at, "p_size")
    return part.repartition(partitions(part)).select(F.col(at).alias("page_id"), html.alias("html"))


@query("""SELECT p_partkey AS page_id, 1 AS key, (p_partkey % 50 || '.' || p_partkey % 7)::DOUBLE AS rate FROM part
UNION ALL SELECT p_partkey, 0, (p_size || '.' || p_partkey % 3)::DOUBLE FROM part""")
def category_rates(spark, folder):
    rows = X.extract_elements(part_pages(spark, folder), "div", "row")
    items = X.own_text(X.nested_elements(rows, "li").drop("outer_pos"))
    return X.category_rates(items)


@query("""SELECT p_partkey AS page_id, round(((p_partkey % 40 || '.' || p_partkey % 9)::DOUBLE
  + (p_size || '.' || p_partkey % 10)::DOUBLE) / 2, 6) AS mean FROM part""")
def tail_mean(spark, folder):
    points = X.extract_elements(part_pages(spark, folder), "span", "point y17")
    values = X.own_text(X.nested_elements(points, "span", "est"))
    return X.tail_mean(values, 4, order=("outer_pos", "pos")).withColumn("mean", F.round("mean", 6))


@query("""SELECT 0 AS idx, 14.0::DOUBLE AS lo, 17.0::DOUBLE AS hi, (SELECT max(p_size) FROM part)::DOUBLE AS rate
UNION ALL SELECT (p_partkey + 1)::INT, p_size::DOUBLE, p_size + 4.0::DOUBLE, p_retailprice FROM part""")
def prepend_band(spark, folder):
    part = table(spark, folder, "part")
    bands = part.select(F.col("p_partkey").cast("int").alias("idx"), F.col("p_size").cast("double").alias("lo"),
                        (F.col("p_size") + 4.0).alias("hi"), F.col("p_retailprice").alias("rate"))
    first = part.agg(F.max("p_size").cast("double").alias("rate")).select(
        F.lit(14.0).alias("lo"), F.lit(17.0).alias("hi"), "rate")
    return X.prepend_band(bands, first)
