"""Quality rules per host: a document stands or falls with its domain."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import query
from tablewright.llm.documents import documents
from tablewright.llm.durable import durable

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words in windows of that many words that the text holds twice or more."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    each = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    keys, base = each[: n - window + 1], len(ids)
    for k in range(1, window):
        if len(ids) ** 2 >= 2**62 or int(keys.max(initial=0)) >= 2**62 // base:
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * base + each[k: n - window + 1 + k]
    _, place, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = times[place] > 1
    covered = np.zeros(n, bool)
    for k in range(window):
        covered[k: n - window + 1 + k] |= again
    return int(covered.sum())


def text_counts(text: bytes, chars: int) -> tuple[int, ...]:
    """The counts named in COUNTS; ``chars`` are the text's code points."""
    words, seen, again, lines = text.split(), set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            again += line in seen
            seen.add(line)
    return (len(words), chars - sum(text.count(b) for b in SPACES), sum(text.count(b) for b in SYMBOLS), again,
            repeated_words(words), lines)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2)
        found = [text_counts(t, n) for t, n in zip(texts.cast(pa.binary()).to_pylist(), pc.utf8_length(texts).to_pylist())]
        columns = np.array(found, np.int64).reshape(-1, len(COUNTS)).T
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, columns)], ["id", "host", *COUNTS])


@dataclass(frozen=True)
class HostRules:
    """Limits of the rules. A document's failures count for its host's rate.

    A host is refused if its share of failing documents is surely high for this corpus: the
    odds of its posterior mean, less ``host_deviations`` posterior deviations, are more than
    ``host_odds`` times those of the prior's mean.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbols_per_word: float = 0.1
    max_dup_line_share: float = 0.5
    host_odds: float = 2.0
    host_deviations: float = 3.0

    def failures(self) -> dict[str, Column]:
        words = F.col("n_words")
        return {
            "too_short": words < self.min_words,
            "repetitive": F.col("n_repeat_words") * 100 > words * self.max_repeat_percent,
            "symbols": F.col("n_symbols") > words * self.max_symbols_per_word,
            "dup_lines": F.col("n_dup_lines") > F.col("n_lines") * self.max_dup_line_share,
        }


def document_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, counts of the text), one narrow row per row; a null text has no words."""
    rows = df.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "host")] + [f"{c} long" for c in COUNTS]
    return rows.mapInArrow(_count_batches, ", ".join(kinds))


def host_verdicts(failed: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """(host, host_docs, host_rate, host_kept) out of rows (host, failed).

    The prior is a beta distribution whose mean is the share of all documents that
    fail and whose weight comes from the spread between hosts: observed spread less
    what chance explains. With it a host's failures give a beta posterior: its mean is the
    shrunken rate, and its deviation says how sure that is, so hosts with few documents are drawn to
    the prior and not refused on thin evidence. Sums of hosts, not hosts, reach the driver.
    Rows without a host have no verdict.
    """
    hosts = durable(failed.filter("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"), F.count_if("failed").alias("host_failed")))
    n, f = F.col("host_docs").cast("double"), F.col("host_failed").cast("double")
    h, docs, bad, squares, spread = hosts.agg(
        F.count(F.lit(1)), F.sum(n), F.sum(f), F.sum(n * n), F.sum(f * f / n)).first()
    alpha, beta = _beta_prior(h, docs or 0.0, bad or 0.0, squares or 0.0, spread or 0.0)
    limit = _odds_times(alpha / (alpha + beta), rules.host_odds)
    weight = n + alpha + beta
    rate = (f + alpha) / weight
    deviation = F.sqrt(F.col("host_rate") * (1.0 - F.col("host_rate")) / (weight + 1.0))
    return (hosts.withColumn("host_rate", rate)
            .select("host", "host_docs", "host_rate", (F.col("host_rate") - rules.host_deviations * deviation <= limit).alias("host_kept")))


def _odds_times(share: float, factor: float) -> float:
    return factor * share / (1.0 - share + factor * share)


def _beta_prior(hosts: int, docs: float, bad: float, squares: float, spread: float) -> tuple[float, float]:
    """Moments of a beta-binomial; half a failure is added so that no mean is 0 or 1."""
    mean = (bad + 0.5) / (docs + 1.0)
    within = mean * (1.0 - mean)
    free = docs - squares / docs - (hosts - 1) if docs else 0.0
    between = spread - bad * bad / docs if docs else 0.0
    share = (between - within * (hosts - 1)) / (within * free) if free > 0 else 0.5
    share = min(max(share, 1e-4), 0.99)
    weight = (1.0 - share) / share
    return mean * weight, (1.0 - mean) * weight


def host_quality(
    df: DataFrame, rules: HostRules = HostRules(), id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
) -> DataFrame:
    """(id, host, counts, base_failed, each rule's failure, host_docs, host_rate, host_kept, kept).

    Every document is tried by the rules; failures are summed per host, shrunk by an
    empirical beta prior, and the hosts' verdicts joined back. A document is kept unless
    ``base_failed``, too short or too repetitive, or its host is refused; the other rules count
    for the host alone.

    Counts are stored as narrow rows, so texts are read once. Sums per host combine
    before the shuffle, and verdicts are one row per host, so a host with a third of all
    documents only makes one side of the join long, which Spark splits. A null text has no
    words and fails; a null host is not refused. Repeated rows are
    judged and counted each. Other columns are not read; an empty table gives an empty result.
    """
    tests = rules.failures()
    rows = durable(document_counts(df, id_col, text_col, host_col)).withColumns(tests).withColumn(
        "base_failed", F.col("too_short") | F.col("repetitive"))
    rows = rows.withColumn("failed", F.col("base_failed") | F.col("symbols") | F.col("dup_lines"))
    verdicts = host_verdicts(rows.select("host", "failed"), rules)
    out = rows.join(verdicts, "host", "left").withColumn("host_kept", F.coalesce("host_kept", F.lit(True)))
    return out.select(
        F.col("id").alias(id_col), F.col("host").alias(host_col), *COUNTS, "base_failed", *tests,
        "host_docs", "host_rate", "host_kept", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))


@query(r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
windows AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS k FROM w),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM again, range(3) AS t(j) GROUP BY r),
c AS (SELECT doc_id, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN covered USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols > n_words * 0.1::DOUBLE OR n_dup_lines > n_lines * 0.5::DOUBLE AS failed FROM c),
h AS (SELECT source, count(*)::DOUBLE AS n, (count(*) FILTER (failed))::DOUBLE AS bad FROM f WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT count(*) AS hosts, sum(n) AS docs, sum(bad) AS bad, sum(n * n) AS squares, sum(bad * bad / n) AS spread FROM h),
m AS (SELECT *, (bad + 0.5::DOUBLE) / (docs + 1) AS mean, docs - squares / docs - (hosts - 1) AS free, spread - bad * bad / docs AS apart FROM s),
p AS (SELECT mean, least(greatest(CASE WHEN free > 0 THEN (apart - mean * (1 - mean) * (hosts - 1)) / (mean * (1 - mean) * free) ELSE 0.5 END, 1e-4), 0.99)::DOUBLE AS share FROM m),
b AS (SELECT mean, (1 - share) / share AS weight, 2 * mean / (1 - mean + 2 * mean) AS most FROM p),
v AS (SELECT source, (bad + mean * weight) / (n + weight) AS rate, n + weight AS total, most FROM h, b),
k AS (SELECT source, rate, rate - 3 * sqrt(rate * (1 - rate) / (total + 1)) <= most AS host_kept FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(host_kept, true) AS kept,
  round(rate, 9) AS host_rate, coalesce(host_kept, true) AS host_kept FROM f LEFT JOIN k USING (source)""")
def op3_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return host_quality(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("host_rate", 9).alias("host_rate"), "host_kept")
