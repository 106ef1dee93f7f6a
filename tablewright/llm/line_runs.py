"""Line deduplication: runs of lines that the corpus already holds are deleted.

Each document is a sequence of line ids. Suffixes of these sequences are ordered by
distributed prefix doubling: ranks by 2 lines come from pairs of ranks by 1 line, and so on.
Suffixes that agree on their first n lines form a longest-common-prefix interval of depth n.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm import query
from tablewright.llm.documents import WORD, document_key, documents, whole_text
from tablewright.llm.durable import durable, rank_of_keys, unused


def line_ids(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, at, line, words): lines that hold a word, numbered within the document, as 128-bit hashes."""
    text = whole_text(text_col)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return (df.select(document_key(id_col, text).alias("key"), F.posexplode(lines).alias("at", "line"))
            .select("key", "at", F.unhex(F.md5("line")).alias("line"),
                    F.size(F.regexp_extract_all("line", F.lit(WORD), F.lit(0))).alias("words")))


def _ranked(positions: DataFrame, by: list[str], out: str) -> DataFrame:
    """Positions whose ``by`` occurs twice or more, with its rank among all suffixes.

    Equal prefixes get one rank: the number of positions with a smaller prefix. What
    occurs once starts no repeated run and leaves.
    """
    groups = positions.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return positions.join(rank_of_keys(groups, by, F.col("n"), out).select(*by, out), by)


def _first_ranks(lines: DataFrame) -> DataFrame:
    """(key, at, rank, words): lines that occur twice or more."""
    return durable(_ranked(lines, ["line"], "rank").select("key", "at", "rank", "words"))


def _deeper(ranks: DataFrame, reach: int, depth: int) -> DataFrame:
    """Ranks of ``depth`` lines from those of ``reach``, by doubling."""
    while reach < depth:
        step = min(reach, depth - reach)
        ahead = Window.partitionBy("key").orderBy("at").rangeBetween(step, step)
        pairs = ranks.withColumn("next", F.max("rank").over(ahead)).filter("next IS NOT NULL")
        ranks = durable(_ranked(pairs.withColumnRenamed("rank", "head"), ["head", "next"], "rank").select("key", "at", "rank"))
        reach += step
    return ranks.select("key", "at", "rank")


def suffix_ranks(lines: DataFrame, depth: int) -> DataFrame:
    """(key, at, rank): suffixes that share their first ``depth`` lines with another, ranked by them.

    ``lines`` has (key, at, line, words). Ranks of h lines double to 2h by pairing a position's rank
    with that of the position h further on; the last step overlaps where ``depth`` is no
    power of two. Positions without a partner fall out in each round.
    """
    if depth < 1:
        raise ValueError("depth must be at least 1")
    return _deeper(_first_ranks(lines), 1, depth)


def run_copies(lines: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """(key, at, lines, first): later copies of runs of ``min_lines`` lines, and of fewer that hold ``min_words`` words."""
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    first = _first_ranks(lines)
    out, reach, ranks = None, 1, first
    for depth in range(1, min_lines + 1):
        deep = _deeper(ranks, reach, depth)
        if depth == 2 * reach:  # powers of two are what later depths start from
            ranks, reach = deep, depth
        if depth < min_lines:
            # All lines of a repeated run are repeated, so they are all in the first round.
            ahead = Window.partitionBy("key").orderBy("at").rangeBetween(0, depth - 1)
            wordy = first.select("key", "at", F.sum("words").over(ahead).alias("n")) if depth > 1 else first.withColumnRenamed("words", "n")
            wordy = wordy.filter(F.col("n") >= min_words)
            deep = durable(deep.join(wordy.select("key", "at"), ["key", "at"])) if depth > 1 else wordy.select("key", "at", "rank")
        found = later_copies(deep).withColumn("lines", F.lit(depth))
        out = found if out is None else out.unionByName(found)
    return out


def later_copies(ranks: DataFrame) -> DataFrame:
    """(key, at, first): all members of each interval but the earliest (key, at), by document and then position."""
    # Stored, so that the join meets two plain exchanges, of which Spark splits a hot interval's side.
    first = durable(ranks.groupBy("rank").agg(F.min(F.struct("key", "at")).alias("first")))
    return ranks.join(first, "rank").filter(F.struct("key", "at") > F.col("first")).select("key", "at", "first")


def delete_runs(text: str, copies: Sequence[tuple[int, int, object]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the lines of these copies, and the runs they are parts of.

    A copy is (position, lines, where). Copies that follow each other make one run as far as
    what they are copied from follows each other as well: ``where`` names the text and the
    line before which the position would begin, so it is the same all along a run.
    Positions count lines that hold a word. A line without one goes with the line before it.
    """
    begin: dict[int, tuple[int, object]] = {}
    for start, lines, where in copies:
        if lines > begin.get(start, (0, None))[0]:
            begin[start] = (lines, where)
    runs, last = [], None
    for at in sorted(begin):
        lines, where = begin[at]
        if runs and where == last and at <= sum(runs[-1]):
            runs[-1] = (runs[-1][0], max(sum(runs[-1]), at + lines) - runs[-1][0])
        elif not runs or at + lines > sum(runs[-1]):  # what lies within a run is no other one
            runs.append((at, lines))
            last = where
    kept, at, until = [], -1, 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            at += 1
            until = max(until, at + begin[at][0]) if at in begin else until
        if at < 0 or at >= until:
            kept.append(line)
    return "\n".join(kept), runs


_RUNS = pa.list_(pa.struct([("line", pa.int64()), ("lines", pa.int64())]))


def _delete_batches(text_at: int, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for text, starts in zip(batch.column(text_at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                text, runs = delete_runs(text, [(c["at"], c["lines"], (c["source"], c["before"])) for c in starts]) if starts else (text, [])
                texts.append(text)
                removed.append([{"line": a, "lines": n} for a, n in runs])
            columns = list(batch.columns)
            columns[text_at], columns[-1] = pa.array(texts, batch.column(text_at).type), pa.array(removed, _RUNS)
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], out])

    return run


def drop_repeated_runs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2, runs_col: str = "removed_runs",
    min_words: int = 10,
) -> DataFrame:
    """``df`` without later copies of runs of at least ``min_lines`` lines or ``min_words`` words, plus ``runs_col``.

    Any run of ``min_lines`` lines that occurs twice is a union of intervals of that depth, so doubling
    stops there; runs of fewer lines, down to one, are intervals of the rounds before and go if
    they hold ``min_words`` words. So overlapping deletions join up to the maximal runs, each of
    which the corpus holds before in one piece: those are listed in ``runs_col`` as (first line,
    lines), counting lines that hold a word. Runs from two places are two, side by side or
    overlapping. The earliest occurrence stays, by id (null last), hash of the text and position; a run may
    repeat inside one document. Lines are equal when their bytes are.

    Counts per line and per pair combine before the shuffle; unique lines leave after the
    first count, so later rounds carry repeated lines only. Ranks come from range
    partitions, and the earliest member of an interval is a minimum, so a line that a
    third of all documents hold never meets in one task. Null text counts as empty; lines
    without a word are no part of a run and go with the line before them. Rows equal in
    id and text are one document and get one result. A document may become empty; its row
    stays. Other columns pass through whatever their names; an empty table gives an
    empty result.
    """
    text = whole_text(text_col)
    key, starts = unused(df, "key"), unused(df, "starts")
    copies = run_copies(line_ids(df, id_col, text_col), min_lines, min_words)
    source = F.xxhash64("first.key").alias("source")  # tells neighbouring runs apart
    copy = F.struct("at", "lines", source, (F.col("first.at") - F.col("at")).alias("before"))
    per_document = copies.groupBy(F.col("key").alias(key)).agg(F.collect_list(copy).alias(starts))
    fields = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns]
    rows = df.withColumn(key, document_key(id_col, text)).join(per_document, key, "left").select(*fields, starts)
    out = runs_col if runs_col not in df.columns else unused(df, runs_col)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return rows.mapInArrow(_delete_batches(df.columns.index(text_col), out),
                           f"{types}, `{out}` array<struct<line: bigint, lines: bigint>>")


@query()
def op7_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_runs(documents(spark, folder).select("doc_id", "text"))
