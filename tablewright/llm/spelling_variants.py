"""Spelling variants: words one edit apart, found in a dictionary of trie node pairs.

Prefixes of the words are the nodes of a trie, suffixes those of a trie of the reversed
words. Both are numbered in preorder from the sorted words, so a prefix and a suffix are two
integers. A word of length L has L + 1 pairs that meet between two of its code points, and L
pairs that skip one. Two words are one edit apart exactly if they have a pair in common: the
longer one skips where the shorter one meets, or both skip at the same place.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm import query
from tablewright.llm.documents import documents
from tablewright.llm.durable import durable, shuffle_partitions, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# How a word takes part in a pair.
_MEETS, _SKIPS, _SKIPS_FIRST = 0, 1, 2

Steps = list[tuple[int, int]]


def shared_prefix(a: str, b: str) -> int:
    """The number of code points that both words begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)


class Preorder:
    """Numbers the trie's nodes while words pass in sorted order.

    A path from the root is kept as steps (depth, offset): from that depth on to the next
    step's, the node at depth i has the number offset + i, as nodes that one word adds are
    numbered in a row. The root is node 0.
    """

    def __init__(self, steps: Steps = (), free: int = 1):
        self.steps, self.free = list(steps), free

    def add(self, word: str, shared: int) -> None:
        """The next word, which shares that many code points with the one before."""
        self.steps = truncated(self.steps, shared)
        self.steps.append((shared + 1, self.free - shared - 1))
        self.free += len(word) - shared

    def path(self, length: int) -> list[int]:
        nodes = [0]
        for (depth, offset), (end, _) in zip(self.steps, [*self.steps[1:], (length + 1, 0)]):
            nodes.extend(range(offset + depth, offset + end))
        return nodes


def truncated(steps: Steps, depth: int) -> Steps:
    """The steps of a path's first ``depth`` nodes."""
    kept = len(steps)
    while kept and steps[kept - 1][0] > depth:
        kept -= 1
    return steps[:kept]


_STEPS = pa.list_(pa.struct([("depth", pa.int64()), ("offset", pa.int64())]))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per partition: its size, nodes, first and last word and the path to the last, numbered on its own."""
    trie, first, last, part, n = Preorder(), None, "", None, 0
    for batch in batches:
        for word in batch.column(1).to_pylist():
            trie.add(word, shared_prefix(last, word) if n else 0)
            first, last, n = word if first is None else first, word, n + 1
        if batch.num_rows:
            part = batch.column(0)[0].as_py()
    if n:
        steps = [{"depth": d, "offset": o} for d, o in trie.steps]
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([trie.free - 1], pa.int64()),
             pa.array([first]), pa.array([last]), pa.array([steps], _STEPS)],
            ["part", "n", "nodes", "first", "last", "steps"])


def partition_starts(ends: list) -> dict[int, tuple[Steps, int, int, int]]:
    """Per partition, in order: the path it continues, the depth of that, its first free node, its first word's rank.

    A partition's first word may share nodes with the partition before; what that one has
    numbered is kept, and the partition's own numbers begin after it.
    """
    out, path, last, free, rank = {}, [], "", 1, 0
    for end in ends:
        shared = shared_prefix(last, end["first"])
        inherited = truncated(path, shared)
        out[end["part"]] = (inherited, shared, free, rank)
        # On its own the partition gave its first word the nodes 1, 2, ...; those up to ``shared`` are inherited.
        move = free - 1 - shared
        local = [(s["depth"], s["offset"]) for s in end["steps"]]
        if local[0] == (1, 0):
            rest = local[1:]
            until = rest[0][0] if rest else len(end["last"]) + 1
            path = truncated(inherited, until - 1)
            if shared + 1 < until:
                path.append((shared + 1, move))
        else:  # The last word shares nothing with the first.
            path, rest = [], local
        path += [(depth, offset + move) for depth, offset in rest]
        last, free, rank = end["last"], free + end["nodes"] - shared, rank + end["n"]
    return out


def _kinds(word: str) -> list[int]:
    """Of a run of one code point, skipping any gives one word: only the first counts where a word meets."""
    return [_SKIPS_FIRST if i == 0 or word[i - 1] != c else _SKIPS for i, c in enumerate(word)]


def _numbered_batches(starts: dict[int, tuple[Steps, int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last, rank = None, "", 0
        for batch in batches:
            words, paths = batch.column(1).to_pylist(), []
            if not words:
                continue
            for word in words:
                if trie is None:
                    steps, shared, free, rank = starts[batch.column(0)[0].as_py()]
                    trie = Preorder(steps, free)
                else:
                    shared = shared_prefix(last, word)
                trie.add(word, shared)
                paths.append(trie.path(len(word)))
                last = word
            ranks = pa.array(range(rank, rank + len(words)), pa.int64())
            rank += len(words)
            yield pa.RecordBatch.from_arrays(
                [ranks, batch.column(1).cast(pa.string()), batch.column(2), pa.array(paths, pa.list_(pa.int64())),
                 pa.array([_kinds(w) for w in words], pa.list_(pa.int32()))],
                ["rank", "word", "n", "path", "kinds"])

    return run


def trie_paths(words: DataFrame, word: str, carried: str) -> DataFrame:
    """(rank, word, n, path, kinds): each distinct word's rank, and the nodes of its prefixes from the root on.

    ``carried`` is a whole number that comes along as n. Words are dealt by range, so the
    words below a node lie side by side. Each partition numbers the nodes its words add; the
    driver sees one row per partition, by which partitions continue each other's path.
    """
    dealt = durable(words.select(F.col(word).alias("word"), F.col(carried).cast("long").alias("n"))
                    .repartitionByRange(shuffle_partitions(words), "word").sortWithinPartitions("word")
                    .select(F.spark_partition_id().alias("part"), "word", "n"))
    ends = dealt.mapInArrow(_ends, "part int, n long, nodes long, first string, last string, "
                                   "steps array<struct<depth: long, offset: long>>").collect()
    starts = partition_starts(sorted(ends, key=lambda e: e["part"]))
    return dealt.mapInArrow(_numbered_batches(starts), "rank long, word string, n long, path array<long>, kinds array<int>")


def node_pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ranked words (rank, word, n) and the pair dictionary (rank, n, p, s, kind) of a table (word, n)."""
    forward = stored(trie_paths(words, "word", "n"), "tries")
    backward = trie_paths(forward.select(F.reverse("word").alias("word"), "rank"), "word", "rank")
    both = forward.join(backward.select(F.col("n").alias("rank"), F.reverse("path").alias("suffixes")), "rank")
    size = F.size("kinds")

    def pair(p, s):
        return F.struct(p.alias("p"), s.alias("s"))

    meets = F.transform(F.zip_with("path", "suffixes", pair),
                        lambda x: F.struct(x["p"].alias("p"), x["s"].alias("s"), F.lit(_MEETS).alias("kind")))
    skips = F.zip_with(F.zip_with(F.slice("path", 1, size), F.slice("suffixes", 2, size), pair), "kinds",
                       lambda x, kind: F.struct(x["p"].alias("p"), x["s"].alias("s"), kind.alias("kind")))
    return forward.select("rank", "word", "n"), both.select("rank", "n", F.inline(F.concat(meets, skips)))


def near_words(pairs: DataFrame) -> DataFrame:
    """(rank, n_near, best): how many words are one edit away, and of these that of largest n, then of smallest rank.

    Words that share a node pair: at most one meets there, and at most one per code point
    of the alphabet skips there, whatever the size of the table. Each row looks at its
    group's counts and maxima; pairs of words are never formed. Two words share one pair only:
    that of the place where they differ, as skips within a run count once where a word meets.
    """
    together = Window.partitionBy("p", "s")
    skipping = F.col("kind") != _MEETS
    own = F.struct(F.col("n").alias("n"), (-F.col("rank")).alias("back"))
    by_n = together.orderBy((~skipping).cast("int"), F.col("n").desc(), "rank")
    groups = (
        pairs.withColumn("own", F.when(skipping, own))
        .withColumn("place", F.row_number().over(by_n)).withColumn("after", F.lead("own").over(by_n))
        .withColumn("first", F.max("own").over(together))
        .withColumn("longer", F.max(F.when(F.col("kind") == _SKIPS_FIRST, own)).over(together))
        .withColumn("shorter", F.max(F.when(~skipping, own)).over(together))
        .withColumn("n_skips", F.count("own").over(together))
        .withColumn("n_longer", F.count_if(F.col("kind") == _SKIPS_FIRST).over(together))
        .filter((F.col("n_skips") > 1) | ((F.col("n_longer") > 0) & F.col("shorter").isNotNull())))
    shorter = F.when(F.col("kind") == _SKIPS_FIRST, F.col("shorter"))
    other = F.when(F.col("place") == 1, F.col("after")).otherwise(F.col("first"))
    links = groups.select(
        "rank",
        F.when(skipping, F.col("n_skips") - 1 + shorter.isNotNull().cast("long")).otherwise(F.col("n_longer")).alias("near"),
        # greatest ignores null: there may be no other, or no shorter word.
        F.when(skipping, F.greatest(other, shorter)).otherwise(F.col("longer")).alias("best"))
    return links.groupBy("rank").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def follow(links: DataFrame) -> DataFrame:
    """(rank, root): the end of the chain that starts with each link (rank, form); chains must not be circular.

    Each round doubles the links that are followed.
    """
    state = durable(links.select("rank", F.col("form").alias("root")))
    while True:
        ahead = state.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        further = durable(state.join(ahead, "root", "left").select("rank", F.coalesce("next", "root").alias("root"), "next"))
        if further.filter("next IS NOT NULL").isEmpty():
            return further.select("rank", "root")
        state = further.select("rank", "root")


def spelling_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per row of a table of distinct words (word, n).

    Two words are near if one inserted, deleted or replaced code point makes one of the
    other. ``form`` is the near word of largest n (ties: smallest in code-point order) if that n is
    at least ``ratio`` times the word's; ``root`` is where forms of forms lead. Words that have no
    form are their own root; ``n_near`` counts all near words. Work grows with the sum of the
    words' lengths: prefixes and suffixes are integers, so a word of 100,000 letters costs as
    many rows. The empty word, null words and null counts leave; an empty table gives
    an empty result. Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or forms could be circular")
    ranked, pairs = node_pairs(words.filter("word != '' AND n IS NOT NULL"))
    near = stored(near_words(pairs).select("rank", "n_near", F.col("best.n").alias("form_n"), (-F.col("best.back")).alias("form")), "near")
    forms = durable(ranked.join(near, "rank").filter(F.col("form_n") >= F.lit(ratio) * F.col("n")).select("rank", "form", "form_n"))
    roots = follow(forms)
    spelled = ranked.select(F.col("rank").alias("at"), F.col("word").alias("spelling"))
    chosen = (
        forms.join(roots, "rank")
        .join(spelled.withColumnsRenamed({"at": "form", "spelling": "form_word"}), "form")
        .join(spelled.withColumnsRenamed({"at": "root", "spelling": "root_word"}), "root")
        .select("rank", "form_word", "root_word", "form_n"))
    return (ranked.join(near.select("rank", "n_near"), "rank", "left").join(chosen, "rank", "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def slipped_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 31, min_length: int = 7,
                  min_count: int = 2) -> DataFrame:
    """(word, n): runs of letters of whole texts, of which about one in ``every`` loses a letter.

    Runs are of A-Z, a-z and U+00C0 to U+00FF; A-Z become a-z. Which run loses which letter
    follows from the crc32 of ``<id>:<run>``. Words shorter than ``min_length`` or rarer than
    ``min_count`` leave. Null texts have no runs; a null id is an empty one; repeated rows count each.
    """
    long_runs = F.lit(f"[A-Za-zÀ-ÿ]{{{min_length},}}")  # a shorter run cannot become a word
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                     F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), long_runs, F.lit(0))).alias("run"))
    runs = runs.withColumn("run", F.translate("run", _UPPER, _LOWER))
    mark = runs.withColumn("mark", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("mark") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("mark") % every == 0, shorter).otherwise(F.col("run"))
    return (mark.select(word.alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


@query(f"""WITH RECURSIVE
runs AS (SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY id, run),
crc AS (SELECT list(list_reduce(list_prepend(i, range(8)),
                lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS step
        FROM range(256) AS r(i)),
marked AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(octet_length(encode(id || ':' || run))),
                   lambda i: ('0x' || substr(hex(encode(id || ':' || run)), (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, step[(xor(c, b) % 256) + 1]))) AS mark FROM runs, crc),
words AS MATERIALIZED (SELECT w, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN mark % 31 = 0 THEN substr(run, 1, (mark % length(run))::INT) || substr(run, (mark % length(run) + 2)::INT)
                   ELSE run END AS w FROM marked)
  WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2),
cut AS MATERIALIZED (SELECT w, i, substr(w, 1, i::INT) || substr(w, (i + 2)::INT) AS rest
        FROM (SELECT w, unnest(range(length(w))) AS i FROM words)),
near AS (SELECT cut.w AS a, words.w AS b FROM cut JOIN words ON words.w = cut.rest
   UNION SELECT words.w, cut.w FROM cut JOIN words ON words.w = cut.rest
   UNION SELECT x.w, y.w FROM cut x JOIN cut y ON x.i = y.i AND x.rest = y.rest AND x.w <> y.w),
best AS (SELECT a, count(*) AS n_near, arg_min(b, (-n, b)) AS near_form, max(n) AS near_n
         FROM near JOIN words ON words.w = b GROUP BY a),
forms AS MATERIALIZED (SELECT w, near_form AS form, near_n AS form_n FROM words JOIN best ON a = w WHERE near_n >= 10 * n),
chain AS (SELECT w, form AS link FROM forms UNION ALL SELECT chain.w, forms.form FROM chain JOIN forms ON forms.w = link),
roots AS (SELECT w, link FROM chain WHERE link NOT IN (SELECT w FROM forms))
SELECT words.w AS word, form, coalesce(link, words.w) AS root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM words LEFT JOIN best ON a = words.w LEFT JOIN forms ON forms.w = words.w LEFT JOIN roots ON roots.w = words.w""")
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(slipped_words(documents(spark, folder)))
