"""Phrase collocations: counts of word sequences from an FM-index per shard, summed over shards.

A shard is a few megabytes of text. Its words become numbers of the shard's own dictionary,
and the sequence is indexed in both directions: rows of the index are text positions in the
order of the words that follow (or precede) them, and beside each row stands the word on the
other side, the Burrows-Wheeler transform. A phrase is an interval of rows in either index;
extending it by each word that occurs beside it, to the right or the left, gives the intervals
of all longer phrases with their counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import query
from tablewright.llm.documents import documents
from tablewright.llm.durable import durable, rank_of_keys, shuffle_partitions, stored

#: Bytes of text per shard. The counts do not depend on it.
SHARD_BYTES = 1 << 22
#: Bits of the filter of frequent phrases. Longer phrases that it lets through in error are counted and then leave.
FILTER_BITS = 25

#: Groups of which a number each is broadcast; the numbers of more are joined.
MAX_GROUPS = 10_000
#: Phrases in a batch that leaves a shard, and texts taken from a batch that comes.
_AT_ONCE, _TEXTS = 1 << 15, 256

_BREAK = b"\xff"  # occurs in no UTF-8 text
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes.maketrans(bytes(range(65, 91)) + _BREAKS + b"\t", bytes(range(97, 123)) + _BREAK * len(_BREAKS) + b" ")


def spaced(text: bytes) -> bytes:
    """The words of a text and the breaks between its pieces, with spaces between them; a break at the end."""
    return text.translate(_BYTES).replace(_BREAK, b" " + _BREAK + b" ") + b" " + _BREAK


def tokens(texts: list[bytes]) -> tuple[np.ndarray, list[int], pa.Array]:
    """Of spaced texts: a number per word or break, how many each text has, and the words by number."""
    lists = pc.split_pattern(pa.array(texts, pa.binary()), b" ")
    coded = lists.flatten().dictionary_encode()
    number, word = coded.indices.to_numpy(), coded.dictionary
    ends = lists.offsets.to_numpy()
    nothing = pc.index(word, pa.scalar(b"", pa.binary())).as_py()
    if nothing >= 0:  # between two spaces
        real = number != nothing
        ends = np.concatenate(([0], np.cumsum(real)))[ends]
        number = number[real]
    return number.astype(np.int64), np.diff(ends).tolist(), word


def suffix_order(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the ``depth`` words that begin there.

    By prefix doubling: ranks by h words and those h positions further on give ranks by 2h.
    What lies beyond the end sorts first.
    """
    n, reach = len(words), 1
    rank, order = words.astype(np.int64), None
    while reach < depth:
        step = min(reach, depth - reach)
        beyond = np.zeros(n, np.int64)
        beyond[: n - step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + beyond
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        reach += step
    return np.argsort(rank) if order is None else order


class Direction:
    """One half of the index, for phrases of up to ``depth`` words: the word before each row."""

    def __init__(self, words: np.ndarray, depth: int):
        order = suffix_order(words, depth)
        self.before = words[order - 1]  # position 0 is preceded by the last word, a break

    @cached_property
    def back(self) -> np.ndarray:
        """Per row that of the position one word back: rows keep their order within a word."""
        out = np.empty(len(self.before), np.int64)
        out[np.argsort(self.before, kind="stable")] = np.arange(len(out))
        return out


@dataclass
class Phrases:
    """Phrases of one length: words, first row in either direction, and number of rows."""

    words: np.ndarray  # a row per phrase
    forward: np.ndarray
    backward: np.ndarray
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.count)

    def where(self, keep: np.ndarray | slice) -> Phrases:
        return Phrases(self.words[keep], self.forward[keep], self.backward[keep], self.count[keep])


class ShardIndex:
    """Both directions over a shard's numbered words; 0 is the break, which begins and ends the sequence.

    ``left`` and ``right`` are the lengths of the longest phrases to be extended to that side.
    """

    def __init__(self, words: np.ndarray, n_words: int, left: int, right: int):
        self.words, self.n_words, self.left, self.right = words, n_words, left, right
        self.firsts = np.concatenate(([0], np.cumsum(np.bincount(words, minlength=n_words))))

    @cached_property
    def to_left(self) -> Direction:
        return Direction(self.words, self.left)

    @cached_property
    def to_right(self) -> Direction:
        return Direction(np.ascontiguousarray(self.words[::-1]), self.right)

    def single(self) -> Phrases:
        ids = np.arange(1, self.n_words)
        begin, n = self.firsts[1:-1], np.diff(self.firsts)[1:]
        return Phrases(ids[:, None], begin, begin, n).where(n > 0)

    def extend(self, phrases: Phrases, right: bool, once: bool = False) -> Phrases:
        """All phrases that are one of these and one more word to its right (or left).

        With ``once`` their rows on that side are not found, so they cannot be extended there.
        """
        index = self.to_right if right else self.to_left
        begin, other = (phrases.backward, phrases.forward) if right else (phrases.forward, phrases.backward)
        if not len(phrases):
            return Phrases(np.empty((0, phrases.words.shape[1] + 1), np.int64), begin, begin, begin)
        # All rows of all intervals, one interval after the other.
        before = np.concatenate(([0], np.cumsum(phrases.count)))
        parent = np.repeat(np.arange(len(phrases)), phrases.count)
        rows = np.arange(before[-1]) + (begin - before[:-1])[parent]
        # Rows in the order of parent and word; equal ones are one new interval, whose rows lie side by side.
        key = parent * self.n_words + index.before[rows]
        order = None if once else np.argsort(key, kind="stable")
        ordered = np.sort(key) if once else key[order]
        heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        n = np.diff(np.concatenate((heads, [len(ordered)])))
        parent, word = np.divmod(ordered[heads], self.n_words)
        # In the other direction the new interval begins after those of smaller words.
        moved = other[parent] + heads - before[parent]
        stepped = np.full(len(heads), -1) if once else index.back[rows[order[heads]]]
        old = phrases.words[parent]
        words = np.hstack((old, word[:, None])) if right else np.hstack((word[:, None], old))
        forward, backward = (moved, stepped) if right else (stepped, moved)
        return Phrases(words, forward, backward, n).where(word != 0)


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_hash(word_hashes: np.ndarray) -> np.ndarray:
    """One number per row of hashes of a phrase's words, dependent on their order."""
    out = np.zeros(len(word_hashes), np.uint64)
    for column in word_hashes.T:
        out = (out ^ column) * _MULTIPLIER
        out ^= out >> np.uint64(29)
    return out


def word_hashes(group: str, words: list[bytes]) -> np.ndarray:
    seed, digest = xxhash.xxh32_intdigest(group.encode()), xxhash.xxh64_intdigest
    return np.array([digest(w, seed) for w in words], np.uint64)


_COLUMNS = ["group", "phrase", "words", "n"]


class Shards:
    """Cuts batches of (group, text) into shards and yields the counts of their phrases.

    ``lengths`` are the lengths to count; a row of length 0 has a shard's words of a group if
    length 1 is counted.
    """

    def __init__(self, lengths: Sequence[int], filters: dict[int, np.ndarray], shard_bytes: int):
        self.lengths, self.filters, self.shard_bytes = lengths, filters, shard_bytes
        self.depth = max(lengths)
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[str, bytes]] = []
        self.size = 0

    def add(self, group: str, text: bytes) -> Iterator[pa.RecordBatch]:
        """A text that does not fit is continued in the next shard, which repeats its last words.

        What the repeated words count among themselves is taken off again.
        """
        rest = spaced(text)
        while rest:
            part, rest = rest, b""
            if len(part) > self.shard_bytes:
                cut = part.rfind(b" ", 0, self.shard_bytes)
                cut = part.find(b" ", self.shard_bytes) if cut <= 0 else cut
                tail = self.tail(part[:cut]) if cut > 0 else []
                following = b" ".join([*tail, part[cut + 1:]])
                if cut > 0 and len(following) < len(part):
                    part, rest = part[:cut] + b" " + _BREAK, following
                    for n in self.lengths:
                        yield from self.corrections(group, [tail[i:i + n] for i in range(len(tail) - n + 1)])
            self.parts.append((group, part))
            self.size += len(part)
            if self.size >= self.shard_bytes:
                yield from self.emit()

    def tail(self, part: bytes) -> list[bytes]:
        """The last words of a part's last piece that a phrase may begin with and go on behind."""
        words = part.rsplit(None, self.depth - 1)[1:] if self.depth > 1 else []
        if len(words) < self.depth - 1:
            words = part.split()[-(self.depth - 1):] if self.depth > 1 else []
        return words[len(words) - words[::-1].index(_BREAK):] if _BREAK in words else words

    def corrections(self, group: str, phrases: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        phrases = [p for p in phrases if self.allowed(word_hashes(group, p)[None, :])[0]]
        counts = [(b" ".join(p), len(p)) for p in phrases]
        counts += [(b"", 0)] * sum(len(p) == 1 for p in phrases)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array([group] * len(counts)), pa.array([p for p, _ in counts], pa.binary()).cast(pa.string()),
                 pa.array([n for _, n in counts], pa.int32()), pa.array([-1] * len(counts), pa.int64())], _COLUMNS)

    def allowed(self, hashes: np.ndarray) -> np.ndarray:
        """Phrases whose parts, one word shorter, may all be frequent."""
        n = hashes.shape[1] - 1
        if n not in self.filters:
            return np.ones(len(hashes), bool)
        return self.frequent(hashes[:, 1:]) & self.frequent(hashes[:, :-1])

    def frequent(self, hashes: np.ndarray) -> np.ndarray:
        bits = self.filters[hashes.shape[1]]
        at = gram_hash(hashes) & np.uint64(len(bits) * 64 - 1)
        return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0

    def numbered(self) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, pa.Array]:
        """The shard's sequence, its groups, and per number the group and the word; one word of two groups is two."""
        groups = sorted({g for g, _ in self.parts})
        place = {g: i for i, g in enumerate(groups)}
        number, sizes, word = tokens([p for _, p in self.parts])
        group = np.repeat([place[g] for g, _ in self.parts], sizes)
        if len(groups) * len(word) <= 1 << 24:
            key = group * len(word) + number
            seen = np.zeros(len(groups) * len(word), bool)
            seen[key] = True
            known = np.flatnonzero(seen)
            number = (np.cumsum(seen) - 1)[key]
        else:
            known, number = np.unique(group * len(word) + number, return_inverse=True)
        group, at = np.divmod(known, len(word))
        breaks = at == pc.index(word, pa.scalar(_BREAK, pa.binary())).as_py()
        # The break of any group is 0, words are numbered from 1.
        name = np.where(breaks, 0, np.cumsum(~breaks))
        sequence = np.concatenate(([0], name[number], [0]))
        return sequence, groups, group[~breaks], at[~breaks], word

    def emit(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        sequence, groups, of_group, at, word = self.numbered()
        self.clear()
        texts, names = word.take(pa.array(at)), pa.array(groups)
        hashes = None
        if self.filters:
            hashes = np.zeros(len(at) + 1, np.uint64)
            for k, group in enumerate(groups):
                mine = np.flatnonzero(of_group == k)
                hashes[mine + 1] = word_hashes(group, texts.take(pa.array(mine)).to_pylist())
        if 1 in self.lengths:
            n = np.bincount(of_group[sequence[sequence > 0] - 1], minlength=len(groups))
            yield pa.RecordBatch.from_arrays([names, pa.array([""] * len(groups)), pa.array([0] * len(groups), pa.int32()),
                                              pa.array(n.astype(np.int64))], _COLUMNS)
        # Even lengths come from extending to the right, odd ones to the left.
        index = ShardIndex(sequence, len(at) + 1, left=max(1, self.depth - 1), right=max(1, self.depth - 1 - self.depth % 2))
        phrases = index.single()
        for n in range(1, self.depth + 1):
            if n > 1:
                if n - 1 in self.filters:
                    phrases = phrases.where(self.frequent(hashes[phrases.words]))
                phrases = index.extend(phrases, right=n % 2 == 0, once=n + 2 > self.depth)
                if n - 1 in self.filters:
                    phrases = phrases.where(self.allowed(hashes[phrases.words]))
            for start in range(0, len(phrases) if n in self.lengths else 0, _AT_ONCE):
                some = phrases.where(slice(start, start + _AT_ONCE))
                columns = [texts.take(pa.array(some.words[:, k] - 1)) for k in range(n)]
                joined = pc.binary_join_element_wise(*columns, b" ") if n > 1 else columns[0]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(of_group[some.words[:, 0] - 1])), joined.cast(pa.string()),
                     pa.array(np.full(len(some), n, np.int32)), pa.array(some.count.astype(np.int64))], _COLUMNS)


def _shard_batches(lengths: Sequence[int], filters, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(lengths, filters.value if filters is not None else {}, shard_bytes)
        for whole in batches:
            for at in range(0, whole.num_rows, _TEXTS):
                batch = whole.slice(at, _TEXTS)
                for group, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                    yield from shards.add(group, text)
        yield from shards.emit()

    return run


def _filter_bits(n_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.array([word_hashes(g, p.split(b" ")) for g, p in zip(
                batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())], np.uint64)
            if len(hashes):
                at = gram_hash(hashes) & np.uint64(2**n_bits - 1)
                bits = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bits)], ["slot", "bits"])

    return run


def frequency_filter(phrases: DataFrame, n_bits: int = FILTER_BITS) -> np.ndarray:
    """One bit per hash of the phrases (group, phrase), which all have one length; of a size fixed beforehand."""
    rows = (phrases.select("group", "phrase").mapInArrow(_filter_bits(n_bits), "slot long, bits long")
            .groupBy("slot").agg(F.bit_or("bits").alias("bits")).collect())  # at most 2 ** (n_bits - 6) rows
    out = np.zeros(2 ** (n_bits - 6), np.uint64)
    if rows:
        out[[r["slot"] for r in rows]] = np.array([r["bits"] for r in rows], np.int64).view(np.uint64)
    return out


def phrase_counts(texts: DataFrame, max_words: int = 3, min_count: int = 10, shard_bytes: int = SHARD_BYTES,
                  filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Counts of a table (group, text): phrases (group, phrase, words, f) with f >= ``min_count``, and (group, n) words.

    Words and pairs are counted in one pass over the shards. Each further length takes a
    pass, in which intervals are only extended where both parts, one word shorter, may be
    frequent. Which those are the shards learn from a filter of fixed size; it decides alike
    in every shard, so sums stay exact, and the fuller it is the more rows are summed in vain.
    """
    if not 6 <= filter_bits <= 32 or max_words < 1 or min_count < 1 or shard_bytes < 1:
        raise ValueError("filter_bits must be 6 to 32; max_words, min_count and shard_bytes at least 1")
    context = texts.sparkSession.sparkContext

    def summed(lengths: list[int], filters: dict[int, np.ndarray]) -> DataFrame:
        shared = context.broadcast(filters) if filters else None
        rows = texts.mapInArrow(_shard_batches(lengths, shared, shard_bytes), "group string, phrase string, words int, n long")
        # A shard has summed its own, and most phrases are in few: they are summed once, after the shuffle.
        dealt = rows.repartition(shuffle_partitions(texts), "group", "phrase", "words")
        sums = dealt.groupBy("group", "phrase", "words").agg(F.sum("n").alias("f"))
        return stored(sums.filter((F.col("f") >= min_count) | (F.col("words") == 0)), "phrases")

    first = summed(list(range(1, min(2, max_words) + 1)), {})
    totals = first.filter("words = 0").select("group", F.col("f").alias("n"))
    frequent = first.filter("words > 0")
    filters: dict[int, np.ndarray] = {}
    for n in range(3, max_words + 1):
        filters[n - 1] = frequency_filter(frequent.filter(F.col("words") == n - 1), filter_bits)
        frequent = frequent.unionByName(summed([n], filters))
    return frequent.select("group", "phrase", "words", "f"), totals


def _part(first: Column | int, n: Column) -> Column:
    return F.array_join(F.slice("parts", first, n), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """(group, phrase, words, a, l, r, score): phrases of two words or more by their lowest-scoring cut.

    A cut after k words gives the score floor(1000000 a a / (l r)), in exact decimal
    arithmetic; both parts of a frequent phrase are frequent. Ties go to the smallest k.
    """
    cuts = (frequent.filter("words > 1").withColumn("parts", F.split("phrase", " "))
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .select("group", "phrase", "words", F.col("f").alias("a"), "k", _part(1, F.col("k")).alias("left"),
                    _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right")))
    known = frequent.select("group", "phrase", "f")
    both = (cuts.join(known.withColumnsRenamed({"phrase": "left", "f": "l"}), ["group", "left"])
            .join(known.withColumnsRenamed({"phrase": "right", "f": "r"}), ["group", "right"]))
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    up = (F.lit(1_000_000).cast("decimal(7,0)") * (exact["a"] * exact["a"]).cast("decimal(31,0)")).cast("decimal(38,0)")
    down = (exact["l"] * exact["r"]).cast("decimal(38,0)")
    both = both.withColumn("up", up).withColumn("down", down).withColumn("score", F.expr("up div down"))
    best = both.groupBy("group", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("group", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def outside_longer(frequent: DataFrame, candidates: DataFrame, percent: int = 50) -> DataFrame:
    """Candidates whose words do not lie inside a longer frequent phrase with at least ``percent`` of their count."""
    places = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: F.array_join(F.slice("parts", at, n), " "))))
    inside = (frequent.filter("words > 2").withColumn("parts", F.split("phrase", " "))
              .select("group", F.explode(F.array_distinct(places)).alias("phrase"), "f")
              .groupBy("group", "phrase").agg(F.max("f").alias("longest")))
    return (candidates.join(inside, ["group", "phrase"], "left")
            .filter(F.col("longest").isNull() | (100 * F.col("longest") < percent * F.col("a"))).drop("longest"))


def collocations(df: DataFrame, text_col: str = "text", group_col: str = "lang", max_words: int = 3, min_count: int = 10,
                 percent: int = 50, top: int = 2000, no_group: str = "und", **options) -> DataFrame:
    """(group, rank, phrase, a, l, r, n, score): each group's first ``top`` phrases of 2 to ``max_words`` words.

    Texts are lower-cased in A-Z and cut at ``. , ; : ! ?`` and line ends into pieces, those at
    spaces and tabs into words. Candidates occur ``min_count`` times or more within pieces of a
    group; see ``scored`` and ``outside_longer`` for their scores and which are dropped. Ranks
    go by score, then count, then the phrase's bytes, and are found from range partitions, so no
    task holds a group. Null text counts as empty, a null group as ``no_group``; repeated rows
    count each; a piece of any length is counted whole; other columns are not read; an empty table
    gives an empty result.
    """
    texts = df.select(F.coalesce(F.col(group_col).cast("string"), F.lit(no_group)).alias("group"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    frequent, totals = phrase_counts(texts, max_words, min_count, **options)
    kept = outside_longer(frequent, scored(frequent), percent)
    keys = kept.select("group", (-F.col("score")).alias("by_score"), (-F.col("a")).alias("by_count"), "phrase", "l", "r")
    ranked = rank_of_keys(keys, ["group", "by_score", "by_count", "phrase"], F.lit(1).cast("long"), "place")
    ranked = stored(ranked, "ranked")
    first = durable(ranked.groupBy("group").agg(F.min("place").alias("first")))
    if first.count() <= MAX_GROUPS:
        first = F.broadcast(first)
    place = (F.col("place") - F.col("first") + 1).cast("long")
    return (ranked.join(first, "group").withColumn("rank", place).filter(F.col("rank") <= top).join(totals, "group")
            .select("group", "rank", "phrase", (-F.col("by_count")).alias("a"), "l", "r", "n", (-F.col("by_score")).alias("score")))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS MATERIALIZED (
  SELECT lang, 1 AS words, phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS phrase FROM lists) GROUP BY ALL
  UNION ALL SELECT lang, 2, phrase, count(*) FROM (
    SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS phrase FROM lists) GROUP BY ALL
  UNION ALL SELECT lang, 3, phrase, count(*) FROM (
    SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS phrase
    FROM lists) GROUP BY ALL),
cand AS MATERIALIZED (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS p FROM grams WHERE words > 1 AND f >= 10),
cuts AS (SELECT lang, words, phrase, a, k, array_to_string(p[1:k], ' ') AS head, array_to_string(p[k + 1:], ' ') AS tail
         FROM (SELECT *, unnest(range(1, words)) AS k FROM cand)),
scores AS (SELECT c.lang, c.phrase, c.words, a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = head AND x.words = k
  JOIN grams y ON y.lang = c.lang AND y.phrase = tail AND y.words = c.words - k),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, part, max(a) AS longest FROM (
    SELECT lang, a, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS part FROM cand WHERE words = 3) GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE words = 1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT best.lang, phrase, a, l, r, score::BIGINT AS score,
         row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN inside ON inside.lang = best.lang AND part = phrase
  WHERE longest IS NULL OR 100 * longest < 50 * a) JOIN total USING (lang) WHERE rank <= 2000""")
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(documents(spark, folder)).withColumnRenamed("group", "lang")
