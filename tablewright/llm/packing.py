"""Packing documents into token sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import heapq
import json
import re
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm import query
from tablewright.llm.documents import documents
from tablewright.llm.durable import stored

#: Sequences of full blocks are numbered by the task that cut them, above all packs.
_PART_BITS = 40


#: How the word tokenizer normalizes and splits; its vocabulary marks a word's last token.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"

#: The same split for small-letter texts of these characters alone, all stable under NFC.
_PLAIN = re.compile(r"[\t\n\v\f\r -~À-ÿ¡-©«-´¶-¹»-¿–—‘’“”…€]*")
_PARTS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\sa-zß-öø-ÿ0-9²³¹¼½¾]+")


class TextTokens:
    """Token ids of texts by a tokenizer file, without special tokens.

    For tokenizers that cut small-letter words one by one, the ids of recent words are
    remembered: plain Latin texts are looked up word by word, and only words not
    remembered reach the tokenizer. Any other text or tokenizer is encoded whole. At most
    ``most_words`` words are remembered.
    """

    LEARN = 16384

    def __init__(self, path: str, most_words: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as file:
            setup = json.load(file)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.specials = [t["content"] for t in setup["added_tokens"]]
        self.by_word = (
            [n["type"] for n in (setup["normalizer"] or {}).get("normalizers", [])] == _NORMALIZERS
            and [p.get("pattern") for p in (setup["pre_tokenizer"] or {}).get("pretokenizers", [])] == [{"Regex": _SPLIT}, None]
            and setup["model"].get("end_of_word_suffix") == _WORD_END and not setup["post_processor"])
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.most, self.words = most_words, {}
        if self.by_word:  # words come normalized and split, so a tokenizer that only merges will do
            setup |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
                {"type": "WhitespaceSplit"}, setup["pre_tokenizer"]["pretokenizers"][1]]}}
            self.merger = Tokenizer.from_str(json.dumps(setup))

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        ids = np.array(self.merger.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.kind)
        ends, packed, width = (np.flatnonzero(self.ends[ids]) + 1).tolist(), ids.tobytes(), self.kind.itemsize
        if len(ends) != len(words):
            raise ValueError("the tokenizer does not mark the end of each word")
        self.words.update((w, packed[a * width:b * width]) for w, a, b in zip(words, [0, *ends], ends))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed as ``kind``."""
        if not self.by_word:
            return [ids.tobytes() for ids in self._whole(texts)]
        if len(self.words) > self.most:
            self.words.clear()
        plain = [_PLAIN.fullmatch(t) is not None and not any(s in t for s in self.specials) for t in texts]
        split = [_PARTS.findall(t.lower()) if p else None for t, p in zip(texts, plain)]
        new = list(set().union(*filter(None, split)) - self.words.keys())
        for at in range(0, len(new), self.LEARN):
            self._learn(new[at:at + self.LEARN])
        get, other = self.words.__getitem__, iter(self._whole([t for t, p in zip(texts, plain) if not p]))
        return [next(other).tobytes() if words is None else b"".join(map(get, words)) for words in split]


def _token_batches(path: str, end_id: int, size: int):
    """Rows (id, ids, doc_tokens, rest, part, own, blocks): whole documents as ids.

    ``own`` counts documents with the same rest in this task so far, ``blocks`` its full blocks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = TextTokens(path), TaskContext.get().partitionId()
        end, seen, blocks = np.array([end_id], tokens.kind).tobytes(), defaultdict(int), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                few = batch.slice(at, 512)
                ids = [x + end for x in tokens.encode([t or "" for t in few.column(1).to_pylist()])]
                rows = []
                for x in ids:
                    n = len(x) // tokens.kind.itemsize
                    rows.append((n, n % size, seen[n % size], blocks))
                    seen[n % size] += 1
                    blocks += n // size
                n, rest, own, before = (pa.array(c, pa.int64()) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [few.column(0), pa.array(ids, pa.binary()), n, rest, pa.array([part] * len(ids), pa.int64()), own, before],
                    ["id", "ids", "doc_tokens", "rest", "part", "own", "blocks"])

    return run


@dataclass
class _Batch:
    """``count`` packs of one pattern. items: (length class, first rank, start in the rest, length)."""

    count: int
    used: int
    items: tuple[tuple[int, int, int, int], ...]

    def take(self, n: int) -> tuple[_Batch, _Batch]:
        later = tuple((r, rank + n, start, length) for r, rank, start, length in self.items)
        return _Batch(n, self.used, self.items), _Batch(self.count - n, self.used, later)

    def add(self, item: tuple[int, int, int, int]) -> _Batch:
        return _Batch(self.count, self.used + item[3], (*self.items, item))


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[_Batch]:
    """Patterns and their counts: lengths longest first, each into the pack with most room.

    Packs of one pattern are one entry, so the work depends on the number of lengths.
    """
    heap: list[tuple[int, int, _Batch]] = []
    made = 0

    def push(batch: _Batch) -> None:
        nonlocal made
        if batch.count:
            made += 1
            heapq.heappush(heap, (batch.used, made, batch))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if not heap or size - heap[0][0] < length:
                push(_Batch(-(-left // (size // length)), 0, ()))
            batch = heapq.heappop(heap)[2]
            n = min(batch.count, left)
            placed, others = batch.take(n)
            push(placed.add((length, rank, 0, length)))
            push(others)
            rank, left = rank + n, left - n
    return [b for _, _, b in heap if b.used]


def fill_up(batches: list[_Batch], size: int) -> list[_Batch]:
    """The same documents without padding: the emptiest packs are cut up to fill the others.

    As many packs stay as the tokens fill; what is left over, less than one pack, goes into
    sequences whose lengths are powers of two, which need no padding either.
    """
    total = sum(b.count * b.used for b in batches)
    full, rest = divmod(total, size)
    stock: dict[int, list[list]] = defaultdict(list)  # by length: [count, class, first rank, start]
    lengths: list[int] = []

    def put(length: int, count: int, kind: int, rank: int, start: int) -> None:
        if count:
            if not stock[length]:
                insort(lengths, length)
            stock[length].append([count, kind, rank, start])

    open_packs: list[tuple[_Batch, int]] = []
    for batch in sorted(batches, key=lambda b: -b.used):
        stay, go = batch.take(min(batch.count, full))
        full -= stay.count
        if stay.count:
            open_packs.append((stay, size))
        for kind, rank, start, length in go.items:
            put(length, go.count, kind, rank, start)
    open_packs += [(_Batch(1, 0, ()), 1 << k) for k in reversed(range(size.bit_length())) if rest >> k & 1]
    done = []
    while open_packs:
        batch, room = open_packs.pop()
        gap = room - batch.used
        if not gap:
            done.append(batch)
            continue
        at = bisect_right(lengths, gap) - 1  # the longest that fits whole, or else a cut of the longest
        length = lengths[max(at, 0) if at >= 0 else len(lengths) - 1]
        entry = stock[length][-1]
        n = min(batch.count, entry[0])
        now, later = batch.take(n)
        used = min(length, gap)
        _, kind, rank, start = entry
        entry[0], entry[2] = entry[0] - n, rank + n
        if not entry[0]:
            stock[length].pop()
            if not stock[length]:
                lengths.remove(length)
        put(length - used, n if length > used else 0, kind, rank, start + used)
        if later.count:
            open_packs.append((later, room))
        open_packs.append((now.add((kind, rank, start, used)), room))
    return done


@dataclass(frozen=True)
class PackPlan:
    """For each length class, rank intervals and the pieces that a document in one is cut into.

    ``pieces``: rows (start, length, sequence of the interval's first rank, offset), interval by interval.
    """

    packs: int
    starts: dict[int, np.ndarray]
    bounds: dict[int, np.ndarray]
    pieces: dict[int, np.ndarray]

    def of(self, rest: int, rank: int) -> list[tuple[int, int, int, int]]:
        i = int(np.searchsorted(self.starts[rest], rank, "right")) - 1
        first, at = int(self.starts[rest][i]), self.bounds[rest]
        return [(s, n, q + rank - first, o) for s, n, q, o in self.pieces[rest][at[i]:at[i + 1]].tolist()]


def plan_packs(histogram: dict[int, int], size: int) -> PackPlan:
    """Where the document of each length and rank goes; as large as the histogram, not the corpus."""
    batches = fill_up(shortest_pack_first({r: n for r, n in histogram.items() if r and n}, size), size)
    items: dict[int, list[tuple[int, int, int, int, int, int]]] = defaultdict(list)
    sequence = 0
    for batch in batches:
        offset = 0
        for kind, rank, start, length in batch.items:
            items[kind].append((rank, rank + batch.count, start, length, sequence, offset))
            offset += length
        sequence += batch.count
    starts, bounds, pieces = {}, {}, {}
    for kind, of in items.items():
        of.sort()
        edges = sorted({e for rank, end, *_ in of for e in (rank, end)})[:-1]
        rows, at, active, begin = [], [0], [], 0
        for edge in edges:
            while begin < len(of) and of[begin][0] <= edge:
                active.append(of[begin])
                begin += 1
            active = [x for x in active if x[1] > edge]
            rows += sorted((start, length, seq + edge - rank, offset) for rank, _, start, length, seq, offset in active)
            at.append(len(rows))
        starts[kind], bounds[kind] = np.array(edges, np.int64), np.array(at, np.int64)
        pieces[kind] = np.array(rows, np.int64).reshape(-1, 4)
    return PackPlan(sequence, starts, bounds, pieces)


def _piece_batches(plan: PackPlan, size: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            column = {n: batch.column(names.index(n)).to_pylist() for n in names if n != "id"}
            owner, out = [], []
            for row, ids in enumerate(column["ids"]):
                total, rest = column["doc_tokens"][row], column["rest"][row]
                full, first = total // size, ((column["part"][row] + 1) << _PART_BITS) + column["blocks"][row]
                cuts = [(k * size, size, first + k, 0) for k in range(full)]
                if rest:
                    cuts += [(full * size + s, n, q, o)
                             for s, n, q, o in plan.of(rest, column["base"][row] + column["own"][row])]
                wide = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
                for start, length, sequence, offset in cuts:
                    owner.append(row)
                    out.append((start, length, wide[4 * start:4 * (start + length)], total, sequence, offset))
            start, length, ids, total, sequence, offset = zip(*out) if out else [()] * 6
            longs = [pa.array(c, pa.int64()) for c in (start, length, total, sequence, offset)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index("id")).take(pa.array(owner, pa.int64())), longs[0], longs[1],
                 pa.array(ids, pa.binary()), *longs[2:]],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return run


def pack_documents(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end_id: int = 1,
) -> DataFrame:
    """(id, start, length, ids, doc_tokens, sequence_id, offset): pieces of documents in sequences.

    A document is its token ids and ``end_id``. Full blocks of ``size`` ids are sequences
    of their own; the rests are packed whole, shortest pack first, by a plan over the
    histogram of their lengths, and the emptiest packs are cut up to fill the others.
    Documents find their place in the plan by their rank among rests of one length.
    ``ids`` holds the piece as little-endian unsigned 32-bit numbers.

    Texts are tokenized once, into a stored table of ids. Ranks need no sort: each task
    counts rests by length, and one sum per task and length is laid before it, so
    a length that a third of all documents share is counted, not gathered. The driver
    sees the histogram (``size`` numbers) and the plan grows with it alone.

    Null text counts as empty and is the single ``end_id``. Ids may repeat or be null:
    every row is packed. Other columns are not read; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    tokens = stored(rows.mapInArrow(_token_batches(tokenizer_path, end_id, size),
                                    f"id {kind}, ids binary, doc_tokens long, rest long, part long, own long, blocks long"), "tokens", "zstd")
    width = TextTokens(tokenizer_path).kind.itemsize
    counts = tokens.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["rest"]: r["n"] for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    placed = tokens.join(bases, ["part", "rest"])
    return placed.mapInArrow(
        _piece_batches(plan_packs(histogram, size), size, width),
        f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    ).withColumnRenamed("id", id_col)


@query()
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_digests(documents(spark, folder))


def packed_digests(docs: DataFrame) -> DataFrame:
    """The pieces of packed documents with a checksum in place of their ids."""
    import public_tokenizers

    pieces = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
