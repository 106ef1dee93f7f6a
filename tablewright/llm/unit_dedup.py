"""Substring deduplication by hashing lines and sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import query
from tablewright.llm.documents import document_key, documents, whole_text
from tablewright.llm.durable import durable, unused

#: A unit ends at a line's end, after a full stop, and where a capital follows a small letter: a
#: passage put into the middle of a sentence begins there.
_CAPITAL = "A-ZÀ-ÖØ-ÞΑ-ΩА-Я"
_SMALL = "a-zß-öø-ÿα-ωа-я"
_BREAK = re.compile(rf"\n\s*|[ \t]+(?:(?<=[.!?…][ \t])|(?<=[{_SMALL},;:][ \t])(?=[{_CAPITAL}]))\s*")

_STOPS = "。！？"
_CLOSERS = "」』”’）"
#: The same where a full stop needs no space behind it.
_BREAK_WIDE = re.compile(rf"{_BREAK.pattern}|(?:(?<=[{_STOPS}])(?![{_STOPS}{_CLOSERS}])|(?<=[{_STOPS}][{_CLOSERS}]))\s*")
#: Letters of scripts written without spaces: Thai, Lao, Myanmar, Khmer, kana, bopomofo and Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u312f\u31a0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
                       "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
#: So many code points count as a word in these scripts, and in a word longer than _LONG (an address, data).
_PER_WORD = 5
_LONG = 30


def extent(words: list[str]) -> int:
    """The length of words, in fifths of a word, so that text without spaces has one too."""
    if all(w.isascii() for w in words):
        return sum(_PER_WORD if len(w) <= _LONG else len(w) for w in words)
    out = 0
    for w in words:
        unspaced = len(_UNSPACED.findall(w))
        out += len(w) if unspaced or len(w) > _LONG else _PER_WORD
    return out


def split_units(text: str) -> list[tuple[int, int]]:
    """Spans of the lines and sentences of a text, without the white space between them."""
    spans, at = [], len(text) - len(text.lstrip())
    breaks = _BREAK_WIDE if any(c in text for c in _STOPS) else _BREAK
    for gap in breaks.finditer(text, at):
        end = gap.start()
        while end > at and text[end - 1].isspace():
            end -= 1
        if end > at:
            spans.append((at, end))
        at = gap.end()
    end = len(text.rstrip())
    if end > at:
        spans.append((at, end))
    return spans


def _digest(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode())


def _unit_batches(least: int):
    """Rows (key, unit, digest, again) of the units of at least ``least`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, unit, digests, again = [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                seen: set[bytes] = set()
                for i, (a, b) in enumerate(split_units(text)):
                    words = text[a:b].lower().split()
                    if extent(words) >= _PER_WORD * least:
                        digest = _digest(words)
                        owner.append(row)
                        unit.append(i)
                        digests.append(digest)
                        again.append(digest in seen)
                        seen.add(digest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(unit, pa.int32()),
                 pa.array(digests, pa.binary()), pa.array(again, pa.bool_())], ["key", "unit", "digest", "again"])

    return run


def removable(text: str, copies: set[int], least_unit: int, least_run: int) -> list[tuple[int, int]]:
    """Spans to remove: runs of copied units with at least ``least_run`` words.

    A unit too short to be hashed goes along between two copied ones.
    """
    spans, runs = split_units(text), []
    words = [extent(text[a:b].split()) for a, b in spans]
    first, last, count, between = None, None, 0, 0
    for i in range(len(spans) + 1):
        if i < len(spans) and i in copies:
            if first is None:
                first, count, between = i, 0, 0
            count, last, between = count + between + words[i], i, 0
        elif i < len(spans) and words[i] < _PER_WORD * least_unit and first is not None:
            between += words[i]
        else:
            if first is not None and count >= _PER_WORD * least_run:
                runs.append((spans[first][0], spans[last][1]))
            first = None
    return runs


def cut(text: str, removed: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without these spans, and the spans (start, length) of the original that it keeps."""
    kept, at = [], 0
    for a, b in removed:
        if a > at:
            kept.append((at, a - at))
        at = b + (b < len(text) and text[b].isspace())  # with the white space that ended it
    if len(text) > at:
        kept.append((at, len(text) - at))
    return "".join(text[a:a + n] for a, n in kept), kept


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def _cut_batches(text_at: int, least_unit: int, least_run: int, out: str):
    """Cuts the text in column ``text_at`` by the unit numbers in the last column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = [], []
            for text, copies in zip(batch.column(text_at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                runs = removable(text, set(copies), least_unit, least_run) if copies else []
                text, spans = cut(text, runs) if runs else (text, [(0, len(text))] if text else [])
                texts.append(text)
                kept.append([{"start": a, "length": n} for a, n in spans])
            columns = list(batch.columns)
            columns[text_at], columns[-1] = pa.array(texts, batch.column(text_at).type), pa.array(kept, _SPANS)
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], out])

    return run


def drop_repeated_passages(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_unit_words: int = 3, min_run_words: int = 10,
    spans_col: str = "kept_spans",
) -> DataFrame:
    """``df`` with later copies of passages taken out of its text, plus ``spans_col``.

    Texts are cut into units (lines, and sentences in them). A unit's normalised form
    (small letters, single spaces) is hashed to 128 bits, and digests are grouped over all
    documents. The earliest occurrence, by id (null last), then hash of the text, then
    offset, stays; a run of later copies with at least ``min_run_words`` words is
    removed. In scripts written without spaces, and in words of over 30 characters, five
    characters count as a word. ``spans_col`` lists start and length, in the original text, of what is kept.

    Units shrink to one row per digest and task before they are grouped, and only
    repeated digests are joined back, so a unit found in a third of all documents is one
    row there; the long side of that join is one Spark splits. Null text counts as
    empty. Rows equal in id and text are one document and get one result. The text of
    a later exact copy of some length becomes empty; its row stays. Other columns pass
    through whatever their names; an empty table gives an empty result.
    """
    text = whole_text(text_col)
    keyed = df.select(document_key(id_col, text).alias("key"), text.alias("text"))
    units = keyed.mapInArrow(_unit_batches(min_unit_words), "key decimal(38,0), unit int, digest binary, again boolean")
    repeated = units.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = durable(repeated.select("digest", "first"))  # a plain side, so Spark splits the other where one digest is hot
    key, copies = unused(df, "key"), unused(df, "copies")
    later = (units.join(repeated, "digest").filter("again OR key > first")
             .groupBy(F.col("key").alias(key)).agg(F.collect_set("unit").alias(copies)))
    at = df.columns.index(text_col)
    fields = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns]
    rows = (df.withColumn(key, document_key(id_col, text)).join(later, key, "left").select(*fields, copies))
    out = spans_col if spans_col not in df.columns else unused(df, spans_col)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return rows.mapInArrow(_cut_batches(at, min_unit_words, min_run_words, out),
                           f"{types}, `{out}` array<struct<start: bigint, length: bigint>>")


@query()
def op10_unit_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return drop_repeated_passages(docs)
