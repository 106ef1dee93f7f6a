"""Range lookup between two tables: overlapping bands become disjoint segments, which keys meet in sorted order."""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.operators.ranks import checkpointed, partitions

#: Ends of bands in a slice, besides those on its last edge; a slice's pieces are swept in memory.
SLICE_ENDS = 50_000


def _slice_begins(ends: int):
    """The first of every run of sorted edges (edge, n) that ``ends`` ends of bands lie on, and of the partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = 0, -1
        for batch in batches:
            n = batch.column(1).to_numpy()
            run_of = (before + np.cumsum(n) - n) // ends
            begins = np.diff(run_of, prepend=last) > 0
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(begins))], ["edge"])
            if len(n):
                before, last = before + int(n.sum()), int(run_of[-1])

    return run


def _slice_of(value: Column, bounds: Sequence[float]) -> Column:
    """The number of the slice that holds a value; slices begin at the bounds."""
    edges = np.array(bounds)

    @F.pandas_udf("int")
    def find(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, values.to_numpy(), side="right") - 1, dtype="int32")

    return find(value)


def _covering_nodes(first: Column, end: Column, slices: int) -> Column:
    """The slices from ``first`` to before ``end`` as nodes of a binary tree over all slices, at most two a level."""
    nodes = []
    for level in range(slices.bit_length() + 1):
        low = F.ceil((first + slices) / F.lit(2.0**level)).cast("long")
        high = F.floor((end + slices) / F.lit(2.0**level)).cast("long")
        nodes += [F.when((low < high) & (low % 2 == 1), low), F.when((low < high) & (high % 2 == 1), high - 1)]
    return F.filter(F.array(*nodes), lambda n: n.isNotNull())


def _sweep(bounds: Sequence[float], covers: dict[int, tuple], half_open: bool):
    """Per slice: from edge to edge with a heap of the bands that hold, the first of which wins."""
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        at = int(pieces["slice"].iloc[0])
        cover = covers.get(at)
        start = bounds[at]
        rows = sorted(zip(np.where(pieces["begins"], pieces["lo"], start).tolist(), np.where(pieces["ends"], pieces["hi"], np.inf).tolist(),
                          pieces["ends"].tolist(), pieces["idx"].tolist(), pieces["rate"].tolist()))
        edges = sorted({start, *(r[0] for r in rows), *(r[1] for r in rows if r[2])})
        heap, used, on, after = [], 0, [], []

        def first():
            best = heap[0] if heap and (cover is None or heap[0][0] <= cover[0]) else cover
            return np.nan if best is None or best[1] is None else best[1]

        for edge in edges:
            while used < len(rows) and rows[used][0] <= edge:
                _, hi, ends, idx, rate = rows[used]
                heapq.heappush(heap, (idx, rate, hi, ends))
                used += 1
            # A piece that goes on beyond the slice has no end here.
            while heap and heap[0][3] and (heap[0][2] <= edge if half_open else heap[0][2] < edge):
                heapq.heappop(heap)
            on.append(first())
            while heap and heap[0][3] and heap[0][2] <= edge:
                heapq.heappop(heap)
            after.append(first())
        return pd.DataFrame({"edge": edges, "at": pd.array(on, "Float64"), "after": pd.array(after, "Float64")})

    return run


def disjoint_segments(bands: DataFrame, half_open: bool = False, slice_ends: int = SLICE_ENDS) -> DataFrame:
    """(edge, at, after): the rate on each edge, and between it and the next, of the first band (idx, lo, hi, rate) there.

    Edges are cut into slices on which ``slice_ends`` ends of bands lie, so there are more of
    them where there are more bands, and none gives more pieces than twice that. A band is known to the slices of its
    ends, as a piece; slices that it covers whole learn only the first band that covers
    them, from minima over the nodes of a tree of slices. So a band gives a number of rows that
    grows with the logarithm of the slices, however much it overlaps, and pieces that reach
    a slice's end collapse by their other end before they meet. The driver holds a few
    numbers per slice.
    """
    hi = F.col("hi").cast("double") + (1.0 if half_open else 0.0)
    bands = (bands.select("idx", F.col("lo").cast("double").alias("lo"), hi.alias("hi"), F.col("rate").cast("double").alias("rate"))
             .filter("lo <= hi AND NOT isnan(hi)").groupBy("lo", "hi").agg(F.min(F.struct("idx", "rate")).alias("first")))
    bands = checkpointed(bands)
    edges = bands.select(F.explode(F.array("lo", "hi")).alias("edge")).groupBy("edge").agg(F.count(F.lit(1)).alias("n"))
    begins = (edges.repartitionByRange(partitions(bands), "edge").sortWithinPartitions("edge")
              .mapInArrow(_slice_begins(slice_ends), "edge double").collect())
    bounds = sorted(r["edge"] for r in begins)
    slices = len(bounds)
    placed = bands.withColumns({"first_slice": _slice_of(F.col("lo"), bounds or [0.0]),
                                "last_slice": _slice_of(F.col("hi"), bounds or [0.0])})

    nodes = _covering_nodes(F.col("first_slice") + 1, F.col("last_slice"), max(1, slices))
    wide = (placed.filter("last_slice - first_slice > 1").select("first", F.explode(nodes).alias("node"))
            .groupBy("node").agg(F.min("first").alias("first")).collect())  # at most two per slice
    tree = {r["node"]: (r["first"]["idx"], r["first"]["rate"]) for r in wide}
    covers = {}
    for s in range(slices):
        node, over = s + slices, []
        while node:
            over += [tree[node]] if node in tree else []
            node //= 2
        if over:
            covers[s] = min(over, key=lambda b: b[0])

    one = F.col("first_slice") == F.col("last_slice")

    def piece(slice_: str, begins: bool, ends: bool) -> Column:
        none = F.lit(None).cast("double")
        return F.struct(F.col(slice_).alias("slice"), F.lit(begins).alias("begins"), F.lit(ends).alias("ends"),
                        (F.col("lo") if begins else none).alias("lo"), (F.col("hi") if ends else none).alias("hi"))

    pieces = F.when(one, F.array(piece("first_slice", True, True))).otherwise(
        F.array(piece("first_slice", True, False), piece("last_slice", False, True)))
    grouped = (placed.select("first", F.explode(pieces).alias("piece")).groupBy("piece.slice", "piece.begins", "piece.ends", "piece.lo", "piece.hi")
               .agg(F.min("first").alias("first"))
               .select("slice", "begins", "ends", "lo", "hi", "first.idx", "first.rate"))
    return grouped.groupBy("slice").applyInPandas(_sweep(bounds, covers, half_open), "edge double, at double, after double")


def as_of(keys: DataFrame, segments: DataFrame) -> DataFrame:
    """(key, rate) of the keys, which are distinct numbers, that lie on an edge or in a segment with a rate.

    Keys and edges are dealt by range together; in each partition a key takes the last
    edge up to it. Of an earlier partition's edges only the last matters, one row each.
    """
    nothing = F.lit(None).cast("double")
    both = segments.select(F.col("edge").alias("place"), F.lit(0).alias("asks"), "at", "after").unionByName(
        keys.select(F.col("key").alias("place"), F.lit(1).alias("asks"), nothing.alias("at"), nothing.alias("after")))
    dealt = checkpointed(both.repartitionByRange(partitions(keys), "place", "asks").withColumn("part", F.spark_partition_id()))
    edge = F.struct("place", "at", "after")
    last = dealt.filter("asks = 0").groupBy("part").agg(F.max(edge).alias("edge")).collect()
    parts, ends = zip(*sorted((r["part"], tuple(r["edge"])) for r in last)) if last else ((), ())
    spark = keys.sparkSession
    carried = [(p, ends[bisect_right(parts, p - 1) - 1]) for p in range(partitions(keys)) if bisect_right(parts, p - 1)]
    before = spark.createDataFrame(carried, "part int, carried struct<place: double, at: double, after: double>")
    upto = Window.partitionBy("part").orderBy("place", "asks").rowsBetween(Window.unboundedPreceding, 0)
    found = (dealt.withColumn("own", F.last(F.when(F.col("asks") == 0, edge), ignorenulls=True).over(upto)).filter("asks = 1")
             .join(F.broadcast(before), "part", "left")  # one row per partition
             .withColumn("edge", F.coalesce("own", "carried")))
    rate = F.when(F.col("edge.place") == F.col("place"), F.col("edge.at")).otherwise(F.col("edge.after"))
    return found.select(F.col("place").alias("key"), rate.alias("rate")).filter("rate IS NOT NULL")
