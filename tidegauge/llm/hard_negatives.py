"""Hard negatives: for each anchor and positive the best-scored rows of other labels within a window of scores.

Anchors are a query set that is compared with all rows in blocks: at most ANCHORS of them at a time are sent to the
tasks, which read the table once for the positives and once for the negatives, so that both what is sent and what a
task holds is bounded. A task multiplies tiles of anchors and candidates by Strassen's recursion on 64-bit integers; odd
sides are padded by zeros, and additions wrap around, so a score that fits into 64 bits is exact whatever the sums on
the way are. Scores go into heaps of the best few of each anchor (positives) or of each anchor and positive
(negatives), which know their worst row, so that nearly all of a tile is passed over at once. Heaps of tasks are merged
by rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import materialize

#: Anchors sent at once; rows and columns of a tile; sides up to which a product isn't split any more.
ANCHORS, TILE, SMALL = 4096, 512, 32
_LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices, modulo 2**64, by seven products of quarters."""
    (n, k), m = a.shape, b.shape[1]
    if min(n, k, m) <= SMALL:
        return a @ b
    h, i, j = (n + 1) // 2, (k + 1) // 2, (m + 1) // 2
    if (n | k | m) & 1:
        a, b = np.pad(a, ((0, 2 * h - n), (0, 2 * i - k))), np.pad(b, ((0, 2 * i - k), (0, 2 * j - m)))
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1, p2, p3 = strassen(a11 + a22, b11 + b22), strassen(a21 + a22, b11), strassen(a11, b12 - b22)
    p4, p5 = strassen(a22, b21 - b11), strassen(a11 + a12, b22)
    p6, p7 = strassen(a21 - a11, b11 + b12), strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * h, 2 * j), np.int64)
    out[:h, :j], out[:h, j:], out[h:, :j], out[h:, j:] = p1 + p4 - p5 + p7, p3 + p5, p2 + p4, p1 - p2 + p3 + p6
    return out[:n, :m]


@dataclass
class Heaps:
    """The ``most`` best (score, then smaller id) rows of each of a number of keys."""

    keys: np.ndarray
    scores: np.ndarray
    ids: np.ndarray
    worst: np.ndarray
    last: np.ndarray
    most: int

    @classmethod
    def empty(cls, number: int, most: int) -> Heaps:
        none = np.zeros(0, np.int64)
        return cls(none, none, none, np.full(number, _LEAST), np.full(number, np.iinfo(np.int64).max), most)

    def open(self, keys, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Where a row would enter its key's heap as it is now."""
        worst = self.worst[keys]
        return (scores > worst) | ((scores == worst) & (ids < self.last[keys]))

    def push(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k, s, i = (np.concatenate(x) for x in ((self.keys, keys), (self.scores, scores), (self.ids, ids)))
        order = np.lexsort((i, ~s, k))
        k, s, i = k[order], s[order], i[order]
        place = np.arange(len(k)) - np.searchsorted(k, k)
        kept, full = place < self.most, place == self.most - 1
        self.keys, self.scores, self.ids = k[kept], s[kept], i[kept]
        self.worst[k[full]], self.last[k[full]] = s[full], i[full]


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of integers, each filled up with zeros to the common width."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place < width  # what an anchor doesn't have counts as zero there
    out[row[inside], place[inside]] = flat[inside]
    return out


@dataclass
class Block:
    """Anchors of one pass, by id, and for the second reading the (place of the anchor, lowest, highest) of each window."""

    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray
    windows: np.ndarray

    def tiles(self) -> Iterator[tuple[int, int]]:
        for at in range(0, len(self.ids), TILE):
            yield at, min(len(self.ids), at + TILE)


def _scored(block: Block, rows: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Tile by tile the first anchor's place, the products, and the candidates' ids and labels."""
    ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
    matrix = _matrix(rows["v"], block.matrix.shape[1])
    for first in range(0, len(ids), TILE):
        part = slice(first, first + TILE)
        for at, upto in block.tiles():
            yield at, strassen(block.matrix[at:upto], np.ascontiguousarray(matrix[part].T)), ids[part], labels[part]


def _offer(heaps: Heaps, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
    row, column = np.nonzero(fits & heaps.open(keys[:, None], scores, ids[None, :]))
    if len(row):
        heaps.push(keys[row], scores[row, column], ids[column])


def _rows(batches: Iterator[pa.RecordBatch], block: Block, heaps: Heaps, offer: Callable) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for tile in _scored(block, rows):
            offer(*tile)
    yield pa.RecordBatch.from_arrays([pa.array(heaps.keys), pa.array(heaps.scores), pa.array(heaps.ids)], names=["key", "score", "id"])


def _positives(sent, most: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        heaps = Heaps.empty(len(block.ids), most)

        def offer(at: int, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
            own = slice(at, at + len(scores))
            fits = (block.labels[own, None] == labels[None, :]) & (block.ids[own, None] != ids[None, :])
            _offer(heaps, np.arange(at, at + len(scores)), scores, ids, fits)

        yield from _rows(batches, block, heaps, offer)

    return scan


def _negatives(sent, most: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        place, low, high = block.windows
        heaps = Heaps.empty(len(place), most)

        def offer(at: int, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
            lo, hi = np.searchsorted(place, [at, at + len(scores)])
            other = block.labels[at : at + len(scores), None] != labels[None, :]
            for nth in range(int(np.bincount(place[lo:hi] - at).max()) if hi > lo else 0):
                # the nth window of each anchor that has so many
                keys = np.arange(lo, hi)[np.arange(lo, hi) - np.searchsorted(place, place[lo:hi]) == nth]
                own = scores[place[keys] - at]
                fits = other[place[keys] - at] & (own >= low[keys, None]) & (own <= high[keys, None])
                _offer(heaps, keys, own, ids, fits)

        yield from _rows(batches, block, heaps, offer)

    return scan


def quantized(vectors: DataFrame, vector: str, shift: Column) -> DataFrame:
    """id, label, v (components times 256, rounded down) of the rows that take part; v's components fit into 64 bits."""
    cells = F.transform(vector, lambda x: F.floor(256 * x.cast("double")))
    inside = F.forall(vector, lambda x: F.coalesce(F.abs(256 * x.cast("double")) < float(2**63), F.lit(False)))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & inside
    return vectors.where(ok).select(F.col("vec_id").cast("long").alias("id"), shift.cast("long").alias("label"), cells.alias("v"))


def _best(heaps: DataFrame, most: int) -> DataFrame:
    """The ``most`` best rows of each key, with their rank."""
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


#: What is found: anchor, positive, place among the negatives, negative, and the two scores.
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _pass(spark, rows: DataFrame, anchors: pd.DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    width = max(map(len, anchors["v"]))
    matrix = np.zeros((len(anchors), width), np.int64)
    for at, v in enumerate(anchors["v"]):
        matrix[at, : len(v)] = v
    block = Block(anchors["id"].to_numpy(np.int64), anchors["label"].to_numpy(np.int64), matrix, np.zeros((3, 0), np.int64))
    heaps = rows.mapInArrow(_positives(spark.sparkContext.broadcast(block), positives), "key long, score long, id long")
    # at most ANCHORS * positives rows
    best = _best(heaps, positives).orderBy("key", "rank").toPandas()
    bounds = [(max(-(-low * s // 100), _LEAST), min(high * s // 100, -_LEAST - 1)) for s in map(int, best["score"])]
    block.windows = np.array([best["key"].tolist(), [b[0] for b in bounds], [b[1] for b in bounds]], np.int64)
    pairs = spark.createDataFrame(pd.DataFrame({"key": np.arange(len(best)), "anchor_id": block.ids[best["key"].to_numpy(np.int64)], "positive_id": best["id"], "positive_score": best["score"]}), "key long, anchor_id long, positive_id long, positive_score long")
    heaps = rows.mapInArrow(_negatives(spark.sparkContext.broadcast(block), negatives), "key long, score long, id long")
    found = _best(heaps, negatives).join(F.broadcast(pairs), "key")
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column | None = None, vector: str = "embedding", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors have vec_id, label (or the expression given) and a vector column. Each component becomes the integer part of
    256 times it, a score is the inner product of two rows. An anchor's positives are its best rows of the same label,
    a positive's negatives the best rows of other labels with low * positive_score <= 100 * negative_score <= high *
    positive_score; ties go to the smaller vec_id. Rows with a null id, label or vector, or with a component that is null,
    not finite or beyond 2**63 / 256 take no part; scores are taken modulo 2**64. A vector that is shorter than another
    counts as filled up with zeros. Repeated rows are rows each, but rows that share the anchor's vec_id are the anchor
    itself and never its positive, and of several anchor rows with one vec_id the one of least label, then vector is
    taken. Other columns are ignored; without anchors or positives there are no rows.
    """
    spark = vectors.sparkSession
    rows = quantized(vectors, vector, F.col("label") if label is None else label)
    chosen = quantized(vectors.where(is_anchor), vector, F.col("label") if label is None else label)
    chosen = materialize(chosen.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.*"), "anchors")
    total, last, found = chosen.count(), None, []
    for _ in range(0, total, ANCHORS):
        left = chosen if last is None else chosen.where(F.col("id") > last)
        anchors = left.orderBy("id").limit(ANCHORS).toPandas()
        last = int(anchors["id"].iloc[-1])
        part = _pass(spark, rows, anchors, positives, negatives, low, high)
        found.append(materialize(part, "negatives") if total > ANCHORS else part)
    out = spark.createDataFrame([], FOUND)
    for part in found:
        out = out.unionByName(part)
    return found[0] if len(found) == 1 else out
