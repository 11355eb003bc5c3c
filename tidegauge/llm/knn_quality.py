"""Quality classifier by nearest-neighbour voting over latent-semantic vectors.

A text becomes counts over hashed words, word shapes and a few habits of the whole text; log-weighted and scaled by
inverse document frequency they are projected onto the leading singular directions of a bounded labelled sample. The
sample's unit vectors and labels are broadcast; for every document the exact cosines to all of them are computed in
blocks as one matrix product, and the nearest vote with their similarity.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import Remembered, claim, settle

#: Labelled rows that the classifier is fitted on at most, half of them of either label where there are enough.
SAMPLE = 4096
#: Hashed words, hashed shapes, habits; singular directions; neighbours that vote.
WORDS, SHAPES, HABITS, DIMENSIONS, NEIGHBOURS = 512, 256, 96, 48, 25
SIZE = WORDS + SHAPES + HABITS
REMEMBERED = 100_000
#: Documents in a block of the product.
BLOCK = 512

_RUN = re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """The word with letters as A or a, digits as 0, other characters as they are, and runs made single."""
    out = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _RUN.sub(r"\1", out)


def _place(word: str) -> int:
    """The word's place among words * SHAPES + its place among shapes."""
    return zlib.crc32(word.encode()) % WORDS * SHAPES + zlib.crc32(shape(word[:200]).encode()) % SHAPES


_PLACES = Remembered(_place, REMEMBERED)


def _step(share: float, n: int) -> int:
    """A share as one of n steps, finer near zero."""
    return min(n - 1, int(n * share**0.5))


def count_vector(text: str) -> np.ndarray:
    """Log-weighted counts of a whole text; an empty one has its habits alone."""
    out = np.zeros(SIZE, np.float32)
    words = text.split()
    n = len(words)
    if n:
        places = np.fromiter(map(_PLACES.__getitem__, words), np.int64, n)
        out[:WORDS] = np.bincount(places // SHAPES, minlength=WORDS)
        out[WORDS : WORDS + SHAPES] = np.bincount(places % SHAPES, minlength=SHAPES)
        np.log1p(out, out=out)
        distinct = len(set(words))
        repeated = int((places[1:] == places[:-1]).sum())
        common = Counter(words).most_common(1)[0][1]
        letters = sum(map(len, words))
        lines = [x for x in text.split("\n") if x.strip()]
        shares = (
            distinct / n**0.9 if n > 1 else 1.0,
            repeated / n,
            common / n,
            sum(map(text.count, "#*$%&|<>")) / letters,
            sum(map(text.count, "!?")) / letters,
            sum(map(text.count, ".,;:")) / letters,
            1 - len(set(lines)) / len(lines),
            sum(1 for w in words if w.isupper()) / n,
            sum(1 for w in words if w.isalpha()) / n,
        )
    else:
        shares = (0.0,) * 9
    base = WORDS + SHAPES
    for k, share in enumerate(shares):
        out[base + 9 * k + min(8, _step(min(1.0, share), 9))] = 3.0
    out[base + 81 + min(14, n.bit_length())] = 2.0
    return out


@dataclass
class Neighbours:
    """Fitted classifier: weights of the counts, projection, the sample's unit vectors and labels."""

    weight: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def bytes(self) -> int:
        return sum(x.nbytes for x in (self.weight, self.projection, self.vectors, self.labels))

    def embed(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors; zero where nothing is known of a text."""
        x = counts * self.weight
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        x = x @ self.projection
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest; 0.5 without a labelled sample."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        near = self.embed(counts) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        at = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, at, 1), 1e-6).astype(np.float64) ** 4
        return np.clip((weight * self.labels[at]).sum(1) / weight.sum(1), 0.0, 1.0)


def fit(counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Neighbours:
    n = len(labels)
    seen = (counts > 0).sum(0)
    weight = np.log((1 + n) / (1 + seen)).astype(np.float32) + 0.3
    if not n:
        return Neighbours(weight, np.zeros((SIZE, dimensions), np.float32), np.zeros((0, dimensions), np.float32), labels.astype(np.float64))
    x = counts * weight
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    values, directions = np.linalg.eigh((x.T @ x).astype(np.float64))
    projection = directions[:, ::-1][:, :dimensions].astype(np.float32)
    model = Neighbours(weight, projection, np.zeros((0, dimensions), np.float32), labels.astype(np.float64))
    model.vectors = model.embed(counts)
    return model


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Count vectors and labels of at most ``size`` labelled rows that are not held out, the same at each run: of
    either label the first by hash, half the size each, and more of the one where the other has fewer."""
    known = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("_y"))
    order = F.xxhash64("doc_id", F.lit(7))
    ids = {y: known.where(F.col("_y") == y).orderBy(order, "doc_id").limit(size).select("doc_id", "_y") for y in (0, 1)}
    rows = {y: x.collect() for y, x in ids.items()}  # at most 2 * size ids
    half = size // 2
    take = {y: rows[y][: max(half, size - len(rows[1 - y]))] for y in (0, 1)}
    spark = docs.sparkSession
    chosen = spark.createDataFrame([tuple(r) for y in (0, 1) for r in take[y]], "_id long, _y int")

    @F.pandas_udf("binary")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        claim("places", _PLACES.clear)
        for texts in batches:
            yield pd.Series([count_vector(x or "").astype(np.float16).tobytes() for x in texts])
        _PLACES.clear()

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # of several texts of an id the longest, of equally long ones that of the greatest hash
    texts = texts.groupBy("doc_id", "_y").agg(F.max_by("text", F.struct(F.length("text"), F.xxhash64("text"))).alias("text"))
    found = texts.select("doc_id", "_y", counted("text").alias("_v"))
    got = sorted(found.collect(), key=lambda r: r["doc_id"])  # at most size vectors of 2 * SIZE bytes
    counts = np.stack([np.frombuffer(r["_v"], np.float16).astype(np.float32) for r in got]) if got else np.zeros((0, SIZE), np.float32)
    return counts, np.array([r["_y"] for r in got])


def model(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Neighbours:
    return fit(*sample(docs, labels, size))


def _score(fitted: Neighbours, docs: DataFrame) -> Column:
    held = docs.sparkSession.sparkContext.broadcast(fitted)  # at most some 3 MB

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        claim("places", _PLACES.clear)
        own = held.value
        for texts in batches:
            parts = []
            for at in range(0, len(texts), BLOCK):
                parts.append(own.score(np.stack([count_vector(x or "") for x in texts.iloc[at : at + BLOCK]])))
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))
        _PLACES.clear()
        settle()

    return scored(F.col("text").cast("string"))


def accepted(docs: DataFrame, fitted: Neighbours) -> DataFrame:
    """The rows of docs with a score of 0.5 at least, with all their columns."""
    return docs.where(_score(fitted, docs) >= 0.5)


def knn_quality(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from its whole text alone.

    score is the likelihood of label 1 (0 to 1), predicted 1 from 0.5 on. Null and empty texts are scored as texts
    without words; without any labelled row every score is 0.5. Labels other than 0 and 1 are ignored and of several
    labels of a doc_id the greater counts. Repeated rows are scored one by one; other columns are never read.
    """
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), _score(model(docs, labels, size), docs).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
