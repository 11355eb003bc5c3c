"""Shared helpers: table access, scratch tables, word patterns."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.scratch import materialize, scratch_root

__all__ = ["materialize", "scratch_root"]

#: The white space that separates words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Settings of the batches that a task hands to Python, each with Spark's default: rows, and bytes where rows are long.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("1000", "10000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("8388608", "67108864b")}


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in smaller batches, unless the session has a setting of its own: each batch is held by the task
    and by its Python worker at once. The settings stay with the session, as a stage's rows are computed after its function
    has returned."""
    for name, (value, default) in BATCHES.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, value)


def once(udf: Callable) -> Callable:
    """The function in Python with its result computed once where a filter follows: Spark pushes filters below functions that
    it holds for deterministic and computes them again there, in a second Python worker of the same task. Idle workers take
    turns and so stay for the rest of the session, each with its memory."""
    return udf.asNondeterministic()


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def squeeze(text: Column) -> Column:
    """The text without its white space."""
    return F.translate(text, SPACES, "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != "")


def join_groups(rows: DataFrame, groups: DataFrame, key: list[str], size: str, n: int) -> DataFrame:
    """rows left-joined to their group's row, where ``size`` is a group's number of rows and n that of all rows.

    Groups of over a thousandth of all rows (and of 1000 rows) are broadcast, of which there can't be more than a
    thousand, so that no task gets all rows of a large group. Key columns aren't null.
    """
    groups = materialize(groups, "groups")
    large = F.col(size) > max(1000, n // 1000)
    hot = F.broadcast(groups.where(large))
    return rows.join(hot, key).unionByName(rows.join(F.broadcast(groups.where(large).select(*key)), key, "left_anti").join(groups.where(~large), key, "left"))


@dataclass
class Bloom:
    """A set of keys (of several 64-bit integers each) that may answer yes for others too, of at most 16 MB."""

    words: np.ndarray
    most: int

    MOST, PAGE = 1 << 27, 1 << 12

    @staticmethod
    def _places(parts: tuple[np.ndarray, ...], most: int) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros(len(parts[0]), np.uint64)
        for part in parts:
            x = (x ^ part.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        x *= np.uint64(0xC2B2AE3D27D4EB4F)
        return (x >> np.uint64(33)) % np.uint64(most), (x & np.uint64(0xFFFFFFFF)) % np.uint64(most)

    @classmethod
    def of(cls, keys: DataFrame, *columns: str) -> Bloom:
        """Bits are set by the tasks and united by word, so the driver gets at most one row a word."""
        most = min(cls.MOST, max(1 << 12, 1 << (16 * keys.count()).bit_length()))

        @F.pandas_udf("array<long>")
        def places(*parts):
            return pd.Series(np.stack(cls._places(tuple(p.to_numpy(np.int64) for p in parts), most), axis=1).astype(np.int64).tolist())

        bits = keys.select(F.explode(places(*columns)).alias("p"))
        words = bits.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b"))

        def page(rows: pd.DataFrame) -> pd.DataFrame:
            out = np.zeros(cls.PAGE, np.uint64)
            at = rows["w"].to_numpy(np.int64)
            out[at % cls.PAGE] = rows["b"].to_numpy(np.int64).view(np.uint64)
            return pd.DataFrame({"page": [at[0] // cls.PAGE], "words": [out.tobytes()]})

        # the driver gets pages of the bit set, at most MOST / 8 bytes in all
        pages = words.groupBy(F.floor(F.col("w") / cls.PAGE)).applyInPandas(page, "page long, words binary").collect()
        held = np.zeros(max(most // 64, cls.PAGE), np.uint64)
        for r in pages:
            held[r["page"] * cls.PAGE : (r["page"] + 1) * cls.PAGE] = np.frombuffer(r["words"], np.uint64)
        return cls(held, most)

    def has(self, *parts: np.ndarray) -> np.ndarray:
        out = np.ones(len(parts[0]), bool)
        for at in self._places(parts, self.most):
            out &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


class Remembered(dict):
    """Values of a function by its argument; emptied when it has ``most``. Arguments of over 64 characters aren't kept."""

    def __init__(self, f: Callable, most: int):
        super().__init__()
        self.f, self.most = f, most

    def __missing__(self, key):
        value = self.f(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


_RELEASE: dict[str, Callable[[], None]] = {}


def settle() -> None:
    """Give memory that is free in this Python worker back to the machine, which it shares with other workers."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def claim(owner: str, release: Callable[[], None]) -> None:
    """Let go of what other operators remember in this Python worker, which tasks of one operator after another share.

    Operators let go at the end of a task themselves; a task that was stopped doesn't come to that.
    """
    others = [k for k in _RELEASE if k != owner]
    for other in others:
        _RELEASE.pop(other)()
    _RELEASE[owner] = release
    if others:
        settle()
