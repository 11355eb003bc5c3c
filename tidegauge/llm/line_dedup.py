"""Line deduplication by site-relative frequency: a line that too large a share of a site's pages has is boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import materialize, squeeze, text_of

RATIO = 0.02
MIN_PAGES = 3
#: Rows of the boilerplate table up to which it is broadcast; each is at most some 60 bytes.
BROADCAST_ROWS = 200_000
#: Parts that a host's boilerplate lines are dealt into, so that a line is compared with few of them.
PARTS = 64


def _key(line: Column) -> Column:
    """128 bits of the line without white space at its ends."""
    trimmed = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.struct(F.xxhash64(trimmed).alias("a"), F.xxhash64(F.lit("second"), trimmed).alias("b"))


def boilerplate(docs: DataFrame, host: str, ratio: float, min_pages: int) -> DataFrame:
    """host, a, b of each line that over ``ratio`` of the host's pages, and ``min_pages`` of them at least, contain.

    A host has at most (lines per page) / ratio of them.
    """
    pages = docs.select(F.col(host).alias("_host"), text_of().alias("_t"))
    totals = pages.groupBy("_host").agg(F.count("*").alias("_pages"))
    solid = F.filter(F.split("_t", "\n"), lambda x: F.length(squeeze(x)) > 0)
    lines = pages.select("_host", F.explode(F.array_distinct(F.transform(solid, _key))).alias("_l"))
    counts = lines.groupBy("_host", F.col("_l.a").alias("a"), F.col("_l.b").alias("b")).agg(F.count("*").alias("_with"))
    often = counts.where(F.col("_with") >= min_pages).join(totals, counts["_host"].eqNullSafe(totals["_host"])).drop(totals["_host"])
    return often.where(F.col("_with") > F.lit(ratio) * F.col("_pages")).select("_host", "a", "b")


def line_dedup(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """doc_id, text, n_lines, n_dropped of every row: its text without the boilerplate lines of its host.

    Lines are split at newlines and compared without white space at their ends; a page counts once however often it
    repeats a line, and repeated rows count as pages of their own. Lines without a visible character are never
    boilerplate. Null texts count as empty, rows with a null host form one host. Lines that stay keep their order and
    their white space. Hosts with fewer than ``min_pages`` pages lose nothing.
    """
    bad = materialize(boilerplate(docs, host, ratio, min_pages), "boilerplate")
    base = docs.select("doc_id", F.col(host).alias("_host"), text_of().alias("_t"))
    few = bad.count() <= BROADCAST_ROWS
    marked = _marked_by_broadcast(base, bad) if few else _marked_by_join(base, bad)
    return marked.select(
        "doc_id",
        F.concat_ws("\n", "_left").alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_left")).cast("long").alias("n_dropped"),
    )


def _part(a: Column) -> Column:
    return F.pmod(a, F.lit(PARTS)).cast("int")


def _marked_by_broadcast(base: DataFrame, bad: DataFrame) -> DataFrame:
    """doc_id, _lines, _left, each page with its host's lines, which are dealt into PARTS."""
    listed = bad.groupBy("_host").agg(F.collect_set(F.struct("a", "b")).alias("_s"))
    dealt = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.filter("_s", lambda x: _part(x["a"]) == p))
    per_host = F.broadcast(listed.select(F.col("_host").alias("_h"), dealt.alias("_bad")))
    joined = base.withColumn("_lines", F.split("_t", "\n")).join(per_host, F.col("_host").eqNullSafe(F.col("_h")), "left")

    def stays(x: Column) -> Column:
        key = _key(x)
        return ~F.array_contains(F.get("_bad", _part(key["a"])), key) | (F.length(squeeze(x)) == 0)

    return joined.withColumn("_left", F.when(F.col("_bad").isNull(), F.col("_lines")).otherwise(F.filter("_lines", stays)))


def _marked_by_join(base: DataFrame, bad: DataFrame) -> DataFrame:
    """doc_id, _lines, _left by an equi-join of lines on (host, line); pages meet their places again by id, host and text's
    hash, which decide the outcome."""
    own = base.withColumns({"_x": F.xxhash64("_t"), "_lines": F.split("_t", "\n")})
    lines = own.select("doc_id", "_host", "_x", F.posexplode("_lines").alias("_k", "_line")).where(F.length(squeeze(F.col("_line"))) > 0)
    lines = lines.select("doc_id", "_host", "_x", "_k", _key(F.col("_line")).alias("_l"))
    met = lines.join(bad.withColumnRenamed("_host", "_h"), (F.col("_l.a") == F.col("a")) & (F.col("_l.b") == F.col("b")) & F.col("_host").eqNullSafe(F.col("_h")), "left_semi")
    places = met.groupBy("doc_id", "_host", "_x").agg(F.collect_set("_k").alias("_gone"))
    places = places.select(F.col("doc_id").alias("_i"), F.col("_host").alias("_h"), F.col("_x").alias("_y"), "_gone")
    joined = own.join(places, F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("_host").eqNullSafe(F.col("_h")) & (F.col("_x") == F.col("_y")), "left")
    return joined.withColumn("_left", F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(F.filter("_lines", lambda x, k: ~F.array_contains("_gone", k))))
