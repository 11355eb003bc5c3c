"""Near-duplicate groups by min-max hashing.

Every permutation of the shingles gives two signature values, the minimum and the maximum of the hashes, so half the
permutations suffice, and as the two depend on each other negatively the estimate varies less. Values are dealt into
bands; texts that agree in a band share a bucket. Links are confirmed on the full shingle sets, in three steps that
never list all pairs of a bucket:

1. Texts with equal sets are one class with one signature.
2. In each bucket every class is compared with the bucket's smallest class, and components are formed.
3. Only buckets that still hold several components are looked at again: their classes are dealt into blocks of bounded
   total size and number, by set size so that blocks too different in size never meet, and every pair of blocks is
   compared by itself as a product of incidence matrices. Only links that join components leave the task, so a pair of
   blocks gives fewer links than it has sets.

With 32 bands of 5 values a pair of similarity 0.85 shares no bucket in some 7 of 10**9 cases (0.8: 4 of 10**6); a
pair that shares one is always compared or already in one component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import Bloom, Remembered, claim, join_groups, materialize, once, settle
from tidegauge.llm.components import components

PERMUTATIONS, BANDS, ROWS = 80, 32, 5
#: Shingles and sets in a block of step 3 at most (but for a single larger set), and shingles hashed at once.
BLOCK, SETS, STRIP = 250_000, 1_024, 8_192
REMEMBERED = 150_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_MULTIPLIERS = np.random.default_rng(20).integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_HASHES = Remembered(xxhash.xxh64_intdigest, REMEMBERED)


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(33)
    x *= _ODD[5]
    x ^= x >> np.uint64(33)
    x *= _ODD[6]
    x ^= x >> np.uint64(33)
    return x


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of k words; with fewer words, of the whole sequence; empty without words.

    Words are separated by white space and A-Z lower-cased.
    """
    words = text.encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    if n < k:
        out = np.full(1, n, np.uint64)
        for x in hashes:
            out = _mixed(out * _ODD[0] + x)
        return out
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out = _mixed(out * _ODD[0] + hashes[i : n - k + 1 + i])
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the shingles' hashes under each permutation."""
    low, high = np.full(PERMUTATIONS, 2**32 - 1, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(found), STRIP):
        hashed = ((found[at : at + STRIP, None] * _MULTIPLIERS) >> np.uint64(32)).astype(np.uint32)
        np.minimum(low, hashed.min(0), out=low)
        np.maximum(high, hashed.max(0), out=high)
    # a band's values come from different permutations
    return np.concatenate([low, high]).reshape(ROWS, BANDS).T


def bands(found: np.ndarray) -> list[int]:
    return [xxhash.xxh64_intdigest(row.tobytes(), seed=k) - (1 << 63) for k, row in enumerate(signature(found))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _features(k: int):
    @F.pandas_udf("n long, a long, b long, bands array<long>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        claim("shingles", _HASHES.clear)
        for texts in batches:
            rows = []
            for text in texts:
                found = shingles(text or "", k)
                digest = xxhash.xxh3_128_intdigest(found.tobytes())
                rows.append((len(found), _signed(digest >> 64), _signed(digest & (1 << 64) - 1), bands(found) if len(found) else []))
            yield pd.DataFrame(rows, columns=["n", "a", "b", "bands"])
        _HASHES.clear()
        settle()

    return measured


def _sets(k: int, held):
    """The set of a text whose id may be among the broadcast ones, else null."""

    @F.pandas_udf("binary")
    def made(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        claim("shingles", _HASHES.clear)
        for ids, texts in batches:
            may = held.value.has(ids.to_numpy(np.int64))
            yield pd.Series([shingles(text or "", k).tobytes() if m else None for m, text in zip(may, texts, strict=True)], dtype=object)
        _HASHES.clear()
        settle()

    return made


def linked(x: bytes, y: bytes, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sets of sorted hashes."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (small + large - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""

    @F.pandas_udf("boolean")
    def alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xs, ys in batches:
            yield pd.Series([linked(x, y, percent) for x, y in zip(xs, ys, strict=True)], dtype=bool)

    left, right = sets.select(F.col("cls").alias("u"), F.col("n").alias("_m"), F.col("set").alias("_x")), sets.select(F.col("cls").alias("v"), F.col("n").alias("_n"), F.col("set").alias("_y"))
    sized = pairs.join(left.select("u", "_m"), "u").join(right.select("v", "_n"), "v")
    sized = sized.where(100 * F.least("_m", "_n") >= percent * F.greatest("_m", "_n")).select("u", "v").distinct()
    return sized.join(right.select("v", "_y"), "v").join(left.select("u", "_x"), "u").where(alike("_x", "_y")).select("u", "v").distinct()


def cross_links(cell: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links between rows of one bucket that join different components, fewer than there are components; rows have cls,
    comp, side and set (sorted 64-bit hashes).

    Side 0 meets side 1, and side 2 meets itself. Intersections are counted as products of incidence matrices, a strip
    of shared shingles at a time.
    """
    sets = [np.frombuffer(x, np.uint64) for x in cell["set"]]
    ids, comp, side = cell["cls"].to_numpy(), pd.factorize(cell["comp"])[0], cell["side"].to_numpy()
    rows, cols = (np.arange(len(sets)),) * 2 if side[0] == 2 else (np.nonzero(side == 0)[0], np.nonzero(side == 1)[0])
    if not len(rows) or not len(cols):
        return []
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[code] > 1
    number = np.cumsum(times > 1) - 1
    owner, code = owner[shared], number[code[shared]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common, width = np.zeros((len(rows), len(cols)), np.float32), 2048
    total = int(code[-1]) + 1 if len(code) else 0
    for at in range(0, total, width):
        lo, hi = np.searchsorted(code, [at, at + width])
        strip = np.zeros((len(sets), min(width, total - at)), np.float32)
        strip[owner[lo:hi], code[lo:hi] - at] = 1
        common += strip[rows] @ strip[cols].T
    union = sizes[rows][:, None] + sizes[cols][None, :] - common
    near = (comp[rows][:, None] != comp[cols][None, :]) & (100 * common >= percent * union)
    root = list(range(comp.max() + 1))

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i in np.nonzero(near.any(axis=1))[0]:
        u, hit = rows[i], cols[near[i]]
        _, first = np.unique(comp[hit], return_index=True)  # one of each component
        for v in hit[first]:
            x, y = find(comp[u]), find(comp[v])
            if x != y:
                root[x] = y
                out.append((int(ids[u]), int(ids[v])))
    return out


def _unresolved(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that join components, in the buckets that hold several."""
    size_class = F.floor(F.log("n") / F.lit(math.log(100 / percent))).cast("int")
    named = members.join(labels.select(F.col("node").alias("cls"), "component"), "cls", "left")
    named = named.select("band", "h", "cls", "n", F.coalesce("component", "cls").alias("comp"), size_class.alias("_c"))
    facts = named.groupBy("band", "h").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.sum("n").alias("_total"), F.count("*").alias("_m"), F.collect_set("_c").alias("_sizes"))
    # of two classes that differ the pair has been compared in step 2; a bucket has some 100 size classes at most
    blocks = F.greatest(F.ceil(F.col("_total") / BLOCK), F.ceil(F.col("_m") / SETS))
    open_buckets = materialize(facts.where("_lo <> _hi and _m > 2").select("band", "h", "_total", "_m", "_sizes", blocks.alias("_nb")), "open-buckets")
    sums = open_buckets.where("_nb = 1").agg(F.sum("_total").alias("t"), F.sum("_m").alias("m")).first()
    groups = max(1, -(-(sums["t"] or 0) // BLOCK), -(-(sums["m"] or 0) // SETS))
    rows = named.join(open_buckets.select("band", "h", "_nb", "_sizes"), ["band", "h"]).withColumn("_k", F.pmod(F.xxhash64("cls"), "_nb"))
    others = F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1)
    cell = lambda c, kind, i, j, side: F.struct(c.alias("c"), F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    k, c, zero = F.col("_k"), F.col("_c"), F.lit(0).cast("long")
    small = F.array(cell(F.lit(0), 0, zero, zero, 2))
    same = F.transform(others, lambda j: F.struct(c.alias("c"), F.lit(1).alias("kind"), F.least(k, j).alias("i"), F.greatest(k, j).alias("j"), F.when(j == k, 2).when(k < j, 0).otherwise(1).alias("side")))
    none = F.filter(same, lambda x: F.lit(False))
    above = F.when(F.array_contains("_sizes", c + 1), F.transform(others, lambda j: cell(c, 2, k, j, 0))).otherwise(none)
    below = F.when(F.array_contains("_sizes", c - 1), F.transform(others, lambda j: cell(c - 1, 2, j, k, 1))).otherwise(none)
    placed = rows.withColumn("_p", F.explode(F.when(F.col("_nb") == 1, small).otherwise(F.concat(same, above, below))))
    # small buckets share a group of some BLOCK shingles; a block pair of a large one has its own
    group = F.when(F.col("_nb") == 1, F.struct(F.pmod(F.xxhash64("band", "h"), F.lit(groups)).alias("x"), F.lit(0).alias("c"), F.lit(0).alias("kind"), zero.alias("i"), zero.alias("j"))).otherwise(
        F.struct(F.xxhash64("band", "h").alias("x"), F.col("_p.c"), F.col("_p.kind"), F.col("_p.i"), F.col("_p.j"))
    )
    placed = placed.select(group.alias("_g"), "band", "h", "cls", "n", "comp", F.col("_p.side").alias("side"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        links = [x for _, cell in frame.groupby(["band", "h"], sort=False) if cell["comp"].nunique() > 1 for x in cross_links(cell, percent)]
        return pd.DataFrame(sorted(set(links)), columns=["u", "v"], dtype="int64")

    return placed.join(sets, ["cls", "n"]).groupBy("_g").applyInPandas(compare, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    A text's set are its distinct runs of k words (A-Z lower-cased; with fewer words the whole sequence). Texts are
    linked when 100 * intersection >= percent * union; component_id is the smallest doc_id that links reach, kept says
    whether it is the row's own. Null texts and texts without words have an empty set and are linked with nothing. Rows
    that share a doc_id count as one document with the links of all their texts. Rows with a null doc_id are not linked
    and have no component. doc_ids are 64-bit integers. Other columns are ignored; an empty table gives no rows.
    """
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    measured = materialize(base.select("doc_id", _features(k)("text").alias("_f")).select("doc_id", "_f.*"), "signatures")
    solid = measured.where("n > 0 and doc_id is not null").select("doc_id", "a", "b", "n", "bands")
    classes = solid.groupBy("a", "b", "n").agg(F.min("doc_id").alias("cls"), F.first("bands").alias("bands"), F.count("*").alias("_size"))
    classes = materialize(classes, "classes")
    entries = classes.select("cls", "n", F.posexplode("bands").alias("band", "h"))
    buckets = entries.groupBy("band", "h").agg(F.min("cls").alias("pivot"), F.max("cls").alias("_top")).where("pivot < _top").drop("_top")
    members = materialize(entries.join(buckets, ["band", "h"]), "buckets")
    wanted = materialize(members.select("cls").distinct(), "wanted")
    # only the texts of classes that share a bucket are read into sets; the filter is tested where the text is
    held = docs.sparkSession.sparkContext.broadcast(Bloom.of(wanted, "cls"))
    made = base.where("doc_id is not null").select("doc_id", once(_sets(k, held))("doc_id", "text").alias("set")).where(F.octet_length("set") > 0)
    made = made.join(wanted, F.col("doc_id") == F.col("cls"), "left_semi").select(F.col("doc_id").alias("cls"), (F.octet_length("set") / 8).cast("long").alias("n"), "set")
    sets = materialize(made, "sets")
    stars = _confirmed(members.where("cls <> pivot").select(F.col("pivot").alias("u"), F.col("cls").alias("v")).distinct(), sets, percent)
    rows = solid.drop("bands")
    keyed = materialize(join_groups(rows, classes.drop("bands"), ["a", "b", "n"], "_size", rows.count()).select("doc_id", "a", "b", "n", "cls"), "rows")
    # all classes of a doc_id are one document
    several = keyed.groupBy("doc_id").agg(F.min("cls").alias("u"), F.max("cls").alias("_top")).where("u < _top")
    same = keyed.join(several.select("doc_id", "u"), "doc_id").where("cls <> u").select("u", F.col("cls").alias("v"))
    links = materialize(stars.unionByName(same).distinct(), "links")
    labels = components(links, "u", "v")
    more = materialize(_unresolved(members, labels, sets, percent), "more-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more), "u", "v")
    # labels go to the classes first, so that no copy of a text is joined by its class's id
    named = classes.join(labels, classes["cls"] == labels["node"], "left").select("a", "b", "n", "_size", F.coalesce("component", "cls").alias("component_id"))
    joined = join_groups(rows, named, ["a", "b", "n"], "_size", rows.count())
    out = joined.select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("component_id") == F.col("doc_id")).alias("kept"))
    rest = measured.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(rest)


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    gone = near_duplicates(docs, k, percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
