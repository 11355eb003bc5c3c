"""Near-duplicate groups by fingerprints: bit majorities of shingle hashes, linked at a small Hamming distance.

The distinct fingerprints are sorted by Gray rank, so that neighbours in the order share most of their bits, and cut into
leaves of at most LEAF. A node stands for a run of leaves and is known by its masked pattern: the bits in which all of
its fingerprints agree. FANOUT nodes make one node of the next level, up to a single root. The tree is joined with
itself from the root down: a pair of nodes adds the differences in the bits that both have newly fixed to those that
its parents had, and goes with all that is below it once the sum exceeds the distance. So a fingerprint meets only the
leaves that may hold a neighbour, and no list of all nodes is held anywhere.

Inside a pair of leaves runs of GROUP fingerprints are pruned in the same way before single ones are compared, and only
links that join components of the two leaves leave the task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import join_groups, materialize
from tidegauge.llm.components import components

#: Fixed value: the seed of the shingles' hashes.
SEED = 42
#: Fingerprints of a leaf, nodes of a node (as a power of two), fingerprints of a run within a leaf, hashes counted at once.
LEAF, FANOUT_BITS, GROUP, STRIP = 256, 4, 16, 1 << 16


def fingerprint(text: str, k: int) -> int:
    """Majority of the bits of the hashes of all runs of k words, repeats included; zero without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(k, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STRIP):
        upto = min(n, at + STRIP)
        runs = map(joined.__getitem__, map(slice, starts[at:upto].tolist(), ends[at + k - 1 : upto + k - 1].tolist()))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), "<u8", upto - at)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(k: int):
    @F.pandas_udf("long")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(text or "", k) for text in texts], np.uint64).view(np.int64))

    return made


def gray_rank(code: Column) -> Column:
    """The place of a 64-bit code in the Gray order, as a long whose signed order is that order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def patterns(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each run of ``width`` codes the mask of the bits in which all agree, and their values."""
    starts = np.arange(0, len(codes), width)
    low, high = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    return ~(low ^ high), low


def _leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, number, held = TaskContext.get().partitionId(), 0, np.zeros(0, np.uint64)

    def rows(codes: np.ndarray) -> pd.DataFrame:
        mask, value = patterns(codes, LEAF)
        out = pd.DataFrame({"part": part, "k": np.arange(number, number + len(mask)), "mask": mask.view(np.int64), "value": value.view(np.int64)})
        return out.assign(codes=[codes[i : i + LEAF].tobytes() for i in range(0, len(codes), LEAF)])

    for batch in batches:
        held = np.concatenate([held, batch["code"].to_numpy(np.int64).view(np.uint64)])
        whole = len(held) // LEAF * LEAF
        if whole:
            yield rows(held[:whole])
            number, held = number + whole // LEAF, held[whole:]
    if len(held):
        yield rows(held)


def leaves(codes: DataFrame) -> DataFrame:
    """node (numbered in Gray order), mask, value, codes of the leaves over the distinct ``code`` rows."""
    parts = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = codes.withColumn("_r", gray_rank(F.col("code"))).repartitionByRange(parts, "_r").sortWithinPartitions("_r")
    made = materialize(dealt.select("code").mapInPandas(_leaves, "part int, k long, mask long, value long, codes binary"), "leaves")
    # one row a partition
    sizes = made.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_b"))
    return made.join(F.broadcast(before), "part").select((F.col("k") + F.col("_b")).alias("node"), "mask", "value", "codes")


def leaf_pairs(nodes: DataFrame, total: int, distance: int) -> DataFrame:
    """The pairs (u, v) of leaves, u <= v, whose patterns differ in at most ``distance`` of the bits that both fix."""
    levels = [nodes.select("node", "mask", "value")]
    while total > 1:
        below, total = levels[-1], -(-total >> FANOUT_BITS)
        low, high = F.bit_and("value"), F.expr("bit_or(value | ~mask)")
        levels.append(below.groupBy(F.shiftright("node", FANOUT_BITS).alias("node")).agg(F.bitwise_not(low.bitwiseXOR(high)).alias("mask"), low.alias("value")))
    pairs = levels[-1].select(F.col("node").alias("u"), F.col("node").alias("v"), F.lit(0).alias("d"), F.col("mask").alias("seen"))
    for level in levels[-2::-1]:
        side = lambda x, y: level.select(F.shiftright("node", FANOUT_BITS).alias(x), F.col("node").alias(f"_{x}"), F.col("mask").alias(f"m{y}"), F.col("value").alias(f"v{y}"))  # noqa: B023, E731
        met = pairs.join(side("u", 1), "u").join(side("v", 2), "v").where("_u <= _v")
        fixed = met.withColumn("both", F.expr("m1 & m2"))
        summed = fixed.withColumn("d", F.expr("d + bit_count((v1 ^ v2) & both & ~seen)"))
        pairs = summed.where(F.col("d") <= distance).select(F.col("_u").alias("u"), F.col("_v").alias("v"), "d", F.col("both").alias("seen"))
    return pairs.select("u", "v")


def near(x: np.ndarray, y: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the codes x[i] and y[j] within the distance, by runs whose patterns are."""
    (m1, v1), (m2, v2) = patterns(x, GROUP), patterns(y, GROUP)
    far = np.bitwise_count((v1[:, None] ^ v2[None, :]) & m1[:, None] & m2[None, :])
    a, b = np.nonzero(far <= distance)
    lanes = np.arange(GROUP)
    found = []
    for at in range(0, len(a), 2048):
        # the last run is filled up with its last code
        i, j = (np.minimum(s[at : at + 2048, None] * GROUP + lanes, len(z) - 1) for s, z in ((a, x), (b, y)))
        p, q, r = np.nonzero(np.bitwise_count(x[i][:, :, None] ^ y[j][:, None, :]) <= distance)
        found.append((i[p, q], j[p, r]))
    return tuple(np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def stars(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    """Links (a row each) that join the same codes as all links within the distance do, fewer than there are codes."""
    i, j = near(x, y, distance)
    codes, at = np.unique(np.concatenate([x[i], y[j]]), return_inverse=True)
    u, v = at[: len(i)], at[len(i) :]
    root = np.arange(len(codes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    own = np.nonzero(root != np.arange(len(codes)))[0]
    return np.stack([codes[root[own]], codes[own]], axis=1)


def _links(distance: int):
    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [stars(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), distance) for x, y in zip(batch["x"], batch["y"], strict=True)]
            links = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.uint64)
            yield pd.DataFrame(links.view(np.int64), columns=["a", "b"])

    return linked


def links(codes: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) between the distinct ``code`` rows that join all that lie within the distance of each other."""
    nodes = materialize(leaves(codes), "leaf-nodes")
    pairs = materialize(leaf_pairs(nodes, nodes.count(), distance), "leaf-pairs")
    x, y = nodes.select(F.col("node").alias("u"), F.col("codes").alias("x")), nodes.select(F.col("node").alias("v"), F.col("codes").alias("y"))
    return pairs.join(x, "u").join(y, "v").select("x", "y").mapInPandas(_links(distance), "a long, b long")


def simhash_groups(docs: DataFrame, k: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id (the smallest doc_id that links reach) of every row.

    A bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of the text's runs of k words, repeats included;
    A-Z are lower-cased, words are separated by white space and joined by one space; fewer words are one run. Rows
    whose fingerprints differ in at most ``distance`` bits are linked. Null texts and texts without words have the
    fingerprint zero and are linked like any other. Rows that share a doc_id are one document with the links of all
    their texts. Rows with a null doc_id are not linked and have no component. Other columns are ignored; an empty
    table gives no rows.
    """
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = materialize(base.select("doc_id", _fingerprints(k)("text").alias("code")), "fingerprints")
    solid = rows.where("doc_id is not null")
    classes = materialize(solid.groupBy("code").agg(F.min("doc_id").alias("_id"), F.count("*").alias("_size")), "codes")
    several = solid.groupBy("doc_id").agg(F.min("code").alias("a"), F.max("code").alias("_top")).where("a < _top")
    same = solid.join(several.select("doc_id", "a"), "doc_id").where("code <> a").select("a", F.col("code").alias("b"))
    found = materialize(links(classes.select("code"), distance).unionByName(same).distinct(), "links")
    named = classes.join(components(found, "a", "b"), classes["code"] == F.col("node"), "left").select("code", "_id", "_size", F.coalesce("component", "code").alias("_c"))
    named = materialize(named, "named")
    least = named.groupBy("_c").agg(F.min("_id").alias("component_id"))
    out = join_groups(solid, named.join(least, "_c").select("code", "_size", "component_id"), ["code"], "_size", solid.count())
    rest = rows.where("doc_id is null").withColumn("component_id", F.col("doc_id"))
    return out.select("doc_id", "code", "component_id").unionByName(rest).select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
