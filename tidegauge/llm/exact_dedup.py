"""Exact deduplication by composable polynomial fingerprints.

A text is cut into chunks. A chunk's fingerprint is the pair (hash, shift) under each of two moduli: hash is the
polynomial of its bytes without white space, shift the base to the power of their number. Fingerprints of neighbours
combine by ``hash = hash_a * shift_b + hash_b, shift = shift_a * shift_b``, so chunks of one huge text are hashed by
different tasks, in any order, and combined afterwards. Equal fingerprints are only candidates: the chunks of all texts
of a group are then compared, chunk position by chunk position, as a streaming minimum and maximum, which partial
aggregation reduces before the shuffle however large the group is. Groups that differ are split by their real text.

Only texts that may have a copy are moved: a Bloom filter of the fingerprints that came more than once, of bounded size,
is tested where the text is read. Where it fills up more texts are moved, none fewer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import Bloom, claim, join_groups, materialize, once, squeeze, text_of

#: Two primes below 2**31 and the bases of their polynomials.
MODULI = (2147483647, 2147483629)
BASES = (911382323, 972663749)
#: Bytes of a chunk, and of the longest text that one task hashes and compares alone.
CHUNK = 1 << 16
HUGE = 1 << 22
SPACES = b" \t\n\x0b\x0c\r"

PART = T.StructType([T.StructField(f"{k}{i}", T.LongType(), False) for i in (0, 1) for k in ("hash", "shift")])
UNIT = (0, 1, 0, 1)


def _powers(base: int, modulus: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) by doubling."""
    out, step = np.ones(n, np.uint64), 1
    while step < n:
        width = min(step, n - step)
        out[step : step + width] = out[:width] * np.uint64(pow(base, step, modulus)) % np.uint64(modulus)
        step *= 2
    return out


class Hasher:
    """Fingerprints under two moduli."""

    def __init__(self, moduli: tuple[int, int]):
        self.moduli = moduli
        # a chunk's bytes are multiplied by falling powers
        self.powers = [_powers(b, m, CHUNK)[::-1].copy() for b, m in zip(BASES, moduli, strict=True)]

    def chunk(self, data: bytes) -> tuple[int, ...]:
        """(hash, shift) of at most CHUNK bytes under each modulus."""
        values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        n, out = len(values), []
        for base, modulus, power in zip(BASES, self.moduli, self.powers, strict=True):
            # every product is below 2**40 and there are at most 2**16 of them
            out += [int(np.dot(values, power[CHUNK - n :])) % modulus, pow(base, n, modulus)]
        return tuple(out)

    def joined(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
        m, k = self.moduli
        return (a[0] * b[1] + b[0]) % m, a[1] * b[1] % m, (a[2] * b[3] + b[2]) % k, a[3] * b[3] % k

    def whole(self, data: bytes) -> tuple[int, ...]:
        out = UNIT
        for at in range(0, len(data), CHUNK):
            out = self.joined(out, self.chunk(data[at : at + CHUNK]))
        return out


def _raw() -> Column:
    return text_of().cast("binary")


def _chunks(raw: Column) -> Column:
    """The bytes' chunks in order; none has one empty chunk."""
    last = F.floor((F.greatest(F.octet_length(raw), F.lit(1)) - 1) / CHUNK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * CHUNK + 1, F.lit(CHUNK)))


def _small_prints(moduli: tuple[int, int]):
    @F.pandas_udf("fp0 long, fp1 long, gone long, text_sha256 string")
    def hashed(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        claim("chunks", lambda: None)
        own = Hasher(moduli)
        for batch in texts:
            rows = []
            for raw in batch:
                bare = raw.translate(None, SPACES)
                fp = own.whole(bare)
                rows.append((fp[0], fp[2], len(raw) - len(bare), hashlib.sha256(bare).hexdigest()))
            yield pd.DataFrame(rows, columns=["fp0", "fp1", "gone", "text_sha256"])

    return hashed


def _chunk_prints(moduli: tuple[int, int]):
    @F.pandas_udf(PART)
    def hashed(chunks: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        claim("chunks", lambda: None)
        own = Hasher(moduli)
        for batch in chunks:
            yield pd.DataFrame([own.chunk(raw.translate(None, SPACES)) for raw in batch], columns=PART.names, dtype="int64")

    return hashed


def _combined(parts: Column, moduli: tuple[int, int]) -> Column:
    """Combine an ordered array of chunk fingerprints, left to right."""

    def join(a: Column, b: Column) -> Column:
        return F.struct(
            *(
                c
                for i in (0, 1)
                for c in (
                    ((a[f"hash{i}"] * b[f"shift{i}"] + b[f"hash{i}"]) % F.lit(moduli[i])).alias(f"hash{i}"),
                    ((a[f"shift{i}"] * b[f"shift{i}"]) % F.lit(moduli[i])).alias(f"shift{i}"),
                )
            )
        )

    unit = F.struct(*(F.lit(v).cast("long").alias(k) for k, v in zip(PART.names, UNIT, strict=True)))
    return F.aggregate(parts, unit, join)


def fingerprints(docs: DataFrame, moduli: tuple[int, int] = MODULI, huge: int = HUGE) -> DataFrame:
    """doc_id, fp0, fp1, norm_chars, n_chars, text_sha256 of every row; a text of over ``huge`` bytes is spread over the
    tasks chunk by chunk."""
    base = docs.select("doc_id", _raw().alias("_b"), F.length(text_of()).cast("long").alias("n_chars"))
    out = ["doc_id", "fp0", "fp1", "norm_chars", "n_chars", "text_sha256"]
    small = base.where(F.octet_length("_b") <= huge).select("doc_id", "n_chars", _small_prints(moduli)("_b").alias("_f"))
    small = small.select("doc_id", "n_chars", "_f.*").withColumn("norm_chars", F.col("n_chars") - F.col("gone")).select(*out)
    bare = squeeze(F.col("_b").cast("string"))
    facts = [F.length(bare).cast("long").alias("norm_chars"), F.sha2(bare, 256).alias("text_sha256")]
    # the row's number is set before its chunks are listed, so that they share it
    numbered = base.where(F.octet_length("_b") > huge).withColumn("_row", F.monotonically_increasing_id())
    cut = numbered.select("doc_id", "n_chars", *facts, "_row", F.posexplode(_chunks(F.col("_b"))).alias("_k", "_c"))
    spread = cut.repartition("_row", "_k").withColumn("_f", _chunk_prints(moduli)("_c"))
    joined = (
        spread.groupBy("_row", "doc_id", "norm_chars", "n_chars", "text_sha256")
        .agg(F.array_sort(F.collect_list(F.struct("_k", "_f"))).alias("_p"))
        .withColumn("_f", _combined(F.transform("_p", lambda p: p["_f"]), moduli))
        .withColumns({"fp0": F.col("_f.hash0"), "fp1": F.col("_f.hash1")})
    )
    return small.unionByName(joined.select(*out))


KEY = ["fp0", "fp1", "norm_chars"]


def _suspects(docs: DataFrame, prints: DataFrame, moduli: tuple[int, int], huge: int) -> DataFrame:
    """fp0, fp1, norm_chars, _k, _c: the chunks of the texts that may have a copy."""
    copies = prints.groupBy(*KEY).agg(F.count("*").alias("_n")).where("_n > 1").select(*KEY)
    copies = materialize(copies, "exact-copies")
    held = docs.sparkSession.sparkContext.broadcast(Bloom.of(copies, *KEY))

    @F.pandas_udf("fp0 long, fp1 long, gone long, bare binary")
    def tested(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        claim("chunks", lambda: None)
        own, seen = Hasher(moduli), held.value
        for texts, chars in batches:
            bare = [raw.translate(None, SPACES) for raw in texts]
            fps = [own.whole(x) for x in bare]
            gone = [len(raw) - len(x) for raw, x in zip(texts, bare, strict=True)]
            keys = np.array([(fp[0], fp[2], n - g) for fp, n, g in zip(fps, chars, gone, strict=True)], np.int64).reshape(-1, 3)
            may = seen.has(*keys.T)
            yield pd.DataFrame({"fp0": keys[:, 0], "fp1": keys[:, 1], "gone": gone, "bare": [x if m else None for x, m in zip(bare, may, strict=True)]})

    base = docs.select("doc_id", _raw().alias("_b"), F.length(text_of()).cast("long").alias("n_chars"))
    small = base.where(F.octet_length("_b") <= huge).select("n_chars", once(tested)("_b", "n_chars").alias("_f")).where(F.octet_length("_f.bare") > 0)
    small = small.select("_f.fp0", "_f.fp1", (F.col("n_chars") - F.col("_f.gone")).alias("norm_chars"), F.posexplode(_chunks(F.col("_f.bare"))).alias("_k", "_c"))
    # rows of one id and size may meet each other's fingerprints here; their group is then told apart by digest, which is right too
    members = prints.join(copies, KEY, "left_semi").select(F.col("doc_id").alias("_id"), *KEY, F.col("n_chars").alias("_chars")).distinct()
    rest = base.where(F.octet_length("_b") > huge).withColumn("_bare", squeeze(F.col("_b").cast("string")))
    met = rest.join(members, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("n_chars") == F.col("_chars")) & (F.length("_bare") == F.col("norm_chars")))
    return small.unionByName(met.select(*KEY, F.posexplode(_chunks(F.col("_bare").cast("binary"))).alias("_k", "_c")))


def judged(docs: DataFrame, moduli: tuple[int, int] = MODULI, huge: int = HUGE) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_chars of every row; of each group exactly one row is kept."""
    prints = fingerprints(docs, moduli, huge).withColumn("_row", F.monotonically_increasing_id())
    prints = materialize(prints, "exact-prints")
    chunks = _suspects(docs, prints, moduli, huge)
    differing = materialize(
        chunks.groupBy(*KEY, "_k").agg(F.min("_c").alias("_a"), F.max("_c").alias("_b")).where("_a <> _b").select(*KEY).distinct(),
        "exact-differing",
    )
    if differing.isEmpty():
        keyed = prints.withColumn("_part", F.lit(""))
    else:  # different texts share a fingerprint: their groups are told apart by the digest of the text itself
        keyed = prints.join(differing.withColumn("_d", F.lit(True)), KEY, "left").withColumn(
            "_part", F.when(F.col("_d"), F.col("text_sha256")).otherwise("")
        )
    first = F.struct("n_chars", F.col("doc_id").isNotNull(), -F.col("doc_id"), -F.col("_row"))
    best = F.max_by(F.struct("doc_id", "_row"), first).alias("_best")
    groups = keyed.groupBy(*KEY, "_part").agg(best, F.count("*").alias("group_size")).where("group_size > 1")
    found = join_groups(keyed, groups, [*KEY, "_part"], "group_size", prints.count())
    alone = F.col("_best").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("_best._row") == F.col("_row"))).alias("kept"),
        "text_sha256",
        "n_chars",
    )


def exact_dedup(docs: DataFrame, moduli: tuple[int, int] = MODULI, huge: int = HUGE) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when equal without their white space. Null counts as empty, and all empty texts are equal. The row
    with the most characters in its original text stays, then the smallest doc_id; a null doc_id comes last, and of rows
    that are equal in all this any one, so exactly one row of a group is kept. doc_ids are numbers. Other columns are ignored. An empty table
    gives no rows.
    """
    return judged(docs, moduli, huge).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns.

    A row is judged by its own text's digest together with its doc_id and length, so rows without an id, and different
    texts that share one, don't stand for each other. Of rows that agree in all three and of which one stays, the one
    with the greatest hash of its columns does. Only rows that may be copies are moved: a Bloom filter of the copies'
    digests is tested where the text is read.
    """
    verdicts = judged(docs).groupBy("text_sha256", "doc_id", "n_chars").agg(F.max("kept").alias("_kept"), F.count("*").alias("_n")).where("not _kept or _n > 1")
    verdicts = materialize(verdicts.select(F.unhex("text_sha256").alias("_digest"), F.col("doc_id").alias("_id"), F.col("n_chars").alias("_chars"), "_kept"), "exact-verdicts")
    # sixty bits of the digest are its place in the filter
    short = F.conv(F.substring(F.hex("_digest"), 1, 15), 16, 10).cast("long")
    held = docs.sparkSession.sparkContext.broadcast(Bloom.of(verdicts.select(short.alias("_h")), "_h"))

    @F.pandas_udf("digest binary, may boolean")
    def judged_by(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [hashlib.sha256(raw.translate(None, SPACES)).digest() for raw in texts]
            keys = np.array([int.from_bytes(x[:8], "big") >> 4 for x in found], np.int64)
            yield pd.DataFrame({"digest": found, "may": held.value.has(keys)})

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("doc_id").alias("_id"), F.length(text_of()).cast("long").alias("_chars"), once(judged_by)(_raw()).alias("_f"))
    rows = rows.select("_row", "_id", "_chars", F.col("_f.digest").alias("_digest"), F.col("_f.may").alias("_may"))
    found = rows.where("_may").alias("r").join(
        verdicts.alias("v"), (F.col("r._digest") == F.col("v._digest")) & F.col("r._id").eqNullSafe(F.col("v._id")) & (F.col("r._chars") == F.col("v._chars")), "left"
    ).select("r._row", "r._digest", "_kept")
    out = rows.where("not _may").select("_row").unionByName(found.where("_kept is null").select("_row"))
    if not verdicts.where("_kept").isEmpty():
        picked = found.where("_kept").groupBy("_digest").agg(F.max_by("_row", F.xxhash64("_row")).alias("_row"))
        out = out.unionByName(picked.select("_row"))
    return out.select("_row.*")
