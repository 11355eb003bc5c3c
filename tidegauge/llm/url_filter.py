"""URL filter over a sorted digest array.

Rules are kept in one flat file: the sorted 64-bit xxhash digests of the rules' strings, the strings themselves and
their verdicts. Executors get the file once, map it into memory and probe it by vectorised binary search; a hit counts
only if the stored string equals the probe, so colliding digests do no harm.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import scratch_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A rule list of more bytes is refused: every executor maps the whole file.
MAX_BYTES = 4 << 30


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: from there up to ?, # or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode())


class DigestArray:
    """Sorted digests with their strings. Entry strings may share a digest; all of them are compared."""

    def __init__(self, keys: np.ndarray, offsets: np.ndarray, blob: np.ndarray, values: np.ndarray):
        self.keys, self.offsets, self.blob, self.values = keys, offsets, blob, values

    @staticmethod
    def pack(entries: Iterable[tuple[str, int]], hashed=digest) -> bytes:
        rows = sorted((hashed(s), s.encode(), v) for s, v in dict(entries).items())
        offsets = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(r[1]) for r in rows], out=offsets[1:])
        keys, values = np.array([r[0] for r in rows], np.uint64), np.array([r[2] for r in rows], np.int64)
        return b"".join([np.int64(len(rows)).tobytes(), keys.tobytes(), offsets.tobytes(), values.tobytes(), *(r[1] for r in rows)])

    @classmethod
    def open(cls, path: str) -> DigestArray:
        data = np.memmap(path, np.uint8, "r")
        n = int(data[:8].view(np.int64)[0])
        cut = [8, 8 + 8 * n, 16 + 16 * n, 16 + 24 * n]
        return cls(data[cut[0] : cut[1]].view(np.uint64), data[cut[1] : cut[2]].view(np.int64), data[cut[3] :], data[cut[2] : cut[3]].view(np.int64))

    def find(self, probes: list[str], hashed=digest) -> np.ndarray:
        """The value of each probe, -1 where it isn't an entry."""
        out = np.full(len(probes), -1, np.int64)
        if not len(self.keys) or not probes:
            return out
        wanted = np.fromiter(map(hashed, probes), np.uint64, len(probes))
        left, right = np.searchsorted(self.keys, wanted, "left"), np.searchsorted(self.keys, wanted, "right")
        for i in np.nonzero(left < right)[0]:
            text = probes[i].encode()
            for k in range(left[i], right[i]):
                if self.blob[self.offsets[k] : self.offsets[k + 1]].tobytes() == text:
                    out[i] = self.values[k]
                    break
        return out


def publish(spark: SparkSession, rules: Iterable[tuple[str, str]], hashed=digest) -> str:
    """Write the rules ("block" or "allow", "host/path") as a digest array and hand it to all executors.

    Entries are of two kinds: "host" maps to a bit set of the path lengths its rules have, in entries "host#k" of 60
    lengths each, and "host/path" to 1 (block) or 0 (allow). So a url is probed only at lengths that exist.
    """
    entries: dict[str, int] = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        if not slash or verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {verdict} {rule}")
        entries[rule] = int(verdict == "block")
        n = len(slash + path)
        block = f"{host}#{n // 60}"
        entries[block] = entries.get(block, 0) | 1 << (n % 60)
        entries[host] = max(entries.get(host, 0), n)
    packed = DigestArray.pack(entries.items(), hashed)
    if len(packed) > MAX_BYTES:
        raise ValueError(f"the rules take {len(packed)} bytes; the bound is {MAX_BYTES}")
    # the same rules have the same name, so a session has one file of them however often they are used
    name = f"rules-{hashlib.sha256(packed).hexdigest()}.bin"
    if not any(x.endswith(name) for x in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(_stored(spark, name, packed))
    return name


def _stored(spark: SparkSession, name: str, data: bytes) -> str:
    """A file below the shared scratch folder, which goes when the driver's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/rules-{uuid.uuid4().hex}/{name}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(path)
    for at in range(0, len(data), 1 << 20):
        out.write(bytearray(data[at : at + (1 << 20)]))
    out.close()
    fs.deleteOnExit(path.getParent())
    return path.toString()


def _suffixes(host: str) -> list[str]:
    """The host and its parent domains, longest first."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))]


def match(hosts: pd.Series, paths: pd.Series, index: DigestArray, hashed=digest) -> pd.DataFrame:
    """The longest fitting rule of each row and whether it blocks (-1: no rule)."""
    codes, distinct = pd.factorize(hosts)
    suffixes = [_suffixes(h) for h in distinct]
    flat = [s for x in suffixes for s in x]
    longest = index.find(flat, hashed)
    lengths: list[list[tuple[int, str]]] = []
    k = 0
    for group in suffixes:
        found = []
        for s in group:
            if longest[k] > 0:
                blocks = index.find([f"{s}#{b}" for b in range(int(longest[k]) // 60 + 1)], hashed)
                found += [(60 * b + i, s) for b, bits in enumerate(blocks) if bits > 0 for i in range(60) if bits >> i & 1]
            k += 1
        lengths.append(sorted(found, key=lambda x: (-x[0] - len(x[1]), -len(x[1]))))
    rows, probes = [], []
    for row, (code, path) in enumerate(zip(codes, paths, strict=True)):
        for n, host in lengths[code]:
            if n <= len(path):
                rows.append(row)
                probes.append(host + path[:n])
    verdicts = index.find(probes, hashed)
    rule: list[str | None] = [None] * len(codes)
    blocked = np.full(len(codes), -1, np.int64)
    for row, probe, verdict in zip(rows, probes, verdicts, strict=True):
        if verdict >= 0 and rule[row] is None:  # probes come longest first
            rule[row], blocked[row] = probe, verdict
    return pd.DataFrame({"rule": pd.Series(rule, dtype=object), "blocked": blocked})


def url_filter(pages: DataFrame, rules: Iterable[tuple[str, str]], hashed=digest) -> DataFrame:
    """page_id, host, path, rule, verdict of every row.

    A rule fits its host and all subdomains where the url's path starts with the rule's path; the longest rule wins, of
    equally long ones that with the longer host. A url that no rule fits is in no list and allowed. A null url and one
    without :// have an empty host and path and no rule. Repeated rows and ids are judged one by one.
    """
    name = publish(pages.sparkSession, rules, hashed)

    @F.pandas_udf("rule string, blocked long")
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = DigestArray.open(SparkFiles.get(name))
        for hosts, paths in batches:
            yield match(hosts, paths, index, hashed)

    host, path = host_and_path(F.col("url").cast("string"))
    found = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("_v", judged("host", "path"))
    verdict = F.when(F.col("_v.blocked") == 1, "block").otherwise("allow")
    return found.select("page_id", "host", "path", F.col("_v.rule").alias("rule"), verdict.alias("verdict"))
