"""Zip archives of text lines as a data source: a task for each member, lines streamed out, checksums verified.

Members are read through Arrow's file systems, so a path is a local one or a URI of a store that Arrow knows. A member is
decompressed as it is read, whatever its size; at its end its CRC is compared, and a member that doesn't agree fails the
job instead of giving half of its lines. A deflated member can't be entered in its middle, so it is one task's.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Lines of a batch that a reader hands to Spark.
LINES = 20_000


def _store(path: str) -> tuple[afs.FileSystem, str]:
    return afs.FileSystem.from_uri(path) if ":/" in path else (afs.LocalFileSystem(), path)


@dataclass
class Member(InputPartition):
    path: str
    name: str


class ZipLinesReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Member]:
        """Every member of every zip file at or below the path, largest first; only the directories of the files are read."""
        store, root = _store(self.path)
        info = store.get_file_info(root)
        found = [info] if info.type == afs.FileType.File else store.get_file_info(afs.FileSelector(root, recursive=True, allow_not_found=True))
        out = []
        for f in found:
            if f.type == afs.FileType.File and f.path.endswith(".zip"):
                with store.open_input_file(f.path) as raw, zipfile.ZipFile(raw) as archive:
                    out += [(m.file_size, f.path, m.filename) for m in archive.infolist() if not m.is_dir()]
        return [Member(p, n) for _, p, n in sorted(out, key=lambda x: (-x[0], x[1], x[2]))] or [Member("", "")]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, _ = _store(self.path)

        def batch(first: int, lines: list[str]) -> pa.RecordBatch:
            n = len(lines)
            return pa.RecordBatch.from_arrays([pa.array([partition.path] * n), pa.array([partition.name] * n), pa.array(range(first, first + n), pa.int64()), pa.array(lines)], names=["path", "member", "line_no", "line"])

        with store.open_input_file(partition.path) as raw, zipfile.ZipFile(raw) as archive, archive.open(partition.name) as member:
            held, at = [], 0
            # the end of the member is where its CRC is compared
            for line in io.TextIOWrapper(member, "utf-8", errors="replace", newline=None):
                held.append(line.rstrip("\n"))
                if len(held) == LINES:
                    yield batch(at, held)
                    held, at = [], at + len(held)
            if held:
                yield batch(at, held)


class ZipLines(DataSource):
    """path, member, line_no (from 0) and line of text members of zip files."""

    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return "path string, member string, line_no long, line string"

    def reader(self, schema) -> ZipLinesReader:
        return ZipLinesReader(self.options["path"])


def zip_lines(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(ZipLines)
    return spark.read.format("zip_lines").load(path)


def write_zips(lines: DataFrame, path: str, archive: str, member: str, order: list[str]) -> None:
    """A zip file for each value of ``archive`` below the path, with a member for each value of ``member``; the column ``line``
    in the given order. A file is one task's and is written as its lines come."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(path)
        store.create_dir(root, recursive=True)
        current, out, raw, part, done = (None, None), None, None, None, 0
        for batch in batches:
            for a, m, line in zip(batch["_a"], batch["_m"], batch["line"], strict=True):
                if (a, m) != current:
                    if part is not None:
                        part.close()
                    if a != current[0]:
                        if out is not None:
                            out.close()
                            raw.close()
                        raw = store.open_output_stream(f"{root}/{a}.zip")
                        out, done = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED), done + 1
                    part, current = out.open(m, "w", force_zip64=True), (a, m)
                part.write(f"{line}\n".encode())
        if out is not None:
            part.close()
            out.close()
            raw.close()
        yield pd.DataFrame({"files": [done]})

    named = lines.select(F.col(archive).cast("string").alias("_a"), F.col(member).cast("string").alias("_m"), *order, "line")
    dealt = named.repartition("_a").sortWithinPartitions("_a", "_m", *order).select("_a", "_m", "line")
    dealt.mapInPandas(write, "files long").agg(F.sum("files")).collect()


def fields(lines: DataFrame, names: list[str], aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """lines (path, member, line_no, line) with the named fields as text, whether or not a member begins with a header.

    A first line whose first field is no number is the member's header: its names (in any case, or one of the aliases of a
    wanted name) tell where the fields are. Members without one have the fields in the order of ``names``. A wanted name
    that a header doesn't have, and a field that a line doesn't have, are null; headers aren't rows.
    """
    cut = F.transform(F.split("line", ","), lambda x: F.trim(x))
    rows = lines.withColumn("_f", cut).withColumn("_head", (F.col("line_no") == 0) & F.col("_f")[0].try_cast("double").isNull())
    heads = rows.where("_head").select(F.col("path").alias("_path"), F.col("member").alias("_member"), F.transform("_f", F.lower).alias("_names"))
    joined = rows.where("not _head").join(heads, (F.col("path") == F.col("_path")) & (F.col("member") == F.col("_member")), "left")

    def place(i: int, name: str):
        options = [name, *(aliases or {}).get(name, [])]
        found = F.coalesce(*(F.nullif(F.array_position("_names", o), F.lit(0)) for o in options))
        return F.when(F.col("_names").isNull(), F.get("_f", F.lit(i))).otherwise(F.get("_f", (found - 1).cast("int")))

    picked = [F.nullif(place(i, n), F.lit("")).alias(n) for i, n in enumerate(names)]
    return joined.select(*(c for c in lines.columns if c not in names), *picked)
