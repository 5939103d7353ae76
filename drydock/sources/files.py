"""Whole text files: build files below repository folders, and logs."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import count, islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import buildfile
from ..functions.text import last_segment, split_lines
from ..operators.rows import unfold
from ..operators.skew import running
from ..session import work_dir


#: Entries that a task lists before it leaves the folders it has not seen to the next round.
WALK_ENTRIES = 10_000
#: Bytes that opening a small log counts for when files are dealt to tasks; Spark's 4 MB makes a task of some thirty files.
SMALL_FILE = 16 << 10
_OPEN_COST = "spark.sql.files.openCostInBytes"


def file_system(uri: str) -> tuple[pafs.FileSystem, str, str]:
    """The file system, the path in it, and what stands before its paths in a URI."""
    scheme, sep, rest = uri.partition("://")
    if not sep or scheme == "file":
        local = "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else os.path.abspath(uri)
        return pafs.LocalFileSystem(), local, "file:"
    fs, path = pafs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{rest}")
    return fs, path, f"{scheme}://{rest.partition('/')[0] if path.startswith('/') else ''}"


def _walk(folder: str, entries: int) -> Iterator[tuple[str, int | None]]:
    """Files below a folder with their sizes, and folders, without a size, that are left after so many entries."""
    fs, path, prefix = file_system(folder)
    todo, seen = [path], 0
    while todo and seen <= entries:
        for found in fs.get_file_info(pafs.FileSelector(todo.pop())):
            seen += 1
            if prefix == "file:" and os.path.islink(found.path) and found.type == pafs.FileType.Directory:
                continue  # a link to a folder may lead back
            if found.type == pafs.FileType.Directory:
                todo.append(found.path)
            elif found.type == pafs.FileType.File:
                yield prefix + found.path, found.size
    yield from ((prefix + rest, None) for rest in todo)


def _list(entries: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                walk = _walk(folder, entries)
                while rows := list(islice(walk, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64())], ["path", "size"])

    return run


def list_files(spark: SparkSession, root: str, entries: int = WALK_ENTRIES) -> DataFrame:
    """``path, size`` of every file below ``root``, empty ones too, listed by tasks.

    A round lists folders, each with what lies below it as far as ``entries`` go; the folders that are left are dealt out in the
    next round. The rounds are written to the shared folder; the driver sees the root and whether folders are left.
    """
    base = work_dir(spark, "listing")
    folders = spark.createDataFrame([(root,)], "folder string")
    for k in count():
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = folders if k == 0 else folders.repartition(tasks)
        dealt.mapInArrow(_list(entries), "path string, size long").write.parquet(f"{base}/round={k}")
        left = spark.read.parquet(f"{base}/round={k}").filter("size is null")
        if left.isEmpty():
            return spark.read.parquet(base).filter("size is not null").select("path", "size")
        folders = left.select(F.col("path").alias("folder"))


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, name, _ = file_system(path)
            with fs.open_input_stream(name) as f:
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([f.read()], pa.binary())], ["path", "content"])


def read_build_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, file_name, content, is_plausible`` of every build file below ``root``.

    Tasks list the tree and read the files with a build file's name, empty ones too; bytes that are not UTF-8 are replaced.
    """
    listed = list_files(spark, root).filter(buildfile.is_buildfile_name(last_segment(F.col("path"))))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = listed.select("path").repartition(tasks).mapInArrow(_contents, "path string, content binary")
    named = read.select("path", last_segment(F.col("path")).alias("file_name"), F.make_valid_utf8(F.col("content").cast("string")).alias("content"))
    return named.withColumn("is_plausible", buildfile.is_plausible(F.col("content")))


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """``source, content``: one row per log file, invalid UTF-8 replaced."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select(F.col("path").alias("source"), F.make_valid_utf8(F.col("content").cast("string")).alias("content"))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``source, line_no, content`` of log files of any length, numbered from 1.

    Files are read in splits, once, many small ones by one task; a line's number is its place among the lines of its file, counted in
    blocks by (split, row in the split). Line breaks other than CR and LF are found inside what a split calls a line.
    """
    read = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
        F.make_valid_utf8("value").alias("value"),
    )
    base = work_dir(spark, "lines")
    before = spark.conf.get(_OPEN_COST)
    spark.conf.set(_OPEN_COST, str(SMALL_FILE))
    try:
        read.write.parquet(base)
    finally:
        spark.conf.set(_OPEN_COST, before)
    stored = spark.read.schema(read.schema).parquet(base)
    lines = unfold(stored, ["source", "_start", "_row"], split_lines(F.col("value")), "content", pos="_part").withColumn("_one", F.lit(1))
    numbered = running(lines, ["source"], ["_start", "_row", "_part"], "_one", total="line_no")
    return numbered.select("source", F.col("line_no").cast("int").alias("line_no"), "content")
