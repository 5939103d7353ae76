"""Tables of one folder that change together.

Data is written into segments under names of their own. A manifest, written last under a temporary name and then
renamed, lists the segments of every table; readers take the manifest with the highest number. So a run that breaks leaves
segments that nothing lists, and the tables before it stay as they were; a run that ends changes all its tables at once.
One writer commits at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_manifests"


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    fs, path = _path(spark, f"{folder}/{MANIFESTS}")
    if not fs.exists(path):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _manifest(spark: SparkSession, folder: str, number: int) -> dict[str, list[str]]:
    fs, path = _path(spark, f"{folder}/{MANIFESTS}/{number:012d}.json")
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def segments(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """The segments of every table, as last committed."""
    numbers = _numbers(spark, folder)
    return _manifest(spark, folder, numbers[-1]) if numbers else {}


def write_segment(df: DataFrame, folder: str, table: str) -> str:
    """Writes a segment that no reader sees yet; returns its name for ``commit``."""
    name = f"{table}/{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{name}")
    return name


def commit(spark: SparkSession, folder: str, replace: dict[str, str] | None = None, append: dict[str, str] | None = None) -> None:
    """Makes segments visible, all at once: ``replace`` gives a table one segment, ``append`` one more."""
    numbers = _numbers(spark, folder)
    tables = _manifest(spark, folder, numbers[-1]) if numbers else {}
    for table, name in (replace or {}).items():
        tables[table] = [name]
    for table, name in (append or {}).items():
        tables[table] = [*tables.get(table, []), name]
    number = numbers[-1] + 1 if numbers else 0
    fs, temp = _path(spark, f"{folder}/{MANIFESTS}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    out.write(bytearray(json.dumps(tables).encode()))
    out.close()
    _, final = _path(spark, f"{folder}/{MANIFESTS}/{number:012d}.json")
    if fs.exists(final) or not fs.rename(temp, final):
        raise RuntimeError(f"another writer has committed to {folder}")


def read(spark: SparkSession, folder: str, table: str, schema: str) -> DataFrame:
    """A table as last committed; empty if it has no segment."""
    found = segments(spark, folder).get(table, [])
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/{name}" for name in found])


def sweep(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Removes segments that none of the last ``keep`` manifests lists, broken runs' too, and older manifests."""
    numbers = _numbers(spark, folder)
    listed = {name for n in numbers[-keep:] for names in _manifest(spark, folder, n).values() for name in names}
    tables = {name.partition("/")[0] for n in numbers for names in _manifest(spark, folder, n).values() for name in names}
    for table in tables:
        fs, path = _path(spark, f"{folder}/{table}")
        for found in fs.listStatus(path):
            if f"{table}/{found.getPath().getName()}" not in listed:
                fs.delete(found.getPath(), True)
    for n in numbers[:-keep]:
        fs, path = _path(spark, f"{folder}/{MANIFESTS}/{n:012d}.json")
        fs.delete(path, False)
