"""CSV files whose quoted fields hold line breaks, read in splits.

A line break ends a record if an even number of quotes lies before it in the file. So each split counts its
quotes and, for both cases, its records; the sums over the splits before tell which case it is, and which record the first lines of a
split still belong to. Then the task that reads a split puts its records together; only pieces of records that go over a split's end are brought
together. The records are written to the shared folder, so lines are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir

#: Bits of a record's position that number it in its split.
POSITION_BITS = 33


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: its quotes, and its lines with an even and with an odd number of quotes before them in it."""
    found: dict[tuple, list[int]] = {}
    for batch in batches:
        starts, quotes = batch.column("start").to_numpy(), batch.column("quotes").to_numpy()
        sources = batch.column("source").dictionary_encode()
        codes, names = sources.indices.to_numpy(), sources.dictionary.to_pylist()
        edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        for a, b in zip([0, *edges], [*edges, len(codes)], strict=True):
            if a == b:
                continue
            sums = found.setdefault((names[codes[a]], int(starts[a])), [0, 0, 0])
            odd = int(((sums[0] + np.cumsum(quotes[a:b]) - quotes[a:b]) % 2).sum())
            sums[0] += int(quotes[a:b].sum())
            sums[1] += b - a - odd
            sums[2] += odd
    rows = [{"source": k[0], "start": k[1], "quotes": v[0], "even": v[1], "odd": v[2]} for k, v in found.items()]
    schema = pa.schema([("source", pa.string()), ("start", pa.int64()), ("quotes", pa.int64()), ("even", pa.int64()), ("odd", pa.int64())])
    yield pa.RecordBatch.from_pylist(rows, schema=schema)


_RECORDS = "source string, pos long, start long, whole boolean, record binary"


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split, and the pieces of records that begin or end in another one (not ``whole``)."""
    at, out, lines = None, [], []
    pos, whole, open_ = None, False, False

    def end(is_whole: bool) -> None:
        out.append((at[0], pos, at[1], is_whole, b"\n".join(lines)))
        lines.clear()

    def made() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * 5
        out.clear()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["source", "pos", "start", "whole", "record"])

    for batch in batches:
        columns = (batch.column(k).to_pylist() for k in ("source", "start", "inside", "number", "open", "quotes", "value"))
        for source, start, inside, number, before, quotes, value in zip(*columns, strict=True):
            if at is None or at[1] != start or at[0] != source:
                if lines:
                    end(False)
                at, open_, whole, pos, following = (source, start), inside, False, before, number
            if not open_:
                whole, pos, following = True, following, following + 1
            lines.append(value)
            open_ ^= quotes % 2 == 1
            if not open_:
                end(whole)
        yield made()
    if lines:
        end(False)
        yield made()


def read_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``source, pos, record``: the text of every record, line breaks inside it kept; ``pos`` rises along a file, from 0.

    A record of blanks only is none. Quotes stand around whole fields, and twice inside them.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"),
        (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))).cast("long").alias("quotes"),
    )
    base = work_dir(spark, "records")
    counted = lines.select("source", "start", "quotes").mapInArrow(_count, "source string, start long, quotes long, even long, odd long")
    counted.write.parquet(f"{base}/splits")
    sums = spark.read.parquet(f"{base}/splits")

    along = Window.partitionBy("source").orderBy("start")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1)
    sums = sums.withColumn("begun", F.when(F.col("inside"), F.col("odd")).otherwise(F.col("even")))
    number = F.shiftleft((F.row_number().over(along) - 1).cast("long"), POSITION_BITS)
    last = F.last(F.when(F.col("begun") > 0, F.col("number") + F.col("begun") - 1), ignorenulls=True).over(earlier)
    splits = sums.withColumn("number", number).select("source", "start", "inside", "number", last.alias("open"))

    placed = lines.join(F.broadcast(splits), ["source", "start"])  # one row for each split
    placed.mapInArrow(_assemble, _RECORDS).write.parquet(f"{base}/records")
    found = spark.read.parquet(f"{base}/records").withColumn("record", F.col("record").cast("string"))
    one = found.filter("whole").select("source", "pos", "record")
    pieces = F.array_sort(F.collect_list(F.struct("start", "record")))
    several = found.filter("not whole").groupBy("source", "pos").agg(F.array_join(F.transform(pieces, lambda p: p["record"]), "\n").alias("record"))
    records = one.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return records.filter(F.trim("record") != "")


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True) -> DataFrame:
    """The columns of ``schema``, and ``pos``, the order in a file, of every record; a header is the first record of each file."""
    records = read_records(spark, path)
    if header:
        records = records.filter("pos > 0")
    return records.select("pos", _fields(F.col("record"), schema, sep).alias("r")).select("r.*", "pos")


def _fields(record: Column, schema: str, sep: str) -> Column:
    return F.from_csv(record, schema, {"sep": sep, "escape": '"'})


def header_of(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The names in the first record of a file of the folder."""
    first = read_records(spark, path).filter("pos = 0").orderBy("source").limit(1)
    row = first.select(F.regexp_extract_all("record", F.lit(f'(?:^|{sep})("(?:[^"]|"")*"|[^{sep}]*)'), F.lit(1)).alias("n")).first()
    return [n[1:-1].replace('""', '"') if n.startswith('"') else n for n in row["n"]] if row else []
