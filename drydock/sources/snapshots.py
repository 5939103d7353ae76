"""Captured listings, inspect documents, histories and completion streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import hold
from . import schemas


_CORRUPT = "_corrupt_line"


def parsed(text: Column, schema: str) -> Column:
    """The document of a JSON text with ``_CORRUPT``: null, or the text if it is malformed or a value is of another type."""
    return F.from_json(text, f"{schema.rstrip()[:-1]}, {_CORRUPT}:string>", {"columnNameOfCorruptRecord": _CORRUPT})


def well_formed(doc: Column) -> Column:
    """Whether a ``parsed`` document is JSON; only texts that did not fit the schema are looked at again."""
    return doc[_CORRUPT].isNull() | F.try_parse_json(doc[_CORRUPT]).isNotNull()


def json_lines(lines: DataFrame, schema: str, column: str = "line") -> DataFrame:
    """Parsed ``doc`` of each non-blank line; malformed lines are dropped."""
    kept = [c for c in lines.columns if c != column]
    docs = hold(lines.filter(F.trim(column) != ""), kept, parsed(F.col(column), schema), "doc")
    return docs.filter(well_formed(F.col("doc"))).withColumn("doc", F.col("doc").dropFields(_CORRUPT))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return json_lines(lines, schema)


def inspect_document(text: Column, schema: str) -> Column:
    """First element of an inspect array; null when the text is malformed or the array is empty."""
    return F.try_element_at(F.from_json(text, f"array<{schema}>"), F.lit(1))


def images(captures: DataFrame) -> DataFrame:
    """``image_id, doc, status`` from ``captures(image_id, json)``."""
    doc = inspect_document(F.col("json"), schemas.IMAGE_INSPECT)
    return captures.select("image_id", doc.alias("doc")).withColumn(
        "status", F.when(F.col("doc").isNull(), "error").otherwise("ok")
    )


def containers(captures: DataFrame, keys: tuple[str, ...] = ("container_id",)) -> DataFrame:
    doc = inspect_document(F.col("json"), schemas.CONTAINER_INSPECT)
    return captures.select(*keys, doc.alias("doc")).withColumn(
        "status", F.when(F.col("doc").isNull(), "error").otherwise("ok")
    )


def container_listing(lines: DataFrame, all_containers: bool = False) -> DataFrame:
    listed = json_lines(lines, schemas.CONTAINER_LISTING).select("doc.*")
    return listed if all_containers else listed.filter(F.lower("State") == "running")


def image_listing(lines: DataFrame) -> DataFrame:
    """Listing rows with the name ``repository:tag``, ``<none>`` for absent parts."""
    listed = json_lines(lines, schemas.IMAGE_LISTING).select("doc.*")
    part = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("<none>"))
    return listed.withColumn("name", F.concat(part("Repository"), F.lit(":"), part("Tag")))


def history(captures: DataFrame) -> DataFrame:
    """``image_id, pos, ...`` from ``captures(image_id, lines)``; pos 0 is the oldest entry."""
    lines = F.filter(F.split("lines", r"\r?\n"), lambda l: F.trim(l) != "")
    entries = hold(captures, ["image_id"], F.transform(lines, lambda l: parsed(l, schemas.HISTORY_ENTRY)), "entries")
    oldest_first = F.reverse(F.filter("entries", well_formed))  # blank and malformed lines do not count
    docs = entries.select("image_id", F.posexplode(oldest_first).alias("pos", "doc"))
    return docs.withColumn("doc", F.col("doc").dropFields(_CORRUPT)).select("image_id", "pos", "doc.*")


def completion_chunks(lines: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``keys, id, created, text, finish_reason`` from ``data: {json}`` lines; the end mark is dropped."""
    body = lines.filter(F.col("line").startswith("data: ")).withColumn("line", F.substring("line", F.lit(7), F.length("line")))
    doc = json_lines(body.filter("line <> '[DONE]'"), schemas.COMPLETION_CHUNK)
    first = F.try_element_at("doc.choices", F.lit(1))
    return doc.select(*keys, "doc.id", "doc.created", first["text"].alias("text"), first["finish_reason"].alias("finish_reason"))


def search_pages(pages: DataFrame) -> DataFrame:
    """``topic, page`` from captured code-search replies ``pages(topic, json)``."""
    return pages.select("topic", F.from_json("json", schemas.CODE_SEARCH_PAGE).alias("page")).filter("page is not null")
