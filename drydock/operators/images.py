"""Image audit over inspect documents and layer histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, sizes
from ..functions.text import fallback, let, strip
from .rows import hold, unfold
from .skew import running

# Thresholds, the source label and the switch values of the pip cache.
MAX_IMAGE_BYTES = 500 * 1024 * 1024
MAX_LAYERS = 20
SOURCE_LABEL = "org.opencontainers.image.source"
SWITCHED_ON = ("1", "true", "True")
EMPTY_SIZES = ("0B", "0 B")


def env_map(env: Column) -> Column:
    """``K=V`` list to a map; entries without '=' are ignored, the last value of a key wins."""
    pairs = F.filter(env, lambda e: e.contains("="))
    entries = F.transform(
        pairs,
        lambda e: F.struct(
            F.substring_index(e, "=", 1).alias("key"),
            F.substring(e, F.instr(e, "=") + 1, F.length(e)).alias("value"),
        ),
    )
    last = F.filter(
        entries,
        lambda x, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda y: y["key"] == x["key"]),
    )
    return F.map_from_entries(last)


def _env_value(env: Column, key: str) -> Column:
    """Last value of one variable, without building the map."""
    hits = F.filter(env, lambda e: e.startswith(f"{key}="))
    return F.substring(F.try_element_at(hits, F.lit(-1)), F.lit(len(key) + 2), F.length(F.try_element_at(hits, F.lit(-1))))


def inspect_findings(doc: Column) -> Column:
    """Findings of one image that need only its inspect document (a null document is an error)."""
    config = doc["Config"]
    env = config["Env"]
    found = rules.fired(
        {
            "image_size": doc["Size"] > MAX_IMAGE_BYTES,
            "image_layers": F.size(doc["RootFS"]["Layers"]) > MAX_LAYERS,
            "image_root": fallback(config["User"], "root") == "root",
            "image_no_healthcheck": config["Healthcheck"].isNull(),
            "image_ports_unlabelled": (F.size(config["ExposedPorts"]) > 0)
            & (F.coalesce(F.try_element_at(config["Labels"], F.lit(SOURCE_LABEL)), F.lit("")) == ""),
            "image_python_buffered": F.coalesce(
                F.exists(config["Cmd"], lambda c: F.lower(c).contains("python")), F.lit(False)
            )
            & _env_value(env, "PYTHONUNBUFFERED").isNull(),
            "image_pip_cache": ~F.coalesce(_env_value(env, "PIP_NO_CACHE_DIR").isin(*SWITCHED_ON), F.lit(False)),
        }
    )
    return F.when(doc.isNull(), F.array(rules.finding("image_inspect_failed"))).otherwise(found)


def has_size(size_text: Column) -> Column:
    return F.coalesce(~size_text.isin("", *EMPTY_SIZES), F.lit(False))


def large_layers(layers: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of ``layers(..., size_text)`` whose size is in gigabytes or above 200 MB.

    ``strict`` skips sizes written without a space.
    """
    return layers.filter(has_size(F.col("size_text")) & sizes.is_large_layer(F.col("size_text"), strict))


def layer_findings(layers: DataFrame, strict: bool = False) -> DataFrame:
    """``image_id, layer_id, size_text, rule_id, severity``: one row per large layer."""
    rule = rules.BY_ID["image_large_layer"]
    found = large_layers(layers, strict).select("image_id", "layer_id", "size_text")
    return found.withColumn("rule_id", F.lit(rule.rule_id)).withColumn("severity", F.lit(rule.severity))


def image_findings(images: DataFrame, layers: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """``image_id, rule_id, severity, n``; ``n`` is the number of layers for the large-layer rule, else
    1. Images without a finding get one ``image_ok`` row.

    Large layers are counted per image before the join, so an image with very many layers brings
    one row to it.
    """
    per_image = images.select("image_id", inspect_findings(F.col("doc")).alias("found"))
    if layers is None:
        n_large = F.lit(0)
    else:
        counts = large_layers(layers, strict).groupBy("image_id").agg(F.count("*").alias("n_large"))
        per_image = per_image.join(counts, "image_id", "left")
        n_large = F.coalesce(F.col("n_large"), F.lit(0))
    readable = F.lit(True) if layers is None else ~F.exists("found", lambda f: f["rule_id"] == "image_inspect_failed")
    base = per_image.select("image_id", "found", F.when(readable, n_large).otherwise(0).alias("n_large"))
    counted = F.transform(
        "found", lambda f: F.struct(f["rule_id"].alias("rule_id"), f["severity"].alias("severity"), F.lit(1).cast("long").alias("n"))
    )
    large, ok = rules.BY_ID["image_large_layer"], rules.BY_ID["image_ok"]

    def row(rule: rules.Rule, n: Column) -> Column:
        return F.array(F.struct(F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.severity).alias("severity"), n.cast("long").alias("n")))

    every = (
        F.when(F.col("n_large") > 0, F.concat(counted, row(large, F.col("n_large"))))
        .when(F.size("found") == 0, row(ok, F.lit(1)))
        .otherwise(counted)
    )
    return unfold(base, ["image_id"], every, "f").select("image_id", "f.*")


def subject(kind: str, name: Column, identity: Column) -> Column:
    return F.concat(F.lit(f"{kind} "), name, F.lit(" ("), identity, F.lit(")"))


def joined_list(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, ", ")).otherwise(F.lit("<none>"))


def image_summary(images: DataFrame, shown: int = 10) -> DataFrame:
    """The header facts of an image; env and labels show their first ``shown`` entries."""
    doc, config = F.col("doc"), F.col("doc.Config")
    labels = F.map_entries(config["Labels"])
    return hold(images, ["image_id"], doc, "doc").select(
        "image_id",
        joined_list(doc["RepoTags"]).alias("repo_tags"),
        joined_list(doc["RepoDigests"]).alias("repo_digests"),
        doc["Created"].alias("created"),
        doc["Architecture"].alias("architecture"),
        doc["Os"].alias("os"),
        sizes.signed_size(doc["Size"]).alias("size"),
        sizes.signed_size(doc["VirtualSize"]).alias("virtual_size"),
        fallback(config["User"], "root").alias("user"),
        fallback(config["WorkingDir"], "/").alias("working_dir"),
        joined_list(config["Entrypoint"]).alias("entrypoint"),
        joined_list(config["Cmd"]).alias("cmd"),
        F.slice(F.coalesce(config["Env"], F.array().cast("array<string>")), 1, shown).alias("env"),
        F.transform(
            F.slice(F.coalesce(labels, F.array().cast("array<struct<key:string,value:string>>")), 1, shown),
            lambda e: F.concat_ws("=", e["key"], e["value"]),
        ).alias("labels"),
        F.coalesce(F.size(labels) > shown, F.lit(False)).alias("more_labels"),
    )


def layer_command(created_by: Column, comment: Column, width: int = 80) -> Column:
    """Command in one line with its comment, cut to ``width`` with an ellipsis."""
    one_line = strip(F.regexp_replace(created_by, r"(?U)\s+", " "))
    note = F.when(F.coalesce(comment, F.lit("")) != "", F.concat(F.lit(" ("), comment, F.lit(")"))).otherwise("")
    return let(
        F.concat(let(one_line, lambda c: fallback(c, "<metadata>")), note),
        lambda t: F.when(F.length(t) > width, F.concat(F.substring(t, 1, width - 1), F.lit("…"))).otherwise(t),
    )


def short_id(layer_id: Column) -> Column:
    return fallback(
        F.substring(F.regexp_replace(F.coalesce(layer_id, F.lit("<unknown>")), "^sha256:", ""), 1, 12), "<missing>"
    )


def layer_table(layers: DataFrame, order: list[str]) -> DataFrame:
    """Layers oldest first with their number and the size so far.

    ``layers(image_id, layer_id, created_by, comment, size_bytes)`` plus the ``order`` columns.
    """
    shown = [short_id(F.col("layer_id")).alias("_layer"), layer_command(F.col("created_by"), F.col("comment")).alias("_command")]
    size = F.coalesce("size_bytes", F.lit(0)).alias("size_bytes")
    kept = [c for c in order if c not in ("image_id", "size_bytes")]
    # What is shown of the texts is cut before the rows move.
    sized = layers.select("image_id", size, *kept, *shown)
    out = running(sized, ["image_id"], order, "size_bytes", total="cumulative_bytes", number="layer_no")
    return out.select(
        "image_id",
        "layer_no",
        F.col("_layer").alias("layer"),
        "size_bytes",
        sizes.signed_size(F.col("size_bytes")).alias("size"),
        F.col("_command").alias("command"),
        "cumulative_bytes",
        sizes.signed_size(F.col("cumulative_bytes")).alias("cumulative"),
    )


def match_layers(history: Column, digests: Column, by_position: bool = False) -> Column:
    """Give each history entry (oldest first) its layer digest, inside one row.

    Only entries with a size own a layer; ``by_position`` pairs entry i with layer i regardless.
    """
    owner = F.transform(
        history,
        lambda h, i: i + 1 if by_position else F.when(h["size_bytes"] > 0, i),
    )
    owners = F.filter(owner, lambda i: i.isNotNull())
    return F.transform(
        history,
        lambda h, i: F.struct(
            *[h[c].alias(c) for c in ("layer_id", "size_bytes")],
            (
                F.get(digests, i)
                if by_position
                else F.when(h["size_bytes"] > 0, F.get(digests, (F.array_position(owners, i) - 1).cast("int")))
            ).alias("digest"),
        ),
    )
