"""The rule catalogue: one row per rule, and the conditions as Columns.

``size_related`` and ``saving_kb`` are properties of a rule here, so no message text is searched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Rule:
    rule_id: str
    target: str
    severity: str
    message: str
    size_related: bool = False
    saving_kb: int = 0
    size_profile: bool = False
    review_profile: bool = False


# Severities, savings in KB and the size flags.
RULES: tuple[Rule, ...] = (
    Rule("from_unpinned", "file", "warning", "Base image has no fixed tag or digest."),
    Rule("apt_no_recommends", "file", "info", "Package install pulls in recommended packages.", True, 50000, True, True),
    Rule("apt_clean", "file", "info", "Package lists stay in the layer.", True, 10000, True, True),
    Rule("apt_update_split", "file", "info", "Index update and install are in separate layers.", True, 20000, False, True),
    Rule("pip_cache", "file", "info", "Python download cache stays in the layer.", True, 10000, False, True),
    Rule("pipe_to_shell", "file", "warning", "A download is piped straight into a shell."),
    Rule("combine_run", "file", "info", "A single command takes a layer of its own.", True, 20000, True, True),
    Rule("add_vs_copy", "file", "info", "ADD is used where COPY would do.", False, 0, True),
    Rule("multi_stage", "file", "suggestion", "Build tools could stay in an earlier stage.", True, 100000, True, True),
    Rule("no_user", "file", "warning", "No USER instruction, the image runs as root."),
    Rule("no_healthcheck", "file", "suggestion", "No HEALTHCHECK instruction."),
    Rule("missing_file", "file", "error", "The build file could not be read."),
    Rule("image_inspect_failed", "image", "error", "The image could not be inspected."),
    Rule("image_size", "image", "info", "The image is larger than 500 MB."),
    Rule("image_layers", "image", "info", "The image has more than 20 layers."),
    Rule("image_root", "image", "warning", "The default user is root."),
    Rule("image_no_healthcheck", "image", "suggestion", "The image defines no health check."),
    Rule("image_ports_unlabelled", "image", "info", "Ports are exposed but the source label is absent."),
    Rule("image_python_buffered", "image", "suggestion", "Python output is buffered."),
    Rule("image_pip_cache", "image", "info", "The pip cache is not switched off."),
    Rule("image_large_layer", "image", "info", "A layer is larger than 200 MB."),
    Rule("image_ok", "image", "ok", "Nothing to report for the image."),
    Rule("container_inspect_failed", "container", "error", "The container could not be inspected."),
    Rule("container_stopped", "container", "warning", "The container is not running."),
    Rule("container_unhealthy", "container", "warning", "The health check does not pass."),
    Rule("container_root", "container", "warning", "The container runs as root."),
    Rule("container_no_restart", "container", "suggestion", "No restart policy is set."),
    Rule("container_privileged", "container", "warning", "The container is privileged."),
    Rule("container_no_memory_limit", "container", "info", "No memory limit is set."),
    Rule("container_log_driver", "container", "suggestion", "The default log driver has no size limit."),
    Rule("container_port_unbound", "container", "info", "A port has no host binding."),
    Rule("container_ok", "container", "ok", "Nothing to report for the container."),
)
BY_ID = {r.rule_id: r for r in RULES}
SEVERITY_RANK = {"error": 0, "warning": 1, "info": 2, "suggestion": 3, "ok": 4}


def finding(rule_id: str, idx: Column | None = None) -> Column:
    fields = [] if idx is None else [idx.alias("idx")]
    return F.struct(*fields, F.lit(rule_id).alias("rule_id"), F.lit(BY_ID[rule_id].severity).alias("severity"))


def fired(conditions: dict[str, Column], idx: Column | None = None) -> Column:
    """Array of findings whose condition is true, in catalogue order."""
    return F.array_compact(F.array(*[F.when(cond, finding(rule, idx)) for rule, cond in conditions.items()]))


def or_ok(findings: Column, ok_rule: str) -> Column:
    return F.when(F.size(findings) == 0, F.array(finding(ok_rule))).otherwise(findings)


def saving_kb(rule_id: Column) -> Column:
    """Estimated saving of one finding, 0 for rules without an estimate."""
    value = None
    for rule in RULES:
        if rule.saving_kb:
            cond = rule_id == rule.rule_id
            value = F.when(cond, rule.saving_kb) if value is None else value.when(cond, rule.saving_kb)
    return value.otherwise(0)


def is_size_related(rule_id: Column) -> Column:
    return rule_id.isin([r.rule_id for r in RULES if r.size_related])


def in_size_profile(rule_id: Column) -> Column:
    return rule_id.isin([r.rule_id for r in RULES if r.size_profile])


def in_review_profile(rule_id: Column) -> Column:
    """Rules of the profile that goes with a size review by a model."""
    return rule_id.isin([r.rule_id for r in RULES if r.review_profile])


def instruction_findings(idx: Column, instruction: Column, value: Column) -> Column:
    run = instruction == "RUN"
    apt = run & (value.contains("apt-get") | value.contains("apt "))
    return fired(
        {
            "from_unpinned": (instruction == "FROM")
            & (~value.contains(":") | F.rtrim(value).endswith(":latest")),
            "apt_no_recommends": apt & ~value.contains("--no-install-recommends"),
            "apt_clean": apt
            & ~value.rlike(r"(?U)apt-get\s+clean")
            & ~value.rlike(r"(?U)rm\s+-rf\s+/var/lib/apt/lists"),
            "apt_update_split": apt & value.contains("apt-get update") & ~value.contains("apt-get install"),
            "pip_cache": run & value.contains("pip install") & ~value.contains("--no-cache-dir"),
            "pipe_to_shell": run & value.rlike(r"(curl|wget).*\|.*(sh|bash)"),
            "combine_run": run & ~value.contains("&&"),
            "add_vs_copy": (instruction == "ADD") & ~value.contains(".tar"),
        },
        idx,
    )


def file_findings(instrs: Column) -> Column:
    """Whole-file rules over the instruction array of one file."""
    runs = F.filter(instrs, lambda x: x["instruction"] == "RUN")
    return fired(
        {
            "multi_stage": (F.size(runs) > 3) & F.exists(runs, lambda x: x["value"].contains("apt-get")),
            "no_user": ~F.exists(instrs, lambda x: x["instruction"] == "USER"),
            "no_healthcheck": ~F.exists(instrs, lambda x: x["instruction"] == "HEALTHCHECK"),
        },
        F.lit(-1),
    )
