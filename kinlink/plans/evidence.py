"""Fingerprints of plans and results, decisions, and metadata-only diagnostics."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyspark
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators.registry import DEFAULT, RULES, Policy, executed_plan, guard_plan, resolve


def plan_fingerprint(df: DataFrame) -> str:
    """SHA-256 of the plan without expression ids and white space."""
    return hashlib.sha256(re.sub(r"#\d+L?|id=#?\d+|\s+", "", executed_plan(df)).encode()).hexdigest()


def output_fingerprint(df: DataFrame) -> DataFrame:
    """One row (rows, digest): the digest does not depend on the order of rows. Sums of row hashes, with partial sums, so it scales."""
    row = F.to_json(F.struct(*(F.col(c) for c in sorted(df.columns))), {"ignoreNullFields": "false"})
    halves = [F.conv(F.substring(F.md5(row), i, 12), 16, 10).cast("decimal(38,0)") for i in (1, 13)]
    sums = df.select(*(h.alias(f"h{i}") for i, h in enumerate(halves))).agg(F.count("*").alias("rows"), *(F.coalesce(F.sum(f"h{i}"), F.lit(0)).alias(f"s{i}") for i in (0, 1)))
    return sums.select("rows", F.sha2(F.concat_ws(":", F.col("rows").cast("string"), F.col("s0").cast("string"), F.col("s1").cast("string")), 256).alias("digest"))


@dataclass
class Evidence:
    phase: str
    rules: list[str]
    plan: str
    output: str | None = None


def capture(df: DataFrame, phase: str, rules: list[str], with_output: bool = False) -> Evidence:
    return Evidence(phase, sorted(rules), plan_fingerprint(df), output_fingerprint(df).first()["digest"] if with_output else None)


def decisions(names: list[str], policy: Policy = DEFAULT) -> dict[str, str]:
    """For each name: ``rewrite``, ``disabled`` or ``unsupported``."""
    out = {}
    for name in names:
        try:
            found = resolve(name)
            out[name] = "disabled" if found in policy.disabled else "rewrite"
        except ValueError:
            out[name] = "unsupported"
    return out


def finish(df: DataFrame, phase: str, policy: Policy = DEFAULT) -> DataFrame:
    """The end of a phase: its plan is guarded and its summary logged; the frame itself is returned and no job runs."""
    guard_plan(df, policy, phase)
    if policy.mode != "OFF":
        policy.diagnostics.note("phase", phase=phase, mode=policy.mode, plan=plan_fingerprint(df))
    return df


def runtime(spark=None) -> dict:
    """What the session is; that a plan stayed native is for evidence of runs to say, not for configuration."""
    kind = "" if spark is None else f"{type(spark).__module__}.{type(spark).__name__}".lower()
    return {"pyspark": pyspark.__version__, "spark": str(getattr(spark, "version", "unknown")), "api": "connect" if "connect" in kind else "classic", "operations": len(RULES), "native_execution": None}
