"""A session's handle on the operations by name, with its policy and status."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from kinlink.operators import registry
from kinlink.operators.registry import Policy


@dataclass
class Engine:
    spark: SparkSession
    policy: Policy = field(default_factory=Policy)

    def status(self) -> dict:
        """The runtime, the mode and what is available; metadata only."""
        from kinlink.plans.evidence import runtime

        by = {}
        for name in registry.RULES:
            kind = name.split(".")[0]
            by[kind] = by.get(kind, 0) + 1
        return runtime(self.spark) | {"mode": self.policy.mode, "disabled": sorted(self.policy.disabled), "run": self.policy.diagnostics.run, "capabilities": by}

    def transform(self, df: DataFrame, name: str, columns: list[str], out: str, **settings) -> DataFrame:
        return registry.transform(df, name, columns, out, self.policy, **settings)

    def preprocess(self, df: DataFrame, name: str, columns: list[str]) -> DataFrame:
        return registry.preprocess(df, name, columns, self.policy)

    def exact(self, df: DataFrame, left: str, right: str, out: str = "z_exact") -> DataFrame:
        return registry.similarity(df, "EXACT_SIMILARITY", left, right, out, self.policy)

    def jaccard(self, df: DataFrame, left: str, right: str, out: str = "z_jaccard") -> DataFrame:
        return registry.similarity(df, "JACCARD_SIMILARITY", left, right, out, self.policy)

    def jaro(self, df: DataFrame, left: str, right: str, out: str = "z_jaro") -> DataFrame:
        return registry.similarity(df, "JARO_SIMILARITY", left, right, out, self.policy)
