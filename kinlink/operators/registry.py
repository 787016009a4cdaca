"""Operation ids, the policy that guards them, and the DataFrame entry points."""

from __future__ import annotations

import logging
import re
import uuid
from dataclasses import dataclass, field

from pyspark.errors import PySparkAttributeError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.functions.hashes import HASHES
from kinlink.functions.preprocess import PREPROCESS, vector_value
from kinlink.functions.similarity import SIMILARITIES, UNSUPPORTED


class UnsupportedOperation(ValueError):
    """No rule has this name."""


class DisabledOperation(RuntimeError):
    """The policy disables this operation."""


class GuardViolation(RuntimeError):
    """A physical plan holds a node that the policy forbids."""


ALIASES = {
    "EXACT_SIMILARITY": "similarity.SimilarityFunctionExact",
    "JACCARD_SIMILARITY": "similarity.JaccSimFunction",
    "JARO_SIMILARITY": "similarity.JaroWinklerFunction",
    "TRIM": "preprocess.trim",
    "CASE_NORMALIZE": "preprocess.caseNormalize",
    "case_normalize": "preprocess.caseNormalize",
    "casenormalize": "preprocess.caseNormalize",
    "trim": "preprocess.trim",
}

RULES = {f"similarity.{k}": f for k, f in SIMILARITIES.items()} | {f"blocking.{k}": f for k, f in HASHES.items()} | {f"preprocess.{k}": f for k, f in PREPROCESS.items()} | {"model.vectorValue": vector_value}

#: Physical nodes that leave the expression engine: those that run Python or R workers, and those that turn rows into objects.
FORBIDDEN_NODES = [
    "Python", "InPandas", "InArrow", "InR", "AttachDistributedSequence",
    "ScalaUDF", "ScalaAggregator", "MapElements", "MapPartitions", "MapGroups", "CoGroup", "AppendColumns", "DeserializeToObject", "SerializeFromObject", "ExistingRDD",
]
_NODE = re.compile(r"^[\s:+|-]*(?:\*\(\d+\) )?([A-Za-z]\w*(?: ExistingRDD)?)", re.M)
_FUNCTION = re.compile(r"\bUDF(?::\w+)?\(|\bpythonUDF\d+")

# fixed values: the names of the modes
MODES = ("OFF", "AUDIT", "REWRITE", "STRICT")

log = logging.getLogger("kinlink")


@dataclass
class Diagnostics:
    """Each message once a run; metadata only, never values of rows."""

    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    seen: set[str] = field(default_factory=set)

    def note(self, code: str, level: int = logging.INFO, **metadata) -> bool:
        message = f"{code} " + " ".join(f"{k}={v}" for k, v in sorted(metadata.items()))
        if message in self.seen:
            return False
        self.seen.add(message)
        log.log(level, "%s run=%s", message, self.run)
        return True


@dataclass(frozen=True)
class Policy:
    """How operations and plans are treated; ``disabled`` holds operation ids.

    OFF: nothing is looked at. AUDIT: what a plan holds that leaves the expression engine is logged. REWRITE: rules that are
    applied are logged too. STRICT: such a plan raises, and non-finite model input is refused. ``guard`` switches plans' inspection
    off, ``explain`` logs the decision for each operation.
    """

    mode: str = "STRICT"
    disabled: frozenset[str] = field(default_factory=frozenset)
    guard: bool = True
    explain: bool = False
    diagnostics: Diagnostics = field(default_factory=Diagnostics, compare=False)

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"{self.mode} is not one of {', '.join(MODES)}")

    @staticmethod
    def parse(mode: str | None, **settings) -> Policy:
        """A policy of a mode's name in any case; none is OFF."""
        return Policy((mode or "OFF").strip().upper(), **settings)

    @property
    def strict(self) -> bool:
        return self.mode == "STRICT"

    def check(self, operation: str) -> None:
        disabled = operation in self.disabled
        if self.explain:
            self.diagnostics.note("explain", operation=operation, decision="disabled" if disabled else "rewrite")
        if disabled:
            raise DisabledOperation(f"{operation} is disabled")
        if self.mode in ("REWRITE", "STRICT"):
            self.diagnostics.note("rewrite", operation=operation, mode=self.mode)


DEFAULT = Policy()


def resolve(name: str, kind: str = "") -> str:
    """The operation id of an id, an alias, a short name or a class name."""
    if name in RULES:
        return name
    if name in ALIASES:
        return ALIASES[name]
    last = name.rsplit(".", 1)[-1]
    if last in UNSUPPORTED:
        raise UnsupportedOperation(f"{last} has no rule")
    for k in [kind] if kind else ["similarity", "blocking", "preprocess", "model"]:
        if f"{k}.{last}" in RULES:
            return f"{k}.{last}"
    raise UnsupportedOperation(f"{name} is not a known operation")


def rule(name: str, kind: str = "", policy: Policy = DEFAULT):
    found = resolve(name, kind)
    policy.check(found)
    return RULES[found]


def executed_plan(df: DataFrame) -> str:
    """The physical plan as text, over classic sessions and Connect."""
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    except (AttributeError, PySparkAttributeError):
        return df._explain_string(mode="simple")


def foreign_nodes(plan: str) -> list[str]:
    """Nodes and functions of a plan's text that leave the expression engine."""
    found = {n for n in _NODE.findall(plan) if any(f in n for f in FORBIDDEN_NODES)}
    return sorted(found | ({"UDF"} if _FUNCTION.search(plan) else set()))


def guard_plan(df: DataFrame, policy: Policy = DEFAULT, phase: str = "plan") -> DataFrame:
    """The frame itself. A foreign node in its plan raises under STRICT and is logged under AUDIT and REWRITE. Runs no job."""
    if policy.guard and policy.mode != "OFF":
        if found := foreign_nodes(executed_plan(df)):
            if policy.strict:
                raise GuardViolation(f"{phase}: the plan holds {', '.join(found)}")
            policy.diagnostics.note("guard", logging.WARNING, phase=phase, nodes=",".join(found), mode=policy.mode)
    return df


def similarity(df: DataFrame, name: str, left: str, right: str, out: str, policy: Policy = DEFAULT) -> DataFrame:
    return df.withColumn(out, rule(name, "similarity", policy)(F.col(left), F.col(right)))


def similarity_batch(df: DataFrame, names: list[str], lefts: list[str], rights: list[str], outs: list[str], policy: Policy = DEFAULT) -> DataFrame:
    """All scores in one projection."""
    if not len(names) == len(lefts) == len(rights) == len(outs):
        raise ValueError("names, lefts, rights and outs must have one length")
    return df.withColumns({o: rule(n, "similarity", policy)(F.col(a), F.col(b)) for n, a, b, o in zip(names, lefts, rights, outs)})


def block_hash(df: DataFrame, name: str, column: str, out: str, policy: Policy = DEFAULT) -> DataFrame:
    return df.withColumn(out, rule(name, "blocking", policy)(F.col(column)))


def preprocess(df: DataFrame, name: str, columns: list[str], policy: Policy = DEFAULT) -> DataFrame:
    """A unary operation over several columns, in place; unknown columns raise."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    if resolve(name, "preprocess") == "preprocess.stopWords":
        raise UnsupportedOperation("stop words need a pattern: use remove_stop_words")
    return df.withColumns({c: rule(name, "preprocess", policy)(F.col(c)) for c in columns})


def remove_stop_words(df: DataFrame, column: str, pattern: str | None, policy: Policy = DEFAULT) -> DataFrame:
    if pattern is None:
        raise ValueError("a stop-word pattern is needed")
    return df.withColumn(column, rule("preprocess.stopWords", policy=policy)(F.col(column), pattern))


def vector_values(df: DataFrame, column: str, out: str, policy: Policy = DEFAULT) -> DataFrame:
    return df.withColumn(out, rule("model.vectorValue", policy=policy)(F.col(column)))


def transform(df: DataFrame, name: str, columns: list[str], out: str, policy: Policy = DEFAULT, **settings) -> DataFrame:
    """Any operation by name: its columns in order, the result in ``out``."""
    return df.withColumn(out, rule(name, policy=policy)(*(F.col(c) for c in columns), **settings))


def column_of(name: str, *columns: Column) -> Column:
    return RULES[resolve(name)](*columns)
