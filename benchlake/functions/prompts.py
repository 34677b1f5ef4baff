"""Prompt-variant registry: key -> label, description and a template built from Columns.

Templates are Column expressions (``concat`` of literals and question fields), so building a
prompt for billions of work items never leaves the JVM.  New variants are added with
``register_variant``.  Templates use the question, category, difficulty and type only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.schemas import PROMPT_VARIANTS as PROMPT_VARIANTS_SCHEMA

BOOLEAN_HINT = "\nChoices: True, False"
STRICT_INSTRUCTION = "Output: one short phrase on a single line."
EXPERT_INSTRUCTION = "Persona: quiz champion who states facts and adds nothing."


@dataclass(frozen=True)
class Variant:
    key: str
    label: str
    description: str
    build: Callable[[Callable[[str], Column]], Column]


def boolean_hint(q: Callable[[str], Column]) -> Column:
    """The two choices, listed by the variants that fix the output."""
    return F.when(q("type") == "boolean", F.lit(BOOLEAN_HINT)).otherwise(F.lit(""))


VARIANTS: dict[str, Variant] = {}


def register_variant(v: Variant) -> None:
    VARIANTS[v.key] = v


register_variant(Variant(
    "naive", "Plain",
    "Control group: the text of the item and nothing around it.",
    lambda q: q("question"),
))
register_variant(Variant(
    "strict_format", "Fixed output",
    "The item first, then the wanted output shape.",
    lambda q: F.concat(q("question"), F.lit("\n\n" + STRICT_INSTRUCTION), boolean_hint(q)),
))
register_variant(Variant(
    "role_expert", "Persona with topic",
    "A persona and the item's topic and level, then the item, then the wanted output shape.",
    lambda q: F.concat(
        F.lit(EXPERT_INSTRUCTION + "\nTopic: "), q("category"), F.lit(" / level: "), q("difficulty"),
        F.lit("\n\n"), q("question"), F.lit("\n\n" + STRICT_INSTRUCTION), boolean_hint(q),
    ),
))


def validate_variants(keys: list[str]) -> list[str]:
    """Fail before reading any data when a requested variant is unknown."""
    unknown = [k for k in keys if k not in VARIANTS]
    if unknown:
        raise ValueError(f"unknown prompt variant(s) {unknown}; available: {list(VARIANTS)}")
    if not keys:
        raise ValueError("at least one prompt variant is required")
    return list(keys)


def prompt_expr(variant_col: Column | str = "prompt_variant", keys: list[str] | None = None) -> Column:
    """One CASE over the registered templates, dispatching on the variant column."""
    vc = F.col(variant_col) if isinstance(variant_col, str) else variant_col
    keys = validate_variants(keys or list(VARIANTS))
    expr = None
    for k in keys:
        branch = VARIANTS[k].build(F.col)
        expr = F.when(vc == k, branch) if expr is None else expr.when(vc == k, branch)
    return expr


def registry_frame(spark: SparkSession) -> DataFrame:
    """The registry as a small table (key, label, description) for lookups and display."""
    rows = [(v.key, v.label, v.description) for v in VARIANTS.values()]
    return spark.createDataFrame(rows, PROMPT_VARIANTS_SCHEMA)
