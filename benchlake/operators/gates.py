"""Quality gates: write, audit, publish.

All checks of a table (unique, not null, accepted values) are one scan: rows are aggregated per
key with conditional counts, then over the keys.  A relation between two tables aggregates the
child per key before it meets the parent, so a hot key arrives as one row.  Tables are published
only if every count is zero; otherwise the version in force stays.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.operators.quality import ACCEPTED, NOT_NULL
from benchlake.sources import versions

AUDIT = "table_name string, check_name string, column_name string, n_failing long"


class Checks(NamedTuple):
    """Checks of one table; ``unique`` is one key of one or more columns."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, list[str]] = {}


class Relation(NamedTuple):
    """Every value of ``child.column`` is found in ``parent.key`` (NULLs ignored)."""

    child: str
    column: str
    parent: str
    key: str


#: The declared checks of the staging models.
STAGING_CHECKS = {
    "stg_questions": Checks(("question_id",), tuple(NOT_NULL["stg_questions"]), ACCEPTED),
    "stg_ai_responses": Checks((), tuple(NOT_NULL["stg_ai_responses"])),
    "stg_responses_enriched": Checks((), tuple(NOT_NULL["stg_responses_enriched"])),
}
STAGING_RELATIONS = (Relation("stg_ai_responses", "question_id", "stg_questions", "question_id"),)


class GateFailed(RuntimeError):
    """The audit found failures: ``audit`` has the rows (table, check, column, failing)."""

    def __init__(self, audit: list):
        self.audit = audit
        bad = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.n_failing}" for r in audit if r.n_failing]
        super().__init__("not published; " + "; ".join(bad))


def audit_table(df: DataFrame, name: str, checks: Checks) -> DataFrame:
    """``table_name, check_name, column_name, n_failing``, a row per check.

    not_null counts rows; accepted_values counts rows whose value is set but not in the list;
    unique counts the keys found more than once (a key with a NULL is left out)."""
    wrong = {("not_null", c): F.col(c).isNull() for c in checks.not_null}
    wrong |= {("accepted_values", c): F.col(c).isNotNull() & ~F.col(c).isin(list(values)) for c, values in checks.accepted.items()}
    flags = [F.count(F.when(test, F.lit(1))).alias(f"_f{i}") for i, test in enumerate(wrong.values())]
    counts = [F.coalesce(F.sum(f"_f{i}"), F.lit(0)).cast("long") for i in range(len(wrong))]
    names = list(wrong)
    if checks.unique:
        # One row per key in between; the group of NULL keys counts for the other checks only.
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in checks.unique])
        per = df.groupBy(*checks.unique).agg(F.count(F.lit(1)).alias("_n"), *flags)
        counts.append(F.count(F.when(whole & (F.col("_n") > 1), F.lit(1))))
        names.append(("unique", ", ".join(checks.unique)))
    else:
        per = df.agg(*flags)
    found = per.agg(*[c.alias(f"_c{i}") for i, c in enumerate(counts)])
    return found.select(F.inline(F.array(*[F.struct(
        F.lit(name).alias("table_name"), F.lit(kind).alias("check_name"), F.lit(column).alias("column_name"), F.col(f"_c{i}").alias("n_failing"))
        for i, (kind, column) in enumerate(names)])))


def audit_relation(child: DataFrame, parent: DataFrame, relation: Relation) -> DataFrame:
    """One audit row: the child's rows without a parent."""
    per = child.where(F.col(relation.column).isNotNull()).groupBy(F.col(relation.column).alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    keys = parent.select(F.col(relation.key).alias("_key"))
    lost = per.join(keys, F.col("_of") == F.col("_key"), "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_failing")).select(
        F.lit(relation.child).alias("table_name"), F.lit("relation").alias("check_name"), F.lit(relation.column).alias("column_name"), "n_failing")


def audit(tables: dict[str, DataFrame], checks: dict[str, Checks], relations: tuple[Relation, ...] = ()) -> DataFrame:
    """The audit rows of all checks, a scan per table and two per relation."""
    parts = [audit_table(tables[name], name, c) for name, c in checks.items() if any(c)]
    parts += [audit_relation(tables[r.child], tables[r.parent], r) for r in relations]
    if not parts:
        raise ValueError("no checks")
    return reduce(DataFrame.unionByName, parts)


def publish_checked(spark: SparkSession, tables: dict[str, DataFrame], root: str, checks: dict[str, Checks] = STAGING_CHECKS,
                    relations: tuple[Relation, ...] = STAGING_RELATIONS, keep: int = 2) -> tuple[versions.Version, list]:
    """Stage the tables, audit them as written, publish them if nothing fails.

    Returns the version and the audit rows (one per check).  With failures the staged data is
    removed, the version in force stays and ``GateFailed`` carries the rows.  At most ``keep``
    versions remain afterwards."""
    staged = versions.stage(spark, tables, root)
    try:
        rows = audit({name: staged.read(spark, name) for name in staged.tables}, checks, relations).collect()
        if any(r.n_failing for r in rows):
            raise GateFailed(rows)
        done = versions.commit(spark, staged, root)
    except Exception:
        versions.discard(spark, staged)
        raise
    versions.retain(spark, root, keep)
    return done, rows
