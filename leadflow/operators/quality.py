"""Reconciliation / data-quality checks: each returns the violating rows (empty = pass)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

C = F.col


def rate_split_reconcile(split: DataFrame, metric: DataFrame) -> DataFrame:
    """Q3: inst_before + inst_after must equal the metric's installs."""
    j = split.join(metric.select("partner_id", "installs").withColumnRenamed("installs", "m_installs"), "partner_id", "left")
    return j.select("partner_id", (C("inst_before") + C("inst_after")).alias("split_sum"),
                    F.coalesce(C("m_installs"), F.lit(0)).alias("installs")).where(C("split_sum") != C("installs"))


def metric_reconcile(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Q1: per-key diff of two implementations (missing side counts as 0)."""
    x = a.select(key, *[C(c).alias(f"a_{c}") for c in cols])
    y = b.select(key, *[C(c).alias(f"b_{c}") for c in cols])
    j = x.join(y, key, "full_outer")
    diff = F.lit(False)
    for c in cols:
        diff = diff | ~F.coalesce(C(f"a_{c}"), F.lit(0)).eqNullSafe(F.coalesce(C(f"b_{c}"), F.lit(0)))
    return j.where(diff).select(key, *[F.coalesce(C(f"{s}_{c}"), F.lit(0)).cast("bigint").alias(f"{s}_{c}")
                                       for c in cols for s in ("a", "b")])


def subset_check(leads: DataFrame) -> DataFrame:
    """Q2: installed leads without a technician (expected none)."""
    return leads.where((C("has_installed") == 1) & (C("tech_assigned") == 0))


def roster_drift(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str] = ()) -> DataFrame:
    """Q7: two copies of a roster differ: only_a / only_b / changed."""
    x = a.select(key, *[C(c).alias(f"a_{c}") for c in cols]).withColumn("_a", F.lit(True))
    y = b.select(key, *[C(c).alias(f"b_{c}") for c in cols]).withColumn("_b", F.lit(True))
    j = x.join(y, key, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & C(f"a_{c}").eqNullSafe(C(f"b_{c}"))
    kind = F.when(C("_a").isNull(), "only_b").when(C("_b").isNull(), "only_a").when(~same, "changed")
    return j.select(key, kind.alias("kind")).where(C("kind").isNotNull())


def bridge_fanout(bridge: DataFrame) -> DataFrame:
    """Q5: profiles mapped to more than one partner."""
    return (bridge.groupBy("profile_id").agg(F.countDistinct("partner_id").alias("partners"))
            .where(C("partners") > 1))


class CoverageError(RuntimeError):
    pass


def unresolved(cohort: DataFrame, resolvable: DataFrame, key: str) -> DataFrame:
    """Cohort members that can't be resolved to an audience."""
    return cohort.select(key).distinct().join(resolvable.select(key).distinct(), key, "left_anti")


def coverage_gate(cohort: DataFrame, resolvable: DataFrame, key: str, slack: int) -> DataFrame:
    """Q4: one row (cohort, resolvable, passed): passed unless more than ``slack`` members can't be resolved."""
    there = resolvable.select(key).distinct().withColumn("_ok", F.lit(True))
    g = cohort.select(key).distinct().join(there, key, "left").agg(
        F.count(F.lit(1)).alias("cohort"), F.count("_ok").alias("resolvable"))
    return g.withColumn("passed", C("resolvable") >= C("cohort") - slack)


def require_coverage(gate: DataFrame) -> None:
    """Raise when a ``coverage_gate`` row didn't pass; a refresh job calls this before it publishes."""
    r = gate.first()
    if not r["passed"]:
        raise CoverageError(f"only {r['resolvable']} of {r['cohort']} resolvable")


def exclude_test(df: DataFrame, rosters: DataFrame, key: str = "partner_id") -> DataFrame:
    """Q6: drop test partners from money runs (anti join on the roster's test flag)."""
    tests = rosters.where(F.col("is_test")).select(F.col("partner_id").alias(key))
    return df.join(tests, key, "left_anti")
