"""Declarative audit: named checks, one result row each.

A check names its offenders (a DataFrame with a string column ``offender``) and perhaps facts (a DataFrame
with columns ``fact`` and ``n``). Each check runs alone: one that fails while it runs is a FAIL row and the others
still report. An Abort stops the audit: its input must not be audited at all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.functions.text import scrub

#: Offenders that a result row names; the count is of all, failures() lists all.
SHOWN = 10
_ROW = "id string, name string, status string, n_failures long, failures string, facts string"


class Abort(Exception):
    """The input must not be audited."""


@dataclass(frozen=True)
class Check:
    """build gives the offenders; info: an inventory, which can't fail (offenders all the same do, if may_fail)."""

    id: str
    name: str
    build: Callable[[], DataFrame]
    info: bool = False
    facts: Callable[[], DataFrame] | None = None
    may_fail: bool = False


def _offenders(check: Check) -> DataFrame:
    return check.build().select(scrub(F.col("offender").cast("string")).alias("offender"))


def counted(check: Check) -> DataFrame:
    """(offender, n): each offender once, and how often it was found."""
    return _offenders(check).groupBy("offender").agg(F.count(F.lit(1)).alias("n"))


def result(check: Check, found: DataFrame | None = None) -> DataFrame:
    """One row (id, name, status, n_failures, failures, facts): PASS without offenders, else FAIL, or INFO for inventories.

    Offenders are scrubbed of addresses and passcodes, the first SHOWN named in order, once each. An empty table of offenders passes.
    found: what counted() gives, where it is held already; it is read twice.
    """
    found = counted(check) if found is None else found
    shown = found.where("offender IS NOT NULL").orderBy("offender").limit(SHOWN).agg(F.array_sort(F.collect_list("offender")).alias("s"))
    n = found.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))
    status = F.when(F.col("n") == 0, "PASS").otherwise("FAIL")
    if check.info:
        status = F.when(F.col("n") == 0, "INFO").otherwise("FAIL" if check.may_fail else "INFO")
    facts = F.lit("").alias("facts")
    out = n.crossJoin(shown)
    if check.facts is not None:
        f = check.facts().select(F.concat("fact", F.lit("="), "n").alias("x")).agg(F.array_join(F.array_sort(F.collect_list("x")), ", ").alias("facts"))
        out, facts = out.crossJoin(f), F.col("facts")
    return out.select(F.lit(check.id).alias("id"), F.lit(check.name).alias("name"), status.alias("status"), F.col("n").alias("n_failures"), F.array_join("s", ", ").alias("failures"), facts)


def run_checks(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """All result rows, one job for each check; a check that stops with an error is a FAIL row that names the kind of error.

    A check's offenders are found once, and held (spilling to disk) until its row is made.
    """
    rows = []
    for c in checks:
        found = None
        try:
            found = counted(c).persist()
            rows += [tuple(r) for r in result(c, found).collect()]
        except Abort:
            raise
        except Exception as e:  # a broken check is a finding of the audit
            rows.append((c.id, c.name, "FAIL", 1, f"the check itself stopped with an error: {type(e).__name__}", ""))
        finally:
            if found is not None:
                found.unpersist()
    return spark.createDataFrame(rows, _ROW)


def failures(checks: list[Check]) -> DataFrame:
    """(id, offender): the complete lists."""
    return reduce(DataFrame.unionByName, [_offenders(c).select(F.lit(c.id).alias("id"), "offender") for c in checks])


def failed(results: DataFrame) -> int:
    return results.where("status = 'FAIL'").count()
