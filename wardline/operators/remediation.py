"""Pentest remediation: deadlines by severity, what is overdue, what to do next."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.asof import as_of_join
from wardline.functions.exprs import lookup
from wardline.functions.ranking import with_position


def sla_due(sla_days: Mapping[str, int] = reg.SLA_DAYS) -> Column:
    """Due date; NULL for a severity without a deadline."""
    return F.date_add("discovered", lookup(F.col("severity"), sla_days))


def with_due_dates_as_of(findings: DataFrame, deadlines: DataFrame) -> DataFrame:
    """``sla_due`` by the days (severity, valid_from, days) that were in force when a finding was discovered."""
    found = as_of_join(findings, deadlines.select("severity", "valid_from", "days"), key="severity", at="discovered",
                       valid_from="valid_from")
    return found.withColumn("sla_due", F.date_add("discovered", F.col("days"))).drop("days")


def is_open() -> Column:
    return F.col("status").isin(*reg.OPEN_STATES)


def has_unknown_status() -> Column:
    """Neither open nor closed: a status that is missing or that nobody knows."""
    return ~F.coalesce(F.col("status").isin(*reg.OPEN_STATES, *reg.CLOSED_STATES), F.lit(False))


def is_unsettled() -> Column:
    """Open, or not known to be closed."""
    return F.coalesce(is_open(), F.lit(False)) | has_unknown_status()


def is_overdue(today: dt.date) -> Column:
    """Unsettled work past its deadline; the due day itself is still on time."""
    return F.coalesce(is_unsettled() & (F.lit(today) > sla_due()), F.lit(False))


def days_left(today: dt.date) -> Column:
    return F.datediff(sla_due(), F.lit(today))


def tracked(findings: DataFrame, today: dt.date) -> DataFrame:
    return findings.withColumns({"sla_due": sla_due(), "overdue": is_overdue(today),
                                 "days_left": days_left(today)})


def summary(findings: DataFrame, today: dt.date) -> DataFrame:
    """One row of totals from one pass; 100 percent on time when nothing is unsettled.

    Open work of a severity without a deadline is ``unrated_open`` and not on time. Work of an unknown status is
    ``unknown_status``, which is not on time either.
    """
    def count(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    counts = findings.agg(
        F.count(F.lit(1)).alias("total"),
        *[count(F.col("severity") == s, s) for s in reg.SLA_DAYS],
        count(is_open(), "open"), count(is_overdue(today), "overdue"),
        count(is_open() & sla_due().isNull(), "unrated_open"),
        count(F.col("status").isin(*reg.CLOSED_STATES), "closed"), count(has_unknown_status(), "unknown_status"),
        count(is_open() & ~is_overdue(today) & sla_due().isNotNull(), "_on_time"),
        count(is_open() & (F.col("owner") == reg.UNASSIGNED), "unassigned_open"))
    # the product comes before the quotient here: 100 * part / total
    on_time = F.bround(F.try_divide(
        (F.lit(100) * F.col("_on_time")).cast("double"),
        (F.col("open") + F.col("unknown_status")).cast("double")), 0).cast("int")
    return counts.withColumn("on_time_pct", F.coalesce(on_time, F.lit(100))).drop("_on_time")


def worklist(findings: DataFrame, today: dt.date) -> DataFrame:
    """Unsettled findings sorted: overdue first, then fewest days left, input order kept."""
    return tracked(findings.filter(is_unsettled()), today).orderBy(
        F.col("overdue").desc(), F.col("days_left"), F.col("seq"))


def ranked_worklist(findings: DataFrame, today: dt.date) -> DataFrame:
    leading = [("late", (~is_overdue(today)).cast("int")), ("left", days_left(today))]
    ranked = with_position(findings.filter(is_unsettled()), leading)
    return tracked(ranked, today)

