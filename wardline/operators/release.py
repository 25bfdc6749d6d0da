"""Release gate: blocking findings, time-boxed exceptions, ship or block."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.lookups import ROWS_PER_TASK, lookup_join
from wardline.functions.ranking import with_position
from wardline.operators.findings import is_attack_path, risk_band, risk_score

SHIP, BLOCK = "SHIP", "BLOCK"


def candidates(findings: DataFrame) -> DataFrame:
    """A Critical band becomes critical, otherwise the vendor's label stays."""
    severity = (F.when(risk_band(risk_score()) == "Critical", F.lit("critical"))
                .otherwise(F.col("vendor_severity")))
    return findings.select("seq", "release_id", "id", severity.alias("severity"),
                           is_attack_path().alias("attack_path"))


def is_blocking() -> Column:
    return F.coalesce((F.col("severity") == "critical") | F.col("attack_path"), F.lit(False))


def valid_exceptions(exceptions: DataFrame, today: dt.date) -> DataFrame:
    """Ids with an exception that has not run out; the last day still counts."""
    return (exceptions.filter(F.col("expires") >= F.lit(today))
            .select("candidate_id").distinct())


def judged(candidates_: DataFrame, exceptions: DataFrame, today: dt.date, *,
           rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Blocking candidates with ``accepted``: is there a valid exception?

    One left lookup yields both the semi-join (accepted) and the anti-join (blockers).
    """
    waived = valid_exceptions(exceptions, today).select(
        F.col("candidate_id").alias("id"), F.lit(True).alias("accepted"))
    blocking = candidates_.filter(is_blocking())
    return (lookup_join(blocking, waived, ["id"], rows_per_task=rows_per_task)
            .withColumn("accepted", F.coalesce("accepted", F.lit(False))))


def gate(judged_: DataFrame, releases: DataFrame) -> DataFrame:
    """One decision per release; a release without blocking candidates ships.

    ``releases`` holds distinct release ids. Candidates are counted before the join,
    so a release with very many of them is no hot key.
    """
    counts = judged_.groupBy("release_id").agg(
        F.count_if(~F.col("accepted")).alias("n"), F.count_if("accepted").alias("m"))
    blockers = F.coalesce("n", F.lit(0).cast("bigint"))
    accepted = F.coalesce("m", F.lit(0).cast("bigint"))
    decision = F.when(blockers > 0, F.lit(BLOCK)).otherwise(F.lit(SHIP))
    return releases.join(counts, "release_id", "left").select(
        "release_id", decision.alias("decision"), blockers.alias("blockers"),
        accepted.alias("accepted"),
        F.concat(decision, F.lit(": "), blockers, F.lit(" open blocker(s), "), accepted,
                 F.lit(" accepted via time-boxed exception")).alias("summary"))


def gate_lists(judged_: DataFrame) -> DataFrame:
    """The ordered id lists behind each decision, as rows with a position.

    Rows instead of arrays: the list of one release may hold a large part of the table.
    """
    named = judged_.withColumn("list", F.when(F.col("accepted"), F.lit("accepted"))
                               .otherwise(F.lit("blockers")))
    ranked = with_position(named, [], within=["release_id", "list"])
    return ranked.select("release_id", "list", "position", F.col("id").alias("candidate_id"))
