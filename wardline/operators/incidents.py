"""Incident records and timelines from a fixed playbook; one row per incident in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import constant_rows, iso_utc, lookup, string_array, utc_wall_clock


def _steps(playbook: Sequence[tuple]) -> Column:
    numbered = [(n, *step) for n, step in enumerate(playbook, start=1)]
    return constant_rows(["step_no", "minutes", "actor", "action", "evidence"], numbered)


def _after(minutes: Column) -> Column:
    return F.col("declared_at") + F.make_dt_interval(mins=minutes)


def declared(detections: DataFrame, *, title: str = reg.INCIDENT_TITLE,
             severity: str = reg.INCIDENT_SEVERITY,
             id_digits: int = reg.INCIDENT_ID_DIGITS) -> DataFrame:
    """One incident per detection: seq, incident_id, title, severity, declared_at (UTC).

    The id holds ``id_digits`` hexadecimal digits of a hash: 6 name a single incident, 16 a table
    of them.
    """
    utc = utc_wall_clock(F.col("ts"), detections.schema["ts"].dataType)
    ident = F.concat(F.lit("INC-"), F.substring(F.sha2(F.col("seq").cast("string"), 256), 1, id_digits))
    return detections.select("seq", ident.alias("incident_id"), F.lit(title).alias("title"),
                             F.lit(severity).alias("severity"), utc.alias("declared_at"))


def timeline_rows(incidents: DataFrame, playbook: Sequence[tuple] = reg.PLAYBOOK) -> DataFrame:
    """One row per incident and playbook step, in step order."""
    return (incidents.select("seq", "incident_id", "declared_at",
                             F.explode(_steps(playbook)).alias("s"))
            .select("seq", "incident_id", "s.step_no",
                    _after(F.col("s.minutes")).alias("at"),
                    "s.actor", "s.action", "s.evidence"))


def records(incidents: DataFrame, playbook: Sequence[tuple] = reg.PLAYBOOK) -> DataFrame:
    """The full record of each incident, timeline included.

    The timeline is built in the row from the playbook; nothing is exploded and regrouped.
    """
    timeline = F.transform(_steps(playbook), lambda s: F.struct(
        iso_utc(_after(s["minutes"])).alias("at"),
        s["actor"].alias("actor"), s["action"].alias("action"), s["evidence"].alias("evidence")))
    roles = F.create_map(*[F.lit(x) for pair in reg.INCIDENT_ROLES for x in pair])
    # a step of its own: next to a column renamed declared_at, the lambda would take that one
    with_timeline = incidents.withColumn("timeline", timeline)
    return with_timeline.select(
        "seq", F.col("incident_id").alias("id"), "title", "severity",
        F.coalesce(lookup(F.col("severity"), reg.SEVERITY_MEANING), F.lit(""))
        .alias("severity_meaning"),
        iso_utc(F.col("declared_at")).alias("declared_at"), roles.alias("roles"),
        F.lit(reg.INCIDENT_STATUS).alias("status"), "timeline",
        string_array(reg.INCIDENT_FOLLOW_UPS).alias("postmortem_actions"),
        string_array(reg.INCIDENT_EVIDENCE).alias("evidence_for"))
