"""Threat and control registers: coverage, gaps, integrity, evidence map.

Registers are kept per organisation (``org_id``), one row per threat or control.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import element_rows, named, percent
from wardline.functions.lookups import lookup_join
from wardline.functions.ranking import with_position
from wardline.session import written


def threat_coverage(threats: DataFrame) -> DataFrame:
    """Totals by status and by STRIDE class, zero-filled, from one aggregation."""
    def count(column: str, value: str, prefix: str) -> Column:
        return F.count_if(F.col(column) == value).alias(f"{prefix}_{value.lower()}")

    counts = threats.groupBy("org_id").agg(
        F.count(F.lit(1)).alias("total"),
        *[count("status", s, "status") for s in reg.THREAT_STATUSES],
        *[count("stride", c, "stride") for c in reg.STRIDE_CLASSES])
    return counts.withColumn("mitigated_pct", percent(F.col("status_mitigated"), F.col("total")))


def coverage_rows(threats: DataFrame, register: DataFrame) -> DataFrame:
    """org_id, dimension, value, n: how many threats of an organisation have each value of a register.

    ``register`` (dimension, value) lists the statuses and classes of any number; dimensions are ``status`` and ``stride``. All counts
    come from one pass (grouping sets), and what an organisation does not have is zero. An organisation's rows are numbered, and the
    register joined by number, so it is neither collected nor broadcast for that. Values the register does not list are left out.
    """
    sets = [["org_id", "status"], ["org_id", "stride"], ["org_id"]]
    counts = written(threats.groupingSets(sets, "org_id", "status", "stride").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_set")), "coverage")
    # grouping_id tells which of the last two columns a row is not about
    kind = F.when(F.col("_set") == 1, F.lit("status")).when(F.col("_set") == 2, F.lit("stride"))
    found = counts.select("org_id", kind.alias("dimension"), F.when(F.col("_set") == 1, F.col("status")).otherwise(
        F.col("stride")).alias("value"), "n").filter("dimension IS NOT NULL AND value IS NOT NULL")
    listed = register.select("dimension", "value").distinct().withColumn("_seq", F.xxhash64("dimension", "value"))
    numbered = with_position(listed, [], seq="_seq", name="_place").drop("_seq")
    size = numbered.count()
    places = F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(size).cast("bigint")) if size else F.array().cast("array<bigint>"))
    wanted = counts.filter(F.col("_set") == 3).select("org_id", places.alias("_place")).join(numbered, "_place").drop("_place")
    return wanted.join(found, ["org_id", "dimension", "value"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def unknown_references(rows: DataFrame, register: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` whose ``column`` names nothing in ``register``'s column ``name``, or nothing at all: an anti-join."""
    known = register.select(F.col(name).alias(column)).dropna().distinct().withColumn("_known", F.lit(True))
    return lookup_join(rows, known, [column], spread_by=rows.columns[0]).filter("_known IS NULL").select(
        *map(named, rows.columns))


def open_gaps(threats: DataFrame) -> DataFrame:
    return threats.filter(F.col("status") != "mitigated")


def unknown_controls(threats: DataFrame,
                     known: Sequence[str] = reg.KNOWN_CONTROLS) -> DataFrame:
    """Threats whose mitigation names a control that does not exist."""
    return threats.filter(~F.coalesce(F.col("control").isin(*known), F.lit(False)))


def missing_stride_classes(threats: DataFrame,
                           classes: Sequence[str] = reg.STRIDE_CLASSES) -> DataFrame:
    """STRIDE classes an organisation has no threat for.

    The classes an organisation uses are at most the fixed few asked for, so the set
    per organisation is bounded and the difference is taken in the row.
    """
    wanted = F.array(*[F.lit(c) for c in classes])
    valid = F.when(F.col("stride").isin(*classes), F.col("stride"))
    return (threats.groupBy("org_id").agg(F.collect_set(valid).alias("used"))
            .select("org_id", F.explode(F.array_except(wanted, "used")).alias("stride")))


def violations(threats: DataFrame) -> DataFrame:
    """Rows breaking the register's rules, as (org_id, threat_id, violation)."""
    def broken(condition: Column, name: str) -> Column:
        return F.when(condition, F.lit(name))

    checks = F.array_compact(F.array(
        broken(~F.coalesce(F.col("stride").isin(*reg.STRIDE_CLASSES), F.lit(False)),
               "invalid stride"),
        broken(~F.coalesce(F.col("status").isin(*reg.THREAT_STATUSES), F.lit(False)),
               "invalid status"),
        broken(F.coalesce(F.trim("mitigation"), F.lit("")) == "", "blank mitigation"),
        broken(F.coalesce(F.trim("description"), F.lit("")) == "", "blank description")))
    # an id that repeats is reported once, with any one of its rows
    same = Window.partitionBy("org_id", "threat_id").orderBy(F.lit(1))
    rows = threats.withColumn("_n", F.row_number().over(same)).withColumn(
        "_next", F.lead(F.lit(1)).over(same))
    repeated = F.when((F.col("_n") > 1) & F.col("_next").isNull(), F.lit("duplicate id"))
    return element_rows(rows, ["org_id", "threat_id"],
                        F.array_compact(F.concat(checks, F.array(repeated))), "violation")


def control_coverage(controls: DataFrame) -> DataFrame:
    counts = controls.groupBy("org_id").agg(
        F.count(F.lit(1)).alias("controls"), F.count_if("automated").alias("automated"))
    return counts.withColumns({
        "manual": F.col("controls") - F.col("automated"),
        "automation_pct": percent(F.col("automated"), F.col("controls"))})


def evidence_map(controls: DataFrame) -> DataFrame:
    return controls.select("org_id", "control_id", "name", "owner", "system", "evidence",
                           "cadence", "automated")
