"""Finding triage: score by toxic combination, order, dedupe, queue, totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import compact, lookup
from wardline.functions.lookups import first_per_key
from wardline.functions.ranking import with_position


def risk_score(weights: Mapping[str, int] = reg.RISK_WEIGHTS) -> Column:
    return reduce(add, [F.when(F.col(f), F.lit(w)).otherwise(F.lit(0)) for f, w in weights.items()])


def factors(weights: Mapping[str, int] = reg.RISK_WEIGHTS) -> Column:
    return compact([F.when(F.col(f), F.lit(f)) for f in weights])


def is_attack_path(needed: Sequence[str] = reg.ATTACK_PATH_FACTORS) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(f), F.lit(False)) for f in needed])


def risk_band(score: Column, bands: Sequence[tuple[int, str]] = reg.RISK_BANDS) -> Column:
    chain = F.when(score >= bands[0][0], F.lit(bands[0][1]))
    for floor, name in bands[1:]:
        chain = chain.when(score >= floor, F.lit(name))
    return chain.otherwise(F.lit(reg.LOWEST_BAND))


def severity_rank(severity: Column) -> Column:
    return F.coalesce(lookup(severity, reg.SEVERITY_RANK), F.lit(reg.UNKNOWN_SEVERITY_RANK))


def scored(findings: DataFrame) -> DataFrame:
    """Adds risk_score, factors, attack_path and risk_band."""
    return (findings.withColumns({"risk_score": risk_score(), "factors": factors(),
                                  "attack_path": is_attack_path()})
            .withColumn("risk_band", risk_band(F.col("risk_score"))))


def vendor_view(findings: DataFrame) -> DataFrame:
    """Sorted by the vendor's label alone; unknown labels last, input order kept."""
    return findings.orderBy(severity_rank(F.col("vendor_severity")), "seq")


def risk_view(findings: DataFrame) -> DataFrame:
    """Sorted with attack paths first, then by score, input order kept."""
    return scored(findings).orderBy(
        F.col("attack_path").desc(), F.col("risk_score").desc(), F.col("seq"))


def vendor_ranked(findings: DataFrame) -> DataFrame:
    return with_position(findings, [("rank", severity_rank(F.col("vendor_severity")))])


def risk_ranked(findings: DataFrame) -> DataFrame:
    leading = [("path", (~is_attack_path()).cast("int")), ("score", -risk_score())]
    return with_position(findings, leading)


def deduped(findings: DataFrame) -> DataFrame:
    """First finding of each (title, resource)."""
    return first_per_key(findings, ["title", "resource"])


def top_queue(findings: DataFrame, k: int) -> DataFrame:
    """The ``k`` most urgent findings, numbered; an attack path outranks its band's name."""
    order = [F.col("attack_path").desc(), F.col("risk_score").desc(), F.col("seq")]
    keyed = findings.withColumns({"attack_path": is_attack_path(), "risk_score": risk_score()})
    # the window numbers k rows; what only the queue shows is computed for these alone
    return (keyed.orderBy(*order).limit(k)
            .withColumn("position", F.row_number().over(Window.orderBy(*order)))
            .withColumns({"factors": factors(), "risk_band": risk_band(F.col("risk_score"))})
            .withColumn("label", F.when(F.col("attack_path"), F.lit("ATTACK-PATH"))
                        .otherwise(F.col("risk_band"))))


def totals(findings: DataFrame) -> DataFrame:
    return findings.agg(
        F.count(F.lit(1)).alias("findings"), F.count_if(is_attack_path()).alias("attack_paths"),
        F.count_if(F.col("owner") == reg.UNASSIGNED).alias("unassigned"))
