"""Connector authorization: registry, least-privilege grants, risk and novelty flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import filled, lookup, string_array
from wardline.functions.lookups import ROWS_PER_TASK, first_per_key, lookup_join
from wardline.functions.text import short_hash_token

PAIR = ["principal", "connector"]


def known_connector(connectors: Mapping[str, Sequence[str]] = reg.CONNECTOR_SCOPES) -> Column:
    return F.coalesce(F.col("connector").isin(*connectors), F.lit(False))


def valid_scope(connectors: Mapping[str, Sequence[str]] = reg.CONNECTOR_SCOPES) -> Column:
    allowed = {f"{c} {s}": True for c, scopes in connectors.items() for s in scopes}
    key = F.concat_ws(" ", "connector", "action")
    return F.coalesce(lookup(key, allowed), F.lit(False))


def registry_error(connectors: Mapping[str, Sequence[str]] = reg.CONNECTOR_SCOPES) -> Column:
    """Reason the request fails before any grant is looked at, or NULL; what is missing fails."""
    return (F.when(~known_connector(connectors),
                   filled(reg.UNKNOWN_CONNECTOR_REASON, connector=named("connector")))
            .when(~valid_scope(connectors), filled(
                reg.INVALID_SCOPE_REASON, action=named("action"), connector=F.col("connector"))))


def named(column: str) -> Column:
    return F.coalesce(column, F.lit(reg.NOT_GIVEN))


def first_grants(grants: DataFrame) -> DataFrame:
    """First grant of each (principal, connector); later ones are not added to it."""
    return first_per_key(grants.select(*PAIR, "seq", "scopes"), PAIR).select(*PAIR, "scopes")


def is_high_risk(actions: Sequence[tuple[str, str]] = reg.HIGH_RISK_ACTIONS) -> Column:
    listed = {f"{c} {a}": True for c, a in actions}
    return F.coalesce(lookup(F.concat_ws(" ", "connector", "action"), listed), F.lit(False))


def authorized(requests: DataFrame, grants: DataFrame, history: DataFrame | None = None, *,
               rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Adds allowed, reason, audit_reason, high_risk and anomalous to each request.

    Grants and history share the key (principal, connector), so both are reduced to one
    row per pair first and the large side is joined once. Without a history nothing is
    anomalous. ``audit_reason`` names the principal by its token only.
    """
    facts = first_grants(grants).withColumn("seen", F.lit(False))
    if history is not None:
        pairs = history.select(*PAIR).distinct().select(
            *PAIR, F.lit(None).cast("array<string>").alias("scopes"), F.lit(True).alias("seen"))
        facts = facts.unionByName(pairs).groupBy(*PAIR).agg(
            F.max("scopes").alias("scopes"), F.bool_or("seen").alias("seen"))
    joined = lookup_join(requests, facts, PAIR, rows_per_task=rows_per_task)
    anomalous = F.lit(False) if history is None else ~F.coalesce("seen", F.lit(False))

    def reason(who: Column) -> Column:
        on = F.col("connector")
        return (F.when(registry_error().isNotNull(), registry_error())
                .when(F.col("scopes").isNull(), filled(
                    reg.NO_GRANT_REASON, who=who, connector=on))
                .when(~F.coalesce(F.array_contains("scopes", F.col("action")), F.lit(False)), filled(
                    reg.LACKS_SCOPE_REASON, who=who, action=F.col("action"), connector=on))
                .otherwise(F.lit(reg.GRANTED_REASON)))

    token = short_hash_token("tok_", named("principal"))
    return (joined.withColumns({
        "reason": reason(named("principal")), "audit_reason": reason(token),
        "high_risk": is_high_risk(), "anomalous": anomalous, "principal_token": token})
        .withColumn("allowed", F.col("reason") == reg.GRANTED_REASON)
        .drop("scopes", "seen"))


def audit_records(authorized_: DataFrame) -> DataFrame:
    """Audit table without the raw principal, also on denials."""
    return authorized_.select(
        "seq", "principal_token", "connector", "action",
        F.when(F.col("allowed"), F.lit("ALLOW")).otherwise(F.lit("DENY")).alias("decision"),
        F.col("audit_reason").alias("reason"), "high_risk", "anomalous",
        F.lit(reg.ACCESS_CONTROL).alias("control"),
        string_array(reg.ACCESS_EVIDENCE).alias("evidence_for"))


def first_accesses(accesses: DataFrame, history: DataFrame | None = None, *,
                   order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """The earliest access of every pair that history does not know.

    Reduced per pair before anything is joined, so hot pairs cost one row per partition.
    """
    rest = [c for c in accesses.columns if c not in PAIR]
    first = accesses.groupBy(*PAIR).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    if history is not None:
        first = first.join(history.select(*PAIR).distinct(), PAIR, "left_anti")
    return first.select(*[F.col(c) if c in PAIR else F.col(f"_first.{c}")
                          for c in accesses.columns])
