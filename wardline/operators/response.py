"""Automated response plans for threat detections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import element_rows, filled, string_array
from wardline.functions.lookups import lookup_join
from wardline.session import written

ACTION = "struct<action:string,target:string,destructive:boolean,reason:string>"


def with_defaults(detections: DataFrame) -> DataFrame:
    """Missing type, severity and resource get their defaults."""
    return detections.withColumns({
        "type": F.coalesce("type", F.lit("")),
        "severity": F.coalesce(F.col("severity").cast("double"), F.lit(0.0)),
        "resource": F.coalesce("resource", F.lit("unknown"))})


def matched_rule(rules: Sequence[tuple[str, Sequence[str]]] = reg.RESPONSE_RULES) -> Column:
    """1-based number of the first rule whose prefix fits, NULL for an unknown type."""
    chain = F
    for number, (prefix, _) in enumerate(rules, start=1):
        chain = chain.when(F.startswith(F.col("type"), F.lit(prefix)), F.lit(number))
    return chain


def rules_of_types(types: DataFrame, rules: DataFrame) -> DataFrame:
    """type, rule_no and actions of the first rule of each distinct ``type`` that has one.

    ``rules`` (rule_no, prefix, actions) may be very many: a type is cut to each length that prefixes have, and the
    pieces are joined to the prefixes by equality. Of several rules that fit the smallest number decides; a rule
    without a prefix fits nothing, one with an empty prefix everything.
    """
    first = written(rules.filter("prefix IS NOT NULL").groupBy("prefix").agg(
        F.min(F.struct("rule_no", "actions")).alias("rule")), "rules")
    # no more than the longest prefix has characters
    lengths = sorted(r.n for r in first.select(F.length("prefix").alias("n")).distinct().collect())
    if not lengths:
        return types.select("type", F.lit(None).cast("int").alias("rule_no"),
                            F.lit(None).cast("array<string>").alias("actions")).limit(0)
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("type"))
    pieces = types.select("type").distinct().select("type", F.explode(F.transform(
        fitting, lambda n: F.substring("type", F.lit(1), n))).alias("prefix"))
    return pieces.join(first, "prefix").groupBy("type").agg(F.min("rule").alias("rule")).select("type", "rule.*")


def with_rules(detections: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``rule_no`` and ``actions`` from a table of rules; NULL and empty for an unknown type."""
    known = rules_of_types(detections, rules)
    return lookup_join(detections, known, ["type"]).withColumn(
        "actions", F.coalesce("actions", F.array().cast("array<string>")))


def destructive_actions(rules: Sequence[tuple[str, Sequence[str]]] = reg.RESPONSE_RULES) -> Column:
    """Destructive actions the type warrants; empty when it is unknown."""
    chain = F
    for prefix, actions in rules:
        chain = chain.when(F.startswith(F.col("type"), F.lit(prefix)), string_array(actions))
    return chain.otherwise(F.array().cast("array<string>"))


def _action(name: Column, target: Column, destructive: bool, reason: Column) -> Column:
    return F.struct(name.alias("action"), target.alias("target"),
                    F.lit(destructive).alias("destructive"), reason.alias("reason"))


def with_plan(detections: DataFrame, threshold: float = reg.DESTRUCTIVE_THRESHOLD, *,
              rules: DataFrame | None = None) -> DataFrame:
    """Adds the ordered ``plan``: destructive only for a known type at or above threshold.

    ``rules`` is a table as in ``rules_of_types`` in place of the fixed ones.
    """
    kind, target = F.col("type"), F.col("resource")
    acts = F.transform("_acts", lambda a: _action(a, target, True, filled(
        reg.DESTRUCTIVE_REASON, type=kind, severity=F.col("severity").cast("string"))))
    below = _action(F.lit("alert"), target, False,
                    filled(reg.BELOW_REASON, type=kind))
    unknown = _action(F.lit("alert"), target, False, filled(
        reg.UNKNOWN_TYPE_REASON, type=F.when(kind == "", F.lit("n/a")).otherwise(kind)))
    known = F.size("_acts") > 0
    first = (F.when(known & (F.col("severity") >= threshold), acts)
             .when(known, F.array(below)).otherwise(F.array(unknown)))
    always = F.array(
        _action(F.lit("open_incident"), target, False, F.lit(reg.INCIDENT_ACTION_REASON)),
        _action(F.lit("notify"), F.lit("security-oncall"), False, F.lit(reg.NOTIFY_REASON)))
    complete = with_defaults(detections)
    with_acts = (complete.withColumn("_acts", destructive_actions()) if rules is None
                 else with_rules(complete, rules).withColumnRenamed("actions", "_acts").drop("rule_no"))
    return (with_acts.withColumn("plan", F.concat(first.cast(f"array<{ACTION}>"),
                                         always.cast(f"array<{ACTION}>")))
            .drop("_acts"))


def plan_rows(detections: DataFrame, *, rules: DataFrame | None = None) -> DataFrame:
    return (element_rows(with_plan(detections, rules=rules), ["seq"], F.col("plan"), "a", "ordinal")
            .select("seq", "ordinal", "a.action", "a.target", "a.destructive", "a.reason"))


def took_destructive_action() -> Column:
    return F.exists("plan", lambda a: a["destructive"])

