"""Account configuration compliance and register integrity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import constant_rows

RULE_COLUMNS = ["rule", "severity", "state_key", "remediation"]


def evaluated(accounts: DataFrame, rules: Sequence[tuple] = reg.CONFIG_RULES) -> DataFrame:
    """Every account against every rule. A true flag is drift, a missing one is not.

    The rules are a literal array exploded next to the account: no join, no shuffle.
    """
    flag = F.coalesce(F.try_element_at("account_state", F.col("r.state_key")), F.lit(False))
    return (accounts.select("account_id", "account_state",
                            F.explode(constant_rows(RULE_COLUMNS, rules)).alias("r"))
            .select("account_id", "r.rule",
                    F.when(flag, F.lit("NON_COMPLIANT")).otherwise(F.lit("COMPLIANT"))
                    .alias("status"), "r.severity", "r.remediation"))


def noncompliant(accounts: DataFrame, rules: Sequence[tuple] = reg.CONFIG_RULES) -> DataFrame:
    return evaluated(accounts, rules).filter(F.col("status") == "NON_COMPLIANT")


def unknown_threat_policies(policies: DataFrame, threat_ids: Sequence[str]) -> DataFrame:
    """Guardrail policies that claim to prevent a threat nobody registered."""
    return policies.filter(~F.coalesce(F.col("prevents").isin(*threat_ids), F.lit(False)))


def repeated_state_keys(rules: DataFrame, scope: str = "account_id") -> DataFrame:
    """State keys used by more than one rule of the same scope."""
    return (rules.groupBy(scope, "state_key").agg(F.count(F.lit(1)).alias("uses"))
            .filter(F.col("uses") > 1))
