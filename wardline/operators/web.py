"""HTTP response audit: protected routes, security headers, error leakage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import compact, element_rows, filled


def _finding(rule: str, severity: str, message: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
                    message.alias("message"))


def protected(routes: Sequence[str] = reg.PROTECTED_ROUTES) -> Column:
    return F.col("endpoint").isin(*routes)


def missing_authentication() -> Column:
    """A protected route answered an unauthenticated request."""
    refused = F.coalesce(F.col("status").isin(*reg.REFUSED_STATUS), F.lit(False))
    return F.when(~_authed() & ~refused, _finding("missing-authentication", "high", filled(
        reg.OPEN_ROUTE_MESSAGE,
        status=F.coalesce(F.col("status").cast("string"), F.lit("no status")))))


def _authed() -> Column:
    """A request that does not say so was made without credentials."""
    return F.coalesce("authed", F.lit(False))


def missing_headers(required: Sequence[str] = reg.REQUIRED_HEADERS) -> Column:
    """Required headers the response does not carry, in fixed order, names case-sensitive.

    A response without a header map lacks them all.
    """
    return compact([F.when(~F.coalesce(F.map_contains_key("headers", h), F.lit(False)), F.lit(h))
                    for h in required])


def missing_security_headers() -> Column:
    absent = missing_headers()
    return F.when(_authed() & (F.size(absent) > 0), _finding(
        "missing-security-headers", "medium",
        filled(reg.HEADERS_MESSAGE, headers=F.array_join(absent, ", "))))


def error_leakage() -> Column:
    leak = F.contains("body", F.lit(reg.LEAK_MARKERS[0]))
    for marker in reg.LEAK_MARKERS[1:]:
        leak = leak | F.contains("body", F.lit(marker))
    return F.when(_authed() & leak, _finding(
        "error-leakage", "high", F.lit(reg.LEAKAGE_MESSAGE)))


RULES = (missing_authentication, missing_security_headers, error_leakage)


def finding_rows(responses: DataFrame, rules: Sequence = RULES) -> DataFrame:
    """Findings of every response to a protected route; one scan for all rules."""
    found = compact([rule() for rule in rules])
    return (element_rows(responses.filter(protected()), ["seq", "endpoint"], found, "f")
            .select("seq", "f.rule", "f.severity", "endpoint", "f.message"))


def summary(responses: DataFrame) -> DataFrame:
    return finding_rows(responses).agg(
        *[F.count_if(F.col("severity") == s).alias(s) for s in ("high", "medium", "low")],
        F.count(F.lit(1)).alias("total"))
