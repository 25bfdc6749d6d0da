"""Checks at both ends of a model: injection attempts going in, leaks coming out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions import text
from wardline.functions.exprs import compact, element_rows, filled
from wardline.functions.patterns import jvm, may_match

_REVEAL = jvm(reg.REVEAL_PATTERN, True)
_TOOL_CALL = jvm(reg.TOOL_CALL_PATTERN, True)


def injection_findings(prompt: Column) -> Column:
    """One finding per rule that fires, in rule order, with its first match."""
    def findings(fold: Column) -> Column:
        rules = []
        for rule, severity, pattern, needs in reg.INJECTION_RULES:
            snippet = F.substring(F.regexp_extract(prompt, jvm(pattern, True), 0), 1,
                                  reg.INJECTION_SNIPPET_LENGTH)
            rules.append(F.struct(
                F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
                F.when(may_match(prompt, needs, fold), snippet).otherwise("")
                .alias("snippet")))
        return F.filter(F.array(*rules), lambda r: r["snippet"] != "")

    return text.with_fold(prompt, findings)


def injection_rows(turns: DataFrame) -> DataFrame:
    return (element_rows(turns, ["seq"], injection_findings(F.col("text")), "f", "ordinal")
            .select("seq", "ordinal", "f.rule", "f.severity", "f.snippet"))


def leaks_data(output: Column) -> Column:
    """A secret, a valid card number or an SSN is present.

    Equivalent to classifying the output, but stops at the first class that is found
    and never computes the positions, merges and other classes it does not need.
    """
    secret = text.with_fold(output, lambda fold: text.has_secret(output, fold))
    ssn = F.rlike(output, F.lit(jvm(reg.SSN_PATTERN)))
    card = F.exists(text.card_candidates(output), text.is_luhn_valid)
    return secret | ssn | card


def reveals_instructions(output: Column) -> Column:
    return text.with_fold(output, lambda fold: may_match(
        output, reg.REVEAL_NEEDS, fold) & F.rlike(output, F.lit(_REVEAL)))


def requested_tools(output: Column) -> Column:
    called = F.regexp_extract_all(output, F.lit(_TOOL_CALL), F.lit(1))
    return text.with_fold(output, lambda fold: F.when(
        may_match(output, reg.TOOL_CALL_NEEDS, fold), called)
        .otherwise(F.array().cast("array<string>")))


def unauthorized_tools(output: Column, allowed_tools: Sequence[str] | None) -> Column:
    """Every requested tool outside the list, once per request; NULL list = no check."""
    if allowed_tools is None:
        return F.array().cast("array<string>")
    allowed = F.array(*[F.lit(t) for t in allowed_tools]).cast("array<string>")
    return F.filter(requested_tools(output), lambda t: ~F.array_contains(allowed, t))


def output_reasons(output: Column, allowed_tools: Sequence[str] | None) -> Column:
    content = compact([
        F.when(leaks_data(output), F.lit(reg.LEAK_REASON)),
        F.when(reveals_instructions(output), F.lit(reg.REVEAL_REASON)),
    ])
    tools = F.transform(unauthorized_tools(output, allowed_tools), lambda t: filled(
        reg.TOOL_REASON, tool=t))
    return F.concat(content, tools)


def output_verdicts(outputs: DataFrame, allowed_tools: Sequence[str] | None = None, *,
                    column: str = "text") -> DataFrame:
    """Adds ``allowed`` and the ordered ``reasons`` (``["clean"]`` when there are none)."""
    return (outputs.withColumn("_found", output_reasons(F.col(column), allowed_tools))
            .withColumn("allowed", F.size("_found") == 0)
            .withColumn("reasons", F.when(F.col("allowed"), F.array(F.lit(reg.CLEAN_REASON)))
                        .otherwise(F.col("_found")))
            .drop("_found"))


def unauthorized_tool_rows(outputs: DataFrame, allowed_tools: Sequence[str]) -> DataFrame:
    return element_rows(outputs, ["seq"], unauthorized_tools(F.col("text"), allowed_tools),
                        "tool", "ordinal")
