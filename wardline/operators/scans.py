"""Source-corpus scan: line rules and routes without an auth decorator.

One row is one file; all its findings are computed in that row, so the corpus is read
once, nothing is shuffled and summaries need no regrouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import compact, element_rows, empty_array, fold_out, lstrip, strip
from wardline.functions.patterns import LINE_BREAK, jvm, literal, may_match

FINDING = "struct<rule:string,severity:string,line:int,snippet:string,message:string>"
_AUTH = "|".join(literal(m) for m in reg.AUTH_MARKERS)
_RULES = [(rule, severity, jvm(pattern, ignore_case), needs, message)
          for rule, severity, pattern, ignore_case, needs, message in reg.SCAN_RULES]


def source_lines(content: Column) -> Column:
    """Lines without their breaks; a final break does not open another line."""
    lines = F.split(content, LINE_BREAK, -1)
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)) \
        .otherwise(lines)


def _finding(rule: str, severity: str, line_no: Column, line: Column, message: str) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
        line_no.cast("int").alias("line"),
        F.substring(strip(line), 1, reg.SCAN_SNIPPET_LENGTH).alias("snippet"),
        F.lit(message).alias("message"))


def line_findings(lines: Column) -> Column:
    """At most one finding per rule and line, by line, then in rule order."""
    def of_line(line: Column, index: Column) -> Column:
        return compact([
            F.when(may_match(line, needs) & F.rlike(line, F.lit(pattern)),
                   _finding(rule, severity, index + 1, line, message))
            for rule, severity, pattern, needs, message in _RULES])

    return F.flatten(F.transform(lines, of_line)).cast(f"array<{FINDING}>")


def line_marker(line: Column, index: Column) -> Column:
    """What a line says about routes."""
    return F.struct(
        index.alias("at"), line.alias("line"),
        F.contains(line, F.lit(reg.ROUTE_MARKER)).alias("route"),
        F.rlike(line, F.lit(_AUTH)).alias("auth"),
        F.startswith(lstrip(line), F.lit(reg.FUNCTION_MARKER)).alias("function"))


def open_route_findings(lines: Column) -> Column:
    """Routes whose decorator block reaches the function without an auth decorator.

    Only lines that carry a marker matter. Walking them backwards, ``covered`` tells
    whether the walk forward from here meets an auth decorator before a function.
    """
    marked = F.filter(F.transform(lines, line_marker),
                      lambda m: m["route"] | m["auth"] | m["function"])
    rule, severity, message = reg.OPEN_ROUTE_RULE

    def step(covered: Column, m: Column) -> tuple[Column, Column]:
        covered = F.when(m["function"], F.lit(False)).when(m["auth"], F.lit(True)).otherwise(covered)
        finding = F.array(_finding(rule, severity, m["at"] + 1, m["line"], message))
        return covered, F.when(m["route"] & ~covered, finding.cast(f"array<{FINDING}>")).otherwise(
            empty_array(FINDING))

    return F.reverse(fold_out(F.reverse(marked), F.lit(False), "boolean", step, FINDING))


def with_findings(files: DataFrame) -> DataFrame:
    """Adds ``findings``: line findings first, then open routes."""
    split = files.withColumn("_lines", source_lines(F.col("content")))
    routes = F.when(F.contains("content", F.lit(reg.ROUTE_MARKER)),
                    open_route_findings(F.col("_lines"))).otherwise(empty_array(FINDING))
    return split.withColumn("findings", F.concat(line_findings(F.col("_lines")), routes)) \
        .drop("_lines")


def _rows(files: DataFrame, findings: Column) -> DataFrame:
    return (element_rows(files, ["path"], findings, "f", "ordinal")
            .select("path", "ordinal", "f.rule", "f.severity", "f.line", "f.snippet", "f.message"))


def line_finding_rows(files: DataFrame) -> DataFrame:
    return _rows(files, line_findings(source_lines(F.col("content"))))


def open_route_rows(files: DataFrame) -> DataFrame:
    return _rows(files, open_route_findings(source_lines(F.col("content"))))


def finding_rows(files: DataFrame) -> DataFrame:
    return _rows(with_findings(files), F.col("findings"))


def _count(severity: str | None) -> Column:
    if severity is None:
        return F.size("findings").cast("bigint")
    return F.size(F.filter("findings", lambda f: f["severity"] == severity)).cast("bigint")


def summaries(files: DataFrame) -> DataFrame:
    """Zero-filled severity totals of every file."""
    return with_findings(files).select(
        "path", _count("high").alias("high"), _count("medium").alias("medium"),
        _count("low").alias("low"), _count(None).alias("total"))


def gates(files: DataFrame) -> DataFrame:
    """A file fails when it has a high finding."""
    return with_findings(files).select(
        "path", (~F.exists("findings", lambda f: f["severity"] == "high")).alias("passed"))


def corpus_gate(files: DataFrame) -> DataFrame:
    """One row for the whole corpus: files, failing files and the verdict."""
    return gates(files).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(~F.col("passed")).alias("failed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"))
