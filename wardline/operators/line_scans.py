"""The source scan over lines, for files that are too large to be one row.

Lines are judged where they are read, in the splits Spark makes of a file. Of a split only the lines that matter go on: those
with a finding, and those with a marker that decides about routes. All other lines of a split are one row with their number, so
the corpus is read once and neither its texts nor its lines are shuffled.

Two things depend on other splits: a line's number, and whether the walk forward from a route
meets an auth decorator before a function. Both are prefix scans in two steps, first inside a
split, then over the splits of a file, each of which is one row there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import element_rows, empty_array, fold_out, strip
from wardline.functions.patterns import LINE_BREAK
from wardline.operators.scans import FINDING, line_findings, line_marker
from wardline.session import written

PLACE = ["path", "block"]
_MARK = "struct<sub:int,route:boolean,mark:int,snippet:string>"
_FUNCTION, _AUTH = 0, 1


def _marks(lines: Column) -> Column:
    """The lines with a marker; ``mark`` tells whether one decides about the routes before it."""
    def mark(line: Column, index: Column) -> Column:
        m = line_marker(line, index)
        decides = F.when(m["function"], F.lit(_FUNCTION)).when(m["auth"], F.lit(_AUTH))
        snippet = F.when(m["route"], F.substring(strip(line), 1, reg.SCAN_SNIPPET_LENGTH))
        return F.struct(index.alias("sub"), m["route"].alias("route"), decides.alias("mark"), snippet.alias("snippet"))

    marked = F.transform(lines, mark).cast(f"array<{_MARK}>")
    return F.filter(marked, lambda m: m["route"] | m["mark"].isNotNull())


def marked_lines(lines: DataFrame) -> DataFrame:
    """The lines that matter, and one row for all others of a split: path, block, at, n, found, marks, first, rows.

    A line of ``read_source_lines`` may hold ``n`` lines, as there are more line breaks than those that files
    are read by. The aggregate has no large state: a line that matters is a group of its own.
    """
    parts = F.split("line", LINE_BREAK, -1)
    judged = lines.withColumn("_parts", parts).select(
        *PLACE, "at", F.size("_parts").alias("n"), line_findings(F.col("_parts")).alias("found"),
        _marks(F.col("_parts")).alias("marks"))
    matters = (F.size("found") > 0) | (F.size("marks") > 0) | (F.col("n") > 1)
    return judged.withColumn("own", F.when(matters, F.col("at"))).groupBy(
        *PLACE, F.col("own"), "n", "found", "marks").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")).withColumnRenamed("own", "at")


def _deciding(marks: Column) -> Column:
    """The first mark of a row that decides, or NULL."""
    return F.try_element_at(F.filter(marks, lambda m: m["mark"].isNotNull()), F.lit(1))["mark"]


def _blocks(marked: DataFrame) -> DataFrame:
    """One row per split: where its lines and findings begin in the file, and what the lines after it decide."""
    decides = _deciding(F.col("marks"))
    sums = marked.groupBy(*PLACE).agg(
        F.min("first").alias("first"), F.sum(F.col("rows") * F.col("n")).alias("lines"),
        F.sum(F.size("found") * F.col("rows")).alias("findings"),
        F.min_by(decides, F.when(decides.isNotNull(), F.col("at"))).alias("mark"))
    forward = Window.partitionBy("path").orderBy("block")
    earlier = forward.rowsBetween(Window.unboundedPreceding, -1)
    backward = Window.partitionBy("path").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    return sums.select(
        *PLACE, "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("line_start"),
        F.coalesce(F.sum("findings").over(earlier), F.lit(0)).alias("finding_start"),
        F.sum("findings").over(whole).alias("finding_total"),
        F.last("mark", ignorenulls=True).over(backward).alias("after"))


def _open_routes(marks: Column, covered: Column) -> Column:
    """Findings of one row's routes; ``covered`` tells what the lines after the row decide."""
    rule, severity, message = reg.OPEN_ROUTE_RULE

    def step(covered: Column, m: Column) -> tuple[Column, Column]:
        covered = F.when(m["mark"].isNotNull(), m["mark"] == _AUTH).otherwise(covered)
        finding = F.array(F.struct(F.lit(rule), F.lit(severity), m["sub"] + 1, m["snippet"], F.lit(message)))
        return covered, F.when(m["route"] & ~covered, finding.cast(f"array<{FINDING}>")).otherwise(empty_array(FINDING))

    return F.reverse(fold_out(F.reverse(marks), covered, "boolean", step, FINDING))


def finding_rows(lines: DataFrame) -> DataFrame:
    """path, ordinal, rule, severity, line, snippet, message: the rows of ``scans.finding_rows``, from lines.

    A file's findings are its line findings, then its open routes. Neither a file nor a split is ever one row; a task
    of the scans holds one split's lines that matter, or one row for each split of a file.
    """
    marked = written(marked_lines(lines), "marked-lines")
    inside = Window.partitionBy(*PLACE).orderBy("at")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*PLACE).orderBy(F.col("at").desc()).rowsBetween(Window.unboundedPreceding, -1)

    def before(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(earlier), F.lit(0))

    own = marked.filter("at IS NOT NULL").drop("first", "rows").withColumns({
        "more": before(F.col("n") - 1), "found_before": before(F.size("found")),
        "next": F.last(_deciding(F.col("marks")), ignorenulls=True).over(later)})
    placed = own.join(_blocks(marked), PLACE).select(
        *PLACE, "at", "found", "finding_total",
        (F.col("line_start") + F.col("at") - F.col("first") + F.col("more")).alias("line_start"),
        (F.col("finding_start") + F.col("found_before")).alias("ordinal"),
        _open_routes(F.col("marks"), F.coalesce(F.coalesce("next", "after") == _AUTH, F.lit(False))).alias("routes"))
    placed = written(placed.filter((F.size("found") > 0) | (F.size("routes") > 0)), "placed-lines")

    routes = placed.filter(F.size("routes") > 0)
    of_block = routes.groupBy(*PLACE).agg(F.sum(F.size("routes")).alias("n"))
    blocks_before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = of_block.select(*PLACE, F.coalesce(F.sum("n").over(blocks_before), F.lit(0)).alias("route_start"))
    numbered = routes.withColumn("ordinal", F.col("finding_total") + before(F.size("routes"))).join(starts, PLACE)
    return _exploded(placed, "found").unionByName(
        _exploded(numbered.withColumn("ordinal", F.col("ordinal") + F.col("route_start")), "routes"))


def _exploded(rows: DataFrame, column: str) -> DataFrame:
    one = element_rows(rows, ["path", "ordinal", "line_start"], F.col(column), "f", "_nth")
    return one.select(
        "path", (F.col("ordinal") + F.col("_nth")).cast("int").alias("ordinal"), "f.rule", "f.severity",
        (F.col("line_start") + F.col("f.line")).cast("int").alias("line"), "f.snippet", "f.message")


def summaries(found: DataFrame, files: DataFrame) -> DataFrame:
    """Zero-filled severity totals of every path in ``files``, from the rows of ``finding_rows``."""
    def count(severity: str) -> Column:
        return F.count_if(F.col("severity") == severity).alias(severity)

    names = ["high", "medium", "low", "total"]
    counted = found.groupBy("path").agg(*map(count, names[:3]), F.count(F.lit(1)).alias("total"))
    return files.select("path").join(counted, "path", "left").select(
        "path", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in names])
