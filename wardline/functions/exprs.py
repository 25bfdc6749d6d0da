"""Small building blocks: literals from constants, let-binding, rounding, time."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the characters str.strip() removes
PYTHON_WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def filled(template: str, **parts: Column) -> Column:
    """A fixed text with columns in the places that its braces name."""
    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        pieces += [F.lit(literal)] if literal else []
        pieces += [parts[name]] if name else []
    return F.concat(*pieces)


def named(column: str) -> Column:
    """A column by its whole name, whatever characters that holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Common subexpressions inside a lambda or a CASE branch are not shared by the
    code generator; a one-element ``transform`` shares them explicitly.
    """
    return F.transform(F.array(value), body)[0]


def compact(items: Sequence[Column]) -> Column:
    """Array of the non-null items, in order."""
    return F.array_compact(F.array(*items))


def string_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def empty_array(element: str) -> Column:
    return F.array().cast(f"array<{element}>")


def fold_out(items: Column, start: Column, carried: str, step, element: str) -> Column:
    """What ``step`` gives for each item, joined: ``step(carry, item)`` is (new carry, array).

    Appending to a growing array copies it each time. The items are folded in chunks of about
    the square root of their number, so an item is copied a few times only and the work
    hardly grows faster than the items.
    """
    state = f"struct<carry:{carried},out:array<{element}>>"
    outer = f"struct<carry:{carried},out:array<array<{element}>>>"

    def inside(acc: Column, item: Column) -> Column:
        carry, out = step(acc["carry"], item)
        return F.struct(carry.alias("carry"), F.concat(acc["out"], out).alias("out")).cast(state)

    def over(acc: Column, chunk: Column) -> Column:
        first = F.struct(acc["carry"].alias("carry"), empty_array(element).alias("out")).cast(state)
        return bind(F.aggregate(chunk, first, inside), lambda done: F.struct(
            done["carry"].alias("carry"),
            F.concat(acc["out"], F.array(done["out"])).alias("out")).cast(outer))

    def folded(all_items: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(all_items))).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.slice(
            all_items, i * width + 1, width))
        begin = F.struct(start.alias("carry"), empty_array(f"array<{element}>").alias("out")).cast(outer)
        result = F.flatten(F.aggregate(chunks, begin, over, lambda acc: acc["out"]))
        return F.when(F.size(all_items) > 0, result).otherwise(empty_array(element))

    return bind(items, folded)


def lookup(key: Column, table: Mapping[str, object]) -> Column:
    """Value of a fixed table for ``key``; NULL when the key is unknown or NULL."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.coalesce(key, F.lit("")))


def constant_rows(names: Sequence[str], rows: Sequence[Sequence[object]]) -> Column:
    """Literal ``array<struct<...>>`` of a fixed register, to be exploded next to a row."""
    return F.array(*[
        F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)])
        for row in rows
    ])


def element_rows(df: DataFrame, keep: Sequence[str], array: Column, name: str,
                 ordinal: str | None = None) -> DataFrame:
    """One row per array element, with its 0-based ordinal if a name for it is given.

    A plain ``explode`` makes the optimizer infer a filter on the array and push it below
    the projections that build it, so that an expensive array is computed several times.
    The outer form has no such filter; rows of empty arrays are dropped by position.
    """
    position = ordinal or "_position"
    rows = (df.select(*keep, F.posexplode_outer(array).alias(position, name))
            .filter(F.col(position).isNotNull()))
    return rows if ordinal else rows.drop(position)


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(PYTHON_WHITESPACE))


def lstrip(value: Column) -> Column:
    return F.ltrim(value, F.lit(PYTHON_WHITESPACE))


def percent(part: Column, total: Column) -> Column:
    """``part / total * 100`` rounded half-even to a whole number; NULL if total is 0."""
    ratio = F.try_divide(part.cast("double"), total.cast("double"))
    return F.bround(ratio * F.lit(100.0), 0).cast("int")


def utc_wall_clock(ts: Column, data_type: T.DataType) -> Column:
    """The UTC wall-clock reading of ``ts``, whatever the session time zone is.

    Parquet timestamps without a zone arrive as TIMESTAMP_NTZ and already hold UTC.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return ts
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def iso_utc(wall_clock: Column) -> Column:
    """ISO-8601 text of a UTC wall clock, microseconds only when present."""
    def padded(clock: Column) -> Column:
        whole = F.when(F.contains(clock, F.lit(".")), F.rpad(clock, 26, "0")).otherwise(clock)
        return F.concat(whole, F.lit("+00:00"))

    return bind(F.translate(wall_clock.cast("string"), " ", "T"), padded)
