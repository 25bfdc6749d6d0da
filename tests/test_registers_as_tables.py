"""Rules by prefix and versions by time, as tables, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from wardline.functions.asof import as_of_join
from wardline.operators import registers, response

SCHEMA = "rule_no int, prefix string, actions array<string>"


def test_the_first_rule_of_very_many_without_a_theta_join(spark):
    rules = spark.range(100_000).select(
        (F.col("id") + 10).cast("int").alias("rule_no"), F.concat(F.lit("T"), F.col("id") % 60_000).alias("prefix"),
        F.array(F.concat(F.lit("a"), F.col("id"))).alias("actions"))
    extra = spark.createDataFrame([(3, "T59", ["x"]), (2, None, ["y"]), (5, "Z", None)], SCHEMA)
    types = ["T5", "T599999", "T123", "T60000", "U1", "", "t5", "Z9", "T59"] + ["T777/hot"] * 500
    df = spark.createDataFrame(list(enumerate(types)), "seq long, type string")
    plan = response.rules_of_types(df, rules.union(extra))._jdf.queryExecution().optimizedPlan().toString()
    assert "startswith" not in plan.lower() and "Cross" not in plan
    got = {r.seq: (r.rule_no, r.actions) for r in response.with_rules(df, rules.union(extra)).collect()}
    by_prefix = {}
    for i in reversed(range(100_000)):
        by_prefix[f"T{i % 60_000}"] = (i + 10, [f"a{i}"])
    by_prefix |= {"T59": (3, ["x"]), "Z": (5, [])}
    for seq, kind in enumerate(types):
        fits = [by_prefix[kind[:n]] for n in range(len(kind) + 1) if kind[:n] in by_prefix]
        assert got[seq] == (min(fits) if fits else (None, []))


def test_no_rules_and_an_empty_prefix(spark):
    df = spark.createDataFrame([(1, "a"), (2, "")], "seq long, type string")
    none = spark.createDataFrame([], SCHEMA)
    assert {(r.rule_no, len(r.actions)) for r in response.with_rules(df, none).collect()} == {(None, 0)}
    every = spark.createDataFrame([(7, "", ["all"])], SCHEMA)
    assert {r.rule_no for r in response.with_rules(df, every).collect()} == {7}


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_the_version_in_force_whatever_the_key(spark, parts):
    """A third of all rows have one key, some of them at one time; versions may be in earlier parts only."""
    r = random.Random(parts)
    keys = ["hot"] * 5 + [f"k{i}" for i in range(8)] + [None, "unlisted"]
    rows = [(i, r.choice(keys), r.choice([None, 500, *range(0, 1000, 7)]), "x") for i in range(1500)]
    versions = [(k, t, f"{k}@{t}", t % 3 == 0) for k in ["hot"] + [f"k{i}" for i in range(6)] for t in r.sample(range(900), 4)]
    versions += [("hot", 2, "hot@2", True), ("k0", None, "never", True), (None, 1, "never", True), ("k1", 500, "k1@500", None),
                 ("k1", 500, "k0@500", True)]
    left = spark.createDataFrame(rows, "seq long, tool string, at int, name string").repartition(5)
    right = spark.createDataFrame(versions, "tool string, since long, label string, ok boolean")
    got = as_of_join(left, right, key="tool", at="at", valid_from="since", parts=parts)
    assert got.columns == ["seq", "tool", "at", "name", "label", "ok"]
    for row in got.collect():
        known = [v for v in versions if None not in (v[0], v[1], row.at) and v[0] == row.tool and v[1] <= row.at]
        best = max(known, key=lambda v: (v[1], v[2], v[3] is not None, v[3]), default=(None,) * 4)
        assert (row.label, row.ok) == best[2:]
    assert got.count() == 1500


def test_empty_tables(spark):
    left = spark.createDataFrame([(1, "a", 5)], "seq long, tool string, at int")
    right = spark.createDataFrame([], "tool string, since int, label string")
    assert [tuple(r) for r in as_of_join(left, right, key="tool", at="at", valid_from="since").collect()] == [(1, "a", 5, None)]
    assert as_of_join(left.limit(0), right, key="tool", at="at", valid_from="since").count() == 0


def test_coverage_by_a_register_counts_in_one_pass_and_fills_with_zero(spark):
    threats = spark.createDataFrame([("o1", "mitigated", "S"), ("o1", "mitigated", "T"), ("o1", None, "S"), ("o2", "odd", None)],
                                    "org_id string, status string, stride string")
    register = spark.createDataFrame([("status", "mitigated"), ("status", "partial"), ("stride", "S"), ("stride", "S"), ("stride", "E")],
                                     "dimension string, value string")
    got = {(r.org_id, r.dimension, r.value): r.n for r in registers.coverage_rows(threats, register).collect()}
    assert got == {("o1", "status", "mitigated"): 2, ("o1", "status", "partial"): 0, ("o1", "stride", "S"): 2, ("o1", "stride", "E"): 0,
                   ("o2", "status", "mitigated"): 0, ("o2", "status", "partial"): 0, ("o2", "stride", "S"): 0, ("o2", "stride", "E"): 0}
    assert registers.coverage_rows(threats, register.limit(0)).count() == 0
    assert registers.coverage_rows(threats.limit(0), register).count() == 0


def test_references_that_no_register_holds(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "seq long, control string")
    register = spark.createDataFrame([("a",), ("a",), (None,)], "name string")
    assert sorted(r.seq for r in registers.unknown_references(rows, register, "control", "name").collect()) == [2, 3]
