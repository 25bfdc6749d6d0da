"""The linear search for source code against the pattern itself."""

import random
import time

from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions import text
from wardline.functions.patterns import jvm

PARTS = ["SELECT", "SELECT ", " FROM ", "FROM", " FROM", "\n", " ", "\n\n", "a", "def f(", "import x", "import ", "class C:", "\t", "\U0001f600",
         "SELECT a FROM b ", "x", "\r", "\u2028", "SELECTED ", "  "]


def test_the_first_match_is_that_of_the_pattern(spark):
    r = random.Random(5)
    rows = [("".join(r.choice(PARTS) for _ in range(r.randint(0, 14))),) for _ in range(6000)]
    rows += [("SELECT\nSELECT x FROM y ",), ("SELECT a\nSELECT\n b FROM c ",), ("\U0001f600 import SELECT a FROM b ",), (None,)]
    df = spark.createDataFrame(rows, "t string").repartition(4)
    plain = F.regexp_extract("t", jvm(reg.SOURCE_CODE_PATTERN), 0)
    got = df.select("t", plain.alias("a"), text.source_code_match(F.col("t")).alias("b"))
    assert got.filter("NOT (a <=> b) AND t IS NOT NULL").collect() == []
    assert got.filter("a LIKE 'SELECT%'").count() > 300


def test_many_selects_without_a_from_take_linear_time(spark):
    def seconds(n):
        line = "FROM x\n" + "SELECT a " * n + "\n FROMAGE"
        df = spark.createDataFrame([(line,)], "t string")
        started = time.perf_counter()
        assert df.select(text.source_code_match(F.col("t")).alias("m")).first().m == ""
        return time.perf_counter() - started

    seconds(100)
    assert seconds(64_000) < 5  # 16,000 took 16 s when each was tried
