"""Scanning files by lines in splits gives what scanning whole files gives."""

import random

import pytest

from wardline.operators import line_scans, scans
from wardline.sources import tables

KEY = "AKIA" + "IOSFODNN7EXAMPLE"
LINES = ["@app.route('/a')", "@require_auth", "@login_required", "def f():", "    def inner():", "  return 1", "", "x = 1",
         f"K = '{KEY}'", "password = 'notarealvalue'", "app.run(debug=True, host='0.0.0.0')", "  @app.route('/b')  # @require_auth",
         "é" * 30, "q = 'SELECT a FROM t' + x"]
BREAKS = ["\n"] * 12 + ["\r\n", "\r", "\x0b", " ", "\x1c", "\x85", "\n\n"]


@pytest.fixture
def split_bytes(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def limit(size):
        for name, value in zip(names, (size, 1, 1)):
            spark.conf.set(name, str(value))
    yield limit
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def corpus(folder, seed, files=6, longest=120):
    r = random.Random(seed)
    for i in range(files):
        text = "".join(r.choice(LINES) + r.choice(BREAKS) for _ in range(r.randint(0, longest)))
        (folder / f"f{i}.py").write_text(text[:-1] if i % 2 else text, newline="", encoding="utf-8")
    (folder / "empty.py").write_text("")
    return str(folder)


def rows(df):
    return sorted(tuple(r) for r in df.withColumn("path", line_scans.F.substring_index("path", "/", -1)).collect())


@pytest.mark.parametrize("size", [40, 97, 300, 1_000_000])
def test_splits_give_the_findings_of_whole_files(spark, tmp_path, split_bytes, size):
    folder = corpus(tmp_path, size)
    whole = tables.read_source_files(spark, folder)
    expected = rows(scans.finding_rows(whole)), rows(scans.summaries(whole))
    split_bytes(size)
    lines = tables.read_source_lines(spark, folder)
    if size < 1000:
        assert lines.select("path", "block").distinct().count() > 15
    found = line_scans.finding_rows(lines)
    assert rows(found) == expected[0] and len(expected[0]) > 100
    assert rows(line_scans.summaries(found, tables.list_source_files(spark, folder))) == expected[1]


@pytest.mark.parametrize("after, open_routes", [("@require_auth\ndef f():", 0), ("def f():\n@require_auth", 1), ("x = 1", 1)])
def test_a_border_inside_a_decorator_block(spark, tmp_path, split_bytes, after, open_routes):
    filler = "@decorator(number=1)\n" * 60
    (tmp_path / "a.py").write_text("import x\n@app.route('/a')\n" + filler + after + "\n" + filler)
    split_bytes(100)
    lines = tables.read_source_lines(spark, str(tmp_path))
    found = line_scans.finding_rows(lines)
    assert lines.select("block").distinct().count() > 20
    assert [(r.ordinal, r.line, r.rule) for r in found.collect()] == [(0, 2, "unauthenticated-endpoint")] * open_routes


def test_no_row_holds_a_file_and_lines_stay_in_their_task(spark, tmp_path, split_bytes):
    (tmp_path / "a.py").write_text("x = 1\n" * 50_000 + f"K = '{KEY}'\n")
    split_bytes(20_000)
    lines = tables.read_source_lines(spark, str(tmp_path))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "wholetext" not in plan and "Exchange" not in plan
    marked = line_scans.marked_lines(lines)
    assert marked.count() == lines.select("block").distinct().count() + 1
    assert [r.line for r in line_scans.finding_rows(lines).collect()] == [50_001]


def test_files_without_lines(spark, tmp_path):
    (tmp_path / "a.py").write_text("\n")
    (tmp_path / "b.py").write_text("")  # Spark's readers pass over it
    found = line_scans.finding_rows(tables.read_source_lines(spark, str(tmp_path)))
    assert found.count() == 0
    assert rows(line_scans.summaries(found, tables.list_source_files(spark, str(tmp_path)))) == [("a.py", 0, 0, 0, 0)]
