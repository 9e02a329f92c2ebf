"""Every registered query gives the rows of its SQL, by a plan fit for large tables."""

import pytest

import __spark_entry__ as entry
from anteframe.plans import cohort
from catalog import QUERIES, pipelines
from catalog.registry import Tables
from parity import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan
    assert difference(df.toPandas(), con.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "anchor_ts", "click", "error", "signup", "view"]
    assert df.count() > 0


def exchanged(df):
    """The lines of a plan that say what an exchange carries."""
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.treeString()
    return [line for line in text.splitlines() if "Exchange" in line], text


def test_report_texts_are_not_shuffled(spark):
    df = QUERIES["unique_reports"](spark, FOLDER)
    df.collect()
    lines, text = exchanged(df)
    assert lines and "CONTENT#" in text
    for line, below in zip(text.splitlines(), text.splitlines()[1:]):
        if "Exchange" in line and "hashpartitioning" in line:
            assert "CONTENT#" not in line and "CONTENT#" not in below


def test_unknown_cases_are_left_out_before_anything_is_shuffled(spark):
    """A filter at each of the five sources, made once; no join of the cases with the labs."""
    text = QUERIES["lab_features"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    lines = [(len(line) - len(line.lstrip(" :+-")), line) for line in text.splitlines()]
    assert "LeftSemi" not in text
    # What a filter reads itself: its last child. The others are what it is compared with.
    found = set()
    for i, (depth, line) in enumerate(lines):
        if "Filter" in line and "scalar-subquery" in line:
            end = next((n for n in range(i + 1, len(lines)) if lines[n][0] <= depth), len(lines))
            first = min(d for d, _ in lines[i + 1 : end])
            last = max(n for n in range(i + 1, end) if lines[n][0] == first)
            assert not any("Aggregate" in below or "Join" in below for _, below in lines[last:end])
            found.add(lines[last][1].strip(" :+-")[:40])
    assert len(found) >= 5
    # The facts are read by five sources; the cases by the anchors and, once, by the filter.
    plan = final_plan(QUERIES["lab_features"](spark, FOLDER))
    assert plan.count("ReusedSubquery") + plan.count("ReusedExchange") >= 5


def final_plan(df):
    """The plan as it ran, subqueries included, without the plans it started from."""
    df.collect()
    kept, inner = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if inner is None and "== Initial Plan ==" in line:
            inner = depth
        elif inner is None or depth < inner:
            kept.append(line)
            inner = None
    return "\n".join(kept)


def test_facts_are_scanned_once(spark):
    """Both uses of the merged facts are one exchange; the other scans are the anchors."""
    for name, column in (("asof_latest_features", "value#"), ("lookback_join_counts", "NOT (event_type")):
        plan = final_plan(QUERIES[name](spark, FOLDER))
        scans = [line for line in plan.splitlines() if "FileScan" in line and column in line]
        assert len(scans) <= 1 and "ReusedExchange" in plan


def test_histogram_reads_its_input_once(spark):
    plan = final_plan(QUERIES["delay_histogram"](spark, FOLDER))
    assert sum("FileScan" in line and "l_orderkey" in line for line in plan.splitlines()) == 1


def test_reports_are_parsed_once(spark):
    """The head's pattern is met in one pass; all others fetch by a checksum."""
    plan = final_plan(QUERIES["cohort_for_labelling"](spark, FOLDER))
    assert plan.count("ReusedExchange") >= 2 and "Window" not in plan


def test_checksums_of_reports_travel_as_bytes(spark):
    # As hexadecimal text each took 64 bytes in every shuffle of the choice.
    reports = pipelines.report_source(Tables(spark, FOLDER))
    choice = cohort.report_choice(reports).select(cohort.ROW_SUM).toArrow().column(0)
    assert set(map(len, choice.to_pylist())) == {16}
    assert len(set(choice.to_pylist())) == len(choice)
