"""What plans must not do, whatever the size of the tables."""

import re

import pytest

from tagloom.operators import dedup
from tagloom.plans.fixtures import boxes
from tagloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def conditions(df):
    """The conditions of the plan's joins."""
    told = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"^Join condition: (.*)$", told, re.M)


@pytest.mark.parametrize("name", ["nearest_segment", "hub_edges", "symbol_edges", "line_reach"])
def test_distances_are_not_in_join_conditions(spark, name):
    """A join's condition doesn't share subexpressions: with a distance in it the compiled method is too large for the JVM's compiler."""
    found = conditions(QUERIES[name](spark, SF))
    assert found and not any("SQRT" in c for c in found)


def test_rules_of_duplicates_are_not_in_join_conditions(spark):
    found = conditions(dedup.duplicate_pairs(boxes(spark, SF)))
    assert found and not any("SQRT" in c for c in found)


def test_boxes_are_dealt_by_the_rows_of_their_table(spark, monkeypatch):
    """6,000 rows at 1,000 a part: a task's rows don't grow with the table."""
    monkeypatch.setattr("tagloom.plans.fixtures.ROWS", 1000)
    assert boxes(spark, SF).rdd.getNumPartitions() == 6


def test_tile_duplicates_meet_once_and_unsorted(spark, monkeypatch):
    """Both rules read the pairs that one join wrote; who comes first is told by the pair's own confidences, not by a drawing's sort."""
    seen, real = {}, dedup.staged
    monkeypatch.setattr(dedup, "staged", lambda df, label="t": (seen.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString()), real(df, label))[1])
    assert dedup.tile_duplicates(boxes(spark, SF)).count() > 0
    assert "Window" not in seen["pairs"]
