"""Each check kind both passes and fails."""

from __future__ import annotations

import pytest

from clickmart.operators import checks as C
from clickmart.plans import quality


@pytest.fixture(scope="module")
def tables(spark):
    ok = spark.createDataFrame(
        [("a", 1, "Champion", 5), ("b", 2, "Lost", 10)], "k string, n long, tier string, score long"
    )
    bad = spark.createDataFrame(
        [("a", 1, "Champion", 5), ("a", 2, "Boss", 20), (None, None, None, None), (None, 0, "Boss", 1)],
        "k string, n long, tier string, score long",
    )
    return ok, bad


CASES = [
    (C.Check(C.NOT_NULL, "t", ("k",)), 0, 2),
    (C.Check(C.UNIQUE, "t", ("k",)), 0, 1),  # NULL keys ignored
    (C.Check(C.ACCEPTED_VALUES, "t", ("tier",), ("Champion", "Lost")), 0, 1),  # NULL passes
    (C.Check(C.EXPRESSION_IS_TRUE, "t", ("score",), "between 3 and 15"), 0, 2),  # NULL passes
    (C.Check(C.UNIQUE_COMBINATION, "t", ("k", "tier")), 0, 0),
    (C.Check(C.UNIQUE_COMBINATION, "t", ("k",)), 0, 2),
]


@pytest.mark.parametrize("check, ok_failures, bad_failures", CASES)
def test_check_kinds(spark, tables, check, ok_failures, bad_failures):
    ok, bad = tables
    assert C.violations(ok, check).count() == ok_failures
    assert C.violations(bad, check).count() == bad_failures
    summary = quality.check_summary({"t": bad}, [check]).collect()
    assert [r.failures for r in summary] == [bad_failures]


def test_suite_has_24_checks():
    assert len(quality.SUITE) == 24
    kinds = [c.kind for c in quality.SUITE]
    assert kinds.count(C.NOT_NULL) == 8 and kinds.count(C.UNIQUE) == 5
    assert kinds.count(C.EXPRESSION_IS_TRUE) == 8 and kinds.count(C.ACCEPTED_VALUES) == 2
    assert kinds.count(C.UNIQUE_COMBINATION) == 1
