"""The workload's maps say for every category that statements print whether and where it is booked."""

from __spark_entry__ import queries
from ledgerloom.fixed_values import PM_CATEGORIES
from tests.helpers import rows
from workload import maps


def test_every_printed_category_is_in_the_maps():
    assert set(PM_CATEGORIES) <= set(maps.PM_LABELS) and set(maps.PM_LABELS) <= set(maps.CASHFLOW_LABELS)
    assert len({x for x in maps.PM_LABELS.values() if x}) == 15


def test_no_printed_category_is_left_out_as_unknown(spark, sf):
    status = dict(rows(queries()["category_map"](spark, sf), "category", "map_status"))
    assert {c for c, s in status.items() if s == "unknown"} == {"", "Mystery"} and status["Postage"] == "mapped"
