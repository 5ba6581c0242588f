"""KPIs from kept sums against KPIs over all transactions."""

import pytest

from refinery.plans.kpi_state import add_to_kpis, kpis_of
from refinery.plans.kpis import KPI_TABLES
from refinery.queries import new_table

DDL = (
    "product_type string, revenue_generated double, manufacturing_costs double, shipping_costs double, "
    "stock_levels int, shipping_times int, lead_time int"
)
ROWS = [
    ("a", 100.0, 20.0, 5.0, 3, 4, 5), ("a", 50.0, None, 5.0, 1, 9, 5), ("b", 0.0, 1.0, 1.0, 2, None, 5),
    ("c", None, 7.0, None, None, 3, 3), (None, 10.0, 2.0, 1.0, 1, 1, 2), ("a", 30.0, 4.0, 2.0, 5, 2, 2), ("b", 8.0, 3.0, None, 4, 6, 7),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def same(spark, states, rows):
    kept = kpis_of(spark.table(states))
    for name, build in KPI_TABLES.items():
        want, got = (sorted(map(tuple, f.collect()), key=lambda r: str(r[0])) for f in (build(frame(spark, rows)), kept[name]))
        assert len(got) == len(want), name
        for g, w in zip(got, want):
            assert list(g) == [pytest.approx(v) if isinstance(v, float) else v for v in w], name


def test_kept_sums_equal_a_recomputation(spark):
    states = new_table(spark, "kpis")
    add_to_kpis(frame(spark, ROWS[:3]), states, "one")
    same(spark, states, ROWS[:3])
    add_to_kpis(frame(spark, ROWS[3:5]), states, "two")
    add_to_kpis(frame(spark, ROWS[3:]), states, "two")  # again, with more rows
    same(spark, states, ROWS)
    add_to_kpis(frame(spark, []), states, "two")  # a batch that has become empty
    same(spark, states, ROWS[:3])


def test_no_rows(spark):
    states = new_table(spark, "kpis")
    add_to_kpis(frame(spark, []), states, "one")
    same(spark, states, [])
