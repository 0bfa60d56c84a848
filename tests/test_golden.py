"""A run over rows with the known totals of the sample: 100 incidents, five of them filed twice."""

from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from tierwork import INCIDENTS
from tierwork.plans import run

# Fixed value: the header line of an incident export.
HEADER = (
    "Number,Opened,short_description,Caller,User ID,Priority,State,Category,Assignment group,"
    "Assigned to,Channel,Service,Service Family,Service Subcategory,Updated,Updated by"
)
# The totals of the sample.
PRIORITIES = {"4 - Low": 87, "3 - Moderate": 10, "2 - High": 3}
CATEGORIES = {"Inquiry / Help": 86, "Network": 6, "Software": 4, "Hardware": 4}
STATES = {"Canceled": 35, "Closed": 33, "Resolved": 32}
MONTHS = {"2023-10": 15, "2023-11": 14, "2023-12": 34, "2024-1": 23, "2024-2": 14}
HOURS = {
    "SOCteam": 859.33,
    "Unassigned": 904.69,
    "Tech-Support-L1": 970.58,
    "GNOCIM": 1008.0,
    "ETL_Support": 1094.5,
    "CIO-DevOps_L2": 1190.35,
}


def spread(totals):
    return [value for value, count in totals.items() for _ in range(count)]


def lines():
    groups = list(HOURS)
    for n, (priority, category, state, month) in enumerate(
        zip(*map(spread, (PRIORITIES, CATEGORIES, STATES, MONTHS)))
    ):
        year, number = map(int, month.split("-"))
        opened = datetime(year, number, 1 + n % 28, 8, 30)
        group = groups[n % len(groups)]
        updated = opened + timedelta(seconds=round(HOURS[group] * 3600))
        filled = n % 3 == 0  # text fields that have a default are empty in two rows of three
        text = [f"text, {n}", "Ann", "U1"] if filled else ["", "", ""]
        rest = ["Bo", "Mail", "S", "F", "C"] if filled else [""] * 5
        fields = [
            f"INC{n:04}", f"{opened:%Y-%m-%d %H:%M:%S}", *text, priority, state, category,
            "" if group == "Unassigned" else group, *rest, f"{updated:%Y-%m-%d %H:%M:%S}", "Cy" if filled else "",
        ]
        yield ",".join(f'"{x}"' if "," in x else x for x in fields)


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder, rows = tmp_path_factory.mktemp("golden"), list(lines())
    (folder / "incidents.csv").write_text("\n".join([HEADER, *rows, *rows[10:60:10]]) + "\n")
    spark.sql(f"CREATE DATABASE golden_test LOCATION '{folder}/schema'")
    spec = replace(INCIDENTS, schema="golden_test")
    counts = run.run(spark, spec, str(folder / "incidents.csv"), str(folder / "tables"))
    return spec, {r["layer"]: r["row_count"] for r in counts.collect()}


def test_rows_per_layer(made):
    assert made[1] == {"bronze": 105, "quality": 21, "silver": 100, "quarantine": 5, "gold": 21}


def test_quality(spark, made):
    report = {(r["check_type"], r["column_name"]): r for r in spark.table(made[0].table("quality")).collect()}
    duplicates = report["DUPLICATE_CHECK", "duplicate_rows"]
    assert (duplicates["value"], duplicates["percentage"]) == ("5", "4.76%")
    critical = report["CRITICAL_NULL_CHECK", "critical_columns_with_nulls"]
    assert (critical["value"], critical["percentage"], critical["status"]) == ("0", "0/4 columns affected", "PASS")
    nulls = Counter(r["status"] for (check, _), r in report.items() if check == "NULL_CHECK")
    assert nulls == {"WARNING": 10, "PASS": 8}


def test_quarantine(spark, made):
    reasons = spark.table(made[0].table("quarantine")).select("reject_reason").collect()
    assert Counter(r[0] for r in reasons) == {"duplicate row": 5}


def test_gold(spark, made):
    gold = spark.table(made[0].table("gold")).collect()
    found = Counter((r["aggregation_type"], r["group_column"], r["value"]) for r in gold)
    wanted = {
        "by_priority": PRIORITIES,
        "by_category": CATEGORIES,
        "by_state": STATES,
        "by_month": MONTHS,
        "avg_resolution_time": HOURS,
    }
    assert found == Counter((kind, group, str(n)) for kind, totals in wanted.items() for group, n in totals.items())
