from datetime import date, datetime

from conftest import rows

from hourledger.operators.clean import clean_hours, clean_users
from hourledger.operators.latest import latest_per_key

T1, T2, T3 = "2025-01-01T00:00:00", "2025-01-02T00:00:00", "2025-01-03T00:00:00"
USERS = "id string, firstName string, lastName string, email string, etl_time string"
HOURS = "userId string, total_billable_hours string, start_date string, end_date string, etl_time string"


def test_users_are_trimmed_folded_and_deduplicated(spark):
    raw = spark.createDataFrame(
        [
            ("1", " ann ", "lee", " Ann@x.com ", T1),
            ("1", "anna", " lee ", "anna@x.com", T2),
            ("2", None, "", None, T1),
            (None, "ghost", "ghost", "g@x.com", T3),
        ],
        USERS,
    )
    assert rows(clean_users(raw)) == [
        ("1", "ANNA", "LEE", "anna@x.com", datetime(2025, 1, 2)),
        ("2", None, "", None, datetime(2025, 1, 1)),
    ]


def test_names_are_trimmed_of_blanks_only(spark):
    raw = spark.createDataFrame([("1", "\tann ", "l", "e", T1)], USERS)
    assert clean_users(raw).first()["firstName"] == "\tANN"


def test_invalid_hours_are_dropped_before_deduplication(spark):
    raw = spark.createDataFrame(
        [
            ("u", "5", "2025-01-06", "2025-01-12", T1),
            ("u", "-1", "2025-01-06", "2025-01-12", T2),
            ("u", "n/a", "2025-01-06", "2025-01-12", T3),
            ("v", "-2", "2025-01-06", "2025-01-12", T1),
            (None, "3", "2025-01-06", "2025-01-12", T1),
        ],
        HOURS,
    )
    assert rows(clean_hours(raw)) == [("u", 5.0, date(2025, 1, 6), date(2025, 1, 12), datetime(2025, 1, 1))]


def test_unreadable_dates_and_nan(spark):
    raw = spark.createDataFrame(
        [("u", "1", "2025-13-01", "x", T1), ("u", "2", "nonsense", None, T2), ("n", "NaN", "2025-01-06", "2025-01-12", "x")],
        HOURS,
    )
    found = {row["userId"]: row for row in clean_hours(raw).collect()}
    # Both rows of u have NULL dates and are one group; NaN is not negative.
    assert (found["u"]["total_billable_hours"], found["u"]["start_date"]) == (2.0, None)
    assert found["n"]["total_billable_hours"] != found["n"]["total_billable_hours"]
    assert found["n"]["etl_time"] is None


def test_ties_do_not_depend_on_row_order(spark):
    data = [("k", 1, "b"), ("k", 1, "a"), ("k", 1, None), ("k", None, "z")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, v int, other string").repartition(3)
        assert rows(latest_per_key(df, ["k"], "v")) == [("k", 1, "b")]


def test_null_version_comes_last_but_survives_alone(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), ("b", None)], "k string, v int")
    assert rows(latest_per_key(df, ["k"], "v")) == [("a", None), ("b", 1)]
