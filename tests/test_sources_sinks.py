import csv
import io
import json
from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows

from hourledger import schemas
from hourledger.operators import lookup
from hourledger.sinks import catalog, history, invoice_store, landing
from hourledger.sources import api_pages, tables
from hourledger.sources.landing import NoLandingFiles, read_landing

RUN = datetime(2025, 7, 7, 15)


def write(path, text):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def csv_text(folder):
    (file,) = Path(folder).rglob("part-*.csv")
    return file.read_text(encoding="utf-8")


# --- Landing ----------------------------------------------------------------------------------


AWKWARD = ["plain", "comma, inside", 'say "so"', "", None, " edges ", "Ünïcode", "a\\b", "'"]


def test_landed_users_are_what_a_csv_reader_reads(spark, folder):
    users = [(str(n), AWKWARD[n], AWKWARD[-n], f"{n}@q.example") for n in range(len(AWKWARD))]
    df = spark.createDataFrame(users, "id string, firstName string, lastName string, email string").coalesce(1)
    target = landing.write_landing(landing.landing_users(df, RUN), folder, RUN)
    assert target.endswith("/run=2025-07-07_150000")
    header, *lines = csv.reader(io.StringIO(csv_text(target)))
    assert header == ["id", "firstName", "lastName", "email", "etl_time"]
    assert lines == [[text or "" for text in user] + ["2025-07-07T15:00:00"] for user in users]
    back = rows(read_landing(spark, folder, schemas.USERS_LANDING))
    assert back == sorted([(*(text or None for text in user), RUN) for user in users], key=repr)


def test_landed_hours_have_two_decimals(spark, folder):
    amounts = [0.0, 0.1 + 0.2, 1 / 3, 2.5, 19.999, 1234567.891, None]
    summary = spark.createDataFrame([(f"u{n}", amount) for n, amount in enumerate(amounts)], "userId string, total_billable_hours double").coalesce(1)
    target = landing.write_landing(landing.landing_hours(summary, "2022-10-01", "2022-10-31", RUN), folder, RUN)
    header, *lines = csv.reader(io.StringIO(csv_text(target)))
    assert header == ["userId", "total_billable_hours", "start_date", "end_date", "etl_time"]
    assert [line[1] for line in lines] == ["" if a is None else f"{a:.2f}" for a in amounts]
    assert {tuple(line[2:]) for line in lines} == {("2022-10-01", "2022-10-31", "2025-07-07T15:00:00")}


def test_white_space_survives_landing(spark, folder):
    users = spark.createDataFrame([("1", "  a ", "b\t", "c")], "id string, firstName string, lastName string, email string")
    landing.write_landing(landing.landing_users(users, RUN), folder, RUN)
    assert rows(read_landing(spark, folder, schemas.USERS_LANDING), "firstName", "lastName") == [("  a ", "b\t")]


def test_two_loads_do_not_overwrite_each_other(spark, folder):
    users = spark.createDataFrame([("1", "a", "b", "c")], "id string, firstName string, lastName string, email string")
    for second in (0, 1):
        run = RUN.replace(second=second)
        landing.write_landing(landing.landing_users(users, run), folder, run)
    assert read_landing(spark, folder, schemas.USERS_LANDING).count() == 2


HEADER = "userId,total_billable_hours,start_date,end_date,etl_time\n"


def test_only_csv_files_at_any_depth(spark, folder):
    write(f"{folder}/a.csv", HEADER + "1,2,2025-01-01,2025-01-02,2025-07-07T15:00:00\n")
    write(f"{folder}/deep/er/b.csv", HEADER + "2,2,2025-01-01,2025-01-02,never\n")
    write(f"{folder}/c.txt", HEADER + "3,2,2025-01-01,2025-01-02,2025-07-07T15:00:00\n")
    found = read_landing(spark, folder, schemas.HOURS_LANDING)
    assert rows(found, "userId", "etl_time") == [("1", RUN), ("2", None)]


def test_no_csv_file_is_an_error(spark, folder):
    write(f"{folder}/c.txt", "x")
    with pytest.raises(NoLandingFiles):
        read_landing(spark, folder, schemas.HOURS_LANDING)


def test_reordered_header_fails_instead_of_misreading(spark, folder):
    write(f"{folder}/a.csv", "total_billable_hours,userId,start_date,end_date,etl_time\n1,2,a,b,c\n")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        read_landing(spark, folder, schemas.HOURS_LANDING).collect()


# --- API pages --------------------------------------------------------------------------------


def page(path, data, total):
    write(path, json.dumps({"data": data, "meta": {"totalRows": total}}))


def test_pages_are_flattened_and_ids_become_text(spark, folder):
    ids = [7, "8", 9.0, "x-10", 11, None, 12]
    items = [{"id": i, "email": f"{n}@q.example", "unknown": {"deep": [n]}} for n, i in enumerate(ids)]
    for start in range(0, len(items), 3):
        page(f"{folder}/from/{start}.json", items[start : start + 3], len(items))
    users = api_pages.flatten_pages(api_pages.read_complete_pages(spark, folder, schemas.USERS_PAGE))
    assert users.columns == ["id", "firstName", "lastName", "email"]
    assert {tuple(r) for r in users.collect()} == {(None if i is None else str(i), None, None, f"{n}@q.example") for n, i in enumerate(ids)}


def test_a_page_that_announces_nothing_fails_the_load(spark, folder):
    page(f"{folder}/1.json", [{"id": 1}], 2)
    write(f"{folder}/2.json", '{"data": [{"id": 2}], "meta": {}}')
    with pytest.raises(api_pages.IncompletePages, match="not by every page"):
        api_pages.read_complete_pages(spark, folder, schemas.USERS_PAGE)


def test_json_is_parsed_once(spark, folder, monkeypatch):
    page(f"{folder}/dump/1.json", [{"id": 1, "decimalHours": "2.5"}], 1)
    opened, usual = [], type(spark.read).json
    monkeypatch.setattr(type(spark.read), "json", lambda self, *a, **k: opened.append(a) or usual(self, *a, **k))
    kept = f"{folder}/kept"
    entries = api_pages.flatten_entries(api_pages.read_complete_pages(spark, f"{folder}/dump", schemas.ENTRIES_PAGE, kept=kept))
    assert len(opened) == 1 and entries._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert "FileScan json" not in entries._jdf.queryExecution().executedPlan().toString()
    Path(f"{folder}/dump/1.json").unlink()
    assert rows(entries, "id", "decimalHours") == [("1", 2.5)]
    assert all(kept in file for file in entries.inputFiles())


def test_checks_read_ids_and_counts_only(spark, folder):
    page(f"{folder}/dump/1.json", [{"id": 1, "email": "a@q.example"}], 1)
    pages = api_pages.read_complete_pages(spark, f"{folder}/dump", schemas.USERS_PAGE)
    plan = api_pages.page_totals(pages)._jdf.queryExecution().executedPlan().toString()
    assert "email" not in plan.split("ReadSchema:")[1].split("\n")[0]


@pytest.mark.parametrize("pages", [1, 3])
def test_missing_or_repeated_pages_fail_the_load(spark, folder, pages):
    for number in range(pages):
        page(f"{folder}/{number}.json", [{"id": number}], 2)
    with pytest.raises(api_pages.IncompletePages):
        api_pages.read_complete_pages(spark, folder, schemas.USERS_PAGE)


def test_unreadable_page_fails_the_load(spark, folder):
    page(f"{folder}/1.json", [{"id": 1}], 2)
    write(f"{folder}/2.json", '{"data": [{"id": 2}')
    with pytest.raises(api_pages.IncompletePages):
        api_pages.read_complete_pages(spark, folder, schemas.USERS_PAGE)


def test_numbers_and_flags_of_any_json_type_are_read(spark, folder):
    flags = [0, 1, "0", "1", 1.0, 0.0, True, False, "true", None]
    page(f"{folder}/tasks/1.json", [{"id": i, "projectId": i, "isNonBillable": flag} for i, flag in enumerate(flags)] + [{"id": "x", "projectId": "x"}, None], 12)
    tasks = api_pages.flatten_pages(api_pages.read_complete_pages(spark, f"{folder}/tasks", schemas.TASKS_PAGE))
    assert dict(tasks.dtypes)["isNonBillable"] == "int"
    assert rows(tasks.where("id is not null and isNonBillable <> 0"), "id") == [("1",), ("3",), ("4",), ("6",), ("8",)]
    assert rows(tasks.where("isNonBillable is null"), "id") == [("9",), ("x",), (None,)]
    page(f"{folder}/entries/1.json", [{"id": 1, "decimalHours": "7.5"}, {"id": 2, "decimalHours": 2}, {"id": 3, "decimalHours": None}], 3)
    entries = api_pages.flatten_entries(api_pages.read_complete_pages(spark, f"{folder}/entries", schemas.ENTRIES_PAGE))
    assert rows(entries, "id", "decimalHours") == [("1", 7.5), ("2", 2.0), ("3", None)]


@pytest.mark.parametrize("schema, name, values", [
    (schemas.TASKS_PAGE, "isNonBillable", ["yes", "", 0.5, 1e12, {"x": 1}]),
    (schemas.ENTRIES_PAGE, "decimalHours", ["7,5", "", True, [1]]),
])
def test_unreadable_values_fail_the_load(spark, folder, schema, name, values):
    page(f"{folder}/1.json", [{"id": i, name: value} for i, value in enumerate([*values, 1, None])], len(values) + 2)
    with pytest.raises(api_pages.UnreadableValues, match=f"^{len(values)} unreadable values of {name}$"):
        api_pages.read_complete_pages(spark, folder, schema)


def test_pretty_printed_pages(spark, folder):
    write(f"{folder}/1.json", json.dumps({"data": [{"projectId": 5, "isNonBillable": None}], "meta": {"totalRows": 1}}, indent=1))
    pages = api_pages.read_complete_pages(spark, folder, schemas.TASKS_PAGE, multi_line=True)
    assert rows(api_pages.flatten_pages(pages)) == [(None, "5", None)]


def test_no_rows_at_all_is_complete(spark, folder):
    page(f"{folder}/1.json", [], 0)
    pages = api_pages.read_complete_pages(spark, folder, schemas.USERS_PAGE)
    assert api_pages.flatten_pages(pages).count() == 0


# --- Mapping ----------------------------------------------------------------------------------


def test_mapping_history(spark, folder):
    path = f"{folder}/mapping"
    empty = tables.read_mapping(spark, path)
    assert empty.columns == ["email", "issuer_company", "updated_at"] and empty.count() == 0
    for hour, issuer in ((1, "Old, Inc"), (2, 'New "Co"')):
        entered = spark.createDataFrame([("a@x.com", issuer)], "email string, issuer_company string")
        history.append_mapping(lookup.new_mappings(entered, RUN.replace(hour=hour, microsecond=5)), path)
    saved = tables.read_mapping(spark, path)
    assert saved.count() == 2
    assert rows(lookup.latest_issuer_of(saved, "A@x.com")) == [('New "Co"',)]


def test_mapping_written_elsewhere_is_read(spark, folder):
    write(f"{folder}/m.csv", "email,issuer_company,updated_at\npia@q.example,\"Sur, y Cia\",2023-11-27T08:09:10\n")
    assert rows(tables.read_mapping(spark, folder)) == [("pia@q.example", "Sur, y Cia", datetime(2023, 11, 27, 8, 9, 10))]


# --- Invoice store ----------------------------------------------------------------------------

ACCEPTED = (
    "invoice_id int, received_at int, email string, razon_social string, ruc_emisor string, amount_of_hours double, "
    "rate double, description string, invoice_date string"
)


def accepted(spark, *data):
    df = spark.createDataFrame(
        [(n, at, email, "Sur y Cia", "0099", hours, 100.0, description, day) for n, at, email, hours, description, day in data],
        ACCEPTED,
    )
    return df.withColumn("invoice_date", df["invoice_date"].cast("date"))


def stored(spark, path):
    return rows(tables.read_invoice_store(spark, path), "email", "amount_of_hours", "description", "year", "month")


def test_stored_invoice_text(spark, folder):
    path = f"{folder}/store"
    invoice_store.save_accepted(accepted(spark, (1, 1, "Test@x.com", 10.5, 'a\n"b"', "2025-06-30")), path)
    (file,) = Path(path).rglob("*.csv")
    assert file.parent == Path(path) / "year=2025" / "month=06"
    assert file.read_text() == '"test@x.com","Sur y Cia","0099","10.5","100.0","a ""b"""\n'
    assert stored(spark, path) == [("test@x.com", 10.5, 'a "b"', "2025", "06")]
    assert tables.read_invoice_store(spark, path).first()["ruc_emisor"] == "0099"


def test_last_accepted_per_email_and_month_wins(spark, folder):
    path = f"{folder}/store"
    first = accepted(
        spark,
        (1, 1, "a@x.com", 1.0, "d", "2025-06-01"), (2, 3, "A@x.com", 2.0, "d", "2025-06-02"),
        (3, 2, "a@x.com", 3.0, "d", "2025-06-03"), (4, 1, "b@x.com", 4.0, "d", "2025-06-03"),
        (5, 1, "a@x.com", 5.0, "d", "2024-06-03"),
    )
    invoice_store.save_accepted(first, path)
    second = accepted(spark, (6, 1, "a@x.com", 6.0, "d", "2025-06-09"), (7, 1, "a@x.com", 7.0, "d", "2025-07-09"))
    invoice_store.save_accepted(second, path)
    invoice_store.save_accepted(second.limit(0), path)
    assert stored(spark, path) == [
        ("a@x.com", 5.0, "d", "2024", "06"), ("a@x.com", 6.0, "d", "2025", "06"),
        ("a@x.com", 7.0, "d", "2025", "07"), ("b@x.com", 4.0, "d", "2025", "06"),
    ]


def test_months_are_registered_as_partitions(spark, folder):
    path, table = f"{folder}/store", "invoices_registered"
    invoice_store.save_accepted(accepted(spark, (1, 1, "a@x.com", 1.0, "d", "2025-06-01")), path, table)
    invoice_store.save_accepted(accepted(spark, (2, 1, "a@x.com", 2.0, "d", "2025-11-01"), (3, 1, "b@x.com", 3.0, "d", "2025-06-01")), path, table)
    partitions = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    assert sorted(partitions) == ["year=2025/month=06", "year=2025/month=11"]
    found = spark.table(table).where("month = '06'").select("email", "amount_of_hours", "month")
    assert rows(found) == [("a@x.com", 1.0, "06"), ("b@x.com", 3.0, "06")]


def test_catalog_objects_are_created_once(spark, folder):
    for _ in range(2):
        catalog.create_database(spark, "once")
        catalog.create_table(spark, "once.users_raw", schemas.USERS_LANDING, f"{folder}/users")
    assert spark.catalog.tableExists("once.users_raw")
    with pytest.raises(tables.MissingTable):
        tables.read_table(spark, "once", "users_std")


def test_invoice_documents_are_read_as_bytes(spark, folder):
    write(f"{folder}/a@x.com/1.xml", "<a/>")
    write(f"{folder}/b@x.com/1.txt", "<a/>")
    (row,) = tables.read_invoice_documents(spark, folder).collect()
    assert (row["email"], bytes(row["xml"])) == ("a@x.com", b"<a/>")
    assert row["invoice_id"].endswith("/1.xml")
