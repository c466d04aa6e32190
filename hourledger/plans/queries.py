"""Driver queries: every operator over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourledger import schemas
from hourledger.functions.text import is_company_email
from hourledger.operators import clean, hours, invoices, lookup, merge, quality, report
from hourledger.operators.latest import latest_per_key
from hourledger.plans import adapters
from hourledger.plans.pipeline import (
    KEYS,
    PipelineConfig,
    StageFailed,
    book_hours,
    check_layers,
    decisions,
    hydrate,
    landing_to_raw,
    process_inbox,
    process_invoices,
    raw_to_std,
    run_checks,
    run_pipeline,
    stored_hours,
    upload_in_rounds,
)
from hourledger.plans.tables import HOURS, USERS
from hourledger.schemas import TableSpec
from hourledger.session import shared_dir
from hourledger.sinks import catalog, history, invoice_store, landing, std_table
from hourledger.sinks.documents import by_sender, write_documents
from hourledger.sinks.raw import SET_ASIDE
from hourledger.sources import api_pages
from hourledger.sources.landing import FILE, read_landing, read_landing_lines
from hourledger.sources.tables import read_invoice_store, read_table

PERIOD = ("1997-01-01", "1997-12-31")
RUN_TS = datetime(2025, 7, 7, 15, 0, 0)
REPORT_DAY = "2025-07-11"
ONE_USER = 7
ONE_EMAIL = f"Customer.000000007@{adapters.DOMAIN}"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/hourledger-{name}-{uuid.uuid4().hex}"


# --- Billable hours ---------------------------------------------------------------------------


@query
def billable_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hours.billable_projects(adapters.project_tasks(spark, sf_dir))


@query
def billable_hours_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = adapters.time_entries(spark, sf_dir, *PERIOD)
    return hours.billable_hours(entries, adapters.project_tasks(spark, sf_dir), *PERIOD)


@query
def billable_hours_one_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = adapters.time_entries(spark, sf_dir, "1995-01-01", "2001-12-31")
    return hours.billable_hours(
        entries, adapters.project_tasks(spark, sf_dir), "1995-01-01", "2001-12-31", ONE_USER
    )


@query
def billable_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.billable_entries(spark, sf_dir)


@query
def landing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.landing_hours(billable_hours_by_user(spark, sf_dir), *PERIOD, RUN_TS)


@query
def landing_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.landing_users(adapters.users_raw(spark, sf_dir), RUN_TS)


# --- Std layer --------------------------------------------------------------------------------


@query
def users_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_users(adapters.users_raw(spark, sf_dir))


@query
def hours_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_hours(adapters.hours_raw(spark, sf_dir))


@query
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(adapters.table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts")


@query
def dedupe_latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(
        adapters.table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey"], "l_shipdate"
    )


def _merge_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Hours up to the 15th, and updates from the 10th on, some stamped with a clock ten days late."""
    raw = adapters.hours_raw(spark, sf_dir)
    late = F.col("etl_time") - F.expr("INTERVAL 10 DAYS")
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    overlap = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    stamped = F.when(F.col("userId").cast("bigint") % 2 == 0, late).otherwise(F.col("etl_time"))
    updates = raw.where(F.col("etl_time") >= overlap).withColumn("etl_time", stamped)
    return clean.clean_hours(raw.where(F.col("etl_time") < split)), clean.clean_hours(updates)


@query
def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_latest(*_merge_inputs(spark, sf_dir), clean.HOURS_KEYS)


@query
def merge_latest_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_latest_small(*_merge_inputs(spark, sf_dir), clean.HOURS_KEYS)


@query
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge where a quarter of the users have no end date in their key, compared both ways."""
    dated = F.when(F.col("userId").cast("bigint") % 4 != 0, F.col("end_date"))
    std, updates = (side.withColumn("end_date", dated) for side in _merge_inputs(spark, sf_dir))
    plain, null_safe = (
        merge.merge_latest(std, updates, clean.HOURS_KEYS, null_safe=safe).withColumn("null_safe", F.lit(safe))
        for safe in (False, True)
    )
    return plain.unionAll(null_safe)


@query
def merge_into_std_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge through the versioned, partitioned std table."""
    std, updates = _merge_inputs(spark, sf_dir)
    base = _scratch(spark, "std")
    name = f"std_{uuid.uuid4().hex}"
    std_table.apply_updates(spark, name, HOURS, std, base, "base")
    std_table.apply_updates(spark, name, HOURS, updates, base, "updates")
    return std_table.read_std(spark, name, HOURS)


# --- Consistency ------------------------------------------------------------------------------


def _checks(spark: SparkSession, sf_dir: str) -> list[quality.LayerCheck]:
    users, booked = adapters.users_raw(spark, sf_dir), adapters.hours_raw(spark, sf_dir)
    return [
        quality.LayerCheck(USERS.name, USERS.check_columns, users, clean.clean_users(users)),
        quality.LayerCheck(HOURS.name, HOURS.check_columns, booked, clean.clean_hours(booked)),
        quality.LayerCheck("hours_full_key", HOURS.keys, booked, clean.clean_hours(booked)),
    ]


@query
def qa_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.consistency_report(_checks(spark, sf_dir))


@query
def qa_summary_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = _checks(spark, sf_dir)
    result = quality.consistency_report(checks)
    return quality.summary_line(result, [check.label for check in checks], REPORT_DAY)


@query
def count_distinct_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ["l_orderkey", "l_linenumber"]
    return adapters.table(spark, sf_dir, "lineitem").agg(quality.distinct_count(pairs).alias("n"))


@query
def count_distinct_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.users_raw(spark, sf_dir).agg(quality.distinct_count(["id"]).alias("n"))


# --- Dashboard --------------------------------------------------------------------------------


@query
def dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.kpis(users_std(spark, sf_dir), hours_std(spark, sf_dir))


@query
def hours_with_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.hours_with_email(hours_std(spark, sf_dir), users_std(spark, sf_dir))


@query
def display_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.display_users(hours_std(spark, sf_dir), users_std(spark, sf_dir))


@query
def user_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.user_series(
        hours_std(spark, sf_dir), users_std(spark, sf_dir), ONE_EMAIL.lower()
    )


# --- Lookups ----------------------------------------------------------------------------------


@query
def latest_issuer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.latest_issuers(adapters.email_issuer_mapping(spark, sf_dir))


@query
def latest_issuer_of_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.latest_issuer_of(adapters.email_issuer_mapping(spark, sf_dir), ONE_EMAIL)


@query
def mapping_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = adapters.email_issuer_mapping(spark, sf_dir).select("email", "issuer_company", "updated_at")
    entered = adapters.table(spark, sf_dir, "customer").select(
        F.lower(adapters.dotted("c_name")).alias("email"),
        F.concat(F.lit("\t"), F.col("c_mktsegment"), F.lit(" \n")).alias("issuer_company"),
    )
    added = lookup.new_mappings(entered, RUN_TS).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
    return lookup.append_mappings(history, added)


@query
def user_id_by_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = adapters.invoices(spark, sf_dir, with_hours=False).select("invoice_id", F.upper("email").alias("email"))
    return lookup.attach_user_id(facts, users_std(spark, sf_dir)).select("invoice_id", "user_id")


@query
def issuer_by_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = adapters.invoices(spark, sf_dir, with_hours=False).select("invoice_id", "email")
    mapping = adapters.email_issuer_mapping(spark, sf_dir)
    return lookup.attach_issuer(facts, mapping).select("invoice_id", "issuer_company")


@query
def email_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = adapters.users_raw(spark, sf_dir)
    padded = F.concat(F.lit("\t"), F.col("email"), F.lit("\n"))
    other = F.when(F.col("lastName").startswith("renamed"), F.replace(padded, F.lit("corp."), F.lit("corp-")))
    checked = F.coalesce(other, padded)
    return users.select(
        "id", "lastName", is_company_email(checked, adapters.DOMAIN).alias("valid")
    )


# --- Invoices ---------------------------------------------------------------------------------


@query
def invoice_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = adapters.invoice_documents(adapters.invoices(spark, sf_dir))
    return invoices.extract_fields(documents).drop("userId", "email")


@query
def invoice_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = lookup.attach_issuer(
        adapters.invoices(spark, sf_dir, with_hours=False), adapters.email_issuer_mapping(spark, sf_dir)
    )
    checked = invoices.check_content(mapped, adapters.RULES)
    return checked.select(
        "invoice_id", "issuer_ok", "receiver_ok",
        F.array_join("missing_keywords", ", ").alias("missing_keywords"),
    )


@query
def invoice_hours_mtd(spark: SparkSession, sf_dir: str) -> DataFrame:
    booked = invoices.attach_month_to_date(
        adapters.invoices(spark, sf_dir), adapters.billable_entries(spark, sf_dir), "userId"
    )
    return booked.select(
        "invoice_id", "amount_of_hours", "timesheet_hours", invoices.hours_status().alias("hours_status")
    )


def _is(divisor: int, column: str = "invoice_id") -> Column:
    return F.col(column) % divisor == 0


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All invoices as documents; some damaged, undated or sent from an unknown address."""
    documents = adapters.invoice_documents(adapters.invoices(spark, sf_dir))
    xml = F.col("xml")
    damaged = (
        F.when(_is(17), F.concat(xml, F.lit("trailing text")))
        .when(_is(19), F.replace(xml, F.lit("</CFE>"), F.lit("")))
        .when(_is(23), F.replace(xml, F.lit("DscItem>"), F.lit("Other>")))
        .when(_is(29), F.regexp_replace(xml, r"<FchEmis>(\d{4})-..-", r"<FchEmis>$1-13-"))
        .otherwise(xml)
    )
    sender = F.when(_is(31), F.concat(F.lit("x."), F.col("email"))).otherwise(F.col("email"))
    return documents.select("invoice_id", sender.alias("email"), damaged.alias("xml"))


def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping history; users whose number ends in 3 gave another address."""
    moved = F.when(F.col("email").contains("3@"), F.concat(F.lit("old."), F.col("email")))
    return adapters.email_issuer_mapping(spark, sf_dir).withColumn("email", F.coalesce(moved, F.col("email")))


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = _mapping(spark, sf_dir)
    directory = lookup.email_directory(users_std(spark, sf_dir), mapping).withColumn(
        "user_id", F.col("user_id").cast("bigint")
    )
    extracted = invoices.extract_fields(_documents(spark, sf_dir))
    return invoices.validate(
        extracted, directory, adapters.billable_entries(spark, sf_dir), adapters.RULES
    )


@query
def invoice_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decisions(spark, sf_dir).select(
        "invoice_id", "first_failure", F.array_join("failures", ",").alias("failures"), "accepted"
    )


@query
def invoice_store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = _decisions(spark, sf_dir).where("accepted")
    return invoice_store.store_rows(accepted, received="invoice_id")


def _store_twice(spark: SparkSession, sf_dir: str, path: str, table: str | None = None) -> None:
    """All invoices stored in two batches, the earlier ones first."""
    everything = (
        adapters.invoices(spark, sf_dir, with_hours=False)
        .withColumn("amount_of_hours", F.col("invoice_id").cast("double") / 4)
        .withColumn("ruc_emisor", F.lpad(F.col("userId").cast("string"), 12, "0"))
        .withColumn("description", F.concat(F.col("description"), F.lit('\nsaid "done", '), F.col("email")))
    )
    early = F.col("invoice_date") < F.lit("1998-06-15").cast("date")
    invoice_store.save_accepted(everything.where(early), path, table, received="invoice_id")
    invoice_store.save_accepted(everything.where(~early), path, table, received="invoice_id")


@query
def invoice_store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store after two batches, read by its path."""
    path = _scratch(spark, "invoices")
    _store_twice(spark, sf_dir, path)
    return read_invoice_store(spark, path)


@query
def invoice_table_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the catalog: the table's registered partitions."""
    name = f"invoices_{uuid.uuid4().hex}"
    _store_twice(spark, sf_dir, _scratch(spark, "invoices"), name)
    return spark.table(name)


@query
def invoice_files_to_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole invoice job on files and tables: the content of the store afterwards."""
    cfg = PipelineConfig(_scratch(spark, "invoices"), f"hourledger_{uuid.uuid4().hex}")
    catalog.create_database(spark, cfg.database)
    std_table.apply_updates(
        spark, cfg.std_table(USERS), USERS, users_std(spark, sf_dir), cfg.std(USERS), "base"
    )
    history.append_mapping(_mapping(spark, sf_dir), cfg.mapping)
    documents = _documents(spark, sf_dir).withColumn("received_at", F.col("invoice_id"))
    entries = adapters.time_entries(spark, sf_dir).withColumn("userId", F.col("userId").cast("string"))
    process_invoices(
        spark, cfg, documents, entries, adapters.project_tasks(spark, sf_dir), adapters.RULES
    )
    return read_invoice_store(spark, cfg.invoices)


@query
def invoice_documents_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every invoice uploaded as a file of its own, read back and parsed."""
    uploaded = adapters.invoice_documents(adapters.invoices(spark, sf_dir))
    documents = upload_in_rounds(spark, uploaded.withColumn("name", F.col("invoice_id")), _scratch(spark, "inbox"))
    fields = invoices.extract_fields(documents)
    return fields.drop("received_at").withColumn("invoice_id", _number_of_file("invoice_id"))


def _number_of_file(path: str) -> Column:
    return F.regexp_extract(path, "/([0-9]+)[.]xml$", 1).cast("bigint")


def _invoice_lake(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    """Users, mappings and the daily hours, which two loads booked: the second corrects a part of the first."""
    cfg = PipelineConfig(_scratch(spark, "lake"), f"hourledger_{uuid.uuid4().hex}")
    catalog.create_database(spark, cfg.database)
    std_table.apply_updates(spark, cfg.std_table(USERS), USERS, users_std(spark, sf_dir), cfg.std(USERS), "base")
    history.append_mapping(_mapping(spark, sf_dir), cfg.mapping)
    entries, tasks = adapters.time_entries(spark, sf_dir), adapters.project_tasks(spark, sf_dir)
    wrong = entries.withColumn("decimalHours", F.when(F.year("entry_date") < 1997, F.col("decimalHours")).otherwise(F.lit(1.0)))
    book_hours(spark, cfg, wrong, tasks, "1990-01-01", "1998-08-15", "first")
    book_hours(spark, cfg, entries, tasks, "1997-01-01", "2005-12-31", "second")
    return cfg


@query
def invoice_hours_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoices' hours from the table of daily hours; the time entries are not read."""
    booked = stored_hours(spark, _invoice_lake(spark, sf_dir))(date(1990, 1, 1), date(2005, 12, 31))
    asked = adapters.invoices(spark, sf_dir, with_hours=False).withColumn("userId", F.col("userId").cast("string"))
    return invoices.attach_booked(asked, booked, "userId").select("invoice_id", "timesheet_hours")


@query
def invoice_inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole invoice job on an inbox that two uploads fill: each decision, and the run that made it."""
    cfg, inbox, made = _invoice_lake(spark, sf_dir), _scratch(spark, "inbox"), _scratch(spark, "made")
    # Made once for both uploads.
    _documents(spark, sf_dir).withColumn("name", F.col("invoice_id")).write.parquet(made)
    documents = spark.read.schema("invoice_id bigint, email string, xml string, name bigint").parquet(made)
    for run in (0, 1):
        write_documents(by_sender(documents.where(F.col("invoice_id") % 2 == run)), inbox)
        process_inbox(spark, cfg, inbox, adapters.RULES, stored_hours(spark, cfg))
    decided = decisions(spark, cfg)
    run = F.dense_rank().over(Window.orderBy("batch")) - 1
    runs = decided.select("batch").distinct().withColumn("run", run)
    return decided.join(runs, "batch").select(
        _number_of_file("invoice_id").alias("invoice_id"), "run", F.array_join("failures", ",").alias("failures")
    )


# --- Sources and incremental loads ------------------------------------------------------------


def _pages(items: DataFrame, key: str, page_size: int = 1000) -> DataFrame:
    """Rows as API pages of at most ``page_size`` items, by a dense unique key."""
    total = items.count()
    page = F.floor(F.col(key).cast("bigint") / page_size)
    return (
        items.groupBy(page.alias("page"))
        .agg(F.collect_list(F.struct(*items.columns)).alias("data"))
        .select("data", F.struct(F.lit(total).alias("totalRows")).alias("meta"))
    )


@query
def api_pages_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "pages")
    _pages(adapters.project_tasks(spark, sf_dir), "id").write.json(path)
    return api_pages.flatten_pages(api_pages.read_complete_pages(spark, path, schemas.TASKS_PAGE))


@query
def api_pages_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "pages")
    customers = adapters.table(spark, sf_dir, "customer")
    users = customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("lastName"))
    _pages(users, "id").write.json(path)
    return api_pages.page_totals(api_pages.read_pages(spark, path, schemas.USERS_PAGE))


@query
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users landed as CSV and read back: empty text comes back as NULL."""
    folder = _scratch(spark, "landing")
    landing.write_landing(landing_users(spark, sf_dir), folder, RUN_TS)
    back = read_landing(spark, folder, schemas.USERS_LANDING)
    return back.withColumn("etl_time", F.col("etl_time").cast("timestamp_ntz"))


@query
def landing_run_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users landed twice: the folder of each load and its rows."""
    folder = _scratch(spark, "landing")
    for hour in (9, 15):
        run = RUN_TS.replace(hour=hour)
        landing.write_landing(landing.landing_users(adapters.users_raw(spark, sf_dir), run), folder, run)
    lines = read_landing_lines(spark, [folder], schemas.USERS_LANDING)
    return lines.groupBy(F.regexp_extract(FILE, "/(run=[^/]+)/", 1).alias("folder")).agg(F.count("etl_time").alias("n"))


def _land_as_others_do(rows: DataFrame, folder: str) -> None:
    """Headed CSV of values that are joined as they are, line breaks and all."""
    lines = rows.select(F.explode(F.split(F.concat_ws(",", *rows.columns), "\n")).alias(",".join(rows.columns)))
    lines.write.options(header="true", quote="", sep="\x01", escapeQuotes="false").csv(folder)


@query
def landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the users landed well, a third with a column too many, a third with a line break within
    quotes: the damaged lines that were set aside, and the ids that were loaded."""
    cfg = PipelineConfig(_scratch(spark, "quarantine"), f"hourledger_{uuid.uuid4().hex}", on_damage=SET_ASIDE)
    customers = adapters.table(spark, sf_dir, "customer")
    users = customers.select(
        F.col("c_custkey").cast("string").alias("id"), F.lower("c_mktsegment").alias("firstName"),
        adapters.dotted("c_name").alias("lastName"), F.lit("a@b.example").alias("email"),
    )
    kind = F.col("id").cast("bigint") % 3
    landing.write_landing(landing.landing_users(users.where(kind == 0), RUN_TS), cfg.landing(USERS), RUN_TS)
    stamped = landing.stamp(users, RUN_TS)
    wide = stamped.where(kind == 1).withColumn("email", F.concat("email", F.lit(",again")))
    torn = stamped.where(kind == 2).withColumn("firstName", F.concat(F.lit('"'), "firstName", F.lit('\nand more"')))
    _land_as_others_do(wide, f"{cfg.landing(USERS)}/wide")
    _land_as_others_do(torn, f"{cfg.landing(USERS)}/torn")
    landing_to_raw(spark, cfg, USERS)
    kept = spark.read.schema("file string, line string").parquet(cfg.quarantined(USERS))
    loaded = spark.table(cfg.raw_table(USERS))
    return kept.select(F.lit("set aside").alias("state"), "line").unionAll(loaded.select(F.lit("loaded"), "id"))


@query
def failing_table_beside_a_good_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in which nothing was landed for the users: what failed, and the hours that were loaded."""
    cfg = PipelineConfig(_scratch(spark, "failing"), f"hourledger_{uuid.uuid4().hex}")
    (part,) = _land_hours(spark, sf_dir, 1)
    landing.write_landing(part, cfg.landing(HOURS), RUN_TS)
    try:
        run_pipeline(spark, cfg, REPORT_DAY)
        failed = ""
    except StageFailed as failure:
        failed = ",".join(f"{name}:{type(error).__name__}" for name, error in failure.failures.items())
    loaded = spark.table(cfg.raw_table(HOURS)).groupBy("userId").agg(F.count("*").alias("n"))
    return loaded.withColumn("failed", F.lit(failed))


@query
def qa_error_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check where the users' layers cannot be read: their error, and the counts of the hours."""
    booked = adapters.hours_raw(spark, sf_dir)

    def layers(spec: TableSpec) -> tuple[DataFrame, DataFrame]:
        if spec is USERS:
            return read_table(spark, "no_such_database", "users_raw"), booked
        return booked, clean.clean_hours(booked)

    return quality.summary_line(run_checks(spark, (USERS, HOURS), layers), [USERS.name, HOURS.name], REPORT_DAY)


def _land_hours(spark: SparkSession, sf_dir: str, landings: int) -> list[DataFrame]:
    """The raw hours cut by load time into the given number of landings."""
    raw = adapters.hours_raw(spark, sf_dir)
    text = raw.withColumn("etl_time", F.date_format("etl_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    days = ["2024-01-11", "2024-01-21"][: landings - 1]
    bounds = ["", *days, "9"]
    return [
        text.where((F.col("etl_time") >= low) & (F.col("etl_time") < high))
        for low, high in zip(bounds, bounds[1:])
    ]


def _load_hours(spark: SparkSession, sf_dir: str, *modes: str) -> DataFrame:
    """One landing and one run for each mode; the std hours afterwards."""
    cfg = PipelineConfig(_scratch(spark, "hours"), f"hourledger_{uuid.uuid4().hex}")
    catalog.create_database(spark, cfg.database)
    for number, (part, mode) in enumerate(zip(_land_hours(spark, sf_dir, len(modes)), modes)):
        cfg = replace(cfg, mode=mode)
        landing.write_landing(part, cfg.landing(HOURS), RUN_TS.replace(second=number))
        landing_to_raw(spark, cfg, HOURS)
        raw_to_std(spark, cfg, HOURS)
    std = std_table.read_std(spark, cfg.std_table(HOURS), HOURS)
    return std.withColumn("etl_time", F.col("etl_time").cast("timestamp_ntz"))


@query
def incremental_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings, each streamed into raw and merged into std."""
    return _load_hours(spark, sf_dir, "incremental", "incremental", "incremental")


@query
def full_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in batch mode: every run re-reads all landings; std is not affected."""
    return _load_hours(spark, sf_dir, "full", "full", "full")


@query
def mixed_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch mode between two streamed landings loses none of them."""
    return _load_hours(spark, sf_dir, "incremental", "full", "incremental")


@query
def qa_consistency_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check after three loads, from the tables of keys that each load extended."""
    cfg = PipelineConfig(_scratch(spark, "keys"), f"hourledger_{uuid.uuid4().hex}", check=KEYS)
    catalog.create_database(spark, cfg.database)
    for number, part in enumerate(_land_hours(spark, sf_dir, 3)):
        landing.write_landing(part, cfg.landing(HOURS), RUN_TS.replace(second=number))
        landing_to_raw(spark, cfg, HOURS)
        raw_to_std(spark, cfg, HOURS)
    return check_layers(spark, cfg, [HOURS]).drop("error")


@query
def hydrate_to_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page dumps of users, tasks and time entries through all layers: the std hours and the check's line."""
    cfg = PipelineConfig(_scratch(spark, "hydrate"), f"hourledger_{uuid.uuid4().hex}")
    users = adapters.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("firstName"),
        F.col("c_name").alias("lastName"), F.lower(adapters.dotted("c_name")).alias("email"),
    )
    entries = adapters.time_entries(spark, sf_dir, numbered=True)
    dumps = {
        "users": users,
        "project-tasks": adapters.project_tasks(spark, sf_dir),
        "time-entries": entries.withColumn("date", F.col("entry_date").cast("string")).drop("entry_date"),
    }
    for kind, items in dumps.items():
        _pages(items, "id").write.json(f"{cfg.root}/pages/{kind}")
    hydrate(spark, cfg, f"{cfg.root}/pages", *PERIOD, RUN_TS)
    line = run_pipeline(spark, cfg, REPORT_DAY)
    std = std_table.read_std(spark, cfg.std_table(HOURS), HOURS)
    return std.drop("etl_time").withColumn("report", F.lit(line))
