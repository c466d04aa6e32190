"""The pipeline's inputs, derived from the star-schema test tables.

Every adapter covers its whole tables. They give each operator realistic variety: padded and
mixed-case text, several versions per key, unreadable numbers, NULL keys, ties.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourledger.operators import hours
from hourledger.operators.invoices import INVOICE_NAMESPACE, InvoiceRules, attach_month_to_date

DOMAIN = "corp.example"
RULES = InvoiceRules(
    receiver_id="999999999999",
    keywords=("engineering", "platform", "reviewed", "clause 7 of the frame contract"),
)
FULL_DESCRIPTION = "Platform Engineering reviewed under Clause 7 of the frame contract"


# Stated, so that no job has to look them up in the files.
_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def dotted(name: str) -> Column:
    return F.replace(F.col(name), F.lit("#"), F.lit("."))


def users_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded users; a renamed second version for a third of them; rows without id."""
    customers = table(spark, sf_dir, "customer")
    email = F.concat(F.lower(dotted("c_name")), F.lit(f"@{DOMAIN}"))

    def at(text: str) -> Column:
        return F.lit(text).cast("timestamp_ntz").alias("etl_time")

    first = customers.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lit("  "), F.lower("c_mktsegment")).alias("firstName"),
        F.concat(F.lower("c_name"), F.lit("  ")).alias("lastName"),
        F.concat(F.lit(" "), email, F.lit(" ")).alias("email"),
        at("2024-01-01 00:00:00"),
    )
    renamed = customers.where(F.col("c_custkey") % 3 == 0).select(
        F.col("c_custkey").cast("string"),
        F.lower("c_mktsegment"),
        F.concat(F.lit("renamed "), F.lower("c_name")),
        email,
        at("2024-02-01 00:00:00"),
    )
    ghosts = customers.where(F.col("c_custkey") % 5 == 0).select(
        F.lit(None).cast("string"),
        F.lit("ghost"),
        F.lit("ghost"),
        F.lit(f"ghost@{DOMAIN}"),
        at("2024-02-02 00:00:00"),
    )
    return first.unionAll(renamed).unionAll(ghosts)


def hours_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly hours as text, with negative and unreadable ones and many versions per week."""
    week = F.date_trunc("week", "ts").cast("date")
    kind = F.col("event_type")
    amount = (
        F.when(kind == "error", F.lit("-1.00"))
        .when(kind == "signup", F.lit("n/a"))
        .otherwise(F.col("value").cast("decimal(10,2)").cast("string"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("userId"),
        amount.alias("total_billable_hours"),
        week.cast("string").alias("start_date"),
        F.date_add(week, 6).cast("string").alias("end_date"),
        F.col("ts").alias("etl_time"),
    )


def project_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag 0, 1 or NULL; several tasks per project; project 0, which must be dropped."""
    flag = F.when(F.col("p_size") % 8 == 0, F.lit(0)).when(F.col("p_size") % 8 != 1, F.lit(1))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        (F.col("p_partkey") % 500).alias("projectId"),
        flag.alias("isNonBillable"),
    )


def time_entries(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None, numbered: bool = False
) -> DataFrame:
    """Line items as time entries of the ordering customer; some without hours.

    A period, if given, is also expressed on the stored timestamp, so that it reaches the scan.
    ``numbered`` adds an ``id``, different for every entry.
    """
    lines = table(spark, sf_dir, "lineitem")
    if numbered:
        lines = lines.withColumn("id", F.monotonically_increasing_id())
    shipped = F.col("l_shipdate")
    if start:
        lines = lines.where(shipped >= F.lit(start).cast("timestamp_ntz"))
    if end:
        after = date.fromisoformat(end) + timedelta(days=1)
        lines = lines.where(shipped < F.lit(str(after)).cast("timestamp_ntz"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *(["id"] if numbered else []),
        F.col("o_custkey").alias("userId"),
        (F.col("l_partkey") % 500).alias("projectId"),
        shipped.cast("date").alias("entry_date"),
        F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("decimalHours"),
    )


def billable_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hours.entries_on(
        time_entries(spark, sf_dir), hours.billable_projects(project_tasks(spark, sf_dir))
    )


def _orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))


def email_issuer_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed-case emails with many versions; ``seq`` breaks ties of the time."""
    return _orders_with_customer(spark, sf_dir).select(
        F.concat(dotted("c_name"), F.lit("@Corp.Example")).alias("email"),
        F.col("o_orderpriority").alias("issuer_company"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("seq"),
    )


def invoices(spark: SparkSession, sf_dir: str, with_hours: bool = True) -> DataFrame:
    """One invoice per order; each rule fails for some, several for a few.

    ``with_hours=False`` leaves out ``amount_of_hours``, and with it the work to derive it.
    """
    key = F.col("o_orderkey")
    company = F.when(key % 7 == 0, F.lit("Wrong Co")).otherwise(
        F.concat(F.lit(" "), F.upper("o_orderpriority"), F.lit(" "))
    )
    base = _orders_with_customer(spark, sf_dir).select(
        key.alias("invoice_id"),
        F.col("o_custkey").alias("userId"),
        F.concat(dotted("c_name"), F.lit(f"@{DOMAIN}")).alias("email"),
        company.alias("razon_social"),
        F.when(key % 11 == 0, F.lit("000000000000")).otherwise(F.lit(RULES.receiver_id)).alias("rut_receptor"),
        F.when(key % 13 == 0, F.lit("consulting")).otherwise(F.lit(FULL_DESCRIPTION)).alias("description"),
        F.col("o_orderdate").cast("date").alias("invoice_date"),
        F.lit(100.0).alias("rate"),
    )
    if not with_hours:
        return base
    booked = attach_month_to_date(base, billable_entries(spark, sf_dir), "userId", "invoice_date")
    case = F.col("invoice_id") % 3
    drift = F.when(case == 0, F.lit(0.0)).when(case == 1, F.lit(0.005)).otherwise(F.lit(1.0))
    amount = F.coalesce("timesheet_hours", F.lit(8.0)) + drift
    return booked.withColumn("amount_of_hours", amount).drop("timesheet_hours")


def invoice_documents(invoices: DataFrame) -> DataFrame:
    """Each invoice wrapped as an XML document: ``invoice_id, userId, email, xml``."""

    def tag(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))

    first_word = F.substring_index("description", " ", 1)
    rest = F.when(
        F.contains("description", F.lit(" ")), F.expr("substr(description, instr(description, ' ') + 1)")
    ).otherwise(F.lit("general"))
    xml = F.concat(
        F.lit(f'<CFE xmlns="{INVOICE_NAMESPACE}"><Encabezado><Emisor>'),
        tag("RUCEmisor", F.lpad(F.col("userId").cast("string"), 12, "0")),
        tag("RznSoc", F.col("razon_social")),
        F.lit("</Emisor><Receptor>"),
        tag("DocRecep", F.col("rut_receptor")),
        F.lit("</Receptor></Encabezado><Detalle>"),
        tag("Cantidad", F.col("amount_of_hours").cast("string")),
        tag("PrecioUnitario", F.col("rate").cast("string")),
        tag("NomItem", first_word),
        tag("DscItem", rest),
        F.lit("</Detalle>"),
        tag("FchEmis", F.col("invoice_date").cast("string")),
        F.lit("</CFE>"),
    )
    return invoices.select("invoice_id", "userId", "email", xml.alias("xml"))
