"""Do the raw and std layers agree? Distinct key counts per table and layer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourledger.functions import convert

REPORT_SCHEMA = "label string, raw_count bigint, std_count bigint, status string, error string"


@dataclass(frozen=True)
class LayerCheck:
    label: str
    columns: tuple[str, ...]
    raw: DataFrame
    std: DataFrame


def distinct_count(columns: Sequence[str]) -> Column:
    """Exact distinct count. One column ignores NULL; a row of columns counts NULL parts too."""
    if len(columns) == 1:
        return F.count_distinct(F.col(columns[0]))
    return F.count_distinct(F.struct(*columns))


def layer_counts(df: DataFrame, wanted: Sequence[tuple[str, str, Sequence[str]]]) -> DataFrame:
    """``label, layer, n`` for each ``(label, layer, columns)``, from one scan of ``df``."""
    counts = df.agg(*[distinct_count(columns).alias(f"n{i}") for i, (_, _, columns) in enumerate(wanted)])
    rows = [
        F.struct(F.lit(label).alias("label"), F.lit(layer).alias("layer"), F.col(f"n{i}").alias("n"))
        for i, (label, layer, _) in enumerate(wanted)
    ]
    return counts.select(F.inline(F.array(*rows)))


def consistency_report(checks: Sequence[LayerCheck]) -> DataFrame:
    """``label, raw_count, std_count, status``; checks of the same frame share its scan.

    Only std < raw is a mismatch.
    """
    scans: list[tuple[DataFrame, list[tuple[str, str, Sequence[str]]]]] = []
    for check in checks:
        for layer, df in (("raw", check.raw), ("std", check.std)):
            wanted = next((wanted for seen, wanted in scans if seen is df or seen.sameSemantics(df)), None)
            if wanted is None:
                scans.append((df, wanted := []))
            wanted.append((check.label, layer, check.columns))
    counts = [layer_counts(df, wanted) for df, wanted in scans]

    def of(layer: str) -> Column:
        return F.max(F.when(F.col("layer") == layer, F.col("n")))

    side_by_side = (
        reduce(DataFrame.unionAll, counts)
        .groupBy("label")
        .agg(of("raw").alias("raw_count"), of("std").alias("std_count"))
    )
    status = F.when(F.col("std_count") < F.col("raw_count"), F.lit("MISMATCH")).otherwise(F.lit("OK"))
    return side_by_side.withColumn("status", status)


def report_line(report: DataFrame) -> Column:
    """Fixed wording of one table's result."""
    counts = F.format_string("%s: Raw: %s | Std: %s", "label", "raw_count", "std_count")
    error = F.col("error") if "error" in report.columns else F.lit(None).cast("string")
    return (
        F.when(F.col("status") == "OK", F.concat(F.lit("✅ Consistency OK for "), counts))
        .when(F.col("status") == "MISMATCH", F.concat(F.lit("❌ MISMATCH for "), counts))
        .otherwise(F.concat(F.lit("❌ Error in "), F.col("label"), F.lit(": "), error))
    )


def summary_line(report: DataFrame, labels: Sequence[str], day: date | str) -> DataFrame:
    """One row: ``Jul 11, 2025, <line>, <line>``, tables in the order of ``labels``."""
    position = F.array_position(F.array(*[F.lit(label) for label in labels]), F.col("label"))
    lines = F.sort_array(F.collect_list(F.struct(position.alias("position"), report_line(report).alias("line"))))
    text = F.concat_ws(", ", convert.long_day(convert.day_literal(day)), F.col("lines.line"))
    return report.agg(lines.alias("lines")).select(text.alias("report"))
