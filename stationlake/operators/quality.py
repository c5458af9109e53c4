"""Named validation rules, quarantine, and data-quality metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.operators.ingest import Landing, any_unfit, key_text, wanted

Rules = Mapping[str, Column]


def not_null(*columns: str) -> dict[str, Column]:
    return {f"{c}_not_null": F.col(c).isNotNull() for c in columns}


def at_least_zero(*columns: str) -> dict[str, Column]:
    return {f"{c}_negative": F.col(c) >= 0 for c in columns}


def between(low: float, high: float, *columns: str) -> dict[str, Column]:
    return {f"{c}_range": F.col(c).between(low, high) for c in columns}


def with_violations(rows: DataFrame, rules: Rules) -> DataFrame:
    """Add ``violations``: names of the rules a row breaks. As with a CHECK
    constraint, a test that comes out NULL is passed."""
    broken = [F.when(~F.coalesce(test, F.lit(True)), F.lit(name)) for name, test in rules.items()]
    return rows.withColumn("violations", F.array_compact(F.array(*broken)))


def kept(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("violations") == 0).drop("violations")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("violations") > 0)


def violation_rows(checked: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One row per broken rule: table, row key as text, rule name."""
    return rejected(checked).select(
        F.lit(table).alias("gold_table"),
        F.concat_ws("|", *(F.col(k).cast("string") for k in keys)).alias("row_key"),
        F.explode("violations").alias("rule"),
    )


# Default thresholds. A value passes when it is at most its threshold, except
# the row count, which must be at least that.
THRESHOLDS = {
    "row_count": 1.0,
    "null_key_count": 0.0,
    "cast_failure_count": 0.0,
    "duplicate_rate": 1.0,
    "orphan_count": 0.0,
    "bound_violation_count": 0.0,
    "rejected_rate": 5.0,
}
UNITS = {name: "pct" if name.endswith("rate") else "rows" for name in THRESHOLDS}


def _count(test: Column) -> Column:
    return F.count(F.when(test, F.lit(1)))


def _raw_counts(landing: Landing, mode: str) -> dict[str, Column]:
    relevant = wanted(landing, mode)
    keyless = F.col("station_id").isNull()
    if not landing.info_only:
        keyless = keyless | key_text("station_status_last_reported", landing, mode).isNull()
    bad = relevant & any_unfit(landing, mode)
    return {
        "row_count": F.count(F.lit(1)),
        "null_key_count": _count(keyless),
        "cast_failure_count": _count(bad),
        "good": _count(relevant) - _count(bad),
    }


def _checked_counts() -> dict[str, Column]:
    orphan = F.array_contains("violations", "station_unknown")
    others = F.size(F.array_remove("violations", "station_unknown"))
    return {
        "stored": F.count(F.lit(1)),
        "orphan_count": _count(orphan),
        "bound_violation_count": _count(others > 0),
        "rejected": _count(F.size("violations") > 0),
    }


def _named(columns: Mapping[str, Column], prefix: str) -> list[Column]:
    return [c.alias(f"{prefix}{name}") for name, c in columns.items()]


def quality_metrics(
    raw: DataFrame,
    checked: Sequence[tuple[Landing, DataFrame]],
    mode: str = "batch",
    thresholds: Mapping[str, float] = THRESHOLDS,
) -> DataFrame:
    """One row per metric and dataset.

    ``checked`` pairs each bronze table with the validated rows that this load
    landed (with ``violations``): rates compare them with the load's raw rows.
    One partially aggregated pass over the raw rows serves
    all datasets, one more runs over each dataset's validated rows; only their
    single result rows meet.
    """
    prefixed = [(f"d{i}_", landing, rows) for i, (landing, rows) in enumerate(checked)]
    counts = raw.agg(
        *(c for prefix, landing, _ in prefixed for c in _named(_raw_counts(landing, mode), prefix))
    )
    for prefix, _, rows in prefixed:
        counts = counts.unionByName(
            rows.agg(*_named(_checked_counts(), prefix)), allowMissingColumns=True
        )
    total = counts.agg(*(F.max(c).cast("double").alias(c) for c in counts.columns))

    def pct(part: Column, whole: str) -> Column:
        share = 100.0 * part / F.nullif(F.col(whole), F.lit(0.0))
        return F.coalesce(F.round(share, 4), F.lit(0.0))

    cells = []
    for prefix, landing, _ in prefixed:
        good, stored = f"{prefix}good", f"{prefix}stored"
        rates = {
            "duplicate_rate": pct(F.col(good) - F.col(stored), good),
            "rejected_rate": pct(F.col(f"{prefix}rejected"), stored),
        }
        for name, threshold in thresholds.items():
            if landing.info_only and name == "orphan_count":
                continue
            value = rates[name] if name in rates else F.col(f"{prefix}{name}")
            cells += [
                F.lit(name),
                value,
                F.lit(float(threshold)),
                F.lit(UNITS[name]),
                F.lit(landing.name),
            ]
    metrics = total.select(
        F.stack(F.lit(len(cells) // 5), *cells).alias(
            "metric_name", "metric_value", "threshold", "unit", "dataset"
        )
    )
    enough = F.when(
        F.col("metric_name") == "row_count", F.col("metric_value") >= F.col("threshold")
    ).otherwise(F.col("metric_value") <= F.col("threshold"))
    return metrics.withColumn("status", F.when(enough, F.lit("PASS")).otherwise(F.lit("FAIL")))


def as_audit_rows(metrics: DataFrame) -> DataFrame:
    """Metrics with run time and a content key, for the append-only audit log."""
    return metrics.withColumn("run_ts", F.current_timestamp()).withColumn(
        "dq_id",
        F.sha2(
            F.concat_ws("|", "dataset", "metric_name", "run_ts", "metric_value", "status"), 256
        ),
    )
