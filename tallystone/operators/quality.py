"""Quality of what a load writes: metrics counted by the write itself, held against limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallystone.functions.rules import REQUIRED_COLUMNS

# Columns whose least and greatest value are kept: numbers as they are, dates as days since 1970.
RANGES = {
    "fact_transactions_clean": ["transaction_date", "yyyymm", "amount"],
    "vendor_monthly_spend": ["yyyymm", "txn_count", "total_spend"],
    "agency_category_spend": ["yyyymm", "txn_count", "total_spend"],
    "transaction_anomaly": ["transaction_date", "amount"],
    "vendor_risk_scores": ["risk_score"],
}
# Flags whose share of the rows is kept.
SHARES = {"transaction_anomaly": ["is_outlier", "is_new_vendor", "is_high_amount"]}


@dataclass(frozen=True)
class Limit:
    """What a metric of a table may be; without a column for metrics of whole rows."""

    table: str
    metric: str
    column: str | None
    at_least: float | None = None
    at_most: float | None = None

    def holds(self, value: float | None) -> bool:
        """A metric without a value (of an empty table) keeps every limit but that on the number of rows."""
        if value is None:
            return True
        return (self.at_least is None or value >= self.at_least) and (self.at_most is None or value <= self.at_most)


def default_limits() -> list[Limit]:
    """No empty table, no NULL in a required column, positive amounts, dates of this and the last century, at most a fifth outliers."""
    found = [Limit(table, "rows", None, at_least=1) for table in REQUIRED_COLUMNS]
    found += [Limit(table, "nulls", c, at_most=0) for table, columns in REQUIRED_COLUMNS.items() for c in columns]
    # Days from 1900-01-01 to 2099-12-31.
    found += [Limit(t, m, "transaction_date", -25_567, 47_481) for t in ("fact_transactions_clean", "transaction_anomaly") for m in ("least", "most")]
    found += [Limit(t, "least", "amount", at_least=0.01) for t in ("fact_transactions_clean", "transaction_anomaly")]
    found += [Limit("vendor_risk_scores", "least", "risk_score", at_least=0), Limit("vendor_risk_scores", "most", "risk_score", at_most=100)]
    return [*found, Limit("transaction_anomaly", "share", "is_outlier", at_most=0.2)]


def measures(table: str, df: DataFrame) -> Sequence[Column]:
    """Aggregates for ``DataFrame.observe``, named ``metric`` or ``metric column``; for tables of the star only."""
    if table not in REQUIRED_COLUMNS:
        return []
    types = dict(df.dtypes)

    def number(column: str) -> Column:
        value = F.unix_date(column) if types[column] == "date" else F.col(column)
        return value.cast("double")

    found = [F.count(F.lit(1)).cast("double").alias("rows")]
    found += [F.count_if(F.col(c).isNull()).cast("double").alias(f"nulls {c}") for c in REQUIRED_COLUMNS[table]]
    for column in RANGES.get(table, ()):
        found += [F.min(number(column)).alias(f"least {column}"), F.max(number(column)).alias(f"most {column}")]
    found += [F.avg(F.col(c).cast("int")).alias(f"share {c}") for c in SHARES.get(table, ())]
    return found


def metric_rows(spark: SparkSession, metrics: Mapping[str, Mapping[str, float | None]]) -> DataFrame:
    """``table_name, metric, column_name, value``: a row per metric, a few dozen per load."""
    rows = []
    for table, values in metrics.items():
        for name, value in values.items():
            metric, _, column = name.partition(" ")
            rows.append((table, metric, column or None, None if value is None else float(value)))
    return spark.createDataFrame(rows, "table_name string, metric string, column_name string, value double")


def breaches(metrics: DataFrame, limits: Sequence[Limit]) -> DataFrame:
    """The metrics that break a limit, with it: ``table_name, metric, column_name, value, at_least, at_most``."""
    rows = [(x.table, x.metric, x.column, None if x.at_least is None else float(x.at_least), None if x.at_most is None else float(x.at_most)) for x in limits]
    schema = "table_name string, metric string, column_of_limit string, at_least double, at_most double"
    found = metrics.join(F.broadcast(metrics.sparkSession.createDataFrame(rows, schema)), ["table_name", "metric"])
    outside = (F.col("value") < F.col("at_least")) | (F.col("value") > F.col("at_most"))
    return found.filter(F.col("column_name").eqNullSafe(F.col("column_of_limit")) & outside).drop("column_of_limit")


def check_quality(metrics: Mapping[str, Mapping[str, float | None]], limits: Sequence[Limit]) -> None:
    """Raise when a metric breaks a limit. No job: the metrics came with the write."""
    broken = []
    for x in limits:
        value = metrics.get(x.table, {}).get(x.metric if x.column is None else f"{x.metric} {x.column}")
        if not x.holds(value):
            broken.append(f"{x.table}: {x.metric} {x.column or ''} is {value:g}, limits {x.at_least} to {x.at_most}")
    if broken:
        raise ValueError("quality check failed: " + "; ".join(broken))


def shrunk(metrics: Mapping[str, Mapping[str, float | None]], previous: DataFrame, least_share: float) -> list[Limit]:
    """Limits that keep every table at ``least_share`` of the rows it had in the previous load, at least."""
    rows = previous.filter("metric = 'rows'").select("table_name", "value").collect()
    return [Limit(r["table_name"], "rows", None, at_least=least_share * (r["value"] or 0)) for r in rows if r["table_name"] in metrics]
