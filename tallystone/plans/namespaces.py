"""The layers under SQL names: ``stage_*``, ``corp_*`` and ``bi_*`` temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallystone.operators import serving
from tallystone.plans.warehouse import STAR, Warehouse
from tallystone.sources.tables import Staged, read_table
from tallystone.sources.versions import current_tables

# corp table -> warehouse layer
_CORP = {table: layer for layer, table in STAR.items()}
_STAGE = {
    "silver_spend_clean_raw": "stage_silver",
    "gold_vendor_monthly_raw": "stage_vendor_monthly",
    "gold_agency_category_raw": "stage_agency_category",
    "gold_anomaly_raw": "stage_anomaly",
}
_BI = [
    "v_vendor_monthly_spend", "v_agency_category_spend", "v_transaction_anomaly", "v_vendor_risk_scores",
    "v_dim_date", "v_dim_month", "v_exec_kpi",
]


def published_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """A warehouse over the star that is currently published under ``root``, for its views and reports."""
    tables = current_tables(spark, root, list(_CORP))
    if not tables:
        raise FileNotFoundError(f"nothing has been published under {root}")
    layers = {_CORP[name]: Staged(df) if name.startswith("dim_") else df for name, df in tables.items()}
    return Warehouse.from_tables(**layers)


def open_published(spark: SparkSession, root: str, data: str | None = None) -> list[str]:
    """All views over the star published under ``root``, in any session, with one call; returns their names.

    With ``data``, the folder that the jobs write to, the ``stage_*`` views over its silver and gold
    tables as well.
    """
    names = register(published_warehouse(spark, root))
    if data is not None:
        typed = {
            "silver_spend_clean_raw": (serving.stage_silver, "silver/spend_clean"),
            "gold_vendor_monthly_raw": (serving.stage_vendor_monthly, "gold/vendor_monthly_spend"),
            "gold_agency_category_raw": (serving.stage_agency_category, "gold/agency_category_spend"),
            "gold_anomaly_raw": (serving.stage_anomaly, "gold/transaction_anomaly"),
        }
        for name, (to_stage, folder) in typed.items():
            to_stage(read_table(spark, f"{data}/{folder}.parquet")).createOrReplaceTempView(f"stage_{name}")
            names.append(f"stage_{name}")
    return sorted(names)


def register(warehouse: Warehouse, stage_tables: bool = False) -> list[str]:
    """Create the temporary views for SQL users and return their names.

    A published star holds no stage tables: see ``open_published``.
    """
    if stage_tables and warehouse.bronze is None and "silver" not in vars(warehouse):
        raise ValueError("a published star has no stage tables; open_published(spark, root, data) reads them from the jobs' folder")
    corp = {f"corp_{name}": getattr(warehouse, layer) for name, layer in _CORP.items()}
    views = corp | {f"bi_{name}": getattr(warehouse, name) for name in _BI}
    if stage_tables:
        views |= {f"stage_{name}": getattr(warehouse, layer) for name, layer in _STAGE.items()}
    for name, layer in views.items():
        df: DataFrame = layer.df if isinstance(layer, Staged) else layer
        df.createOrReplaceTempView(name)
    return sorted(views)
