"""All layers over one bronze table, each built when first asked for."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, partial

from pyspark.sql import DataFrame, functions as F

from tallystone.functions import text
from tallystone.operators import activity, gold, reports, risk, serving, silver, views
from tallystone.operators.lookup import attach, fits_broadcast
from tallystone.sources.columns import gold_columns
from tallystone.sources.tables import Staged, observe_size, read_table, release_shuffles, scratch_path, stage, write_table
from tallystone.sources.versions import VersionFolder


# Layer -> table of the star.
STAR = {
    "dim_agency": "dim_agency",
    "dim_vendor": "dim_vendor",
    "fact": "fact_transactions_clean",
    "mart_vendor_monthly": "vendor_monthly_spend",
    "mart_agency_category": "agency_category_spend",
    "mart_anomaly": "transaction_anomaly",
    "mart_vendor_risk": "vendor_risk_scores",
}
# What fact and gold need of silver: 14 of its 19 columns, raw texts and time of day left out.
_CORE = [
    "transaction_id", "agency_name_clean", "vendor_name_clean", "mcc_description", "description", "transaction_date",
    "year", "month", "yyyymm", "amount", "category_group", "amount_bucket", "day_of_week", "is_weekend",
]
# What of these the others follow from (see ``silver.derive``).
_TOLD = ["transaction_id", "agency_name_clean", "vendor_name_clean", "mcc_description", "description", "transaction_date", "amount"]
# What rows get from their vendor.
_VENDOR = ["first_seen_month", gold.MATCHED]
# Columns of few values, by which written rows lie together: alike neighbours are short in files and shuffles.
_ALIKE = ["mcc_description", "agency_name_clean", "description"]
# Texts that travel as one.
_TEXTS = ["mcc_description", "agency_name_clean", "description", "vendor_name_clean", "transaction_id"]
# Rows of all months together that come to one share of each month's vendors.
_SHARE_ROWS = 20_000_000
# Layers that, if given, may hold other rows or vendors than silver does.
_ELSEWHERE = {"anomaly", "first_seen", "vendor_monthly", "cleaned"}


class Warehouse:
    """Bronze to views.

    What several layers read is staged (written once, read back with column pruning), whatever its size:
    the cleaned rows, the monthly spend, the lookups, the dimensions, fact and marts. Everything else stays
    a query; what only one reader needs is not written for it. ``write_into`` names the folder that the
    star's tables are written to instead, once each, and read back from by the layers above.
    ``published`` may hold the dimensions of an earlier load, ``dim_agency`` and ``dim_vendor``.
    """

    def __init__(self, bronze: DataFrame | None, published: Mapping[str, DataFrame] | None = None):
        self.bronze = bronze
        self.published = published or {}
        self._given: frozenset[str] = frozenset()
        self._folder: VersionFolder | None = None
        self._by_month: set[str] = set()
        self._dealt = False  # whether the placed rows lie in a folder per month
        self._month_sums: DataFrame | None = None  # placed rows that hold what a vendor's month sums to
        self._monthly_ids: DataFrame | None = None  # monthly spend with the vendors' ids

    @classmethod
    def from_tables(cls, published: Mapping[str, DataFrame] | None = None, **tables: DataFrame) -> Warehouse:
        """Start from layers that are already written, by attribute name (``silver``, ``anomaly``, ...)."""
        warehouse = cls(None, published)
        warehouse._given = frozenset(tables)
        warehouse.__dict__.update(tables)  # where cached_property keeps its values
        return warehouse

    def _has(self, layer: str) -> bool:
        return layer in self.__dict__

    def _kept(self, layer: str, df: DataFrame, always: bool = True, dealt: bool = False) -> DataFrame:
        """A table of the star: written into the version's folder if there is one, else staged, or left a query."""
        if self._folder is not None:
            self._by_month.add(layer)
            return self._folder.write(STAR[layer], df, dealt)
        return stage(df, layer).df if always else df

    def _kept_dimension(self, layer: str, df: DataFrame) -> Staged:
        """The same for a dimension, whose size is counted with the write."""
        if self._folder is None:
            return stage(df, layer, measured=True)
        df, sizes = observe_size(df)
        return Staged(self._folder.write(STAR[layer], df), measured=sizes)

    def write_star(self, folder: VersionFolder) -> None:
        """Write every table of the star into ``folder``; this warehouse reads them from there from now on.

        Tables that are not built yet are written as they are built, those that exist already are copied.
        """
        built = [layer for layer in STAR if self._has(layer)]
        for layer in built:
            value = self.__dict__[layer]
            is_staged = isinstance(value, Staged)
            written = folder.write(STAR[layer], value.df if is_staged else value, dealt=layer in self._by_month)
            self.__dict__[layer] = Staged(written) if is_staged else written
        self._folder = folder
        try:
            self.star()
        finally:
            self._folder = None

    def forget_star(self) -> None:
        """Drop the star's tables, after the folder that they were written into is gone."""
        for layer in STAR:
            self.__dict__.pop(layer, None)
        self.__dict__.pop("named_anomaly", None)
        self._by_month.clear()

    def _build(self, *layers: str) -> None:
        """Build layers that do not depend on each other at the same time.

        Each is a job or two over narrow or small data; one by one they would leave a cluster idle.
        """
        missing = [name for name in layers if name not in self.__dict__]
        if missing:
            with ThreadPoolExecutor(len(missing)) as pool:
                list(pool.map(partial(getattr, self), missing))

    # ---- silver and gold ----

    @cached_property
    def silver(self) -> DataFrame:
        cleaned = stage(silver.build_silver(self.bronze).sortWithinPartitions(*_ALIKE), "silver").df
        release_shuffles(cleaned.sparkSession)  # of the raw rows
        return cleaned

    @cached_property
    def core(self) -> DataFrame:
        """The columns that fact and gold need, written in one pass."""
        if self._has("silver"):
            return self.silver.select(*_CORE)
        return stage(silver.build_silver(self.bronze).select(*_CORE).sortWithinPartitions(*_ALIKE), "core").df

    @cached_property
    def cleaned(self) -> DataFrame:
        """The columns gold needs. Unless silver or its core exist already, only these are written."""
        for layer in ("silver", "core"):
            if self._has(layer):
                return gold_columns(self.__dict__[layer])
        rows = silver.build_silver(self.bronze, silver.GOLD_INPUT).sortWithinPartitions(*_ALIKE[:2])
        return stage(gold_columns(rows), "cleaned").df

    @cached_property
    def vendor_monthly(self) -> DataFrame:
        if not self._has("placed"):
            return stage(gold.vendor_monthly_spend(self.cleaned), "vendor-monthly").df
        # Rows carry their vendors' ids, so the mart is made of these sums as well.
        rows = gold_columns(self.placed, carried=[gold.MATCHED])
        self._monthly_ids = stage(gold.vendor_monthly_spend(rows), "vendor-monthly").df
        return self._monthly_ids.drop(gold.MATCHED)

    @cached_property
    def agency_category(self) -> DataFrame:
        return stage(gold.agency_category_spend(self.cleaned), "agency-category").df

    @cached_property
    def category_stats(self) -> Staged:
        return stage(gold.category_stats(self.cleaned), "category-stats", measured=True)

    @cached_property
    def vendors(self) -> Staged:
        """First month and number of rows by vendor: from the monthly spend when that exists already, as it is far smaller."""
        source = self.vendor_monthly if "vendor_monthly" in self.__dict__ else self.cleaned
        return stage(gold.vendor_first_seen(source, counted=True), "first-seen", measured=True)

    @cached_property
    def first_seen(self) -> Staged:
        return self.vendors.select("vendor_name", "first_seen_month")

    @cached_property
    def anomaly(self) -> DataFrame:
        return stage(self._flagged(), "anomaly").df

    def _flagged(self) -> DataFrame:
        """The anomaly rows as a query over written lookups."""
        self._build("cleaned")
        self._build("category_stats", "first_seen")
        if self._has("placed"):
            return gold.transaction_anomaly(gold_columns(self.placed, carried=_VENDOR), self.category_stats, self.first_seen)
        lookup = self.vendor_lookup if self._has("vendor_lookup") else self.first_seen
        told = not self._given and not fits_broadcast(lookup)  # rows cleaned here travel without what follows from the rest
        rows = self.cleaned.drop("year", "month", "category_group") if told else self.cleaned
        rows = gold.join_first_seen(rows, lookup, rows_per_key=self._rows_per_vendor("vendor_name"))
        if told:
            got = [name for name in _VENDOR if name in rows.columns]
            rows = gold_columns(silver.derive(rows.withColumnRenamed("merchant_category", "mcc_description")), carried=got)
        return gold.transaction_anomaly(rows, self.category_stats, lookup)

    def _rows_per_vendor(self, key: str) -> DataFrame | None:
        """``key, n`` of the cleaned rows, if they were counted with the first months."""
        if not self._has("vendors") or self._given & _ELSEWHERE:
            return None
        return self.vendors.df.select(F.col("vendor_name").alias(key), "n")

    def _vendors_are_many(self) -> bool:
        """Whether a lookup by vendor exceeds a broadcast, and first months and ids are of the same vendors."""
        if self._given & _ELSEWHERE or self._has("anomaly"):
            return False
        return not (fits_broadcast(self.first_seen) and fits_broadcast(self.dim_vendor))

    @cached_property
    def vendor_lookup(self) -> Staged:
        """First month and id by vendor: large, so rows are shuffled to their vendor once for both."""
        return stage(serving.vendor_lookup(self.first_seen, self.dim_vendor), "vendor-lookup", measured=True)

    @cached_property
    def placed(self) -> DataFrame:
        """The rows of fact and anomalies with first month and id of their vendor.

        For a version's folder they lie in a folder per month, so that both tables are written from it as it
        lies. Rows that were cleaned here travel without what follows from the rest of them.
        """
        key, spark = "vendor_name_clean", self.core.sparkSession
        lookup = self.vendor_lookup
        lookup = Staged(lookup.df.withColumnRenamed("vendor_name", key), whole=lookup)
        rows = self.core if self._given else self.core.select(*_TOLD)
        rows = attach(rows, lookup, key, rows_per_key=self._rows_per_vendor(key))
        if self._folder is None:
            rows = stage(rows, "placed").df
        else:
            path = scratch_path(spark, "placed")
            if self._given:
                write_table(rows, path, ["yyyymm"])
            else:
                write_table(self._dealt_rows(rows), path, ["yyyymm"], dealt=True)
            self._dealt = True
            rows = read_table(spark, path)
        if self._given:
            return rows
        derived = silver.derive(rows)
        if gold.SUMS in rows.columns:
            summed = derived.filter(F.col(gold.SUMS).isNotNull())
            self._month_sums = gold_columns(summed, carried=[gold.MATCHED, gold.SUMS])
        return derived.select(*_CORE, *_VENDOR)

    def _dealt_rows(self, rows: DataFrame) -> DataFrame:
        """The rows moved to their month, their texts as one, so that they can be written as they lie.

        Unless a vendor holds too many of them, a month's rows are dealt to shares of its vendors, and one row of each
        vendor and month holds what they sum to: months' spend and scores are written from that without a shuffle.
        """
        texts = [name for name in rows.columns if name in _TEXTS]
        others = [name for name in rows.columns if name not in _TEXTS]
        moved = silver.derive(rows).select(text.pack(texts).alias("_texts"), *others, "yyyymm")
        shares = self._shares()
        if not shares:
            return text.unpack(moved.hint("rebalance", "yyyymm"), "_texts", texts).select(*rows.columns, "yyyymm")
        within = ["_month", gold.SHARE]  # not a name that ``derive`` gives anew, which Spark would take for another column
        moved = moved.withColumnRenamed("yyyymm", "_month").withColumn(gold.SHARE, F.pmod(F.hash(gold.MATCHED), F.lit(shares)))
        moved = text.unpack(moved.repartition(*within), "_texts", texts)
        named = gold_columns(silver.derive(moved), carried=["description", *_VENDOR, *within])
        summed = gold.with_month_sums(named, self.category_stats, within)
        back = {"vendor_name": "vendor_name_clean", "agency_name": "agency_name_clean", "merchant_category": "mcc_description"}
        return summed.withColumnsRenamed(back).select(*rows.columns, gold.SUMS, F.col("_month").alias("yyyymm"))

    def place(self, always: bool = False) -> None:
        """Bring the rows to their vendors once, before fact (or its calendar) and anomalies are both asked for.

        Without ``always`` only if vendors are many; a smaller lookup moves no rows.
        """
        if self._has("fact") or self._has("mart_anomaly") or self._has("anomaly") or self._given & _ELSEWHERE:
            return
        self._build("core")
        self._build("category_stats", "first_seen")
        self._build_dimensions()
        if not (fits_broadcast(self.dim_agency) and fits_broadcast(self.category_stats)):
            return
        if always or self._vendors_are_many():
            self._build("placed")

    def _anomaly_once(self, *lookups: Staged) -> DataFrame:
        """Anomalies for a single reader that attaches ``lookups`` to them.

        Not written for it if nothing is larger than a broadcast, as they are read in one pass then; a
        larger lookup reads its rows several times.
        """
        if not self._has("anomaly"):
            flagged = self._flagged()
            if self._has("placed") or all(fits_broadcast(x) for x in (self.category_stats, self.first_seen, *lookups)):
                return flagged
        return self.anomaly

    @cached_property
    def vendor_risk(self) -> DataFrame:
        return risk.vendor_risk_all_time(self.anomaly)

    # ---- stage tables ----

    @cached_property
    def stage_silver(self) -> DataFrame:
        return serving.stage_silver(self.silver)

    @cached_property
    def stage_vendor_monthly(self) -> DataFrame:
        return serving.stage_vendor_monthly(self.vendor_monthly)

    @cached_property
    def stage_agency_category(self) -> DataFrame:
        return serving.stage_agency_category(self.agency_category)

    @cached_property
    def stage_anomaly(self) -> DataFrame:
        return serving.stage_anomaly(self.anomaly)

    # ---- star ----

    def _name_sources(self, monthly: str) -> list[DataFrame]:
        """Tables that can hold names the dimension needs: silver, a monthly table and the anomalies.

        A monthly table built here from silver already has every name of silver, and so do the
        anomalies built from it; only tables that came from elsewhere have to be scanned as well.
        """
        if monthly == "vendor_monthly" and self._names_are_many():
            return [self.first_seen.df]
        sources = [getattr(self, f"stage_{monthly}")]
        if monthly in self._given:
            sources.append(self.stage_silver)
        if "anomaly" in self._given:
            sources.append(self.stage_anomaly)
        return sources

    def _names_are_many(self) -> bool:
        """Whether first months of too many vendors for a broadcast are there; they hold every vendor once."""
        if self._given & _ELSEWHERE or self._has("vendor_monthly") or not self._has("first_seen"):
            return False
        return not fits_broadcast(self.first_seen)

    @cached_property
    def dim_agency(self) -> Staged:
        candidates = serving.agency_candidates(*self._name_sources("agency_category"))
        return self._kept_dimension("dim_agency", serving.upsert_dim_agency(candidates, self.published.get("dim_agency")))

    @cached_property
    def dim_vendor(self) -> Staged:
        candidates = serving.vendor_candidates(*self._name_sources("vendor_monthly"))
        return self._kept_dimension("dim_vendor", serving.upsert_dim_vendor(candidates, self.published.get("dim_vendor")))

    def _build_dimensions(self) -> None:
        monthly = [] if self._names_are_many() else ["vendor_monthly"]
        if not all(self._has(layer) for layer in [*monthly, "agency_category"]):
            self._build("cleaned")
        self._build(*monthly, "agency_category")
        self._build("dim_agency", "dim_vendor")

    @cached_property
    def fact(self) -> DataFrame:
        return self._kept("fact", self._fact_rows(), dealt=self._dealt)

    def _fact_rows(self) -> DataFrame:
        named = {"agency_name_clean": "agency_name", "vendor_name_clean": "vendor_name"}
        if self._has("placed"):
            rows = serving.stage_silver(self.placed.withColumnsRenamed(named))
        elif self._has("silver"):
            rows = self.stage_silver
        else:
            rows = serving.stage_silver(self.core.withColumnsRenamed(named))
        self._build_dimensions()
        return serving.load_fact(rows, self.dim_agency, self.dim_vendor)

    @cached_property
    def mart_vendor_monthly(self) -> DataFrame:
        if self._has("placed") and not self._has("vendor_monthly"):  # rows carry their vendors' ids
            rows = gold_columns(self.placed, carried=[gold.MATCHED]) if self._month_sums is None else self._month_sums
            shares = self._shares() if self._dealt else 0
            if shares and self._month_sums is None:
                rows = rows.withColumn(gold.SHARE, F.pmod(F.hash("vendor_name"), F.lit(shares))).repartition("year", "month", gold.SHARE)
            staged = serving.stage_vendor_monthly(gold.vendor_monthly_spend(rows))
        elif self._monthly_ids is not None:
            shares, staged = 0, serving.stage_vendor_monthly(self._monthly_ids)
        else:
            shares, staged = 0, self.stage_vendor_monthly
        return self._kept("mart_vendor_monthly", serving.load_vendor_monthly(staged, self.dim_vendor), dealt=shares > 0)

    def _shares(self) -> int:
        """Into how many shares of its vendors a month is dealt, so that sums are written from where they are made.

        None if a vendor holds more than a hundredth of the rows: they are combined before the shuffle then.
        """
        if self._rows_per_vendor("vendor_name") is None:
            return 0
        rows, most = self.vendors.df.agg(F.sum("n"), F.max("n")).first()
        return 0 if not rows or most * 100 > rows else 1 + rows // _SHARE_ROWS

    @cached_property
    def mart_agency_category(self) -> DataFrame:
        loaded = serving.load_agency_category(self.stage_agency_category, self.dim_agency)
        return self._kept("mart_agency_category", loaded, always=False)

    @cached_property
    def mart_anomaly(self) -> DataFrame:
        if not self._has("anomaly"):
            self._build("cleaned")
            self._build("category_stats", "first_seen", "agency_category")
        self._build_dimensions()
        many = self._vendors_are_many()
        if many or self._has("placed"):
            if not self._has("placed"):
                self._build("vendor_lookup")
            flagged = serving.stage_anomaly(self._flagged())
        else:
            flagged = serving.stage_anomaly(self._anomaly_once(self.dim_agency, self.dim_vendor))
        # A view looks up the names of many vendors by shuffling all rows again, so they are written with the rows.
        named = many and self._folder is None
        loaded = serving.load_anomaly(flagged, self.dim_agency, self.dim_vendor, named=named)
        kept = self._kept("mart_anomaly", loaded, dealt=self._dealt)
        if named:
            self.named_anomaly = kept
        return kept.drop(*serving.NAMES)

    @cached_property
    def mart_vendor_risk(self) -> DataFrame:
        summed = self._month_sums is not None
        scored = serving.vendor_risk_monthly(self._month_sums if summed else self.mart_anomaly, self.dim_vendor)
        return self._kept("mart_vendor_risk", scored, always=False, dealt=summed)

    def marts(self) -> dict[str, DataFrame]:
        """Fact and marts by table name."""
        return {table: getattr(self, layer) for layer, table in STAR.items() if not layer.startswith("dim_")}

    def star(self) -> dict[str, DataFrame]:
        self.place(always=True)
        marts = self.marts()  # first: the fact needs more of silver than gold does
        return {"dim_agency": self.dim_agency.df, "dim_vendor": self.dim_vendor.df, **marts}

    @cached_property
    def vendor_activity(self) -> DataFrame:
        return stage(activity.vendor_activity(self.mart_vendor_monthly), "vendor-activity").df

    # ---- views: those that show names only need no ids, and so no dimensions, unless the marts exist ----

    @cached_property
    def v_vendor_monthly_spend(self) -> DataFrame:
        if self._has("mart_vendor_monthly"):
            return views.v_vendor_monthly_spend(self.mart_vendor_monthly)
        return views.v_vendor_monthly_spend(serving.name_vendor_monthly(self.stage_vendor_monthly))

    @cached_property
    def v_agency_category_spend(self) -> DataFrame:
        if self._has("mart_agency_category"):
            return views.v_agency_category_spend(self.mart_agency_category)
        return views.v_agency_category_spend(serving.name_agency_category(self.stage_agency_category))

    @cached_property
    def v_transaction_anomaly(self) -> DataFrame:
        mart = self.mart_anomaly
        return views.v_transaction_anomaly(vars(self).get("named_anomaly", mart), self.dim_agency, self.dim_vendor)

    @cached_property
    def v_vendor_risk_scores(self) -> DataFrame:
        return views.v_vendor_risk_scores(self.mart_vendor_risk)

    @cached_property
    def v_dim_date(self) -> DataFrame:
        """Only the fact's dates are needed: unless it exists, it stays a query, of which few columns are read."""
        return views.v_dim_date(self.fact if self._has("fact") else self._fact_rows())

    @cached_property
    def v_dim_month(self) -> DataFrame:
        return views.v_dim_month(self.v_dim_date)

    @cached_property
    def v_exec_kpi(self) -> DataFrame:
        if self._has("mart_anomaly"):
            flagged = self.mart_anomaly
        else:
            self._build("cleaned")
            self._build("category_stats", "vendor_monthly")
            flagged = serving.name_flags(serving.stage_anomaly(self._anomaly_once()))
        return views.v_exec_kpi(self.v_vendor_monthly_spend, flagged)

    @cached_property
    def kpi_totals(self) -> DataFrame:
        return reports.kpi_totals(self.v_exec_kpi)
