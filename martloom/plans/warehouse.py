"""All models over one set of input tables.

Every model is a lazy DataFrame; nothing runs until one is used. ``run`` stores dimensions and facts and returns a
warehouse whose marts read the stored tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from copy import copy
from datetime import UTC, date, datetime, time
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators import ad_marts, dimensions, facts, sales_marts
from martloom.operators.changes import Source, month_of, period_digests
from martloom.operators.common import moment
from martloom.operators.incremental import FactTable, month_of_key
from martloom.operators.staging import STAGED, stage
from martloom.operators.stored_marts import StoredMart, budget_inputs
from martloom.session import scanned_bytes, tune
from martloom.sources import star
from martloom.sources.files import save_table
from martloom.sources.star import RunDates

DIMENSIONS = (
    "dim_customer dim_product dim_campaign dim_adset dim_ad dim_date dim_order_status dim_payment_method"
    " dim_warehouse dim_status"
).split()
FACTS = tuple(facts.LOADS)
MARTS = (
    "product_performance customer_segmentation sales_by_region inventory_analysis campaign_performance"
    " ad_effectiveness targeting_analysis budget_utilization"
).split()


STORED_MARTS = ("budget_utilization",)
# The inputs whose rows become rows of a fact, for loads that follow changes of the source.
SOURCES = {
    "fact_sales": Source("Orders", "order_date", "Order_Items", "order_id"),
    "fact_order_summary": Source("Orders", "order_date", "Order_Items", "order_id"),
    "fact_inventory": Source("Inventory", "last_restocked"),
    "fact_ad_performance": Source("Ad_Insights", "date"),
    "fact_adset_performance": Source("Ad_Insights", "date"),
    "fact_campaign_spend": Source("Ad_Spend", "date"),
}
# A fact whose rows come of two large tables is built in one part per so many bytes of their files, one after the other, so
# that what is shuffled at a time does not grow with them. Each part reads the tables again, hence the bound.
PART_BYTES, MOST_PARTS = 1 << 29, 8


class Warehouse:
    """Models over the ten input tables (by table name), for given run dates. ``warehouse[name]`` is a model."""

    def __init__(
        self, spark: SparkSession, inputs: Mapping[str, DataFrame], dates: RunDates | None = None,
        run_ts: datetime | None = None,
    ):
        """run_ts: the time of the run for audit columns; without it models have none."""
        self.spark = tune(spark)
        self.run_ts = run_ts
        self.inputs = inputs
        self._dates = dates
        self.tables: dict[str, DataFrame] = {}

    @property
    def dates(self) -> RunDates:
        return self._dates

    @property
    def as_of(self) -> date:
        return self.dates.as_of

    @property
    def loaded_at(self) -> Column:
        """The run counts as loaded at midnight of the report day."""
        return moment(datetime.combine(self.as_of, time()))

    def calendar(self, name: str) -> DataFrame:
        """The days a model looks its dates up in: at least all days of its own inputs."""
        return self["dim_date"]

    def __getitem__(self, name: str) -> DataFrame:
        """A model: the stored table if there is one, else its query, set up once."""
        if name not in self.tables:
            if name in STAGED:
                self.tables[name] = stage(name, self.inputs[STAGED[name]])
            elif name in DIMENSIONS:
                self.tables[name] = self.dimension(name)
            elif name in FACTS:
                self.tables[name] = self.fact(name)
            else:
                self.tables[name] = self.mart(name)
        return self.tables[name]

    def dimension(self, name: str) -> DataFrame:
        match name:
            case "dim_customer":
                return dimensions.dim_customer(self["stg_customers"], run_ts=self.run_ts)
            case "dim_product":
                return dimensions.dim_product(self["stg_products"], run_ts=self.run_ts)
            case "dim_campaign":
                return dimensions.dim_campaign(self["stg_campaigns"], run_ts=self.run_ts)
            case "dim_adset":
                return dimensions.dim_adset(self["stg_adsets"], self["dim_campaign"], self.loaded_at, run_ts=self.run_ts)
            case "dim_ad":
                return dimensions.dim_ad(self["stg_ads"], self["dim_adset"], run_ts=self.run_ts)
            case "dim_date":
                return dimensions.dim_date(self.spark, self.dates.start, self.dates.end)
            case "dim_order_status":
                return dimensions.dim_order_status(self["stg_orders"], run_ts=self.run_ts)
            case "dim_payment_method":
                return dimensions.dim_payment_method(self["stg_orders"], run_ts=self.run_ts)
            case "dim_warehouse":
                return dimensions.dim_warehouse(self["stg_inventory"], run_ts=self.run_ts)
            case "dim_status":
                return dimensions.dim_status(self["stg_campaigns"], self["stg_adsets"], self["stg_ads"], run_ts=self.run_ts)
        raise KeyError(name)

    def fact(self, name: str, after=None) -> DataFrame:
        """The query of a fact; ``after`` is the high-water mark of an incremental load."""
        days = self.calendar(name)
        match name:
            case "fact_sales":
                return facts.fact_sales(
                    self["stg_order_items"], self["stg_orders"], self["dim_customer"], self["dim_product"], days,
                    after=after, run_ts=self.run_ts,
                )
            case "fact_order_summary":
                return facts.fact_order_summary(
                    self["stg_orders"], self["stg_order_items"], self["dim_customer"], days, after=after, run_ts=self.run_ts
                )
            case "fact_inventory":
                return facts.fact_inventory(self["stg_inventory"], self["dim_product"], days, after=after, run_ts=self.run_ts)
            case "fact_ad_performance":
                return facts.fact_ad_performance(self["stg_ad_insights"], self["dim_ad"], days, after=after, run_ts=self.run_ts)
            case "fact_adset_performance":
                return facts.fact_adset_performance(
                    self["stg_ad_insights"], self["stg_ads"], self["dim_adset"], days, after=after, run_ts=self.run_ts
                )
            case "fact_campaign_spend":
                return facts.fact_campaign_spend(
                    self["stg_ad_spend"], self["dim_campaign"], self["dim_adset"], days, after=after, run_ts=self.run_ts
                )
        raise KeyError(name)

    def fact_in_parts(self, name: str, after=None, part_bytes: int = PART_BYTES) -> list[DataFrame]:
        """The rows of a fact in one or several queries, each over the source rows whose shared keys fall into it."""
        source = SOURCES[name]
        if not source.details:
            return [self.fact(name, after)]
        tables = {t: self.inputs[t] for t in source.tables}
        parts = max(1, min(-(-scanned_bytes(*tables.values()) // part_bytes), MOST_PARTS))
        if parts == 1:
            return [self.fact(name, after)]
        which = F.pmod(F.xxhash64(F.col(source.key).cast("bigint")), F.lit(parts))
        built = []
        for nth in range(parts):
            some = copy(self)
            staged = {model: tables[t].where(which == nth) for model, t in STAGED.items() if t in tables}
            some.tables = {**self.tables, **{model: stage(model, rows) for model, rows in staged.items()}}
            built.append(some.fact(name, after))
        return built

    def of_periods(self, name: str, periods: list[int]) -> Warehouse:
        """The models over the source rows of a fact that lie in some months (yyyymm); the filter sits on the source."""
        source = SOURCES[name]
        rows = self.inputs[source.table].where(month_of(F.col(source.time_column)).isin(periods))
        return Warehouse(self.spark, {**self.inputs, source.table: rows}, self.dates, self.run_ts)

    def fact_of_periods(self, name: str, periods: list[int]) -> DataFrame:
        """The rows of a fact whose source rows lie in some months (yyyymm)."""
        return self.of_periods(name, periods).fact(name)

    def load_changes(self, name: str, table: FactTable) -> list[int]:
        """Bring a stored fact to what its inputs say now, month by month; the months that were built again."""
        return table.load_changes(
            period_digests(self.inputs, SOURCES[name]), lambda p: self.of_periods(name, p).fact_in_parts(name)
        )

    def update_budget(self, stored: StoredMart) -> int:
        """Bring a stored budget mart to what the facts say now, campaign by campaign; the number of campaigns built."""
        spend, performance = self["fact_campaign_spend"], self["fact_ad_performance"]
        ad, adset, campaign = self.hierarchy

        def build(changed: DataFrame) -> DataFrame:
            # The campaign is joined by all that follows, so nothing of the others comes through.
            those = campaign.join(changed, "campaign_key", "left_semi")
            days = self.calendar("budget_utilization")
            return ad_marts.budget_utilization(spend, performance, ad, adset, those, days, run_ts=self.run_ts)

        return stored.update(budget_inputs(spend, performance, adset, campaign), build)

    @property
    def hierarchy(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self["dim_ad"], self["dim_adset"], self["dim_campaign"]

    def mart(self, name: str, **limits) -> DataFrame:
        """The query of a mart, if wanted with other limits than the standard ones."""
        days = self.calendar(name)
        limits["run_ts"] = self.run_ts
        match name:
            case "product_performance":
                return sales_marts.product_performance(
                    self["fact_sales"], self["fact_inventory"], self["dim_product"], days, **limits
                )
            case "customer_segmentation":
                return sales_marts.customer_segmentation(
                    self["fact_order_summary"], self["fact_sales"], self["dim_customer"], self["dim_product"], days,
                    self.as_of, **limits,
                )
            case "sales_by_region":
                return sales_marts.sales_by_region(self["fact_sales"], self["dim_customer"], days, **limits)
            case "inventory_analysis":
                return sales_marts.inventory_analysis(
                    self["fact_inventory"], self["fact_sales"], self["dim_product"], self["dim_warehouse"], days,
                    self.as_of, **limits,
                )
            case "campaign_performance":
                return ad_marts.campaign_performance(
                    self["fact_ad_performance"], self["fact_campaign_spend"], *self.hierarchy, days, **limits
                )
            case "ad_effectiveness":
                return ad_marts.ad_effectiveness(self["fact_ad_performance"], *self.hierarchy, **limits)
            case "targeting_analysis":
                return ad_marts.targeting_analysis(self["fact_ad_performance"], *self.hierarchy, **limits)
            case "budget_utilization":
                return ad_marts.budget_utilization(
                    self["fact_campaign_spend"], self["fact_ad_performance"], *self.hierarchy, days, **limits
                )
        raise KeyError(name)

    def run(
        self, folder: str, look_back_days: int = 0, run_ts: datetime | None = None, corrections: bool = False
    ) -> Warehouse:
        """A whole run into stored tables, and the warehouse that reads them.

        Dimensions are rebuilt in full. Facts are loaded above their high-water mark, or in full the first time. Marts
        stay queries over the stored tables, except the budget mart, which is stored too. Audit columns get ``run_ts``, the
        time of the run (the present one in UTC if none is given).

        With ``corrections``, facts are compared with their source by month instead, and months that differ are built again:
        late, changed and deleted source rows arrive, at the price of reading the source. The budget mart is then built again for
        the campaigns whose inputs differ. A folder is to be loaded in the same way every time.
        """
        folder = folder.rstrip("/")
        kept = Warehouse(self.spark, self.inputs, self.dates, run_ts or datetime.now(UTC).replace(tzinfo=None))
        for name in DIMENSIONS:
            kept.tables[name] = save_table(kept[name], f"{folder}/{name}")
        for name, (key, time_column, date_key) in facts.LOADS.items():
            table = FactTable(self.spark, f"{folder}/{name}", key, time_column, month_of_key(date_key))
            if corrections:
                kept.load_changes(name, table)
            else:
                table.load(lambda mark, name=name: kept.fact_in_parts(name, mark), look_back_days)
            stored = table.read()
            kept.tables[name] = kept.fact(name).where("false") if stored is None else stored
        if corrections:
            mart = StoredMart(self.spark, f"{folder}/{STORED_MARTS[0]}", "campaign_key", "full_date")
            kept.update_budget(mart)
            stored = mart.read()
            kept.tables[STORED_MARTS[0]] = kept[STORED_MARTS[0]].where("false") if stored is None else stored
        else:
            for name in STORED_MARTS:
                kept.tables[name] = save_table(kept[name], f"{folder}/{name}")
        return kept


# The table of the sample whose time column a model looks up in the calendar.
TIMED = {
    **dict.fromkeys(("fact_sales", "fact_order_summary", "product_performance", "customer_segmentation"), "orders"),
    **dict.fromkeys(("sales_by_region", "inventory_analysis"), "orders"),
    "fact_inventory": "lineitem",
    **dict.fromkeys(("fact_ad_performance", "fact_adset_performance", "fact_campaign_spend"), "events"),
    **dict.fromkeys(("campaign_performance", "budget_utilization"), "events"),
}


class StarWarehouse(Warehouse):
    """The models over a star-schema sample, whose run dates come from the data.

    A model reads the time column of its own table only, as part of its query: its calendar is a row of bounds turned into
    days. The report day is read from the orders, and only by models that use it.
    """

    inputs: star.StarTables

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, star.StarTables(spark, folder))

    @cached_property
    def dates(self) -> RunDates:
        return star.run_dates(self.inputs.raw)

    @cached_property
    def as_of(self) -> date:
        return star.report_day(self.inputs.raw).first()["day"]

    @property
    def loaded_at(self) -> Column:
        return star.report_day(self.inputs.raw).select(F.col("day").cast("timestamp_ntz")).scalar()

    def calendar(self, name: str) -> DataFrame:
        table = TIMED.get(name)
        if table is None:
            return self["dim_date"]
        if f"days of {table}" not in self.tables:
            self.tables[f"days of {table}"] = dimensions.dim_date_dynamic(star.date_bounds(self.inputs.raw, table))
        return self.tables[f"days of {table}"]
