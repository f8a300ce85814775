"""The star schema as written tables, each built when it is first asked for."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from salesloom.config import Settings
from salesloom.operators import clean, dims, fact
from salesloom.sources.contracts import STAGING_TABLES
from salesloom.sources.store import Store

DIMENSIONS = ("dim_date", "dim_customer", "dim_product", "dim_campaign")
TABLES = (*DIMENSIONS, "fact_sales")


class Warehouse:
    """Staging, dimensions, fact and the order summary below one store.

    A table is computed once, written, and from then on read, whichever of marts, reports and
    checks comes first.
    """

    def __init__(
        self,
        spark: SparkSession,
        store: Store,
        settings: Settings,
        raw: Callable[[str], DataFrame] | None = None,
        order_by: dict[str, Sequence[str]] | None = None,
    ):
        self.spark, self.store, self.settings = spark, store, settings
        self._raw, self._order_by = raw, order_by or {}
        self._ready: dict[str, DataFrame] = {}

    @classmethod
    def over_staging(
        cls, spark: SparkSession, store: Store, settings: Settings, staged: dict[str, DataFrame]
    ) -> Warehouse:
        """A warehouse over staging tables that an earlier phase has written."""
        warehouse = cls(spark, store, settings)
        warehouse._ready.update({STAGING_TABLES[source]: df for source, df in staged.items()})
        return warehouse

    def _table(self, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()) -> DataFrame:
        if name not in self._ready:
            self._ready[name] = self.store.save(build(), name, partition_by)
        return self._ready[name]

    def staged(self, source: str) -> DataFrame:
        def cleaned() -> DataFrame:
            if self._raw is None:
                raise LookupError(f"source '{source}' is neither given nor staged in {self.store.root}")
            return clean.transform(source, self._raw(source), self.settings, self._order_by.get(source))

        return self._table(STAGING_TABLES[source], cleaned)

    def staging(self) -> dict[str, DataFrame]:
        return {table: self.staged(source) for source, table in STAGING_TABLES.items()}

    @property
    def dim_date(self) -> DataFrame:
        s = self.settings

        def build() -> DataFrame:
            if s.calendar_start and s.calendar_end:
                return dims.calendar(self.spark, s.calendar_start, s.calendar_end)
            return dims.calendar_covering(self.staged("orders"), "order_date")

        return self._table("dim_date", build)

    @property
    def yoy_years(self) -> tuple[int, int, int]:
        """The years compared: those set, or the last three of the calendar."""
        if self.settings.yoy_years is None:
            last = self.dim_date.agg(F.max("year")).first()[0] or 0
            return (last - 2, last - 1, last)
        return self.settings.yoy_years

    @property
    def dim_customer(self) -> DataFrame:
        return self._table("dim_customer", lambda: dims.customer_dimension(self.staged("customers"), self.store))

    @property
    def dim_product(self) -> DataFrame:
        return self._table("dim_product", lambda: dims.product_dimension(self.staged("products"), self.store))

    @property
    def dim_campaign(self) -> DataFrame:
        return self._table("dim_campaign", lambda: dims.campaign_dimension(self.staged("campaigns"), self.store))

    def prepare(self) -> None:
        """Build what the fact needs, all at once: none of it depends on the rest."""
        builds = (
            lambda: self.staged("order_items"),
            # The orders come first here: the calendar may be bounded by them.
            lambda: (self.staged("orders"), self.dim_date),
            lambda: self.dim_customer,
            lambda: self.dim_product,
            lambda: self.dim_campaign,
        )
        with ThreadPoolExecutor(len(builds)) as pool:
            # Job groups and other local properties of the caller go along.
            for done in [pool.submit(inheritable_thread_target(self.spark)(build)) for build in builds]:
                done.result()

    @property
    def fact_sales(self) -> DataFrame:
        def build() -> DataFrame:
            self.prepare()
            # Written as it is joined: adaptive execution has sized these tasks, and moving the widest table of all once
            # more would only make fewer files.
            return fact.build_fact(
                self.staged("order_items"),
                self.staged("orders"),
                self.dim_date,
                self.dim_customer,
                self.dim_product,
                self.dim_campaign,
            )

        return self._table("fact_sales", build, fact.FACT_PARTITIONS)

    @property
    def fact_rejects(self) -> DataFrame:
        """The lines that the fact leaves out, written like any table."""

        def build() -> DataFrame:
            return fact.fact_rejects(
                self.staged("order_items"), self.staged("orders"), self.dim_date, self.dim_customer, self.dim_product
            )

        return self._table("fact_rejects", build)

    @property
    def order_sales(self) -> DataFrame:
        def build() -> DataFrame:
            return fact.rebalanced(fact.order_sales(self.fact_sales), fact.ORDER_PARTITIONS)

        return self._table("agg_order_sales", build, fact.ORDER_PARTITIONS)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}
