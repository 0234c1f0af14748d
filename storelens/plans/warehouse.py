"""The written layers: every table is built once, from the written tables it depends on."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock, RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.plans import gold, silver
from storelens.plans.versions import Versions
from storelens.schemas import GOLD, SILVER
from storelens.session import COMPRESSION, path_exists, staging_area

# Written beside the gold tables for the facts to share; not part of the star.
HEADER = "_order_header"

FACTS = frozenset(("FactOrderItems", "FactPayments", "FactReviews"))


class Warehouse:
    """Silver and gold under ``root``, as Parquet.

    A table is written when it is first asked for, together with what it depends on, and read from then
    on; a silver table that only one gold table reads is planned into that one, unless it is written already. Nothing is taken over from an earlier run: ``root`` belongs to one build, and no table in it is written twice. Orders
    bought outside ``bounds`` would drop out of what joins the calendar; they fail the build of the facts. Facts lie in folders by purchase
    year and month; ``partitioned=False`` keeps the two columns in the files, for a shop whose months are small.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        bronze: Callable[[str], DataFrame],
        bounds: DataFrame,
        regions: DataFrame,
        partitioned: bool = True,
    ):
        self.spark, self.root, self.bronze = spark, root, bronze
        self.partitioned = partitioned
        self._bounds, self._regions = bounds, regions
        self._tables: dict[tuple[str, str], DataFrame] = {}
        self._locks: dict[tuple[str, str], RLock] = defaultdict(RLock)
        self._guard = Lock()

    def silver(self, name: str) -> DataFrame:
        return self._table("silver", name, lambda: silver.build(name, self.bronze))

    def gold(self, name: str) -> DataFrame:
        return self._table("gold", name, lambda: self.gold_plan(name))

    def star(self, name: str) -> DataFrame:
        """A gold table with its published columns only."""
        return self.gold(name).drop(*gold.FACT_PARTITIONS)

    def register(self, prefix: str = "") -> None:
        """Views over the star for SQL users: facts, dimensions and the bridge, by their own names."""
        for name in GOLD:
            self.star(name).createOrReplaceTempView(f"{prefix}{name}")

    def gold_plan(self, name: str) -> DataFrame:
        """The plan of a gold table over the written tables below it."""
        s, g, alone = self.silver, self.gold, self._silver_rows
        match name:
            case "DimDate":
                return gold.dim_date(self._bounds)
            case "DimCustomer":
                return gold.dim_customer(s("customers"))
            case "_bridge_customer":
                return gold.bridge_customer(s("customers"), g("DimCustomer"))
            case "DimProduct":
                return gold.dim_product(alone("products"))
            case "DimSeller":
                return gold.dim_seller(s("sellers"))
            case "DimGeography":
                return gold.dim_geography(s("customers"), s("sellers"), self._regions)
            case "_order_header":
                return gold.within(gold.order_header(alone("orders"), g("_bridge_customer")), self._bounds)
            case gold.ORDER_NUMBERS:
                return gold.order_numbers(g(HEADER))
            case "FactOrderItems":
                self._together(g, (HEADER, "DimProduct", "DimSeller"))
                return gold.fact_order_items(alone("order_items"), g(HEADER), g("DimProduct"), g("DimSeller"))
            case "FactPayments":
                return gold.fact_payments(alone("order_payments"), g(HEADER))
            case "FactReviews":
                return gold.fact_reviews(alone("order_reviews"), g(HEADER))
        raise KeyError(name)

    def _silver_rows(self, name: str) -> DataFrame:
        """A silver table for its only reader: as written, or else as a plan."""
        return self.silver(name) if ("silver", name) in self._tables else silver.build(name, self.bronze)

    def build_silver(self) -> None:
        self._together(self.silver, SILVER)

    def build_gold(self) -> None:
        self._together(self.gold, [*GOLD, gold.ORDER_NUMBERS])

    def _together(self, build: Callable[[str], DataFrame], names: Iterable[str]) -> None:
        """Submit the tables side by side, so that small ones do not hold up the cluster one by one."""
        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(build, names))

    def _table(self, layer: str, name: str, plan: Callable[[], DataFrame]) -> DataFrame:
        key = (layer, name)
        with self._guard:
            lock = self._locks[key]
        with lock:
            # A table whose files are gone is built again.
            if key not in self._tables or not path_exists(self.spark, self._path(layer, name)):
                with staging_area(self.spark):
                    self._tables[key] = self._write(plan(), layer, name)
            return self._tables[key]

    def _path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def _write(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        path = self._path(layer, name)
        if name in FACTS and self.partitioned:
            # AQE sizes the write tasks: small months share one, a large month is split.
            placed = df.hint("rebalance", *[F.col(c) for c in gold.FACT_PARTITIONS])
            placed.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*gold.FACT_PARTITIONS).parquet(path)
        else:
            df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


class Lake(Warehouse):
    """The live version of a lake, opened for reading: nothing is built and nothing is written.

    The version is looked up once, here. A build that is published later is seen by lakes opened after it.
    """

    def __init__(self, spark: SparkSession, lake: str):
        live = Versions(spark, lake).live()
        if live is None:
            raise FileNotFoundError(f"{lake} holds no finished build")
        super().__init__(spark, live, self._no_source, None, None)

    @staticmethod
    def _no_source(name: str) -> DataFrame:
        raise LookupError(f"an opened lake does not read bronze: {name}")

    def _table(self, layer: str, name: str, plan: Callable[[], DataFrame]) -> DataFrame:
        key = (layer, name)
        if key not in self._tables:
            if not path_exists(self.spark, self._path(layer, name)):
                raise LookupError(f"the lake has no {layer} table {name}")
            self._tables[key] = self.spark.read.parquet(self._path(layer, name))
        return self._tables[key]
