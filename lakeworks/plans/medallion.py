"""The whole commerce run, layer by layer; every layer reads what the one before has stored."""

from __future__ import annotations

import re

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from lakeworks.plans import cube, gold, kpis
from lakeworks.plans.silver import SILVER, SOURCE_TYPES
from lakeworks.session import shuffles_freed, work_folder
from lakeworks.sources import lakehouse, views

# Two silver tables keep their schema on rewrite, the others may change it.
FIXED_SCHEMA = {"customers", "exchange_rates"}

WRITERS = 5

_runs: dict[tuple[str, str], tuple["Medallion", set[str]]] = {}
_lock = Lock()


def _together(names: Iterable[str], write: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """Independent writes submitted side by side, so that small tables do not queue behind large ones."""
    names = list(names)
    with ThreadPoolExecutor(WRITERS) as pool:
        return dict(zip(names, pool.map(write, names)))


class Medallion:
    """Builds and stores the layers, in databases of their own."""

    def __init__(self, spark: SparkSession, folder: str, prefix: str = ""):
        self.spark = spark
        self.layers = lakehouse.create_layers(spark, folder, prefix)

    def stored(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(f"{self.layers[layer]}.{name}")

    def _save(self, df: DataFrame, layer: str, name: str, same_schema: bool = False) -> DataFrame:
        write = lakehouse.save_same_schema if same_schema else lakehouse.save
        return write(df, f"{self.layers[layer]}.{name}")

    def land(self, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Store source tables as they arrive."""
        return _together(frames, lambda name: self._save(frames[name], "source", name))

    def bronze(self, names: Iterable[str] = views.COMMERCE) -> dict[str, DataFrame]:
        source, target = self.layers["source"], self.layers["bronze"]
        return _together(
            names, lambda name: lakehouse.ingest(self.spark, name, source, target, SOURCE_TYPES.get(name))
        )

    def silver(self) -> dict[str, DataFrame]:
        def write(name: str) -> DataFrame:
            cleaned = SILVER[name](self.stored("bronze", f"{name}_bronze"))
            return self._save(cleaned, "silver", f"silver_{name}", name in FIXED_SCHEMA)

        return _together(SILVER, write)

    def dimensions(self) -> dict[str, DataFrame]:
        made = {
            "dim_customers": gold.dim_customers(self.stored("silver", "silver_customers")),
            "dim_products": gold.dim_products(self.stored("silver", "silver_products")),
            "dim_date": gold.dim_date(self.stored("silver", "silver_orders")),
        }
        return _together(made, lambda name: self._save(made[name], "gold", name))

    def fact_frame(self, rates: DataFrame | None = None, rate_policy: str = "all") -> DataFrame:
        """The fact from the stored layers; ``rates`` takes the place of the stored exchange rates."""
        return gold.fact_orders(
            self.stored("silver", "silver_order_items"),
            self.stored("silver", "silver_orders"),
            self.stored("gold", "dim_products"),
            self.stored("gold", "dim_customers"),
            self.stored("silver", "silver_exchange_rates") if rates is None else rates,
            rate_policy,
        )

    def fact(self) -> DataFrame:
        return self._save(self.fact_frame(), "gold", "fact_orders")

    def kpis(self) -> dict[str, DataFrame]:
        """The ten KPI tables, from six passes over the fact: two stored results serve several KPIs."""
        fused = kpis.fused(self.stored("gold", "fact_orders"), lambda df, name: self._save(df, "gold", name))
        return _together(fused, lambda name: self._save(fused[name], "gold", name))

    def cube(self) -> DataFrame:
        return self._save(cube.cube_sales(self.stored("gold", "fact_orders")), "gold", "cube_sales")

    def run(self) -> None:
        """Bronze to gold over the landed source tables."""
        self.bronze()
        self.silver()
        self.dimensions()
        self.fact()
        self.kpis()
        self.cube()


def _settled(spark: SparkSession, sf_dir: str, part: str, build: Callable[["Medallion"], object]) -> Medallion:
    """The run over the given tables with one part of it built, once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _runs:
            tag = f"sf{len(_runs)}"
            own = re.sub(r"\W", "_", spark.sparkContext.applicationId)  # databases are shared between applications
            _runs[key] = Medallion(spark, f"{work_folder(spark)}/{tag}", f"{tag}_{own}_"), set()
        run, built = _runs[key]
        if part not in built:
            with shuffles_freed(spark):  # every layer is stored
                build(run)
            built.add(part)
        return run


def pitches_of_given_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed pitches: all that the study reads of the given tables."""

    def build(run: Medallion) -> None:
        run.land({"pitches": views.view(spark, sf_dir, "pitches")})

    return _settled(spark, sf_dir, "pitches", build).stored("source", "pitches")


def over_given_tables(spark: SparkSession, sf_dir: str) -> Medallion:
    """The commerce run over the given tables up to the stored fact."""

    def build(run: Medallion) -> None:
        run.land({name: views.bronze(spark, sf_dir, name) for name in views.COMMERCE})
        run.bronze()
        run.silver()
        run.dimensions()
        run.fact()

    return _settled(spark, sf_dir, "commerce", build)
