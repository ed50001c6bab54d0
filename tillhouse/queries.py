"""Every table of the warehouse, and its data-quality reports, as a query over the benchmark tables.

The raw and detail layers and the date dimension are stored once per session and input folder, as
in a batch run, where each layer reads the stored tables of the layer below. Aggregates and reports
are computed from the stored detail at every call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillhouse import activity_queries, schemas
from tillhouse.plans import dwd, dws, ods, summaries, warehouse
from tillhouse.sources import read_json_log
from tillhouse.sources.benchmark_tables import read_input
from tillhouse.staging import land_lines, pin

Query = Callable[[SparkSession, str], DataFrame]

_stored: dict[tuple, DataFrame | str] = {}


def _contents(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the input files, so that changed inputs are read anew."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        file = files.next()
        found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


class Tables:
    """Looks up ``layer.table`` for one input folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._key = (spark.sparkContext.applicationId, folder, _contents(spark, folder))

    def _once(self, name: str, make: Callable[[], DataFrame | str]) -> DataFrame | str:
        key = (*self._key, name)
        if key not in _stored:
            _stored[key] = make()
        return _stored[key]

    def _raw(self, name: str) -> DataFrame:
        if name in ("customer", "store"):
            source = schemas.conform(read_input(self.spark, self.folder, name), schemas.INPUTS[name])
            return ods.customer(source) if name == "customer" else ods.store(source)
        log = self._once(f"log.{name}", lambda: land_lines(read_input(self.spark, self.folder, name)))
        return read_json_log(self.spark, log, schemas.INPUTS[name].names)

    def compute(self, name: str) -> DataFrame:
        layer, table = name.split(".")
        if layer == "ods":
            return self._raw(table)
        if name == "dws.transaction_by_customer":
            return dws.transaction_by_customer(self("dwd.transaction"), self("dwd.customer"), self("dws.dim_date"))
        return warehouse.LAYERS[layer][table](self)

    def __call__(self, name: str) -> DataFrame:
        if name.startswith(("ods.", "dwd.")) or name == "dws.dim_date":
            partitions = warehouse.PARTITIONS.get(name, ())
            return self._once(name, lambda: pin(self.compute(name), partitions))
        return self.compute(name)


def _table_query(name: str) -> Query:
    return lambda spark, folder: Tables(spark, folder).compute(name)


def queries() -> dict[str, Query]:
    names = [f"ods.{name}" for name in schemas.INPUTS]
    names += [f"{layer}.{table}" for layer, tables in warehouse.LAYERS.items() for table in tables]
    found = {name.replace(".", "_", 1): _table_query(name) for name in names}

    def over(tables: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, folder: tables(Tables(spark, folder))

    found["dws_store_faith_factor_by_count"] = over(
        lambda t: dws.store_faith_factor(t("dwd.transaction"), t("dws.dim_date"), recent_measure="count")
    )
    found["dq_duplicate_transaction_ids"] = over(lambda t: dwd.duplicate_transaction_ids(t("ods.transaction")))
    found["dq_rejected_transactions"] = over(lambda t: dwd.rejected_transactions(t("ods.transaction")))
    found["dq_repeated_dimension_keys"] = over(
        lambda t: dwd.repeated_dimension_keys(t("ods.customer"), t("ods.store"))
    )
    found["dq_distinct_sketches"] = over(lambda t: summaries.distinct_check(t("dwd.transaction")))
    found["dq_quantile_sketches"] = over(lambda t: summaries.quantile_check(t("dwd.transaction")))
    return found | activity_queries.queries()
