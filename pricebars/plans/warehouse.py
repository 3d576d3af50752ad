"""The batch job: ticks or bars of several sources -> bronze -> silver -> gold -> predictions.

Each layer is written once and the next one reads it, so nothing is computed twice and a lost executor
costs a task, not the job.
"""

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebars.operators import evaluate, features, forecast, layers, reshape, serve, series
from pricebars.schema import (
    BRONZE_SCHEMA, COUNTS_SCHEMA, DIM_SCHEMA, FACT_SCHEMA, PREDICTION_SCHEMA, SERIES_KEY, SERVED_SCHEMA, SILVER_SCHEMA,
    TEST_SIZE,
)
from pricebars.sources import store
from pricebars.sources.tables import read_or_empty


@dataclass(frozen=True)
class Warehouse:
    """Tables under one folder, which change as a whole; one that nobody has written yet reads as empty.

    Every table read on its own is that of the last version; take a :meth:`snapshot` to read several of the same one.
    ``tables`` names the folders of a snapshot, or of a version that is being written.
    """

    spark: SparkSession
    root: str
    tables: dict[str, str] | None = None
    writing: bool = False

    def snapshot(self) -> "Warehouse":
        if self.tables is not None:
            return self
        return Warehouse(self.spark, self.root, store.Versions(self.spark, self.root).latest()[1])

    @contextmanager
    def change(self) -> Iterator["Warehouse"]:
        """A version to write: readers get it when the block ends, and never if it fails.  Changes inside one another are one."""
        if self.writing:
            yield self
            return
        versions = store.Versions(self.spark, self.root)
        number, tables = versions.latest()
        new = Warehouse(self.spark, self.root, dict(tables), True)
        yield new
        versions.commit(new.tables, number)

    def write(self, name: str, writer: Callable[[str], None]) -> None:
        """Have a table of the version that is being written put into a folder of its own."""
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        writer(path)
        self.tables[name] = path

    def drop(self, name: str) -> None:
        self.tables.pop(name, None)

    def has(self, name: str) -> bool:
        return name in self.snapshot().tables

    def _read(self, name: str, schema) -> DataFrame:
        path = self.snapshot().tables.get(name)
        return read_or_empty(self.spark, path, schema) if path else self.spark.createDataFrame([], schema)

    @property
    def bronze(self) -> DataFrame:
        return self._read("bronze", BRONZE_SCHEMA)

    @property
    def silver(self) -> DataFrame:
        return self._read("silver", SILVER_SCHEMA)

    @property
    def dim(self) -> DataFrame:
        return self._read("gold/dim", DIM_SCHEMA)

    @property
    def fact(self) -> DataFrame:
        return self._read("gold/fact", FACT_SCHEMA)

    @property
    def served(self) -> DataFrame:
        """The fact with the category its files are ordered by."""
        return self._read("gold/fact", SERVED_SCHEMA)

    @property
    def latest_fact(self) -> DataFrame:
        """The last bar of every symbol and timeframe."""
        return self._read("gold/latest", FACT_SCHEMA)

    @property
    def prediction_fact(self) -> DataFrame:
        return self._read("gold/predictions", PREDICTION_SCHEMA)

    @property
    def counts(self) -> DataFrame:
        return self._read("counts", COUNTS_SCHEMA)

    @property
    def prices(self) -> DataFrame:
        now = self.snapshot()
        return serve.prices(now.fact, now.dim)

    @property
    def latest(self) -> DataFrame:
        now = self.snapshot()
        return serve.prices(now.latest_fact, now.dim)

    @property
    def predictions(self) -> DataFrame:
        now = self.snapshot()
        return serve.predictions(now.prediction_fact, now.dim)


def load(
    warehouse: Warehouse,
    sources: list[DataFrame],
    profiles: DataFrame,
    at: datetime,
    priority: dict[str, int] | None = None,
) -> None:
    """Write bronze, silver, dimension, fact and the last bars from long-format sources, as one version.

    The rows before and after each cleaning step are counted as they pass, and written to ``counts``.  Forecasts belong to the
    ids of the version before and go; write new ones in the same :meth:`Warehouse.change`, so that no reader misses them.
    """
    spark, seen = warehouse.spark, {}

    def counted(df: DataFrame, step: str) -> DataFrame:
        df, seen[step] = reshape.observed(df, step)
        return df

    with warehouse.change() as new:
        long = reshape.union_sources([reshape.conform_long(s) for s in sources])
        new.write("bronze", lambda path: store.write_layer(layers.bronze(counted(long, "landed rows"), at), path))

        wide = counted(reshape.to_wide(new.bronze, priority), "bars")
        priced = counted(features.drop_missing_price(wide), "bars with a price")
        bars = store.materialise(priced, "bars").join(reshape.source_names(new.bronze), "symbol", "left")
        enriched = counted(features.enrich(bars, profiles), "enriched bars")
        new.write("silver", lambda path: store.write_layer(layers.silver(enriched, at), path))
        counts = [(i, step, observation.get["rows"]) for i, (step, observation) in enumerate(seen.items())]
        counts = spark.createDataFrame(counts, "place INT, step STRING, rows BIGINT")
        new.write("counts", lambda path: counts.write.parquet(path))

        new.write("gold/dim", lambda path: layers.build_dim(new.silver).write.parquet(path))
        fact = layers.gold(new.silver, new.dim, at).join(new.dim.select("id", "category"), "id")
        new.write("gold/fact", lambda path: store.write_served(fact, path, ["category", "id", "time_index"], ("id",)))
        new.write("gold/latest", lambda path: store.write_layer(serve.latest_rows(new.fact), path))
        new.drop("gold/predictions")


def predict(warehouse: Warehouse, run_at: datetime, test_size: int = TEST_SIZE) -> None:
    """Fit both models on the whole history and without the hold-out, and write both sets of forecasts."""
    with warehouse.change() as new:
        points = series.to_series(new.prices)
        rows = (
            forecast.forecast(points).withColumn("fit_scope", F.lit("full"))
            .unionByName(evaluate.holdout_forecast(points, test_size).withColumn("fit_scope", F.lit("holdout")))
        )
        fact = layers.prediction_fact(store.materialise(rows, "predictions"), new.dim, run_at)
        keys = ["model_name", "id", "indicator"]
        new.write("gold/predictions", lambda path: store.write_served(fact, path, keys, ("id",)))


def holdout_predictions(warehouse: Warehouse) -> DataFrame:
    rows = warehouse.predictions.filter(F.col("fit_scope") == "holdout")
    return rows.select(
        *SERIES_KEY, "model_name", "predicted_time", "predicted_value", "confidence_low", "confidence_high"
    )


def export(warehouse: Warehouse, folder: str, test_size: int = TEST_SIZE) -> None:
    """Stored hold-out forecasts and their scores as CSV, one folder per model and timeframe."""
    predictions = holdout_predictions(warehouse)
    scores = evaluate.score(predictions, series.to_series(warehouse.prices), test_size)
    store.export_csv(predictions, f"{folder}/predictions")
    store.export_csv(scores, f"{folder}/metrics")
