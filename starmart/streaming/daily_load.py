"""Incremental load of landed daily state files into the fact table.

The batch job loads the whole daily feed at once. When new daily files keep landing,
the same load runs as a Structured Streaming query over the landing folder:

* the file source records every processed file in the checkpoint, so each landed file
  is loaded exactly once, and a restarted query resumes where it stopped;
* each micro-batch is conformed with the same code as the batch build
  (``star.covid_fact`` against the current dimensions);
* rows are merged by the fact's primary key (date, state_fips): a newer file (by its
  modification time, then its path) replaces the rows it repeats and leaves every other row
  alone. The table is partitioned by month and the merge rewrites only the months present
  in the batch (dynamic partition overwrite), so its cost follows the batch, not the table;
* the months a batch rewrites are staged whole under the batch's number beside the
  checkpoint before the table is touched. A batch that is replayed after a failure uses a
  complete staging as it stands, whatever the table's months look like by then, so the
  table ends as if the batch had run once. The staging goes when the batch is done.

The two per-state lookups are computed once per start, not per batch. No state is kept in
memory across batches; the table itself is the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.codes import zfill_code
from starmart.operators.joins import first_per_group
from starmart.plans import star
from starmart.schemas import FACT_COVID, STATES_DAILY
from starmart.session import delete_path, path_exists, scratch_scope, write_once
from starmart.sources.files import CSV_DIALECT
from starmart.streaming import mart_store

_SOURCE, _LANDED = "__sm_source", "__sm_landed"
_PK = list(FACT_COVID.primary_key)
_MONTH = mart_store.MONTH  # partition column: a batch of daily files touches few months


def _latest_per_key(raw: DataFrame) -> DataFrame:
    """One raw row per fact key (date, state code): the one from the latest landed file (by
    modification time, then path), ties broken on every column so the choice is
    deterministic. The window is partitioned by the fact key, one row per key and file."""
    key = zfill_code("fips", 2)
    cols = [c for c in raw.columns if c not in (_SOURCE, _LANDED)]
    order = [F.col(_LANDED).desc(), F.col(_SOURCE).desc()] + [F.col(c).asc_nulls_last() for c in cols]
    w = Window.partitionBy("date", "__sm_key").orderBy(*order)
    return (raw.where(F.col("fips").isNotNull() & F.col("state").isNotNull())
               .withColumn("__sm_key", key)
               .withColumn("__sm_rn", F.row_number().over(w))
               .where("__sm_rn = 1")
               .select(*cols))


def _read_existing(spark: SparkSession, target: str) -> DataFrame | None:
    return spark.read.parquet(target) if path_exists(spark, target) else None  # else nothing is loaded yet


def _stage(batch: DataFrame, dim_region: DataFrame, dim_hospital: DataFrame, target: str,
           staging: str) -> None:
    """Write the whole new contents of the months that the batch touches."""
    spark = batch.sparkSession
    new_rows = star.covid_fact(_latest_per_key(batch), dim_region, dim_hospital)
    new_rows = write_once(new_rows.withColumn(_MONTH, mart_store.month_of("date")), "daily-load-batch")
    # The months one batch touches: a short list (a backfill of decades is ~1,200), used as
    # a literal filter so only those partitions of the table are read (static pruning).
    months = sorted(r[0] for r in new_rows.select(_MONTH).distinct().collect())
    merged = new_rows
    existing = _read_existing(spark, target)
    if existing is not None and months:
        kept = (existing.where(F.col(_MONTH).isin(months))
                        .join(new_rows.select(*_PK), _PK, "left_anti"))
        merged = kept.unionByName(new_rows)
    merged.write.mode("overwrite").parquet(staging)


def merge_batch(batch: DataFrame, dim_region: DataFrame, dim_hospital: DataFrame,
                target: str, staging: str, store: str | None = None,
                regions: DataFrame | None = None) -> None:
    """Conform one batch of raw daily rows and merge it into the fact table at ``target``.

    ``staging`` names the batch: a complete one left by a failed attempt is used as it is.
    With a ``store`` the marts kept there (``mart_store``) follow, for the batch's months; they
    need the whole region dimension, ``regions``, where ``dim_region`` is only its first keys.
    """
    spark = batch.sparkSession
    if not path_exists(spark, f"{staging}/_SUCCESS"):
        if batch.isEmpty():
            return
        with scratch_scope(spark):
            _stage(batch, dim_region, dim_hospital, target, staging)
    # One file per month partition (a month holds states x days rows of the daily grain).
    months = spark.read.parquet(staging).select(*FACT_COVID.names, _MONTH)
    (months.repartition(_MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(_MONTH).parquet(target))
    if store is not None:  # from the staging still: a replayed batch refreshes the same months
        mart_store.refresh(months, dim_region if regions is None else regions, store)
    delete_path(spark, staging)


def start(spark: SparkSession, landing_dir: str, dim_region: DataFrame, dim_hospital: DataFrame,
          target: str, checkpoint: str, available_now: bool = True,
          max_files_per_trigger: int | None = None, store: str | None = None):
    """Start the load; returns the ``StreamingQuery``. With a ``store`` the marts kept there are
    brought up to date by every batch.

    ``available_now=True`` processes everything landed so far and stops (scheduled
    runs); otherwise the query keeps polling the landing folder.
    """
    schema = T.StructType(list(STATES_DAILY.fields))
    region = write_once(first_per_group(dim_region, "state_fips", "region_sk"), "daily-load-region")
    hospital = write_once(first_per_group(dim_hospital, "state_fips", "hosp_sk"), "daily-load-hospital")
    regions = (write_once(dim_region.select("region_sk", "state", "latitude", "longitude"), "daily-load-regions")
               if store is not None else None)
    reader = (spark.readStream.schema(schema).options(**CSV_DIALECT).option("header", True)
              .option("enforceSchema", False).option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(landing_dir).select(
        "*", F.col("_metadata.file_path").alias(_SOURCE),
        F.col("_metadata.file_modification_time").alias(_LANDED))
    staged = checkpoint.rstrip("/") + "-staging"
    writer = (stream.writeStream
              .foreachBatch(lambda df, epoch: merge_batch(df, region, hospital, target, f"{staged}/{epoch}",
                                                          store, regions))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def read_fact(spark: SparkSession, target: str) -> DataFrame:
    """The loaded fact table in warehouse column order."""
    return spark.read.parquet(target).select(*FACT_COVID.names)
