"""Enrichment of articles as their files land."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mediasignal import schemas
from mediasignal.config import PipelineConfig
from mediasignal.plans.enrich import base_articles, enrich
from mediasignal.session import staged, staging_scope

ENRICHED_BY_BATCH = StructType([*schemas.ARTICLES_ENRICHED.fields, StructField("run", StringType()),
                                StructField("batch", LongType())])
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstLanded(StatefulProcessor):
    """Of a URL's rows, one of the first micro-batch that has any: the first by date, then by the other columns.

    The state of a URL is one flag. Rows are looked at one by one, so a frequent URL needs no memory.
    """

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "known boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((True,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            for _ in rows:
                pass
            return
        self.seen.update((True,))
        yield min(rows, key=lambda r: [(r[c] is not None, r[c] or "") for c in self.order])

    def close(self) -> None:
        pass


def enrich_new_files(spark: SparkSession, landing: str, pages: DataFrame, sink: str, checkpoint: str,
                     config: PipelineConfig, max_files: int = 100) -> None:
    """Enrich the article files that landed since the last call, and stop.

    Of an article's copies the one that lands first counts, among those that
    land together the first by date. The URLs already seen are keyed state of the
    stream, so no batch reads the sink; a new checkpoint takes the sink's URLs as its first state. Each micro-batch replaces its own
    ``run=R/batch=N`` folder of the sink, ``R`` standing for the checkpoint, so a
    batch that runs again after a failure, with the state it had, leaves no second copy.
    """
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def write(rows: DataFrame, batch: int) -> None:
        with staging_scope(spark):
            write_batch(staged(rows, "landed"), batch)

    def write_batch(fresh: DataFrame, batch: int) -> None:
        if fresh.isEmpty():
            return
        result = enrich(base_articles(fresh, config), pages, config, few=True)
        for field in schemas.ARTICLES_ENRICHED.fields:
            if field.name not in result.columns:
                result = result.withColumn(field.name, F.lit(None).cast(field.dataType))
        result.select(*[f"`{n}`" for n in schemas.ARTICLES_ENRICHED.fieldNames()]).write.mode("overwrite").parquet(
            f"{sink}/run={run}/batch={batch}")

    started = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/0")
    files = started.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    known = spark.createDataFrame([], ENRICHED_BY_BATCH) if files.exists(started) else stored(spark, sink)
    known = known.where(F.col("run") != run).select("URL").distinct()
    order = ["Date", *(c for c in schemas.ARTICLES_RAW.fieldNames() if c not in ("Date", "URL"))]
    stream = (spark.readStream.schema(schemas.ARTICLES_RAW)
              .option("maxFilesPerTrigger", max_files).parquet(landing)
              .groupBy("URL").transformWithState(
                  FirstLanded(order), schemas.ARTICLES_RAW, "Update", "None", initialState=known.groupBy("URL")))
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        query = (stream.writeStream.foreachBatch(write).outputMode("update")
                 .option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def stored(spark: SparkSession, sink: str) -> DataFrame:
    """All rows of the sink with their folders; none if nothing has been written yet."""
    try:
        return spark.read.schema(ENRICHED_BY_BATCH).parquet(sink)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENRICHED_BY_BATCH)


def read_enriched(spark: SparkSession, sink: str) -> DataFrame:
    """All batches of the sink as one enriched table."""
    return stored(spark, sink).select(*[f"`{n}`" for n in schemas.ARTICLES_ENRICHED.fieldNames()])
