"""Incremental ingest: new raw files only, upserted into a keyed store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise.operators.quality import REASON, with_reason
from statewise.sinks.upsert import KeyedStore, upsert
from statewise.sources.files import UNREADABLE
from statewise.workspace import discard


def ingest_available(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    shape: Callable[[DataFrame], DataFrame],
    store: KeyedStore,
    checkpoint: str,
    file_format: str = "json",
    max_files: int | None = None,
    glob: str | None = None,
    rejects: str | None = None,
) -> None:
    """Take in every file that arrived in ``landing`` since the last call.

    ``shape`` turns raw rows, and their file's ``_metadata``, into rows of the
    store. Documents that do not parse, rows without a value in a column the
    store requires, and rows with an empty text in a partition column go to
    ``rejects`` (by default next to the store), one folder per batch. Files already taken are remembered in ``checkpoint``.
    A batch repeated after a failure finds its staged rows and publishes them
    again, so the result is that of one run.
    """
    required = [field.name for field in store.schema.fields if not field.nullable]
    rejects = rejects or f"{store.path}_rejects"
    raw_schema = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])
    reader = spark.readStream.schema(raw_schema).format(file_format)
    if file_format in ("json", "csv"):
        reader = reader.option("columnNameOfCorruptRecord", UNREADABLE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    texts = [
        name
        for name in store.partition_by
        if isinstance(store.schema[name].dataType, T.StringType)
    ]
    rules = {f"{name} is empty": ~F.col(name).eqNullSafe("") for name in texts}

    def stage_of(batch_id: int) -> str:
        return f"{checkpoint}/stages/{batch_id}"

    def take(batch: DataFrame, batch_id: int) -> None:
        # Raw text is parsed once; everything after reads what was written.
        parsed = f"{checkpoint}/rows"
        batch.write.mode("overwrite").parquet(parsed)
        raw = batch.sparkSession.read.schema(batch.schema).parquet(parsed)
        readable = raw.where(F.col(UNREADABLE).isNull()).drop(UNREADABLE)
        marked = with_reason(shape(readable), required, rules)
        lost = raw.where(F.col(UNREADABLE).isNotNull())
        lost = lost.select(UNREADABLE, F.lit("unreadable").alias(REASON))
        bad = marked.where(F.col(REASON) != "").unionByName(lost, allowMissingColumns=True)
        bad.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        good = marked.where(F.col(REASON) == "").drop(REASON)
        upsert(store, good, stage=stage_of(batch_id))
        if batch_id > 0:
            # The next batch starts only after the one before is committed.
            discard(batch.sparkSession, stage_of(batch_id - 1))

    query = (
        reader.load(landing)
        .select("*", "_metadata")
        .writeStream.option("checkpointLocation", f"{checkpoint}/progress")
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
    query.awaitTermination()
