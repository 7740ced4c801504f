"""A stream of documents: lines cleaned, deduplicated within a watermark, and appended."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boreal.functions.text import clean, norm_key, sha


def read(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def harvest(stream: DataFrame, text: str = "text", time: str = "ingested_at", min_chars: int = 20, lateness: str | None = None) -> DataFrame:
    """Cleaned texts of at least ``min_chars``, the first of each normalized text. With ``lateness`` a text is
    remembered for that long of event time and the state stays bounded; without, for good."""
    own = stream.withColumn("text", clean(text)).where(F.length("text") >= min_chars).withColumn("normalized_text_sha256", sha(norm_key("text")))
    if lateness:
        timed = own.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
        return timed.dropDuplicatesWithinWatermark(["normalized_text_sha256"])
    return own.dropDuplicates(["normalized_text_sha256"])


def counts(stream: DataFrame, key: str, time: str = "ingested_at", every: str = "7 days", lateness: str = "60 days") -> DataFrame:
    """Records per key and window of event time; late ones count as long as the watermark holds their window."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    return timed.groupBy(F.window(time, every), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")


def latest(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Runs an aggregation over what is there and ends. Each batch writes the rows it changed, under its own number so
    that a repeated batch replaces itself; the result is each key's last row. Nothing passes through the driver."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(save).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    spark = stream.sparkSession
    try:
        saved = spark.read.option("basePath", path).parquet(path)
    except AnalysisException:  # no batch at all
        return spark.createDataFrame([], stream.schema)
    rest = [c for c in stream.columns if c not in keys]
    last = saved.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__last"))
    return last.select(*keys, "__last.*")


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs what is there and ends; each batch is appended as parquet once."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
