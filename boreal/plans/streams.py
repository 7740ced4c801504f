"""Streaming queries, run to the end of what is there."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from boreal.plans import sqltext as S
from boreal.session import scratch, table
from boreal.streaming import harvest

Q: dict = {}
SQL: dict[str, str] = {}


def _folder(spark, name):
    return f"{scratch(spark)}/stream-{name}-{uuid.uuid4().hex}"


def stream_harvest(spark, d):
    """Texts of the documents stream, each normalized text once within 90 days of its delivery."""
    schema = table(spark, d, "documents").schema
    read = harvest.read(spark, f"{d}/documents.parquet*", schema).select("text", "ingested_at")
    stream, base = harvest.harvest(read, min_chars=20, lateness="90 days"), _folder(spark, "harvest")
    harvest.append(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    out = spark.read.schema(stream.schema).parquet(f"{base}/out")
    return out.agg(F.count(F.lit(1)).alias("texts"), F.countDistinct("normalized_text_sha256").alias("distinct_texts"))


SQL["stream_harvest"] = f"select count(distinct k) as texts, count(distinct k) as distinct_texts from (select {S.norm('text')} as k from documents where length({S.clean('text')}) >= 20)"


def stream_windows(spark, d):
    """Records per source and week of delivery, late ones included while the watermark holds their window."""
    schema = table(spark, d, "assnat_fixture_harvest").schema
    stream = harvest.read(spark, f"{d}/assnat_fixture_harvest.parquet*", schema).select("source_id", "ingested_at")
    base = _folder(spark, "windows")
    return harvest.latest(harvest.counts(stream, "source_id"), ["start", "source_id"], f"{base}/out", f"{base}/checkpoint")


SQL["stream_windows"] = "select time_bucket(interval '7 days', ingested_at, timestamp '1970-01-01') as start, source_id, count(*) as n from assnat_fixture_harvest where ingested_at is not null group by 1, 2"

Q |= {"stream_harvest": stream_harvest, "stream_windows": stream_windows}
