"""Incremental and streaming scoring. Scores are row by row, so a stream needs state only to leave out repeated records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from winnow.functions.patterns import with_lowered
from winnow.operators.prefilter import LOWS, TEXTS, decision
from winnow.operators.score import scored
from winnow.sources.catalog import KINDS, Catalog
from winnow.streaming.increments import Table, score_batch

#: Records of a stream whose ids repeat within so long are one.
REPEATS_WITHIN = "1 day"
#: Bytes of files that a micro-batch of decisions takes: what it moves and writes between its steps is bounded by these, and not by what is there.
AT_ONCE = 1 << 30
RECORD = "record_id string, seq long, subject string, body string, files array<string>, author_name string"


def incremental_new(records: DataFrame, done: DataFrame, fingerprint: str) -> DataFrame:
    """Records that were not yet scored with this catalog. done: record_id, fingerprint."""
    return records.join(done.where(F.col("fingerprint") == fingerprint).select("record_id"), "record_id", "left_anti")


def score_increment(records: DataFrame, path: str, catalog: Catalog, fingerprint: str) -> DataFrame:
    """Score what is new and append it to the table at path."""
    from winnow.sources.records import stage_table

    spark = records.sparkSession
    done = stage_table(spark, path, "record_id string, fingerprint string, score int")
    new = scored(incremental_new(records, done, fingerprint), catalog).select("record_id", F.lit(fingerprint).alias("fingerprint"), "score")
    new.write.mode("append").parquet(path)
    return stage_table(spark, path, "record_id string, fingerprint string, score int")


def score_stream(records: DataFrame, catalog: Catalog) -> DataFrame:
    """record_id, action, reason, score, matched_profiles of a stream or a table of records."""
    lists = {k: catalog.overall(k) for k in KINDS}
    out = scored(with_lowered(records, TEXTS).withColumn("d", decision(lists, lows=[F.col(c) for c in LOWS])), catalog)
    return out.select("record_id", "d.action", "d.reason", "score", "matched_profiles")


def read_stream(spark: SparkSession, folder: str, schema: str = RECORD, at_once: int | None = None) -> DataFrame:
    """Records of a folder of JSON rows. at_once: bytes of files that a micro-batch takes; else one takes all that is there, and moves all of it at a time."""
    stream = spark.readStream.schema(schema)
    return (stream.option("maxBytesPerTrigger", at_once) if at_once else stream).json(folder)


def write_stream(scores: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that is there, then stop; called again, go on where it stopped."""
    return scores.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once(records: DataFrame, time: str, within: str = REPEATS_WITHIN) -> DataFrame:
    """A stream's records without those whose record_id was seen before within a time, by a column of seconds; those that come later than that are left out.

    The state is one row per id, and goes as the watermark passes it.
    """
    timed = records.withColumn("_time", F.timestamp_seconds(F.coalesce(time, F.lit(0))))
    return timed.withWatermark("_time", within).dropDuplicatesWithinWatermark(["record_id"]).drop("_time")


def decide_stream(records: DataFrame, table: Table, catalog: Catalog, fingerprint: str, checkpoint: str, sets: DataFrame | None = None, run: str = "stream") -> StreamingQuery:
    """Decide and score a stream's records with what is built (sets, a table at rest), as a batch would, into a table of batches.

    Every micro-batch is joined with the table at rest and added under a name of its own, so that one that is repeated after a failure counts once.
    A record that comes again is scored again if its content has changed. run: names the stream's batches in the table. Stops when all that is there is done; called again, it goes on where it stopped.
    """

    def add(rows: DataFrame, number: int) -> None:
        score_batch(rows, table, catalog, fingerprint, f"{run}-{number:09d}", sets)

    return records.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
