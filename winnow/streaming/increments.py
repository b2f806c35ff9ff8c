"""Incremental tables that a killed run cannot spoil, and what is made of them later.

A batch is written in two steps: its rows into a folder of its own, then a manifest that names it. Rows without a
manifest are not part of the table: a run that is killed leaves nothing behind, and the repeated run writes the batch again. A batch that has
its manifest is never written twice. Each row has a digest of its content, so that a record counts as done as long as neither its
content nor the catalog has changed; of its rows the one of the latest batch counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.operators.prefilter import decide
from winnow.operators.score import scored
from winnow.sources.catalog import Catalog
from winnow.sources.stages import cut, discard, dropping_shuffles, exists, remove

MANIFEST = "batch string, place long, n long, note string"
SCORES = "record_id string, content string, fingerprint string, action string, reason string, score int, matched_profiles array<string>"
_TEXTS, _FILES = ("record_id", "subject", "body"), "files"


def content_digest() -> Column:
    """A digest of all that decides about a record: id, texts and files. Null and empty parts differ."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
    files = F.coalesce(F.to_json("files"), F.lit("-"))
    return F.sha2(F.concat(*(part(c) for c in _TEXTS), files), 256)


@dataclass
class Table:
    """A table of batches below a folder."""

    spark: SparkSession
    path: str
    schema: str

    def manifests(self) -> DataFrame:
        """batch, place, n, note of the batches that count."""
        if not exists(self.spark, f"{self.path}/manifests"):
            return self.spark.createDataFrame([], MANIFEST)
        # a manifest that is being written has no file by that name yet
        return self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.json").json(f"{self.path}/manifests")

    def has(self, batch: str) -> bool:
        return not self.manifests().where(F.col("batch") == batch).isEmpty()

    def rows(self) -> DataFrame:
        """The rows of all batches that count, with _batch and _place."""
        known = self.manifests().select(F.col("batch").alias("_batch"), F.col("place").alias("_place"))
        if known.isEmpty():
            return self.spark.createDataFrame([], f"{self.schema}, _batch string, _place long")
        # one row per batch
        found = self.spark.read.schema(f"{self.schema}, _batch string").parquet(f"{self.path}/batches")
        return found.join(F.broadcast(known), "_batch").select(*found.columns, "_place")

    def commit(self, batch: str, rows: DataFrame, note: str = "") -> None:
        """Add a batch. One that counts already is left as it is; what a killed run wrote of it goes."""
        if self.has(batch):
            return
        place = (self.manifests().agg(F.max("place")).first()[0] or 0) + 1
        at = f"{self.path}/batches/_batch={batch}"
        with dropping_shuffles(rows.sparkSession):
            rows.write.mode("overwrite").option("compression", "zstd").parquet(at)
        n = self.spark.read.parquet(at).count()
        self.spark.createDataFrame([(batch, place, n, note)], MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.path}/manifests/{batch}")

    def drop(self, batch: str) -> None:
        """Take a batch out: first its manifest, then its rows."""
        remove(self.spark, f"{self.path}/manifests/{batch}")
        remove(self.spark, f"{self.path}/batches/_batch={batch}")


def latest(rows: DataFrame, key: str = "record_id") -> DataFrame:
    """Of each key the row of the latest batch."""
    columns = [c for c in rows.columns if c not in (key, "_batch", "_place")]
    one = rows.groupBy(key).agg(F.max(F.struct("_place", *columns)).alias("_r"))
    return one.select(key, *(f"_r.{c}" for c in columns))


def scores_table(spark: SparkSession, path: str) -> Table:
    return Table(spark, path, SCORES)


def current_scores(table: Table) -> DataFrame:
    """Each record once, as scored last."""
    return latest(table.rows())


#: Records that repeat, or that were scored before, by their digests up to which these are sent to every task.
FEW_REPEATED = 1_000_000
_ONE = ["record_id", "content"]


def _narrow(table: Table) -> DataFrame:
    """What tells of a table whether a record was scored: rows are in order of content and fingerprint first, so that no more of them is moved."""
    return table.rows().select(*_ONE, "fingerprint", "_batch", "_place")


def _few(found: DataFrame) -> DataFrame:
    return F.broadcast(found) if found.count() <= FEW_REPEATED else found


def _undone(batch: DataFrame, table: Table, fingerprint: str) -> DataFrame:
    """The records of a written batch that were not yet scored, written: ids and digests tell which, and where none was the batch stays as it is."""
    if table.manifests().isEmpty() or batch.isEmpty():
        return batch
    # put together by id in one pass: joined with what was scored last, that would be moved once more
    told = _narrow(table).select("record_id", F.struct("_place", "content", "fingerprint").alias("last"), F.lit(None).cast("string").alias("asked"))
    both = told.union(batch.select("record_id", F.lit(None), F.col("content"))).where("record_id is not null")
    by = both.groupBy("record_id").agg(F.max("last").alias("last"), F.collect_set("asked").alias("asked"))
    same = by.where((F.col("last.fingerprint") == fingerprint) & F.array_contains("asked", F.col("last.content")))
    known = cut(same.select("record_id", "last.content"), "known")
    return batch if known.isEmpty() else cut(batch.join(_few(known), _ONE, "left_anti"), "new")


def _unrepeated(batch: DataFrame) -> DataFrame:
    """The records of a written batch without those that repeat one, written: digests tell which may, only these are moved, and where there are none the batch stays as it is."""
    keyed = batch.withColumns({"_a": F.xxhash64(*_ONE), "_b": F.xxhash64(F.lit(1), *_ONE)})
    twice = cut(keyed.groupBy("_a", "_b").count().where("count > 1").select("_a", "_b", F.lit(True).alias("_twice")), "twice")
    if twice.isEmpty():
        return batch
    marked = keyed.join(_few(twice), ["_a", "_b"], "left").drop("_a", "_b")
    return cut(marked.where("_twice is null").drop("_twice").union(marked.where("_twice").drop("_twice").dropDuplicates(_ONE)), "single")


def score_batch(records: DataFrame, table: Table, catalog: Catalog, fingerprint: str, batch: str, sets: DataFrame | None = None) -> None:
    """Decide and score the records whose content or catalog is not the one that they were last scored with, and add them as a batch.

    Repeated rows of one content are one; of several contents under one id each is scored, and the one that is greatest in order of its row counts. Called again with the name
    of a batch that counts, nothing is done. sets: what is built; see compiled_sets.
    """
    if table.has(batch):
        return
    keyed = records.withColumn("content", content_digest())
    rows = lambda out: out.select(*_ONE, F.lit(fingerprint).alias("fingerprint"), "action", "reason", "score", "matched_profiles")
    if sets is None:
        done = latest(_narrow(table)).where(F.col("fingerprint") == fingerprint).select(*_ONE)
        new = keyed.join(done, _ONE, "left_anti")
        # repeated rows are scored where they are and one of them kept then: to find them first, all texts would be sorted and moved
        table.commit(batch, rows(scored(decide(new, catalog), catalog)).dropDuplicates(_ONE), note=fingerprint)
        return
    # what is known of their files is asked for in steps of their own: a stream's records would be read, parted from repeated ones and joined again for each
    whole = cut(keyed.select(*_ONE, "subject", "body", "files"), "batch")
    undone = _undone(whole, table, fingerprint)
    single = _unrepeated(undone)
    # scored before they are joined with what is known of their files: rows are narrow there
    table.commit(batch, rows(decide(scored(single, catalog), catalog, sets)), note=fingerprint)
    discard(*{t.cut_path: t for t in (whole, undone, single)}.values())


@dataclass
class Steps:
    """Written tables that are made of one another, in order: each is kept as long as what it was made of is the same.

    A step's manifest names what it was made of, as text (say, a fingerprint and the batches it read). A step whose manifest says so already is not made again; one that is made takes all
    later ones with it.
    """

    spark: SparkSession
    path: str
    order: Sequence[str]

    def _table(self, step: str) -> Table:
        return Table(self.spark, f"{self.path}/{step}", "")

    def made_of(self, step: str) -> str | None:
        first = self._table(step).manifests().where("batch = 'made'").first()
        return first["note"] if first else None

    def run(self, step: str, source: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The step's table, made if its source has changed."""
        table, at = self._table(step), f"{self.path}/{step}/batches/_batch=made"
        if self.made_of(step) != source:
            self.invalidate(step)
            table.commit("made", make(), source)
        return self.spark.read.parquet(at)

    def invalidate(self, step: str) -> list[str]:
        """Drop a step and all that come after it; their names."""
        later = list(self.order)[list(self.order).index(step) :]
        for name in reversed(later):
            self._table(name).drop("made")
        return later
