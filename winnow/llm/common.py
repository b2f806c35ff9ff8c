"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.sources.stages import cut, discard, session_dir, spread  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, in as many parts as there are cores at least."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores at its end as no column of df has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that few texts at a time are Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Maximal runs of rows with equal keys, from batches sorted by those keys."""
    open_parts: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        changed = np.zeros(n, bool)
        for k in keys:
            col = batch.column(k)
            if n > 1:
                same = pc.equal(col.slice(1), col.slice(0, n - 1))
                both_null = pc.and_(col.slice(1).is_null(), col.slice(0, n - 1).is_null())
                changed[1:] |= ~pc.or_(pc.fill_null(same, False), both_null).to_numpy(zero_copy_only=False)
        first = tuple(batch.column(k)[0].as_py() for k in keys)
        changed[0] = last is None or first != last
        starts = np.flatnonzero(changed)
        if not changed[0]:
            end = int(starts[0]) if len(starts) else n
            open_parts.append(batch.slice(0, end))
        if len(starts):
            if open_parts:
                yield pa.Table.from_batches(open_parts)
            ends = np.append(starts[1:], n)
            for s, e in zip(starts[:-1].tolist(), ends[:-1].tolist(), strict=True):
                yield pa.Table.from_batches([batch.slice(s, e - s)])
            open_parts = [batch.slice(int(starts[-1]))]
        last = tuple(batch.column(k)[n - 1].as_py() for k in keys)
    if open_parts:
        yield pa.Table.from_batches(open_parts)


#: Links that one task of a round takes.
LINKS_PER_TASK = 100_000


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of edges(a, b): one row (id, component_id) per id that occurs.

    component_id is the smallest id that links reach. Links point from the larger to the smaller
    id, and rounds of two steps change them until nothing changes: each link's smaller end
    gives way to its own smallest neighbour (large star), then all smaller neighbours of an id
    are hung on the smallest of them (small star). The number of rounds grows with the logarithm of
    the longest chain. No round gathers the neighbours of an id: minima are summed up before they
    are shuffled, and an id with very many links is a skewed join that adaptive execution splits.
    Rounds are cut with a table, and have as many tasks as their links need.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    least = edges.sparkSession.sparkContext.defaultParallelism
    seen = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        mark = (mark["n"], mark["h"])
        if mark == seen or not mark[0]:
            break
        seen, before = mark, now
        tasks = max(least, -(-mark[0] // LINKS_PER_TASK))
        low = now.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks).select(F.col("a").alias("k"), "m")
        large = now.join(low, now.b == low.k, "left").select("a", F.coalesce("m", "b").alias("b")).coalesce(tasks)
        low = large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks).select(F.col("a").alias("k"), "m")
        small = large.join(low, large.a == low.k).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks)
        now = cut(small.union(low).distinct().coalesce(tasks), name)
        discard(before)
    members = now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component_id"))
    return members.union(now.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())
