"""A training-data pipeline over documents: each stage works on all rows that the one before kept.

Stages keep the columns that their rows have, whatever their names. A null text counts as empty, and a null doc_id is that of a row
by itself; what that and repeated rows mean to a stage is said at its operator. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from winnow.llm import bpe, minhash, mixing, quality, suffixes
from winnow.llm.common import cut, discard, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: rows whose text the classifier rejects go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each class of near duplicates the smallest doc_id stays."""
    return minhash.keep_one(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: strings of 50 bytes that an earlier document has go from the texts; all rows stay."""
    return suffixes.remove_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the rows in the order of the mix; all stay. Written, they keep that order in the table's files."""
    return mixing.in_mix_order(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: ids of every text, and the digests of the ids and of what they decode to; each row with its slot and position in the mix, and in that order.

    Slots and positions are read from the order that the rows have in the files of the table before.
    """
    rows = mixing.stored(docs)
    encoded = bpe.encode(rows, digests=True, keep=("file_no", "row_no"))
    placed = encoded.join(mixing.places_in_order(rows), ["file_no", "row_no"]).drop("file_no", "row_no")
    return mixing.sorted_by_position(placed, docs.count())


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeats_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: Compression, minimum hashes and merges are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
