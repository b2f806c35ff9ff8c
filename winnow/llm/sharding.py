"""Sharding by fixed virtual slots.

Records hash into a fixed number of virtual slots (thousands, far more than shards). Only
the slots are placed: their bytes and rows are summed, and a versioned map from slot to
shard places them. Rebalancing edits that map and leaves the hash alone, so a record moves
only when its slot does.

The slot is a hash of the text, so that equal texts share one. A text whose copies outweigh a part of a
shard, by bytes or by rows, has an entry in the map that tells over how many slots they are dealt; like the slots' shards, such entries are
written when a map is made or edited, and change with no later number of bytes or shards.

The map has one row per slot, and entries for texts of which few can weigh that much: that bound lets it be broadcast and
edited on the driver.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnow.llm.common import cut

SLOTS = 8192
#: Bytes that a record takes besides its text.
OVERHEAD = 16
#: A map gets an entry for a text whose copies are more than this part of a shard's bytes or rows, for so many slots in each shard's worth of them.
GROUP_SHARE, PARTS = 0.25, 16


@dataclass
class SlotMap:
    """A version of the map: shard[s] holds slot s. size, rows: what each slot weighs. spread: by hash of a text, the slots that its copies are dealt over."""

    version: int
    shards: int
    shard: list[int]
    size: list[int]
    rows: list[int]
    log: list[str] = field(default_factory=list)
    spread: dict[int, int] = field(default_factory=dict)

    def loads(self) -> list[int]:
        out = [0] * self.shards
        for at, n in zip(self.shard, self.size, strict=True):
            out[at] += n
        return out


def new_map(size: list[int], rows: list[int], shards: int, spread: dict[int, int] | None = None) -> SlotMap:
    """Version 1: heaviest slot first, each to the lightest shard so far."""
    heap = [(0, 0, k) for k in range(shards)]
    shard = [0] * len(size)
    for s in sorted(range(len(size)), key=lambda s: (-size[s], s)):
        load, n, k = heapq.heappop(heap)
        shard[s] = k
        heapq.heappush(heap, (load + size[s], n + 1, k))
    return SlotMap(1, shards, shard, size, rows, ["placed all slots"], dict(spread or {}))


def grow(old: SlotMap, by: int = 1) -> SlotMap:
    """The next version with more shards: slots move into the new ones only, from the heaviest shards."""
    shard, shards = list(old.shard), old.shards + by
    target = sum(old.size) / shards
    held: dict[int, list[int]] = {k: [] for k in range(shards)}
    for s in sorted(range(len(shard)), key=lambda s: (old.size[s], s)):
        held[shard[s]].append(s)
    heap = [(-load, k) for k, load in enumerate(old.loads())]
    heapq.heapify(heap)
    moved = 0
    for new in range(old.shards, shards):
        load = 0
        while heap:
            most, k = heap[0]
            room = min(target - load, -most - target)
            fits = [s for s in held[k] if 0 < old.size[s] <= room]
            if not fits:
                break
            s = fits[-1]
            held[k].remove(s)
            shard[s], load, moved = new, load + old.size[s], moved + 1
            heapq.heapreplace(heap, (most + old.size[s], k))
    return SlotMap(old.version + 1, shards, shard, old.size, old.rows, [*old.log, f"grew to {shards} shards, moved {moved} slots"], old.spread)


def rebalance(old: SlotMap, size: list[int], rows: list[int], tolerance: float = 0.01) -> SlotMap:
    """The next version for new slot weights (see weigh): moves as few slots as bring every shard within the tolerance."""
    now = SlotMap(old.version + 1, old.shards, list(old.shard), size, rows, list(old.log), old.spread)
    loads, target, moved = now.loads(), sum(size) / old.shards, 0
    for _ in range(len(size)):
        a, b = max(range(old.shards), key=loads.__getitem__), min(range(old.shards), key=loads.__getitem__)
        if loads[a] <= target * (1 + tolerance):
            break
        room = min(loads[a] - target, (loads[a] - loads[b]) / 2)
        fits = [s for s in range(len(size)) if now.shard[s] == a and 0 < size[s] <= max(room, 1)]
        if not fits:
            break
        s = max(fits, key=lambda s: (size[s], -s))
        now.shard[s] = b
        loads[a], loads[b], moved = loads[a] - size[s], loads[b] + size[s], moved + 1
    now.log.append(f"rebalanced, moved {moved} slots")
    return now


def spread_more(old: SlotMap, heavy: dict[int, int]) -> SlotMap:
    """The next version with entries for texts that have none: only their copies change slots, and what the slots weigh is to be summed again."""
    new = {h: k for h, k in heavy.items() if h not in old.spread}
    return SlotMap(old.version + 1, old.shards, old.shard, old.size, old.rows, [*old.log, f"dealt {len(new)} texts over slots"], old.spread | new)


def write_map(spark: SparkSession, slots: SlotMap, path: str) -> None:
    """Add a version to the stored map: Parquet folders of its own for each version, none overwritten."""
    rows = [(s, k, n, r) for s, (k, n, r) in enumerate(zip(slots.shard, slots.size, slots.rows, strict=True))]
    at = f"{path}/version={slots.version:06d}"
    spark.createDataFrame(rows, "virtual_slot int, shard int, bytes long, rows long").coalesce(1).write.parquet(f"{at}/slots")
    spark.createDataFrame(list(slots.spread.items()), "text_hash long, slots int").coalesce(1).write.parquet(f"{at}/spread")


def read_map(spark: SparkSession, path: str, version: int) -> SlotMap:
    at = f"{path}/version={version:06d}"
    rows = spark.read.parquet(f"{at}/slots").orderBy("virtual_slot").collect()
    spread = {r["text_hash"]: r["slots"] for r in spark.read.parquet(f"{at}/spread").collect()}
    return SlotMap(version, max(r["shard"] for r in rows) + 1, [r["shard"] for r in rows], [r["bytes"] for r in rows], [r["rows"] for r in rows], spread=spread)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, text_hash of every row; a null text has no bytes."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", (F.octet_length(text).cast("long") + OVERHEAD).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))


def heavy_texts(sized_rows: DataFrame, shards: int) -> dict[int, int]:
    """By hash, texts whose copies are more than GROUP_SHARE of a shard's bytes or rows (as very many empty texts are), and over how many slots they should be dealt.

    Fewer than 2 * shards / GROUP_SHARE texts can be that many.
    """
    size, rows = sized_rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    by = sized_rows.groupBy("text_hash").agg(F.sum("size").alias("s"), F.count("*").alias("n")).where("n > 1")
    by = by.where((F.col("s") > GROUP_SHARE * size / shards) | (F.col("n") > GROUP_SHARE * rows / shards))
    return {r["text_hash"]: max(-(-PARTS * shards * r["s"] // size), -(-PARTS * shards * r["n"] // rows)) for r in by.collect()}


def slotted(sized_rows: DataFrame, spread: dict[int, int], slots: int = SLOTS) -> DataFrame:
    """The rows with virtual_slot: by the text's hash, and for the texts of spread by that and one of so many numbers that doc_id gives."""
    entries = sized_rows.sparkSession.createDataFrame(list(spread.items()), "text_hash long, _slots int")
    part = F.pmod(F.xxhash64(F.lit("row"), "doc_id"), F.col("_slots"))
    slot = F.pmod(F.when(F.col("_slots").isNull(), F.col("text_hash")).otherwise(F.xxhash64("text_hash", part)), F.lit(slots))
    return sized_rows.join(F.broadcast(entries), "text_hash", "left").withColumn("virtual_slot", slot.cast("int")).drop("_slots")


def weigh(sized_rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot: at most one row per slot comes to the driver."""
    size, rows = [0] * slots, [0] * slots
    for r in sized_rows.groupBy("virtual_slot").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect():
        size[r["virtual_slot"]], rows[r["virtual_slot"]] = r["s"], r["n"]
    return size, rows


def make_map(sized_rows: DataFrame, shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 1 for these rows."""
    spread = heavy_texts(sized_rows, shards)
    return new_map(*weigh(slotted(sized_rows, spread, slots), slots), shards, spread)


def assign(docs: DataFrame, shards: int = 40, slots: int = SLOTS, slot_map: SlotMap | None = None, store: str | None = None) -> DataFrame:
    """Every row with its shard and its place there.

    Returns doc_id, size (UTF-8 bytes of the text and OVERHEAD), text_crc32, law ('bytes':
    shard sizes are near equal), shard, slot (the row's place in its shard, gapless from
    0), grown_shard (null: that is for the law 'key'), virtual_slot, map_version.
    An empty table gives no rows; a null text counts as empty; repeated rows and a null
    doc_id are rows like others; extra columns are ignored. A given slot_map is used as it
    is, whatever rows it was made from; else version 1 is made from these, and written to store, a folder, if that is named.
    """
    spark = docs.sparkSession
    base = cut(sized(docs), "sized")
    if slot_map is None:
        slot_map = make_map(base, shards, slots)
        if store:
            write_map(spark, slot_map, store)
            slot_map = read_map(spark, store, slot_map.version)
    slots = len(slot_map.shard)
    rows = slotted(base, slot_map.spread, slots)
    _, held = weigh(rows, slots)
    first, filled = [0] * slots, [0] * slot_map.shards
    for s in range(slots):
        first[s] = filled[slot_map.shard[s]]
        filled[slot_map.shard[s]] += held[s]
    placed = spark.createDataFrame([(s, slot_map.shard[s], first[s]) for s in range(slots)], "virtual_slot int, shard int, first long")
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        rows.withColumn("place", place)
        .join(F.broadcast(placed), "virtual_slot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("place") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            F.lit(slot_map.version).alias("map_version"),
        )
    )
