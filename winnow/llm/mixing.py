"""Mixing sources to target weights by Pfair scheduling.

Each source's rows, in a seeded order, form blocks. Of a source with a share w of the mix,
block i is released at slot floor(i / w) and due at slot ceil((i + 1) / w); in every slot the
released block that is due first goes next. No deadline is missed, and after any number of slots each
source has had its share of them to within less than one block.

Shares are those of the weights as they are, in whole-number arithmetic. The driver schedules
every block and sends the slots to the rows in chunks; blocks have BLOCK_ROWS rows, or as many more as keep them to about
BLOCKS, which bounds both, whatever the number of rows. When a source runs out, the
others' shares grow in proportion and a new phase begins. All rows of all sources stay in the mix, each once.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.common import cut, partitions

#: Rows of a block at least, and blocks of a mix at most, but for one that a source may not fill.
BLOCK_ROWS, BLOCKS = 16, 1 << 20
#: Blocks of a source whose slots go to the rows together.
CHUNK = 4096
#: Without target weights, shares follow the sources' rows to this power.
TEMPER = 0.5
#: Rows that are ranked together.
RANKED = 50_000


def in_turn(shares: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(source, released, due) of each slot, without end: earliest deadline first among released blocks; ties by name."""
    total = sum(shares.values())
    done = dict.fromkeys(shares, 0)
    waiting = [(0, s) for s in sorted(shares)]
    ready: list[tuple[int, str, int]] = []
    t = 0
    while True:
        while waiting and waiting[0][0] <= t:
            released, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(done[s] + 1) * total // shares[s]), s, released))
        due, s, released = heapq.heappop(ready)
        yield s, released, due
        done[s], t = done[s] + 1, t + 1
        heapq.heappush(waiting, (done[s] * total // shares[s], s))


def whole(weights: dict[str, float]) -> dict[str, int]:
    """The weights as whole numbers in exactly their proportion."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * scale) for s, w in exact.items()}


#: phase, slot, released, due of each block of a source.
Places = tuple[array, array, array, array]


def schedule(blocks: dict[str, int], weights: dict[str, float]) -> dict[str, Places]:
    """The places of all blocks of each source."""
    out: dict[str, Places] = {s: (array("q"), array("q"), array("q"), array("q")) for s, n in blocks.items() if n}
    left, base, phase = {s: n for s, n in blocks.items() if n}, 0, 0
    while left:
        for s, released, due in in_turn(whole({s: weights[s] for s in left})):
            for column, x in zip(out[s], (phase, base, released, due), strict=True):
                column.append(x)
            base += 1
            left[s] -= 1
            if not left[s]:
                break
        left = {s: n for s, n in left.items() if n}
        phase += 1
    return out


def rows_of_a_block(rows: int) -> int:
    return max(BLOCK_ROWS, -(-rows // BLOCKS))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block_rows: int | None = None, seed: int = 0) -> DataFrame:
    """Each row's place in the mix.

    Returns doc_id, source, source_rank (in the seeded order), block, phase, slot, released,
    due (slots, counted from the phase's first), position (the order of the mix). weights: by source, as they are
    or in proportion; a null source is one of its own. Rows that repeat a doc_id have places of
    their own; those of one source, like its rows without a doc_id, are ranked in one sort. Extra columns are ignored; an empty table gives no rows. block_rows: see BLOCK_ROWS. The driver
    holds a number for each source.
    """
    spark = docs.sparkSession
    none = "\0"
    rows = docs.select("doc_id", "source", F.coalesce("source", F.lit(none)).alias("src"), F.xxhash64(F.lit(seed), "doc_id").alias("h"))
    rows = cut(rows, "mix")
    sizes = {r["src"]: r["n"] for r in rows.groupBy("src").agg(F.count("*").alias("n")).collect()}
    block_rows = block_rows or rows_of_a_block(sum(sizes.values()))
    if weights is None:
        share = {s: n**TEMPER for s, n in sizes.items()}
    else:
        share = {none if s is None else s: w for s, w in weights.items()}
        if missing := [s for s in sizes if share.get(s, 0) <= 0]:
            raise ValueError(f"no weight for {sorted(missing)}")
    plan = schedule({s: -(-n // block_rows) for s, n in sizes.items()}, share)
    # the sources' rows are ranked in ranges of their hash, so a large source is many small windows
    ranges = spark.createDataFrame([(s, -(-n // RANKED)) for s, n in sizes.items()], "src string, ranges long")
    rows = rows.join(F.broadcast(ranges), "src")
    rows = rows.withColumn("range", F.expr("shiftrightunsigned(shiftrightunsigned(h, 33) * ranges, 31)"))
    counts = rows.groupBy("src", "range").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("src").orderBy("range")) - F.col("n")).drop("n")
    unsigned = F.struct(F.expr("shiftrightunsigned(h, 1)"), F.expr("h & 1"), "doc_id")
    ranked = rows.withColumn("at", F.row_number().over(Window.partitionBy("src", "range").orderBy(unsigned)))
    ranked = ranked.join(before, ["src", "range"]).withColumn("source_rank", F.col("before") + F.col("at") - 1)
    ranked = ranked.withColumn("block", F.floor(F.col("source_rank") / block_rows))
    names = ["phase", "slot", "released", "due"]
    chunks = [(s, at // CHUNK, *(c[at : at + CHUNK] for c in places)) for s, places in plan.items() for at in range(0, len(places[0]), CHUNK)]
    columns = zip(["src", "chunk", *names], [pa.string(), pa.int64(), *[pa.list_(pa.int64())] * 4], strict=True)
    table = spark.createDataFrame(pa.table({k: pa.array([c[i] for c in chunks], kind) for i, (k, kind) in enumerate(columns)}))
    placed = ranked.withColumn("chunk", F.expr(f"block div {CHUNK}")).join(F.broadcast(table), ["src", "chunk"])
    placed = placed.select("doc_id", "source", "source_rank", "block", *(F.expr(f"{k}[cast(block % {CHUNK} as int)]").alias(k) for k in names))
    position = (F.col("slot") * block_rows + F.col("source_rank") % block_rows).alias("position")
    return placed.select("doc_id", "source", "source_rank", "block", F.col("phase").cast("int").alias("phase"), "slot", "released", "due", position)


def in_mix_order(docs: DataFrame, **options) -> DataFrame:
    """The rows in the order of the mix, with the columns they have, whatever their names; every row at a place of its own.

    Rows that repeat a doc_id and a source have its places in order of their texts. A null source is one of its own; an empty table gives no rows. Written as a table, the rows keep their order in its files;
    see places_in_order.
    """
    keys = ["d", "s", "no_d", "no_s"]
    known = [F.coalesce("doc_id", F.lit(0)).alias("d"), F.coalesce("source", F.lit("")).alias("s"), F.isnull("doc_id").alias("no_d"), F.isnull("source").alias("no_s")]
    places = cut(mix(docs, **options).select(*known, "position"), "places")
    rows = docs.select(F.struct(*docs.columns).alias("row"), *known)
    if not places.groupBy(*keys).count().where("count > 1").isEmpty():
        places = places.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("position")))
        rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("row.text", F.xxhash64("row"))))
        keys = [*keys, "nth"]
    joined = rows.join(places, keys).select("row", "position")
    return joined.repartitionByRange(partitions(docs.sparkSession), "position").sortWithinPartitions("position").select("row.*")


def stored(docs: DataFrame) -> DataFrame:
    """doc_id, text, source, file_no and row_no of a written table's rows: their places in its files. Rows from elsewhere are written first, as they come."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException as e:
        if e.getCondition() not in ("UNRESOLVED_COLUMN.WITH_SUGGESTION", "UNRESOLVED_COLUMN.WITHOUT_SUGGESTION", "FIELD_NOT_FOUND"):
            raise
        docs = cut(docs, "stored")
    file_no = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("bigint")
    return docs.select("doc_id", "text", "source", F.coalesce(file_no, F.lit(0)).alias("file_no"), F.col("_metadata.row_index").alias("row_no"))


def places_in_order(rows: DataFrame) -> DataFrame:
    """file_no, row_no, slot, position of rows(source, file_no, row_no) that stand in the order of a mix: what mix() says of them, read from the order alone.

    A source's rows form blocks in their order, and blocks have slots in the order of their first rows. Rows are counted within their files, and files summed up.
    """
    at = cut(rows.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("src"), "file_no", "row_no"), "order")
    block_rows = rows_of_a_block(at.count())
    earlier = lambda part, by: F.coalesce(F.sum("n").over(Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = at.groupBy("src", "file_no").agg(F.count("*").alias("n")).select("src", "file_no", earlier(["src"], "file_no").alias("before"))
    nth = F.row_number().over(Window.partitionBy("src", "file_no").orderBy("row_no")) - 1
    ranked = cut(at.withColumn("nth", nth).join(before, ["src", "file_no"]).select("src", "file_no", "row_no", (F.col("before") + F.col("nth")).alias("rank")), "ranked")
    ranked = ranked.withColumns({"block": F.expr(f"rank div {block_rows}"), "place": F.col("rank") % block_rows})
    first = ranked.where("place = 0")
    # as many rows as there are files
    blocks = first.groupBy("file_no").agg(F.count("*").alias("n")).select("file_no", earlier([], "file_no").alias("before"))
    of_file = F.row_number().over(Window.partitionBy("file_no").orderBy("row_no")) - 1
    slots = first.withColumn("nth", of_file).join(blocks, "file_no").select("src", "block", (F.col("before") + F.col("nth")).cast("bigint").alias("slot"))
    return ranked.join(slots, ["src", "block"]).select("file_no", "row_no", "slot", (F.col("slot") * block_rows + F.col("place")).alias("position"))


def sorted_by_position(rows: DataFrame, count: int) -> DataFrame:
    """The rows, about `count` of them, in order of position. Positions leave few gaps, so ranges need no sample."""
    n = partitions(rows.sparkSession)
    range_ = F.expr(f"cast(least({n - 1}, position * {n} div {max(1, count)}) as int)")
    return rows.repartitionById(n, range_).sortWithinPartitions("position")
