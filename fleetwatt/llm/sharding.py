"""Shards of nearly equal bytes by range partitioning at sampled splitters.

Records are ordered by two hashes: of their group, so that equal texts lie side by side, and of the
record, so that a group of any size can be cut. Ranges of that order come from splitters: a sample
that prefers large records, cut at its weighted quantiles. A range that is still overfull is
subdivided by a sample of its own. Exact sizes of the ranges, and sums inside each, give every
record the bytes and the records before it, and shards are cut at equal bytes. So the sample decides
how the work is spread, never the result. DataFrame functions only.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwatt.llm.steps import stored

SHARDS = 16
PARTS = 64  # ranges that a range is divided into
SAMPLE = 64 * PARTS  # expected records of a sample
RANGE_ROWS = 250_000  # a range with more different records is overfull
LARGE = 64  # a record above this part of a shard is placed by itself
COPIES = 4096  # equal records that one array lists

_KEY = ["_h", "_e"]
_FULL = Window.unboundedPreceding, Window.unboundedFollowing
_BEFORE = Window.unboundedPreceding, -1


def _cuts(rows: DataFrame, level: int, size: str) -> DataFrame:
    """_node, _cuts: at most PARTS - 1 splitters of each node, in order.

    Half of a record's chance comes from its share of the node's bytes, half from its being one of
    its records, so the parts are even in both. _bytes and _keys are the node's totals.
    """
    measure = (F.col("_n") * F.col(size) / F.greatest("_bytes", F.lit(1)) + F.lit(1.0) / F.greatest("_keys", F.lit(1))) * (SAMPLE / 2)
    chance = F.shiftrightunsigned(F.xxhash64(*_KEY, F.lit(level)), 11) / float(1 << 53)
    drawn = rows.withColumn("_m", measure).where(chance < F.col("_m")).select("_node", *_KEY, F.greatest("_m", F.lit(1.0)).alias("_w"))
    order = Window.partitionBy("_node").orderBy(*_KEY)
    before = F.coalesce(F.sum("_w").over(order.rowsBetween(*_BEFORE)), F.lit(0.0))
    whole = F.sum("_w").over(Window.partitionBy("_node"))
    ranked = drawn.withColumn("_q", F.floor(before / whole * PARTS))
    ends = ranked.withColumn("_last", F.lag("_q", 1, 0).over(order)).where("_q > _last")
    return ends.groupBy("_node").agg(F.sort_array(F.collect_list(F.struct(*_KEY))).alias("_cuts"))


def _part(cuts: Column) -> Column:
    key = F.struct(*_KEY)
    return F.coalesce(F.size(F.filter(cuts, lambda c: c <= key)), F.lit(0))


def _ranged(counted: DataFrame, size: str, totals, range_rows: int) -> DataFrame:
    """Every record with its range (_node) and the bytes and records before that range."""
    root = F.lit(1).cast("bigint")
    rows = counted.withColumns({"_node": root, "_bytes": F.lit(totals["bytes"]), "_keys": F.lit(totals["keys"])})
    # The first splitters are at most PARTS - 1 pairs of numbers, whatever the table.
    first = _cuts(rows, 0, size).first()
    literal = F.array(*[F.struct(F.lit(c["_h"]).alias("_h"), F.lit(c["_e"]).alias("_e")) for c in first["_cuts"]]) if first else None
    placed = rows.withColumn("_part", _part(literal) if literal is not None else F.lit(0))
    parents, done, level = None, [], 0
    while True:
        placed = placed.drop("_bytes", "_keys", "_rows_at", "_bytes_at").withColumn("_child", F.col("_node") * PARTS + F.col("_part"))
        children = placed.groupBy("_node", "_child").agg(
            F.sum("_n").alias("_rows"), F.sum(F.col("_n") * F.col(size)).alias("_bytes"), F.count("*").alias("_keys")
        )
        order = Window.partitionBy("_node").orderBy("_child").rowsBetween(*_BEFORE)
        at = {f"_{x}_at": F.coalesce(F.sum(f"_{x}").over(order), F.lit(0)) for x in ("rows", "bytes")}
        children = children.withColumns(at)
        if parents is not None:
            above = parents.select(F.col("_child").alias("_node"), F.col("_rows_at").alias("_r"), F.col("_bytes_at").alias("_b"))
            children = children.join(above, "_node").withColumns({"_rows_at": F.col("_rows_at") + F.col("_r"), "_bytes_at": F.col("_bytes_at") + F.col("_b")})
        children = stored(children.select("_child", "_keys", "_bytes", "_rows_at", "_bytes_at"), "shard_ranges")
        joined = placed.drop("_node", "_part").join(children, "_child").withColumnRenamed("_child", "_node")
        done.append(joined.where(F.col("_keys") <= range_rows).drop("_keys", "_bytes"))
        if children.where(F.col("_keys") > range_rows).isEmpty():
            break
        level += 1
        rows = stored(joined.where(F.col("_keys") > range_rows), "shard_overfull")
        placed = rows.join(_cuts(rows, level, size), "_node", "left").withColumn("_part", _part(F.col("_cuts"))).drop("_cuts")
        parents = children
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _copies(rows: DataFrame) -> DataFrame:
    """One row per copy (_copy from 0); of many copies, tasks share the blocks."""
    few = rows.where(F.col("_n") <= COPIES).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    blocks = rows.where(F.col("_n") > COPIES).withColumn("_block", F.explode(F.expr(f"sequence(0, (_n - 1) div {COPIES})")))
    last = F.least((F.col("_block") + 1) * COPIES, F.col("_n")) - 1
    many = blocks.repartition(*_KEY, "_block").withColumn("_copy", F.explode(F.sequence(F.col("_block") * COPIES, last))).drop("_block")
    return few.unionByName(many)


def _levelled(loads: list[int], rest: int) -> list[int]:
    """Ends of the shards in the bytes that are left, so that all shards fill up to one level."""
    low, high = min(loads), max(loads) + rest
    while low < high:
        level = (low + high) // 2
        low, high = (level + 1, high) if sum(max(level - x, 0) for x in loads) < rest else (low, level)
    ends, at = [], 0
    for x in loads:
        at += max(low - x, 0)
        ends.append(min(at, rest))
    return ends


def byte_shards(
    rows: DataFrame, group: list[str], size: str = "size", shards: int = SHARDS, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """All rows with `shard` (from 0) and `slot` (gapless from 0 in each shard); bytes are even.

    Shards differ from one level by less than a LARGE-th of a shard. The records above that size,
    fewer than LARGE times the shards, are placed first, largest to emptiest; where one of them is
    above the level, its shard holds no other record that could go elsewhere. Rows with equal group
    columns share a shard unless a boundary falls among them or they are placed first. Equal rows are counted, kept and
    placed one by one; NULLs are values like others. A NULL size counts as 0, a negative one is an
    error of the caller. Columns must be orderable; names that begin with _ are the operator's.
    An empty table gives no rows.
    """
    own = rows.columns
    sized = rows.withColumn("_size", F.coalesce(F.col(size), F.lit(0)).cast("bigint"))
    keyed = sized.withColumns({"_h": F.xxhash64(*group), "_e": F.xxhash64(*own)})
    counted = stored(keyed.groupBy(*own, "_size", *_KEY).agg(F.count("*").alias("_n")), "shard_keys")
    nothing = F.lit(0).cast("bigint")
    totals = counted.agg(
        F.coalesce(F.sum(F.col("_n") * F.col("_size")), nothing).alias("bytes"), F.count("*").alias("keys")
    ).first()

    large = F.col("_size") * (shards * LARGE) > F.lit(totals["bytes"])
    order = Window.orderBy(F.desc("_size"), *_KEY, *own, "_copy")
    giants = _copies(counted.where(large)).withColumn("_g", F.row_number().over(order))
    loads, held, place = [0] * shards, [0] * shards, []
    heap = [(0, s) for s in range(shards)]
    for r in giants.select("_size").orderBy("_g").collect():  # fewer than LARGE * shards
        load, s = heapq.heappop(heap)
        place.append((s, held[s]))
        loads[s], held[s] = load + r["_size"], held[s] + 1
        heapq.heappush(heap, (loads[s], s))

    small = counted.where(~large)
    rest = small.agg(F.coalesce(F.sum(F.col("_n") * F.col("_size")), nothing).alias("bytes"), F.count("*").alias("keys")).first()
    ends = _levelled(loads, rest["bytes"])
    ranged = _ranged(small, "_size", rest, range_rows)
    inside = Window.partitionBy("_node").orderBy(*_KEY, *own).rowsBetween(*_BEFORE)
    before = {
        "_rows_at": F.col("_rows_at") + F.coalesce(F.sum("_n").over(inside), F.lit(0)),
        "_bytes_at": F.col("_bytes_at") + F.coalesce(F.sum(F.col("_n") * F.col("_size")).over(inside), F.lit(0)),
    }
    numbered = stored(ranged.withColumns(before).drop("_node"), "shard_order")
    middle = 2 * (F.col("_bytes_at") + F.col("_copy") * F.col("_size")) + F.col("_size")
    shard = sum(((middle >= 2 * end).cast("int") for end in ends[:-1]), F.lit(0))
    cut = _copies(numbered).select(*own, shard.alias("shard"), (F.col("_rows_at") + F.col("_copy")).alias("_rank"))
    begins = cut.groupBy(F.col("shard")).agg(F.min("_rank").alias("_begin"))
    there = F.element_at(F.array(*[F.lit(x).cast("bigint") for x in held]), F.col("shard") + 1)
    spread = cut.join(begins, "shard").select(*own, "shard", (F.col("_rank") - F.col("_begin") + there).alias("slot"))
    if not place:
        return spread
    to = lambda k, kind: F.element_at(F.array(*[F.lit(p[k]).cast(kind) for p in place]), F.col("_g"))
    return spread.unionByName(giants.select(*own, to(0, "int").alias("shard"), to(1, "bigint").alias("slot")))


def document_shards(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """doc_id, size, text_crc32, text_hash, shard, slot: documents in shards of equal bytes.

    The size is the text's bytes and 1; a NULL text has none, and the checksum of the empty one.
    Equal texts are a group. Only ids, sizes and hashes are moved. Other columns are left out.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body).cast("bigint") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("text_hash"),
    )
    return byte_shards(rows, ["text_hash"], "size", shards, range_rows)
