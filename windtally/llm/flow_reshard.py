"""Resharding by minimum-cost flow.

Old shards supply bytes, new shards have near-equal capacities; a byte that
stays in its shard costs nothing, a moved one costs 1.  The flow of least cost
(successive shortest paths) says how many bytes go from where to where.  It is
carried out in blocks: a row larger than ``1 / BLOCKS_PER_SHARD`` of a shard is
a block of its own, the other rows of an old shard are dealt by hash into
blocks of about that size.  So there are at most ``2 * BLOCKS_PER_SHARD *
n_new + n_old`` blocks however many rows there are, and only block sizes reach
the driver.  Affected shards are then rewritten by one shuffle of their rows.

Rows are dealt by a hash of their doc_id, size and place in the table, so
repeated rows and rows without doc_id spread like any others and the law holds
whatever a third of all rows have in common.  The place must be the same
whenever the table is read: ``row_id`` says what it is (for files: file and
row number); without one the rows are stored once with a number.

Law: ``bytes``.  Defined results: null texts have no bytes (size 16, crc of the
empty text); repeated rows are separate rows; null doc_ids are
dealt like a value; null old shards count as shard 0; an empty table gives no
rows.  Rows equal in all read columns are interchangeable between slots.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windtally.session import scratch_path

from .common import stored, table, text_of

N_SHARDS = 40
ROW_BYTES = 16
BLOCKS_PER_SHARD = 400
#: Rows of a shard are numbered in parts of about this size.
PART_BYTES = 32 << 20


def row_size(text: str = "text") -> Column:
    return F.octet_length(text_of(text)).cast("long") + ROW_BYTES


def min_cost_flow(supply: list[int], capacity: list[int], cost: np.ndarray) -> np.ndarray:
    """Integer flow of least total cost from every supply into the capacities
    (their sums are equal), by successive shortest paths (Bellman-Ford)."""
    n, m = len(supply), len(capacity)
    left, room = np.array(supply, dtype=np.int64), np.array(capacity, dtype=np.int64)
    flow = np.zeros((n, m), np.int64)
    far = np.float64(np.inf)
    while left.sum() > 0 and room.sum() > 0:
        du, dv = np.where(left > 0, 0.0, far), np.full(m, far)
        pu, pv = np.full(n, -1), np.full(m, -1)
        while True:
            via = du[:, None] + cost
            best = via.argmin(axis=0)
            better = via[best, np.arange(m)] < dv - 1e-12
            dv, pv = np.where(better, via[best, np.arange(m)], dv), np.where(better, best, pv)
            back = np.where(flow > 0, dv[None, :] - cost, far)
            best_b = back.argmin(axis=1)
            better_b = back[np.arange(n), best_b] < du - 1e-12
            du, pu = np.where(better_b, back[np.arange(n), best_b], du), np.where(better_b, best_b, pu)
            if not better.any() and not better_b.any():
                break
        j = int(np.where(room > 0, dv, far).argmin())
        path, at = [], j
        while True:
            i = int(pv[at])
            path.append((i, at, 1))
            if pu[i] < 0:
                break
            at = int(pu[i])
            path.append((i, at, -1))
        push = min([int(left[i]), int(room[j]), *(int(flow[a, b]) for a, b, way in path if way < 0)])
        for a, b, way in path:
            flow[a, b] += way * push
        left[i] -= push
        room[j] -= push
    return flow


def deal_blocks(blocks: list[tuple[int, int]], flow: np.ndarray, staying: list[int]) -> list[int]:
    """New shard of each block ``(old index, size)``: the largest first into
    the largest remaining flow of its old shard; then blocks move from the
    fullest to the emptiest shard while that brings them nearer."""
    rest, load, to = flow.astype(np.float64).copy(), np.zeros(flow.shape[1]), [0] * len(blocks)
    for k in sorted(range(len(blocks)), key=lambda k: (-blocks[k][1], k)):
        old, size = blocks[k]
        j = int(rest[old].argmax())
        if staying[old] >= 0 and rest[old, staying[old]] >= size:
            j = staying[old]
        rest[old, j] -= size
        load[j] += size
        to[k] = j
    held = [[] for _ in load]
    for k, j in enumerate(to):
        held[j].append((blocks[k][1], k))
    for h in held:
        h.sort()
    for _ in range(50 * len(load)):
        hi, lo = int(load.argmax()), int(load.argmin())
        gap = load[hi] - load[lo]
        fits = [x for x in held[hi] if x[0] < gap]
        if not fits:
            break
        size, k = min(fits, key=lambda x: abs(x[0] - gap / 2))
        held[hi].remove((size, k))
        held[lo].append((size, k))
        load[hi] -= size
        load[lo] += size
        to[k] = lo
    return to


def plan(docs: DataFrame, old: Column, n_new: int = N_SHARDS, row_id: Column | None = None) -> DataFrame:
    """``docs`` with ``_old, _size, _key, _shard``: every row's new shard."""
    spark = docs.sparkSession
    rows = docs.withColumn("_old", F.coalesce(old.cast("int"), F.lit(0)))
    if row_id is None:
        rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        row_id = F.col("_row")
    sized = rows.withColumn("_size", row_size()).withColumn("_key", F.xxhash64("doc_id", F.col("_size"), row_id)).drop("_row")
    totals = {r["_old"]: r["b"] for r in sized.groupBy("_old").agg(F.sum("_size").alias("b")).collect()}
    olds, total = sorted(totals), sum(totals.values())
    unit = max(1, math.ceil(total / n_new / BLOCKS_PER_SHARD))
    counts = {o: math.ceil(totals[o] / unit) for o in olds}
    pick = spark.createDataFrame([(o, counts[o]) for o in olds], "_old int, _n int")
    sized = (sized.join(F.broadcast(pick), "_old")  # one row for each old shard
             .withColumn("_own", F.col("_size") > unit)
             .withColumn("_block", F.when(F.col("_own"), F.col("_key")).otherwise(F.pmod("_key", "_n"))).drop("_n"))
    blocks = sized.groupBy("_old", "_own", "_block").agg(F.sum("_size").alias("b")).collect()  # bounded, see above
    capacity = [total // n_new + (j < total % n_new) for j in range(n_new)]
    cost = np.array([[0.0 if o == j else 1.0 for j in range(n_new)] for o in olds]).reshape(len(olds), n_new)
    flow = min_cost_flow([totals[o] for o in olds], capacity, cost)
    index = {o: i for i, o in enumerate(olds)}
    to = deal_blocks([(index[r["_old"]], r["b"]) for r in blocks], flow, [o if o < n_new else -1 for o in olds])
    dealt = spark.createDataFrame([(r["_old"], r["_own"], r["_block"], j) for r, j in zip(blocks, to)],
                                  "_old int, _own boolean, _block long, _shard int")
    return sized.join(F.broadcast(dealt), ["_old", "_own", "_block"])


def reshard(docs: DataFrame, old: Column, out: str, n_new: int = N_SHARDS, only_affected: bool = False,
            row_id: Column | None = None) -> DataFrame:
    """Write new shards as ``out/shard=<n>`` (doc_id, text, slot) and return
    all rows, those of written shards as read back.  With ``only_affected``, shards that neither lose nor
    gain a row are not rewritten: their rows are read where they are."""
    spark = docs.sparkSession
    ids = [] if row_id is None else [F.xxhash64(row_id).alias("_id")]
    planned = plan(docs.select("doc_id", "text", old.alias("_was"), *ids), F.col("_was"), n_new, F.col("_id") if ids else None)
    sums = planned.groupBy("_shard").agg(F.sum("_size").alias("b"), F.max(F.col("_old") != F.col("_shard")).alias("in"))
    facts = {r["_shard"]: r for r in sums.collect()}
    parts = max(1, math.ceil(max((r["b"] for r in facts.values()), default=0) / PART_BYTES))
    if only_affected:
        losing = {r["_old"] for r in planned.where("_old <> _shard").select("_old").distinct().collect()}
        touched = sorted({j for j, r in facts.items() if r["in"]} | losing)
    planned = planned.withColumn("_part", F.pmod(F.col("_key"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("_shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (planned.groupBy("_shard", "_part").agg(F.count(F.lit(1)).alias("n"))
             .select("_shard", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base")))
    inside = Window.partitionBy("_shard", "_part").orderBy("doc_id", "_size", "text")
    rows = planned.select("doc_id", "text", "_shard", "_part", F.row_number().over(inside).alias("_nth"))
    bases = bases.withColumnsRenamed({"_shard": "_s", "_part": "_p"})
    slotted = rows.join(bases, (rows["_shard"] == bases["_s"]) & (rows["_part"] == bases["_p"]))
    done = slotted.select("doc_id", "text", (F.col("_base") + F.col("_nth") - 1).alias("slot"), F.col("_shard").alias("shard"))
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, slot long, shard int"
    written = done.where(F.col("shard").isin(touched)) if only_affected else done
    written.write.partitionBy("shard").parquet(out)
    back = spark.read.schema(kinds).parquet(out)
    return back.unionByName(done.where(~F.col("shard").isin(touched))) if only_affected else back


def op8_flow_reshard(spark, sf_dir: str) -> DataFrame:
    """The table is taken as stored by source (old shard: crc32 of the source
    modulo 40) and goes to 40 shards of equal bytes."""
    docs = table(spark, sf_dir, "documents").withColumn("_place", F.struct("_metadata.file_path", "_metadata.row_index"))
    old = F.pmod(F.crc32(F.encode(F.coalesce(F.col("source").cast("string"), F.lit("")), "UTF-8")), F.lit(N_SHARDS)).cast("int")
    files = reshard(docs, old, f"{scratch_path(spark, 'reshard')}/shards", row_id=F.xxhash64("_place.file_path", "_place.row_index"))
    return files.select("doc_id", row_size().alias("size"), F.crc32(F.encode(text_of(), "UTF-8")).alias("text_crc32"),
                        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
