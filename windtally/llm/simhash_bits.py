"""SimHash near-duplicates with bit-sliced comparison.

Fingerprint: lower-case A-Z, blank-delimited words, 3-word shingles (repeats
count), XXH64 with seed 42 per shingle (Spark's ``xxhash64``), bit set if set
in more than half the hashes.  Fingerprints within ``RADIUS`` bits are linked;
a component is everything reachable.

Candidates: 64 bits are cut into 8 blocks of 8.  Two fingerprints at most 2
bits apart agree on at least 6 blocks, so they share one of the 28 keys that
leave two blocks out.  A key's members agree on 48 bits, so a key never holds
more than 2**16 distinct fingerprints however many documents there are: equal
fingerprints are collapsed first, and nothing is capped.  Inside a key, bit
planes are stored vertically (64 members to a word), distances of a query to
64 members advance together in carry-save counters, and words whose members
have all passed the radius are abandoned.

Defined results: a null or blank text has fingerprint zero and is linked like
any other; null doc_ids take part, but a component's id is its smallest
non-null doc_id (null if it has none); repeated rows are returned each; an
empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, row_identity, stored, text_of, words_of
from .graph import components

SHINGLE = 3
RADIUS = 2
BLOCKS = 8
#: (query, word) items compared at a time.
CHUNK = 1 << 17


def shingle_hashes(size: int = SHINGLE) -> str:
    joined = ", ".join(f"words[i + {k}]" for k in range(size))
    return (f"case when size(words) = 0 then cast(array() as array<bigint>) "
            f"when size(words) < {size} then array(xxhash64(array_join(words, ' '))) "
            f"else transform(sequence(0, size(words) - {size}), i -> xxhash64(concat_ws(' ', {joined}))) end")


def majority_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit majority fingerprint per run ``hashes[offsets[i]:offsets[i+1]]``.

    Eight bit counts are kept in the bytes of one word; a byte holds at most
    255, so runs are cut into pieces of 255 hashes."""
    n = np.diff(offsets)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    pieces = (n[full] + 254) // 255
    first = np.concatenate([[0], np.cumsum(pieces)[:-1]])
    at = np.repeat(offsets[:-1][full], pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    used = hashes[: offsets[-1]].view(np.uint64)
    for s in range(8):
        lanes = np.add.reduceat((used >> np.uint64(s)) & np.uint64(0x0101010101010101), at)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for byte in range(8):
            out[full] |= (2 * counts[:, byte] > n[full]).astype(np.uint64) << np.uint64(8 * byte + s)
    return out


def _fingerprint_batches(batches):
    for b in batches:
        h = b.column(1)
        offsets = h.offsets.to_numpy().astype(np.int64)
        flat = h.values.to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(majority_bits(flat[offsets[0]:], offsets - offsets[0]).view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed 64-bit integer."""
    hashed = (docs.select("doc_id", words_of(ascii_lower(text_of()), BLANKS).alias("words"))
              .select("doc_id", F.expr(shingle_hashes()).alias("h")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return hashed.mapInArrow(_fingerprint_batches, f"doc_id {kind}, fp bigint")


def close_pairs(fps: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of lanes (i < j) of one block, ``starts[k]:starts[k+1]``, at
    most ``radius`` bits apart."""
    sizes = np.diff(starts)
    block = np.repeat(np.arange(len(sizes)), sizes)
    pos = np.arange(len(fps)) - starts[block]
    lane = (pos & 63).astype(np.uint64)
    first = np.flatnonzero(lane == 0)  # first member of each word
    word_ends = np.cumsum((sizes + 63) // 64)
    word = np.cumsum(lane == 0) - 1
    planes = [np.bitwise_or.reduceat(((fps >> np.uint64(p)) & np.uint64(1)) << lane, first) for p in range(64)]
    held = np.bitwise_or.reduceat(np.uint64(1) << lane, first)
    per_query = word_ends[block] - word
    left, right = [], []
    done = np.concatenate([[0], np.cumsum(per_query)])
    bits = (radius + 1).bit_length()
    for lo in range(0, int(done[-1]), CHUNK):
        item = np.arange(lo, min(lo + CHUNK, int(done[-1])))
        q = np.searchsorted(done, item, "right") - 1
        w = word[q] + item - done[q]
        own = np.where(w == word[q], ~((np.uint64(2) << lane[q]) - np.uint64(1)), ~np.uint64(0))
        open_ = held[w] & own
        keep = open_ != 0
        q, w, open_ = q[keep], w[keep], open_[keep]
        value = fps[q]
        counters = [np.zeros(len(q), np.uint64) for _ in range(bits)]
        for p in range(64):
            carry = planes[p][w] ^ (np.uint64(0) - ((value >> np.uint64(p)) & np.uint64(1)))
            for c in counters:  # carry-save: add one bit to 64 counters at once
                nxt = c & carry
                c ^= carry
                carry = nxt
            open_ &= ~carry  # overflow: far beyond the radius
            if p % 8 == 7:
                open_ &= ~_above(counters, radius)
                alive = open_ != 0
                if len(alive) and alive.mean() < 0.75:  # abandon finished words
                    q, w, open_, value = q[alive], w[alive], open_[alive], value[alive]
                    counters = [c[alive] for c in counters]
        hit, bit = np.nonzero(np.unpackbits(open_.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        left.append(q[hit])
        right.append(first[w[hit]] + bit)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _above(counters: list[np.ndarray], limit: int) -> np.ndarray:
    gt, eq = np.uint64(0), ~np.uint64(0)
    for j in reversed(range(len(counters))):
        if limit >> j & 1:
            eq = eq & counters[j]
        else:
            gt = gt | (eq & counters[j])
            eq = eq & ~counters[j]
    return gt


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest lane reachable from each lane."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _link_batches(radius: int):
    def links(batches):
        for batch in batches:
            members = batch.column(0)
            starts = members.offsets.to_numpy().astype(np.int64)
            fps = members.values.to_numpy(zero_copy_only=False).view(np.uint64)[starts[0]:starts[-1]]
            a, b = close_pairs(fps, starts - starts[0], radius)
            label = _spanning(len(fps), a, b)
            at = np.flatnonzero(label != np.arange(len(fps)))
            yield pa.RecordBatch.from_arrays([pa.array(fps[at].view(np.int64)), pa.array(fps[label[at]].view(np.int64))], ["a", "b"])
    return links


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly what links of at most ``radius``
    bits connect: per key a spanning forest, so their number is linear in the members."""
    width = 64 // blocks
    keys = []
    for t, out in enumerate(combinations(range(blocks), radius)):
        mask = (1 << 64) - 1
        for k in out:
            mask &= ~(((1 << width) - 1) << (width * k))
        mask = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key")))
    groups = (distinct.select("fp", F.explode(F.array(*keys)).alias("k")).groupBy("k.t", "k.key")
              .agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1))
    return groups.select("members").mapInArrow(_link_batches(radius), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``."""
    fps = stored(fingerprints(docs), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(fingerprint_links(distinct, radius))
    joined = stored(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_fp = joined.join(least, "root").select("fp", "component_id")
    return (fps.join(per_fp, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, that stand for their component: the one
    with its smallest doc_id.  A document is told by (doc_id, text), so an id
    that comes with several texts loses none of them to the others' groups; of
    rows that repeat both one stays.  A row without doc_id can't be told from
    others by name and stays."""
    name = F.when(F.col("doc_id").isNotNull(), F.struct(*row_identity()))
    found = stored(near_duplicates(docs.select(name.alias("doc_id"), "text")).select("doc_id", "component_id"), "simhash-kept")
    leaders = (found.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
               .select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.text_key").alias("_key"), "_n"))
    text_key = F.xxhash64(text_of())
    kept = docs.join(leaders, (docs["doc_id"] == leaders["_id"]) & (text_key == leaders["_key"]), "left_semi")
    if leaders.where("_n > 1").limit(1).count():
        kept = kept.withColumn("_simhash_text", text_key).dropDuplicates(["doc_id", "_simhash_text"]).drop("_simhash_text")
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def op4_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return near_duplicates(table(spark, sf_dir, "documents"))
