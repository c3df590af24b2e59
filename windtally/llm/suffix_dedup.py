"""Exact removal of repeated byte strings: suffixes sorted by radix passes, only as deep as the threshold.

A window is ``length`` consecutive bytes of one document, that is a suffix cut
at the threshold.  Two windows are equal exactly if they stay in one group
through all radix passes, so groups need no order among each other.

* The first digit of a window is its anchor: the least hash among its 16-byte
  grams.  Neighbouring windows mostly share it, so a run of them (some 18, at
  most ``RUN``) travels as one record.  A first exchange of hashes alone finds
  the anchors that occur in two different documents; all other windows are in
  groups of one and leave the sort here.
* The records that stay are dealt out by anchor together with their bytes.  In a bucket,
  equal records are one, and the windows of anchors with several different records are
  ordered by their bytes, eight at a time from the most significant on.  After
  each pass, groups that come from one document leave.
* What is left at full depth are the repeated windows; the least doc_id of each
  group goes back to the blocks of documents that hold it, which remove the
  bytes covered by windows with a smaller doc_id.

Blocks of documents (``BLOCK_BYTES``) are packed once; one exchange of them serves all
three passes over the texts.  Each block sends a bucket every different record
once, so a passage that a third of all documents share costs a record a block.
An anchor with more than ``HOT`` places may have as many different
surroundings; its windows travel one by one, dealt out by their own bytes.
Hashes only deal out and prune: equality is decided on bytes.

Defined results: null and empty texts have no bytes; a null doc_id counts as
smaller than any other; rows that repeat a doc_id remove nothing from each
other, but each counts and is returned; a text below the threshold keeps all; an
empty table gives no rows.  Only doc_id (an integer) and text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, text_of

LENGTH = 50
#: Bytes of an anchor; the threshold must not be less.
GRAM = 16
#: Most windows of a record.
RUN = 64
#: Text of a block and, on average, of a bucket.
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20
#: An anchor with more places than this is dealt out window by window.
HOT = 20_000
#: Window starts handled at a time in a block, and windows sorted at a time in a bucket.
CHUNK, SORTED = 1 << 17, 1 << 18

_NO_ID = np.iinfo(np.int64).min
_BLOCK = "block long, ids binary, known binary, sizes binary, data binary"
_MESSAGE = "block long, bucket long, payload binary"


# ------------------------------------------------------------------ encoding
def _pack(arrays: list[np.ndarray], tail: bytes = b"") -> bytes:
    """Arrays of one length, byte plane by byte plane, and some bytes, as a zstd frame."""
    head = np.array([len(arrays[0])], "<u4").tobytes()
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head, *planes, tail]))


def _unpack(payload: bytes, kinds: list[str]) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, at, out = int(np.frombuffer(raw, "<u4", 1)[0]), 4, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return out, raw[at:]


def _deltas(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def _groups(*keys: np.ndarray) -> np.ndarray:
    """First places of runs of equal keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each count n, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _messages(block: list[int], bucket: list[int], payload: list[bytes]) -> pa.Table:
    return pa.table({"block": pa.array(block, pa.int64()), "bucket": pa.array(bucket, pa.int64()), "payload": pa.array(payload, pa.binary())})


# -------------------------------------------------------------------- blocks
def _block_rows(block_bytes: int):
    def pack(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        texts: list[bytes] = []
        size = 0

        def row():
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pa.RecordBatch.from_pydict({
                "block": pa.array([part << 32 | seq], pa.int64()),
                "ids": [np.array([_NO_ID if i is None else i for i in ids], "<i8").tobytes()],
                "known": [np.array([i is not None for i in ids], np.uint8).tobytes()],
                "sizes": [np.array([len(t) for t in texts], "<i8").tobytes()], "data": [data]})

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= block_bytes:
                    yield row()
                    ids, texts, size, seq = [], [], 0, seq + 1
        if ids:
            yield row()
    return pack


class Block:
    """The documents of a block and the records of their windows, in order of their anchors."""

    def __init__(self, t: pa.Table, length: int, buckets: int):
        row = {k: v[0] for k, v in t.to_pydict().items()}
        self.number, self.length, self.buckets = row["block"], length, buckets
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.known = np.frombuffer(row["known"], np.uint8).astype(bool)
        self.ends = np.cumsum(np.frombuffer(row["sizes"], "<i8"))
        self.raw = zstandard.ZstdDecompressor().decompress(row["data"]) if len(self.ends) and self.ends[-1] else b""
        start, count, anchor = self._runs()
        anchor = anchor * np.uint64(0x9E3779B97F4A7C15)  # least hashes crowd at the lower end; the product's high bits are even
        order = np.argsort(anchor, kind="stable")
        self.start, self.count, anchor = start[order], count[order], anchor[order]
        self.doc = np.searchsorted(self.ends, self.start, "right")
        self.rank = self.ids[self.doc]
        self.first = _groups(anchor)
        self.anchors = anchor[self.first]
        #: Of each record, the place of its anchor.
        self.anchor_of = np.repeat(np.arange(len(self.first)), np.diff(self.first, append=len(anchor)))
        bucket = ((self.anchors >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        #: (bucket, from, to) over the anchors
        cuts = _groups(bucket)
        self.slices = list(zip(bucket[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(bucket)])) if len(bucket) else []

    def _runs(self):
        """Runs of neighbouring windows with one anchor: first start, number of windows, anchor."""
        buf, n, size = np.frombuffer(self.raw, np.uint8), len(self.raw), self.length
        begins = self.ends - np.diff(self.ends, prepend=0)
        starts, counts, anchors = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for lo in range(0, n, CHUNK):
            piece = buf[lo:min(n, lo + CHUNK + size - 1)]
            m = len(piece) - size + 1
            if m <= 0:
                break
            least = _least_grams(piece, size)
            # windows that begin too near the end of their document are none
            change = np.zeros(m + 1, np.int32)
            np.add.at(change, np.clip(np.maximum(begins, self.ends - size + 1) - lo, 0, m), 1)
            np.add.at(change, np.clip(self.ends - lo, 0, m), -1)
            at = np.flatnonzero(np.cumsum(change[:m]) == 0)
            if not len(at):
                continue
            anchor = least[at]
            new = _groups(at - np.arange(len(at)), anchor)
            long = np.diff(new, append=len(at))
            pieces = -(-long // RUN)  # a long run (periodic text) is cut
            step = _ranges(pieces) * RUN
            starts.append(np.repeat(at[new], pieces) + step + lo)
            counts.append(np.minimum(RUN, np.repeat(long, pieces) - step))
            anchors.append(np.repeat(anchor[new], pieces))
        return np.concatenate(starts), np.concatenate(counts), np.concatenate(anchors)

    def records(self, status: np.ndarray):
        """The different records of the anchors with a status: their places in ``self.start``
        (or the window starts of hot ones), documents' ranks and numbers, and of each number the bytes, windows, anchor and bucket."""
        state = status[self.anchor_of]
        raw, more = self.raw, self.length - 1
        plain = np.flatnonzero(state == 1)
        hot = np.flatnonzero(state == 2)
        start = np.concatenate([self.start[plain], np.repeat(self.start[hot], self.count[hot]) + _ranges(self.count[hot])])
        count = np.concatenate([self.count[plain], np.ones(int(self.count[hot].sum()), np.int64)])
        rank = np.concatenate([self.rank[plain], np.repeat(self.rank[hot], self.count[hot])])
        seen: dict[bytes, int] = {}
        number = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start.tolist(), (start + count + more).tolist())], np.int64)
        texts = list(seen)
        windows = np.zeros(len(texts), np.int64)
        windows[number] = count
        anchor = np.zeros(len(texts), np.uint64)
        anchor[number[:len(plain)]] = self.anchors[self.anchor_of[plain]]
        for j in np.unique(number[len(plain):]).tolist():
            anchor[j] = zlib.crc32(texts[j]) << 32
        # by anchor, and so by bucket
        order = np.argsort(anchor, kind="stable")
        where = np.empty_like(order)
        where[order] = np.arange(len(order))
        anchor = anchor[order]
        bucket = ((anchor >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)
        return start, rank, where[number], [texts[i] for i in order.tolist()], windows[order], anchor, bucket


def _least_grams(piece: np.ndarray, size: int) -> np.ndarray:
    """The least gram hash of each window."""
    n = len(piece)
    words = np.ndarray((n - 7,), "<u8", np.ascontiguousarray(piece), strides=(1,)).astype(np.uint64)
    h = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
    h ^= (words[8:] + np.uint64(0x7F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(29)
    span, wanted = 1, size - GRAM + 1
    while span < wanted:
        step = min(span, wanted - span)
        h = np.minimum(h[:-step], h[step:])
        span += step
    return h


# --------------------------------------------------- first digit: the anchors
def _send_anchors(length: int, buckets: int):
    def send(t: pa.Table) -> pa.Table:
        b = Block(t, length, buckets)
        if not len(b.first):
            return _messages([], [], [])
        low, high = np.minimum.reduceat(b.rank, b.first), np.maximum.reduceat(b.rank, b.first)
        places = np.diff(b.first, append=len(b.rank)).astype("<u4")
        out = [_pack([_deltas(b.anchors[i:j]), low[i:j], high[i:j] - low[i:j], places[i:j]]) for _, i, j in b.slices]
        return _messages([b.number] * len(out), [s[0] for s in b.slices], out)
    return send


def _judge_anchors(t: pa.Table) -> pa.Table:
    """Status of every anchor sent: 0 in one document only, 1 in several, 2 in several and hot."""
    parts = [_unpack(p, ["<u8", "<i8", "<i8", "<u4"])[0] for p in t.column("payload").to_pylist()]
    anchor = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    low = np.concatenate([p[1] for p in parts])
    high = low + np.concatenate([p[2] for p in parts])
    places = np.concatenate([p[3] for p in parts]).astype(np.int64)
    order = np.argsort(anchor, kind="stable")
    first = _groups(anchor[order])
    several = np.minimum.reduceat(low[order], first) < np.maximum.reduceat(high[order], first)
    hot = np.add.reduceat(places[order], first) > HOT
    status = np.zeros(len(anchor), np.uint8)
    status[order] = np.repeat(np.where(several, 1 + hot, 0), np.diff(first, append=len(anchor)))
    ends = np.cumsum([len(p[0]) for p in parts])
    mine = [status[e - len(p[0]):e] for p, e in zip(parts, ends)]
    some = [i for i, s in enumerate(mine) if s.any()]
    block, bucket = t.column("block").to_pylist(), t.column("bucket").to_pylist()
    return _messages([block[i] for i in some], [bucket[i] for i in some], [_pack([mine[i]]) for i in some])


def _status(b: Block, answers: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(len(b.anchors), np.uint8)
    for bucket, i, j in b.slices:
        if bucket in answers:
            out[i:j] = _unpack(answers[bucket], ["u1"])[0][0]
    return out


# ------------------------------------------------- further digits: the bytes
def _send_records(length: int, buckets: int):
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _messages([], [], [])
        b = Block(left, length, buckets)
        answers = dict(zip(right.column("bucket").to_pylist(), right.column("payload").to_pylist()))
        _, rank, number, texts, windows, anchor, bucket = b.records(_status(b, answers))
        low = np.full(len(texts), np.iinfo(np.int64).max)
        high = np.full(len(texts), _NO_ID)
        np.minimum.at(low, number, rank)
        np.maximum.at(high, number, rank)
        cuts = _groups(bucket)
        out = [_pack([windows[i:j].astype("<u4"), _deltas(anchor[i:j]), low[i:j], high[i:j] - low[i:j]], b"".join(texts[i:j]))
               for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)])]
        return _messages([b.number] * len(out), bucket[cuts].tolist(), out)
    return send


def radix_groups(data: np.ndarray, at: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray, length: int):
    """Most-significant-digit passes over the windows ``data[at:at + length]`` inside the given groups.

    ``low`` and ``high`` are the least and largest rank of each window's documents.
    Returns the places in ``at`` of the windows that reach full depth in a group of
    several ranks, and the least rank of their groups."""
    words = np.ndarray((len(data) - 7,), ">u8", np.ascontiguousarray(data), strides=(1,))
    alive = np.arange(len(at))
    for depth in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        digit = words[at[alive] + depth].astype(np.uint64)
        order = np.lexsort((digit, group))
        alive, group, digit = alive[order], group[order], digit[order]
        first = _groups(group, digit)
        size = np.diff(first, append=len(alive))
        if len(first):
            stays = np.repeat(np.minimum.reduceat(low[alive], first) < np.maximum.reduceat(high[alive], first), size)
            alive, group = alive[stays], np.repeat(np.arange(len(first)), size)[stays]
    first = _groups(group)
    least = np.minimum.reduceat(low[alive], first) if len(first) else low[:0]
    return alive, np.repeat(least, np.diff(first, append=len(alive)))


def _sort_records(length: int):
    def judge(t: pa.Table) -> pa.Table:
        """For each record sent: the runs of its windows that a smaller rank holds, with that rank."""
        seen: dict[bytes, int] = {}
        numbers, lows, highs, windows, anchors = [], [], [], [], []
        for payload in t.column("payload").to_pylist():
            (count, anchor, low, more), raw = _unpack(payload, ["<u4", "<u8", "<i8", "<i8"])
            ends = np.cumsum(count.astype(np.int64) + length - 1).tolist()
            numbers.append(np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip([0, *ends], ends)], np.int64))
            lows.append(low)
            highs.append(low + more)
            windows.append(count)
            anchors.append(np.cumsum(anchor, dtype=np.uint64))
        number = np.concatenate(numbers)
        low, high = np.full(len(seen), np.iinfo(np.int64).max), np.full(len(seen), _NO_ID)
        np.minimum.at(low, number, np.concatenate(lows))
        np.maximum.at(high, number, np.concatenate(highs))
        count, anchor = np.zeros(len(seen), np.int64), np.zeros(len(seen), np.uint64)
        count[number], anchor[number] = np.concatenate(windows), np.concatenate(anchors)
        order = np.argsort(anchor, kind="stable")
        first = _groups(anchor[order])
        size = np.diff(first, append=len(order))
        several = (size > 1) & (np.minimum.reduceat(low[order], first) < np.maximum.reduceat(high[order], first))
        texts = list(seen)
        # runs (record, first window, last window + 1, least rank); records of their own have one run
        alone = order[np.repeat(~several, size)]
        runs = [(alone, np.zeros(len(alone), np.int64), count[alone], low[alone])]
        todo: list[np.ndarray] = []
        held = 0
        for f, n in zip(first[several].tolist(), size[several].tolist()):
            todo.append(order[f:f + n])
            held += int(count[todo[-1]].sum())
            if held >= SORTED:
                runs.append(_sorted_runs(todo, texts, count, low, high, length))
                todo, held = [], 0
        if todo:
            runs.append(_sorted_runs(todo, texts, count, low, high, length))
        record, j0, j1, least = (np.concatenate([r[k] for r in runs]) for k in range(4))
        by = np.argsort(record, kind="stable")
        record, j0, j1, least = record[by], j0[by], j1[by], least[by]
        n_runs = np.bincount(record, minlength=len(seen))
        opens = np.cumsum(n_runs) - n_runs
        block, bucket, payloads = [], [], []
        for b, k, mine, top in zip(t.column("block").to_pylist(), t.column("bucket").to_pylist(), numbers, highs):
            place = np.repeat(np.arange(len(mine)), n_runs[mine])
            at = np.repeat(opens[mine], n_runs[mine]) + _ranges(n_runs[mine])
            useful = least[at] < top[place]
            if useful.any():
                place, at = place[useful], at[useful]
                block.append(b)
                bucket.append(k)
                payloads.append(_pack([place.astype("<u4"), j0[at].astype("<u4"), j1[at].astype("<u4"), least[at]]))
        return _messages(block, bucket, payloads)
    return judge


def _sorted_runs(todo: list[np.ndarray], texts: list[bytes], count: np.ndarray, low: np.ndarray, high: np.ndarray, length: int):
    """Runs of the records of some anchors, their windows sorted by bytes."""
    records = np.concatenate(todo)
    group = np.repeat(np.arange(len(todo)), [len(x) for x in todo])
    n = count[records]
    data = np.frombuffer(b"".join([texts[i] for i in records.tolist()]), np.uint8)
    begins = np.cumsum(n + length - 1) - (n + length - 1)
    record, window = np.repeat(records, n), _ranges(n)
    alive, least = radix_groups(data, np.repeat(begins, n) + window, np.repeat(group, n), low[record], high[record], length)
    found = low[record]
    found[alive] = least
    new = _groups(record, found)
    return record[new], window[new], np.append(window[new[1:] - 1], window[-1:]) + 1, found[new]


# ------------------------------------------------------------------- removal
def _remove(length: int, buckets: int):
    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Block(left, length, buckets)
        kinds, places, payloads = (right.column(c).to_pylist() for c in ("kind", "bucket", "payload"))
        status = _status(b, {p: x for k, p, x in zip(kinds, places, payloads) if k == 1})
        gone = np.zeros(len(b.raw) + 1, np.int32)
        if status.any():
            start, rank, number, texts, _, _, bucket = b.records(status)
            opens = np.searchsorted(bucket, np.arange(buckets)) if buckets < 1 << 16 else None
            runs = []
            for k, p, x in zip(kinds, places, payloads):
                if k == 2:
                    place, j0, j1, least = _unpack(x, ["<u4", "<u4", "<u4", "<i8"])[0]
                    first = int(opens[p]) if opens is not None else int(np.searchsorted(bucket, p))
                    runs.append((place.astype(np.int64) + first, j0.astype(np.int64), j1.astype(np.int64), least))
            if runs:
                record, j0, j1, least = (np.concatenate([r[i] for r in runs]) for i in range(4))
                by = np.argsort(record, kind="stable")
                n_runs = np.bincount(record, minlength=len(texts))
                where = np.repeat(np.arange(len(number)), n_runs[number])
                at = by[np.repeat((np.cumsum(n_runs) - n_runs)[number], n_runs[number]) + _ranges(n_runs[number])]
                smaller = least[at] < rank[where]
                where, at = where[smaller], at[smaller]
                np.add.at(gone, start[where] + j0[at], 1)
                np.add.at(gone, start[where] + j1[at] - 1 + length, -1)
        covered = np.cumsum(gone[:-1]) > 0
        spans, kept, lo = [], [], 0
        for hi in b.ends.tolist():
            mine = covered[lo:hi]
            if mine.any():
                edge = np.diff(np.concatenate([[0], mine, [0]]).astype(np.int8))
                spans.append([{"start": s, "end": e} for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
                kept.append(np.frombuffer(b.raw, np.uint8, hi - lo, lo)[~mine].tobytes())
            else:
                spans.append([])
                kept.append(b.raw[lo:hi])
            lo = hi
        return pa.table({
            "doc_id": pa.array(b.ids, mask=~b.known), "n_bytes": pa.array(np.diff(b.ends, prepend=0)),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.binary())})
    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` for every row of ``docs``: the removed
    runs of bytes (start and end), and the bytes that stay, joined."""
    if length < GRAM:
        raise ValueError(f"the threshold must be at least {GRAM} bytes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    blocks = rows.mapInArrow(_block_rows(block_bytes), _BLOCK)
    status = (blocks.groupBy("block").applyInArrow(_send_anchors(length, buckets), _MESSAGE)
              .groupBy("bucket").applyInArrow(_judge_anchors, _MESSAGE))
    found = (blocks.groupBy("block").cogroup(status.groupBy("block")).applyInArrow(_send_records(length, buckets), _MESSAGE)
             .groupBy("bucket").applyInArrow(_sort_records(length), _MESSAGE))
    back = status.withColumn("kind", F.lit(1)).unionByName(found.withColumn("kind", F.lit(2)))
    return (blocks.groupBy("block").cogroup(back.groupBy("block"))
            .applyInArrow(_remove(length, buckets), "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"))


def op11_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d) AS x),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING count(*) > 1),
g AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens
      FROM w JOIN m USING (s) WHERE least < doc_id),
k AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS span FROM g),
p AS (SELECT r, min(i) AS lo, max(i) + 50 AS hi FROM k GROUP BY r, span),
q AS (SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS since FROM p),
e AS (SELECT r, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS last,
             string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS kept FROM q JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN e USING (r)"""
