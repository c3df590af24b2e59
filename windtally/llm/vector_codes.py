"""Product codes of integer vectors by exact k-means with norm-of-sum bounds.

Components become ``floor(256 * x)``; a vector is cut into ``PARTS`` equal
consecutive parts, and every part position has a codebook of ``ENTRIES``
entries.  Each vector keeps, for each part, its entry, the exact distance ``u``
to it and a lower bound ``l`` of the distance to any other entry, and for both
the round in which they were measured (their stamps).  As all codebooks of
earlier rounds are kept, a bound is brought up to date with the true distance
between an entry's place now and its place at the stamp, which is at most, and
mostly less than, the sum of its moves in between.  If ``u`` stays below
``l`` (strictly, so that no tie can hide there) the entry is still the nearest;
otherwise ``u`` is measured anew, and only if that does not settle it are all entries scanned.

A round is one pass over the vectors, which are stored with their state and
with each task's sums; Spark adds the sums up.  Only the codebooks (``ENTRIES`` times
the vector's length, whatever the number of rows) go through the driver.

Defined results: a row whose vector is null, empty, holds null or non-finite
components, or is not as long as that of the smallest kept vec_id is left out;
a length that ``PARTS`` does not divide is filled up with zeros; components beyond
2**26 either way count as that; rows that repeat a vec_id each count (the smaller vector
first), rows with a null vec_id come last; fewer vectors than entries make a smaller codebook;
an empty table gives no rows.  Only vec_id, label and embedding are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Largest component, so that squared distances of parts of 512 components fit 64 bits.
LARGEST = 1 << 26
#: Share by which a bound must be undercut, against the rounding of square roots.
MARGIN = 1e-9
_STATE = np.dtype([("entry", "u1"), ("u_at", "u1"), ("l_at", "u1"), ("u", "<f8"), ("l", "<f8")])
_ROW = "vec_id long, label string, v binary, state binary, entry int, pos int, total long, n long"


def integer_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, label, v``: kept rows with integer components."""
    bad = "x -> x is null or isnan(x) or abs(x) = double('Infinity')"
    scaled = f"transform(embedding, x -> cast(floor(greatest({-LARGEST}D, least({LARGEST}D, 256D * x))) as int))"
    return (rows.where(f"embedding is not null and size(embedding) > 0 and not exists(embedding, {bad})")
            .select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.expr(scaled).alias("v")))


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of x, entries of c), as float64 where that is exact, else int64."""
    far = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * far * far < 1 << 53:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return (xf * xf).sum(axis=1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(axis=1)[None, :]
    return np.stack([((x.astype(np.int64) - e.astype(np.int64)) ** 2).sum(axis=1) for e in c], axis=1)


def own_distances(x: np.ndarray, c: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances (int64) of rows to their entries."""
    return ((x.astype(np.int64) - c[entry].astype(np.int64)) ** 2).sum(axis=1)


def scan(x: np.ndarray, c: np.ndarray, now: int) -> np.ndarray:
    """State of parts from a comparison with every entry; ties go to the lower index."""
    d = squared_distances(x, c)
    out = np.zeros(len(x), _STATE)
    out["entry"] = d.argmin(axis=1)
    rows = np.arange(len(x))
    out["u"] = np.sqrt(d[rows, out["entry"]].astype(np.float64))
    if d.shape[1] > 1:
        d = d.astype(np.float64)
        d[rows, out["entry"]] = np.inf
        out["l"] = np.sqrt(d.min(axis=1))
    else:
        out["l"] = np.inf
    out["u_at"] = out["l_at"] = now
    return out


def reassign(x: np.ndarray, state: np.ndarray, history: list[np.ndarray], now: int) -> tuple[np.ndarray, int]:
    """State of the parts ``x`` against the codebook ``history[now]``, and how many needed a scan."""
    state = state.copy()
    moved = np.stack([np.sqrt(((history[now] - c).astype(np.float64) ** 2).sum(axis=1)) for c in history[:now + 1]])
    # of each stamp, the largest displacement, and the largest but that of one entry
    top = moved.argmax(axis=1)
    most = moved.max(axis=1)
    rest = moved.copy()
    rest[np.arange(len(rest)), top] = 0
    second = rest.max(axis=1) if moved.shape[1] > 1 else np.zeros(len(moved))
    others = np.where(top[state["l_at"]] == state["entry"], second[state["l_at"]], most[state["l_at"]])
    low = (state["l"] - others) * (1 - MARGIN) - MARGIN
    high = (state["u"] + moved[state["u_at"], state["entry"]]) * (1 + MARGIN) + MARGIN
    open_ = np.flatnonzero(~(high < low))
    if len(open_):
        exact = np.sqrt(own_distances(x[open_], history[now], state["entry"][open_]).astype(np.float64))
        state["u"][open_], state["u_at"][open_] = exact, now
        open_ = open_[~(exact * (1 + MARGIN) + MARGIN < low[open_])]
    if len(open_):
        state[open_] = scan(x[open_], history[now], now)
    return state, len(open_)


def _rows(b: pa.RecordBatch, dim: int, width: int) -> np.ndarray:
    """The batch's vectors, filled up with zeros to ``width``."""
    x = np.zeros((b.num_rows, width), np.int64)
    x[:, :dim] = np.frombuffer(b"".join(b.column("v").to_pylist()), "<i4").reshape(-1, dim)
    return x


def _round(history: list[np.ndarray], now: int, dim: int, parts: int, entries: int):
    """One pass: every vector's state against the codebook of round ``now``, and the task's sums (rows with ``entry``)."""
    width = history[0].shape[2]

    def run(batches):
        total = np.zeros((parts, entries, width), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = _rows(b, dim, parts * width).reshape(b.num_rows, parts, width)
            old = np.frombuffer(b"".join(b.column("state").to_pylist()), _STATE).reshape(-1, parts) if now else None
            state = np.zeros((b.num_rows, parts), _STATE)
            for p in range(parts):
                books = [h[p] for h in history]
                if now:
                    state[:, p], _ = reassign(x[:, p], old[:, p], books, now)
                else:
                    state[:, p] = scan(x[:, p], books[0], 0)
                np.add.at(total[p], state["entry"][:, p], x[:, p])
                count[p] += np.bincount(state["entry"][:, p], minlength=entries)
            n = b.num_rows
            empty = lambda kind: pa.nulls(n, kind)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), b.column("v"), pa.array([s.tobytes() for s in state], pa.binary()),
                 empty(pa.int32()), empty(pa.int32()), empty(pa.int64()), empty(pa.int64())],
                names=["vec_id", "label", "v", "state", "entry", "pos", "total", "n"])
        used = np.flatnonzero(count.reshape(-1))
        if len(used):
            n = len(used) * width
            empty = lambda kind: pa.nulls(n, kind)
            yield pa.RecordBatch.from_arrays(
                [empty(pa.int64()), empty(pa.string()), empty(pa.binary()), empty(pa.binary()),
                 pa.array(np.repeat(used, width).astype(np.int32)), pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                 pa.array(total.reshape(-1, width)[used].reshape(-1)), pa.array(np.repeat(count.reshape(-1)[used], width))],
                names=["vec_id", "label", "v", "state", "entry", "pos", "total", "n"])
    return run


def _coded(book: np.ndarray, dim: int):
    """Code and exact error of every vector from its state."""
    parts, _, width = book.shape

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _rows(b, dim, parts * width).reshape(b.num_rows, parts, width)
            entry = np.frombuffer(b"".join(b.column("state").to_pylist()), _STATE).reshape(-1, parts)["entry"]
            error = sum(own_distances(x[:, p], book[p], entry[:, p]) for p in range(parts))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"),
                                              pa.array([e.tobytes().hex() for e in np.ascontiguousarray(entry)]), pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])
    return run


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """``(vec_id, label, code, error)`` of every kept row (label as text), and
    the codebooks (parts, entries, components).  ``code`` has two hex digits a part, so ``entries`` is at most 256."""
    rows = integer_vectors(vectors)
    start = [r["v"] for r in rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(1).collect()]
    if not start:
        return vectors.sparkSession.createDataFrame([], "vec_id long, label string, code string, error long"), None
    dim = len(start[0])
    rows = rows.where(F.size("v") == dim)
    first = np.array([r["v"] for r in rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()], np.int64)
    width = -(-dim // parts)
    full = np.zeros((len(first), parts * width), np.int64)
    full[:, :dim] = first
    history = [full.reshape(len(first), parts, width).transpose(1, 0, 2).copy()]
    n_entries = len(first)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("entry", "int"), ("pos", "int"), ("total", "long"), ("n", "long"))]
    # little-endian 32-bit integers, made by Arrow inside the first pass
    current = rows.select("vec_id", F.col("label").cast("string").alias("label"), "v",
                          F.lit(None).cast("binary").alias("state"), *nothing).mapInArrow(_as_binary, _ROW)
    for now in range(rounds + 1):
        done = stored(current.mapInArrow(_round(history, now, dim, parts, n_entries), _ROW), f"codes-{now}")
        current = done.where("entry is null")
        if now < rounds:
            sums = (done.where("entry is not null").groupBy("entry", "pos")
                    .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())
            book = history[-1].copy()
            for r in sums:
                book[r["entry"] // n_entries, r["entry"] % n_entries, r["pos"]] = int(r["total"]) // r["n"]
            history.append(book)
    return current.mapInArrow(_coded(history[-1], dim), "vec_id long, label string, code string, error long"), history[-1]


def _as_binary(batches):
    for b in batches:
        v = b.column("v")
        flat = v.flatten().to_numpy(zero_copy_only=False).astype("<i4")
        ends = np.cumsum([len(x) for x in v]) if b.num_rows else np.zeros(0, int)
        packed = [flat[e - len(x):e].tobytes() for x, e in zip(v, ends)]
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()) if n == "v" else b.column(n) for n in b.schema.names], names=b.schema.names)


def digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    coded, book = compress(table(spark, sf_dir, "embeddings"))
    coded = stored(coded, "vector-codes")
    # labels are pre-aggregated; AQE broadcasts the sums by their measured size, or splits a hot label's rows
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest(book) if book is not None else "").alias("codebooks_sha256")))


def _oracle() -> str:
    assign = """a{k} AS (SELECT rid, part, min(d * 64 + idx) AS m FROM (
  SELECT c.rid, c.part, b.idx, sum((c.z - b.z) * (c.z - b.z)) AS d FROM c JOIN b{k} AS b ON b.part = c.part AND b.pos = c.pos GROUP BY ALL) AS x GROUP BY ALL)"""
    update = """s{k} AS (SELECT c.part, c.pos, a.m % 64 AS idx, sum(c.z) AS t, count(*) AS n FROM c JOIN a{k} AS a USING (rid, part) GROUP BY ALL),
b{n} AS (SELECT b.part, b.pos, b.idx, CAST(CASE WHEN n IS NULL THEN b.z ELSE (t - ((t % n) + n) % n) / n END AS BIGINT) AS z
  FROM b{k} AS b LEFT JOIN s{k} AS s ON s.part = b.part AND s.pos = b.pos AND s.idx = b.idx)"""
    steps = [assign.format(k=0)]
    for k in range(ROUNDS):
        steps += [update.format(k=k, n=k + 1), assign.format(k=k + 1)]
    return f"""WITH r AS (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, embedding FROM embeddings),
e AS (SELECT rid, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM r),
o AS (SELECT rid, count(*) AS dim FROM e GROUP BY rid HAVING bool_and(coalesce(isfinite(x), false))),
c AS (SELECT rid, i // (dim // 16) AS part, i % (dim // 16) AS pos, CAST(floor(256 * x) AS BIGINT) AS z FROM e JOIN o USING (rid)),
f AS (SELECT rid, row_number() OVER (ORDER BY rid) - 1 AS idx FROM o),
b0 AS (SELECT part, pos, idx, z FROM c JOIN f USING (rid) WHERE idx < {ENTRIES}),
{",".join(steps)},
t AS (SELECT rid, string_agg(lpad(lower(hex(m % 64)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY rid),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM t JOIN r USING (rid) GROUP BY label)
SELECT r.vec_id, code, error, label_error, (SELECT sha256(string_agg(CAST(z AS VARCHAR), ',' ORDER BY part, idx, pos)) FROM b{ROUNDS}) AS codebooks_sha256
FROM t JOIN r USING (rid) JOIN l ON l.label IS NOT DISTINCT FROM r.label"""


ORACLE = _oracle()
