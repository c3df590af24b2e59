"""Token ids as flat binary files with 64-bit offsets.

Layout of a folder, one set of files for each range partition of doc_id:

* ``tokens-NNNNN.bin``   ids, little-endian uint16 (uint32 if the vocabulary needs it)
* ``offsets-NNNNN.bin``  uint64, documents + 1 entries, counted from the partition's start
* ``docs-NNNNN.bin``     int64 doc_ids (0 where null: the first ``n_null``)

and a manifest (Parquet) with each partition's counts and its base: the prefix
sum of the token counts before it.  Files are written under an attempt's name
and renamed, so a lost executor's task is simply run again.  Readers map the
files into memory.

Defined results: a null or empty text is one end id; rows come in ascending
doc_id order, nulls first, rows that repeat a doc_id by text; an empty table
gives no files and no rows.  Only doc_id (an integer) and text are read.
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windtally.session import scratch_path

from .common import stored, table, text_of

END_ID = 0
#: Bytes that each of the two generations of a worker's cache may hold (the older one is
#: dropped when a task ends: a worker lives on, and other stages share its executor), what an
#: entry takes beside its word and ids, and the longest word that is kept after its batch.
CACHE_BYTES, ENTRY_BYTES, CACHE_WORD = 64 << 20, 100, 64
#: Texts are encoded together up to so many bytes and rows.
BATCH_BYTES, BATCH_ROWS = 2 << 20, 4096
_TWO_BLANKS = re.compile(r"\s\s")
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_SOLID = re.compile(r" ?\S+")
_MARKS = ".,;:!?\"'()[]{}|-*&%$#"
#: Marks that end a word after a letter.
_LAST_MARKS = rf"(\pL)([{re.escape(_MARKS)}]+)( |$)"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Whole texts -> id bytes, by the tokenizers library.

    A byte-level tokenizer splits a text into pieces before it merges, and its
    pieces never cross a single blank between two non-blanks, a mark after a
    letter, or a lone line feed; so ids of such parts can be kept and joined.
    Any other kind of tokenizer encodes each text in one go.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                        and not spec.get("normalizer") and not spec["model"].get("dropout")
                        and not any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens") or []))
        line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_feed = line_feed[0] if len(line_feed) == 1 else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0  # bytes in the young generation

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def parts(self, parts: list[str]) -> list[bytes]:
        """Ids of short parts.  Those without blanks go through the library a
        thousand at a time, with line feeds between them to part the ids by."""
        out: list[bytes | None] = [None] * len(parts)
        solid = [i for i, p in enumerate(parts) if _SOLID.fullmatch(p)] if self.line_feed is not None else []
        groups = [solid[lo:lo + 1000] for lo in range(0, len(solid), 1000)]
        width = self.kind.itemsize
        for some in groups:  # one at a time: the library's results take many times the ids' memory
            data, = self.whole(["\n".join([parts[i] for i in some])])
            cuts = np.flatnonzero(np.frombuffer(data, self.kind) == self.line_feed) * width
            for i, a, b in zip(some, [0, *(cuts + width).tolist()], [*cuts.tolist(), len(data)]):
                out[i] = data[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self.whole([parts[i] for i in rest]) if rest else []):
            out[i] = x
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self.whole(texts)
        # a word stands for itself with the blank before it; what follows no blank (a text's
        # first word, a lone line feed and the word after it, marks after a word) is kept under a leading NUL
        strange = {i: b for i, b in enumerate(self.whole([t])[0] if "\0" in t else None for t in texts) if b is not None}
        spaced = {i: _SAFE_CUT.split("\0" + t) for i, t in enumerate(texts) if i not in strange and (t[:1].isspace() or t[-1:].isspace() or _TWO_BLANKS.search(t))}
        even = ["\0" + t.replace("\n", " \0\n \0") for i, t in enumerate(texts) if i not in strange and i not in spaced]
        lists = pc.split_pattern(pc.replace_substring_regex(pa.array(even, pa.large_string()), _LAST_MARKS, "\\1 \0\\2\\3"), " ")
        words = pa.concat_arrays([lists.flatten(), pa.array([w for x in spaced.values() for w in x], pa.large_string())]).dictionary_encode()
        counts = iter(pc.list_value_length(lists).to_pylist())
        sizes = [0 if i in strange else len(spaced[i]) if i in spaced else next(counts) for i in range(len(texts))]
        order = [i for i in range(len(texts)) if i not in strange and i not in spaced] + list(spaced)

        if self.held > CACHE_BYTES:
            self.young, self.old, self.held = {}, self.young, 0
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = len(self.young)
        missing = {w for w in distinct if w not in self.young}
        if missing:
            self.learn(missing)
        ids = list(map(self.young.__getitem__, distinct))
        added = list(islice(reversed(self.young), len(self.young) - known))  # by this batch
        for w in [w for w in added if len(w) > CACHE_WORD]:
            del self.young[w]
        kept = [w for w in added if len(w) <= CACHE_WORD]
        self.held += sum(map(sys.getsizeof, kept)) + sum(map(sys.getsizeof, map(self.young.__getitem__, kept))) + ENTRY_BYTES * len(kept)

        # every word's ids, gathered from those of the distinct words
        flat = np.frombuffer(b"".join(ids), self.kind)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        starts = np.cumsum(lengths) - lengths
        at = words.indices.to_numpy()
        spans = lengths[at]
        ends = np.cumsum(spans)
        every = flat[np.repeat(starts[at] - ends + spans, spans) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.append(0, ends)
        out, first = [b""] * len(texts), 0
        for i in order:
            last = first + sizes[i]
            out[i] = every[ends[first]:ends[last]].tobytes()
            first = last
        for i, b in strange.items():
            out[i] = b
        return out

    def end_task(self) -> None:
        """Drop the older generation: at most ``CACHE_BYTES`` and one batch stay until the worker's next task."""
        self.old = {}
        pa.default_memory_pool().release_unused()

    def learn(self, words: set[str]) -> None:
        """Put every word into the young generation, encoding what is in neither."""
        young, old = self.young, self.old
        composed: list[tuple[str, list[str]]] = []
        plain: set[str] = set()

        def need(part: str) -> None:
            if part not in young:
                if part in old:
                    young[part] = old[part]
                else:
                    plain.add(part)

        for w in words:
            if w in old:
                young[w] = old[w]
            elif w.isalpha():
                plain.add(w)
            else:
                pieces = self.cut(w)
                for p in pieces:
                    need(p)
                if len(pieces) > 1:
                    composed.append((w, pieces))
        if plain:
            order = list(plain)
            young.update(zip(order, self.parts([p[1:] if p[:1] == "\0" else " " + p for p in order])))
        for w, pieces in composed:
            young[w] = b"".join([young[p] for p in pieces])

    @staticmethod
    def cut(w: str) -> list[str]:
        """Parts of a word at lone line feeds and before marks that follow a letter."""
        lines = [w]
        if "\n" in w:
            lines = w.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in (lines[0].lstrip("\0"), *lines[1:])):
                lines = [lines[0], *(y for x in lines[1:] for y in ("\0\n", "\0" + x))]
            else:
                lines = [w]
        pieces = []
        for x in lines:
            core = x.rstrip(_MARKS)
            if core != x and core and core[-1].isalpha():
                pieces += [core, "\0" + x[len(core):]]
            else:
                pieces.append(x)
        return pieces


def worker_encoder(path: str) -> Encoder:
    """One encoder, with its cache of words, for all tasks of a Python worker."""
    held = sys.modules.setdefault("_token_files_worker", types.ModuleType("_token_files_worker")).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def _filesystem(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder)


def _text_batches(texts: pa.Array) -> list[tuple[int, int]]:
    """Row ranges of at most ``BATCH_ROWS`` rows, cut where ``BATCH_BYTES`` more bytes have begun."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = np.arange(len(size))
    cuts = np.flatnonzero(np.diff(size // BATCH_BYTES)) + 1
    edges = sorted({0, *cuts.tolist(), *at[::BATCH_ROWS].tolist(), len(size)})
    return list(zip(edges, edges[1:]))


def _write_partitions(folder: str, vocabulary: str, end_id: int):
    def write(batches):
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        files, at, sink, encoder = None, None, None, None
        n_docs = n_tokens = n_null = 0
        end = b""
        for b in batches:
            if not b.num_rows:
                continue
            if files is None:
                files, at = _filesystem(folder)
                encoder = worker_encoder(vocabulary)
                end = np.array([end_id], encoder.kind).tobytes()
                sink = {k: files.open_output_stream(f"{at}/{k}-{part:05d}.bin.{attempt}") for k in ("tokens", "offsets", "docs")}
                sink["offsets"].write(np.zeros(1, "<u8").tobytes())
            ids = b.column(0).cast(pa.int64())
            n_null += ids.null_count
            sink["docs"].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            for lo, hi in _text_batches(b.column(1)):
                coded = encoder.encode(b.column(1).slice(lo, hi - lo).to_pylist())
                lengths = np.array([len(x) // encoder.kind.itemsize + 1 for x in coded], np.uint64)
                sink["tokens"].write(b"".join(y for x in coded for y in (x, end)))
                sink["offsets"].write((np.cumsum(lengths) + np.uint64(n_tokens)).astype("<u8").tobytes())
                n_tokens += int(lengths.sum())
            n_docs += b.num_rows
        if files is not None:
            encoder.end_task()
            for k, s in sink.items():
                s.close()
                files.move(f"{at}/{k}-{part:05d}.bin.{attempt}", f"{at}/{k}-{part:05d}.bin")
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_docs": [n_docs], "n_tokens": [n_tokens], "n_null": [n_null],
                                              "width": pa.array([encoder.kind.itemsize], pa.int32())})
    return write


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, partitions: int | None = None) -> DataFrame:
    """Write the files and return the manifest ``(part, n_docs, n_tokens, n_null, width, base)``.

    Texts are shuffled once, by ranges of doc_id (ties by a hash of the text and
    then by the row's place in the input, so a doc_id or a row that repeats often
    spreads), and encoded where they arrive.  Equal rows are interchangeable;
    ``docs`` should be read from files, where places are the same if a task is run again."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    order = [F.asc_nulls_first("doc_id"), F.asc("tie"), F.asc("text")]
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(n, *order[:2], F.asc("place")).sortWithinPartitions(*order).select("doc_id", "text")
    counts = ordered.mapInArrow(_write_partitions(folder, vocabulary or default_vocabulary(), end_id),
                                "part int, n_docs long, n_tokens long, n_null long, width int")
    counts = stored(counts, "token-counts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    return stored(counts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "token-manifest")


def mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """A file as a read-only array: memory-mapped on a mounted path, else read whole."""
    files, at = _filesystem(folder)
    if files.type_name == "local":
        return np.memmap(f"{at}/{name}", dtype=dtype, mode="r")
    with files.open_input_file(f"{at}/{name}") as f:
        return np.frombuffer(f.read(), dtype)


def _read_partitions(folder: str):
    def read(batches):
        for b in batches:
            for row in b.to_pylist():
                part = row["part"]
                tokens = mapped(folder, f"tokens-{part:05d}.bin", f"<u{row['width']}")
                offsets = mapped(folder, f"offsets-{part:05d}.bin", "<u8").astype(np.int64)
                ids = mapped(folder, f"docs-{part:05d}.bin", "<i8")
                for lo in range(0, row["n_docs"], 10_000):
                    hi = min(lo + 10_000, row["n_docs"])
                    crc = [zlib.crc32(tokens[offsets[i]:offsets[i + 1]].astype("<u4").tobytes()) for i in range(lo, hi)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(np.asarray(ids[lo:hi]), mask=np.arange(lo, hi) < row["n_null"]),
                        "start": pa.array(offsets[lo:hi] + row["base"]),
                        "n_tokens": pa.array(np.diff(offsets[lo:hi + 1])),
                        "ids_crc32": pa.array(crc, pa.int64())})
    return read


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "part").mapInArrow(_read_partitions(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_corpus(docs: DataFrame) -> DataFrame:
    folder = f"{scratch_path(docs.sparkSession, 'tokens')}/files"
    return read_token_files(write_token_files(docs, folder), folder)


def op9_token_files(spark, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))
