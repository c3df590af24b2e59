"""Alignment of two tokenizers' tokens, and corpus counts of aligned id pairs by external spill counting.

A text's bytes are cut into groups where a token of A and a token of B both end;
an A and a B token are linked where their bytes overlap.  Texts go through
both tokenizers segment by segment (a segment begins at a blank after a
non-blank, where neither can have a token across); a segment's links and
groups are kept in a cache bounded by bytes.

Counting.  Documents are taken in blocks.  A block sorts its pair-document
records, partitions them by a digit of the A id and writes each partition as a zstd run:
the heads (pair, number of documents) and the body (document, times).  Runs
of a partition meet in a k-way heap merge that counts every pair; up to ``FAN`` runs
are merged at a time, in as many levels as it takes, so no task holds more than that many.  The last
merge is in the order of A ids: when an id ends, the largest count among its pairs
is known.  Counts and maxima then stream back level by level to the runs they
came from and are added up per document in its block.  Only heads are
merged: however many documents share a pair, a block sends it once.

Defined results: a text that is null, empty, or whose tokens' joined bytes
are not those of a blank and the text has no tokens: zeros and an empty
digest; rows that repeat a doc_id count as documents of their own; an empty table gives no
rows.  Only doc_id (an integer) and text are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import types

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table, text_of
from .token_files import Encoder

#: Text of a block.
BLOCK_BYTES = 4 << 20
#: Radix partitions of the A ids, and runs merged at a time.
PARTITIONS, FAN = 64, 512
#: Bytes of segments kept in a worker (twice, as there is an older generation), and the longest that is kept.
CACHE_BYTES, CACHE_CHARS = 48 << 20, 48
#: Bits of a B id and of a document's number in its block; an A id has the other 20.
B_BITS, DOC_BITS = 20, 24
_SEGMENT = re.compile(r"(?<=\S)(?= )")
_RUNS = "block long, part int, heads binary, body binary"


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


class Aligner:
    """Texts -> links and groups of their tokens in both vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.a = Encoder(path_a)
        self.a.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        with open(path_a, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        known = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if all(c in letters for c in t)}
        self.bytes_a = [known.get(i, b"") for i in range(self.a.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.blank = self.b.piece_to_id("▁")
        self.said = Said()
        # a merge across a blank would need a piece with a blank after another character
        self.by_segment = self.a.by_word and not any(re.search("[^▁]▁", p) for p in pieces)
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}
        self.size = 0

    def segments(self, text: str) -> list[str]:
        return _SEGMENT.split(" " + text) if self.by_segment else [" " + text]

    def encode(self, texts: list[str]) -> list[list[tuple | None]]:
        """Of each text, the entries of its segments: (links as bytes of uint64, groups, number of A tokens), or None where bytes differ."""
        cut = [self.segments(t) for t in texts]
        if self.size > CACHE_BYTES:
            self.young, self.old, self.size = {}, self.young, 0
        missing: set[str] = set()
        for words in cut:
            missing.update(set(words).difference(self.young))
        young, old = self.young, self.old
        new = []
        for w in missing:
            if w in old:
                young[w] = old[w]
                self.size += 200 + 2 * len(w)
            else:
                new.append(w)
        long = []
        for w, entry in zip(new, self.entries(new)):
            young[w] = entry
            if len(w) > CACHE_CHARS:
                long.append(w)
            else:
                self.size += 300 + 2 * len(w)
        out = [[young[w] for w in words] for words in cut]
        for w in long:
            del young[w]
        return out

    def entries(self, words: list[str]) -> list[tuple | None]:
        """Entries of new segments, all aligned at once in one line of their bytes."""
        if not words:
            return []
        raws = [w.encode() for w in words]
        coded_a = self.a.parts(words)
        coded_b = self.b.encode([w[1:] for w in words], num_threads=1)
        if " " in words:  # a lone blank at a text's end: encoding nothing gives no token
            coded_b[words.index(" ")] = [self.blank]
        n_a = np.array([len(x) for x in coded_a]) // self.a.kind.itemsize
        n_b = np.array([len(x) for x in coded_b])
        size = np.array([len(r) for r in raws])
        a = np.frombuffer(b"".join(coded_a), self.a.kind).astype(np.int64)
        b = np.array([i for x in coded_b for i in x], np.int64)
        word_a, word_b = np.repeat(np.arange(len(words)), n_a), np.repeat(np.arange(len(words)), n_b)
        same = self._same(raws, size, a, word_a, self.bytes_a, self.size_a) & self._same(raws, size, b, word_b, self.bytes_b, self.size_b)
        out: list[tuple | None] = [None] * len(words)
        good = np.flatnonzero(same)
        if not len(good):
            return out
        number = np.cumsum(same) - 1
        keep_a, keep_b = same[word_a], same[word_b]
        a, b, word_a, word_b, n_a = a[keep_a], b[keep_b], number[word_a[keep_a]], number[word_b[keep_b]], n_a[good]
        end_a, end_b, ends = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), np.cumsum(size[good])
        # between two cuts of either side lies the overlap of one A and one B token
        cut = np.unique(np.concatenate([end_a, end_b]))
        i, j = np.searchsorted(end_a, cut), np.searchsorted(end_b, cut)
        links = (a[i] << B_BITS + DOC_BITS | b[j] << DOC_BITS).astype("<u8").tobytes()
        stop = (8 * np.cumsum(np.bincount(word_a[i], minlength=len(good)))).tolist()
        # a group ends where both sides do; its A tokens stand before its B tokens
        closes_a = end_b[np.searchsorted(end_b, end_a)] == end_a
        closes_b = end_a[np.searchsorted(end_a, end_b)] == end_b
        order = np.argsort(np.concatenate([2 * (np.cumsum(closes_a) - closes_a), 2 * (np.cumsum(closes_b) - closes_b) + 1]), kind="stable")
        after_b = np.where(closes_b, np.where(end_b == ends[word_b], 3, 2), 0)
        said = np.concatenate([4 * a + closes_a, 4 * b + after_b])[order].tolist()
        texts = "".join(map(self.said.__getitem__, said)).split("\n")
        for k, lo, hi, groups, n in zip(good.tolist(), [0, *stop], stop, texts, n_a.tolist()):
            out[k] = links[lo:hi], groups, n
        return out

    @staticmethod
    def _same(raws: list[bytes], size: np.ndarray, ids: np.ndarray, word: np.ndarray, texts: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Which segments' tokens, joined, are their bytes."""
        same = np.bincount(word, sizes[ids], minlength=len(raws)) == size
        if same.all() and b"".join([texts[i] for i in ids.tolist()]) == b"".join(raws):
            return same
        at = np.searchsorted(word, np.arange(len(raws) + 1)).tolist()
        ids = ids.tolist()
        return np.array([b"".join([texts[i] for i in ids[lo:hi]]) == r for lo, hi, r in zip(at, at[1:], raws)], bool)


class Said(dict):
    """Number and what follows it, by 4 * number + (0 for ``,``, 1 for ``|``, 2 for ``;``, 3 for a line's end)."""

    def __missing__(self, code: int) -> str:
        self[code] = text = f"{code // 4}{',|;'[code % 4] if code % 4 < 3 else chr(10)}"
        return text


def worker_aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner, with its cache, for all tasks of a Python worker."""
    held = sys.modules.setdefault("_token_align_worker", types.ModuleType("_token_align_worker")).__dict__
    key = (path_a, path_b)
    if key not in held:
        held[key] = Aligner(path_a, path_b)
    return held[key]


# ---------------------------------------------------------------------- runs
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
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    return out, raw[at:]


def _heads(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    return _pack([np.diff(pairs, prepend=np.uint64(0)), counts.astype("<u8")])


def _read_heads(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    delta, counts = _unpack(payload, ["<u8", "<u8"])[0]
    return np.cumsum(delta, dtype=np.uint64), counts


def _align_blocks(path_a: str, path_b: str):
    def run(batches):
        part = TaskContext.get().partitionId()
        aligner, seq, size = worker_aligner(path_a, path_b), 0, 0
        ids: list[int | None] = []
        links: list[bytes] = []
        facts: list[tuple[int, int, int, int]] = []
        digests: list[bytes] = []

        def rows():
            data = np.frombuffer(b"".join(links), "<u8")
            doc = np.repeat(np.arange(len(ids), dtype=np.uint64), [f[3] for f in facts])
            key = np.sort(data | doc)
            first = np.flatnonzero(np.diff(key, prepend=~key[:1]))
            key, times = key[first], np.diff(first, append=len(key))
            pair, doc = key >> np.uint64(DOC_BITS), key & np.uint64((1 << DOC_BITS) - 1)
            digit = (pair >> np.uint64(B_BITS)) % np.uint64(PARTITIONS)
            out = {"part": [-1], "heads": [None], "body": [_pack([
                np.array([0 if i is None else i for i in ids], "<i8"), np.array([i is not None for i in ids], "u1"),
                *np.array(facts, "<i8").reshape(-1, 4).T], b"".join(digests))]}
            for d in np.unique(digit).tolist():
                mine = np.flatnonzero(digit == d)
                p = pair[mine]
                opens = np.flatnonzero(np.diff(p, prepend=~p[:1]))
                out["part"].append(d)
                out["heads"].append(_heads(p[opens], np.diff(opens, append=len(p))))
                out["body"].append(_pack([doc[mine].astype("<u4"), times[mine].astype("<u4")]))
            n = len(out["part"])
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | seq] * n, pa.int64()), pa.array(out["part"], pa.int32()),
                                               pa.array(out["heads"], pa.binary()), pa.array(out["body"], pa.binary())],
                                              names=["block", "part", "heads", "body"])

        for b in batches:
            for lo in range(0, b.num_rows, 64):
                texts = b.column("text").slice(lo, 64).to_pylist()
                for i, t, entries in zip(b.column("doc_id").slice(lo, 64).to_pylist(), texts, aligner.encode(texts)):
                    ids.append(i)
                    if t and None not in entries:
                        parts, groups, n_a = zip(*entries)
                        data, said = b"".join(parts), ";".join(groups)
                        n_groups, n_links, a = said.count(";") + 1, len(data) // 8, sum(n_a)
                        # inside a group every cut is of one side only: links = A + B tokens - groups
                        facts.append((a, n_links + n_groups - a, n_groups, n_links))
                        links.append(data)
                        digests.append(hashlib.sha256(said.encode()).digest())
                    else:
                        facts.append((0, 0, 0, 0))
                        digests.append(bytes(32))
                    size += len(t)
                    if size >= BLOCK_BYTES or len(ids) == 1 << DOC_BITS:
                        yield rows()
                        ids, links, facts, digests, size, seq = [], [], [], [], 0, seq + 1
        if ids:
            yield rows()
    return run


# --------------------------------------------------------------------- merge
def merge(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """K-way heap merge of sorted runs (pairs, counts); counts of equal pairs are added."""
    if len(runs) == 1:
        return runs[0]
    pairs, counts, last = [], [], -1
    for pair, n in heapq.merge(*(zip(p.tolist(), c.tolist()) for p, c in runs)):
        if pair == last:
            counts[-1] += n
        else:
            pairs.append(pair)
            counts.append(n)
            last = pair
    return np.array(pairs, "<u8"), np.array(counts, "<u8")


def largest(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the largest of its A id; pairs are in order of A ids."""
    a = pairs >> np.uint64(B_BITS)
    first = np.flatnonzero(np.diff(a, prepend=~a[:1]))
    return counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(a))) if len(a) else counts == 0


def _merge_level(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    pairs, counts = merge([_read_heads(h) for h in t.column("heads").to_pylist()])
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "node": pa.array([key[1].as_py()], pa.int64()), "heads": [_heads(pairs, counts)]})


def _judge_top(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """The last merge of a partition: each pair's corpus count, and whether it is its A id's largest."""
    pairs, counts = merge([_read_heads(h) for h in t.column("heads").to_pylist()])
    answer = _pack([np.diff(pairs, prepend=np.uint64(0)), counts, largest(pairs, counts).astype("u1")])
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "node": pa.array([0], pa.int64()), "answer": [answer]})


def _answer_children(left: pa.Table, right: pa.Table) -> pa.Table:
    """Counts and maxima of a merge, handed to the runs it was made of."""
    delta, counts, best = _unpack(right.column("answer")[0].as_py(), ["<u8", "<u8", "u1"])[0]
    pairs = np.cumsum(delta, dtype=np.uint64)
    out = []
    for h in left.column("heads").to_pylist():
        mine, _ = _read_heads(h)
        at = np.searchsorted(pairs, mine)
        out.append(_pack([np.diff(mine, prepend=np.uint64(0)), counts[at], best[at]]))
    return pa.table({"part": left.column("part"), "node": left.column("node"), "answer": pa.array(out, pa.binary())})


def _add_up(left: pa.Table, right: pa.Table) -> pa.Table:
    """Per document of a block, the contributions of all its runs."""
    answers = dict(zip(right.column("part").to_pylist(), right.column("answer").to_pylist()))
    rows = {p: (h, b) for p, h, b in zip(*(left.column(c).to_pylist() for c in ("part", "heads", "body")))}
    (ids, known, n_a, n_b, n_groups, n_links), digests = _unpack(rows.pop(-1)[1], ["<i8", "u1", *["<i8"] * 4])
    n_best, count_sum = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for part, (heads, body) in rows.items():
        _, n_docs = _read_heads(heads)
        _, counts, best = _unpack(answers[part], ["<u8", "<u8", "u1"])[0]
        doc, times = _unpack(body, ["<u4", "<u4"])[0]
        n = n_docs.astype(np.int64)
        np.add.at(n_best, doc, times.astype(np.int64) * np.repeat(best, n))
        np.add.at(count_sum, doc, times.astype(np.int64) * np.repeat(counts.astype(np.int64), n))
    sha = [digests[32 * i:32 * i + 32].hex() if n else "" for i, n in enumerate(n_a.tolist())]
    return pa.table({"doc_id": pa.array(ids, mask=known == 0), "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                     "n_best": n_best, "count_sum": count_sum, "groups_sha256": sha})


def align_corpus(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per row of ``docs`` with the contract's columns."""
    a, b = default_vocabularies()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    blocks = stored(rows.mapInArrow(_align_blocks(path_a or a, path_b or b), _RUNS), "aligned")
    # levels of the merge: the nodes of a level are dealt to ``width`` nodes of the next
    level = blocks.where("part >= 0").select("part", F.col("block").alias("node"), "heads")
    width = -(-blocks.where("part = -1").count() // FAN)
    levels = []
    while True:
        width = max(1, width)
        level = level.withColumn("parent", F.expr(f"pmod(xxhash64(node), {width})").cast("long"))
        levels.append(level)
        if width == 1:
            break
        level = stored(level.groupBy("part", "parent").applyInArrow(_merge_level, "part int, node long, heads binary"), "merged")
        width = -(-width // FAN)
    answers = levels[-1].groupBy("part", "parent").applyInArrow(_judge_top, "part int, node long, answer binary")
    for children in reversed(levels):
        answers = stored(answers, "answers")
        answers = (children.groupBy("part", "parent").cogroup(answers.withColumnRenamed("node", "parent").groupBy("part", "parent"))
                   .applyInArrow(_answer_children, "part int, node long, answer binary"))
    return (blocks.groupBy("block").cogroup(answers.withColumnRenamed("node", "block").groupBy("block"))
            .applyInArrow(_add_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))


def op12_token_align(spark, sf_dir: str) -> DataFrame:
    return align_corpus(table(spark, sf_dir, "documents"))
