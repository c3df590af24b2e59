"""Suffix removal, token alignment and vector codes against brute force."""
import bisect
import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from windtally.llm import suffix_dedup, token_align, vector_codes

KIND = "doc_id long, text string, lang string, source string, n_chars long, block long, bucket string, payload string, part string, spans int, kept string"
PASSAGE = "a passage of more than fifty bytes that several of the documents share, word by word; "


def doc_rows():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 9)))
    fresh = lambda n: " ".join(word() for _ in range(n))
    texts = [PASSAGE + fresh(30), fresh(20) + PASSAGE + fresh(9), PASSAGE[:50], PASSAGE[:49], "x" + PASSAGE[3:70], None, "", "x" * 500, "x" * 400,
             "ab" * 200 + "c", "c" + "ab" * 150, fresh(4000), "日本語の文章です。" * 30, "é" + "日本語の文章です。" * 20, "short",
             fresh(5) + PASSAGE * 3, "\u0000" * 60, " ", "trail ", "▁ lone mark", "<s> <|endoftext|> <0x41>\n\tx  y"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(0, texts[0]), (0, PASSAGE * 2), (None, PASSAGE + "no id"), (None, None), (None, PASSAGE * 2), (2, texts[2]), (40, texts[11] + PASSAGE)]
    return [(i, t, "en", "s", 1, 7, "b", "p", "q", 2, "k") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(doc_rows(), KIND).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KIND)


# ------------------------------------------------------------------- suffixes
def removal(rows, size):
    least = {}
    data = [(i, -1 << 63 if i is None else i, (t or "").encode()) for i, t in rows]
    for _, k, b in data:
        for p in range(len(b) - size + 1):
            w = b[p:p + size]
            least[w] = min(least.get(w, k), k)
    out = []
    for i, k, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if least[b[p:p + size]] < k:
                gone[p:p + size] = b"\1" * size
        spans, p = [], 0
        while p < len(b):
            if gone[p]:
                q = p
                while q < len(b) and gone[q]:
                    q += 1
                spans.append((p, q))
                p = q
            else:
                p += 1
        out.append((i, len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def removed(df):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size,block,bucket,hot", [(50, 1 << 20, 4 << 20, 1000), (50, 3000, 5000, 1000), (50, 3000, 5000, 1), (16, 9000, 9000, 3), (37, 200, 400, 2)])
def test_suffix_removal_equals_every_window_compared(docs, monkeypatch, size, block, bucket, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SORTED", 100)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    want = removal([r[:2] for r in doc_rows()], size)
    assert removed(suffix_dedup.remove_repeats(docs, size, block, bucket)) == want
    assert sum(e - s for w in want for s, e in w[2]) > 500


def test_suffix_removal_of_copies_and_of_nothing(spark, none):
    assert suffix_dedup.remove_repeats(none).collect() == []
    copies = spark.createDataFrame([(i, PASSAGE * 4 + ("" if i % 3 else "x")) for i in range(300)], "doc_id long, text string").repartition(7)
    got = removed(suffix_dedup.remove_repeats(copies, block_bytes=2000, bucket_bytes=4000))
    assert got == removal([(i, PASSAGE * 4 + ("" if i % 3 else "x")) for i in range(300)], 50)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(none, 15)


def test_radix_groups_are_the_equal_windows():
    r = np.random.default_rng(1)
    data = r.integers(0, 2, 4000).astype(np.uint8)
    at = np.arange(0, 3900)
    low = r.integers(0, 50, len(at))
    for size in (8, 11, 16, 19):
        alive, least = suffix_dedup.radix_groups(data, at, np.zeros(len(at), int), low, low, size)
        groups = defaultdict(list)
        for p in at.tolist():
            groups[data[p:p + size].tobytes()].append(p)
        want = {p: min(low[g]) for g in groups.values() if len({*low[g].tolist()}) > 1 for p in g}
        assert dict(zip(at[alive].tolist(), least.tolist())) == want


# ------------------------------------------------------------------ alignment
def aligned(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    path_a, path_b = token_align.default_vocabularies()
    t = Tokenizer.from_file(path_a)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
    text_of = token_align.byte_letters()
    token_a = lambda k: bytes(text_of[c] for c in t.id_to_token(k))
    token_b = lambda k: bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode()
    out = []
    for i, x in rows:
        a = t.encode(" " + x, add_special_tokens=False).ids if x else []
        b = sp.encode(x) if x else []
        raw = (" " + (x or "")).encode()
        if not x or b"".join(map(token_a, a)) != raw or b"".join(map(token_b, b)) != raw:
            out.append((i, [], [], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(f(k)) for k in ids]).tolist() for f, ids in ((token_a, a), (token_b, b)))
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = [([], []) for _ in cuts]
        for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
            for k, e in zip(ids, ends):
                groups[bisect.bisect_left(cuts, e)][side].append(str(k))
        links = [(p, q) for p, e, s in zip(a, ends_a, [0, *ends_a]) for q, f, g in zip(b, ends_b, [0, *ends_b]) if s < f and g < e]
        out.append((i, a, b, [",".join(x) + "|" + ",".join(y) for x, y in groups], links))
    count, best = defaultdict(int), defaultdict(int)
    for d in out:
        for pair in set(d[4]):
            count[pair] += 1
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    return sorted([(i, len(a), len(b), len(g), len(l), sum(count[x] == best[x[0]] for x in l), sum(count[x] for x in l),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, a, b, g, l in out], key=repr)


@pytest.mark.parametrize("fan,block,partitions,cache", [(512, 4 << 20, 64, 48 << 20), (2, 800, 3, 2000)])
def test_alignment_equals_whole_texts_compared(docs, monkeypatch, fan, block, partitions, cache):
    for name, value in (("FAN", fan), ("BLOCK_BYTES", block), ("PARTITIONS", partitions), ("CACHE_BYTES", cache)):
        monkeypatch.setattr(token_align, name, value)
    rows = [r[:2] for r in doc_rows() if r[0] != 11 and r[0] != 40]  # the long ones are compared pair by pair above
    want = aligned(rows)
    got = token_align.align_corpus(docs.where("doc_id is null or doc_id not in (11, 40)"))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert any(w[1] == 0 and w[7] == "" for w in want) and any(w[5] < w[4] for w in want)


def test_segments_have_the_tokens_of_whole_texts():
    a = token_align.Aligner(*token_align.default_vocabularies())
    assert a.by_segment
    r = random.Random(3)
    alphabet = ["a", "Zb", "é", "日本", " ", " ", "  ", "\n", "\t", " ", "　", "\x1c", " ", "'s", "1", "!?", "<s>", "\r\n", "​", "ﬁ"]
    for _ in range(300):
        text = "".join(r.choice(alphabet) for _ in range(r.randrange(1, 30)))
        parts = a.segments(text)
        assert "".join(parts) == " " + text
        whole = a.a.tokenizer.encode(" " + text, add_special_tokens=False).ids
        assert [i for x in a.a.parts(parts) for i in np.frombuffer(x, a.a.kind).tolist()] == whole, text
        entries = a.encode([text])[0]
        said = ";".join(e[1] for e in entries)
        assert [int(i) for g in said.split(";") for i in g.split("|")[1].split(",")] == a.b.encode(text), text


def test_alignment_of_no_rows_and_merge(none):
    assert token_align.align_corpus(none).collect() == []
    r = random.Random(2)
    runs = [(np.array(sorted(r.sample(range(200), 40)), "<u8"), np.array([r.randrange(1, 9) for _ in range(40)], "<u8")) for _ in range(7)]
    total = defaultdict(int)
    for p, c in runs:
        for x, n in zip(p.tolist(), c.tolist()):
            total[x] += n
    pairs, counts = token_align.merge(runs)
    assert dict(zip(pairs.tolist(), counts.tolist())) == total and pairs.tolist() == sorted(total)


# ---------------------------------------------------------------------- codes
def codes(rows, parts=16, entries=64, rounds=2):
    kept = sorted(((i is None, i or 0, v, label) for i, v, label in rows if v and all(x is not None and np.isfinite(np.float32(x)) for x in v)), key=lambda r: r[:3])
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    limit = vector_codes.LARGEST
    x = [[max(-limit, min(limit, int(np.floor(256 * float(np.float32(c)))))) for c in r[2]] for r in kept]
    width = -(-len(x[0]) // parts)
    x = [v + [0] * (parts * width - len(v)) for v in x]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in x]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    for k in range(rounds + 1):
        near = [[min(range(len(books[p])), key=lambda e: (dist(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]
        if k < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    mine = [c[p] for c, n in zip(cut, near) if n[p] == e]
                    if mine:
                        books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    error = [sum(dist(c[p], books[p][n[p]]) for p in range(parts)) for c, n in zip(cut, near)]
    return sorted([(None if r[0] else r[1], "".join(f"{e:02x}" for e in n), d) for r, n, d in zip(kept, near, error)], key=repr), books


VEC = "vec_id long, embedding array<float>, label int, code int, state string, entry string"


def vectors(n, dim, seed):
    r = np.random.default_rng(seed)
    rows = [(i * 3 % 1009, [float(v) for v in np.float32(r.normal(size=dim) * 0.3 + (i % 5))], None if i % 7 == 0 else i % 4, 1, "s", "e") for i in range(n)]
    return rows


@pytest.mark.parametrize("dim,n", [(64, 150), (20, 90), (16, 30)])
def test_codes_equal_plain_kmeans(spark, dim, n):
    rows = vectors(n, dim, dim)
    rows += [rows[0], (rows[1][0], [2.0] * dim, 1, 1, "s", "e"), (None, [1.0] * dim, 1, 1, "s", "e"), (5000, None, 1, 1, "s", "e"), (5001, [], 1, 1, "s", "e"),
             (5002, [None] + [0.0] * (dim - 1), 1, 1, "s", "e"), (5003, [float("nan")] * dim, 1, 1, "s", "e"), (5004, [float("-inf")] * dim, 1, 1, "s", "e"),
             (5005, [1.0] * (dim + 1), 1, 1, "s", "e"), (5006, [-0.001, 3e38] + [-1e30] * (dim - 2), 1, 1, "s", "e")]
    df = spark.createDataFrame(rows, VEC).repartition(4)
    coded, book = vector_codes.compress(df)
    want, books = codes([(r[0], r[1], r[2]) for r in rows])
    assert sorted(((r.vec_id, r.code, r.error) for r in coded.collect()), key=repr) == want
    assert book.tolist() == books


def test_codes_query_sums_errors_by_label(spark, scratch):
    path = scratch("emb")
    rows = vectors(80, 64, 3)
    spark.createDataFrame(rows, VEC).write.mode("append").parquet(f"{path}/embeddings.parquet")
    got = vector_codes.op13_vector_codes(spark, path).collect()
    label = {r[0]: r[2] for r in rows}
    total = defaultdict(int)
    for r in got:
        total[label[r.vec_id]] += r.error
    assert len(got) == 80 and all(r.label_error == total[label[r.vec_id]] for r in got)
    assert len({r.codebooks_sha256 for r in got}) == 1 and len(got[0].code) == 32


def test_codes_of_no_rows(spark, scratch):
    path = scratch("emb")
    spark.createDataFrame([(1, None, 1, 1, "s", "e")], VEC).write.mode("append").parquet(f"{path}/embeddings.parquet")
    assert vector_codes.op13_vector_codes(spark, path).collect() == []


def test_bounds_skip_scans_and_never_err():
    r = np.random.default_rng(0)
    x = np.concatenate([r.integers(-300, 300, (40, 4)) * 0 + c + r.integers(-9, 9, (40, 4)) for c in r.integers(-300, 300, (12, 4))])
    history = [x[::40].copy()]
    state, scans = vector_codes.scan(x, history[0], 0), []
    for now in range(1, 6):
        book = history[-1].copy()
        for e in range(len(book)):
            mine = x[state["entry"] == e]
            if len(mine):
                book[e] = mine.sum(axis=0) // len(mine) + (r.integers(-2, 3, 4) if now < 4 else 0)
        history.append(book)
        state, n = vector_codes.reassign(x, state, history, now)
        scans.append(n)
        assert (state["entry"] == vector_codes.scan(x, book, now)["entry"]).all()
    assert max(scans) < len(x) / 2
    # there and back: the net displacement is nothing, so no bound has to give
    back, n = vector_codes.reassign(x, vector_codes.scan(x, history[0], 0), [history[0], history[0] + 50, history[0]], 2)
    assert n <= (x[:, None] == history[0][None]).all(axis=2).sum() and (back["entry"] == vector_codes.scan(x, history[0], 0)["entry"]).all()


# ------------------------------------------------ limits taken out of earlier operators
def test_many_languages_are_all_learned(spark):
    from windtally.llm import byte_cnn

    df = spark.createDataFrame([(k * 4 + j, f"word{k} text", f"l{k:03d}") for k in range(260) for j in range(4)], "doc_id long, text string, lang string")
    sample = byte_cnn.training_windows(df)
    free = {lang for i, _, lang in df.collect() if __import__("zlib").crc32(str(i).encode()) % 4 != 2}
    assert set(sample["lang"]) == free and len(free) > 250
    assert byte_cnn.least_score(4) == pytest.approx(0.35, abs=1e-5)
    assert byte_cnn.least_score(1) <= 1 and 1 / 260 < byte_cnn.least_score(260) < 0.2
    shares = [byte_cnn.least_score(k) * k for k in (2, 4, 50, 260)]
    assert shares == sorted(shares)  # always above an even guess


def test_words_are_whole_across_pieces(monkeypatch):
    from windtally.llm import textvec

    r = random.Random(1)
    texts = [" ".join("".join(r.choice("abcdé") for _ in range(r.randrange(1, 90))) for _ in range(200)) for _ in range(5)] + ["x" * 700, "%" * 700, "", "a " * 99]
    whole = textvec.profile(texts)
    monkeypatch.setattr(textvec, "PIECE", 64)
    parts = textvec.profile(texts)
    assert (whole.stats[:, :6] == parts.stats[:, :6]).all() and (whole.seen == parts.seen).all()
    assert parts.stats[5, 0] == 1 and parts.stats[0, 0] == 200


def test_long_chain_of_diagonals_keeps_its_passages(spark):
    from windtally.llm import license_diagonals as ld

    text = dict((b, a) for a, b in ld.PASSAGES)["mit"]
    stutter = " ".join(text.split()[:3]) + " "
    df = spark.createDataFrame([(1, stutter * 40 + text + " " + stutter * 40), (2, text), (3, stutter * 40), (4, " ".join([text] * 3))], "doc_id long, text string")
    got = {r.doc_id: r for r in ld.license_report(df, ld.templates(spark)).collect()}
    assert "mit" in got[1].labels and got[1].n_spans >= 1
    assert (got[2].n_spans, got[2].score, got[4].n_spans) == (1, 1.0, 3)
    assert got[3].labels == ""


@pytest.mark.parametrize("same", ["repeated", "null"])
def test_bytes_law_holds_with_a_third_of_equal_rows(spark, scratch, same):
    from windtally.llm import flow_reshard as fr

    hot = "7" if same == "repeated" else "cast(null as bigint)"
    df = spark.range(3000).selectExpr(f"if(id % 3 = 0, {hot}, id) AS doc_id", "repeat('x', 400) AS text", "cast(id % 8 as int) AS old")
    for n in (5, 40):
        out = fr.reshard(df, F.col("old"), f"{scratch()}/s", n)
        load = {r.shard: r.b for r in out.groupBy("shard").agg(F.sum(fr.row_size()).alias("b")).collect()}
        assert len(load) == n and sum(load.values()) == 3000 * 416
        assert max(load.values()) - min(load.values()) <= 2 * 416
        slots = out.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
        assert all(s.n == s.d == s.m + 1 for s in slots)


def test_untouched_shards_are_returned_not_rewritten(spark, scratch):
    from windtally.llm import flow_reshard as fr

    df = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', 40) AS text", "cast(id % 3 as int) AS old")
    out = f"{scratch()}/s"
    got = fr.reshard(df, F.col("old"), out, 3, only_affected=True)
    assert sorted((r.doc_id, r.shard) for r in got.collect()) == [(i, i % 3) for i in range(3000)]
    assert spark.read.schema("doc_id long").parquet(out).count() == 0
    # four old shards to three: the fourth is dealt out, bytes moved are the flow's least
    four = df.withColumn("old", F.pmod("doc_id", F.lit(4)).cast("int"))
    planned = fr.plan(four, F.col("old"), 3).select("_old", "_shard", "_size").collect()
    assert {b for _, _, b in planned} == {56}
    moved = sum(b for o, s, b in planned if o != s)
    assert 750 * 56 <= moved <= 750 * 56 + 3 * 56 * 3


def test_reshard_query_against_its_table(spark, scratch):
    from windtally.llm import flow_reshard as fr

    path = scratch("docs")
    rows = [(i if i % 3 else 5, None if i % 11 == 0 else "t" * (i % 50), f"s{i % 6}" if i % 5 else None) for i in range(600)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).write.mode("append").parquet(f"{path}/documents.parquet")
    got = fr.op8_flow_reshard(spark, path).collect()
    want = sorted((d, len(t or "") + 16, __import__("zlib").crc32((t or "").encode())) for d, t, _ in rows)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)} and {r.shard for r in got} <= set(range(40))
    load = defaultdict(int)
    slots = defaultdict(list)
    for r in got:
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(load) == 40 and max(load.values()) - min(load.values()) <= 66
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
