"""Every operator against brute force or an exact property, on one table of hard cases:
nulls in any column, empty and long texts, repeated rows, extra clashing columns, and no rows."""
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from windtally.llm import (byte_cnn, flow_reshard, license_diagonals, mixing, order_minhash, prefix_decontam, simhash_bits, token_files,
                           url_tree, weak_quality)

ITEM = "Alpha beta gamma delta, epsilon zeta eta theta iota kappa lambda mu nu"
BASE = ("Der Hund und die Katze gehen in den großen Garten und spielen dort mit dem kleinen Ball, "
        "während der alte Mann auf der Bank sitzt und die Zeitung liest. ") * 3
ENGLISH = ("The dog and the cat walk into the large garden and play there with a small ball, "
           "while the old man sits on the bench and reads the paper. ") * 3
TEXTS = [
    ENGLISH, ENGLISH, BASE, BASE.replace("Ball", "Ring", 1), "", "   \n\t ", None, "word", "one two",
    f"before {ITEM} after " + ENGLISH, "alpha BETA gamma delta epsilon zeta eta theta iota kappa", "short item", "a short item here",
    "Released under the MIT License. Cc by; cc-BY and the Apache  license", "GNU General Public\nLicense mit license MIT LICENSE",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "the " * 3000,
    ENGLISH * 300, "日本語の文章です。" * 40, "a\x00b <|endoftext|> c  d\n\n e 'tis we'll", "x" * 5000, "12 34 %%% $$$", "É á Ñ " * 9, ENGLISH,
]
KIND = "doc_id long, text string, lang string, source string, n_chars long, fp long, component_id string, key string, score string, shard int"


def rows():
    out = []
    for i, t in enumerate(TEXTS):
        out.append((i, t, None if i % 7 == 3 else "de" if t and "und" in t else "en", None if i == 2 else f"s{i % 3}", None, 1, "c", "k", "s", 1))
    out += [out[0], out[6], (None, ENGLISH, "en", "s1", 1, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), KIND).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KIND)


def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, "short item"), (3, ""), (4, None), (10, ITEM)], "item_id long, text string")


def low(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def words(t):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t)) if w]


def order(values):
    return sorted(values, key=str)


def test_simhash(spark, docs, none):
    def fingerprint(t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", low(t)) if x]
        grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    want = [(r[0], fingerprint(r[1])) for r in rows()]
    group = list(range(len(want)))
    for _ in want:
        for i, a in enumerate(want):
            for j, b in enumerate(want):
                if bin(a[1] ^ b[1]).count("1") <= 2:
                    group[i] = group[j] = min(group[i], group[j])
    least = {g: min((d for (d, _), x in zip(want, group) if x == g and d is not None), default=None) for g in group}
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash_bits.near_duplicates(docs).collect()]
    assert order(got) == order((d, f"{f:016x}", least[g]) for (d, f), g in zip(want, group))
    kept = [r.doc_id for r in simhash_bits.keep_one(docs).collect()]
    assert order(kept) == order([x for x in set(least.values()) if x is not None] + [None, None])
    assert simhash_bits.keep_one(docs).columns == docs.columns
    assert simhash_bits.near_duplicates(none).count() == 0


def test_simhash_keeps_texts_that_share_an_id(spark):
    table = [(3, ENGLISH), (5, BASE), (5, BASE), (5, ENGLISH), (5, "word"), (7, BASE)]
    kept = simhash_bits.keep_one(spark.createDataFrame(table, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == sorted([(3, ENGLISH), (5, BASE), (5, "word")])


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_close_pairs(radius):
    r = np.random.default_rng(radius)
    base = r.integers(0, 1 << 63, 6).astype(np.uint64)
    sizes = [1, 2, 63, 64, 65, 200]
    fps = np.concatenate([np.unique(b ^ (np.uint64(1) << r.integers(0, 12, n).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 12, n).astype(np.uint64)) ^ r.integers(0, 4, n).astype(np.uint64)) for b, n in zip(base, sizes)])
    starts = np.array([0, 1, 2, 40, 41, 60, len(fps)])
    a, b = simhash_bits.close_pairs(fps, starts, radius)
    want = {(i, j) for k in range(6) for i in range(starts[k], starts[k + 1]) for j in range(i + 1, starts[k + 1])
            if bin(int(fps[i] ^ fps[j])).count("1") <= radius}
    assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)


def test_decontamination(spark, docs, none):
    windows = defaultdict(set)
    for i, t in [(1, ITEM), (2, "short item"), (10, ITEM)]:
        w = words(t)
        for k in range(max(1, len(w) - 9)):
            windows[tuple(w[k:k + 10])].add(i)
    want = []
    for r in rows():
        w, hit, found = words(r[1]), set(), set()
        for g, ids in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found |= ids
        want.append((r[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    got = prefix_decontam.contamination(docs, items(spark))
    assert order(map(tuple, got.collect())) == order(want)
    kept = prefix_decontam.keep_clean(docs, items(spark))
    assert kept.columns == docs.columns
    assert order(r.doc_id for r in kept.select("doc_id").collect()) == order(w[0] for w in want if not w[5])
    assert prefix_decontam.contamination(none, items(spark)).count() == 0
    assert not prefix_decontam.contamination(docs, items(spark).limit(0)).where("contaminated").count()


def test_licenses(spark, docs, none):
    want = []
    for r in rows():
        w, starts, labels = words(r[1]), [], set()
        for phrase, label in license_diagonals.PHRASES:
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k:k + len(p)] == p]
            starts += at
            labels |= {label} if at else set()
        want.append((r[0], len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    report = license_diagonals.license_report(docs, license_diagonals.templates(spark))
    got = report.collect()
    assert order((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == order(want)
    passage = next(r for r in got if r.doc_id == 15)
    assert passage.labels == "mit" and passage.base_labels == "" and passage.score == 1.0
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)
    assert license_diagonals.license_report(none, license_diagonals.templates(spark)).count() == 0


def test_order_minhash(spark, docs, none):
    table = [(r[0], r[1] or "") for r in rows()]
    ids = sorted({d for d, _ in table}, key=lambda d: (d is not None, d))
    text = {d: min(t for e, t in table if e == d) for d in ids}
    after = {d: text[ids[(k + 1) % len(ids)]] for k, d in enumerate(ids)}
    want = []
    for d, t in table:
        half = len(t) // 2
        want.append((d, len(t), hashlib.sha256((t[:len(t) - half] + after[d][:half]).encode()).hexdigest()))
    got = order_minhash.fingerprint_pairs(docs).collect()
    assert order((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == order(want)
    by = {r.doc_id: r for r in got}
    assert by[0].fingerprint == by[1].fingerprint == by[23].fingerprint and by[4].fingerprint == ""
    assert by[0].near_next == 1.0 and by[2].near_next > 0.5 and by[4].near_next == 1.0 and by[6].near_next == 0.0
    assert 0 < by[17].near_edited < 1 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert order_minhash.fingerprint_pairs(none).count() == 0


def test_order_matters(spark):
    w = [f"w{i}" for i in range(400)]
    df = spark.createDataFrame([(" ".join(w),), (" ".join(w[200:] + w[:200]),), (" ".join(reversed(w)),)], "text string")
    s = [set(r.sig) for r in order_minhash.signature(F.col("text"), df, "sig").collect()]
    assert len(s[0] & s[1]) < len(s[0]) and len(s[0] & s[2]) < len(s[0] & s[1])


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", "".join(chr(0x4E00 + i) for i in range(800))])
def test_order_minhash_of_unspaced_text_survives_an_insertion(spark, letters):
    r = np.random.default_rng(5)
    table = []
    for n in (400, 2000, 20000):
        t = "".join(r.choice(list(letters), n))
        table += [(n, t, e) for e in ("!" + t, t[:n // 2] + "!" + t[n // 2:], t[:n // 3] + " " + t[n // 3:], t[1:])]
    df = spark.createDataFrame(table, "n int, a string, b string")
    df = order_minhash.signature(F.col("b"), order_minhash.signature(F.col("a"), df, "sa"), "sb")
    for n, near in df.select("n", order_minhash.likeness(F.col("sa"), F.col("sb"))).collect():
        assert near > (0.7 if n == 400 else 0.9)


def test_order_matters_in_short_texts(spark):
    r = np.random.default_rng(6)
    table = []
    for n in (1, 2, 4, 30, 60, 1000):
        for k in range(40):
            w = [f"w{x}" for x in r.permutation(10 ** 6)[:n]]
            table.append((n, " ".join(w), " ".join(w[n // 2:] + w[:n // 2])))
    df = spark.createDataFrame(table, "n int, a string, b string")
    df = order_minhash.signature(F.col("b"), order_minhash.signature(F.col("a"), df, "sa"), "sb")
    sizes = df.select(F.array_distinct(F.transform("sa", lambda x: F.shiftright(x, 16))).alias("bins"), "sa").collect()
    assert all(r.bins == list(range(64)) and len(r.sa) == 64 for r in sizes)
    near = dict(df.groupBy("n").agg(F.avg(order_minhash.likeness(F.col("sa"), F.col("sb")))).collect())
    assert near[1] == 1 and near[2] < 0.1 and all(near[n] < 0.6 for n in (4, 30, 60, 1000)) and near[1000] > 0.4


def test_order_minhash_tokens(spark):
    text = "a  bc\t" + "x" * 16 + " 0123456789abcdefg \U0001F600é\n" + "日" * 17
    got = spark.createDataFrame([(text,)], "t string").select(F.regexp_extract_all("t", F.lit(order_minhash.TOKEN), F.lit(1))).first()[0]
    run = "0123456789abcdefg"
    assert got == ["a", "bc", "x" * 16] + [run[i:i + 8] for i in range(10)] + ["\U0001F600é"] + ["日" * 8] * 10


def test_reshard(spark, docs, none, scratch):
    got = flow_reshard.reshard(docs, F.col("shard"), scratch() + "/s", n_new=3).collect()
    assert order((r.doc_id, r.text) for r in got) == order((r[0], r[1]) for r in rows())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert flow_reshard.reshard(none, F.col("shard"), scratch() + "/s", n_new=3).count() == 0


def test_reshard_balance_and_least_moves(spark, scratch):
    many = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', cast(id % 97 as int)) AS text", "cast(least(id % 8, 3) as int) AS old")
    got = flow_reshard.plan(many, F.col("old"), 5).select("_old", "_shard", "_size").collect()
    size, kept = defaultdict(int), defaultdict(int)
    for o, s, b in got:
        size[s] += b
        kept[o] += b * (o == s)
    target = sum(size.values()) / 5
    assert max(size.values()) - min(size.values()) < 0.01 * target
    assert kept[3] > 0.98 * target  # the large old shard keeps a full share
    out = scratch() + "/s"
    flow_reshard.reshard(many.withColumn("old", F.pmod("doc_id", F.lit(2)).cast("int")), F.col("old"), out, 2, only_affected=True)


def test_flow_is_minimal():
    flow = flow_reshard.min_cost_flow([5, 3, 0], [2, 2, 4], np.array([[0., 1, 2], [1, 0, 5], [1, 1, 0]]))
    assert flow.sum(axis=1).tolist() == [5, 3, 0] and flow.sum(axis=0).tolist() == [2, 2, 4]
    cost = (flow * np.array([[0, 1, 2], [1, 0, 5], [1, 1, 0]])).sum()
    best = min(a * 0 + b * 1 + (5 - a - b) * 2 + (2 - a) * 1 + (2 - b) * 0 + (3 - (2 - a) - (2 - b)) * 5
               for a in range(3) for b in range(3) if 0 <= 5 - a - b <= 4 and 0 <= 3 - (2 - a) - (2 - b))
    assert cost == best


def test_token_files(spark, docs, none, scratch):
    encoder = token_files.Encoder(token_files.default_vocabulary())
    ordered = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    got = token_files.encode_corpus(docs)
    got = {(r.start): r for r in got.collect()}
    at, null = 0, []
    for r in ordered:
        ids = encoder.tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        if r[0] is None:
            null.append(len(ids))
            at += len(ids)
            continue
        row = got[at]
        assert (row.doc_id, row.n_tokens, row.ids_crc32) == (r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert sorted(r.n_tokens for r in got.values() if r.doc_id is None) == sorted(null)
    assert token_files.encode_corpus(none).count() == 0


def test_encoder_equals_library():
    import random
    encoder = token_files.Encoder(token_files.default_vocabulary())
    random.seed(3)
    letters = ["a", "b", "Z", "é", " ", " ", "\n", ".", ",", "'", "s", "ll", "1", "\t", "-", "<|endoftext|>", "\u3000", "\x00", "\x1c"]
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 14))) for _ in range(3000)]
    for lo in range(0, 3000, 500):
        assert encoder.encode(texts[lo:lo + 500]) == encoder.whole(texts[lo:lo + 500])


def test_language(spark, docs, none):
    many = spark.createDataFrame([(i, (BASE if i % 2 else ENGLISH)[i % 50:][:150], "de" if i % 2 else "en") for i in range(400)], "doc_id long, text string, lang string")
    net = byte_cnn.train(many)
    out = byte_cnn.identify(many, net).join(many, "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.95
    assert {r.doc_id for r in out} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    got = byte_cnn.identify(docs, net).collect()
    assert len(got) == len(rows()) and {r.lang_pred for r in got} <= {"de", "en", "und"}
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (4, 5, 6, 21))
    odd = byte_cnn.identify(spark.createDataFrame([(1, "½ ² 12 ٣"), (2, "½ a")], "doc_id long, text string"), net).collect()
    assert [r.lang_pred == "und" for r in sorted(odd)] == [True, False]
    assert byte_cnn.keep_known(docs, net).columns == docs.columns
    assert byte_cnn.identify(none).count() == 0


def test_quality(spark, docs, none):
    got = weak_quality.quality(docs).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 and len(r.votes) == 8 for r in got)
    assert weak_quality.quality(none).count() == 0


def test_variety_does_not_depend_on_length():
    r = np.random.default_rng(4)
    vary = lambda n, vocabulary: " ".join(f"w{x}" for x in r.integers(0, vocabulary, n))
    part = vary(300, 10 ** 6)
    texts = [" ".join([part] * 67)[:k] for k in (13500, 10 ** 7)] + [vary(n, 200) for n in (1500, 20000)]  # bad
    texts += [vary(n, 10 ** 4) for n in (1500, 20000, 400000)] + [vary(20000, 1500) + " " + part]  # good
    p = weak_quality.profile([*texts, "", None], run=weak_quality.RUN)
    assert weak_quality.votes(p)[:-2, -1].tolist() == [-1] * 4 + [1] * 4
    for t, got in zip(texts[:6], p.distinct):
        w = t.split()
        assert got == sum(len(set(w[i:i + weak_quality.RUN])) for i in range(0, len(w), weak_quality.RUN))
    assert p.distinct[-2:].tolist() == [0, 0]


def test_em_recovers_accuracies():
    r = np.random.default_rng(1)
    y = r.random(20000) < 0.7
    right = np.array([0.9, 0.8, 0.7, 0.6, 0.75, 0.85, 0.55, 0.65])
    v = np.where(r.random((20000, 8)) < right, 1, -1) * np.where(y, 1, -1)[:, None] * (r.random((20000, 8)) < 0.8)
    p, n = np.unique(weak_quality.pattern(v), return_counts=True)
    posterior, accuracy, good = weak_quality.estimate(p, n)
    assert abs(good - 0.7) < 0.05
    assert np.abs(accuracy[:, 1, 2] / (accuracy[:, 1, 0] + accuracy[:, 1, 2]) - right).max() < 0.05
    assert ((posterior[weak_quality.pattern(v)] > 0.5) == y).mean() > 0.9


def test_mixing(spark, docs, none):
    labels = spark.createDataFrame([(0, 1, 0), (2, 0, 0), (16, 0, 0), (20, 1, 1), (None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = mixing.mixing_rates(docs, labels).collect()
    assert len(got) == len(rows()) and all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    assert mixing.mixed(docs, labels).columns == docs.columns
    assert mixing.mixing_rates(none, labels).count() == 0
    assert mixing.mixing_rates(docs, labels.limit(0)).count() == len(rows())


def test_mixing_meets_targets(spark):
    r = np.random.default_rng(2)
    p = r.dirichlet([2, 1, 0.5], 500)
    tokens = r.integers(1, 900, 500)
    table = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p)], "tokens long, p array<double>")
    history, step = mixing.solve(table, (0.2, 0.5, 0.3))
    rate = mixing.rates(p, history, step)
    assert (rate >= 0).all()
    assert np.abs((p * (rate * tokens)[:, None]).sum(axis=0) / tokens.sum() - (0.2, 0.5, 0.3)).max() < 1e-3


@pytest.mark.parametrize("shares", [(30, 5, 5), (.9, .099, .001), (9, .99, .01), (7.5, 1.3, 1.2)])
def test_mixing_meets_targets_of_rare_and_soft_domains(spark, shares):
    r = np.random.default_rng(3)
    p = r.dirichlet(shares, 20000)
    tokens = r.integers(1, 900, len(p))
    table = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p)], "tokens long, p array<double>")
    rate = mixing.rates(p, *mixing.solve(table))
    assert (rate >= 0).all()
    assert np.abs((p * (rate * tokens)[:, None]).sum(axis=0) / tokens.sum() - mixing.TARGETS).max() < mixing.TOLERANCE * 1.01


def test_mixing_reports_targets_out_of_reach(spark, caplog):
    p = np.array([[0.7, 0.3, 0.0], [0.2, 0.8, 0.0]])
    table = spark.createDataFrame([(5, x.tolist()) for x in p], "tokens long, p array<double>")
    rate = mixing.rates(p, *mixing.solve(table))
    assert np.allclose(rate, [0.316 / 0.145, 0], atol=1e-5) and "out of reach" in caplog.text  # least squares with the second rate at 0
    assert mixing.rates(p, *mixing.solve(table.limit(0))).tolist() == [1, 1]


def test_urls(spark):
    urls = ["http://WWW.Example.com/en/1?x", "https://a.net/es/x", "http://a.net/fr", "no url", None, "", "http://example.com#f", "x://h/a?b://c/d",
            "http://example.com/en/2", "http://shop.org/" + "/".join("abcdefghijkl"), "ftp://q.org/\nz/1", "http://com/"]
    urls += [f"http://shop.org/p/slug{chr(97 + i % 26)}{chr(97 + i // 26)}-x/{i}" for i in range(60)] + [f"http://bad.org/t/{i}" for i in range(30)]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h"), (None, urls[1], None)], "page_id long, url string, host string")
    labels = spark.createDataFrame([(i, "shop" in (u or "")) for i, u in enumerate(urls) if u and ("shop" in u or "bad" in u)] + [(None, True)], "page_id long, good boolean")
    got = url_tree.judge_urls(pages, labels).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        u = urls[1] if r.page_id is None else urls[r.page_id]
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.split(r"[/?#]", rest, maxsplit=1)[0]
            path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
            host = low(host)
        fits = [(len(h + p), h + p, v) for h, p, v in url_tree.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.verdict == (max(fits)[2] if fits else "block" if host in ("", "bad.org") else "allow")
    twice = labels.limit(0).selectExpr("page_id AS doc_id", "1 AS quality", "0 AS toxic").union(
        spark.createDataFrame([(2, 1, 0), (2, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int"))
    assert [tuple(r) for r in url_tree.labelled_pages(pages.where("page_id = 8"), twice).collect()] == [(8, False)]
    slugs = {r.template for r in got if r.host == "shop.org" and "slug" in r.path}
    assert len(slugs) == 1 and slugs.pop().split("/")[2] == "*"  # 60 different slugs are one variable
    assert url_tree.judge_urls(pages.limit(0), labels).count() == 0


def test_urls_differ_at_any_depth(spark):
    deep = "/".join("abcdefghijkl")
    urls = [f"http://deep.org/{deep}/{'good' if i % 2 else 'bad'}/{i}" for i in range(400)]
    urls += ["http://trap.org" + "/x" * n for n in range(1, 301)]  # one chain: no level for each segment
    urls += [f"http://pair.org/{deep}/end/{deep}", f"http://pair.org/{deep}/end/{deep}/z", f"http://pair.org/{deep}/other/**"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2 == 1) for i in range(400)], "page_id long, good boolean")
    got = {r.page_id: r for r in url_tree.judge_urls(pages, labels).collect()}
    assert len(got) == len(urls)
    for i in range(400):
        assert (got[i].verdict, got[i].template) == (("allow", f"/{deep}/good/<n>") if i % 2 else ("block", f"/{deep}/bad/<n>"))
    assert all(got[i].template == got[i].path for i in range(400, len(urls)))


def test_pipeline_keeps_columns_and_work(spark, docs, scratch):
    import corpus_pipeline
    d = scratch()
    docs.write.parquet(d + "/documents.parquet")
    items(spark).write.parquet(d + "/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0), (2, 1, 0), (16, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(d + "/labels.parquet")
    cur = spark.read.parquet(d + "/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, cur, d)
        assert out.columns == cur.columns, name
        cur = out
    final = corpus_pipeline.run(spark, d)
    assert final.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert not {r.doc_id for r in final.collect()} & {4, 6, 9, 10, 11, 12}  # blank, contaminated
