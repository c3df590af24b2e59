"""Unlabelled siblings, fixed choice of texts, byte-bounded cache, repeated rows over files, license paragraphs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from windtally.llm import license_diagonals, mixing, token_files, url_tree, weak_quality


def test_unlabelled_sibling_of_bad_branches_is_blocked(spark):
    rows = [(i, f"http://h.org/{'ab'[i % 2]}/p{'xyz'[i % 3]}") for i in range(80)]
    rows += [(100 + i, f"http://h.org/c/p{'xyz'[i % 3]}") for i in range(40)]
    rows += [(200 + i, f"http://mixed.org/{'ab'[i % 2]}/p") for i in range(80)] + [(300 + i, "http://mixed.org/c/p") for i in range(40)]
    rows += [(400 + i, f"http://new.org/{'ab'[i % 2]}/p") for i in range(40)]
    labels = [(i, False) for i in range(80)] + [(200 + i, i % 2 == 0) for i in range(80)] + [(1000 + i, True) for i in range(200)]
    rows += [(1000 + i, "http://good.org/a/p") for i in range(200)]
    got = url_tree.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, good boolean")).collect()
    verdicts = {}
    for r in got:
        verdicts.setdefault((r.host, r.path.split("/")[1]), set()).add(r.verdict)
    assert [verdicts["h.org", c] for c in "abc"] == [{"block"}] * 3
    # siblings that differ say nothing of a third one, nor does a host without labels
    assert [verdicts["mixed.org", c] for c in "abc"] == [{"allow"}, {"block"}, {"allow"}]
    assert [verdicts["new.org", c] for c in "ab"] == [{"allow"}] * 2
    assert {r.template for r in got if r.host == "new.org"} == {"/a/p", "/b/p"}


def test_models_do_not_depend_on_how_rows_are_dealt(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9)))
    rows = [(i % 40, " ".join(word() for _ in range(r.randint(5, 80)))) for i in range(160)] + [(1, None), (1, ""), (None, "a b")]
    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    models = []
    for parts in (1, 3, 7):
        r.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        models.append((weak_quality.train(docs)[1], mixing.train(docs, labels)))
    for a, b in models[1:]:
        assert np.array_equal(a, models[0][0]) and np.array_equal(b, models[0][1])


def test_least_rows_is_one_row_an_id(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, "b"), (2, None), (2, None)], "doc_id long, text string")
    got = weak_quality.least_rows(df).collect()
    assert sorted(r.doc_id for r in got) == [1, 2] and next(r for r in got if r.doc_id == 2).text is None


def test_cache_of_words_is_bounded_by_bytes(monkeypatch):
    encoder = token_files.Encoder(token_files.default_vocabulary())
    r = random.Random(1)
    long = ["".join(r.choice("abcdefghij") for _ in range(3000)) for _ in range(60)]
    mixed = [" ".join("".join(r.choice("abcdefghij") for _ in range(r.choice((5, 9, 90)))) for _ in range(50)) + ".\nEnd" for _ in range(60)]
    plain = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, encoder.kind).tobytes() for t in [*long, *mixed, *long]]
    monkeypatch.setattr(token_files, "CACHE_BYTES", 20_000)
    held = []
    got = []
    for t in [*long, *mixed, *long]:
        got += encoder.encode([t])
        assert all(len(w) <= token_files.CACHE_WORD for w in (*encoder.young, *encoder.old))
        held.append(encoder.held)
    assert got == plain
    assert max(held) < 20_000 + 50 * 600 and min(held[60:]) < 20_000  # one text's words over, and a new generation begun


@pytest.mark.parametrize("hot", ["5", "cast(null as bigint)"])
def test_equal_rows_spread_over_token_files(spark, scratch, hot):
    path = scratch() + "/docs"
    (spark.range(9000).selectExpr(f"if(id % 3 = 0, {hot}, id) AS doc_id", "if(id % 3 = 0, 'the same text', concat('text ', id)) AS text")
     .repartition(4).write.parquet(path))
    folder = scratch() + "/files"
    manifest = token_files.write_token_files(spark.read.parquet(path), folder, partitions=8)
    assert manifest.agg(F.sum("n_docs"), F.max("n_docs")).first()[0] == 9000
    assert manifest.agg(F.max("n_docs")).first()[0] < 2000
    got = token_files.read_token_files(manifest, folder).orderBy("start").collect()
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert ids == sorted(ids) and got[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


def test_each_license_paragraph_is_found_alone_and_edited(spark):
    r = random.Random(2)
    noise = lambda n: " ".join(f"q{r.randint(0, 10 ** 6)}" for _ in range(n))
    rows = []
    for i, (text, _) in enumerate(license_diagonals.PASSAGES):
        w = text.split()
        rows.append((i, f"{noise(30)} {text.capitalize()}. {noise(30)}"))
        # a word put in, one left out
        rows.append((100 + i, f"{noise(30)} {' '.join([*w[:5], 'zzz', *w[5:9], *w[10:]])} {noise(30)}"))
        rows.append((200 + i, noise(40) + " " + " ".join(w[:len(w) // 4]) + " " + noise(40)))
    got = {x.doc_id: x for x in license_diagonals.license_report(spark.createDataFrame(rows, "doc_id long, text string"), license_diagonals.templates(spark)).collect()}
    for i, (text, label) in enumerate(license_diagonals.PASSAGES):
        assert label in got[i].labels.split(",") and got[i].n_spans >= 1 and got[i].score == 1.0, text
        if len(text.split()) > 20:
            assert label in got[100 + i].labels.split(","), text
    assert not any(got[200 + i].labels for i, (t, _) in enumerate(license_diagonals.PASSAGES)
                   if t not in ("",) and "gnu general public license" not in " ".join(t.split()[:len(t.split()) // 4])
                   and "apache license" not in " ".join(t.split()[:len(t.split()) // 4]) and not t.startswith("permission is hereby granted"))


def test_cache_holds_words_without_their_marks():
    encoder = token_files.Encoder(token_files.default_vocabulary())
    r = random.Random(4)
    parts = ["Ein", "wörd", "l'eau", "Ω", "x1", "7", "á", ".", ",", ").", "?!", "'s", "'", " ", " ", " ", "\n", "\n", "　", "\x1c", "€"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(4000)] + ["", "\n", " ", ".", "a.\n", "\na. b.\n\nc (d). e."]
    plain = encoder.whole(texts)
    assert [x for lo in range(0, len(texts), 700) for x in encoder.encode(texts[lo:lo + 700])] == plain
    some = token_files.Encoder(token_files.default_vocabulary())
    some.encode(["Ein Wort.\nDer, (die) Tür!\nDas Ende."])
    assert {w for w in some.young if w.strip("\0").rstrip(".,!)") != w.strip("\0") and w.strip("\0.,!)")} == set()
    some.young, some.old = {}, some.young
    some.end_task()
    assert not some.old  # an idle worker keeps one generation
