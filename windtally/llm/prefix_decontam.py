"""Benchmark decontamination by a prefix-filtered set join (native functions only).

An item's windows are its runs of ``WINDOW`` words (an item of fewer words is
one window).  A window is the set of its word shingles; to contain it wholly a
document needs every one of them, so a prefix of one shingle is necessary, and
the rarest in the corpus is taken.  Steps:

1. one pass over the texts joins all shingles of documents with those of the
   benchmark (``phrases.gram_occurrences``) and stores the few matches;
2. shingle frequencies over the whole corpus give the order by rarity;
3. documents' occurrences are joined with prefix shingles only; the position
   in the window gives the start, bounded by the document's length;
4. the window's other words are verified exactly, by joining shingles that
   cover it at their places (the strings themselves, not hashes).

Defined results: a null text or one without words has no windows and no hits;
an item without words has no window; equal item texts count as several items;
repeated rows are returned each; null doc_ids keep their row; an empty
benchmark contaminates nothing.  Only doc_id, item_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import same_document, small_side, stored, table, text_of
from .phrases import gram_occurrences, gram_sizes, lower_words

WINDOW = 10
SHINGLE = 5
#: Windows that may be broadcast (a few hundred bytes each).
MAX_BROADCAST_WINDOWS = 100_000


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item_id, win, n)``: each item's windows as blank-joined words, with their word count."""
    cut = f"transform(sequence(0, greatest(size(words) - {window}, 0)), i -> slice(words, i + 1, {window}))"
    return (items.select("item_id", lower_words(text_of()).alias("words")).where(F.size("words") > 0)
            .select("item_id", F.explode(F.expr(cut)).alias("w"))
            .select("item_id", F.array_join("w", " ").alias("win"), F.size("w").alias("n")).distinct())


def window_grams(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(win, n, off, gram)``: every shingle of every distinct window."""
    size = f"least({shingle}, n)"
    cut = (f"transform(sequence(0, n - {size}), i -> struct(i as off, "
           f"array_join(slice(split(win, ' '), i + 1, {size}), ' ') as gram))")
    return windows.select("win", "n").distinct().select("win", "n", F.explode(F.expr(cut)).alias("g")).select("win", "n", "g.*")


def occurrences(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, text_key, n_words)`` per document row, and
    ``(doc_id, text_key, win, n, start)`` for each place of a window in a document."""
    wanted = stored(window_grams(windows, shingle), "window-grams")
    found = stored(gram_occurrences(docs, wanted.select("gram").distinct(), gram_sizes(wanted)), "gram-places")
    base = found.where("pos < 0").select("doc_id", "text_key", "n_words")
    places = found.where("pos >= 0")
    # rarity order: the least frequent shingle is the necessary prefix
    seen = places.groupBy("gram").agg(F.count(F.lit(1)).alias("freq"))
    prefix = (wanted.join(seen, "gram").groupBy("win", "n")
              .agg(F.count(F.lit(1)).alias("seen_grams"), F.min(F.struct("freq", "gram", "off")).alias("rare"))
              .where(F.col("seen_grams") == F.col("n") - F.least(F.lit(shingle), "n") + 1)
              .select("win", "n", "rare.gram", "rare.off"))
    prefix = stored(prefix, "prefixes")
    candidates = (places.join(small_side(prefix, MAX_BROADCAST_WINDOWS), "gram")
                  .select("doc_id", "text_key", "n_words", "win", "n", (F.col("pos") - F.col("off")).alias("start"))
                  .where("start >= 0 and start + n <= n_words").distinct())
    # shingles that cover the whole window, each wanted at its place
    cover = wanted.where(f"off % {shingle} = 0 or off = n - {shingle}")
    need = cover.groupBy("win").agg(F.count(F.lit(1)).alias("n_need"))
    cover = stored(cover.join(need, "win").select("win", "off", "gram", "n_need"), "covers")
    asked = (candidates.join(small_side(cover, MAX_BROADCAST_WINDOWS), "win")
             .withColumn("pos", F.col("start") + F.col("off")))
    have = places.select("doc_id", "text_key", "pos", "gram").distinct().withColumnsRenamed(
        {"doc_id": "p_id", "text_key": "p_key", "pos": "p_pos", "gram": "p_gram"})
    met = asked.join(have, asked["doc_id"].eqNullSafe(have["p_id"]) & (asked["text_key"] == have["p_key"])
                     & (asked["pos"] == have["p_pos"]) & (asked["gram"] == have["p_gram"]), "left_semi")
    exact = (met.groupBy("doc_id", "text_key", "win", "n", "start", "n_need").agg(F.count(F.lit(1)).alias("met"))
             .where("met = n_need").select("doc_id", "text_key", "win", "n", "start"))
    return base, stored(exact, "window-places")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    windows = stored(item_windows(items, window), "windows")
    base, exact = occurrences(docs, windows)
    hit = (exact.select("doc_id", "text_key", F.explode(F.sequence("start", F.expr("start + n - 1"))).alias("pos")).distinct()
           .groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n_hit")))
    named = (exact.select("doc_id", "text_key", "win").distinct()
             .join(windows.select("item_id", "win"), "win").select("doc_id", "text_key", "item_id").distinct()
             .groupBy("doc_id", "text_key")
             .agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("ids")))
    out = same_document(same_document(base, hit, "left"), named, "left")
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, in which no window of an item occurs.
    The join is by (doc_id, text), so a clean text with a contaminated one's id stays."""
    windows = stored(item_windows(items), "windows")
    _, exact = occurrences(docs, windows)
    dirty = exact.select(F.col("doc_id").alias("_dirty_id"), F.col("text_key").alias("_dirty_key")).distinct()
    return docs.join(dirty, docs["doc_id"].eqNullSafe(dirty["_dirty_id"])
                     & (F.xxhash64(text_of()) == dirty["_dirty_key"]), "left_anti")


def op5_prefix_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_WORDS = ("[x for x in string_split_regex(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> '']")

ORACLE = f"""
with d as (select doc_id, {ORACLE_WORDS.format('text')} w from documents),
b as (select item_id, {ORACLE_WORDS.format('text')} w from benchmark),
win as (select item_id, array_to_string(w[i + 1 : i + 10], ' ') g, least(10, len(w)) n
        from (select item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) i from b where len(w) > 0)),
dg as (select doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') g
       from (select doc_id, w, s.n, unnest(range(greatest(len(w) - s.n + 1, 0))) i from d, (select distinct n from win) s)),
occ as (select distinct doc_id, i, dg.n, item_id from dg join win on dg.g = win.g and dg.n = win.n),
hit as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from occ) group by 1),
it as (select doc_id, count(*) n_items, string_agg(id, ',' order by id) ids
       from (select distinct doc_id, cast(item_id as varchar) id from occ) group by 1)
select d.doc_id, len(d.w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hit using (doc_id) left join it using (doc_id)
"""
