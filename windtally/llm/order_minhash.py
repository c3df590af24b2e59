"""Order MinHash fingerprints (native functions only).

A run of at most ``RUN`` non-blank characters is a token.  A longer run (text
without blanks, a URL, base64) has a token at every character, the ``GRAM``
characters that start there, so that an inserted character changes only the
tokens around it.  A k-mer is ``K`` consecutive tokens (a shorter text is one
k-mer).  The o-th occurrence of a k-mer is an element of its own,
with its own hash.  The hash space is a circle cut into bins; for each bin the
first ``PICK`` elements from its beginning on, if need be in the bins after it,
are selected, put back in text order, and the tuple of their k-mers is hashed.
So short texts, too, fill all bins with pairs, which have an order.  Two texts agree in a bin if they select the
same k-mers in the same order, which edits and moves both disturb.

Occurrence numbers and minima come from sorting one array of longs per text
(35 bits of hash above 28 bits of position); no row is exploded, and the work
is n log n in the text's length.

Defined results: null counts as empty; a text of blanks alone has an empty fingerprint,
like (1.0) another empty one and unlike (0.0) any other; the next document is
the one with the next larger doc_id (nulls first; after the last, the first);
of rows that repeat a doc_id the smallest text is taken as next, and each such
row is returned; an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table, text_of

K = 3
#: The longest run that is one token, and the width of the tokens of longer runs.
RUN, GRAM = 16, 8
#: Group 1 is the token.  In a longer run a match goes on by one character.
TOKEN = rf"(?=((?<!\S)\S{{1,{RUN}}}+(?!\S)|\S{{{GRAM}}}))(?:(?<!\S)\S{{1,{RUN}}}+(?!\S)|\S)"
BINS_LOG2 = 6
PICK = 2
POS = 28
HASH = 35


def signature(text: Column, df: DataFrame, name: str) -> DataFrame:
    """Adds column ``name``: array<int> of (bin << 16 | 16-bit tuple hash), by bin."""
    t = f"_{name}_"
    bin_of = lambda x: f"shiftright({x}, {POS + HASH - BINS_LOG2})"
    kmer_of = lambda x: f"shiftright({x}, {POS})"
    pos_of = lambda x: f"({x} & {(1 << POS) - 1})"
    pack = lambda h, pos: f"(shiftleft(shiftrightunsigned({h}, {64 - HASH}), {POS}) | {pos})"
    parts = ", ".join(f"{t}w[i + {k}]" for k in range(K))
    steps = [
        (f"{t}w", None),
        # every k-mer's hash with its position, sorted: equal k-mers stand together, in text order
        (f"{t}s", f"sort_array(case when size({t}w) = 0 then cast(array() as array<bigint>) "
                  f"when size({t}w) < {K} then array({pack(f'xxhash64(array_join({t}w, chr(32)))', '0L')}) "
                  f"else transform(sequence(0, size({t}w) - {K}), i -> {pack(f'xxhash64({parts})', 'i')}) end)"),
        # first occurrences keep their hash
        (f"{t}f", f"filter({t}s, (x, i) -> i = 0 or {kmer_of('x')} <> {kmer_of(f'{t}s[i - 1]')})"),
        # runs of repeats; the o-th repeat of a k-mer gets the hash of (k-mer, o)
        (f"{t}b", f"if(size({t}f) = size({t}s), cast(array() as array<int>), filter(sequence(0, size({t}s) - 1), "
                  f"i -> i = 0 or {kmer_of(f'{t}s[i]')} <> {kmer_of(f'{t}s[i - 1]')}))"),
        (f"{t}r", f"flatten(transform({t}b, (b, j) -> transform(slice({t}s, b + 2, "
                  f"if(j + 1 < size({t}b), {t}b[least(j + 1, size({t}b) - 1)], size({t}s)) - b - 1), "
                  f"(x, o) -> {pack(f'xxhash64({kmer_of("x")}, o)', pos_of('x'))})))"),
        (f"{t}a", f"if(size({t}r) = 0, {t}s, sort_array(concat({t}f, {t}r)))"),
        # the least PICK of each bin
        (f"{t}m", f"filter({t}a, (x, i) -> i < {PICK} or {bin_of('x')} <> {bin_of(f'{t}a[i - {PICK}]')})"),
        # an element that opens its bin, and the one after it in the circle, are the pair of that bin and of the empty ones before it
        (f"{t}n", f"concat(slice({t}m, 2, size({t}m)), slice({t}m, 1, 1))"),
        (f"{t}t", f"transform({t}m, (x, i) -> if({pos_of('x')} = {pos_of(f'{t}n[i]')}, xxhash64({kmer_of('x')}), "
                  f"if({pos_of('x')} < {pos_of(f'{t}n[i]')}, xxhash64({kmer_of('x')}, {kmer_of(f'{t}n[i]')}), "
                  f"xxhash64({kmer_of(f'{t}n[i]')}, {kmer_of('x')}))) & 65535)"),
        (f"{t}o", f"filter(transform({t}m, (x, i) -> if(i = 0 or {bin_of('x')} <> {bin_of(f'{t}m[greatest(i - 1, 0)]')}, i, null)), i -> i is not null)"),
        (name, f"if(size({t}m) = 0, cast(array() as array<int>), flatten(concat("
               f"transform({t}o, (i, j) -> transform(sequence(if(j = 0, 0L, {bin_of(f'{t}m[{t}o[greatest(j - 1, 0)]]')} + 1), {bin_of(f'{t}m[i]')}), "
               f"b -> cast(shiftleft(b, 16) | {t}t[i] as int))), "
               f"array(transform(filter(sequence(0L, {(1 << BINS_LOG2) - 1}L), b -> b > {bin_of(f'{t}m[size({t}m) - 1]')}), "
               f"b -> cast(shiftleft(b, 16) | {t}t[0] as int))))))"),
    ]
    assert PICK == 2, "the tuple step is written for pairs"
    keep = df.columns
    df = df.withColumn(steps[0][0], F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1)))
    for col, sql in steps[1:]:
        df = df.withColumn(col, F.expr(sql))
    return df.select(*keep, name)


def rendered(sig: Column) -> Column:
    """Hex text: six digits (bin, hash) for each bin; none for a text without tokens."""
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing bins among those that are not empty in both."""
    bins = lambda s: F.transform(s, lambda x: F.shiftright(x, 16))
    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def successors(ids: DataFrame, parts: int) -> DataFrame:
    """``ids(doc_id, n_chars)``, one row per distinct id -> ``(doc_id, next_id)``.

    Ids are range-partitioned; each range looks one row ahead, and the last of
    a range takes the first of the next one from a table of ``parts`` rows.
    """
    ranged = stored(ids.select("doc_id").repartitionByRange(parts, F.asc_nulls_first("doc_id"))
                    .withColumn("part", F.spark_partition_id()), "id-ranges")
    inside = Window.partitionBy("part").orderBy(F.asc_nulls_first("doc_id"))
    # null may be an id, so a row's place is told by a marker, not by its value
    ahead = ranged.withColumn("ahead", F.lead(F.struct("doc_id")).over(inside))
    firsts = ranged.groupBy("part").agg(F.min_by(F.struct("doc_id"), F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first"))
    order = Window.orderBy("part")  # over at most ``parts`` rows
    opening = F.first("first").over(order)
    following = firsts.select("part", F.coalesce(F.lead("first").over(order), opening).alias("following"))
    return (ahead.join(F.broadcast(following), "part")
            .select("doc_id", F.coalesce("ahead", "following")["doc_id"].alias("next_id")))


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with the contract's columns.

    Texts are shuffled once by id; both joins read that exchange.  To the
    document before it, a document gives its signature and only as much of its
    beginning as the edit needs.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    id_of = F.when(F.col("key") != "", F.expr("substring(key, 2)").cast(kind))
    rows = docs.select("doc_id", text_of().alias("text"))
    lengths = stored(rows.groupBy("doc_id").agg(F.max(F.length("text")).alias("n_longest"), F.count(F.lit(1)).alias("n")), "id-lengths")
    chain = stored(successors(lengths, parts).join(lengths.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")))
                   .select(key("doc_id").alias("before"), key("next_id").alias("next_key"),
                           F.floor(F.col("n_longest") / 2).cast("int").alias("need")), "id-chain")
    # both joins ask for the same three columns, so that one exchange serves them
    signed = signature(F.col("text"), rows, "sig").select(key("doc_id").alias("key"), "text", "sig").repartition("key")
    following = signed
    if lengths.where("n > 1").limit(1).count():  # repeated ids: the smallest text stands for the id
        following = following.groupBy("key").agg(F.min(F.struct("text", "sig")).alias("g")).select("key", "g.text", "g.sig")
    given = (following.join(chain, following["key"] == chain["next_key"])
             .select("before", F.expr("left(text, need)").alias("lent"), F.col("sig").alias("next_sig")))
    half = "cast(floor(length(text) / 2) as int)"
    both = (signed.join(given, signed["key"] == given["before"])
            .select(id_of.alias("doc_id"), F.length("text").cast("long").alias("n_chars"), "sig", "next_sig",
                    F.expr(f"concat(left(text, length(text) - {half}), left(lent, {half}))").alias("edited")))
    done = signature(F.col("edited"), both, "edited_sig")
    return done.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        rendered(F.col("sig")).alias("fingerprint"), rendered(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))


def op7_order_minhash(spark, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(table(spark, sf_dir, "documents"))
