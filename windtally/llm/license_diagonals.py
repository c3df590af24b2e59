"""License scans by diagonal voting.

The 64-bit hash of every rolling word gram of the documents is joined with its positions in the
license templates; a match votes for the diagonal (document position minus
template position).  Votes are counted per diagonal, neighbouring diagonals
(insertions, deletions) are merged, and the merged span is verified by the
share of the template it covers.  A chain that spans two templates or more (a
text that repeats parts of one) is taken apart into stretches of one template's length,
twice, the second time half a length further on, and those that are verified stay.  A phrase whose grams all vote on one
diagonal stands there word for word.  A place matches by chance one of the
some 900 template hashes at odds of 900 / 2**64, that is 1e-3 false votes in
2e13 words.

Defined results: null and empty texts have no words and no places; repeated
rows are returned each; null doc_ids keep their row; an empty table gives no
rows.  Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import same_document, small_side, stored, table
from .phrases import gram_sizes, hash_of_gram, hashed_occurrences

# The contract's phrases and labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Paragraphs of public licenses, and the notices that go with the longer ones.
PASSAGES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", "apache"),
    ("subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details", "gpl"),
    ("you should have received a copy of the gnu general public license along with this program", "gpl"),
    ("the gnu general public license is a free copyleft license for software and other kinds of works", "gpl"),
    ("everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "bsd"),
    ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "bsd"),
    ("this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("if a copy of the mpl was not distributed with this file you can obtain one at", "mpl"),
    ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", "unlicense"),
    ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions", "zlib"),
]
GRAM = 3
#: Diagonals this near belong together.
DRIFT = 3
#: Least share of a passage's grams that a span must cover.
COVER = 0.5
MAX_BROADCAST_GRAMS = 1_000_000


def templates(spark: SparkSession, phrases=PHRASES, passages=PASSAGES, gram: int = GRAM) -> DataFrame:
    """``(template, label, exact, n_words, n_grams, t_pos, gram)`` of all templates."""
    rows = []
    for t, (text, label, exact) in enumerate([(*p, True) for p in phrases] + [(*p, False) for p in passages]):
        w = text.split()
        k = min(gram, len(w))
        rows += [(t, label, exact, len(w), len(w) - k + 1, i, " ".join(w[i:i + k])) for i in range(len(w) - k + 1)]
    return spark.createDataFrame(rows, "template int, label string, exact boolean, n_template int, n_grams int, t_pos int, gram string")


def scan(docs: DataFrame, grams: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Document rows ``(doc_id, text_key, n_words)``; exact phrase places
    ``(doc_id, text_key, template, label, start)``; verified passage spans
    ``(..., template, label, start, end, coverage)``."""
    sizes = gram_sizes(grams)
    wanted = stored(grams.withColumn("gram", hash_of_gram("gram", sizes)), "license-grams")
    found = stored(hashed_occurrences(docs, wanted.select("gram").distinct(), sizes), "license-votes")
    base = found.where("pos < 0").select("doc_id", "text_key", "n_words")
    votes = (found.where("pos >= 0").join(small_side(wanted, MAX_BROADCAST_GRAMS), "gram")
             .withColumn("diagonal", F.col("pos") - F.col("t_pos")))
    spot = ["doc_id", "text_key", "template", "label", "exact", "n_template", "n_grams"]
    diagonals = stored(votes.groupBy(*spot, "diagonal").agg(
        F.collect_set("t_pos").alias("hits"), F.min("pos").alias("low"), F.max("pos").alias("high")), "diagonals")
    exact = (diagonals.where("exact and size(hits) = n_grams")
             .select("doc_id", "text_key", "template", "label", F.col("diagonal").alias("start")))
    # a lone vote is noise in a long passage; the others are chained while they drift little
    strong = diagonals.where("not exact and size(hits) >= least(2, n_grams)")
    along = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    chained = (strong.withColumn("step", (F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along), F.lit(DRIFT + 1)) > DRIFT).cast("int"))
               .withColumn("chain", F.sum("step").over(along)))
    low_of = Window.partitionBy("doc_id", "text_key", "template", "chain")
    placed = (chained.withColumn("first", F.min("diagonal").over(low_of))
              .withColumn("long", F.max("high").over(low_of) - F.min("low").over(low_of) >= 2 * F.col("n_template"))
              .withColumn("at", F.expr("if(long, array(0, 1), array(0))")).withColumn("tiling", F.explode("at"))
              .withColumn("stretch", F.expr("if(long, cast((diagonal - first + tiling * cast(n_template / 2 as int)) div n_template as int), 0)")))
    spans = (placed.groupBy(*spot, "chain", "tiling", "stretch")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("covered"),
                  F.min("low").alias("start"), F.max("high").alias("last"))
             .withColumn("coverage", F.col("covered") / F.col("n_grams")).where(F.col("coverage") >= COVER))
    # of a long chain's two tilings, the one with more verified stretches
    spans = (spans.groupBy(*spot, "chain", "tiling").agg(F.collect_list(F.struct("start", "last", "coverage")).alias("found"))
             .groupBy(*spot, "chain").agg(F.max_by("found", F.struct(F.size("found"), -F.col("tiling"))).alias("found"))
             .select("doc_id", "text_key", "template", "label", F.explode("found").alias("s"))
             .select("doc_id", "text_key", "template", "label", "s.start", (F.col("s.last") + GRAM).alias("end"), "s.coverage"))
    return base, exact, spans


def license_report(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with the contract's columns and ``n_spans``."""
    base, exact, spans = scan(docs, grams)
    phrase = exact.groupBy("doc_id", "text_key").agg(
        F.count(F.lit(1)).alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        F.collect_set("label").alias("own"))
    passage = spans.groupBy("doc_id", "text_key").agg(
        F.count(F.lit(1)).alias("n_spans"), F.max("coverage").alias("best"), F.collect_set("label").alias("more"))
    none = F.array().cast("array<string>")
    out = same_document(same_document(base, phrase, "left"), passage, "left")
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.coalesce("own", none)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(F.coalesce("own", none), F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"))


def op6_license_diagonals(spark, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"), templates(spark))
