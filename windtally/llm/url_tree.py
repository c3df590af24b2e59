"""URL filter by a tree of path templates.

Per host, path segments become templates: numbers and hex strings turn into
wildcards by their form, other segments by statistics, level by level:

* a node with many rare children is a variable: its rare children become ``*``;
* children whose labelled share of good pages does not differ from that of
  their siblings (a two-sided z test at ``Z``) are merged into ``*``; so are
  children without labels if two of their siblings have some.

A template is rejected if its labelled purity, smoothed towards the overall
share with ``PRIOR`` pseudo-pages, is below ``PURITY``.  Explicit rules
(host, path) come first, the longest one wins.

Pages are read twice: once to count distinct (host, form path) pairs, all
levels work on those counts, and once to attach the verdicts.  Paths of any
depth are followed to their end; a level works on the forms that go deeper
than it, and forms of a node that branches no more are finished at once, so
that a deep path does not take as many levels as it has segments.

Defined results: a null url or one without ``://`` has empty host and path and
is blocked unless a rule says otherwise; labels with nulls count as unlabelled;
repeated rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, stored, table

# The contract's rules (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
MAX_RULES = 1000
#: A literal child of fewer pages is rare; a node with at least so many rare children is a variable.
RARE, MANY = 5, 8
Z = 2.58
PRIOR = 10.0
PURITY = 0.5
#: Finished levels that are read side by side; more are stored as one.
MAX_PARTS = 16


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; this form takes at most {MAX_RULES}")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def form_path(path: Column) -> Column:
    """Segments of a path, with numbers and hex strings as wildcards."""
    segments = F.array_remove(F.split(path, "/"), "")
    return F.transform(segments, lambda s: F.when(s.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{16,}$"), F.lit("<hex>"))
                       .otherwise(F.regexp_replace(s, r"[0-9]+", "<n>")))


def template_tree(counts: DataFrame) -> DataFrame:
    """``counts(host, form, n, good, bad)`` -> ``(host, form, template)``."""
    at = counts.withColumn("template", F.lit("")).withColumn("straight", F.lit(False))
    kept = ["host", "form", "n", "good", "bad", "template"]
    done, d = [], 0
    while True:
        done.append(at.where(F.size("form") <= d).select(*kept))
        if len(done) > MAX_PARTS:
            done = [stored(reduce(DataFrame.unionByName, done), "url-done")]
        deep = at.where(F.size("form") > d).withColumn("child", F.get("form", F.lit(d)))
        if not deep.limit(1).count():
            return reduce(DataFrame.unionByName, done)
        child = deep.groupBy("host", "template", "child").agg(
            *(F.sum(c).alias(c) for c in ("n", "good", "bad")), F.max("form").alias("greatest"), F.min("straight").alias("straight"))
        rare = (F.col("n") < RARE) & ~F.col("child").contains("<")
        node = child.groupBy("host", "template").agg(
            F.sum(rare.cast("int")).alias("rare"), F.count(F.lit(1)).alias("kids"), F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"),
            F.sum((F.col("good") + F.col("bad") > 0).cast("int")).alias("labelled"),
            F.min("straight").alias("single"))
        judged = child.drop("straight").join(node, ["host", "template"])
        seen = F.col("good") + F.col("bad")
        share = (F.col("all_good") + 1) / (F.col("all_good") + F.col("all_bad") + 2)
        z = F.abs(F.col("good") - seen * share) / F.sqrt(seen * share * (1 - share) + 1e-9)
        variable = rare & (F.col("rare") >= MANY)
        similar = (F.col("kids") > 1) & (z < Z) & ((seen > 0) | (F.col("labelled") > 1))
        named = judged.select(
            F.col("host").alias("_h"), F.col("template").alias("_t"), F.col("child").alias("_c"), "greatest", "single",
            F.when(variable | similar, F.lit("*")).otherwise(F.col("child")).alias("step"))
        step = F.concat("template", F.lit("/"), "step")
        rest = F.concat_ws("/", "template", F.expr(f"slice(form, {d + 1}, size(form))"))
        # a node whose forms are all beginnings of one of them has no branches: its forms are templates to their end
        begins = (F.col("step") == F.col("child")) & (F.col("form") == F.expr("slice(greatest, 1, size(form))"))
        at = stored(deep.join(named, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")) & (F.col("child") == F.col("_c")))
                    .select("host", "form", "n", "good", "bad", "single",
                            F.when(F.col("single"), rest).otherwise(step).alias("template"), begins.alias("straight")), "url-level")
        done.append(at.where("single").select(*kept))
        at = at.where("not single").drop("single")
        d += 1


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)``, one row per
    row of ``pages(page_id, url)``; ``labels(page_id, good)`` are labelled pages."""
    urls = pages.select("page_id", F.col("url").cast("string").alias("url"))
    parsed = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn("form", form_path(F.col("path")))
    known = labels.where("page_id is not null and good is not null").groupBy("page_id").agg(F.min(F.col("good").cast("int")).alias("good"))
    known = known.withColumnRenamed("page_id", "_labelled")
    counts = (parsed.join(known, parsed["page_id"] == known["_labelled"], "left").groupBy("host", "form")
              .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                   F.coalesce(F.sum(1 - F.col("good")), F.lit(0)).alias("bad")))
    tree = stored(template_tree(stored(counts, "url-counts")), "url-tree")
    overall = tree.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).first()
    base = ((overall["g"] or 0) + 1) / ((overall["g"] or 0) + (overall["b"] or 0) + 2)
    purity = tree.groupBy("host", "template").agg(((F.sum("good") + PRIOR * base) / (F.sum("good") + F.sum("bad") + PRIOR)).alias("purity"))
    verdicts = tree.join(purity, ["host", "template"]).select(
        F.col("host").alias("_h"), F.col("form").alias("_f"), "template", "purity",
        F.when((F.col("host") == "") | (F.col("purity") < PURITY), F.lit("block")).otherwise(F.lit("allow")).alias("method"))
    judged = parsed.join(verdicts, (parsed["host"] == F.col("_h")) & (parsed["form"] == F.col("_f")), "left")
    rule = matched_rule(F.col("host"), F.col("path"), rules)
    return judged.select("page_id", "host", "path", rule["rule"].alias("rule"),
                         F.coalesce(rule["verdict"], F.col("method")).alias("verdict"), "template", "purity")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages whose url ends in a document's number take that document's label:
    good if of quality and not toxic (of several labels the worst counts)."""
    number = F.regexp_extract(path_of(F.col("url").cast("string")), r"/(\d{1,18})(?:\.html)?/?$", 1)
    numbered = pages.select("page_id", number.alias("number")).where("number <> ''")
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    known = known.groupBy("doc_id").agg(F.min("good").alias("good"))  # one label an id, so that the join cannot multiply
    return numbered.withColumn("doc_id", F.col("number").cast("long")).join(known, "doc_id").select("page_id", "good")


def op1_url_tree(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, labelled_pages(pages, table(spark, sf_dir, "labels")))
