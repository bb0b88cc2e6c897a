"""URL filters: explicit rules, and for all other pages a tree of path templates judged by labelled purity.

Variable segments (numbers, hexadecimal names, dates) become wildcards first, which folds all pages of a host into a
few rows per path shape. The tree is then built over those rows, a level at a time down to the last segment: under each
parent a segment stays a branch of its own if its labels differ from those of its siblings by a two-proportion test, the
worse ones first; all others merge into ``*``. Where the labels of a parent cannot tell any two branches apart, all that
is below it is ``*`` at once. A template is rejected if the labelled share of bad pages, smoothed towards the host's share
and that towards the share of all pages, reaches ``REJECT``. Counts are combined map-side, so that a host with a third
of all pages is a handful of rows in every later step.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged with its like;
a null or repeated label counts as often as it stands there, null as unlabelled; repeated rows are judged alike; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import written

#: A branch needs so many labelled pages, and its siblings as many, to stand alone.
LEAST_LABELLED = 20
#: Standard errors between the bad shares of a branch and its siblings from which they count as different.
DIFFERENT = 3.0
#: Labelled pages that the smoothing counts as.
SMOOTHING = 20.0
#: Smoothed share of bad pages from which a template is rejected.
REJECT = 0.5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def address(url: Column) -> tuple[Column, Column]:
    """Host and path of a url as text; nothing is decoded."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of ``rules`` (verdict, ``host/path``) that fits, and its verdict; the list is a configuration."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, _, start = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def shape(path: Column) -> Column:
    """Segments of a path with variable ones as wildcards."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    kinds = (
        (r"^\d{4}-\d\d-\d\d$", "<date>"),
        (r"^[0-9a-f]{8}-[0-9a-f-]{27}$|^[0-9a-f]{16,}$", "<hex>"),
        (r"\d+", "<n>"),
    )

    def general(segment: Column) -> Column:
        for pattern, name in kinds:
            segment = F.regexp_replace(segment, pattern, name)
        return segment

    return F.transform(segments, general)


_SUMS = ("n", "labelled", "bad")


def _summed(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in _SUMS))


def _beyond(labelled: Column, bad: Column, rest: Column, rest_bad: Column) -> Column:
    """By how many standard errors a share of bad pages is above that of the rest; null without evidence."""
    share = F.try_divide
    pooled = share(bad + rest_bad, labelled + rest)
    error = F.sqrt(pooled * (1 - pooled) * (share(F.lit(1), labelled) + share(F.lit(1), rest)))
    known = (labelled >= LEAST_LABELLED) & (rest >= LEAST_LABELLED) & (error > 0)
    return F.when(known, share(share(bad, labelled) - share(rest_bad, rest), error))


def _level(tree: DataFrame, depth: int) -> DataFrame:
    """One more segment of the templates; an ended path has the segment ``''``.

    Branches worse than their siblings are set apart first, so that the others are compared among themselves.
    """
    tree = tree.withColumn("segment", F.coalesce(F.try_element_at("shape", F.lit(depth + 1)), F.lit("")))
    branch = _summed(tree, "host", "template", "segment")
    parent = ["host", "template"]
    for test in ("worse", "better"):
        left = F.lit(True) if test == "worse" else ~F.col("worse")
        sums = [F.sum(F.when(left, F.col(c))).alias(f"all_{c}") for c in _SUMS]
        branch = branch.join(branch.groupBy(*parent).agg(*sums), parent)
        rest, rest_bad = F.col("all_labelled") - F.col("labelled"), F.col("all_bad") - F.col("bad")
        beyond = _beyond(F.col("labelled"), F.col("bad"), rest, rest_bad)
        apart = left & ((beyond if test == "worse" else -beyond) > DIFFERENT)
        branch = branch.withColumn(test, F.coalesce(apart, F.lit(False))).drop(*(f"all_{c}" for c in _SUMS))
    alone = F.col("worse") | F.col("better")
    ended = F.col("segment") == ""
    name = F.when(ended, F.lit("")).otherwise(F.concat(F.lit("/"), F.when(alone, F.col("segment")).otherwise(F.lit("*"))))
    named = branch.select(*parent, "segment", name.alias("name"))
    grown = tree.join(named, [*parent, "segment"])
    return grown.withColumn("template", F.concat("template", "name")).drop("segment", "name")


def _open(tree: DataFrame, depth: int) -> DataFrame:
    """The templates with paths below ``depth`` whose labels could still set branches apart."""
    sums = tree.groupBy("host", "template").agg(
        F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"), F.max(F.size("shape")).alias("deepest")
    )
    enough = (F.col("labelled") >= 2 * LEAST_LABELLED) & (F.col("bad") > 0) & (F.col("bad") < F.col("labelled"))
    return sums.filter(enough & (F.col("deepest") > depth)).select("host", "template")


def templates(shapes: DataFrame) -> DataFrame:
    """``host``, ``shape``, ``template``, ``purity`` from counts per host and shape (``n``, ``labelled``, ``bad``)."""
    tree, done = written(shapes.withColumn("template", F.lit("")), "tree"), []
    for depth in count():
        parents = written(_open(tree, depth), "parents")
        below = F.repeat(F.lit("/*"), F.greatest(F.size("shape") - depth, F.lit(0)))
        ended = tree.join(parents, ["host", "template"], "left_anti")
        done.append(ended.select("host", "shape", F.concat("template", below).alias("template"), *_SUMS))
        if parents.isEmpty():
            break
        tree = written(_level(tree.join(parents, ["host", "template"], "left_semi"), depth), "tree")
    tree = written(reduce(DataFrame.union, done), "templates")
    by_template = _summed(tree, "host", "template")
    by_host = _summed(tree, "host").select("host", F.col("labelled").alias("h_labelled"), F.col("bad").alias("h_bad"))
    total = tree.agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).first()
    share = (total["bad"] or 0) / max(total["labelled"] or 0, 1)
    of_host = (F.col("h_bad") + SMOOTHING * share) / (F.col("h_labelled") + SMOOTHING)
    purity = (F.col("bad") + SMOOTHING * of_host) / (F.col("labelled") + SMOOTHING)
    judged = by_template.join(by_host, "host").select("host", "template", purity.alias("purity"))
    return tree.select("host", "shape", "template").join(judged, ["host", "template"])


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Host, path, rule and verdict of every page, and the template and smoothed bad share that judge the others.

    ``labels`` has ``page_id`` and ``bad`` (0 or 1) of some pages.
    """
    host, path = address(F.col("url"))
    parsed = pages.select(F.col("page_id").cast("long"), "url").select("page_id", host.alias("host"), path.alias("path"))
    shaped = parsed.withColumn("shape", shape(F.col("path")))
    marks = labels.filter(F.col("bad").isNotNull()).groupBy(F.col("page_id").alias("of")).agg(
        F.count("*").alias("labelled"), F.sum(F.col("bad").cast("long")).alias("bad")
    )
    marked = shaped.join(marks, F.col("page_id") == F.col("of"), "left")
    counts = marked.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("labelled"), F.lit(0)).alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    judged = templates(counts)
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return (
        shaped.join(judged, ["host", "shape"], "left")
        .withColumns({"rule": rule, "verdict": F.coalesce(says, by_method)})
        .select("page_id", "host", "path", "rule", "verdict", F.concat("host", "template").alias("template"), "purity")
    )
