"""URL filters: explicit host and path rules, then a tree of path templates judged by labelled purity.

DataFrame functions only. The tree: a page's path is cut into segments; digits within a segment are generalised, and a
segment that takes many values below one node of a host becomes a wildcard. The explicit rules label pages. Sibling
branches whose labelled shares don't differ are merged; a merged branch's purity is its share of blocked pages, smoothed
by that of its templates on other hosts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VALUES = 12  # a node with more different children than this, and with few pages for each, is generalised
PAGES_PER_VALUE = 8
ALIKE = 1.96  # standard errors within which two shares are alike, so that sibling branches are merged
WEIGHT = 5.0  # labelled pages that the prior counts for
PURE = 0.9  # templates of at least this smoothed share of blocked pages are rejected


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query's contract.
RULES = (UrlRule("block", "net", "/"), UrlRule("allow", "example.net", "/en/"), UrlRule("block", "example.com", "/de/"), UrlRule("allow", "org", "/fr/"))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host in lower case; both empty without '://'. Neither user, port nor escapes are taken apart."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judged(pages: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    """page_id, host, path, rule: the longest rule that fits, or null."""
    host, path = split_url(F.col("url"))
    out = pages.select("page_id", host.alias("host"), path.alias("path"))
    fits = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fit = ((F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")) & F.col("path").startswith(r.path)
        fits = F.when(fit, F.lit(r.name)).otherwise(fits)
    return out.withColumn("rule", fits)


def _segments(path: Column) -> Column:
    """All segments with digits generalised, without slashes at either end; [''] for an empty path."""
    return F.split(F.regexp_replace(F.trim(path, F.lit("/")), "[0-9]+", "0"), "/")


def templates(paths: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, segs, nodes): each distinct row of segments and the nodes that the tree of its host gives it.

    paths: (host, segs, n, blocked, labelled), a row for each distinct (host, segs). From the root downwards, a node with
    over VALUES different children and under PAGES_PER_VALUE pages for each has one wildcard child; a page that ends at
    the node is no child. It goes on to the ends of the paths; below a node with VALUES paths or fewer no wildcard can
    follow, so these keep the rest of their segments and leave the rounds. Counts are combined before the shuffle; a busy
    host is one short row per node.
    """
    live, done, d = paths.select("host", "segs", "n", F.array().cast("array<string>").alias("nodes")), [], 0
    while True:
        seg = F.col("segs")[d]
        kids = live.groupBy("host", "nodes", seg.alias("seg")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("paths"))
        nodes = kids.groupBy("host", "nodes").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("pages"), F.sum("paths").alias("paths"))
        wild = (F.col("values") > VALUES) & (F.col("pages") < PAGES_PER_VALUE * F.col("values"))
        nodes = nodes.select("host", "nodes", wild.alias("wild"), (F.col("paths") <= VALUES).alias("plain"))
        rest = F.slice("segs", F.lit(d + 1), F.size("segs"))
        below = F.when(F.col("plain"), rest).otherwise(F.array(F.when(F.col("wild"), F.lit("*")).otherwise(seg)))
        more = ~F.col("plain") & (F.size("segs") > d + 1)
        step = scratch.keep(live.join(nodes, ["host", "nodes"]).select("host", "segs", "n", F.concat("nodes", below).alias("nodes"), more.alias("more")), "level")
        done.append(step.where("NOT more").select("host", "segs", "nodes"))
        live, d = step.where("more").drop("more"), d + 1
        if live.isEmpty():
            return reduce(DataFrame.unionAll, done)


def _differ(b: Column, n: Column, b2: Column, n2: Column) -> Column:
    """Whether b of n and b2 of n2 are different shares; nothing differs from no labels."""
    one, two = F.greatest(n, F.lit(1.0)), F.greatest(n2, F.lit(1.0))
    p, gap = (b + b2) / F.greatest(n + n2, F.lit(1.0)), b / one - b2 / two
    return (n > 0) & (n2 > 0) & (gap * gap > ALIKE * ALIKE * p * (1 - p) * (1 / one + 1 / two))


def merged(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, nodes, grp): the group of merged branches that each template of a host belongs to.

    leaves: (host, nodes, b, l, ob, ol), a row for each template with its blocked and labelled pages on its host and on
    others, one of them labelled at least. A branch is tested by the labels of its host, or by those of the others if it
    has none. From the deepest level upwards: if no branch below a parent differs from the rest of its siblings, all are
    merged and stand for the parent one level up. Otherwise they are taken by falling share, and a branch that differs
    from the sum of those before it begins another group; such a parent is mixed, and it isn't merged with its own
    siblings. Siblings of equal counts are one row before a parent's are listed, so N labelled pages give it some N^(2/3)
    entries at most, whatever the number of siblings.
    """
    d = leaves.agg(F.max(F.size("nodes"))).first()[0] or 0
    # A last node "/", which no segment can be, parts a page that ends at a node from the branches below that node.
    rows = leaves.withColumn("at", F.concat("nodes", F.array(F.lit("/")))).withColumn("grp", F.lit(None).cast("array<string>"))
    for k in range(d + 1, 0, -1):
        sums = [F.sum(c).cast("double").alias(c) for c in ("b", "l", "ob", "ol")]
        nodes = rows.where(F.size("at") == k).groupBy("host", "at").agg(*sums, F.max(F.col("grp").isNotNull()).alias("mixed"))
        own = F.col("l") > 0
        nodes = nodes.select("host", "at", F.slice("at", 1, k - 1).alias("up"), "mixed", F.when(own, F.col("b")).otherwise(F.col("ob")).alias("b"), F.when(own, F.col("l")).otherwise(F.col("ol")).alias("l"))
        key = F.struct((-F.col("b") / F.col("l")).alias("share"), (-F.col("l")).alias("size"))
        few = nodes.groupBy("host", "up", "mixed", "b", "l").agg(F.count(F.lit(1)).cast("double").alias("n"))
        entry = F.when(~F.col("mixed"), F.struct(key.alias("key"), "b", "l", "n"))
        lists = few.groupBy("host", "up").agg(F.sort_array(F.collect_list(entry)).alias("kids"), F.max("mixed").alias("mixed"))
        total = lambda c: F.aggregate("kids", F.lit(0.0), lambda s, x: s + x[c] * x["n"]).alias(f"all_{c}")
        lists = lists.select("host", "up", "kids", "mixed", total("b"), total("l"))
        odd = F.exists("kids", lambda x: _differ(x["b"], x["l"], F.col("all_b") - x["b"], F.col("all_l") - x["l"]))
        none = F.slice(F.transform("kids", lambda x: x["key"]), 1, 0)

        def add(s, x):
            new = _differ(x["b"], x["l"], s["b"], s["l"])
            put = [(F.when(new, 0.0).otherwise(s[c]) + x[c] * x["n"]).alias(c) for c in ("b", "l")]
            return F.struct(*put, F.when(new, F.concat(s["cuts"], F.array(x["key"]))).otherwise(s["cuts"]).alias("cuts"))

        start = F.struct(F.lit(0.0).alias("b"), F.lit(0.0).alias("l"), none.alias("cuts"))
        cuts = F.when(odd, F.aggregate("kids", start, add)["cuts"]).otherwise(none)
        lists = lists.select("host", "up", cuts.alias("cuts"), F.col("mixed").alias("stuck"))
        group = F.size(F.filter("cuts", lambda c: c <= key)).cast("string")
        part = F.when(F.col("stuck") | (F.size("cuts") > 0), F.concat("up", F.array(F.concat(F.lit("/"), group))))
        placed = nodes.join(lists, ["host", "up"]).select("host", "at", "up", part.alias("part"))
        out = rows.join(placed, ["host", "at"], "left")
        rows = scratch.keep(out.select("host", "nodes", "b", "l", "ob", "ol", F.coalesce("up", "at").alias("at"), F.coalesce("grp", "part").alias("grp")), "merged")
    return rows.select("host", "nodes", "b", "l", "ob", "ol", F.coalesce("grp", F.array().cast("array<string>")).alias("grp"))


def filtered(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of each row of pages.

    A null url, or one without '://', has an empty host and path and is judged by the template of such pages. Pages
    under a rule take its verdict; the others are blocked if the purity of the merged branch that their template belongs
    to reaches PURE. A template without a labelled page on any host isn't merged; its purity is a half, so nothing is
    blocked. Ties between rules of one length can't fit one url but by equal
    names. Repeated rows and null ids are judged like any other row.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    verdicts = {r.name: r.verdict for r in rules}
    given = reduce(lambda c, x: F.when(F.col("rule") == x[0], F.lit(x[1])).otherwise(c), verdicts.items(), F.lit(None).cast("string"))
    rows = judged(pages, rules).withColumn("given", given).withColumn("segs", _segments(F.col("path")))
    blocked = F.sum(F.when(F.col("given") == "block", 1).otherwise(0)).alias("blocked")
    paths = scratch.keep(rows.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), blocked, F.count("given").alias("labelled")), "paths")
    named = scratch.keep(templates(paths, scratch), "templates")
    branch = paths.join(named, ["host", "segs"]).groupBy("host", "nodes").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
    pooled = branch.groupBy("nodes").agg(F.sum("b").alias("all_b"), F.sum("l").alias("all_l")).where("all_l > 0")
    leaves = scratch.keep(branch.join(pooled, "nodes").select("host", "nodes", "b", "l", (F.col("all_b") - F.col("b")).alias("ob"), (F.col("all_l") - F.col("l")).alias("ol")), "leaves")
    parts = merged(leaves, scratch)
    prior = (F.sum("ob") + 0.5 * WEIGHT) / (F.sum("ol") + WEIGHT)
    worth = parts.groupBy("host", "grp").agg(((F.sum("b") + WEIGHT * prior) / (F.sum("l") + WEIGHT)).alias("purity"))
    worth = parts.select("host", "nodes", "grp").join(worth, ["host", "grp"]).select("host", "nodes", "purity")
    template = F.concat(F.lit("/"), F.array_join("nodes", "/")).alias("template")
    known = named.join(worth, ["host", "nodes"], "left").select(F.col("host").alias("h"), F.col("segs").alias("s"), template, F.coalesce("purity", F.lit(0.5)).alias("purity"))
    out = rows.join(known, (F.col("host") == F.col("h")) & (F.col("segs") == F.col("s")), "left")
    learned = F.when(F.col("purity") >= PURE, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("given", learned).alias("verdict"), "template", "purity")


def op9_template_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(table(spark, sf_dir, "pages")).drop("template", "purity")
