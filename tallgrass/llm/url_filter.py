"""URL verdicts by rules, and by a tree of path templates where no rule speaks; DataFrame functions only.

Segments that hold numbers are variable by themselves.  The tree of a host is generalised from the
root down: at each node, children that hold a fair share of its urls stay as they are, and the
others, if there are several, become one wildcard, whose subtrees are put together before the
next level is looked at.  Sibling templates whose share of blocked labels does not differ
significantly are merged, and a template is rejected if its smoothed share of blocked labels is
high.  The labels are the urls that the rules decide.  All counts are of different paths of a host, so rows
that repeat a url change no verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallgrass.plans.lineage import cut_lineage

#: Children with less than this share of their node's urls become a wildcard, if they are at least so many.
RARE_SHARE, CHILDREN = 0.05, 8
#: Differences of purity (in standard errors) that keep sibling branches apart.
MERGE_Z = 1.96
#: A template is rejected if (blocked + 1) / (labelled + 2) reaches this.
REJECT_PURITY = 0.9

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (host followed by path) that fits the host or a parent domain, and the path's start."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def shape_of(path: Column) -> Column:
    """The path with runs of digits as ``#``, and segments with several of them as ``*``."""
    return F.regexp_replace(F.regexp_replace(path, "[0-9]+", "#"), "/[^/#]*#[^/#]*#[^/]*", "/*")


def templates(shapes: DataFrame) -> DataFrame:
    """Template of every (host, shape); ``shapes`` has host, shape, n, labelled and blocked, one row each.

    Returns these columns and template.  A step generalises one level; the steps end when no
    node has CHILDREN shapes or more below it, as only such a node can get a wildcard.  A node has
    at most 1 / RARE_SHARE + CHILDREN children in the end.  An empty table gives no rows.
    """
    state = shapes.select(
        "*", F.lit("").alias("node"), F.split("shape", "/").alias("rest"), F.lit(True).alias("open")
    )
    first = True
    while True:
        here = state.withColumn("part", F.when(F.col("open"), F.element_at("rest", 1)))
        # urls by child first, so that a host with most of the urls is summed in every task
        children = cut_lineage(here.where("open").groupBy("host", "node", "part").agg(F.sum("n").alias("n")))
        whole = children.groupBy("host", "node").agg(F.sum("n").alias("whole"))
        rare = children.join(whole, ["host", "node"]).where(F.col("n") < RARE_SHARE * F.col("whole")).select("host", "node", "part")
        many = rare.groupBy("host", "node").agg(F.count(F.lit(1)).alias("rare")).where(F.col("rare") >= CHILDREN).drop("rare")
        wild = rare.join(many, ["host", "node"]).withColumn("wild", F.lit(True))
        part = F.when(F.coalesce("wild", F.lit(False)), F.lit("*")).otherwise(F.col("part"))
        longer = part if first else F.concat("node", F.lit("/"), part)
        moved = here.join(wild, ["host", "node", "part"], "left").select(
            *shapes.columns,
            F.when(F.col("open"), longer).otherwise(F.col("node")).alias("node"),
            F.when(F.col("open"), F.slice("rest", F.lit(2), F.greatest(F.size("rest") - 1, F.lit(0)))).otherwise(F.col("rest")).alias("rest"),
            "open",
        )
        # equal nodes only compare among shapes that are still open and go on
        going = F.col("open") & (F.size("rest") > 0)
        wide = moved.where(going).groupBy("host", "node").agg(F.count(F.lit(1)).alias("below")).where(F.col("below") >= CHILDREN)
        marked = moved.join(wide.select("host", "node", F.lit(True).alias("wide")), ["host", "node"], "left")
        state = cut_lineage(marked.withColumn("open", going & F.coalesce("wide", F.lit(False))).drop("wide"))
        first = False
        if state.where("open").isEmpty():
            break
    whole = F.when(F.size("rest") > 0, F.concat("node", F.lit("/"), F.array_join("rest", "/"))).otherwise(F.col("node"))
    return state.select(*shapes.columns, whole.alias("template"))


def judged_templates(known: DataFrame) -> DataFrame:
    """(host, template, reject) of templates with labels, after merging similar siblings.

    ``known`` has host, template, labelled and blocked.  Siblings are put in order of their purity; two
    next to each other are merged unless they differ significantly, also those with few labels.
    """
    leaf = known.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    leaf = leaf.where("labelled > 0").withColumn("parent", F.regexp_replace("template", "[^/]*$", "")).withColumn(
        "rate", (F.col("blocked") + 1) / (F.col("labelled") + 2)
    )
    # (a node has a bounded number of children, see templates)
    order = Window.partitionBy("host", "parent").orderBy("rate", "template")
    n, m = F.col("labelled"), F.lag("labelled").over(order)
    pooled = (F.col("blocked") + F.lag("blocked").over(order) + 1) / (n + m + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    apart = F.coalesce((F.col("rate") - F.lag("rate").over(order)) > MERGE_Z * error, F.lit(True))
    leaf = leaf.withColumn("apart", apart.cast("int")).withColumn("branch", F.sum("apart").over(order))
    whole = leaf.groupBy("host", "parent", "branch").agg(F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))
    return leaf.join(whole, ["host", "parent", "branch"]).select(
        "host", "template", ((F.col("all_blocked") + 1) / (F.col("all_labelled") + 2) >= REJECT_PURITY).alias("reject")
    )


def judge_urls(pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict (allow or block) of every row.

    ``rules`` maps host and path, like ``example.net/en/``, to allow or block; it is a short list
    that stays in the plan.  A null url, or one without ``://``, has an empty host and path, fits
    no rule and is judged with all others of that kind: without labels a template is allowed.
    Repeated rows and null ids stay; other columns are not read; an empty table gives no rows.
    """
    if any(v not in ("allow", "block") or "/" not in r for r, v in rules.items()):
        raise ValueError("rules map host/path to allow or block")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    said = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    rows = rows.withColumn("said", said).withColumn("shape", shape_of(F.col("path")))
    urls = rows.select("host", "path", "shape", "said").distinct()
    counts = urls.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("said").alias("labelled"), F.count_if(F.col("said") == "block").alias("blocked")
    )
    known = cut_lineage(templates(cut_lineage(counts)))
    rejected = judged_templates(known).where("reject")
    bad = known.join(rejected, ["host", "template"]).select("host", "shape", F.lit("block").alias("tree"))
    out = rows.join(bad, ["host", "shape"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", "tree", F.lit("allow")).alias("verdict"))
