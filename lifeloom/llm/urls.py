"""URL filtering: fixed rules first, then a path-template tree per host.

A url's path is cut into segments.  Numbers, hexadecimal strings and other segments that change from page to
page are generalised: by their form, or because a node of the host's tree has many different children of few
urls each.  The tree is built level by level: the children of a node are counted under its generalised path.  What is left
is the url's template.

The urls that a rule decides are the labelled ones.  The share of bad ones is smoothed along the tree, from the top: over all
hosts, of the host, of the template's parent node, of the sibling branches that are merged with it, of the template itself; each
level counts its own labelled urls and takes the level above as SMOOTHING more.  Sibling branches, templates that differ only
in their last literal segment, are merged if both have labelled urls and their shares do not differ significantly.  So
a template without labels gets what is known of its node and host.  It is rejected if the smoothed share reaches ``REJECT`` and
its host has labelled urls at all: what holds over all hosts smooths, but rejects nothing by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, settled

# Verdict and rule.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: A node with at least so many different children, and on average fewer urls per child than this, is variable.
MANY_CHILDREN, FEW_URLS = 8, 2.0
#: Two shares differ if their pooled z score exceeds this.
Z = 1.96
#: Weight of the level above, in urls.
SMOOTHING = 4.0
REJECT = 0.6


def host_and_path(url) -> tuple[F.Column, F.Column]:
    """Both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    none = F.lit("")
    return F.coalesce(F.translate(host, UPPER, LOWER), none), F.coalesce(path, none)


def rule_of(host, path, rules=RULES):
    """The longest fitting rule as struct(rule, verdict), null if none fits."""
    fitting = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        r_host, _, r_path = rule.partition("/")
        fits = ((host == r_host) | host.endswith(f".{r_host}")) & path.startswith(f"/{r_path}")
        this = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, this) if fitting is None else fitting.when(fits, this)
    return fitting


def _form(segment):
    """A segment with its variable parts replaced by their kind: numbers, hexadecimal strings, dates."""
    shape = F.regexp_replace(segment, r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", "{u}")
    shape = F.regexp_replace(shape, r"\b(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{8,}\b", "{h}")
    return F.regexp_replace(shape, r"[0-9]+", "{n}")


def parsed(pages: DataFrame, rules=RULES) -> DataFrame:
    """(row, page_id, host, path, fit, forms): the url columns of ``pages`` only, written once, so that ``row`` is fixed."""
    host, path = host_and_path(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    forms = F.transform(F.filter(F.split(F.col("path"), "/"), lambda s: s != ""), _form)
    return settled(
        cut.select(F.monotonically_increasing_id().alias("row"), "*", rule_of(F.col("host"), F.col("path"), rules).alias("fit"), forms.alias("forms")),
        "url-rows",
    )


def templates(rows: DataFrame) -> DataFrame:
    """(row, host, template, parent, pooled): the generalised path, the node above it, and the path with its last literal segment open."""
    literal_at = lambda c: ~c.contains("{")
    now = rows.select("row", "host", "forms", F.array().cast("array<string>").alias("s")).filter(F.size("forms") > 0)
    # Deeper than this no host has the urls that a variable node needs.
    levels = now.select("host", F.explode(F.sequence(F.lit(1), F.size("forms"))).alias("level")).groupBy("host", "level").count()
    deepest = levels.filter(F.col("count") >= MANY_CHILDREN).agg(F.max("level")).first()[0] or 0
    for depth in range(deepest):
        form = F.get("forms", F.lit(depth))
        nodes = now.withColumn("parent", F.array_join("s", "/")).withColumn("form", form)
        # Of each tree node: its urls and different children; both sums combine before the shuffle.
        children = nodes.filter(F.col("form").isNotNull() & literal_at(F.col("form"))).groupBy("host", "parent", "form").agg(F.count("*").alias("urls"))
        wide = (
            children.groupBy("host", "parent").agg(F.sum("urls").alias("urls"), F.count("*").alias("kinds"))
            .filter((F.col("kinds") >= MANY_CHILDREN) & (F.col("urls") < FEW_URLS * F.col("kinds")))
            .select("host", "parent", F.lit(True).alias("wide"))
        )
        told = F.when(F.col("wide") & literal_at(F.col("form")), F.lit("*")).otherwise(F.col("form"))
        grown = F.when(F.col("form").isNull(), F.col("s")).otherwise(F.concat("s", F.array(told)))
        now = settled(nodes.join(wide, ["host", "parent"], "left").select("row", "host", "forms", grown.alias("s")), "url-levels")
    seen = now.select("row", "host", F.concat("s", F.slice("forms", F.size("s") + 1, F.size("forms"))).alias("s"))
    segments = F.col("s")
    literal = F.transform(segments, lambda x: ~(x.contains("{") | (x == "*")))
    last = F.size(segments) - F.array_position(F.reverse(literal), True)
    opened = F.when(F.array_contains(literal, True), F.transform(segments, lambda x, i: F.when(i == last, F.lit("~")).otherwise(x))).otherwise(segments)
    above = F.array_join(F.slice(segments, 1, F.size(segments) - 1), "/")
    return seen.select("row", "host", F.array_join(segments, "/").alias("template"), above.alias("parent"), F.array_join(opened, "/").alias("pooled"))


def verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row of ``pages``.

    ``purity`` is the smoothed share of labelled-bad urls of the row's template.  A null url, one without ``://`` and
    an empty path belong to the template ``""`` of their host.  Without a labelled url on the host the method allows.
    Repeated rows and null ids stay; an empty table gives an empty result; further columns are ignored.
    """
    rows = parsed(pages, rules)
    shaped = rows.join(templates(rows).drop("host"), "row", "left").select(
        "row", "page_id", "host", "path", "fit", *(F.coalesce(c, F.lit("")).alias(c) for c in ("template", "parent", "pooled"))
    )
    shaped = settled(shaped, "url-shapes")
    judged = purities(shaped.select("host", "template", "parent", "pooled", F.col("fit.verdict").alias("label")))
    rejected = (F.col("purity") >= REJECT) & (F.col("host_n") > 0)
    return shaped.join(judged, ["host", "template"]).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(rejected, "block").otherwise("allow")).alias("verdict"), "template", "purity",
    )


def purities(shaped: DataFrame) -> DataFrame:
    """(host, template, purity, host_n) of (host, template, parent, pooled, label): one row per template of a host.

    A label is ``block``, ``allow`` or null.  All counts combine before they are shuffled; what is joined is one row per branch.
    """
    bad = F.count_if(F.col("label") == "block")
    branch = shaped.groupBy("host", "template", "parent", "pooled").agg(F.count("label").alias("n"), bad.alias("bad"))
    hosts = branch.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("bad").alias("host_bad"))
    nodes = branch.groupBy("host", "parent").agg(F.sum("n").alias("node_n"), F.sum("bad").alias("node_bad"))
    pool = branch.groupBy("host", "pooled").agg(F.sum("n").alias("p_n"), F.sum("bad").alias("p_bad"))
    whole = hosts.agg(F.coalesce(F.try_divide(F.sum("host_bad"), F.sum("host_n")), F.lit(0.0)).alias("all_share"))
    other_n, other_bad = F.col("p_n") - F.col("n"), F.col("p_bad") - F.col("bad")
    share, one = F.try_divide(F.col("p_bad"), F.col("p_n")), F.lit(1.0)
    spread = F.sqrt(share * (one - share) * (F.try_divide(one, F.col("n")) + F.try_divide(one, other_n)))
    gap = F.abs(F.try_divide(F.col("bad"), F.col("n")) - F.try_divide(other_bad, other_n))
    # Merged: branches that have labels, as has the rest of their pool, and are not apart from it.
    merged = (F.col("n") > 0) & (other_n > 0) & ~F.coalesce(gap > Z * spread, F.lit(False))
    tested = branch.join(pool, ["host", "pooled"]).withColumn("merged", merged)
    joint = tested.filter("merged").groupBy("host", "pooled").agg(F.sum("n").alias("m_n"), F.sum("bad").alias("m_bad"))

    def smoothed(bad, n, above):
        return (F.col(bad) + SMOOTHING * above) / (F.col(n) + SMOOTHING)

    levels = tested.join(joint, ["host", "pooled"], "left").join(nodes, ["host", "parent"]).join(hosts, "host").join(F.broadcast(whole))  # one row
    of_host = levels.withColumn("of_host", smoothed("host_bad", "host_n", F.col("all_share")))
    of_node = of_host.withColumn("of_node", smoothed("node_bad", "node_n", F.col("of_host")))
    siblings = F.when(F.col("merged"), smoothed("m_bad", "m_n", F.col("of_node"))).otherwise(F.col("of_node"))
    return of_node.withColumn("above", siblings).select("host", "template", smoothed("bad", "n", F.col("above")).alias("purity"), "host_n")
