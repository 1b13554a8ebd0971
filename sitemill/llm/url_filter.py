"""URL verdicts by rules and by a tree of path templates for each host (operator 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, cut

#: (verdict, host/path) of the query's rules.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Levels at which variable segments are learnt; what lies deeper is one last segment of fixed shapes.
DEPTH = 6
#: A node with more distinct children, most of them rare, has variable ones.
FANOUT = 20
#: Purity is smoothed by so many imagined pages, of which a quarter are blocked; that of a branch
#: without labels by so many imagined siblings of that purity.
SMOOTHING, PRIOR = 4.0, 0.25
#: A template is rejected at this share of blocked pages.
REJECT = 0.5
#: Branches whose blocked shares differ by fewer standard errors are merged.
ALIKE_Z = 1.96
#: A table is broadcast only if it was counted and has no more rows than this.
BROADCAST_ROWS = 500_000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: both empty if the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + prefix)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def segment_shape(segment: Column) -> Column:
    """A segment with numbers, long hex strings and dates as wildcards; its other characters stay."""
    s = F.regexp_replace(segment, r"\d{4}-\d{2}-\d{2}", "{date}")
    s = F.regexp_replace(s, r"\b[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\b|\b[0-9a-fA-F]{12,}\b", "{hex}")
    return F.regexp_replace(s, r"\d+", "{n}")


def counted(df: DataFrame) -> tuple[DataFrame, bool]:
    """The table, materialised, with a broadcast hint if it has few enough rows; and whether it has."""
    df = cut(df)
    small = df.count() <= BROADCAST_ROWS
    return F.broadcast(df) if small else df, small


def path_templates(paths: DataFrame, depth: int = DEPTH, fanout: int = FANOUT) -> DataFrame:
    """Adds template to distinct (host, path, ...) rows: the path with variable segments as wildcards.

    Level by level from the host's root, nodes are (host, template so far). A node with more than
    ``fanout`` distinct children of which most occur once has variable children: they become ``*``.
    Two aggregates a level, no row gathers its node's children. The table of such nodes is counted:
    it is broadcast where it is small, so that a host with most of the paths is not dealt to one
    task; a large one is joined by shuffle.
    """
    parts = F.transform(F.split("path", "/"), segment_shape)
    head = F.slice(parts, 1, depth)
    tail = F.when(F.size(parts) > depth, F.array(F.array_join(F.slice(parts, depth + 1, F.size(parts)), "/"))).otherwise(F.array().cast("array<string>"))
    t = cut(paths.withColumn("__seg", F.concat(head, tail)).withColumn("template", F.element_at("__seg", 1)))
    for level in range(2, depth + 1):
        seg = F.try_element_at("__seg", F.lit(level))
        kids = t.where(seg.isNotNull()).groupBy("host", "template", seg.alias("seg")).agg(F.count("*").alias("n"))
        nodes = kids.groupBy("host", "template").agg(F.count("*").alias("kids"), F.sum((F.col("n") <= 2).cast("int")).alias("rare"))
        wild = nodes.where((F.col("kids") > fanout) & (2 * F.col("rare") > F.col("kids"))).select("host", "template", F.lit(True).alias("wild"))
        wild, small = counted(wild)
        t = t.join(wild, ["host", "template"], "left")
        here = F.when(F.col("wild"), "*").otherwise(seg)
        t = t.withColumn("template", F.when(seg.isNull(), F.col("template")).otherwise(F.concat_ws("/", "template", here))).drop("wild")
        t = t if small else cut(t)
    last = F.try_element_at("__seg", F.lit(depth + 1))
    return t.withColumn("template", F.concat_ws("/", "template", last)).drop("__seg")


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity: one row for each page.

    Where a rule fits, the longest one's verdict holds. Else the page's template decides: the pages
    of a host that rules have judged are the labels. Sibling templates, which differ in one fixed
    segment, are merged if their shares of blocked pages do not differ significantly from their
    common share. The purity of a template is its blocked share, smoothed towards a prior that
    allows; from one half it rejects. A template without labels joins the branch of its labelled
    siblings: its purity is their mean, smoothed as if there were four more siblings at the prior, so
    three blocked ones condemn it and two do not. Without labelled siblings the prior is left.

    Null urls and those without ``://`` have an empty host and path, match no rule and are allowed
    unless the empty template is rejected. Rows of one id each give a row. Extra columns are ignored.
    """
    host, path = split_url(F.col(url_col).cast("string"))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", rule).withColumn("__fixed", verdict)
    distinct = base.groupBy("host", "path").agg(F.count("*").alias("n"), F.max("__fixed").alias("label"))
    t = path_templates(distinct)
    known = F.col("label").isNotNull()
    nodes = t.groupBy("host", "template").agg(
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n"), F.sum(F.when(F.col("label") == "block", F.col("n")).otherwise(0)).alias("bad")
    )
    # siblings: the last fixed segment masked
    nodes = nodes.withColumn("parent", F.regexp_replace("template", r"^(.*/)?([^/{}*]+)((/[^/]*[{*][^/]*)*/?)$", "$1?$3"))
    family = nodes.where("n > 0").groupBy("host", "parent").agg(
        F.sum("n").alias("fn"), F.sum("bad").alias("fbad"), F.count("*").alias("kin"), F.sum((F.col("bad") + SMOOTHING * PRIOR) / (F.col("n") + SMOOTHING)).alias("pure")
    )
    nodes = nodes.join(family, ["host", "parent"], "left")
    p = F.col("fbad") / F.col("fn")
    z = F.abs(F.col("bad") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))
    alike = (F.col("n") > 0) & ((p == 0) | (p == 1) | (z < ALIKE_Z))
    n, bad = F.when(alike, F.col("fn")).otherwise(F.col("n")), F.when(alike, F.col("fbad")).otherwise(F.col("bad"))
    joins = (F.col("n") == 0) & (F.col("kin") > 0)
    kin = (F.col("pure") + SMOOTHING * PRIOR) / (F.col("kin") + SMOOTHING)
    purity = F.round(F.when(joins, kin).otherwise((bad + SMOOTHING * PRIOR) / (n + SMOOTHING)), 9).alias("purity")
    nodes = nodes.select("host", "template", purity, F.when(alike | joins, F.col("parent")).otherwise(F.col("template")).alias("merged"))
    nodes, _ = counted(nodes)
    named = t.select("host", "path", "template").join(nodes, ["host", "template"]).select("host", "path", F.col("merged").alias("template"), "purity")
    out = base.join(named, ["host", "path"])
    own = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("__fixed", own).alias("verdict"), "template", "purity")
