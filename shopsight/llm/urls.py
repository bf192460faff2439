"""URL filters: host and path rules, and a tree of path templates per host.

A host's paths form a tree of segments. From the root down, variable segments
become wildcards: numbers, hashes and long tokens by their form, and children
that are each rare under a node with many. Sibling branches whose next segments
are distributed like those of the node as a whole, and whose labels don't
contradict it, are merged into one wildcard. Pages that a rule decides are the
labels. Words under one node are merged only with words of the same labels
(none, blocked, allowed or both), whatever their number: that a rule names one
word says nothing of its siblings. A template is rejected if its blocked share,
smoothed by the overall share, reaches ``max_blocked``. Pages without a rule get
their template's verdict.

Distinct paths are counted first, so a host of any number of pages costs what
its distinct paths cost.

Defined results: null, or no ``://``: host and path are empty, no rule fits, and
the (empty) template decides; equal urls get equal verdicts; segments beyond
``depth`` are one wildcard; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import col, cut

#: The rules, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
FORMS = ("none", "number", "file", "hash", "long", "word")


@dataclass(frozen=True)
class Tree:
    depth: int = 8
    many_children: int = 16
    rare_share: float = 0.1
    long_segment: int = 32
    max_distance: float = 0.25  # Jensen-Shannon, of a branch from its siblings
    max_label_gap: float = 0.5
    min_labelled: int = 20
    prior_weight: float = 20.0
    max_blocked: float = 0.9


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.instr(url, "://") > 0, lower).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    path = F.regexp_extract(F.regexp_replace(rest, r"^[^/?#]*", ""), r"^[^?#]*", 0)
    return F.when(F.instr(url, "://") > 0, path).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _form(segment: Column, tree: Tree) -> Column:
    return (F.when(segment.isNull(), "none").when(segment.rlike(r"^[0-9]+$"), "number")
            .when(segment.rlike(r"^[0-9]+\.[A-Za-z0-9]{1,5}$"), "file").when(segment.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), "hash")
            .when(F.length(segment) > tree.long_segment, "long").otherwise("word"))


def _distance(p: list[Column], q: list[Column]) -> Column:
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    total = sum((term(x, (x + y) / 2) + term(y, (x + y) / 2) for x, y in zip(p, q, strict=True)), F.lit(0.0))
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def templates(paths: DataFrame, tree: Tree) -> DataFrame:
    """``paths`` (host, path, n, labelled, blocked) and ``template``."""
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    segments = F.when(F.size(parts) > tree.depth, F.concat(F.slice(parts, 1, tree.depth), F.array(F.lit("**")))).otherwise(parts)
    rows = cut(paths.withColumn("segs", segments).withColumn("template", F.lit("")))
    deepest = rows.agg(F.max(F.size("segs")).alias("d")).first().d or 0
    node = ["host", "template"]
    for d in range(deepest):
        here = rows.where(F.size("segs") > d).withColumn("child", F.col("segs")[d])
        following = _form(F.get("segs", F.lit(d + 1)), tree)
        children = here.groupBy(*node, "child").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("l"), F.sum("blocked").alias("b"),
            *(F.sum(F.when(following == f, F.col("n")).otherwise(0)).alias(f"f_{f}") for f in FORMS))
        whole = children.groupBy(*node).agg(
            F.count(F.lit(1)).alias("kids"), F.sum("n").alias("all_n"), F.sum("l").alias("all_l"), F.sum("b").alias("all_b"),
            *(F.sum(f"f_{f}").alias(f"all_{f}") for f in FORMS))
        both = children.join(whole, node)
        form = _form(F.col("child"), tree)
        rare = (F.col("kids") > tree.many_children) & (F.col("n") < tree.rare_share * F.col("all_n"))
        alike = _distance([F.col(f"f_{f}") / F.col("n") for f in FORMS],
                          [F.col(f"all_{f}") / F.col("all_n") for f in FORMS]) <= tree.max_distance
        known = (F.col("l") >= tree.min_labelled) & (F.col("all_l") >= tree.min_labelled)
        gap = F.abs(F.col("b") / F.greatest("l", F.lit(1)) - F.col("all_b") / F.greatest("all_l", F.lit(1)))
        merged = alike & (F.col("kids") > 1) & ~F.coalesce(known & (gap > tree.max_label_gap), F.lit(False))
        labels = (F.when(F.col("l") == 0, "").when(F.col("b") == F.col("l"), ":block").when(F.col("b") == 0, ":allow")
                  .otherwise(":mixed"))
        wild = lambda kind: F.concat(F.lit(f"<{kind}"), labels, F.lit(">"))
        name = (F.when(form.isin("number", "hash", "long"), F.concat(F.lit("<"), form, F.lit(">")))
                .when(form == "file", F.concat(F.lit("<number>."), F.substring_index("child", ".", -1)))
                .when(F.col("child") == "**", F.col("child")).when(rare, wild("any"))
                .when(merged, wild("like")).otherwise(F.col("child")))
        named = both.select(*node, "child", name.alias("name"))
        step = here.join(named, [*node, "child"]).withColumn("template", F.concat("template", F.lit("/"), "name"))
        rows = cut(step.select(*rows.columns).unionByName(rows.where(F.size("segs") <= d)))
    return rows.drop("segs")


def judge(pages: DataFrame, url: str = "url", rules=RULES, tree: Tree = Tree(), out: str = "judged") -> DataFrame:
    """``pages`` and a struct ``out``: host, path, rule, verdict, template."""
    u = F.coalesce(col(url).cast("string"), F.lit(""))
    host, path = host_of(u), path_of(u)
    listed = pages.select(host.alias("host"), path.alias("path"))
    counted = listed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "r", rule_of(F.col("host"), F.col("path"), rules))
    labelled = counted.select(
        "host", "path", "n", F.when(F.col("r").isNotNull(), F.col("n")).otherwise(0).alias("labelled"),
        F.when(F.col("r.verdict") == "block", F.col("n")).otherwise(0).alias("blocked"))
    found = templates(labelled, tree)
    total = found.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    prior = (total.b or 0) / max(total.l or 0, 1)
    share = (F.sum("blocked") + tree.prior_weight * prior) / (F.sum("labelled") + F.lit(tree.prior_weight))
    purity = found.groupBy("host", "template").agg(
        ((share >= tree.max_blocked) & (F.sum("labelled") >= tree.min_labelled)).alias("rejected"))
    by_path = found.join(purity, ["host", "template"]).select(
        F.col("host").alias("__host"), F.col("path").alias("__path"), "template", "rejected")
    rows = pages.withColumn(out, F.struct(host.alias("host"), path.alias("path"), rule_of(host, path, rules).alias("r")))
    rows = rows.join(by_path, (F.col(out)["host"] == F.col("__host")) & (F.col(out)["path"] == F.col("__path")), "left")
    verdict = F.coalesce(F.col(out)["r"]["verdict"], F.when(F.col("rejected"), "block").otherwise("allow"))
    return rows.withColumn(out, F.struct(
        F.col(out)["host"].alias("host"), F.col(out)["path"].alias("path"), F.col(out)["r"]["rule"].alias("rule"),
        verdict.alias("verdict"), F.col("template").alias("template"))).select(*(col(c) for c in pages.columns), F.col(out))
