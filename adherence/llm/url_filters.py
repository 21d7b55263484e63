"""URL filters: rules first, then a path-template tree of every host.

A url's rule is the longest one that fits its host (or a domain above it) and the start of its path.
Urls that no rule decides are judged by their template.  Per host, paths are laid into a tree, segment
by segment: where the segments at a place are numbers, ids or dates, or are too many for what they
hold, they are generalised into a wildcard; branches whose shares of blocked urls do not differ
significantly are merged.  The labels are the verdicts of the rules; the purity of a template is its
share of blocked among labelled urls, smoothed by that of its parent, this one by its parent's, up to
the host's and all hosts'.  A template is rejected, and its unlabelled urls blocked, if its smoothed
purity is ``REJECT`` at least.

A host may have any share of the urls: the tree is worked out level by level with grouped sums over
(host, template, segment), which combine before they are shuffled; no task holds a host.  Segments
past ``DEPTH`` form one last segment.

Defined cases: a null url, or one without ``://``, has an empty host and an empty path, no rule fits it
and it is allowed; a host is taken as written up to the path (a port is part of it); repeated urls count
as often as they occur; null page_ids are kept; extra columns are not looked at; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adherence.llm.base import stored, table

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
DEPTH = 6
#: A place with more different segments than this is variable if they are over MANY of its urls.
BRANCHES = 12
MANY = 0.5
#: Urls that a parent's purity counts for.
SMOOTH = 8.0
REJECT = 0.8
#: Branches with a smaller difference, in standard errors, are similar.
SIMILAR = 1.64
#: Labelled urls from which on a branch is compared with its siblings.
LABELLED = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one.  The rules are a parameter, a
    list as long as a person writes it."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _shape(segment: Column) -> Column:
    """A segment that is plainly a value: digits (with an ending), a date, or a long hexadecimal id."""
    return (F.when(segment.rlike(r"^[0-9]+(\.[a-z0-9]+)?$"), F.lit("*")).when(segment.rlike(r"^[0-9a-f-]*[0-9][0-9a-f-]*$") & (F.length(segment) >= 6), F.lit("*"))
            .otherwise(segment))


def templates(urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (host, path, verdict): the template of every (host, path), and of every (host, template) its
    counts, smoothed purity and whether it is rejected."""
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    some = F.when(F.size(segments) > DEPTH, F.concat(F.slice(segments, 1, DEPTH - 1), F.array(F.array_join(F.slice(segments, F.lit(DEPTH), F.size(segments)), "/")))).otherwise(segments)
    paths = (urls.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum((F.col("verdict") == "block").cast("long")).alias("blocked"), F.count("verdict").alias("known"))
             .withColumn("blocked", F.coalesce("blocked", F.lit(0))).withColumn("segments", F.transform(some, _shape)).withColumn("template", F.lit("")))
    paths = stored(paths, "paths")
    p_all = urls.agg((F.count(F.when(F.col("verdict") == "block", 1)) + 1) / (F.count("verdict") + 2)).first()[0]
    sums = [F.sum(c).alias(c) for c in ("n", "blocked", "known")]
    # the root of each host
    nodes = paths.groupBy("host", "template").agg(*sums).withColumn("p", (F.col("blocked") + SMOOTH * p_all) / (F.col("known") + SMOOTH))
    every = [nodes]
    for depth in range(DEPTH):
        at = F.get("segments", F.lit(depth))
        here = paths.where(at.isNotNull()).withColumn("segment", at)
        children = here.groupBy("host", "template", "segment").agg(*sums)
        own = children.groupBy("host", "template").agg(F.count("*").alias("kinds"), F.sum("n").alias("all"))
        variable = (F.col("kinds") > BRANCHES) & ((F.col("kinds") > MANY * F.col("all")) | (F.col("kinds") > 20 * BRANCHES))
        children = children.join(own, ["host", "template"]).withColumn("branch", F.when(variable, F.lit("*")).otherwise(F.col("segment")))
        # siblings in order of their purity: a new group begins where the difference to the one before is significant,
        # and branches with hardly any labels, of which nothing is known, are a group; at most 20 * BRANCHES siblings
        groups = children.groupBy("host", "template", "branch").agg(*sums)
        rate = (F.col("blocked") + 0.5) / (F.col("known") + 1.0)
        error = F.sqrt(rate * (1 - rate) / (F.col("known") + 1.0))
        order = Window.partitionBy("host", "template").orderBy("weak", "rate", "branch")
        step = (F.col("weak") != F.lag("weak").over(order)) | ~F.col("weak") & (F.abs(F.col("rate") - F.lag("rate").over(order)) > SIMILAR * F.sqrt(F.col("error") * F.col("error") + F.lag(F.col("error") * F.col("error")).over(order)))
        groups = (groups.withColumn("weak", F.col("known") < LABELLED).withColumn("rate", rate).withColumn("error", error).withColumn("step", F.coalesce(step, F.lit(False)).cast("int"))
                  .withColumn("group", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)))
                  .withColumn("name", F.min("branch").over(Window.partitionBy("host", "template", "group")))
                  .withColumn("size", F.count("*").over(Window.partitionBy("host", "template", "group"))))
        named = groups.select("host", "template", "branch", F.concat("template", F.lit("/"), F.when(F.col("size") > 1, F.concat("name", F.lit("~"))).otherwise(F.col("name"))).alias("next"))
        to = children.join(named, ["host", "template", "branch"]).select("host", "template", "segment", "next")
        moved = paths.withColumn("segment", at).join(to, ["host", "template", "segment"], "left")
        paths = stored(moved.select("host", "path", "n", "blocked", "known", "segments", F.coalesce("next", "template").alias("template"),
                                    F.col("next").isNotNull().alias("open")), "paths")
        parent = nodes.select("host", F.col("template").alias("up"), F.col("p").alias("p_up"))
        new = named.select("host", F.col("template").alias("up"), F.col("next").alias("template")).distinct()
        counted = paths.where("open").groupBy("host", "template").agg(*sums)
        nodes = stored(counted.join(new, ["host", "template"]).join(parent, ["host", "up"])
                       .withColumn("p", (F.col("blocked") + SMOOTH * F.col("p_up")) / (F.col("known") + SMOOTH)).select("host", "template", "n", "blocked", "known", "p"), "nodes")
        every.append(nodes)
        if not paths.where(F.size("segments") > depth + 1).limit(1).count():
            break
    out = every[0]
    for x in every[1:]:
        out = out.unionByName(x)
    return paths.select("host", "path", "template"), out.withColumn("rejected", F.col("p") >= REJECT)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every page."""
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path).withColumn("rule", rule).withColumn("verdict", verdict)
    of_path, of_template = templates(urls.where("host <> ''").select("host", "path", "verdict"))
    by_path = of_path.join(of_template.select("host", "template", "p", "rejected"), ["host", "template"], "left")
    # a hot url is one row here; its pages are split by the join
    out = urls.join(by_path, ["host", "path"], "left")
    method = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "template", F.col("p").alias("purity"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages", "page_id", "url"))
