"""URL filters by a path-template tree per host.

Numbers in a path are wildcards from the start, so that a host's paths become few shapes. The
tree is then grown level by level over these shapes: below a node a segment that holds too
small a share of the node's pages becomes a wildcard, unless its own labels tell it from the
rest of the node or tell its verdict; such ones of about the same share count as one, named by
a number (shapes hold none). The segments that stay are merged with siblings whose labelled share of bad pages is statistically the same, each compared with
the whole branch that it would join; those without labels stay apart from labelled ones. At the
leaves the share of bad labels, smoothed towards the host's and that towards the whole table's, decides.

All of it is aggregation and joins with one row per key; what a hot host costs is counted
map-side. Only the kept siblings of a node, at most
1 / ``LEAST_SHARE`` and ``FOLDS`` + 1, come together in a cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.session import materialize

# A segment stays as it is with at least this share of its node's pages, and so many of them.
LEAST_SHARE, LEAST_PAGES = 0.02, 5
# Smaller segments that stay for their labels are folded by so many steps of their share. A step
# ends at MOST_BAD, so that no two on different sides of it are folded.
FOLDS = 64
# Levels of the tree; what a path holds beyond them is one last segment.
DEPTH = 8
# Pages' worth of the level above that smooth a share of bad labels.
SMOOTHING = 4.0
# Templates with a larger smoothed share of bad labels are rejected.
MOST_BAD = 0.5
# Half the logarithm of 2 / 0.05: by this Hoeffding bound shares count as the same.
SAME = 1.844

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of some rules (host/path) that fits a URL, else NULL."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(
            path, F.lit(slash + rest))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def shape_of(path: Column) -> Column:
    """A path's segments with # for every number, and those beyond the tree's depth in one."""
    segments = F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), r"[0-9]+", "#"), "/", -1)
    return F.when(F.size(segments) <= DEPTH, segments).otherwise(F.concat(
        F.slice(segments, 1, DEPTH - 1),
        F.array(F.array_join(F.slice(segments, DEPTH, 2**31 - 1), "/"))))


def _branches(kept: DataFrame) -> DataFrame:
    """(host, template, segment) with the number of its ``branch`` among its siblings.

    Labelled siblings join the branch of those with smaller shares unless theirs is apart from
    that of the branch as a whole or of any sibling in it: unless it is, less its own half of
    the bound, above the least upper end of these. Siblings without labels say nothing about
    others, and are a branch by themselves.
    """
    share = (F.col("bad") + 1) / (F.col("labelled") + 2)
    siblings = kept.groupBy("host", "template").agg(F.array_sort(F.collect_list(F.struct(
        share.alias("share"), "segment", F.col("bad").cast("long").alias("bad"),
        F.col("labelled").cast("long").alias("labelled")))).alias("siblings"))

    def width(labelled: Column) -> Column:
        return F.try_divide(F.lit(SAME**0.5), F.sqrt(labelled))

    def state(branch: Column, bad: Column, labelled: Column, end: Column,
              placed: Column) -> Column:
        return F.struct(branch.alias("branch"), bad.alias("bad"), labelled.alias("labelled"),
                        end.alias("end"), placed.alias("placed"))

    def place(so_far: Column, one: Column) -> Column:
        half = width(one["labelled"])
        pooled = (so_far["bad"] + 1) / (so_far["labelled"] + 2) + width(so_far["labelled"])
        apart = F.coalesce(one["share"] - half > F.least(so_far["end"], pooled), F.lit(False))
        branch = so_far["branch"] + apart.cast("int")
        placed = F.concat(so_far["placed"], F.array(F.struct(
            one["segment"].alias("segment"), branch.alias("branch"))))
        alone, end = one["labelled"] == 0, one["share"] + half
        joined = F.when(apart, state(branch, one["bad"], one["labelled"], end, placed)).otherwise(
            state(branch, so_far["bad"] + one["bad"], so_far["labelled"] + one["labelled"],
                  F.least(so_far["end"], end), placed))
        return F.when(alone, state(
            so_far["branch"], so_far["bad"], so_far["labelled"], so_far["end"],
            F.concat(so_far["placed"], F.array(F.struct(
                one["segment"].alias("segment"), F.lit(-1).alias("branch")))))).otherwise(joined)

    start = state(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"),
                  F.lit(None).cast("double"),
                  F.lit([]).cast("array<struct<segment:string,branch:int>>"))
    return siblings.select("host", "template", F.inline(
        F.aggregate("siblings", start, place)["placed"]))


def _telling() -> Column:
    """Has a segment a labelled share apart from the rest of its node's or from MOST_BAD."""
    bad, labelled = F.col("bad"), F.col("labelled")
    rest_bad, rest = F.col("all_bad") - bad, F.col("all_labelled") - labelled
    share = (bad + 1) / (labelled + 2)
    half = F.try_divide(F.lit(SAME**0.5), F.sqrt(labelled))
    from_rest = F.abs(share - (rest_bad + 1) / (rest + 2)) > half + F.try_divide(
        F.lit(SAME**0.5), F.sqrt(rest))
    return F.coalesce(from_rest, F.lit(False)) | F.coalesce(
        F.abs(share - MOST_BAD) > half, F.lit(False))


def _decided(nodes: DataFrame) -> DataFrame:
    """What becomes of each segment below a node: (host, template, segment) and ``label``."""
    segments = nodes.groupBy("host", "template", "segment").agg(
        *(F.sum(name).alias(name) for name in ("pages", "bad", "labelled")))
    totals = segments.groupBy("host", "template").agg(
        F.sum("pages").alias("total"), F.sum("bad").alias("all_bad"),
        F.sum("labelled").alias("all_labelled"))
    sized = segments.join(totals, ["host", "template"])
    large = (F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= LEAST_SHARE * F.col("total"))
    # A smaller segment stays where its labels alone say that it isn't like the rest of its node,
    # or on which side of the verdict it lies; those of about the same share stay as one.
    told = F.when(~large & _telling(), F.concat(F.lit("*"), F.ceil(
        FOLDS * F.col("bad") / F.col("labelled")).cast("string")))
    sized = sized.withColumn("part", F.when(large, F.col("segment")).otherwise(told))
    parts = sized.filter("part IS NOT NULL").groupBy("host", "template", "part").agg(
        F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
    kept = _branches(parts.withColumnRenamed("part", "segment"))
    names = kept.groupBy("host", "template", "branch").agg(
        F.array_join(F.array_sort(F.collect_list("segment")), "|").alias("label"))
    named = kept.join(names, ["host", "template", "branch"]).select(
        "host", "template", F.col("segment").alias("part"), "label")
    return (sized.select("host", "template", "segment", "part")
            .join(named, ["host", "template", "part"], "left")
            .select("host", "template", "segment", F.coalesce("label", F.lit("*")).alias("label")))


def template_tree(shapes: DataFrame) -> DataFrame:
    """(host, shape, pages, bad, labelled) with the ``template`` of every shape.

    A template joins its segments by ``/``: wildcards ``*``, merged siblings by ``|``.
    """
    nodes = materialize(shapes.withColumn("template", F.lit("")), "shapes")
    depth = nodes.agg(F.max(F.size("shape"))).first()[0] or 0
    for level in range(depth):
        here = nodes.filter(F.size("shape") > level).withColumn(
            "segment", F.get("shape", level))
        grown = here.join(_decided(here), ["host", "template", "segment"]).withColumn(
            "template", F.concat("template", F.lit("/"), "label"))
        nodes = materialize(grown.select(nodes.columns).unionByName(
            nodes.filter(F.size("shape") <= level)), "tree")
    return nodes


def judged(tree: DataFrame) -> DataFrame:
    """(host, template) with the smoothed share of bad labels."""
    templates = tree.groupBy("host", "template").agg(
        *(F.sum(name).alias(name) for name in ("pages", "bad", "labelled")))
    everywhere = tree.agg(F.coalesce(
        F.try_divide(F.sum("bad"), F.sum("labelled")), F.lit(0.0))).scalar()
    hosts = tree.groupBy("host").agg(F.sum("bad").alias("b"), F.sum("labelled").alias("n")).select(
        "host", ((F.col("b") + SMOOTHING * everywhere) / (F.col("n") + SMOOTHING)).alias("prior"))
    return templates.join(hosts, "host").select(
        "host", "template", "pages", "bad", "labelled",
        ((F.col("bad") + SMOOTHING * F.col("prior"))
         / (F.col("labelled") + SMOOTHING)).alias("bad_share"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]],
                id: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: ``id``, host, path, rule, verdict, template, bad_share.

    ``labels`` has (host, path, bad) of pages that somebody judged, bad being 0 or 1; rows may
    repeat and each counts. ``rules`` are (host/path, verdict); the longest that fits a URL
    gives the verdict, else its template does. A NULL URL, or one without ``://``, has an empty
    host and path, which are judged as any others; without labels nothing is rejected.
    """
    rows = pages.select(F.col(id).alias("__id"), host_of(F.col(url)).alias("host"),
                        path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("shape", shape_of(F.col("path")))
    told = (labels.filter("bad IN (0, 1)")
            .select("host", shape_of(F.col("path")).alias("shape"), "bad")
            .groupBy("host", "shape").agg(F.sum("bad").cast("long").alias("bad"),
                                          F.count("*").alias("labelled")))
    shapes = rows.groupBy("host", "shape").agg(F.count("*").alias("pages")).join(
        told, ["host", "shape"], "left").fillna(0, ["bad", "labelled"])
    tree = template_tree(shapes)
    found = materialize(tree.select("host", "shape", "template").join(
        judged(tree).select("host", "template", "bad_share"), ["host", "template"]), "templates")
    ruled = rule_of(F.col("host"), F.col("path"), rules)
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, verdict).otherwise(by_rule)
    return (rows.join(found, ["host", "shape"]).withColumn("rule", ruled)
            .select(F.col("__id").alias(id), "host", "path", "rule", F.coalesce(
                by_rule, F.when(F.col("bad_share") > MOST_BAD, "block").otherwise("allow"))
                .alias("verdict"), "template", "bad_share"))
