"""URL filters: rules first, then a tree of path templates per host.

Variable path segments become wildcards, sibling branches whose labels do not differ statistically
are merged, and a template whose smoothed share of bad labels is high is rejected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import ascii_lower
from roadpulse.session import written_out

# (verdict, host, path): holds on the host and its subdomains for paths that start with the path.
Rule = tuple[str, str, str]

WILD = "*"
MANY, VARIED = 10, 0.3  # children of a branch, and children per url, from which they are variable
Z = 1.96  # siblings whose labels differ by less are merged
LEAST = 5  # labels that a branch needs before it is compared
STRENGTH, PRIOR, REJECT = 4.0, 0.25, 0.6  # smoothing weight, assumed share, and share to reject


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _rest(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as (rule, verdict); null where none does. Rules are few by design."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    none = F.lit(None).cast("struct<rule:string,verdict:string>")

    def fits(rule: Rule) -> Column:
        on = (host == rule[1]) | F.endswith(host, F.lit("." + rule[1]))
        return on & F.startswith(path, F.lit(rule[2]))

    def chosen(rule: Rule) -> Column:
        return F.struct(F.lit(rule[1] + rule[2]).alias("rule"), F.lit(rule[0]).alias("verdict"))

    return reduce(lambda rest, r: F.when(fits(r), chosen(r)).otherwise(rest), reversed(longest), none)


def shape(segment: Column) -> Column:
    """A segment that looks like an id becomes a wildcard; a file extension stays."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    extension = F.regexp_extract(segment, r"\.[A-Za-z]{1,5}$", 0)
    variable = F.regexp_like(stem, F.lit(r"^[0-9]+$")) | F.regexp_like(
        stem, F.lit(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$|^.{40,}$|^(?=.*[0-9].*[0-9].*[0-9]).{12,}$")
    )
    return F.when(variable, F.concat(F.lit(WILD), extension)).otherwise(segment)


def _segments(path: Column) -> Column:
    return F.transform(F.array_remove(F.split(path, "/"), ""), shape)


def templates(urls: DataFrame) -> DataFrame:
    """The tree's leaves with their verdicts, from rows of (host, path, bad).

    ``bad`` is 1, 0 or null (no label). Gives one row per (host, segments): the segments with id-like
    ones already generalised, the ``template`` they fall under, its labels and ``verdict``. Each round
    is aggregations of counts that are reduced before the shuffle, so a host with a third of all
    rows costs one row per distinct branch and task.

    A path ends at its own last segment, however deep. Segments that all paths of a branch share are taken in
    one step, and so is the rest of a path that is the only one of its branch; rounds are thus as many as the
    branchings on a path.
    """
    leaves = urls.groupBy("host", _segments(F.col("path")).alias("segments")).agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad")
    )
    # Template so far, and how many segments it covers; every round replaces some more.
    tree = leaves.withColumns({"done": F.lit(""), "taken": F.lit(0), "over": F.lit(False)})
    tree, ended, number = written_out(tree, "url-leaves"), [], 0
    while not tree.isEmpty():
        tree = written_out(_generalised(tree), f"url-round-{number}")
        ended.append(tree.where("over"))
        tree, number = tree.where("NOT over"), number + 1
    tree = reduce(DataFrame.unionAll, ended, tree)
    whole = tree.groupBy("host", "done").agg(F.sum("labelled").alias("seen"), F.sum("bad").alias("refused"))
    share = (F.col("refused") + STRENGTH * PRIOR) / (F.col("seen") + STRENGTH)
    judged = whole.select(
        F.col("host").alias("h"),
        F.col("done").alias("template"),
        "seen",
        "refused",
        share.alias("share"),
        F.when(share >= REJECT, "block").otherwise("allow").alias("verdict"),
    )
    return tree.join(judged, (tree.host == judged.h) & (tree.done == judged.template)).select(
        "host", "segments", "template", "labelled", "bad", "seen", "refused", "share", "verdict"
    )


def _joined(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: F.concat(F.lit("/"), s)), "")


def _past_shared(tree: DataFrame) -> DataFrame:
    """The leaves moved past the segments that all of their branch share.

    These are what the smallest and the greatest of the branch's paths share. A leaf alone is done.
    """
    rest = F.slice("segments", F.col("taken") + 1, F.size("segments"))
    ends = tree.groupBy(F.col("host").alias("bh"), F.col("done").alias("bd")).agg(
        F.min(rest).alias("low"), F.max(rest).alias("high"), F.count("*").alias("leaves")
    )
    differ = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), F.lit(False))
    shared = F.when(differ > 0, differ - 1).otherwise(F.size("low")).cast("int")
    known = ends.select("bh", "bd", shared.alias("shared"), (F.col("leaves") == 1).alias("alone"))
    joined = tree.join(known, (F.col("host") == F.col("bh")) & (F.col("done") == F.col("bd")))
    return joined.select(
        "host", "segments", "n", "labelled", "bad",
        F.concat("done", _joined(F.slice("segments", F.col("taken") + 1, F.col("shared")))).alias("done"),
        (F.col("taken") + F.col("shared")).alias("taken"),
        F.col("alone").alias("over"),
    )


def _generalised(tree: DataFrame) -> DataFrame:
    """Replace the segments that a branch shares by themselves, and the next one by a wildcard, the merged
    siblings' mark, or itself. A path that has no next segment is a sibling of those that go on, and is over."""
    moved = _past_shared(tree)
    at = moved.where("NOT over").withColumn("segment", F.coalesce(F.get("segments", F.col("taken")), F.lit("")))
    branches = at.groupBy("host", "done", "segment").agg(
        F.sum("n").alias("bn"), F.sum("labelled").alias("bl"), F.sum("bad").alias("bb")
    )
    known = F.col("bl") >= LEAST
    parents = branches.groupBy(F.col("host").alias("ph"), F.col("done").alias("pd")).agg(
        F.sum("bn").alias("pn"),
        F.count("*").alias("children"),
        F.sum(F.when(known, F.col("bl")).otherwise(0)).alias("pl"),
        F.sum(F.when(known, F.col("bb")).otherwise(0)).alias("pb"),
    )
    rest_l, rest_b = F.col("pl") - F.col("bl"), F.col("pb") - F.col("bb")
    pooled = F.col("pb") / F.col("pl")
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("bl") + 1 / rest_l))
    gap = F.abs(F.col("bb") / F.col("bl") - rest_b / rest_l)
    alike = known & (rest_l >= LEAST) & (gap <= Z * spread)
    variable = (F.col("children") >= MANY) & (F.col("children") >= VARIED * F.col("pn"))
    named = branches.join(parents, (F.col("host") == F.col("ph")) & (F.col("done") == F.col("pd"))).select(
        F.col("host").alias("nh"),
        F.col("done").alias("nd"),
        F.col("segment").alias("ns"),
        F.when(F.col("segment") == "", F.lit(""))
        .when(variable | F.coalesce(alike, F.lit(False)), F.lit("/" + WILD))
        .otherwise(F.concat(F.lit("/"), F.col("segment")))
        .alias("step"),
    )
    on = (at.host == named.nh) & (at.done == named.nd) & (at.segment == named.ns)
    stepped = at.join(named, on).select(
        "host", "segments", "n", "labelled", "bad",
        F.concat("done", "step").alias("done"), (F.col("taken") + 1).alias("taken"), (F.col("segment") == "").alias("over"),
    )
    return moved.where("over").unionByName(stepped)


def domain_of(host: Column) -> Column:
    """The registered domain by its shape: two labels, three under one like ``co.uk``; a number stays whole."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    two = F.regexp_extract(name, r"(?:[^.]+\.)?(?:[^.]{1,3}\.[a-z]{2}|[^.]+)$", 0)
    return F.when(F.regexp_like(name, F.lit(r"^[0-9.]+$|^\[")), name).otherwise(two)


def backed_off(tree: DataFrame) -> DataFrame:
    """Share of bad labels per (host, template), smoothed towards the evidence of wider branches.

    From rows of (host, template, labelled, bad). The chain starts at the share of all labels. At each
    level the registered domain's branch over its subdomains comes first, then the host's own, and each
    takes the share before it as its prior, with the weight ``STRENGTH``; one without labels passes it on.
    """
    every = tree.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).first()
    whole = (every["b"] or 0) / every["l"] if every["l"] else PRIOR
    steps = F.split("template", "/")
    ends = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    # A branch is known by its depth and the hash of its steps, so that deep paths are not spelt out at each level.
    hashes = F.transform(steps, lambda s, i: F.xxhash64(F.slice(steps, F.lit(1), i + 1)))
    branches = ends.withColumn("domain", domain_of(F.col("host"))).select("*", F.posexplode(hashes).alias("k", "branch"))
    own = branches.groupBy("domain", "host", "k", "branch").agg(F.sum("labelled").alias("hl"), F.sum("bad").alias("hb"))
    own = written_out(own, "url-branches")
    wide = own.groupBy("domain", "k", "branch").agg(F.sum("hl").alias("dl"), F.sum("hb").alias("db"))
    counted = own.join(wide, ["domain", "k", "branch"]).select("host", "k", "branch", "dl", "db", "hl", "hb")
    # A row per template with as many numbers as its path has levels.
    chain = branches.select("host", "template", "k", "branch").join(counted, ["host", "k", "branch"]).groupBy("host", "template")
    levels = chain.agg(F.array_sort(F.collect_list(F.struct("k", "dl", "db", "hl", "hb"))).alias("c"))

    def smoothed(prior: Column, bad: Column, labels: Column) -> Column:
        return (bad + STRENGTH * prior) / (labels + STRENGTH)

    share = F.aggregate("c", F.lit(float(whole)), lambda p, x: smoothed(smoothed(p, x["db"], x["dl"]), x["hb"], x["hl"]))
    return levels.select("host", "template", share.alias("share"))


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], page: str = "page_id", url: str = "url", back_off: bool = True
) -> DataFrame:
    """Every page with host, path, the rule that fits (or null), template, share and verdict.

    The rules' verdicts are the labels from which the templates learn, over paths of any depth. With
    ``back_off`` a template without labels of its own learns from its parent branches, its registered domain
    and all labels (``backed_off``); else from its own alone, around ``PRIOR``. A null url or
    one without ``://`` has an empty host and path and is judged like any other. Repeated rows stay;
    only ``page`` and ``url`` are read, so other columns may have any name. An empty table gives none.
    """
    rows = pages.select(F.col(page).alias("page"), F.col(url).alias("u")).select(
        "page", F.coalesce(host_of(F.col("u")), F.lit("")).alias("host"), F.coalesce(path_of(F.col("u")), F.lit("")).alias("path")
    )
    ruled = rows.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    bad = F.when(F.col("fit").isNotNull(), (F.col("fit.verdict") == "block").cast("int"))
    tree = templates(ruled.select("host", "path", bad.alias("bad")))
    if back_off:
        shares = backed_off(tree.select("host", "template", "labelled", "bad"))
        verdict = F.when(F.col("share") >= REJECT, "block").otherwise("allow")
        tree = tree.select("host", "template", "segments").join(shares, ["host", "template"]).withColumn("verdict", verdict)
    leaf = tree.select(
        F.col("host").alias("h"), F.col("segments").alias("s"), "template", "share", F.col("verdict").alias("method")
    )
    at = ruled.withColumn("segments", _segments(F.col("path")))
    return at.join(leaf, (at.host == leaf.h) & (at.segments == leaf.s), "left").select(
        F.col("page").alias(page),
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.col("method")).alias("verdict"),
        "template",
        "share",
    )
