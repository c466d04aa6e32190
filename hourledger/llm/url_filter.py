"""URL filter by path-template trees, one per host.

A tree is grown level by level for all hosts at once, as deep as paths go. At a node, a segment that
holds a fair share of the node's pages stays as it is; the others are variable and become wildcards
by shape, digits and letters. A node that pages of one path only reach is not grown further: what is
left of the path is taken at once, so there are as many levels as different paths share. Siblings under one parent are then merged while their labelled shares are statistically
alike, and a template is rejected if the smoothed share of bad labels along its path is high.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourledger.operators.reduced import join_reduced
from hourledger.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A segment with at least this share of its node's pages is not variable.
LITERAL_SHARE = 0.05
#: Stands for the parent of a host's root; every node but the root begins with a slash.
ROOT = "root"
#: Siblings whose shares differ by less than so many standard errors are merged.
ALIKE = 1.96
#: Labels that the prior share of bad pages counts as.
PRIOR_WEIGHT = 4.0
REJECT_FROM = 0.5


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def rule_match(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest (verdict, host, path) rule that fits, as a struct, or null. Rules are configuration."""
    result = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        result = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(result)
    return result


def shape(segment: Column) -> Column:
    """A variable segment's wildcard: runs of digits and of letters by kind, an extension kept."""
    extension = F.regexp_extract(segment, r"\.\p{L}{1,4}$", 0)
    stem = F.substring(segment, F.lit(1), F.length(segment) - F.length(extension))
    # Marks first, since the wildcards have letters themselves.
    marked = F.regexp_replace(F.regexp_replace(stem, r"\p{L}+", "\x01"), r"\d+", "\x02")
    return F.concat(F.replace(F.replace(marked, F.lit("\x01"), F.lit("{w}")), F.lit("\x02"), F.lit("{n}")), extension)


def templates(pages: DataFrame) -> DataFrame:
    """`pages` (host, path, ...) with each page's template."""
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    rows = pages.withColumn("__segments", segments).withColumn("template", F.lit("")).withColumn("__open", F.lit(True))
    shared_dir(pages.sparkSession)
    rows = rows.checkpoint()
    level = 0
    while (rows.agg(F.max(F.when(F.col("__open"), F.size("__segments")))).first()[0] or 0) > level:
        segment = F.get("__segments", F.lit(level))
        rows = rows.withColumn("__segment", F.when(F.col("__open"), segment))
        counts = rows.where("__segment is not null").groupBy("host", "template", "__segment")
        counts = counts.agg(F.count("*").alias("__n"), (F.min("path") == F.max("path")).alias("__one"))
        nodes = counts.groupBy("host", "template").agg(F.sum("__n").alias("__all"))
        # Every node's frequent segments, at most 1 / LITERAL_SHARE rows a node, and the nodes of one page.
        literal = F.col("__n") >= F.greatest(F.lit(2), F.col("__all") * LITERAL_SHARE)
        told = join_reduced(counts, nodes, ["host", "template"]).where(literal | (F.col("__all") == 1))
        told = told.select("host", "template", "__segment", literal.alias("__literal"), F.when(literal, F.col("__one")).otherwise(True).alias("__last"))
        rows = join_reduced(rows, told, ["host", "template", "__segment"])
        left = F.slice("__segments", level + 1, F.size("__segments"))
        spelt = lambda x: F.when(F.col("__literal"), x).otherwise(shape(x))
        step = F.when(F.col("__last"), F.array_join(F.transform(left, spelt), "/")).otherwise(spelt(F.col("__segment")))
        grown = F.when(F.col("__segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), step))
        still = F.col("__segment").isNotNull() & ~F.coalesce("__last", F.lit(False))
        # The next level reads the rows twice; without a cut each level would double the work.
        rows = rows.withColumn("template", grown).withColumn("__open", still).drop("__literal", "__last").checkpoint()
        level += 1
    return rows.drop("__segments", "__segment", "__open")


def mark_branches(nodes: DataFrame) -> DataFrame:
    """`nodes` (host, parent, node, end, share, n, bad) with the number of each node's branch among its siblings.

    Siblings are visited in the order of their shares, in one pass. A node joins the branch before it only
    if it is statistically alike with the branch's pooled labels and with its members, of which those
    without a lower one of as many labels are compared; else it begins a branch.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, branch, n, bad, low = None, 0, 0, 0, []
        for batch in batches:
            numbers = []
            columns = [batch.column(c).to_pylist() for c in ("host", "parent", "share", "n", "bad", "prior")]
            for host, parent, share, own_n, own_bad, prior in zip(*columns, strict=True):
                if (host, parent) != family:
                    family, branch, n, bad, low = (host, parent), 0, 0, 0, []
                pooled = ((bad + PRIOR_WEIGHT * prior) / (n + PRIOR_WEIGHT), n)
                if low and any(apart(share, own_n, *other) for other in (pooled, *low)):
                    branch, n, bad, low = branch + 1, 0, 0, []
                n, bad = n + own_n, bad + own_bad
                if not low or own_n > low[-1][1]:
                    low.append((share, own_n))
                numbers.append(branch)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(numbers, pa.int64())], [*kept, "branch"])

    kept = ["host", "parent", "node", "end", "n", "bad"]
    schema = T.StructType([nodes.schema[c] for c in kept]).add("branch", T.LongType())
    return nodes.repartition("host", "parent").sortWithinPartitions("host", "parent", "share", "node", "end").mapInArrow(mark, schema)


def apart(share: float, n: int, share0: float, n0: int) -> bool:
    """Whether two smoothed shares differ by more than chance explains."""
    w, w0 = n + PRIOR_WEIGHT, n0 + PRIOR_WEIGHT
    pooled = (share * w + share0 * w0) / (w + w0)
    return abs(share - share0) > ALIKE * (pooled * (1 - pooled) * (1 / w + 1 / w0)) ** 0.5


def branches(labelled: DataFrame) -> DataFrame:
    """host, template, n, bad and the smoothed share of bad labels of every template.

    `labelled` holds host, template and bad (boolean or null) of each page. Every prefix of a template is
    a node of its host's tree; where pages end at a node that others pass, these pages are a child of
    their own. Labelled siblings that are alike are one branch. A template's share starts from that of
    all labels and is led down its path: each level adds the labels of its branch that are not in the
    next one, so every label counts once and templates with few labels lean on those nearest to them.
    """
    shared_dir(labelled.sparkSession)
    leaves = labelled.groupBy("host", "template").agg(F.count("bad").alias("n"), F.count_if("bad").alias("bad")).checkpoint()
    total = leaves.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    prior = ((total.bad or 0) + 1) / ((total.n or 0) + 2)
    parts = F.split("template", "/")
    levels = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(k.alias("level"), F.array_join(F.slice(parts, 1, k), "/").alias("node")))
    paths = leaves.select("host", "template", "n", "bad", F.inline(levels))
    here = F.col("node") == F.col("template")
    counted = paths.groupBy("host", "node").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), (F.bool_or(here) & F.bool_or(~here)).alias("mixed"),
        F.sum(F.when(here, F.col("n")).otherwise(0)).alias("own_n"), F.sum(F.when(here, F.col("bad")).otherwise(0)).alias("own_bad"),
    )
    # The root has no parent, and no siblings on other hosts.
    above = F.when(F.col("node") == "", ROOT).otherwise(F.regexp_replace("node", "(?s)/[^/]*$", ""))
    whole = F.struct(above.alias("parent"), F.lit(False).alias("end"), F.col("n"), F.col("bad"))
    own = F.struct(F.col("node").alias("parent"), F.lit(True).alias("end"), F.col("own_n").alias("n"), F.col("own_bad").alias("bad"))
    nodes = counted.select("host", "node", F.inline(F.when(F.col("mixed"), F.array(whole, own)).otherwise(F.array(whole)))).where("n > 0")
    share = (F.col("bad") + PRIOR_WEIGHT * prior) / (F.col("n") + PRIOR_WEIGHT)
    marked = mark_branches(nodes.withColumn("share", share).withColumn("prior", F.lit(prior))).checkpoint()
    keys = ["host", "parent", "branch"]
    sums = marked.groupBy(keys).agg(F.sum("n").alias("branch_n"), F.sum("bad").alias("branch_bad"))
    merged = join_reduced(marked, sums, keys).select("host", "node", "end", "branch_n", "branch_bad")
    steps = paths.select("host", "template", "level", "node", F.explode(F.when(here, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("end"))
    step = F.struct("level", "end", "branch_n", "branch_bad")
    led = join_reduced(steps, merged, ["host", "node", "end"]).where("branch_n is not null").groupBy("host", "template").agg(F.array_sort(F.collect_list(step)).alias("steps"))

    def rest(name: str):
        return lambda x, i: x[name] - F.coalesce(F.get("steps", i + 1)[name], F.lit(0))

    only = F.arrays_zip(F.transform("steps", rest("branch_n")).alias("n"), F.transform("steps", rest("branch_bad")).alias("bad"))
    lead = F.aggregate(only, F.lit(prior), lambda s, x: (x["bad"] + PRIOR_WEIGHT * s) / (x["n"] + PRIOR_WEIGHT))
    shares = led.select("host", "template", lead.alias("bad_share"))
    return join_reduced(leaves, shares, ["host", "template"]).withColumn("bad_share", F.coalesce("bad_share", F.lit(prior)))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, template and bad_share.

    `labels` holds the id and a boolean `bad`; pages that it does not name are unlabelled, a page that
    it names more than once is bad if any row says so. A null url, or one without ``://``, has an empty
    host and path. Every row of `pages` gives a row, repeated ones too. Rules beat the trees.
    """
    url = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    known = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max("bad").alias("bad"))
    rows = templates(join_reduced(rows, known, ["id"]))
    verdicts = branches(rows).select("host", "template", "bad_share")
    judged = join_reduced(rows, verdicts, ["host", "template"])
    rule = rule_match(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_share") >= REJECT_FROM, "block").otherwise("allow")
    return judged.withColumn("__rule", rule).select(
        F.col("id").alias(id_col), "host", "path", F.col("__rule.rule").alias("rule"), F.coalesce("__rule.verdict", own).alias("verdict"), "template", "bad_share"
    )
