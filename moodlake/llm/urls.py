"""URL filter by a tree of path templates per host, with rules on top.

Paths become templates: a segment whose shape is variable (numbers, hashes, dates, ids) is a
wildcard at once; further segments become wildcards where a child's labels do not differ, by a
test of two shares, from those of its siblings, or where a child has no labels and its node of
the tree has too many different children, or at least two labelled ones that are all alike. A template is rejected when the smoothed share of blocked pages among
its labelled ones is high. All steps are aggregates and joins on (host, template), so a host
that holds a third of all pages is counted in every task before anything is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import settle

DEPTH = 4
BRANCHES = 20
SIMILAR_Z = 1.64
SMOOTHING = 4.0
PURITY = 0.8
#: One in so many pages that a rule decides is kept from the tree, to measure it.
HELD_OUT = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules that the query is given.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path; both empty for a null url or one without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def match_rule(host: Column, path: Column, rules: tuple[Rule, ...], field: str) -> Column:
    """``field`` of the longest rule that fits the host or a parent of it and starts the path."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, field))).otherwise(out)
    return out


def segments(path: Column) -> Column:
    """The path's segments with variable shapes as wildcards; a file's ending is kept."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")

    def shape(s: Column) -> Column:
        end = F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
        stem = F.substring(s, F.lit(1), F.length(s) - F.length(end))
        number = stem.rlike(r"^[0-9][0-9._-]*$")
        code = stem.rlike(r"^[0-9a-fA-F-]{8,}$") & stem.rlike("[0-9]")
        mixed = (F.length(stem) >= 6) & (F.length(F.regexp_replace(stem, "[^0-9]", "")) * 2 >= F.length(stem))
        return F.when(number | code | mixed | (F.length(stem) > 40), F.concat(F.lit("*"), end)).otherwise(s)

    return F.transform(parts, shape)


def templates(paths: DataFrame, depth: int = DEPTH, branches: int = BRANCHES) -> DataFrame:
    """Template and labelled counts of each ``(host, shape)``, level by level down the tree.

    ``paths`` has ``host``, ``shape``, ``n`` (labelled pages) and ``bad`` (blocked ones). Segments
    deeper than ``depth`` are one wildcard. More than ``branches`` children of a node make those
    without labels a wildcard. Returns ``paths`` with ``template``.
    """
    parts = F.filter(F.split("shape", "/"), lambda s: s != "")
    now = paths.withColumn("parts", parts).withColumn("template", F.lit(""))
    for level in range(depth):
        now = now.withColumn("child", F.get("parts", F.lit(level)))
        node = now.filter("child is not null").groupBy("host", "template", "child").agg(F.sum("n").alias("cn"), F.sum("bad").alias("cb"))
        node = settle(node, "url-nodes")
        above = node.groupBy("host", "template").agg(F.count("*").alias("many"), F.sum("cn").alias("pn"), F.sum("cb").alias("pb"))
        both = node.join(above, ["host", "template"])
        others, rest = F.col("pn") - F.col("cn"), F.col("pb") - F.col("cb")
        share = F.try_divide("pb", "pn")
        spread = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (F.try_divide(F.lit(1), "cn") + F.try_divide(F.lit(1), others)))
        z = F.abs(F.try_divide("cb", "cn") - F.try_divide(rest, others)) / spread
        similar = (F.col("cn") > 0) & (others > 0) & (z < SIMILAR_Z)
        both = both.withColumn("alike", F.coalesce(similar, F.lit(False)))
        agreed = both.filter("cn > 0").groupBy("host", "template").agg(F.every("alike").alias("agree"), F.count("*").alias("labelled"))
        both = both.join(agreed, ["host", "template"], "left")
        # However many children there are, a labelled one that is not like its siblings stays apart.
        # One without labels goes with its siblings only where the labelled ones do not differ.
        carried = F.coalesce(F.col("agree") & (F.col("labelled") > 1), F.lit(False)) | (F.col("many") > branches)
        merged = F.col("alike") | ((F.col("cn") == 0) & carried)
        step = both.select("host", "template", "child", F.when(merged, F.lit("*")).otherwise(F.col("child")).alias("step"))
        now = now.join(step, ["host", "template", "child"], "left")
        now = now.withColumn("template", F.when(F.col("step").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "step")))
        now = settle(now.drop("child", "step"), "url-templates")
    deeper = F.when(F.size("parts") > depth, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return now.withColumn("template", deeper).drop("parts")


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, labels: DataFrame | None = None, url: str = "url", id_col: str = "page_id",
    depth: int = DEPTH, branches: int = BRANCHES, held_out: int = HELD_OUT,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity, learned, held_out)``, one row per row of ``pages``.

    ``labels`` has ``page_id`` and ``blocked`` (boolean); without it the pages that a rule decides
    are the labelled ones, but for those whose crc32(page_id as text) is divisible by ``held_out``
    (0: none), which show how the tree judges pages it has not seen: ``learned`` is its own
    verdict on every page, ``verdict`` the rule's, else ``learned``. Purity is the smoothed share of blocked among labelled pages of the
    template; a template without labels has the overall share, held under the threshold, so
    it is allowed. Repeated labels of a page count once each.
    """
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", match_rule(F.col("host"), F.col("path"), rules, "name"))
    rows = rows.withColumn("ruled", match_rule(F.col("host"), F.col("path"), rules, "verdict"))
    rows = rows.withColumn("shape", F.array_join(segments(F.col("path")), "/"))
    kept = F.lit(False)
    if labels is None and held_out:
        kept = F.col("rule").isNotNull() & (F.crc32(F.col("page_id").cast("string")) % held_out == 0)
    rows = rows.withColumn("held_out", F.coalesce(kept, F.lit(False)))
    if labels is None:
        marked = rows.select("host", "shape", F.when(~F.col("held_out"), F.col("ruled") == "block").alias("blocked"))
    else:
        known = labels.select(F.col("page_id").alias("_id"), "blocked")
        marked = rows.join(known, F.col("page_id") == F.col("_id"), "left").select("host", "shape", "blocked")
    bad = F.sum(F.when(F.col("blocked"), 1).otherwise(0)).cast("long")
    shapes = marked.groupBy("host", "shape").agg(F.count("blocked").alias("n"), bad.alias("bad"))
    tree = templates(settle(shapes, "url-shapes"), depth, branches)
    known = tree.groupBy("host", "template").agg(F.sum("n").alias("tn"), F.sum("bad").alias("tb"))
    total = known.agg(F.sum("tn"), F.sum("tb")).first()
    prior = min((total[1] or 0) / total[0] if total[0] else 0.0, PURITY / 2)
    known = known.withColumn("purity", (F.col("tb") + SMOOTHING * prior) / (F.col("tn") + SMOOTHING))
    verdicts = settle(tree.join(known, ["host", "template"]).select("host", "shape", "template", "purity"), "url-verdicts")
    judged = rows.join(verdicts, ["host", "shape"], "left")
    own = F.when(F.col("purity") >= PURITY, "block").otherwise("allow")
    verdict = F.coalesce("ruled", own).alias("verdict")
    return judged.select("page_id", "host", "path", "rule", verdict, "template", "purity", own.alias("learned"), "held_out")
