"""URL filter: explicit rules first, then a path-template tree per host.

DataFrame operations only. Each distinct (host, path) is cut into segments;
a segment that is plainly variable (digits, a long hex string, a date, each
with an optional file suffix) becomes a typed wildcard at once. The tree of a
host is grown from the root, a round for each depth at which paths part:

* generalise: a child is rare if it has at most ``rare`` urls, or
  ``rare_share`` of its prefix's; below a prefix with at least ``min_fan`` rare
  children those become ``*``, while frequent ones keep their names. Segments
  that all paths of a prefix share are passed in one step, and a prefix of
  fewer than ``min_fan`` paths keeps them as they are, so no depth is fixed;
* merge: from the deepest siblings up, sibling branches that lead to the same
  templates become one branch ``{~}``, if each one's smoothed share of blocked
  labels is within ``merge_z`` standard errors of that of all together. Branches
  without labels carry no evidence of being similar and keep to themselves;
* reject: purity is smoothed along the tree. A labelled branch has the share
  (blocked + prior * weight) / (labelled + weight). What a prefix tells of a
  branch not seen before is the mean of its labelled branches' shares (a merged one counts
  as often as it has names), drawn by ``weight`` to what its own prefix tells, and so on up to the
  host's root, which is drawn to ``prior``. So one blocked branch doesn't condemn its siblings, and many do. A template's
  purity is that of its own labels, drawn by ``weight`` to what its prefix tells. It is
  rejected where that reaches ``purity`` and the level that carries the evidence
  (the template, or the nearest prefix with labels) has ``min_labels`` of them.

Labels are the urls that explicit rules judge; a caller may add his own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
MAX_RULES = 2000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as the contract cuts them; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fitting rule, or nulls. At most ``MAX_RULES``: they become one expression."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict)):  # the last one tested wins
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def shape(segment: Column) -> Column:
    """A typed wildcard for a segment that is plainly variable, else the segment."""
    suffix = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return (
        F.when(stem.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.concat(F.lit("{date}"), suffix))
        .when(stem.rlike(r"^[0-9]+$"), F.concat(F.lit("{num}"), suffix))
        .when(stem.rlike(r"^[0-9a-fA-F-]{16,}$"), F.concat(F.lit("{hex}"), suffix))
        .otherwise(segment)
    )


def _spread(left: DataFrame, right: DataFrame, on: list[str], by: list[str], salt: int) -> DataFrame:
    """Left join of rows to what a prefix says, one hot host's rows dealt over ``salt`` copies of it."""
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    left = left.withColumn("__salt", F.pmod(F.xxhash64(*by), F.lit(salt)).cast("int"))
    return left.join(right, [*on, "__salt"], "left").drop("__salt")


def _tail(segments: Column, skip: Column) -> Column:
    return F.slice(segments, skip + 1, F.greatest(F.size(segments) - skip, F.lit(0)))


def grow(pages: DataFrame, min_fan: int, rare: int, rare_share: float, salt: int) -> DataFrame:
    """(host, raw, bad, good, template): each distinct shaped path of a host with the segments of its template.

    ``pages``: (host, raw array of segments, bad, good), one row per url.
    """
    node = pages.groupBy("host", "raw").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.any_value("raw").alias("rest"))
    # rest comes of an aggregate, since the optimizer would carry what ties it to raw through all rounds
    node = cut(node.withColumn("template", F.array().cast("array<string>")))
    kept, done = ["host", "raw", "n", "bad", "good", "template"], []
    while True:
        done.append(node.where(F.size("rest") == 0).select(*kept))
        node = node.where(F.size("rest") > 0)
        if node.isEmpty():
            break
        # all paths of a prefix share what the first and the last of them share
        ends = node.groupBy("host", "template").agg(F.count(F.lit(1)).alias("paths"), F.min("rest").alias("lo"), F.max("rest").alias("hi")).where(F.col("paths") >= min_fan)
        least = F.least(F.size("lo"), F.size("hi"))
        parts = F.filter(F.sequence(F.lit(1), least), lambda i: F.element_at("lo", i) != F.element_at("hi", i))
        shared = ends.select("host", "template", F.when(F.size(parts) > 0, parts[0] - 1).otherwise(least).alias("skip"))
        node = _spread(node, shared, ["host", "template"], ["raw"], salt)
        skip = F.coalesce("skip", F.size("rest"))
        node = cut(node.select("host", "raw", "n", "bad", "good", F.concat("template", F.slice("rest", F.lit(1), skip)).alias("template"), _tail(F.col("rest"), skip).alias("rest")), again=True)
        done.append(node.where(F.size("rest") == 0).select(*kept))
        node = node.where(F.size("rest") > 0).withColumn("seg", F.element_at("rest", 1))
        child = node.groupBy("host", "template", "seg").agg(F.sum("n").alias("times"))
        urls = child.groupBy("host", "template").agg(F.sum("times").alias("urls"))
        few = _spread(child, urls, ["host", "template"], ["seg"], salt).where(F.col("times") <= F.greatest(F.lit(rare), F.col("urls") * rare_share))
        fan = few.groupBy("host", "template").agg(F.count(F.lit(1)).alias("fan")).where(F.col("fan") >= min_fan)
        wide = _spread(few.select("host", "template", "seg"), fan, ["host", "template"], ["seg"], salt).where("fan is not null").select("host", "template", "seg", F.lit(True).alias("wide"))
        node = node.join(wide, ["host", "template", "seg"], "left")
        step = F.array(F.when(F.col("wide"), F.lit("*")).otherwise(F.col("seg")))
        node = cut(node.select("host", "raw", "n", "bad", "good", F.concat("template", step).alias("template"), _tail(F.col("rest"), F.lit(1)).alias("rest")), again=True)
    return reduce(DataFrame.union, done).drop("n")


def _plain(segment: Column) -> Column:
    return ~segment.startswith("{") & (segment != "*")


def merge(node: DataFrame, merge_z: float, salt: int) -> DataFrame:
    """The same rows, with alike branches under one name, and the template as it ``was``.

    Under one prefix at most 1 / ``rare_share`` children and ``min_fan`` more keep names, so no group of siblings is larger.
    """
    found = cut(node.groupBy("host", "template").agg(F.sum("bad").alias("b"), F.sum(F.col("bad") + F.col("good")).alias("m")).where("m > 0").withColumn("was", F.col("template")))
    at = None
    while True:
        hole = found.select("host", "template", F.posexplode("template").alias("i", "seg")).where(_plain(F.col("seg")))
        hole = hole if at is None else hole.where(F.col("i") < at)
        sides = [F.xxhash64(F.slice("template", F.lit(1), F.col("i"))).alias("left"), F.xxhash64(_tail(F.col("template"), F.col("i") + 1)).alias("right")]
        at = hole.groupBy("host", "i", *sides).agg(F.min("seg").alias("a"), F.max("seg").alias("z")).where("a <> z").agg(F.max("i")).first()[0]
        if at is None:
            break
        i = F.lit(at)
        here = found.where(F.size("template") > at).withColumn("seg", F.element_at("template", at + 1)).where(_plain(F.col("seg")))
        stat = here.groupBy("host", "seg", F.slice("template", F.lit(1), i).alias("left"), _tail(F.col("template"), i + 1).alias("right")).agg(F.sum("b").alias("b"), F.sum("m").alias("m"))
        every = Window.partitionBy("host", "left", "right")
        pool = (F.sum("b").over(every) + 0.5) / (F.sum("m").over(every) + 1)
        stat = stat.withColumn("pool", pool).where(F.abs((F.col("b") + 0.5) / (F.col("m") + 1) - F.col("pool")) <= merge_z * F.sqrt(F.col("pool") * (1 - F.col("pool")) / F.col("m")))
        alike = stat.withColumn("k", F.count(F.lit(1)).over(every)).where("k > 1")
        alike = alike.select("host", F.concat("left", F.array("seg"), "right").alias("template"), F.concat("left", F.array(F.lit("{~}")), "right").alias("to"))
        found = cut(found.join(alike, ["host", "template"], "left").select("host", F.coalesce("to", "template").alias("template"), "b", "m", "was"), again=True)
    changed = found.where("template <> was").select("host", F.col("was").alias("template"), F.col("template").alias("to"))
    return _spread(node, changed, ["host", "template"], ["raw"], salt).select("host", "raw", "bad", "good", F.coalesce("to", "template").alias("template"), F.col("template").alias("was"))


def purities(node: DataFrame, prior: float, weight: float, salt: int) -> DataFrame:
    """(host, template, blocked_share, labels): the smoothed purity of each template, and how many labels the level has that carries it."""
    share = lambda b, m: (F.col(b) + prior * weight) / (F.col(m) + weight)
    each = cut(node.groupBy("host", "template", "was").agg(F.sum("bad").alias("b"), F.sum(F.col("bad") + F.col("good")).alias("m")))
    own = each.groupBy("host", "template").agg(F.sum("b").alias("b"), F.sum("m").alias("m"))
    prefix = lambda depth: [F.xxhash64(F.lit(seed), F.slice("template", F.lit(1), depth)).alias(k) for k, seed in (("p1", 1), ("p2", 2))]
    branch = each.where("m > 0").select("host", "b", "m", "template", "was", F.explode(F.sequence(F.lit(1), F.size("template"))).alias("depth")).where(F.size("template") > 0)
    above = [c.alias(f"above{i}") for i, c in enumerate(prefix(F.col("depth") - 1))]
    branch = branch.groupBy("host", "depth", *prefix(F.col("depth")), *above).agg(F.sum("b").alias("b"), F.sum("m").alias("m"), F.size(F.collect_set(F.element_at("was", F.col("depth")))).alias("names"))
    # decimals, so that no order of adding shows
    told = branch.groupBy("host", (F.col("depth") - 1).alias("depth"), F.col("above0").alias("p1"), F.col("above1").alias("p2")).agg(
        F.sum(share("b", "m").cast("decimal(18,12)") * F.col("names")).alias("shares"), F.sum("names").alias("branches"), F.sum("m").alias("labels")
    )
    up = own.select("host", "template", F.explode(F.sequence(F.lit(0), F.greatest(F.size("template") - 1, F.lit(0)))).alias("depth"))
    up = _spread(up.select("host", "template", "depth", *prefix(F.col("depth"))), told, ["host", "depth", "p1", "p2"], ["template"], salt).where("branches is not null")
    up = up.groupBy("host", "template").agg(F.sort_array(F.collect_list(F.struct("depth", F.col("shares").cast("double").alias("shares"), "branches", "labels"))).alias("up"))
    told_of = F.aggregate(F.coalesce("up", F.array().cast("array<struct<depth:int,shares:double,branches:bigint,labels:bigint>>")), F.lit(prior), lambda p, x: (x["shares"] + p * weight) / (x["branches"] + weight))
    known = own.join(up, ["host", "template"], "left").select(
        "host", "template", ((F.col("b") + told_of * weight) / (F.col("m") + weight)).alias("blocked_share"), F.when(F.col("m") > 0, F.col("m")).otherwise(F.coalesce(F.element_at("up", -1)["labels"], F.lit(0))).alias("labels")
    )
    return known


def url_filter(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[Rule] = RULES, label_col: str | None = None,
    min_fan: int = 20, rare: int = 3, rare_share: float = 0.001, merge_z: float = 2.0, purity: float = 0.8, prior: float = 0.5, weight: float = 2.0, min_labels: int = 5, salt: int = 16,
) -> DataFrame:
    """(id, host, path, rule, verdict, template, blocked_share, labels), one row per input row.

    The longest fitting rule decides; else the url's template does, and a url
    of whose host no label is known is allowed. ``label_col``: a column of
    ``pages`` with 1 for bad, 0 for good, null for unknown, which adds to
    the labels. Null urls, and those without ``://``, have an empty host and
    path, no rule, and are allowed; an empty host makes no template.
    Repeated rows and equal ids are judged each by itself; an empty table gives
    an empty result. A host with a third of all urls is one group only in sums
    that are combined before the shuffle; its rows meet what its prefixes tell,
    and their templates, on a salt as well.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), (F.col(label_col) if label_col else F.lit(None)).cast("int").alias("known"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    label = F.coalesce(F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0), F.col("known"))
    raw = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), shape)
    rows = rows.withColumns({"rule": text, "ruled": verdict}).withColumns({
        "raw": raw, "bad": F.coalesce((label == 1).cast("long"), F.lit(0)), "good": F.coalesce((label == 0).cast("long"), F.lit(0)),
    })
    node = cut(merge(grow(rows.where("host <> ''").select("host", "raw", "bad", "good"), min_fan, rare, rare_share, salt), merge_z, salt))
    known = _spread(node.select("host", "raw", "template"), purities(node, prior, weight, salt), ["host", "template"], ["raw"], salt)
    known = known.withColumn("template", F.concat_ws("/", F.when(F.size("template") > 0, F.lit("")), "template"))
    out = _spread(rows, known, ["host", "raw"], ["id"], salt)
    rejected = (F.col("blocked_share") >= purity) & (F.col("labels") >= min_labels)
    return out.select(
        "id", "host", "path", "rule", F.coalesce(F.col("ruled"), F.when(rejected, "block").otherwise("allow")).alias("verdict"), "template", "blocked_share", "labels"
    )
