"""URL filter by a tree of path templates per host.

A path's segments are followed from the root. At each node of a host's tree the labelled segments that are
blocked at a rate differing beyond chance from the node's stay literal, as does the only labelled one; all
others fall together in a wildcard. A segment without labels is judged by its labelled siblings, each of
which is one vote however many pages it has, so a few large branches do not decide for others. Merged
branches of one shape are judged by their labelled pages. A page is rejected when the lowest of these
smoothed shares of blocked is high. Explicit rules come first and supply the labels. Equal addresses count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.session import stored

#: Levels of the tree that are always followed, and deeper ones as long as a node has pages with and without labels.
#: Segments below that, whose pages are all labelled or all not, fall together in one last wildcard.
DEPTH = 4
#: Standard errors by which a segment or branch may differ from its siblings and still be merged with them.
CHANCE = 2.0
#: Votes or pages of prior belief (at the share of all labelled addresses), and the purity from which on a page is rejected.
PRIOR_PAGES, REJECT = 5.0, 0.9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
WILD, REST = "*", "**"


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule ``host/path prefix`` that fits, NULL when none does.

    A rule fits its host and all below it, where the path starts with the rule's from its first slash on.
    """
    fits = []
    for rule in sorted(set(rules), key=lambda r: (-len(r), r)):
        name, _, rest = rule.partition("/")
        own = (host == name) | host.endswith(f".{name}")
        fits.append(F.when(own & path.startswith(f"/{rest}"), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def _labels() -> list[Column]:
    return [F.count("given").alias("labelled"), F.count(F.when(F.col("given") == "block", 1)).alias("blocked")]


def _alike(labelled: Column, blocked: Column, rate: Column) -> Column:
    spread = F.sqrt(F.greatest(rate * (1 - rate), F.lit(0.01)) / labelled)
    return F.abs(blocked / labelled - rate) <= CHANCE * spread


def _smoothed(blocked: Column, of: Column, prior: float) -> Column:
    return (blocked + PRIOR_PAGES * prior) / (of + PRIOR_PAGES)


def _judged(here: DataFrame, prior: float) -> DataFrame:
    """``host, template, segment, literal, segment_belief`` of the segments of nodes with labels; the belief only of those without."""
    counts = here.groupBy("host", "template", "segment").agg(*_labels())
    nodes = counts.where("labelled > 0").groupBy("host", "template").agg(
        F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"),
        F.count("*").alias("voters"), F.sum(F.col("blocked") / F.col("labelled")).alias("votes"),
    )
    rate = F.col("all_blocked") / F.col("all_labelled")
    known = F.col("labelled") > 0
    literal = F.when(known, (F.col("voters") == 1) | ~_alike(F.col("labelled"), F.col("blocked"), rate)).otherwise(False)
    return counts.join(nodes, ["host", "template"]).select(
        "host", "template", "segment", literal.alias("literal"),
        F.when(~known, _smoothed(F.col("votes"), F.col("voters"), prior)).alias("segment_belief"),
    )


def _open(here: DataFrame, level: int) -> bool:
    """Whether a node has pages with and without labels, and one that goes on below ``level`` segments."""
    nodes = here.groupBy("host", "template").agg(
        F.count("given").alias("labelled"), F.count("*").alias("n"), F.max(F.size("segments")).alias("longest")
    )
    return not nodes.where((F.col("labelled") > 0) & (F.col("labelled") < F.col("n")) & (F.col("longest") > level)).isEmpty()


def _templates(addresses: DataFrame, prior: float) -> DataFrame:
    """Add ``template``, the path with its variable segments as wildcards, and ``belief``, the least of the path's segments.

    ``addresses`` is ``host, segments, given`` and further columns, with a row per address.
    """
    now = addresses.withColumns({"template": F.lit(""), "belief": F.lit(None).cast("double")})
    level = 0
    while True:
        # the end of a path is a segment too, an empty one
        here = stored(now.withColumn("segment", F.coalesce(F.get("segments", F.lit(level)), F.lit(""))), "url-level")
        if level >= DEPTH and not _open(here, level):
            break
        step = F.concat(F.lit("/"), F.when(F.col("literal"), F.col("segment")).otherwise(F.lit(WILD)))
        now = here.join(_judged(here, prior), ["host", "template", "segment"], "left").withColumns({
            "template": F.concat("template", F.when(F.col("segment") == "", F.lit("")).otherwise(step)),
            "belief": F.least("belief", "segment_belief"),
        }).drop("segment", "literal", "segment_belief")
        level += 1
    deeper = F.when(F.size("segments") > level, F.lit(f"/{REST}")).otherwise(F.lit(""))
    return here.drop("segment").withColumn("template", F.concat("template", deeper))


def _merged(branches: DataFrame) -> DataFrame:
    """``host, template, branch``: sibling templates that differ in one segment and alike in labels get one branch name.

    ``branches`` is ``host, template, labelled, blocked`` and has a row per template.
    """
    now = stored(branches.withColumn("branch", F.col("template")), "url-branch-level")
    depth = now.agg(F.max(F.size(F.split("template", "/")) - 1).alias("depth")).first()["depth"]
    for level in range(depth or 0):
        parts = F.split("branch", "/")
        shape = F.array_join(F.transform(parts, lambda s, k: F.when(k == level + 1, F.lit("?")).otherwise(s)), "/")
        literal = (F.size(parts) > level + 1) & ~F.coalesce(F.get(parts, F.lit(level + 1)), F.lit(WILD)).isin(WILD, REST)
        here = now.withColumn("shape", F.when(literal, shape))
        pool = here.where("shape IS NOT NULL AND labelled > 0").groupBy("host", "shape").agg(
            F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"), F.countDistinct("branch").alias("siblings")
        )
        rate = F.col("all_blocked") / F.col("all_labelled")
        alike = (F.col("siblings") > 1) & (F.col("labelled") > 0) & _alike(F.col("labelled"), F.col("blocked"), rate)
        now = here.join(pool, ["host", "shape"], "left").select(
            "host", "template", "labelled", "blocked", F.when(alike, F.col("shape")).otherwise(F.col("branch")).alias("branch")
        )
        now = stored(now, "url-branch-level")  # read twice by each level
    return now


def judge(df: DataFrame, rules: dict[str, str], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for each row.

    ``rules`` maps rules to ``allow`` or ``block``; it is part of the plan, so it should stay a short list.
    Where a rule fits, its verdict holds; else ``block`` when ``purity`` reaches ``REJECT``: the least of the
    smoothed shares of blocked among the labelled pages of the page's merged template and, for each segment
    of it without labels, among the votes of its labelled siblings. Pages with neither have the prior share
    and, as that is mixed, are allowed unless all labels are ``block``. NULL urls and those
    without ``://`` have an empty host and path, no rule, and are allowed. Equal rows get equal results.
    """
    address = F.col(f"`{url}`")
    verdicts = F.create_map(*[F.lit(x) for rule in rules.items() for x in rule]) if rules else None
    pages = df.select(F.col(f"`{page_id}`").alias("page_id"), host(address).alias("host"), path(address).alias("path"))
    pages = pages.withColumn("rule", rule_for(F.col("host"), F.col("path"), list(rules)))
    given = F.lit(None).cast("string") if verdicts is None else F.when(F.col("rule").isNotNull(), verdicts[F.col("rule")])
    pages = pages.withColumn("given", given)
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    addresses = pages.select("host", "path", "given").distinct().withColumn("segments", segments)
    share = addresses.agg(*_labels()).select(((F.col("blocked") + 1) / (F.col("labelled") + 2)).alias("share")).first()["share"]
    placed = stored(_templates(addresses, share).drop("segments"), "url-templates")

    merged = _merged(placed.groupBy("host", "template").agg(*_labels()))
    pure = merged.groupBy("host", "branch").agg(
        F.when(F.sum("labelled") > 0, _smoothed(F.sum("blocked"), F.sum("labelled"), share)).alias("purity")
    )
    branches = merged.join(pure, ["host", "branch"]).select("host", "template", "purity")
    purity = F.coalesce(F.least("belief", "purity"), F.lit(share))
    learned = placed.join(branches, ["host", "template"], "left").select("host", "path", "template", purity.alias("purity"))
    verdict = F.coalesce(
        "given", F.when((F.col("purity") >= REJECT) & (F.col("host") != ""), F.lit("block")).otherwise(F.lit("allow"))
    )
    return pages.join(learned, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )
