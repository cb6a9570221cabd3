"""URL filter by path templates.

Rules name a host (with its subdomains) and the start of a path; the longest that fits decides. They also label the pages
they fit, and from these labels a tree of path templates is learned for every host, which decides the other pages:

* segments that hold a digit are variable and become `*`; so do all segments below a node that has many different ones,
  each seen only a few times;
* sibling branches that are mostly blocked, or mostly allowed, and whose share of blocked pages does not differ from that
  of all such siblings by more than chance are merged into one branch (`~block`, `~allow`), so that their evidence adds up;
  branches without labelled pages keep to themselves;
* a template's purity is its share of blocked pages among labelled ones, smoothed by `PRIOR` imaginary pages of which
  `PRIOR_SHARE` are blocked. From `REJECT` on its pages are blocked. Without evidence, pages are allowed.

Literal segments that are empty or begin with `*`, `~` or `=` get a `=` in front, so that none is taken for a wildcard or a
merged branch. All segments of a path count, however many. The tree grows in rounds: a node first takes all segments that
its paths begin with in common, which is one step however many they are, and then branches; rounds end when no path has
segments left, so their number follows how often paths part, not how long they are.

Everything is built-in expressions. Pages are first reduced to counts per host and generalised segments, map-side; a host
with very many pages is a few rows from then on, unless its segments differ, in which case their rows are spread by
segment. Tables that are joined are stored before, so that both sides are plain exchanges and hot keys can be split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import quoted, row_of, stored

#: A node is variable from so many different segments on, each seen this often or less on average.
MANY, SELDOM = 20, 3.0
#: Branches within so many standard deviations of their siblings' purity are merged.
ALIKE = 1.96
PRIOR, PRIOR_SHARE, REJECT = 4.0, 0.2, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def rule_for(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as struct (text, verdict); null if none does."""
    ranked = sorted(rules, key=lambda r: (-len(r.text), r.text))
    return F.coalesce(
        *[F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))) for r in ranked],
        F.lit(None).cast("struct<text:string,verdict:string>"),
    )


def judged(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """`pages` as a struct `row`, with host, path, rule, template, purity and verdict.

    A null url, or one without `://`, has an empty host and path and no rule; equal rows are judged alike; an empty table
    gives an empty result. Extra columns are carried in `row` and never clash.
    """
    parts = pages.select(row_of(pages).alias("row"), F.col(quoted(url)).alias("url")).select(
        "row", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    fitted = parts.select("*", rule_for(rules, F.col("host"), F.col("path")).alias("fit"))
    shaped = fitted.select("row", "host", "path", "fit", shape_of(F.col("path")).alias("shape"))
    counts = stored(
        shaped.groupBy("host", "shape").agg(
            F.count(F.lit(1)).alias("n"),
            F.count("fit").alias("labelled"),
            F.count(F.when(F.col("fit.verdict") == "block", 1)).alias("blocked"),
        ),
        "url-counts",
    )
    verdicts = stored(template_purity(template_tree(counts)).select(
        F.col("host").alias("t_host"), F.col("shape").alias("t_shape"), "template", "purity"
    ), "url-templates")
    same = (F.col("host") == F.col("t_host")) & (F.col("shape") == F.col("t_shape"))
    return shaped.join(verdicts.hint("merge"), same).select(
        "row", "host", "path", F.col("fit.text").alias("rule"), "template", "purity",
        F.coalesce(F.col("fit.verdict"), F.when(F.col("purity") >= REJECT, "block").otherwise("allow")).alias("verdict"),
    )


def shape_of(path: Column) -> Column:
    """The segments of a path, variable ones as `*`; a path without any, or of one slash, has none."""
    steps = F.split(F.regexp_replace(path, "^/", ""), "/")
    odd = ("", "*", "~", "=")
    named = F.transform(
        steps, lambda s: F.when(s.rlike("[0-9]"), "*").when(F.left(s, F.lit(1)).isin(*odd), F.concat(F.lit("="), s)).otherwise(s)
    )
    return F.when(path.isin("", "/"), F.array().cast("array<string>")).otherwise(named)


def mostly_blocked() -> Column:
    return F.col("blocked") * 2 >= F.col("labelled")


def template_tree(counts: DataFrame) -> DataFrame:
    """`counts` (host, shape, n, labelled, blocked) with the template of each row, built from the host down."""
    rows = counts.select("*", F.lit("").alias("template"), F.col("shape").alias("rest"))
    done = []
    while True:
        rows = stored(taken_in_common(rows), "url-chains")
        rows = stored(branched(rows), "url-tree")
        done.append(rows.where("rest IS NULL"))
        rows = rows.where("rest IS NOT NULL")
        if rows.isEmpty():
            break
    found = done[0]
    for more in done[1:]:
        found = found.unionAll(more)
    return found.drop("rest")


def taken_in_common(rows: DataFrame) -> DataFrame:
    """Rows moved down by the segments with which all paths below their node begin.

    These are what the least and the greatest path share. A node with one branch is never variable, and the branch is like
    its siblings, being all there are; so it is merged if any page below it is labelled, and keeps its name otherwise.
    """
    nodes = stored(
        rows.groupBy(F.col("host").alias("n_host"), F.col("template").alias("n_template")).agg(
            F.min("rest").alias("least"), F.max("rest").alias("greatest"), F.sum("labelled").alias("labelled"),
            F.sum("blocked").alias("blocked"),
        ),
        "url-spans",
    )
    parted = F.array_position(F.zip_with("least", "greatest", lambda a, b: a.eqNullSafe(b)), False)
    common = F.when(parted > 0, parted - 1).otherwise(F.size("least")).cast("int")
    label = F.when(F.col("labelled") == 0, None).when(mostly_blocked(), "~block").otherwise("~allow")
    chain = F.transform(F.slice("least", F.lit(1), common), lambda s: F.when(s == "*", s).otherwise(F.coalesce(label, s)))
    chains = nodes.select(
        "n_host", "n_template", common.alias("common"),
        F.concat_ws("", F.transform(chain, lambda s: F.concat(F.lit("/"), s))).alias("chain"),
    )
    joined = rows.join(chains.hint("merge"), (F.col("host") == F.col("n_host")) & (F.col("template") == F.col("n_template")))
    left = F.slice("rest", F.col("common") + 1, F.greatest(F.size("rest") - F.col("common"), F.lit(0)))
    return joined.select(
        "host", "shape", "n", "labelled", "blocked", F.concat("template", "chain").alias("template"), left.alias("rest")
    )


def branched(rows: DataFrame) -> DataFrame:
    """Rows moved down by one segment, generalised or merged; those whose path ended before have a null `rest`."""
    rows = rows.withColumn("seg", F.get("rest", F.lit(0)))
    branches = stored(
        rows.groupBy("host", "template", "seg").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
        ),
        "url-branches",
    )
    mostly = mostly_blocked()

    def of_side(column: str, side: Column) -> Column:
        return F.coalesce(F.sum(F.when(side & (F.col("labelled") > 0), F.col(column))), F.lit(0))

    nodes = stored(
        branches.groupBy(F.col("host").alias("n_host"), F.col("template").alias("n_template")).agg(
            F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("all"),
            (of_side("blocked", mostly) / F.greatest(of_side("labelled", mostly), F.lit(1))).alias("share_block"),
            (of_side("blocked", ~mostly) / F.greatest(of_side("labelled", ~mostly), F.lit(1))).alias("share_allow"),
        ),
        "url-nodes",
    )
    share = F.when(mostly, F.col("share_block")).otherwise(F.col("share_allow"))
    gap = F.abs(F.col("blocked") - F.col("labelled") * share)
    alike = (F.col("labelled") > 0) & (gap <= ALIKE * F.sqrt(F.col("labelled") * share * (1 - share)) + 0.5)
    variable = (F.col("kinds") >= MANY) & (F.col("all") <= SELDOM * F.col("kinds"))
    named = stored(
        branches.join(nodes.hint("merge"), (F.col("host") == F.col("n_host")) & (F.col("template") == F.col("n_template"))).select(
            F.col("host").alias("b_host"), F.col("template").alias("b_template"), F.col("seg").alias("b_seg"),
            F.when(F.col("seg").isNull(), "").when(variable | (F.col("seg") == "*"), "/*")
            .when(alike, F.when(mostly, "/~block").otherwise("/~allow")).otherwise(F.concat(F.lit("/"), "seg"))
            .alias("branch"),
        ),
        "url-named",
    )
    same = (F.col("host") == F.col("b_host")) & (F.col("template") == F.col("b_template")) & F.col("seg").eqNullSafe(F.col("b_seg"))
    left = F.when(F.col("seg").isNotNull(), F.slice("rest", F.lit(2), F.size("rest")))
    return rows.join(named.hint("merge"), same).select(
        "host", "shape", "n", "labelled", "blocked", F.concat("template", "branch").alias("template"), left.alias("rest")
    )


def template_purity(tree: DataFrame) -> DataFrame:
    """`tree` with the smoothed share of blocked pages of each row's template."""
    sums = stored(
        tree.groupBy(F.col("host").alias("p_host"), F.col("template").alias("p_template")).agg(
            F.sum("labelled").alias("p_labelled"), F.sum("blocked").alias("p_blocked")
        ),
        "url-purity",
    )
    return tree.join(
        sums.hint("merge"), (F.col("host") == F.col("p_host")) & (F.col("template") == F.col("p_template"))
    ).withColumn("purity", (F.col("p_blocked") + PRIOR * PRIOR_SHARE) / (F.col("p_labelled") + PRIOR))
