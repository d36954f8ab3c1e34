"""URL filter by rules and by path templates, built of DataFrame functions only.

The paths of each host form a tree. Segments that look generated become wildcards, then, level by level, branches that
behave like the rest of their siblings are merged into one. A template, that is a path through the merged tree, is
blocked if nearly all of its labelled urls are bad, the share being smoothed so that few labels decide nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.tables import written


@dataclass(frozen=True)
class UrlRule:
    """`pattern` is host/path-prefix, such as example.com/de/; it fits the host and its subdomains."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


@dataclass(frozen=True)
class TemplateOptions:
    """depth: levels of the tree; the rest of a longer path is one more segment, so no part of a path is lost.
    z: branches merge if their share of bad urls and of ended paths is within so many standard errors of the siblings'.
    max_children: a level with more different segments holds a variable, and each of its rare segments is a wildcard;
    rare: in less than this share of the level's urls.
    prior, weight: smoothing of the bad share. reject: the smoothed share at which a template is blocked."""

    depth: int = 4
    z: float = 3.0
    max_children: int = 50
    rare: float = 0.01
    prior: float = 0.5
    weight: float = 4.0
    reject: float = 0.9


#: What a generated segment is replaced by, first match first; an extension stays.
SHAPES = (
    (r"^[0-9]+(\.[A-Za-z0-9]{1,5})?$", "{n}$1"),
    (r"^[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?(\.[A-Za-z0-9]{1,5})?$", "{date}$1"),
    (r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}(\.[A-Za-z0-9]{1,5})?$", "{uuid}$1"),
    (r"^(?=[^.]*[0-9])[0-9A-Fa-f]{8,}(\.[A-Za-z0-9]{1,5})?$", "{hex}$1"),
    (r"^(?=[^.]*[0-9])[0-9A-Za-z_-]{16,}(\.[A-Za-z0-9]{1,5})?$", "{id}$1"),
)
WILDCARD = "*"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path; both empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: list[UrlRule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does. Of equal patterns the first given holds."""
    fitting = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.pattern))):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        fitting = F.when(fits, F.lit(rule.pattern)).otherwise(fitting)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return fitting, verdict


def segments(path: Column, depth: int) -> list[Column]:
    """`depth` + 1 segments with generated ones generalised, the last being all that is left; null beyond the end."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", depth + 1)
    out = []
    for level in range(depth + 1):
        segment = F.get(parts, level)
        shaped = segment
        for pattern, shape in reversed(SHAPES):
            shaped = F.when(segment.rlike(pattern), F.regexp_replace(segment, pattern, shape)).otherwise(shaped)
        out.append(F.when(path != "", shaped))
    return out


def _close(part: Column, n: Column, rest: Column, n_rest: Column, z: float) -> Column:
    """Whether part / n and rest / n_rest are shares of the same size, as far as so many rows can tell.

    Two-proportion test, multiplied out: no division, so an empty rest divides nothing by zero.
    """
    both, total = part + rest, n + n_rest
    gap = part * n_rest - rest * n
    return gap * gap <= z * z * both * (total - both) * n * n_rest / total


def merged_templates(paths: DataFrame, options: TemplateOptions) -> DataFrame:
    """`paths` (host, s0.., n, n_labelled, n_bad; one row for each distinct path) with template levels t0... added.

    A level's branches are summed first; only sums meet the sums of their siblings, so a host's share of the rows
    doesn't matter, only its number of different paths. Every level is stored, as the next one reads it several times.
    """
    spark = paths.sparkSession
    levels = options.depth + 1
    tree = written(spark, paths, "url-paths")
    for level in range(levels):
        above = ["host", *(f"t{i}" for i in range(level))]
        segment = f"s{level}"
        ended = F.col(f"s{level + 1}").isNull() if level + 1 < levels else F.lit(True)
        branch = tree.groupBy(*above, segment).agg(
            F.sum("n").alias("_n"),
            F.sum("n_bad").alias("_bad"),
            F.sum(F.when(ended, F.col("n")).otherwise(0)).alias("_ended"),
        )
        parent = branch.groupBy(*above).agg(
            F.sum("_n").alias("_all"),
            F.sum("_bad").alias("_all_bad"),
            F.sum("_ended").alias("_all_ended"),
            F.count(segment).alias("_children"),
        )
        both = _joined(branch, parent, above)
        n, n_rest = F.col("_n").cast("double"), (F.col("_all") - F.col("_n")).cast("double")
        bad, ended_here = F.col("_bad").cast("double"), F.col("_ended").cast("double")
        alike = _close(bad, n, F.col("_all_bad") - bad, n_rest, options.z) & _close(
            ended_here, n, F.col("_all_ended") - ended_here, n_rest, options.z
        )
        variable = (F.col("_children") > options.max_children) & (n < options.rare * F.col("_all"))
        template = F.when(F.col(segment).isNotNull() & (n_rest > 0) & (variable | alike), WILDCARD).otherwise(
            F.col(segment)
        )
        chosen = both.select(*above, segment, template.alias(f"t{level}"))
        tree = written(spark, _joined(tree, chosen, [*above, segment]), "url-tree")
    return tree


def _joined(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Inner join on `columns`, a null being equal to a null; the other columns have different names."""
    theirs = right.select(*[F.col(c).alias(f"_r_{c}") if c in columns else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(theirs, same).drop(*[f"_r_{c}" for c in columns])


def judge_urls(
    pages: DataFrame,
    rules: list[UrlRule],
    bad: Column | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    options: TemplateOptions = TemplateOptions(),
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, bad_share) for every row of `pages`.

    `bad` labels rows: true, false, or null for unknown. Without it the rules are the labels: a url that a rule blocks
    is bad and one that a rule allows is good, so the templates carry the rules' experience to urls that no rule fits.
    A rule always wins over a template.

    Paths are counted before anything is joined. The last join, of rows with their template, may meet a frequent path;
    adaptive skew handling splits it.

    Defined cases: a url that is null or has no `://` has an empty host and path, which form one template like any
    other; an empty path is a template without segments; empty segments (`//`) are segments; a null id is passed on;
    repeated rows count as often as they come; an empty table gives an empty table; other columns are looked at only
    by `bad`. Segments beyond `depth` are kept together in one.
    """
    host, path = split_url(F.col(f"`{url_col}`"))
    labels = F.lit(None).cast("boolean") if bad is None else bad
    split = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"), labels.alias("_bad"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.select("*", rule.alias("rule"), verdict.alias("_ruled"))
    known = F.col("_bad") if bad is not None else F.col("_ruled") == "block"
    levels = range(options.depth + 1)
    shaped = ruled.select(
        "page_id",
        "host",
        "path",
        "rule",
        "_ruled",
        known.alias("_bad"),
        *[s.alias(f"s{i}") for i, s in enumerate(segments(F.col("path"), options.depth))],
    )
    steps = [f"s{i}" for i in levels]
    paths = shaped.groupBy("host", *steps).agg(
        F.count(F.lit(1)).alias("n"), F.count("_bad").alias("n_labelled"), F.count(F.when(F.col("_bad"), 1)).alias("n_bad")
    )
    tree = merged_templates(paths, options)
    template = ["host", *(f"t{i}" for i in levels)]
    stats = tree.groupBy(*template).agg(F.sum("n_labelled").alias("_labelled"), F.sum("n_bad").alias("_n_bad"))
    share = (F.col("_n_bad") + options.weight * options.prior) / (F.col("_labelled") + options.weight)
    judged = _joined(tree, stats, template).select(
        "host",
        *steps,
        F.concat(F.lit("/"), F.concat_ws("/", *template[1:])).alias("template"),
        share.alias("bad_share"),
    )
    final = F.coalesce("_ruled", F.when(F.col("bad_share") >= options.reject, "block").otherwise("allow"))
    return _joined(shaped, judged, ["host", *steps]).select(
        "page_id", "host", "path", "rule", final.alias("verdict"), "template", "bad_share"
    )
