"""URL filter by a path-template tree.

Per host, the segments of a path are levels of a tree. Segments that vary by their form
(numbers, dates, hex strings, long mixed ids) become typed wildcards. Level by level, rare
children of a node become the wildcard ``*`` unless their labels differ
significantly from the rest of the node's, and labelled siblings
whose share of good pages does not differ significantly from the rest of their node's are
merged into one branch ``~``. The paths that are left are the templates. A template whose smoothed
share of good labelled pages, (good + s * prior) / (labelled + s), is under a threshold is
rejected.

Only counts travel: pages are summed to (host, generalised segments) with partial sums
first, the tree works on that table, and one join takes the verdicts back to the pages (its
right side has one row per key; adaptive execution splits a hot key's pages).

Hand-written rules (host, path) come first: a rule fits its host and all subdomains if the
path starts with the rule's; the longest rule wins.

Defined results: host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z in lower case, path what follows up to ``?``, ``#`` or the end; a null URL or one without
``://`` has both empty, and is judged as the page of an empty host; empty segments are dropped;
the tree is as deep as paths share their starts, behind that a path is its own template, however
long; repeated rows each get a verdict and count each;
extra columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import col, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the query, as (action, host/path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# Words of a host name that label its pages as bad, in the manner of public URL word lists.
BAD_HOST_WORDS = (
    "ads", "adult", "bet", "bets", "betting", "casino", "cheap", "escort", "gambling", "loans", "pills", "poker",
    "porn", "sex", "spam", "torrent", "track", "tracker", "viagra", "warez", "xxx",
)

RARE_SHARE = 0.02         # a child with a smaller share of the node's pages is rare
SIMILAR_Z = 1.96          # two shares closer than this many standard errors are alike
PRIOR, STRENGTH = 0.9, 1.0
LEAST_PURITY = 0.5

# Forms of variable segments (pattern of the whole segment, wildcard), first match wins.
FORMS = (
    ("[0-9]{4}-[0-9]{1,2}(-[0-9]{1,2})?", "{date}"),
    ("[0-9]+", "{number}"),
    ("[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "{uuid}"),
    ("(?=.*[0-9])[0-9a-f]{8,}", "{hex}"),
    ("(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_-]{16,}", "{id}"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (
        F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
    )


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest fitting rule, or nulls."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: len(r[1])):   # longer rules wrap shorter ones
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, action = F.when(fits, text).otherwise(rule), F.when(fits, act).otherwise(action)
    return rule, action


def _generalised(segment: Column) -> Column:
    stem = F.regexp_replace(segment, r"\.[A-Za-z0-9]{1,5}$", "")
    tail = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1)
    out = segment
    for pattern, wildcard in reversed(FORMS):
        out = F.when(stem.rlike(f"^(?:{pattern})\\z"), F.concat(F.lit(wildcard), tail)).otherwise(out)
    return out


def _parts(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def segments(path: Column) -> Column:
    """The generalised segments of a path."""
    return F.transform(_parts(path), _generalised)


def word_label(name: Column, words: Sequence[str] = BAD_HOST_WORDS) -> Column:
    """0 for names (lower case) with a bad word among their words, else null."""
    named = F.arrays_overlap(F.split(name, "[^a-z]+"), F.array(*[F.lit(w) for w in words]))
    return F.when(named, 0)


def templates(paths: DataFrame) -> DataFrame:
    """Template of each (host, segments, n, good, bad) row: adds ``template`` and ``purity``."""
    table = paths.withColumn("t", F.expr("cast(array() as array<string>)"))
    done, d = None, 0
    while True:
        # a path that ends here is the child "" of its node, and goes no further
        node = ["host", "t"]
        table = table.withColumn("s", F.coalesce(F.get("segments", F.lit(d)), F.lit("")))
        children = table.groupBy(*node, "s").agg(F.sum("n").alias("c_n"), F.sum("good").alias("c_good"),
                                                     F.sum("bad").alias("c_bad"), F.count("*").alias("c_paths"))
        nodes = children.groupBy(*node).agg(F.sum("c_paths").alias("paths"), F.sum("c_n").alias("a_n"),
                                            F.sum("c_good").alias("a_good"), F.sum("c_bad").alias("a_bad"))
        labelled = F.col("c_good") + F.col("c_bad")
        others = F.col("a_good") + F.col("a_bad") - labelled
        share, rest = F.col("c_good") / labelled, (F.col("a_good") - F.col("c_good")) / others
        pooled = F.col("a_good") / (labelled + others)
        error = F.sqrt(pooled * (1 - pooled) * (1 / labelled + 1 / others))
        # no labels on one side: nothing shows that the branches are alike
        alike = F.when((labelled > 0) & (others > 0), F.abs(share - rest) <= SIMILAR_Z * error).otherwise(False)
        rare = F.col("c_n") < RARE_SHARE * F.col("a_n")
        # a rare child that differs from the rest keeps its name
        pooled_rare = rare & ((labelled == 0) | (others == 0) | alike)
        name = F.when(F.col("s") == "", "").when(pooled_rare, "*").when(alike, "~").otherwise(F.col("s"))
        decided = children.join(nodes, node).select(*node, "s", name.alias("name"), (F.col("paths") == 1).alias("alone"))
        # a path alone in its node has no siblings at any level below either: it keeps its names
        rest = F.slice("segments", F.lit(d + 1), F.size("segments"))
        table = saved(table.join(decided, [*node, "s"]).withColumn(   # else each level triples the plan
            "t", F.when(F.col("alone"), F.concat("t", rest)).when(F.col("name") == "", F.col("t")).otherwise(
                F.array_append("t", F.col("name")))).withColumn(
            "ended", F.col("alone") | (F.size("segments") <= d)).drop("name", "s", "alone"))
        d += 1
        ended = table.filter("ended").drop("ended")
        done = ended if done is None else done.unionByName(ended)
        table = table.filter("NOT ended").drop("ended")
        if table.isEmpty():
            break
    table = done.withColumn("template", F.concat_ws("/", "host", F.array_join("t", "/")))
    purity = table.groupBy("template").agg(
        ((F.sum("good") + STRENGTH * PRIOR) / (F.sum("good") + F.sum("bad") + STRENGTH)).alias("purity"))
    return table.join(purity, "template").select("host", "segments", "template", "purity")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labels: DataFrame | None = None,
          id_col: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, template, purity.

    Seed labels vary inside a host: pages that a rule blocks or whose host, path or query has
    a bad word are bad, pages that a rule allows good, rules first. Without ``labels`` all other
    pages of a host are good seeds, so a template is judged by its share of bad pages;
    ``labels`` (id, good 0/1; one row per id) come before these, and leave other pages unlabelled."""
    host, path = host_and_path(col(url).cast("string"))
    words = F.when(F.contains(col(url).cast("string"), F.lit("://")), F.translate(col(url).cast("string"), UPPER, LOWER))
    rows = pages.select(col(id_col).alias(id_col), host.alias("host"), path.alias("path"),
                        F.coalesce(word_label(words), F.when(words.isNotNull(), 1)).alias("__seed"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "__action": action})
    rows = rows.withColumn("segments", segments(F.col("path")))
    label = F.when(F.col("__action") == "block", 0).when(F.col("__action") == "allow", 1)
    label = F.coalesce(label, F.when(F.col("__seed") == 0, 0) if labels is not None else F.col("__seed"))
    if labels is not None:
        rows = rows.join(labels.select(col(id_col), F.col("good").alias("__good")), id_col, "left")
        label = F.coalesce(F.col("__good"), label)
    keys = ["host", "segments"]
    counts = rows.withColumn("__label", label).groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(F.col("__label") == 1).alias("good"),
        F.count_if(F.col("__label") == 0).alias("bad"))
    verdicts = templates(saved(counts))
    method = F.when(F.col("purity") < LEAST_PURITY, "block").otherwise("allow")
    return rows.join(verdicts, keys).select(
        col(id_col), "host", "path", "rule", F.coalesce("__action", method).alias("verdict"), "template", "purity")
