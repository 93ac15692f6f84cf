"""URL verdicts from a tree of path templates per host, with DataFrame functions only.

Digits in path segments become ``#``, so pages of one kind share a shape, and everything after that
works on one row per (host, shape). The tree of a host is grown level by level, to the last segment:

* children whose share of good labels does not differ from that of all their siblings (a z-test on
  the counts; children without labels never differ) are one branch; the others keep their literal
  segment, however many siblings there are;
* the branch is written ``*`` under a node with more than ``MAX_CHILDREN`` children and ``~`` under
  others, which says how variable the segment is and decides nothing;
* a shape that no other shares its node with has one child a level, so the rest of it is literal.

A template's purity is its share of good labels, smoothed by its host's, which is smoothed by that of
all urls. Templates under ``MIN_PURITY`` are rejected. Explicit rules go first: the longest that fits
the host (or a parent domain) and begins the path decides.

Defined results: a null url and one without ``://`` have an empty host and path and are judged like
any other host; without labels the share counts as ``UNKNOWN``; repeated rows are judged alike, each
on its own row; other columns pass through, those named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_table
from tidemark.sources.scratch import cut_lineage

#: Levels that ``ORACLE_SQL`` unrolls; the operator has no such limit.
DEPTH = 4
MAX_CHILDREN = 12
Z = 1.96
HOST_WEIGHT = 10.0
TEMPLATE_WEIGHT = 8.0
MIN_PURITY = 0.8
UNKNOWN = 1.0
#: (verdict, host and path prefix) of the query.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path, both empty where the url is null or has no ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls where none does."""
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, prefix = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _shapes(path: Column) -> Column:
    """The path's segments with runs of digits as ``#``."""
    return F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda s: s != "")


def path_templates(shapes: DataFrame) -> DataFrame:
    """(host, shape, template) from (host, shape, labelled, good), one row per host and shape."""
    columns = ["host", "shape", "labelled", "good", "node"]
    tree = cut_lineage(shapes.select(*columns[:-1], F.lit("").alias("node")))
    ended, growing, level = [tree.filter("size(shape) = 0")], tree.filter("size(shape) > 0"), 0
    while True:
        at = growing.withColumn("segment", F.element_at("shape", level + 1))
        kids = at.groupBy("host", "node", "segment").agg(
            F.sum("labelled").alias("n"), F.sum("good").alias("g"), F.count("*").alias("shapes")
        )
        pool = kids.groupBy("host", "node").agg(
            F.count("*").alias("children"), F.sum("n").alias("all_n"), F.sum("g").alias("all_g"),
            F.sum("shapes").alias("all_shapes"),
        )
        share = (F.col("all_g") + 1.0) / (F.col("all_n") + 2.0)
        gap = F.col("g") - F.col("n") * share
        alike = gap * gap <= F.lit(Z * Z) * F.col("n") * share * (1.0 - share)
        token = F.when(
            (F.col("children") > 1) & alike, F.when(F.col("children") > MAX_CHILDREN, "*").otherwise("~")
        ).otherwise(F.col("segment"))
        tokens = kids.join(pool, ["host", "node"]).select("host", "node", "segment", token.alias("token"), "all_shapes")
        rest = F.array_join(F.slice("shape", level + 1, F.size("shape")), "/")
        alone = F.col("all_shapes") == 1
        grown = at.join(tokens, ["host", "node", "segment"]).select(
            *columns[:-1],
            F.concat("node", F.lit("/"), F.when(alone, rest).otherwise(F.col("token"))).alias("node"),
            (alone | (F.size("shape") == level + 1)).alias("ends"),
        )
        grown = cut_lineage(grown)  # each level reads the one above twice
        ended.append(grown.filter("ends").select(columns))
        growing, level = grown.filter("not ends").select(columns), level + 1
        if growing.isEmpty():
            return reduce(DataFrame.unionByName, ended).withColumnRenamed("node", "template")


def template_purity(tree: DataFrame) -> DataFrame:
    """(host, template, purity): shares of good labels, smoothed by the host's and by all."""
    total = tree.agg(F.sum("labelled"), F.sum("good")).first()  # two numbers
    overall = total[1] / total[0] if total[0] else UNKNOWN
    hosts = tree.groupBy("host").agg(
        ((F.sum("good") + HOST_WEIGHT * overall) / (F.sum("labelled") + HOST_WEIGHT)).alias("host_share")
    )
    nodes = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good"))
    purity = (F.col("good") + TEMPLATE_WEIGHT * F.col("host_share")) / (F.col("labelled") + TEMPLATE_WEIGHT)
    return nodes.join(hosts, "host").select("host", "template", purity.alias("purity"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    url_col: str = "url",
    label_col: str = "label",
    min_purity: float = MIN_PURITY,
) -> DataFrame:
    """``pages`` with host, path, template, purity, rule and verdict; label: 1 good, 0 bad, null unknown."""
    results = ("host", "path", "shape", "template", "purity", "rule", "verdict")
    kept = [c for c in pages.columns if c.lower() not in results]
    host, path = url_host_path(F.col(url_col))
    parsed = pages.select(*kept, host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("shape", _shapes(F.col("path")))
    shapes = as_table(parsed, host="host", shape="shape", label=label_col).groupBy("host", "shape").agg(
        F.count("label").alias("labelled"), F.count_if(F.col("label") == 1).alias("good")
    )
    tree = path_templates(shapes)
    judged = tree.join(template_purity(tree), ["host", "template"]).select("host", "shape", "template", "purity")
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(says, F.when(F.col("purity") < min_purity, "block").otherwise("allow"))
    joined = parsed.join(judged, ["host", "shape"])
    return joined.select(*kept, "host", "path", "template", "purity", rule.alias("rule"), verdict.alias("verdict"))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, url, label): the quality of the document a page shows, whose id ends its path."""
    number = F.try_to_number(F.regexp_extract(url_host_path(F.col("url"))[1], "/([0-9]{1,18})[^/]*/?$", 1), F.lit("9" * 18))
    shown = as_table(pages, page_id="page_id", url="url").withColumn("shown", number.cast("bigint"))
    quality = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("shown")).agg(F.max("quality").alias("label"))
    return shown.join(quality, "shown", "left").drop("shown")


def _oracle_sql() -> str:
    prefix = " ".join(
        f"WHEN (host = '{t.partition('/')[0]}' OR ends_with(host, '.{t.partition('/')[0]}'))"
        f" AND starts_with(path, '/{t.partition('/')[2]}') THEN '{{{i}}}'"
        for i, (_, t) in sorted(enumerate(RULES), key=lambda r: -len(r[1][1]))
    )
    rule = "CASE " + prefix.format(*[t for _, t in RULES]) + " END"
    says = "CASE " + prefix.format(*[v for v, _ in RULES]) + " END"
    levels = ""
    for i in range(DEPTH + 1):
        levels += f""",
at{i} AS (SELECT *, shape[{i + 1}] AS segment FROM tree{i}),
kids{i} AS (SELECT host, node, segment, sum(labelled) AS n, sum(good) AS g FROM at{i}
  WHERE segment IS NOT NULL GROUP BY ALL),
pool{i} AS (SELECT host, node, count(*) AS children, (sum(g) + 1.0::DOUBLE) / (sum(n) + 2.0::DOUBLE) AS share
  FROM kids{i} GROUP BY ALL),
tree{i + 1} AS (SELECT a.host, a.shape, a.labelled, a.good, a.node || CASE
    WHEN k.segment IS NULL THEN '' WHEN k.segment = '**' THEN '/**' WHEN children > {MAX_CHILDREN} THEN '/*'
    WHEN children > 1 AND (g - n * share) * (g - n * share) <= {Z * Z}::DOUBLE * n * share * (1 - share) THEN '/~'
    ELSE '/' || k.segment END AS node
  FROM at{i} a LEFT JOIN (kids{i} k JOIN pool{i} USING (host, node))
    ON a.host = k.host AND a.node = k.node AND a.segment = k.segment)"""
    return f"""WITH quality AS (SELECT doc_id, max(quality) AS label FROM labels GROUP BY doc_id),
after AS (SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END, '') AS rest FROM pages),
parsed AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM after),
shaped AS (SELECT p.*, list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda s: s <> '') AS parts,
    label FROM parsed p LEFT JOIN quality q
    ON q.doc_id = TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})[^/]*/?$', 1) AS BIGINT)),
urls AS (SELECT page_id, host, path, label,
    list_concat(parts[1:{DEPTH}], CASE WHEN len(parts) > {DEPTH} THEN ['**'] ELSE [] END) AS shape FROM shaped),
tree0 AS (SELECT host, shape, count(label) AS labelled, count(*) FILTER (label = 1) AS good, '' AS node
  FROM urls GROUP BY host, shape){levels},
overall AS (SELECT sum(good) / sum(labelled) AS share FROM tree0),
hosts AS (SELECT host, (sum(good) + {HOST_WEIGHT}::DOUBLE * any_value(share)) / (sum(labelled) + {HOST_WEIGHT}::DOUBLE)
    AS host_share FROM tree0, overall GROUP BY host),
nodes AS (SELECT host, node, (sum(good) + {TEMPLATE_WEIGHT}::DOUBLE * any_value(host_share))
    / (sum(labelled) + {TEMPLATE_WEIGHT}::DOUBLE) AS purity FROM tree{DEPTH + 1} JOIN hosts USING (host) GROUP BY ALL)
SELECT page_id, host, path, {rule} AS rule,
  coalesce({says}, CASE WHEN purity < {MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict,
  node AS template, round(purity, 9) AS purity
FROM urls u JOIN tree{DEPTH + 1} t USING (host, shape) JOIN nodes USING (host, node)"""


ORACLE_SQL = _oracle_sql()
