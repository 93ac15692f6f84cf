"""How far the sources of a language stand apart in their use of words, from a frequent-pattern tree of term rows.

A term row holds the sources that use a term, in a fixed order, with their smoothed shares. Rows with the same content
are one row with a multiplicity. Sorted rows go through a prefix tree: rows that begin alike share a path, and a node
that is complete adds, once for each of its ancestors and times its multiplicity, what the pair's distance differs from
the sum of two sources taken alone. Only the open path and the sums by pair are in memory, and the sums are handed on
when they grow, because they add up anywhere.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_table
from tidemark.sources.scratch import stored

MIN_DOCS = 30
TOP_TERMS = 50
#: What becomes of each byte of a text: A-Z are a-z, a-z and the bytes of other scripts stay, all else ends a term.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Counts that a task holds before it hands them on.
HELD_COUNTS = 500_000
#: Sums by pair that a task holds before it hands them on, in numbers of 8 bytes.
HELD_SUMS = 4_000_000


def share(count: str, whole: str, terms: str) -> Column:
    """Smoothed share of a term in billionths, at least 1; exact, also where a count times a billion is over 64 bits."""
    return F.expr(f"1 + (1000000000BD * (CAST({count} AS DECIMAL(20, 0)) + 5)) div ({whole} + 5 * {terms})")


_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, for the documents since the last hand-over."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for batch in batches:
        for lang, source, text in zip(*[batch.column(c).to_pylist() for c in ("lang", "source", "text")]):
            uses, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            words = text.encode().translate(_BYTES).split()
            words.append(b"")  # stands for the group itself
            held -= len(docs)
            uses.update(words)
            docs.update(set(words))
            held += len(docs)
            if held > HELD_COUNTS:
                yield from _handed(groups)
                groups, held = {}, 0
    yield from _handed(groups)


def _handed(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (uses, docs) in groups.items():
        terms = pa.array(uses.keys(), pa.binary()).cast(pa.string())
        numbers = [pa.array([counts[t] for t in uses], pa.int64()) for counts in (uses, docs)]
        names = [pa.repeat(pa.scalar(x, pa.string()), len(terms)) for x in (lang, source)]
        yield pa.record_batch([*names, terms, *numbers], schema=_COUNTS)


def term_rows(
    docs: DataFrame, min_docs: int = MIN_DOCS, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """The kept terms, (lang, term, lang_n, entries): an entry is a source that uses the term, with its count ``n``.

    The empty term stands for the groups themselves, so that groups without terms are there too. Tasks count what they
    read; the counts move once, by (lang, term), and only kept terms go on.
    """
    rows = as_table(docs, text=text, lang=lang, source=source).fillna("", ["text", "lang", "source"])
    counts = rows.select("lang", "source", "text").mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return (
        counts.repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("lang_n"),
            F.collect_list(F.struct("source", "n")).alias("entries"),
        )
        .filter(F.expr(f"term = '' OR docs >= {min_docs}"))
        .drop("docs")
    )


def group_sizes(groups: DataFrame, uses: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per (lang, source): kept occurrences and terms, the language's, the share ``z`` of a term that is not
    there, and ``place``, the order in paths: small sources first, since their counts agree most often."""
    own = uses.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("used"))
    langs = rows.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_size"))
    filled = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    filled = filled.fillna(0, ["size", "used", "terms", "lang_size"])
    order = Window.partitionBy("lang").orderBy("size", "source")
    absent = F.when(F.col("terms") > 0, share("0", "size", "terms")).otherwise(0)
    return filled.select("*", absent.alias("z"), (F.row_number().over(order) - 1).alias("place"))


_SUMS = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])


class PathTree:
    """The open path of a prefix tree that takes sorted paths, and what its complete nodes have added up to."""

    def __init__(self) -> None:
        self.lang: str | None = None
        self.place, self.p, self.z = (np.zeros(64, np.int64) for _ in range(3))
        self.copies: list[int] = []
        self.sums: dict[int, np.ndarray] = {}
        self.held = 0

    def add(self, nodes: np.ndarray, copies: int) -> None:
        """Insert a path, rows of (place, p, z), ``copies`` times; it must not sort before the path that is open."""
        depth = len(nodes)
        same = min(depth, len(self.copies))
        equal = (self.place[:same] == nodes[:same, 0]) & (self.p[:same] == nodes[:same, 1])
        shared = same if equal.all() else int(np.argmin(equal))
        self.close(shared)
        if depth > len(self.place):
            self.place, self.p, self.z = (np.resize(x, 2 * depth) for x in (self.place, self.p, self.z))
        for kept, column in zip((self.place, self.p, self.z), nodes.T):
            kept[shared:depth] = column[shared:]
        self.copies += [0] * (depth - shared)
        if depth:
            self.copies[-1] += copies

    def close(self, depth: int) -> None:
        """Complete the nodes below ``depth``: each meets its ancestors, and its parent takes over its copies."""
        while len(self.copies) > depth:
            copies, at = self.copies.pop(), len(self.copies)
            if not at:
                return
            self.copies[-1] += copies
            b, p_b, z_b = int(self.place[at]), self.p[at], self.z[at]
            p_a, z_a = self.p[:at], self.z[:at]
            beyond = np.abs(p_a - p_b) - np.abs(p_a - z_b) - np.abs(z_a - p_b) + np.abs(z_a - z_b)
            if b not in self.sums:
                self.sums[b] = np.zeros(b, np.int64)
                self.held += b
            self.sums[b][self.place[:at]] += copies * beyond

    def take(self) -> Iterator[pa.RecordBatch]:
        """Hand on the sums so far; the open path stays."""
        for b, values in self.sums.items():
            a = np.flatnonzero(values)
            if len(a):
                columns = [[self.lang] * len(a), a.astype(np.int32), np.full(len(a), b, np.int32), values[a]]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SUMS)], schema=_SUMS)
        self.sums, self.held = {}, 0


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree = PathTree()
    for batch in batches:
        path = batch.column("path")
        bounds = path.offsets.to_numpy()
        nodes = path.values
        table = np.stack([nodes.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("place", "p", "z")], axis=1)
        for i, (lang, copies) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("copies").to_pylist())):
            if lang != tree.lang:
                tree.close(0)
                yield from tree.take()
                tree.lang = lang
            tree.add(table[bounds[i] : bounds[i + 1]], copies)
            if tree.held > HELD_SUMS:
                yield from tree.take()
    tree.close(0)
    yield from tree.take()


def shared_corrections(shares: DataFrame) -> DataFrame:
    """(lang, a, b, value) by the tree, over the terms that both sources use: how much the distance of their shares
    differs from the distances to each other's share of an absent term."""
    paths = (
        shares.groupBy("lang", "term")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("place").cast("int").alias("place"), "p", "z"))).alias("path"))
        .groupBy("lang", "path")
        .agg(F.count("*").alias("copies"))
        # By how paths begin, which is what they share; the hash cuts a beginning that very many have. Range bounds are
        # sampled, and this key keeps the samples short.
        .repartitionByRange("lang", F.slice("path", 1, 2), F.xxhash64("path"))
        .sortWithinPartitions("lang", "path")
    )
    sums = paths.mapInArrow(_pair_sums, "lang string, a int, b int, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def lone_distances(shares: DataFrame, sizes: DataFrame) -> DataFrame:
    """For ordered pairs of sources: the distance of a's used terms to b's share of an absent term, summed; by running
    sums over a's shares, in which the other sources' absent shares are points."""
    zero = F.lit(0).cast("bigint")
    values = shares.groupBy("lang", F.col("place").alias("a"), F.col("p").alias("x")).agg(F.count("*").alias("m"))
    values = values.select("lang", "a", "x", F.lit(None).cast("int").alias("b"), "m", zero.alias("base"))
    one = sizes.select("lang", F.col("place").alias("a"), F.col("z").alias("z_a"), F.col("used").alias("used_a"), "terms")
    two = sizes.select("lang", F.col("place").alias("b"), F.col("z").alias("x"), F.col("used").alias("used_b"))
    points = one.join(two, "lang").filter("a <> b")  # the pairs that the report lists
    neither = F.expr("(terms - used_a - used_b) * abs(z_a - x)")
    points = points.select("lang", "a", "x", "b", zero.alias("m"), neither.alias("base"))
    source = Window.partitionBy("lang", "a")
    upto = source.orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = values.unionByName(points).withColumns(
        {
            "n_low": F.sum("m").over(upto),
            "s_low": F.sum(F.expr("m * x")).over(upto),
            "n_all": F.sum("m").over(source),
            "s_all": F.sum(F.expr("m * x")).over(source),
        }
    )
    distance = F.expr("x * n_low - s_low + (s_all - s_low) - x * (n_all - n_low)")
    return sums.filter("b IS NOT NULL").select("lang", "a", "b", distance.alias("lone"), "base")


def audit_sources(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): how sources differ, in billionths of a share.

    Part ``pair``: every other source of the language with the summed distance of the shares of all kept terms. Part
    ``term``: the ``top`` terms that the source uses more than its language. Ties go to the smaller item. Null texts,
    languages and sources are empty; a group without terms takes part with counts of zero; without kept terms distances
    are 0; an empty table gives no rows. Extra columns are ignored, repeated rows count each.
    """
    rows = stored(term_rows(docs, min_docs, text, lang, source), "term-rows")
    groups = rows.filter("term = ''").select("lang", F.inline("entries")).drop("n")
    rows = rows.filter("term <> ''")
    uses = rows.select("lang", "term", "lang_n", F.inline("entries"))
    sizes = stored(group_sizes(groups, uses, rows), "groups")
    shares = uses.join(sizes, ["lang", "source"]).select(
        "lang", "source", "term", "lang_n", "place", "z", "terms", "lang_size", share("n", "size", "terms").alias("p")
    )
    shares = stored(shares, "shares")

    lone, both = lone_distances(shares, sizes), shared_corrections(shares)
    # A pair's sums go to both of its rows.
    lone = lone.select("lang", F.expr("inline(array(struct(a, b, lone + base AS value), struct(b AS a, a AS b, lone AS value)))"))
    both = both.select("lang", F.expr("inline(array(struct(a, b, value), struct(b AS a, a AS b, value)))"))
    pairs = lone.unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    names = [sizes.select("lang", F.col("place").alias(c), F.col("source").alias(n)) for c, n in (("a", "source"), ("b", "item"))]
    pairs = pairs.join(names[0], ["lang", "a"]).join(names[1], ["lang", "b"])
    terms = shares.withColumn("q", share("lang_n", "lang_size", "terms")).filter("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    result = ["lang", "source", "part", "item", "value", "rank"]
    ranked = [
        part.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(name))
        for name, part in (
            ("pair", pairs.select("lang", "source", "item", "value")),
            ("term", terms.select("lang", "source", F.col("term").alias("item"), F.expr("p - q").alias("value"))),
        )
    ]
    return ranked[0].select(*result).unionByName(ranked[1].filter(F.col("rank") <= top).select(*result))


#: The same report written out: every kept term against every group, without a tree.
ORACLE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
words AS (SELECT i, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT i) >= 30),
found AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM groups JOIN kept USING (lang)
  LEFT JOIN found USING (lang, source, term)),
whole AS (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL),
langs AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n::HUGEINT + 5)) // ((sum(n) OVER (PARTITION BY lang))::HUGEINT + 5 * v) AS q
  FROM whole JOIN vocabulary USING (lang)),
shares AS (SELECT lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 5)) // ((sum(n) OVER (PARTITION BY lang, source))::HUGEINT + 5 * v) AS p
  FROM cells JOIN vocabulary USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
distances AS (SELECT lang, source, item, coalesce(value, 0) AS value FROM pairs LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL) USING (lang, source, item)),
own AS (SELECT lang, source, term AS item, p - q AS value FROM shares JOIN langs USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM distances
  UNION ALL SELECT lang, source, 'term', item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM own)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked
WHERE part = 'pair' OR rank <= 50"""
