"""A Merkle manifest of a table with persistent versions: each tampered leaf is a version of the tree of its own.

Leaves of a language, in order of their ids, are cut into aligned blocks of ``8 ** 4``; one task holds the four levels
over a block, and the blocks' roots are the leaves of the next tier, until one node is left. The roots of the languages
are the leaves of one more tree. Sibling digests come back down the same way, one row for each block. A version of a
tampered leaf copies the leaf's ancestors, in its block and then in the tiers above, and shares every other node.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_table
from tidemark.llm.ranges import with_running
from tidemark.sources.scratch import stored

WIDTH = 8
#: Levels in one block: at most ``WIDTH ** LEVELS`` nodes are in a call at a time.
LEVELS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(nodes: int) -> int:
    """Levels above ``nodes`` nodes."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // WIDTH), levels + 1
    return levels


class PersistentTree:
    """The levels over a block's nodes. Versions share them and hold only the copies on one path."""

    def __init__(self, nodes: list[str], levels: int) -> None:
        self.levels = [nodes]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([digest(*below[i : i + WIDTH]) for i in range(0, len(below), WIDTH)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """For each level, the joined digests left and right of the node above ``at`` in its run."""
        path = []
        for level in self.levels[:-1]:
            first = at - at % WIDTH
            path.append(("".join(level[first:at]), "".join(level[at + 1 : first + WIDTH])))
            at //= WIDTH
        return path

    def copied(self, at: int, node: str) -> list[str]:
        """The version in which ``node`` stands at ``at``: copies of its ancestors, the last one the version's root."""
        return path_copy(node, self.siblings(at))


def path_copy(node: str, siblings: list[tuple[str, str]]) -> list[str]:
    copies = []
    for left, right in siblings:
        node = digest(left, node, right)
        copies.append(node)
    return copies


_ROOT = pa.schema([("tree", pa.int64()), ("index", pa.int64()), ("nodes", pa.int64()), ("node", pa.string())])
_SIDES = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_PATH = pa.schema([("tree", pa.int64()), ("index", pa.int64()), ("above", _SIDES), ("root", pa.string()), ("subroot", pa.string())])
_PROOF = pa.schema(
    [("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string())]
    + [("folded_root", pa.string()), ("copies", pa.list_(pa.string()))]
)


def _block_tree(rows: list[dict], levels: int) -> PersistentTree:
    return PersistentTree([r["node"] for r in rows], min(height(rows[0]["nodes"]), levels))


def _sorted_rows(table: pa.Table) -> list[dict]:
    return table.sort_by("index").to_pylist()


def _block_root(levels: int, table: pa.Table) -> pa.Table:
    rows = _sorted_rows(table)
    size = WIDTH**levels
    root = {"tree": rows[0]["tree"], "index": rows[0]["index"] // size, "nodes": -(-rows[0]["nodes"] // size)}
    return pa.Table.from_pylist([root | {"node": _block_tree(rows, levels).root}], _ROOT)


def _paths(levels: int, table: pa.Table, above: pa.Table) -> pa.Table:
    """The siblings of each node of a block, its block's following."""
    rows, block = _sorted_rows(table), above.to_pylist()[0]
    tree, out = _block_tree(rows, levels), []
    for at, row in enumerate(rows):
        own = [{"left": left, "right": right} for left, right in tree.siblings(at)]
        path = {"tree": row["tree"], "index": row["index"], "above": own + block["above"]}
        out.append(path | {"root": block["root"], "subroot": block["subroot"]})
    return pa.Table.from_pylist(out, _PATH)


def _proofs(levels: int, table: pa.Table, above: pa.Table) -> pa.Table:
    """The manifest's rows of a block of leaves; tampered leaves get a version each."""
    rows, block = _sorted_rows(table), above.to_pylist()[0]
    upper = [(s["left"], s["right"]) for s in block["above"]]
    tree, out = _block_tree(rows, levels), []
    for at, row in enumerate(rows):
        path = tree.siblings(at) + upper
        proof = {"doc_id": row["doc_id"], "leaf": row["node"], "subroot": block["subroot"], "root": block["root"]}
        proof["proof_sha256"] = digest(*[side for level in path for side in level])
        proof["copies"] = None
        if row["tampered"] is None:
            proof["folded_root"] = path_copy(row["node"], path)[-1] if path else row["node"]
        else:
            inside = tree.copied(at, row["tampered"])
            proof["copies"] = inside + path_copy(inside[-1] if inside else row["tampered"], upper)
            proof["folded_root"] = proof["copies"][-1] if path else row["tampered"]
        out.append(proof)
    return pa.Table.from_pylist(out, _PROOF)


_DDL_ROOT = "tree long, index long, nodes long, node string"
_DDL_PATH = "tree long, index long, above array<struct<left: string, right: string>>, root string, subroot string"
_DDL_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, copies array<string>"


def _by_block(nodes: DataFrame, levels: int):
    return nodes.groupBy("tree", F.expr(f"index div {WIDTH**levels}").alias("block"))


def _tiers(nodes: DataFrame, most: int, levels: int) -> list[DataFrame]:
    """The nodes and the tables of block roots above them; the last has one node of each tree."""
    tiers = [nodes]
    while most > 1:
        rows = tiers[-1].select("tree", "index", "nodes", "node")
        tiers.append(stored(_by_block(rows, levels).applyInArrow(lambda table: _block_root(levels, table), _DDL_ROOT), "merkle-tier"))
        most = -(-most // WIDTH**levels)
    return tiers


def _with_paths(tier: DataFrame, above: DataFrame, step, schema: str, levels: int) -> DataFrame:
    """A tier's blocks, each with the one row of the path above it."""
    paths = above.groupBy("tree", F.col("index").alias("block"))
    return _by_block(tier, levels).cogroup(paths).applyInArrow(lambda table, up: step(levels, table, up), schema)


def _down(tiers: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """Paths of the nodes of the first tier, from those of the last one's."""
    for tier in reversed(tiers[:-1]):
        nodes = tier.select("tree", "index", "nodes", "node")
        above = stored(_with_paths(nodes, above, _paths, _DDL_PATH, levels), "merkle-paths")
    return above


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(_field, columns)), 256)


def merkle_manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, copies) of ``doc_id, source, lang, n_chars, text``.

    ``tampered`` says, by ``doc_id``, which leaves are recomputed from a text with A-Z as a-z; by default those where 3
    divides the crc32 of the decimal id. ``copies`` are the nodes that the version of a tampered leaf adds, from the
    leaf's parent to the root; null elsewhere. Null fields are ``-``, null languages a tree of their own, the first. Null
    ids come first and are not tampered with; rows with one id are ordered by leaf. A table of one row is its own root.
    An empty table gives no rows. Extra columns are ignored.
    """
    rows = as_table(docs, doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = rows.select(
        "doc_id",
        "lang",
        F.lit(1).alias("one"),
        leaf([*others, F.col("text")]).alias("node"),
        F.when(tampered, leaf([*others, F.translate("text", UPPER, LOWER)])).alias("tampered"),
    )
    ordered = stored(with_running(leaves, ["lang"], ["doc_id", "node"], {"one": "index"}), "leaves")
    langs = ordered.groupBy("lang").agg(F.max("total_index").alias("nodes")).withColumn("one", F.lit(1))
    langs = stored(with_running(langs, [], ["lang"], {"one": "tree"}).withColumnRenamed("before_tree", "tree"), "langs")
    most = langs.agg(F.max("nodes").alias("nodes"), F.count("*").alias("langs")).first()
    named = langs.select(F.col("lang").alias("of"), "tree", "nodes")
    nodes = ordered.join(named, F.expr("lang <=> of")).select(
        "tree", F.col("before_index").alias("index"), "nodes", "node", "tampered", "doc_id"
    )
    nodes = stored(nodes, "nodes")

    tiers = _tiers(nodes, most["nodes"] or 0, levels)
    subroots = tiers[-1].select("tree", F.col("node").alias("subroot"))
    top = tiers[-1].select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("index"), F.lit(most["langs"]).cast("bigint").alias("nodes"), "node")
    top_tiers = _tiers(top, most["langs"], levels)
    no_sides = F.expr("CAST(array() AS ARRAY<STRUCT<left: STRING, right: STRING>>)")
    root = top_tiers[-1].select("tree", "index", no_sides.alias("above"), F.col("node").alias("root"), F.col("node").alias("subroot"))
    # The paths of the languages' roots become the paths at the single node of each language's last tier.
    above = _down(top_tiers, root, levels).select(F.col("index").alias("tree"), F.lit(0).cast("bigint").alias("index"), "above", "root")
    above = above.join(subroots, "tree").select("tree", "index", "above", "root", "subroot")
    above = _down(tiers[1:], above, levels) if len(tiers) > 1 else above
    proofs = _with_paths(nodes, above, _proofs, _DDL_PROOF, levels)
    return proofs.withColumn("verified", F.expr("folded_root = root")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "copies"
    )


def _levels_sql(name: str, levels: int) -> list[str]:
    """The nodes (t, i, d, c) of each level over ``<name>0`` and, beside each node, its joined siblings; a single node
    stays as it is."""
    parts = []
    for n in range(levels):
        here = f"{name}{n}"
        parts.append(
            f"{name}{n + 1} AS (SELECT t, j AS i, CASE WHEN c > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE any_value(d) END AS d,"
            f" count(*) OVER (PARTITION BY t) AS c FROM (SELECT *, i // 8 AS j FROM {here}) GROUP BY t, j, c)"
        )
        parts.append(
            f"{name}_beside{n} AS (SELECT a.t, a.i, a.c > 1 AS many, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,"
            f" coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r"
            f" FROM {here} a JOIN {here} b ON a.t = b.t AND a.i // 8 = b.i // 8 GROUP BY a.t, a.i, a.c)"
        )
    return parts


def oracle_sql(levels: int, top_levels: int) -> str:
    """The manifest level by level, for up to 8 ** levels documents of a language and 8 ** top_levels languages."""
    low = f"translate(text, '{UPPER}', '{LOWER}')"

    def leaf_sql(text: str) -> str:
        fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"

    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    crc = f"xor(list_reduce({codes}, lambda a, b: xor(a >> 8, entries[CAST((xor(a, b) & 255) + 1 AS INT)]), 4294967295), 4294967295)"
    parts = [
        """crc_table AS (SELECT list(list_reduce(range(9), lambda a, b: CASE WHEN b = 0 THEN a
    ELSE xor(a >> 1, 3988292384 * (a & 1)) END, n) ORDER BY n) AS entries FROM range(256) r(n))""",
        f"""leaves AS (SELECT doc_id, lang, {leaf_sql("text")} AS leaf,
    CASE WHEN {crc} % 3 = 0 THEN {leaf_sql(low)} END AS changed FROM documents, crc_table)""",
        """placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves)""",
        "n0 AS (SELECT t, i, leaf AS d, count(*) OVER (PARTITION BY t) AS c FROM placed)",
        *_levels_sql("n", levels),
        f"u0 AS (SELECT 0 AS t, t AS i, d, count(*) OVER () AS c FROM n{levels})",
        *_levels_sql("u", top_levels),
        "f0 AS (SELECT doc_id, t, i, leaf, coalesce(changed, leaf) AS x, '' AS proof FROM placed)",
    ]
    beside = [(f"n_beside{n}", "f.t", f"f.i // {8**n}") for n in range(levels)]
    beside += [(f"u_beside{n}", "0", f"f.t // {8**n}") for n in range(top_levels)]
    for n, (table, tree, at) in enumerate(beside):
        parts.append(
            f"f{n + 1} AS (SELECT doc_id, f.t, f.i, leaf, CASE WHEN many THEN sha256(l || x || r) ELSE x END AS x, proof || l || r AS proof"
            f" FROM f{n} f JOIN {table} b ON b.t = {tree} AND b.i = {at})"
        )
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, s.d AS subroot, u.d AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = u.d AS verified
FROM f{len(beside)} f JOIN n{levels} s ON s.t = f.t, u{top_levels} u"""


ORACLE_SQL = oracle_sql(levels=9, top_levels=3)
