"""Source divergence, source mixing and the Merkle manifest against plain counterparts, with odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle_manifest, ranges, source_divergence, source_mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["part", "term", "tree", "index", "node", "place", "start", "size", "rank", "`a.b`"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="session")
def mixed_rows(odd_rows):
    """Odd texts with null and empty languages and sources, null and repeated ids, whole rows twice."""
    langs, sources = ["en", "en", "de", None, "", "en"], ["a", "b", "é", None, "", "B", "a"]
    rows = [(i, text, langs[i % 6], sources[i % 7], None if i % 5 == 0 else len(text or "")) for i, text in odd_rows]
    rows += [(None, "One ÉTÉ two", "en", "a", 3), (None, "", "en", "a", None), (3, "same id", "en", "a", 7), (3, "SAME ID", "en", "b", 7)]
    rows += [rows[10], rows[10], (900, "Long Words " * 20_000, "de", "a", 1)]
    return rows


@pytest.fixture(scope="session")
def mixed_docs(spark, mixed_rows):
    docs = spark.createDataFrame(mixed_rows, SCHEMA)
    return docs.withColumns({c.strip("`"): F.lit("x") for c in EXTRA}).repartition(3).cache()


def sql_rows(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted([tuple(r) for r in result.fetchall()], key=repr), names


# --- running sums ----------------------------------------------------------------------------------


def test_running_sums_over_hot_and_null_groups(spark):
    rows = [(g, i, (i * 7) % 5) for g, n in (("hot", 500), ("b", 3), (None, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i long, x long").repartition(5)
    got = {(r["g"], r["i"]): (r["before_sum"], r["total_sum"]) for r in ranges.with_running(df, ["g"], ["i"], {"x": "sum"}).collect()}
    for g, i, _ in rows:
        own = [(j, x) for h, j, x in rows if h == g]
        assert got[g, i] == (sum(x for j, x in own if j < i), sum(x for _, x in own))


# --- source divergence -----------------------------------------------------------------------------


def brute_audit(rows, min_docs, top):
    docs = defaultdict(list)
    for _, text, lang, source, _ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        docs[lang or "", source or ""].append(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
    out = []
    for lang in {k[0] for k in docs}:
        groups = {s: d for (own, s), d in docs.items() if own == lang}
        seen = Counter(t for d in groups.values() for words in d for t in set(words))
        kept = [t for t, n in seen.items() if n >= min_docs]
        counts = {s: Counter(t for words in d for t in words if seen[t] >= min_docs) for s, d in groups.items()}
        share = lambda c, n: 1 + (10**9 * (c + 5)) // (n + 5 * len(kept))
        whole = sum(counts.values(), Counter())
        for s, own in counts.items():
            p = {t: share(own[t], own.total()) for t in kept}
            pairs = [(o, sum(abs(p[t] - share(c[t], c.total())) for t in kept)) for o, c in counts.items() if o != s]
            terms = [(t, p[t] - share(whole[t], whole.total())) for t in kept if own[t]]
            for part, items, most in (("pair", pairs, None), ("term", [x for x in terms if x[1] > 0], top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, n) for n, (item, value) in enumerate(ranked, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_docs", [1, 3, 1000])
def test_divergence_against_brute_force(mixed_rows, mixed_docs, min_docs):
    expected = brute_audit(mixed_rows, min_docs, 4)
    assert expected
    assert rows_of(source_divergence.audit_sources(mixed_docs, min_docs, top=4)) == expected


def test_path_tree_hands_over_in_pieces():
    """Sums handed on between paths add up to those of every node with every ancestor."""
    tree = source_divergence.PathTree()
    paths = sorted([[(0, 5, 1), (1, 4, 2)], [(0, 5, 1), (1, 4, 2), (2, 9, 1)], [(1, 3, 2), (2, 8, 1)], [(0, 5, 1), (2, 7, 1)]])
    whole = np.zeros((3, 3), np.int64)
    for k, path in enumerate(paths):
        tree.add(np.array(path), k + 1)
        if k % 2:
            for batch in tree.take():
                for a, b, v in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "value")]):
                    whole[a, b] += v
    tree.close(0)
    for batch in tree.take():
        for a, b, v in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "value")]):
            whole[a, b] += v
    expected = np.zeros((3, 3), np.int64)
    for k, path in enumerate(paths):
        for j, (b, pb, zb) in enumerate(path):
            for a, pa_, za in path[:j]:
                expected[a, b] += (k + 1) * (abs(pa_ - pb) - abs(pa_ - zb) - abs(za - pb) + abs(za - zb))
    assert (whole == expected).all() and expected.any()


def test_counts_handed_over_early(mixed_rows, monkeypatch):
    rows = [(lang or "", source or "", text or "") for _, text, lang, source, _ in mixed_rows]
    batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), r)) for r in rows])

    def counted():
        n, docs = Counter(), Counter()
        for out in source_divergence._counted(iter([batch])):
            for r in out.to_pylist():
                n[r["lang"], r["source"], r["term"]] += r["n"]
                docs[r["lang"], r["source"], r["term"]] += r["docs"]
        return n, docs

    whole = counted()
    monkeypatch.setattr(source_divergence, "HELD_COUNTS", 10)
    assert counted() == whole
    assert whole[0]["en", "a", ""] == whole[1]["en", "a", ""] == sum(r[:2] == ("en", "a") for r in rows)


def test_divergence_of_empty_and_wordless_tables(spark):
    assert source_divergence.audit_sources(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None, "en", "a", None), (2, "12 %", "en", "b", 3), (3, "", None, None, 0)]
    got = rows_of(source_divergence.audit_sources(spark.createDataFrame(rows, SCHEMA)))
    assert got == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_share_is_exact_beyond_64_bits(spark):
    n, size, terms = 9 * 10**15, 10**16, 10**6
    got = spark.range(1).select(source_divergence.share(f"{n}L", f"{size}L", f"{terms}L")).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (size + 5 * terms)


# --- source mixing ---------------------------------------------------------------------------------


def filled(sizes, weights=(5, 2, 1), most=3):
    """Resharing the excess, literally."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in held]
        rest = total - sum(held.values())
        target = {s: Fraction(rest * weight[s], sum(weight[t] for t in free)) for s in free}
        over = [s for s in free if target[s] > most * sizes[s]]
        if not over:
            return {**held, **target}
        held |= {s: most * sizes[s] for s in over}


def test_targets_are_those_of_resharing(spark):
    sizes = {"a": 10, "b": 100_000, "B": 7, "é": 0, "": 5_000, None: 900, "z": 30_000, "zz": 1}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_mixing.source_targets(df).collect()}
    assert got == {s: float(t) for s, t in filled(sizes).items()}
    assert sum(filled(sizes).values()) == sum(sizes.values())


def test_seats_go_to_the_highest_quotients(spark):
    sizes = {"a": 5_000, "b": 3_000, "c": 7, "d": 1_234, "e": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    targets = source_mixing.source_targets(df).cache()
    dealt = rows_of(source_mixing.seats(targets, block=16, shard=10))
    own = {r["place"]: (r["target"], r["source_size"]) for r in targets.collect()}
    quotients = [(-t / (2 * k + 1), place, k) for place, (t, size) in own.items() for k in range(3 * -(-size // 16))]
    wanted = round(sum(sizes.values()) / 16)
    assert dealt == sorted(((place, k, n // 10) for n, (_, place, k) in enumerate(sorted(quotients)[:wanted])), key=repr)


def test_mixing_against_sql(mixed_rows, mixed_docs):
    expected, names = sql_rows(mixed_rows, source_mixing.ORACLE_SQL)
    got = source_mixing.taken_words(source_mixing.mix_sources(mixed_docs))
    assert rows_of(got.select(*names)) == expected and len(expected) == len(mixed_rows)
    assert all(r["taken"] <= 3 * r["size"] for r in got.collect())


def test_mixing_comes_near_its_targets_and_shards_take_their_quotas(mixed_docs):
    mix = source_mixing.mix_sources(mixed_docs, block=8, shard=50)
    by_source = mix.documents.join(
        mix.pieces.groupBy("place", "start").agg(F.sum("words").alias("taken")), ["place", "start"], "left"
    ).filter("size > 0")
    for r in by_source.groupBy("place", "target", "source_size").agg(F.sum("taken").alias("taken")).collect():
        assert abs((r["taken"] or 0) - r["target"]) <= 4 * 8
    quotas = {(r["shard"], r["place"]): r["blocks"] for r in mix.quotas.collect()}
    for r in mix.pieces.groupBy("shard", "place").agg(F.sum("words").alias("words")).collect():
        assert quotas[r["shard"], r["place"]] * 8 - 24 <= r["words"] <= quotas[r["shard"], r["place"]] * 8
    sums = Counter()
    for (shard, _), blocks in quotas.items():
        sums[shard] += blocks
    assert set(list(sums.values())[:-1]) <= {50, min(sums.values())}


def test_mixing_again_and_in_other_partitions_agrees(mixed_docs):
    one = source_mixing.taken_words(source_mixing.mix_sources(mixed_docs))
    two = source_mixing.taken_words(source_mixing.mix_sources(mixed_docs.repartition(7, "text")))
    assert rows_of(one) == rows_of(two)


def test_mixing_unfolds_in_pieces(spark, mixed_docs, monkeypatch):
    whole = rows_of(source_mixing.taken_words(source_mixing.mix_sources(mixed_docs)))
    monkeypatch.setattr(source_mixing, "_UNFOLD", 3)
    assert rows_of(source_mixing.taken_words(source_mixing.mix_sources(mixed_docs))) == whole


def test_mixing_of_empty_and_wordless_tables(spark):
    assert source_mixing.taken_words(source_mixing.mix_sources(spark.createDataFrame([], SCHEMA))).collect() == []
    rows = [(1, None, "en", "a", None), (2, " \n", "en", None, 2)]
    got = rows_of(source_mixing.taken_words(source_mixing.mix_sources(spark.createDataFrame(rows, SCHEMA))))
    assert got == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


# --- Merkle manifest -------------------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    fields = (doc_id, source, lang, n_chars, text)
    return h("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree_of(nodes):
    """Root and, for each node, the (left, right) siblings level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            run = i - i % 8
            path.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 8])))
        nodes, at = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)], [i // 8 for i in at]
    return nodes[0], paths


def brute_manifest(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = own, *tree_of([leaf_of(r) for r in own])
    root, tops = tree_of([trees[x][1] for x in langs])
    out = []
    for lang, top in zip(langs, tops):
        own, subroot, paths = trees[lang]
        for row, path in zip(own, paths):
            path = path + top
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf_of(row, changed)
            for left, right in path:
                node = h(left, node, right)
            proof = h(*[side for level in path for side in level])
            out.append((row[0], leaf_of(row), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_against_brute_force(mixed_rows, mixed_docs, levels):
    """With blocks of 8 and 64 leaves the trees span several tiers."""
    got = merkle_manifest.merkle_manifest(mixed_docs, levels=levels)
    expected = brute_manifest(mixed_rows)
    assert rows_of(got.drop("copies")) == expected
    assert not all(r[-1] for r in expected) and any(r[-1] for r in expected)
    for r in got.collect():
        tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        assert (r["copies"] is not None) == tampered
        assert not r["copies"] or r["copies"][-1] == r["folded_root"]


def test_manifest_against_sql(mixed_rows, mixed_docs):
    expected, names = sql_rows(mixed_rows, merkle_manifest.ORACLE_SQL)
    assert rows_of(merkle_manifest.merkle_manifest(mixed_docs).select(*names)) == expected


@pytest.mark.parametrize("count", [1, 8, 9, 65])
def test_manifest_of_one_language(spark, count):
    rows = [(i * 3, f"Text {i}", "en", "a", i) for i in range(count)]
    got = rows_of(merkle_manifest.merkle_manifest(spark.createDataFrame(rows, SCHEMA)).drop("copies"))
    assert got == brute_manifest(rows)
    if count == 1:
        assert got[0][1] == got[0][2] == got[0][3]


def test_manifest_of_many_languages(spark):
    rows = [(i, f"Text {i}", f"lang{i % 70}", "a", i) for i in range(150)]
    assert rows_of(merkle_manifest.merkle_manifest(spark.createDataFrame(rows, SCHEMA)).drop("copies")) == brute_manifest(rows)


def test_manifest_of_an_empty_table(spark):
    assert merkle_manifest.merkle_manifest(spark.createDataFrame([], SCHEMA)).collect() == []
