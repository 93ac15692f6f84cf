import random
from collections import Counter

import brute
import corpus_pipeline
import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, cover_tree, graph, line_dedup, projection_forest, queries, toxicity, url_templates, warc_revisits

SMALL = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def plain(frame):
    return sorted(
        repr([None if pd.isna(v) else float(v) if isinstance(v, (int, float, np.number)) else str(v) for v in row])
        for row in frame[sorted(frame.columns)].astype(object).itertuples(index=False, name=None)
    )


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    found = queries.queries()[name](spark, SMALL)
    assert plain(found.toPandas()) == plain(con.sql(queries.oracle_sql()[name]).df())


# --- toxicity --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    """Texts of random words; some hold an insult, of which there are whole words and stems."""
    rng = random.Random(4)
    words = ["".join(rng.choices("aeioubdglmnrst", k=rng.randint(3, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(1500):
        text = rng.choices(words, k=rng.randint(5, 60))
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 3)):
                bad = rng.choice(["zorkel", "zorkelan", "zorkeline", "vexnut"])
                text.insert(rng.randrange(len(text)), bad)
        rows.append((i, " ".join(text) + "."))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, label int")


def test_python_tasks_get_texts_in_bounded_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["size", "n"])

    spark.conf.unset(common._BATCH_LIMIT)
    docs = spark.range(0, 1000, 1, 1).select("id", F.expr("repeat('some words ', 1000)").alias("text"))
    found = common.as_table(docs, id="id", text="text").mapInArrow(sizes, "size long, n long").toPandas()
    assert found.n.sum() == 1000 and found["size"].max() < 2 * common.BATCH_BYTES
    spark.conf.set(common._BATCH_LIMIT, "100000")
    try:
        found = common.as_table(docs, id="id", text="text").mapInArrow(sizes, "size long, n long").toPandas()
        assert found.n.sum() == 1000 and found["size"].max() < 200_000  # the session's own limit stays
    finally:
        spark.conf.unset(common._BATCH_LIMIT)


def test_toxicity_hands_counts_on(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(20)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array([*texts, None]), pa.array([i % 2 for i in range(61)])], ["text", "label"])
    monkeypatch.setattr(toxicity, "MOST_COUNTED", 100)
    parts = list(toxicity._feature_counts([batch]))
    assert len(parts) > 3 and max(p.num_rows for p in parts) <= 100 + max(len(toxicity.text_features(t)) for t in texts)
    for label, column in ((1, "bad"), (0, "good")):
        total, want = Counter(), Counter()
        for part in parts:
            total.update(dict(zip(part.column("feature").to_pylist(), part.column(column).to_pylist())))
        for text in texts[label::2]:
            want.update(toxicity.text_features(text))
        assert +total == want


def test_toxicity_learns_the_label(labelled):
    docs, labels = labelled
    scored = toxicity.score_documents(docs, labels).join(labels, "doc_id").toPandas()
    for held in (True, False):
        own = scored[scored.held_out == held]
        assert ((own.predicted == own.label).mean() > 0.99) and own.score.between(0, 1).all()
    crc = docs.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("h")).toPandas()
    assert dict(zip(scored.doc_id, scored.held_out)) == dict(zip(crc.doc_id, crc.h))


def test_held_out_labels_are_never_read(labelled):
    docs, labels = labelled
    other = labels.withColumn("label", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("label")).otherwise(F.col("label")))
    one, two = toxicity.fit_toxicity(docs, labels), toxicity.fit_toxicity(docs, other)
    assert one.stems == two.stems and one.words == two.words and (one.weights == two.weights).all()


def test_patterns_of_clauses():
    grammar = toxicity.Grammar({"vexnut": 5.0}, {"zork": 6.0})
    names = toxicity.PATTERNS[1:]

    def matched(text):
        return {n for n, v in zip(names, grammar.features(text)[1:]) if v}

    assert matched("You are a zorkelan") == {"insult", "aimed"}
    assert matched("he is not a vexnut") == {"negated"}
    assert matched("She said he is a vexnut") == {"reported"}
    assert matched("vexnut zorkel") == {"insult", "several"}
    assert matched("I will hurt you") == {"threat", "aimed_threat"}
    assert matched("You. vexnut") == {"insult"}  # another clause
    assert matched("vexnuts and unzorkel") == set() == matched("")


GERMAN = "Die Frau, die er sah, will die Stadt. Das ist die, die sie und ihr Mann kennen. So ist es eben die\nalte. " * 30


def test_german_articles_are_no_threats(labelled):
    grammar = toxicity.Grammar({}, {})
    assert not grammar.features(GERMAN).any()
    for text in ("I hope you die", "You'll die", "they all deserve to die", "he will die"):
        assert grammar.features(text)[1:].sum() > 0
    assert grammar.features("you, will you kill the man")[1:].sum() > 0
    docs, labels = labelled
    german = docs.withColumn("text", F.concat(F.lit(GERMAN), "text"))
    clean = docs.limit(1).select(F.lit(GERMAN).alias("text"))
    fitted = toxicity.fit_toxicity(german, labels)
    threats = [toxicity.PATTERNS.index(p) + 1 for p in ("threat", "aimed_threat")]
    assert np.allclose(fitted.weights[threats], toxicity.PRIOR_WEIGHTS[[i - 1 for i in threats]])
    for model in (toxicity.fit_toxicity(docs, labels.filter("label = 1")), fitted):
        assert clean.select(toxicity.toxicity_score("text", model).alias("s")).first().s < toxicity.THRESHOLD


def test_composition_follows_every_part():
    parts = [toxicity._latch("I", 2), toxicity._negated_insult(3), toxicity._reported_first()]
    table, states = toxicity.composed(parts)
    rng = random.Random(1)
    for _ in range(200):
        state, own = 0, [0, 0, 0]
        for s in rng.choices(toxicity.SYMBOLS, k=12):
            state = table[state][s]
            own = [p.step[i][s] for p, i in zip(parts, own)]
        assert states[state] == tuple(own)


def test_toxicity_edges(labelled, clashing):
    docs, labels = labelled
    scored = toxicity.score_documents(clashing, labels.filter("label = 1")).collect()
    assert len(scored) == 3 and all(0 <= r.score < 0.7 and not r.predicted for r in scored)
    assert [r.held_out for r in scored if r.doc_id is None] == [False]
    assert toxicity.score_documents(docs.filter("doc_id < 0"), labels).count() == 0
    empty = docs.limit(1).select(F.lit(1).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    assert toxicity.score_documents(empty, labels).first().predicted == 0


# --- vectors ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 16))
    x[100:180] = x[100] + rng.normal(size=(80, 16)) * 0.08  # one dense group
    x[200:205] = x[200]
    rows = [(i, x[i].tolist(), int(i % 3) if i >= 180 else 1) for i in range(500)]
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, x[100].tolist(), None)]
    rows += [(504, [None] + x[0].tolist()[1:], 1), (505, [float("inf")] * 16, 2), (None, x[0].tolist(), 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)


@pytest.mark.parametrize("block", [2048, 32])
def test_cover_tree_pairs_are_exact(vectors, block, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    found = {r.id: (r.n_links, r.component_id, r.kept) for r in cover_tree.cosine_groups(vectors).collect()}
    rows = [r for r in vectors.collect() if r.vec_id is not None]
    good = [r for r in rows if r.vec_id < 500]
    x = np.array([r.embedding for r in good])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r.label for r in good])
    links = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(links, False)
    union = brute.Union([r.vec_id for r in rows])
    for i, j in np.argwhere(links):
        union.join(good[i].vec_id, good[j].vec_id)
    counts = {r.vec_id: int(n) for r, n in zip(good, links.sum(axis=1))}
    assert links.sum() > 4000
    assert found == {r.vec_id: (counts.get(r.vec_id, 0), union.find(r.vec_id), union.find(r.vec_id) == r.vec_id) for r in rows}


def test_cover_tree_radii_cover():
    x = cover_tree.unit(np.random.default_rng(2).normal(size=(200, 4)))
    tree = cover_tree.CoverTree(x)
    owner = tree.leaf
    for level in range(len(tree.levels) - 1, 0, -1):
        centres, parents, radii = tree.levels[level]
        gap = np.sqrt(((x - x[centres[owner]]) ** 2).sum(axis=1))
        assert (gap <= radii[owner] + 1e-12).all() and (gap <= 2.0 ** (1 - level) + 1e-9).all()
        assert set(tree.levels[level - 1][0]) <= set(centres)  # nested
        owner = parents[owner]


def test_cover_tree_empty(vectors):
    assert cover_tree.cosine_groups(vectors.filter("vec_id < 0")).count() == 0


@pytest.mark.parametrize("block", [4096, 64])
def test_forest_recall_and_scores(vectors, block, monkeypatch):
    monkeypatch.setattr(projection_forest, "BLOCK", block)
    monkeypatch.setattr(projection_forest, "QUERY_BLOCK", 10)
    found = projection_forest.nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0")).toPandas()
    good = {r.vec_id: np.array(r.embedding) for r in vectors.collect() if r.vec_id is not None and (r.vec_id < 500 or r.vec_id == 503)}
    hits = wanted = 0
    for q in range(0, 500, 20):
        exact = sorted(((float((good[q] * v).sum()), -i) for i, v in good.items() if i != q), reverse=True)
        own = found[found.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and own.vec_id.nunique() == 20
        assert own.apply(lambda r: abs(r.score - float((good[q] * good[int(r.vec_id)]).sum())) < 1e-12, axis=1).all()
        assert list(zip(-own.score, own.vec_id)) == sorted(zip(-own.score, own.vec_id))
        hits += len({-i for _, i in exact[:20]} & set(own.vec_id))
        wanted += 20
    assert hits / wanted >= 0.9
    assert projection_forest.nearest_neighbours(vectors.filter("vec_id < 0"), vectors.filter("vec_id < 0")).count() == 0
    few = projection_forest.nearest_neighbours(vectors.filter("vec_id < 4"), vectors.filter("vec_id < 4"))
    assert few.count() == 12


# --- graph, urls, archive --------------------------------------------------------------------


def test_components_match_brute_force(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120)]
    union = brute.Union(range(300))
    for a, b in edges:
        union.join(a, b)
    found = graph.connected_components(spark.createDataFrame(edges, "a long, b long"))
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.component for r in found.collect()} == {n: union.find(n) for n in linked}


def test_url_parts_and_rules(spark):
    cases = [
        ("http://A.example.ORG/en/15", "a.example.org", "/en/15", "example.org/en/1", "block"),
        ("https://example.org/es/x?y", "example.org", "/es/x", "example.org/es/", "block"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("ftp://x.com/fr/1#a", "x.com", "/fr/1", "com/fr/", "allow"),
        ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
        ("http://x.org", "x.org", "", None, "allow"),
        ("http://x.org?q=/es/", "x.org", "", None, "allow"),
        ("no url", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], None) for i, c in enumerate(cases)], "page_id long, url string, label int")
    found = url_templates.judge_urls(pages, url_templates.RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [c[1:] for c in cases]
    assert url_templates.judge_urls(pages.filter("page_id < 0")).count() == 0


def test_impure_templates_are_rejected(spark):
    rows = [(i, f"http://h/good/{i}", 1) for i in range(60)] + [(i, f"http://h/bad/{i}", i % 5 == 0 and 1 or 0) for i in range(60)]
    rows += [(i, f"http://h/bad/{i + 500}", None) for i in range(5)] + [(i, f"http://h/words/w{'abcdefghijklmnopqrstuvw'[i]}x/{i}", 1) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, label int")
    found = url_templates.judge_urls(pages).select("path", "template", "verdict").collect()
    verdicts = {(r.path.split("/")[1], r.verdict) for r in found}
    assert verdicts == {("good", "allow"), ("bad", "block"), ("words", "allow")}
    assert {r.template for r in found if "/words/" in r.path} <= {"/words/*/#", "/words/*/~", "/~/*/#"}


@pytest.mark.parametrize("siblings", [11, 12, 40])
def test_siblings_do_not_hide_a_bad_section(spark, siblings):
    names = ["s" + "abcdefghij"[i // 10] + "abcdefghij"[i % 10] for i in range(siblings)]
    rows = [(i, f"http://h/bad/{i}", 0) for i in range(100)] + [(i, f"http://h/{n}/{i}", 1) for n in names for i in range(80)]
    rows += [(1, "http://h/rare/1", None), (1, "http://h/bad/900", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, label int")
    found = {(r.path.split("/")[1], r.template, r.verdict) for r in url_templates.judge_urls(pages).collect()}
    assert {x for x in found if x[0] == "bad"} == {("bad", "/bad/#", "block")}
    assert {v for n, _, v in found if n != "bad"} == {"allow"}
    assert {t for n, t, _ in found if n == "rare"} == {"/~/#" if siblings < 11 else "/*/#"}


def test_deep_branches_have_their_own_purity(spark):
    rows = [(i, f"http://h/a/b/c/d/{n}/x/{i}", int(n == "good")) for n in ("good", "bad") for i in range(100)]
    rows += [(1, "http://h/a/b/c/d/bad/x/777", None), (1, "http://h/a/b/c/d/good/x/777", None), (1, "http://g/" + "q/" * 60, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, label int")
    found = {(r.template, r.verdict) for r in url_templates.judge_urls(pages).collect()}
    assert found >= {("/a/b/c/d/good/x/#", "allow"), ("/a/b/c/d/bad/x/#", "block")} and len(found) == 3


def test_revisits(spark):
    head = {"Content-Type": "text/html", "Date": "1"}
    rows = [
        (1, "http://A.x/p?b=2&a=1", 10, 200, '"e1"', None, head, "d1"),
        (2, "http://a.x:80/p?a=1&b=2&utm_x=3#f", 20, 304, 'W/"e1"', None, {"Date": "2", "Content-Type": "no", "ETag": '"e1"'}, None),
        (3, "http://a.x/p?a=1&b=2", 30, 200, '"e2"', None, head, "d3"),
        (4, "http://a.x/p?a=1&b=2", 30, 304, '"e1"', None, None, None),
        (5, "http://a.x/p?a=1&b=2", 31, 304, None, 7, None, None),
        (6, "http://a.x/q", 5, 304, '"e1"', None, None, None),
        (7, None, 50, 304, '"e1"', None, None, None),
        (8, None, 40, 200, '"e1"', None, head, "d8"),
    ]
    kind = "record_id long, url string, ts long, status int, etag string, last_modified long, headers map<string,string>, digest string"
    records = spark.createDataFrame(rows, kind)
    found = {r.record_id: r for r in warc_revisits.resolve_revisits(records).collect()}
    assert {i: (r.outcome, r.base_id, r.digest) for i, r in found.items()} == {
        1: ("response", 1, "d1"), 2: ("resolved", 1, "d1"), 3: ("response", 3, "d3"), 4: ("changed", None, None),
        5: ("unchecked", 3, "d3"), 6: ("no_response", None, None), 7: ("no_response", None, None), 8: ("response", 8, "d8"),
    }
    assert found[2].headers == {"content-type": "text/html", "date": "2", "etag": '"e1"'}
    assert warc_revisits.resolve_revisits(records.filter("record_id < 0")).count() == 0
    many = spark.createDataFrame(
        [(i, "http://hot/", i, 200 if i % 97 == 0 else 304, None, None, {}, str(i)) for i in range(2000)], kind
    ).repartition(5)
    hot = warc_revisits.resolve_revisits(many).collect()
    assert all(r.base_id == r.record_id // 97 * 97 for r in hot)


def test_revisits_of_index_pages(spark):
    urls = ["http://a/", "http://a/index.html", "http://a/d/index.php?b=1", "http://a/d?b=1", "http://a/myindex.html", "http://a/index.html/x"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "record_id long, url string")
    names = [r.c for r in frame.select("record_id", warc_revisits.canonical_url(F.col("url")).alias("c")).orderBy("record_id").collect()]
    assert names == ["http://a", "http://a", "http://a/d?b=1", "http://a/d?b=1", "http://a/myindex.html", "http://a/index.html/x"]
    records = frame.filter("record_id < 2").selectExpr(
        "record_id", "url", "record_id AS ts", "IF(record_id = 0, 200, 304) AS status", "'e' AS etag", "CAST(NULL AS LONG) AS last_modified",
        "CAST(NULL AS MAP<STRING,STRING>) AS headers", "CAST(record_id AS STRING) AS digest",
    )
    found = warc_revisits.resolve_revisits(records).filter("record_id = 1").first()
    assert (found.outcome, found.base_id) == ("resolved", 0)


# --- the pipeline ----------------------------------------------------------------------------


def test_pipeline_stages_match_brute_force(spark, odd_rows, tmp_path):
    rng = random.Random(8)
    rows = [*odd_rows, *((1000 + i, "you are a zorkelan fool " * 2 + " ".join(rng.choices("abcdefgh", k=30))) for i in range(30))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, 1, int(i >= 1000)) for i, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram Jaccard join", "suffix-array dedup", "packing"]
    left = dict(rows)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, str(tmp_path))
        result.write.parquet(f"{tmp_path}/{k}")
        result = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "packing":
            assert set(left) == {r.doc_id for r in result.select("doc_id").distinct().collect()}
            break
        assert result.columns == docs.columns
        found = {r.doc_id: r.text for r in result.collect()}
        if name == "toxicity":
            left = {i: t for i, t in left.items() if i < 1000}
        elif name == "line dedup":
            left = brute.line_dedup(list(left.items()))
        elif name == "n-gram Jaccard join":
            groups = brute.shingle_groups(list(left.items()), 5, 80)
            left = {i: t for i, t in left.items() if groups[i][1] == i}
        else:
            kept = brute.suffix_removal(list(left.values()))
            left = {i: t if t is None else k[4].decode(errors="ignore") for (i, t), k in zip(left.items(), kept)}
        assert found == left
        assert all(r.n_chars == len(r.text) for r in result.collect() if r.text)
        docs = result


def test_chunk_boundaries_shift_with_the_lines(spark):
    passage = "\n".join(f"row {i}" for i in range(40))
    docs = spark.createDataFrame([(1, passage), (2, "new\n" + passage), (3, "a\nb\nc\n" + passage)], "doc_id long, text string")
    removed = {r.doc_id: r.lines_removed for r in line_dedup.dedup_lines(docs).collect()}
    assert removed[1] == 0 and removed[2] > 20 and removed[3] > 20
