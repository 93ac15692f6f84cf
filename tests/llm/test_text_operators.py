import zlib
from hashlib import md5, sha256

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import line_dedup, ngram_join, packing, suffix_dedup, suffix_sort, token_ids, word_automaton

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")


def empty(docs):
    return docs.filter("doc_id < 0")


# --- line dedup ------------------------------------------------------------------------------


def test_line_dedup_matches_brute_force(spark, documents, odd_rows):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(i + 10_000, t) for i, t in odd_rows]
    shared = "\n".join(f"line {i} of a passage" for i in range(30))
    rows += [(20_000 + i, f"own {i}\n{shared}\nend {i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.text, r.lines_removed) for r in line_dedup.dedup_lines(docs).collect()}
    want = brute.line_dedup(rows)
    assert {i: t for i, (t, _) in found.items()} == want
    assert sum(n for _, n in found.values()) > 300


def test_repeated_lines_go_in_runs_of_any_length(spark):
    """Passages of 2 to 20 lines at any place among own lines go wholly, empty lines within them too."""
    rows, at = [], 0
    for length in (2, 3, 4, 5, 9, 20):
        for n in range(6):
            passage = [f"passage {length} {n} line {j}" if j % 3 != 1 or length < 4 else "" for j in range(length)]
            for copy in range(3):
                own = [f"own {at} {j}" for j in range(2 * copy + n)]
                rows.append((at, "\n".join([*own[:copy], *passage, *own[copy:]])))
                at += 1
    found = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.text for i, r in found.items()} == brute.line_dedup(rows)
    for i, text in rows:
        lines = [x for x in text.split("\n") if x.startswith("own")]
        assert found[i].text == (text if i % 3 == 0 else "\n".join(lines))


def test_single_lines_stay(spark):
    rows = [(1, "a\n\nb"), (2, "x\n\nb"), (3, "a\n\ny"), (4, "b"), (5, "q\nq\nq\nq"), (6, "\n\n\n"), (7, "\n\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert found == brute.line_dedup(rows)
    assert {i: found[i] for i in (1, 2, 3, 4, 6, 7)} == {i: t for i, t in rows if i != 5} and found[5] == "q"


def test_crowded_windows_give_the_same(documents, monkeypatch):
    want = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents).collect()}
    for share in (1, 10_000_000):  # none looked up map-side, or all
        monkeypatch.setattr(line_dedup, "CROWDED", share)
        assert {r.doc_id: r.text for r in line_dedup.dedup_lines(documents).collect()} == want


def test_hash_with_two_texts_removes_nothing(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_rolled", lambda before, line: F.lit(7).cast("bigint"))
    docs = spark.createDataFrame([(1, "a\nb"), (2, "a\nb"), (3, "c\nd")], "doc_id long, text string")
    assert line_dedup.dedup_lines(docs).filter("lines_removed > 0").count() == 0


def test_small_and_large_corpora_move_alike(spark, capsys):
    """Texts meet their cuts in a sorted merge, also where the cuts are few."""
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "x\na\nb"), (3, "y")], "doc_id long, text string")
    kept = line_dedup.dedup_lines(docs)
    kept.explain()
    assert "SortMergeJoin" in (plan := capsys.readouterr().out) and "Broadcast" not in plan
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "a\nb\nc", 2: "x", 3: "y"}


def test_rows_of_one_id_keep_their_own_lines(spark):
    rows = [(1, "a\nb\nc"), (2, "x\na\nb"), (2, "u\nv\nw"), (2, "x\na\nb")]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in found) == [(1, "a\nb\nc"), (2, "u\nv\nw"), (2, "x"), (2, "x")]


def test_line_dedup_edges(clashing, odd_docs):
    kept = line_dedup.dedup_lines(clashing)
    assert kept.columns == [*clashing.columns, "lines_removed"]
    assert sorted((r.doc_id or 0, r.id) for r in kept.collect()) == [(0, 9), (1, 7), (2, 8)]
    assert line_dedup.dedup_lines(empty(odd_docs)).count() == 0
    twice = odd_docs.filter("doc_id in (88, 45)")
    found = {(r.doc_id, r.text) for r in line_dedup.dedup_lines(twice.union(twice)).collect()}
    assert found == set(brute.line_dedup([tuple(r) for r in twice.collect()]).items())  # no copies of one another


# --- n-gram join -----------------------------------------------------------------------------


@pytest.mark.parametrize("words, threshold", [(3, 90), (5, 80)])
def test_groups_match_brute_force(odd_docs, odd_rows, words, threshold):
    found = ngram_join.shingle_groups(odd_docs, words=words, threshold=threshold).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in found} == brute.shingle_groups(odd_rows, words, threshold)


def test_a_turn_moves_few_sets(spark, monkeypatch):
    """Pairs are searched in as many turns as there are pairs for the sets, and all links are found."""
    moved, real = [], ngram_join._searched
    monkeypatch.setattr(ngram_join, "_searched", lambda pairs, *rest: moved.append(pairs.count()) or real(pairs, *rest))
    shingles = [bytearray(np.arange(i % 3, 40 + i % 3, dtype=np.uint64).tobytes()) for i in range(12)]
    sets = spark.createDataFrame(list(enumerate(shingles)), "node long, shingles binary")
    wanted = [(a, b) for a in range(12) for b in range(a + 1, 12)]
    pairs = spark.createDataFrame(wanted, "query long, node long")
    found = {tuple(r) for r in ngram_join._searched_in_turns(pairs, sets, 95, 4).collect()}
    assert found == {(a, b) for a, b in wanted if abs(a % 3 - b % 3) < 2}  # 39 of 41 shared, or 38 of 42
    assert len(moved) == 5 and sum(moved) == len(wanted)


def test_near_copies_below_the_threshold_are_not_searched_in_pairs(spark, monkeypatch):
    """A large group that shares most parts and few links: the sets searched follow its size, not its square."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        words = base.copy()
        for at in rng.choice(60, 2, replace=False):
            words[at] = f"edit{rng.integers(8)}" if i % 4 else f"new{i}x{at}"
        rows.append((i, " ".join(words)))
    searched, real = [], ngram_join._searched
    monkeypatch.setattr(ngram_join, "_searched", lambda pairs, *rest: searched.append(pairs.count()) or real(pairs, *rest))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.shingle_groups(docs, words=3, threshold=90).collect()}
    assert found == brute.shingle_groups(rows, 3, 90)
    assert sum(searched) <= 3 * len(rows)


def test_nodes_of_a_part_meet_in_a_home(spark):
    """Any two nodes of different components that share a part are both at one home, as its own or as visitors."""
    rng = np.random.default_rng(6)
    parts = sorted({(int(rng.integers(30)), int(rng.integers(20))) for _ in range(90)})
    home = {node: int(rng.integers(6)) for node in range(20)}
    component = {node: int(rng.integers(8)) for node in range(20)}
    placed = spark.createDataFrame([(home[i], i, component[i]) for i in range(20)], "query long, node long, component long")
    visits = ngram_join._visits(spark.createDataFrame(parts, "part long, node long"), placed).collect()
    at = {(home[i], i) for i in range(20)} | {(r.query, r.node) for r in visits}
    for part, a in parts:
        for other, b in parts:
            if part == other and component[a] != component[b]:
                assert any((q, a) in at and (q, b) in at for q in range(6))


def test_linked_pairs_agree_on_as_many_parts_as_they_need():
    """Also where sets are tiny, exactly at the threshold, and in bands side by side."""
    rng = np.random.default_rng(8)
    linked = 0
    for threshold in (80, 90):
        for _ in range(1500):
            n = int(rng.integers(2, 90))
            base = rng.integers(1, 2**63, 3 * n, dtype=np.uint64)
            gone = int(rng.integers(0, max(1, n // 5) + 1))
            a, b = np.unique(base[:n]), np.unique(np.concatenate([base[gone:n], base[n : n + int(rng.integers(0, max(1, n // 5) + 1))]]))
            both = len(np.intersect1d(a, b))
            if len(a) == len(b) == both or 100 * both < threshold * (len(a) + len(b) - both):
                continue
            linked += 1
            keys, owner, needs = ngram_join.parts_and_needs([a, b], threshold)
            common = set(keys[owner == 0]) & set(keys[owner == 1])
            for one in (0, 1):
                agree = [need for key, need in zip(keys[owner == one], needs[owner == one]) if key in common]
                assert any(agree.count(need) >= need >> 1 for need in agree)
    assert linked > 500


def test_a_passage_in_common_makes_no_candidates(spark, monkeypatch):
    """Texts that share a passage, and with it a few parts, are not compared; near copies among them are."""
    rng = np.random.default_rng(9)
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(i, " ".join(f"w{rng.integers(1 << 40)}" for _ in range(110)) + " " + passage) for i in range(120)]
    rows += [(120, rows[7][1] + " more"), (121, rows[40][1] + " again")]
    homes, real = [], ngram_join._common_sets
    monkeypatch.setattr(ngram_join, "_common_sets", lambda found, sets: homes.append(found.count()) or real(found, sets))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.shingle_groups(docs).collect()}
    assert found == brute.shingle_groups(rows, 5, 80)
    assert homes == [4]


def test_groups_edges(clashing, odd_docs):
    assert ngram_join.shingle_groups(empty(odd_docs)).count() == 0
    one = ngram_join.one_of_each_group(clashing)
    assert one.columns == clashing.columns
    assert sorted(r.doc_id or 0 for r in one.collect()) == [0, 1]
    repeated = ngram_join.shingle_groups(odd_docs.filter("doc_id = 1").union(odd_docs.filter("doc_id = 1"))).collect()
    assert [(r.id, r.component_id) for r in repeated] == [(1, 1), (1, 1)]


def test_divide_skip_counts():
    rng = np.random.default_rng(3)
    for required in (1, 2, 5, 9):
        lists = [sorted(rng.choice(40, rng.integers(0, 30), replace=False).tolist()) for _ in range(12)]
        want = {d: n for d in range(40) if (n := sum(d in entries for entries in lists)) >= required}
        assert dict(ngram_join.divide_skip(lists, required)) == want


def test_part_rows_meet_for_every_linked_pair():
    """Pairs exactly at the threshold share a part, also where sets are tiny."""
    rng = np.random.default_rng(1)
    for threshold in (80, 90):
        for _ in range(1500):
            n = int(rng.integers(2, 60))
            base = rng.integers(1, 2**63, 2 * n, dtype=np.uint64)
            shared = int(rng.integers(1, n + 1))
            a = np.unique(base[:n])
            b = np.unique(np.concatenate([base[:shared], base[n : n + int(rng.integers(0, max(1, n // 5) + 1))]]))
            both = len(np.intersect1d(a, b))
            if len(a) == len(b) == both or 100 * both < threshold * (len(a) + len(b) - both):
                continue
            keys, owner = ngram_join.part_rows([a, b], threshold)
            assert set(keys[owner == 0]) & set(keys[owner == 1])


# --- suffix dedup ----------------------------------------------------------------------------


def test_suffix_dedup_matches_brute_force(odd_docs, odd_rows):
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(odd_docs).collect()}
    for (i, text), want in zip(odd_rows, brute.suffix_removal([t for _, t in odd_rows])):
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[:4]
        assert r.kept_text == (None if text is None else want[4].decode(errors="ignore"))


def test_crowded_anchors_give_the_same(odd_docs, monkeypatch):
    names = ["doc_id", "n_removed", "n_spans", "kept_sha256"]
    want = suffix_dedup.remove_repeats(odd_docs).select(names).toPandas().sort_values("doc_id")
    monkeypatch.setattr(suffix_dedup, "MOST_SEGMENTS", 1)
    found = suffix_dedup.remove_repeats(odd_docs).select(names).toPandas().sort_values("doc_id")
    assert found.values.tolist() == want.values.tolist()


def test_suffix_dedup_edges(clashing, odd_docs):
    rest = suffix_dedup.without_repeats(clashing)
    assert rest.columns == clashing.columns and rest.count() == 3
    assert suffix_dedup.remove_repeats(empty(odd_docs)).count() == 0
    twice = odd_docs.filter("doc_id = 45").union(odd_docs.filter("doc_id = 45"))
    assert [r.n_removed == r.n_bytes for r in suffix_dedup.remove_repeats(twice).collect()] == [True, True]


def test_wanted_suffixes_alone_are_compared(monkeypatch):
    """Where only some positions are wanted, they come in the same order and few others with them."""
    rng = np.random.default_rng(5)
    data = b"\xff".join(rng.choice(list(b"abcde "), n).astype(np.uint8).tobytes() for n in (700, 300, 20, 500)) + b"\xff"
    wanted = np.zeros(len(data), bool)
    wanted[:200] = wanted[701:760] = wanted[1100:1101] = True
    order = suffix_sort.suffix_array(data, 150, wanted)
    every = suffix_sort.suffix_array(data, 150)
    assert order[wanted[order]].tolist() == every[wanted[every]].tolist()
    assert wanted.sum() <= len(order) <= wanted.sum() + 30


def test_segments_cover_every_string_once():
    """Segments of texts of any length, shorter and longer than a string, and side by side."""
    rng = np.random.default_rng(8)
    texts = [rng.choice(list(b"abc"), n).astype(np.uint8).tobytes() for n in (0, 5, 19, 20, 21, 300, 0, 90, 19, 64)]
    bounds = np.cumsum([0, *map(len, texts)])
    _, _, owner, first, n = suffix_dedup.segments(np.frombuffer(b"".join(texts), np.uint8), bounds, 20, 7)
    places = [(o, f + i) for o, f, m in zip(owner.tolist(), first.tolist(), n.tolist()) for i in range(m)]
    assert places == [(o, i) for o, text in enumerate(texts) for i in range(len(text) - 19)]


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(2)
    for letters in (b"ab", b"abc", b"a", b"abcdefgh"):
        one, two = (rng.choice(list(letters), n).astype(np.uint8).tobytes() for n in (400, 300))
        data = one + b"\xff" + two + b"\xff"
        order = suffix_sort.suffix_array(data, len(data)).tolist()
        assert order == sorted(range(len(data)), key=lambda p: data[p:])


# --- tokens ----------------------------------------------------------------------------------


def test_word_ids_equal_the_library(odd_rows):
    library = Tokenizer.from_file(WORD_FILE)
    texts = [t or "" for _, t in odd_rows] + ["ΣΑΣ İx ﬁ é ½²", "it's 'S don''t '''re", "a_b --- #1,234.56%"]
    for text, ids in zip(texts, token_ids.WordIds(WORD_FILE).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_word_ids_start_anew(odd_rows, monkeypatch):
    texts = [t or "" for _, t in odd_rows]
    want = token_ids.WordIds(WORD_FILE).encode(texts)
    monkeypatch.setattr(token_ids, "MAX_WORDS", 20)
    few, most = token_ids.WordIds(WORD_FILE), 0
    for at in range(0, len(texts), 4):
        assert few.encode(texts[at : at + 4]) == want[at : at + 4]
        most = max(most, len(few.known) - len(set(" ".join(texts[at : at + 4]).split())))
    assert most <= 40


def test_packing_places_every_id_once(spark, odd_docs, odd_rows):
    library = Tokenizer.from_file(WORD_FILE)
    pieces = packing.pack_documents(odd_docs, WORD_FILE, capacity=256, open_windows=4).toPandas()
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in odd_rows}
    assert set(pieces.doc_id) == set(ids)
    for i, own in pieces.sort_values("start").groupby("doc_id"):
        at = 0
        for p in own.itertuples():
            data = np.array(ids[i][at : at + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids[i]), zlib.crc32(data))
            at += p.length
        assert at == len(ids[i])
    fills = []
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]]
        fills.append(int(own.length.sum()))
    assert max(fills) <= 256 and sorted(fills)[1] == 256  # all but one are full


def test_packing_edges(clashing, odd_docs):
    assert packing.pack_documents(empty(odd_docs), WORD_FILE).count() == 0
    assert sorted(r.doc_id or 0 for r in packing.pack_documents(clashing, WORD_FILE).collect()) == [0, 1, 2]


def test_word_automaton_round_trip(odd_docs, odd_rows):
    library = Tokenizer.from_file(BYTE_FILE)
    for r in word_automaton.encode_decode(odd_docs, BYTE_FILE, texts=True).collect():
        ids = library.encode(dict(odd_rows)[r.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.ids, r.decoded, r.n_tokens) == (",".join(map(str, ids)), decoded, len(ids))
        assert r.ids_sha256 == sha256(r.ids.encode()).hexdigest()
        assert r.decoded_sha256 == sha256(decoded.encode()).hexdigest()
    assert word_automaton.encode_decode(empty(odd_docs), BYTE_FILE).count() == 0


def test_automaton_is_minimal_and_complete(tmp_path):
    words = sorted({a + b + c for a in ("walk", "talk", "stalk") for b in ("", "s", "ed", "ing") for c in ("", " ", ".")})
    entries = {w.encode(): [i, i + 1] for i, w in enumerate(words)}
    path = str(tmp_path / "lexicon")
    word_automaton.write_lexicon(path, entries)
    lexicon = word_automaton.Lexicon(path)
    numbers = lexicon.numbers([*entries, b"wal", b"walkx", b""])
    assert [lexicon.ids_of(n) for n in numbers[:-3].tolist()] == list(entries.values())
    assert numbers[-3:].tolist() == [-1, -1, -1]
    tails = {w[i:] for w in entries for i in range(len(w) + 1)}
    assert len(lexicon.ends) < len(tails)  # suffixes are shared


def test_md5_of_the_query_is_of_the_text(spark):
    row = spark.range(1).select(F.md5(F.lit("é")).alias("m")).first()
    assert row.m == md5("é".encode()).hexdigest()
