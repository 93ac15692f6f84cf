"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the words of a clause: insults, threats, targets, negation and reported
speech. Their composition is one automaton; the state a clause ends in says which pattern it matches
(an insult at someone, a negated insult, a reported threat, ...), and a document's score is a logistic
function of the patterns of its clauses. Isolated words have no weight of their own: the same insult
weighs differently when it is negated, reported or aimed at somebody.

Threats, targets, negation and reported speech are fixed word lists. The insult transducer (whole
words and word beginnings, with log-odds) and the pattern weights are learned from labels, on at most
``SAMPLE_ROWS`` labelled rows (those with the smallest hash of their id); labels of held-out rows are
never read. The pattern weights start from prior means, so patterns that labels do not show keep a
sensible meaning. Scoring covers every row, without a shuffle.

Defined results: null and empty texts match nothing and have the score of a text without patterns;
rows that repeat an id are scored one by one; a null id is scored and not held out; without labels, or
with labels of one kind, the grammar has no learned insults and the prior weights; of repeated labels
of an id the larger counts.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_table
from tidemark.sources.scratch import stored

SAMPLE_ROWS = 20_000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
STEMS = (4, 5, 6)
LEAST_DOCUMENTS = 4
LEAST_ODDS = 2.5
MOST_CANDIDATES = 20_000
#: Features that a task counts before it hands the counts on.
MOST_COUNTED = 200_000
#: A feature is taken for the label's if chance makes fewer than ``CHANCE`` of so many features like it.
CHANCE, MOST_FEATURES = 0.01, 1_000_000
NEGATION_REACH = 3

# Word lists of the fixed transducers, in English, French, German and Spanish.
THREATS = frozenset(
    "kill hurt destroy attack murder shoot stab burn beat punish tuer frapper mourir crever töten umbringen "
    "schlagen sterben matar golpear morir".split()
)
TARGETS = frozenset(
    "you your yours he she him her they them their those people tu toi te vous il elle ils elles eux leur du dich dir "
    "ihr euch er sie ihnen tú ti usted ustedes él ella ellos ellas".split()
)
NEGATIONS = frozenset(
    "not no never none isn't aren't wasn't don't doesn't didn't won't can't cannot without ne pas jamais aucun nicht kein "
    "keine keinen nie niemals nunca jamás ningún tampoco sin".split()
)
REPORTS = frozenset(
    "said says say told wrote writes called calls claimed claims quoted quote reported according dit disait appelle "
    "selon sagte sagt schrieb nannte laut dijo dice llamó según".split()
)
#: ``die`` is also the German article and relative pronoun, and there is no language input. It is a threat after
#: an English pronoun only, with nothing but helping words between them (``you will die``, ``they deserve to die``).
DIE = "die"
DIERS = frozenset("you he she him they them those people you'll they'll".split())
HELPERS = frozenset(
    "will would shall should must can could may might ought deserve deserves need needs have has going gonna to all both "
    "just now soon slowly".split()
)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”«»]")
_QUOTES = frozenset("\"“”«»")
_CLAUSE_END = re.compile(r"[.!?;:\n]")

#: Features of a document and their weights before labels are seen: strongest insult, clauses with a
#: plain insult, several insults, an insult at a target, a negated one, a reported one, a threat, a
#: threat at a target.
PATTERNS = ("strength", "insult", "several", "aimed", "negated", "reported", "threat", "aimed_threat")
PRIOR_WEIGHTS = np.array([0.6, 2.0, 0.5, 0.5, -1.5, -1.0, 0.5, 1.5])
PRIOR_BIAS = -3.0
PRIOR_PRECISION = 0.5


# --- transducers -----------------------------------------------------------------------------

#: Symbols of a clause: insult, threat, target, negation, report, any other word.
SYMBOLS = "ITPNRo"


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine over the symbols; ``step[state][symbol]`` is the next state, 0 the start."""

    step: tuple[dict[str, int], ...]


def _latch(symbol: str, most: int = 1) -> Transducer:
    """Counts a symbol up to ``most``."""
    return Transducer(tuple({s: min(i + (s == symbol), most) for s in SYMBOLS} for i in range(most + 1)))


def _negated_insult(reach: int) -> Transducer:
    """States: words that a negation still reaches (0..reach), then: an insult was plain, negated, both."""
    plain, negated, both = 0, 1, 2
    step = []
    outcomes = {None: {plain: plain, negated: negated}, plain: {plain: plain, negated: both}}
    outcomes |= {negated: {plain: both, negated: negated}, both: {plain: both, negated: both}}
    seen = [None, plain, negated, both]
    for outcome, left in product(seen, range(reach + 1)):
        row = {}
        for s in SYMBOLS:
            after = outcomes[outcome][negated if left else plain] if s == "I" else outcome
            row[s] = seen.index(after) * (reach + 1) + (reach if s == "N" else max(0, left - 1))
        step.append(row)
    return Transducer(tuple(step))


def _reported_first() -> Transducer:
    """0 nothing, 1 a report opened the clause, 2 an insult or threat came before any report, 3 after one."""
    first = {s: 1 if s == "R" else 2 if s in "IT" else 0 for s in SYMBOLS}
    opened = {s: 3 if s in "IT" else 1 for s in SYMBOLS}
    return Transducer((first, opened, dict.fromkeys(SYMBOLS, 2), dict.fromkeys(SYMBOLS, 3)))


def composed(parts: list[Transducer]) -> tuple[list[dict[str, int]], list[tuple[int, ...]]]:
    """The product of machines that read the same symbols: its reachable transitions and states."""
    states = [tuple(0 for _ in parts)]
    index, table = {states[0]: 0}, []
    for state in states:
        row = {}
        for s in SYMBOLS:
            after = tuple(p.step[i][s] for p, i in zip(parts, state))
            if after not in index:
                index[after] = len(states)
                states.append(after)
            row[s] = index[after]
        table.append(row)
    return table, states


def somebody_dies(words: list[str], i: int) -> bool:
    """Whether the ``die`` at ``i`` is the English verb of a pronoun before it."""
    before = i - 1
    while before >= 0 and words[before] in HELPERS:
        before -= 1
    return before >= 0 and words[before].replace("’", "'") in DIERS


class Grammar:
    """The composed automaton with a lexicon of insults: words and word beginnings with their log-odds."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.lengths = sorted({len(s) for s in stems})
        machines = [_latch("I", 2), _latch("T"), _latch("P"), _negated_insult(NEGATION_REACH), _reported_first()]
        self.table, states = composed(machines)
        self.patterns = [self._pattern(*state) for state in states]
        heads = sorted([*(re.escape(w) + r"\b" for w in [*words, *THREATS, DIE]), *map(re.escape, stems)], key=len, reverse=True)
        self.trigger = re.compile(r"(?<![^\W\d_])(?:" + "|".join(heads) + ")")

    @staticmethod
    def _pattern(insults: int, threat: int, target: int, negation: int, report: int) -> np.ndarray:
        """Indicators (after ``strength``) of the state a clause ends in."""
        outcome = negation // (NEGATION_REACH + 1)
        reported = report == 3
        plain = outcome in (1, 3) and not reported
        return np.array([
            plain, plain and insults > 1, plain and bool(target), outcome == 2, bool(insults) and reported,
            bool(threat) and not reported, bool(threat and target) and not reported,
        ], float)

    def insult(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for n in self.lengths:
            found = max(found, self.stems.get(word[:n], 0.0))
        return found

    def clause(self, text: str) -> tuple[float, np.ndarray]:
        """Strongest insult and matched patterns of one clause in lower case."""
        state, strongest = 0, 0.0
        words = _WORD.findall(text)
        for i, word in enumerate(words):
            weight = self.insult(word)
            strongest = max(strongest, weight)
            if weight > 0:
                symbol = "I"
            elif word in THREATS or (word == DIE and somebody_dies(words, i)):
                symbol = "T"
            elif word in TARGETS:
                symbol = "P"
            elif word in NEGATIONS:
                symbol = "N"
            elif word in REPORTS or word in _QUOTES:
                symbol = "R"
            else:
                symbol = "o"
            state = self.table[state][symbol]
        return strongest, self.patterns[state]

    def features(self, text: str) -> np.ndarray:
        """What the clauses of a text match; clauses without an insult or threat match nothing."""
        text = text.lower()
        strength, counts, end = 0.0, np.zeros(len(PATTERNS) - 1), -1
        for hit in self.trigger.finditer(text):
            if hit.start() < end:
                continue
            begin = max(text.rfind(c, 0, hit.start()) for c in ".!?;:\n") + 1
            stop = _CLAUSE_END.search(text, hit.start())
            end = stop.start() if stop else len(text)
            strongest, matched = self.clause(text[begin:end])
            strength = max(strength, strongest)
            counts += matched
        return np.concatenate([[strength], np.log1p(counts)])


# --- learning --------------------------------------------------------------------------------


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def text_features(text: str) -> set[str]:
    """Words (``=word``) and word beginnings of a text."""
    words = {w for w in _WORD.findall(text.lower()) if len(w) > 2}
    return {"=" + w for w in words} | {w[:n] for w in words for n in STEMS if len(w) >= n}


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by feature and label, handed on as soon as there are many; a feature may come several times."""
    counts = {0: Counter(), 1: Counter()}

    def counted() -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(names, pa.string()), *(pa.array([counts[c][n] for n in names], pa.int64()) for c in (1, 0))]
        return pa.RecordBatch.from_arrays(columns, ["feature", "bad", "good"])

    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
            counts[label].update(text_features(text.as_py() or ""))
            if len(counts[0]) + len(counts[1]) >= MOST_COUNTED:
                yield counted()
                counts = {0: Counter(), 1: Counter()}
    yield counted()


def _marked(features: frozenset[str]):
    """The label, features and (feature, word before) pairs of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, pairs = [], []
            for text in batch.column("text"):
                words = _WORD.findall((text.as_py() or "").lower())
                own, before = set(), set()
                for previous, word in zip(["", *words], words):
                    for f in text_features(word) & features:
                        own.add(f)
                        before.add(f + " " + previous)
                found.append(sorted(own))
                pairs.append(sorted(before))
            kind = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(found, kind), pa.array(pairs, kind)], ["label", "features", "pairs"]
            )

    return run


def covering_features(rows: list[tuple[int, list[str]]], odds: dict[str, float]) -> list[str]:
    """Features that between them mark the labelled texts, the one that adds most first.

    A feature must mark ``LEAST_DOCUMENTS`` texts that no earlier one has.
    """
    holders: dict[str, dict[int, set[int]]] = defaultdict(lambda: {0: set(), 1: set()})
    for i, (label, features) in enumerate(rows):
        for f in features:
            holders[f][label].add(i)
    chosen, marked = [], set()
    left = set(holders)
    while left:
        gain = {f: len(holders[f][1] - marked) - 50 * len(holders[f][0]) for f in left}
        best = max(left, key=lambda f: (gain[f], odds[f], f))
        if gain[best] < LEAST_DOCUMENTS:
            return chosen
        chosen.append(best)
        marked |= holders[best][1]
        left = {f for f in left if gain[f] >= LEAST_DOCUMENTS and f != best}
    return chosen


def surprising_features(rows: list[tuple[int, list[str], list[str]]], share: float) -> set[str]:
    """Features of labelled texts only, after more different words than chance explains.

    Copies of a text repeat the word before; so what counts is how many words a feature follows.
    """
    before: dict[str, set[str]] = defaultdict(set)
    good, bad = Counter(), Counter()
    for label, features, pairs in rows:
        (bad if label else good).update(features)
        if label:
            for pair in pairs:
                feature, _, word = pair.partition(" ")
                before[feature].add(word)
    needed = np.log(CHANCE / MOST_FEATURES) / np.log(min(max(share, 1e-6), 0.99))
    return {f for f, words in before.items() if len(words) >= needed and good[f] * 500 <= bad[f]}


def without_covered(features: set[str]) -> set[str]:
    """Features that no shorter stem among them stands for."""
    stems = {f for f in features if f[0] != "="}

    def covered(f: str) -> bool:
        word = f.removeprefix("=")
        return any(word[:n] in stems and word[:n] != f for n in STEMS if n <= len(word))

    return {f for f in features if not covered(f)}


def fitted_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bias and pattern weights: logistic regression drawn to the prior weights, by Newton's method."""
    start = np.concatenate([[PRIOR_BIAS], PRIOR_WEIGHTS])
    if not len(y):
        return start
    x = np.hstack([np.ones((len(x), 1)), x])
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + PRIOR_PRECISION * (w - start)
        bend = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_PRECISION * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    words: dict[str, float]
    stems: dict[str, float]
    weights: np.ndarray


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """The model from (doc_id, text) and (doc_id, label), on at most ``sample_rows`` rows that aren't held out."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    picked = usable.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # two numbers for each sampled row
    sample = stored(rows.select("label", "text").dropDuplicates(["text"]), "labelled")
    totals = dict(sample.groupBy("label").count().collect())
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return ToxicityModel({}, {}, fitted_weights(np.zeros((0, len(PATTERNS))), np.zeros(0)))
    counted = sample.mapInArrow(_feature_counts, "feature string, bad long, good long").groupBy("feature")
    counted = counted.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    strong = counted.filter(F.col("bad") >= LEAST_DOCUMENTS).select("feature", odds.alias("odds"), "bad")
    strong = strong.filter(F.col("odds") >= LEAST_ODDS).orderBy(F.desc("bad"), F.desc("odds"), "feature")
    odds_of = {r.feature: r.odds for r in strong.limit(MOST_CANDIDATES).collect()}
    marked = sample.mapInArrow(
        _marked(frozenset(odds_of)), "label int, features array<string>, pairs array<string>"
    ).filter("size(features) > 0")
    seen = [tuple(r) for r in marked.collect()]  # at most sample_rows rows
    chosen = set(covering_features([r[:2] for r in seen], odds_of))
    chosen = without_covered(chosen | surprising_features(seen, bad / (bad + good)))
    words = {f[1:]: odds_of[f] for f in chosen if f[0] == "="}
    stems = {f: odds_of[f] for f in chosen if f[0] != "="}
    kind = "label int, " + ", ".join(f"{p} double" for p in PATTERNS)
    table = sample.mapInArrow(_pattern_rows(words, stems), kind).toPandas()  # at most sample_rows rows
    x, y = table[list(PATTERNS)].to_numpy(float), table["label"].to_numpy(float)
    return ToxicityModel(words, stems, fitted_weights(x, y))


def _pattern_rows(words: dict[str, float], stems: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(words, stems)
        for batch in batches:
            found = np.array([grammar.features(t.as_py() or "") for t in batch.column("text")]).reshape(-1, len(PATTERNS))
            columns = [batch.column("label"), *(pa.array(c) for c in found.T)]
            yield pa.RecordBatch.from_arrays(columns, ["label", *PATTERNS])

    return run


# --- scoring ---------------------------------------------------------------------------------


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """The score of a text column, 0 to 1."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grammar = Grammar(model.words, model.stems)
        for texts in batches:
            found = np.array([grammar.features(t.as_py() or "") for t in texts]).reshape(-1, len(PATTERNS))
            scores = 1 / (1 + np.exp(-np.clip(model.weights[0] + found @ model.weights[1:], -30, 30)))
            yield pa.array(scores)

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "double")(text)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; ``labels``: doc_id and label 0 or 1."""
    rows = as_table(docs, doc_id=id_col, text=text_col)
    model = fit_toxicity(rows, labels)
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
