"""Byte-level BPE with a minimal acyclic transducer for frequent words, exact merges for the rest.

The automaton shares prefixes and suffixes of its words. Each state knows how many words end below it,
so the way of a word through the automaton adds up to its number, and that number points to its ids: the
states can be shared although every word has an output of its own. It is written as flat arrays that
workers map into memory, and whole batches of words walk through it level by level.

Words are white space and what follows up to the next white space; no token of such a vocabulary
crosses the place before white space, so words are encoded alone and texts are their words joined.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import as_table
from tidemark.llm.token_ids import byte_of_sign

#: Words in the automaton, the most frequent of the corpus.
MAX_WORDS = 65_536
#: A task reports words that make up at least this share of its words; every word of such a share in
#: the whole corpus has it in some task.
LEAST_SHARE = 2.0**-20
LONGEST_WORD = 64
#: Distinct words a worker remembers before it starts anew.
REMEMBERED = 400_000
_WORDS = re.compile(r"\s*\S+|\s+").findall
#: Signs that only some white-space definitions take as such, and texts the library must cut itself.
_UNSURE = re.compile("[\x00\x1c-\x1f]|<\\|")
_GAP = "\x00"
_BATCH_CHARS = 4_000_000


# --- the automaton ---------------------------------------------------------------------------


def minimal_automaton(words: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat arrays of the minimal acyclic automaton of sorted distinct words.

    Edges sorted by state * 256 + byte: that key, the target, and the number of words that come before
    the edge's at its state; and for each state whether a word ends there. State 0 is the start.
    """
    registry: dict[tuple, int] = {}
    states: list[tuple] = []  # (ends here, words below, ((byte, state), ...))

    def frozen(node: list) -> int:
        ends, edges = node
        key = (ends, tuple(edges))
        if key not in registry:
            registry[key] = len(states)
            states.append((ends, ends + sum(states[t][1] for _, t in edges), key[1]))
        return registry[key]

    path: list[list] = [[False, []]]
    previous = b""
    for word in words:
        same = 0
        while same < min(len(word), len(previous)) and word[same] == previous[same]:
            same += 1
        while len(path) > same + 1:  # what no later word can change
            node = path.pop()
            path[-1][1].append((previous[len(path) - 1], frozen(node)))
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        previous = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((previous[len(path) - 1], frozen(node)))
    start = frozen(path[0])
    number = {start: 0} | {s: i + 1 for i, s in enumerate(x for x in range(len(states)) if x != start)}
    rows = []
    ends = np.zeros(len(states), dtype=bool)
    for state, (is_end, _, edges) in enumerate(states):
        before = int(is_end)
        ends[number[state]] = is_end
        for byte, target in edges:
            rows.append((number[state] * 256 + byte, number[target], before))
            before += states[target][1]
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2], ends


def write_lexicon(path: str, entries: dict[bytes, list[int]]) -> None:
    """The automaton of the entries and their ids as one flat file of 64-bit numbers."""
    words = sorted(entries)
    keys, targets, before, ends = minimal_automaton(words)
    ids = [entries[w] for w in words]
    offsets = np.cumsum([0, *map(len, ids)])
    sections = [keys, targets, before, ends, offsets, np.array([i for x in ids for i in x], dtype=np.int64)]
    head = np.array([len(s) for s in sections], dtype=np.int64)
    with open(path, "wb") as file:
        file.write(np.concatenate([head, *sections]).astype("<i8").tobytes())


class Lexicon:
    """A lexicon file mapped into memory."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype="<i8", mode="r")
        bounds = 6 + np.cumsum([0, *data[:6]])
        parts = [data[a:b] for a, b in zip(bounds, bounds[1:])]
        self.keys, self.targets, self.before, self.ends, self.offsets, self.ids = parts

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word in the lexicon, -1 for others: all words take each step together."""
        found = np.full(len(words), -1, dtype=np.int64)
        if not len(self.keys):
            return found
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        length = np.fromiter(map(len, words), np.int64, len(words))
        place = np.cumsum(length) - length
        alive, state, total = np.arange(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for step in range(int(length.max(initial=0)) + 1):
            over = length[alive] == step
            done = over & (self.ends[state] == 1)
            found[alive[done]] = total[done]
            go = ~over
            alive, state, total = alive[go], state[go], total[go]
            if not len(alive):
                break
            key = state * 256 + text[place[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive, at = alive[hit], at[hit]
            state, total = self.targets[at], total[hit] + self.before[at]
        return found

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.offsets[number] : self.offsets[number + 1]].tolist()


# --- exact merges ----------------------------------------------------------------------------


class ByteBpe:
    """Ids of words under a byte-level vocabulary file, and the bytes of ids."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        sign = byte_of_sign()
        vocab = self.library.get_vocab(with_added_tokens=False)
        ranks = {bytes(sign[c] for c in token): i for token, i in vocab.items()}
        self.bytes_of = {i: b for b, i in ranks.items()}
        for i, token in self.library.get_added_tokens_decoder().items():
            self.bytes_of[i] = token.content.encode()
        # The vocabulary's own cuts, and a sign between words that no cut crosses.
        pattern = rf"{_GAP}|'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}{_GAP}]+|\s+(?!\S)|\s+"
        self.merges = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.gap = ranks[_GAP.encode()]

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of words by merging pairs, all words in one call; odd ones by the library."""
        odd = [i for i, w in enumerate(words) if w.isspace() or _UNSURE.search(w)]
        plain = words if not odd else [w for i, w in enumerate(words) if i not in set(odd)]
        ids = np.frombuffer(self.merges._core_bpe.encode_to_tiktoken_buffer(_GAP.join(plain), set()), dtype="<u4")
        parts = np.split(ids, np.flatnonzero(ids == self.gap)) if plain else []
        found = iter([p[1:].tolist() if i else p.tolist() for i, p in enumerate(parts)])
        if not odd:
            return list(found)
        rare = set(odd)
        return [self.encode(w) if i in rare else next(found) for i, w in enumerate(words)]

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode(errors="replace")


class Encoder:
    """Texts to ids and back: remembered words, else the automaton, else merges."""

    def __init__(self, tokenizer: str, lexicon: str | None = None):
        self.bpe = ByteBpe(tokenizer)
        self.lexicon = Lexicon(lexicon) if lexicon else None
        self.ids: dict[str, str] = {}  # decimal ids of a word, each followed by a comma
        self.texts: dict[str, str] = {}  # decoded words that differ from themselves

    def learn(self, words: set[str]) -> None:
        if len(self.ids) > REMEMBERED:
            self.ids, self.texts = {}, {}
        new = [w for w in words if w not in self.ids]
        coded = [w.encode() for w in new]
        numbers = self.lexicon.numbers(coded) if self.lexicon else np.full(len(new), -1)
        unseen = np.flatnonzero(numbers < 0).tolist()
        ids: list = [None if n < 0 else self.lexicon.ids_of(n) for n in numbers.tolist()]
        for i, merged in zip(unseen, self.bpe.merge([new[i] for i in unseen])):
            ids[i] = merged
        pieces = self.bpe.bytes_of.__getitem__
        for word, own, code in zip(new, ids, coded):
            self.ids[word] = ",".join(map(str, own)) + "," if own else ""
            if b"".join(map(pieces, own)) != code:
                self.texts[word] = self.bpe.decode(own)

    def run(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """For each text its ids (decimal, joined by commas) and the text they decode to."""
        cut = [None if _UNSURE.search(t) else _WORDS(t) for t in texts]
        self.learn(set().union(*filter(None, cut)))
        for text, words in zip(texts, cut):
            if words is None:
                ids = self.bpe.encode(text)
                yield ",".join(map(str, ids)), self.bpe.decode(ids)
            else:
                joined = "".join(map(self.ids.__getitem__, words))
                back = map(self.texts.get, words, words) if self.texts else words
                yield joined[:-1], "".join(back)


@cache
def _encoder(tokenizer: str, lexicon: str) -> Encoder:
    """The encoder of this worker process; the lexicon is a file Spark has brought to it."""
    return Encoder(tokenizer, SparkFiles.get(lexicon))


# --- Spark jobs ------------------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    seen = 0
    for batch in batches:
        for text in batch.column("text"):
            words = _WORDS(text.as_py() or "")
            counts.update(words)
            seen += len(words)
        if len(counts) > 2_000_000:  # keep what can still reach the share
            counts = Counter({w: n for w, n in counts.items() if n > seen * LEAST_SHARE / 2})
    least = max(2, seen * LEAST_SHARE)
    kept = [(w, n) for w, n in counts.items() if n >= least and len(w.encode()) <= LONGEST_WORD]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"]
    )


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = MAX_WORDS) -> DataFrame:
    """(word, n): at most ``most`` words of the corpus, the most frequent ones."""
    counted = as_table(docs, text=text_col).mapInArrow(_count_words, "word string, n long")
    total = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return total.orderBy(F.desc("n"), "word").limit(most)


def ship_lexicon(docs: DataFrame, tokenizer: str, text_col: str = "text", most: int = MAX_WORDS) -> str:
    """Compile the frequent words and give the file to all executors, present and future; its name there."""
    bpe = ByteBpe(tokenizer)
    words = [w for w, _ in frequent_words(docs, text_col, most).collect() if not _UNSURE.search(w)]  # at most ``most``
    name = f"lexicon-{uuid.uuid4().hex}"
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    write_lexicon(path, dict(zip([w.encode() for w in words], bpe.merge(words))))
    docs.sparkSession.sparkContext.addFile(path)
    return name


def encode_decode(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", texts: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; with ``texts`` also ids and decoded.

    Checksums of the decimal ids joined by commas and of the decoded text. A null text is an empty one;
    rows that repeat an id each give a row; null ids stay null; an empty table gives none.
    """
    rows = as_table(docs, doc_id=id_col, text=text_col)
    lexicon = ship_lexicon(docs, tokenizer, text_col)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if texts else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, lexicon)

        def result(ids: pa.Array, held: list[str]) -> pa.RecordBatch:
            found = list(encoder.run(held))
            columns = [
                ids,
                pa.array([i.count(",") + 1 if i else 0 for i, _ in found], pa.int64()),
                pa.array([sha256(i.encode()).hexdigest() for i, _ in found], pa.string()),
                pa.array([sha256(t.encode()).hexdigest() for _, t in found], pa.string()),
            ]
            if texts:
                columns += [pa.array([i for i, _ in found], pa.string()), pa.array([t for _, t in found], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            held, size, start = [], 0, 0
            for i, text in enumerate(batch.column("text")):
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size > _BATCH_CHARS:
                    yield result(batch.column("doc_id").slice(start, len(held)), held)
                    held, size, start = [], 0, i + 1
            yield result(batch.column("doc_id").slice(start, len(held)), held)

    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + (", ids string, decoded string" if texts else ""))
