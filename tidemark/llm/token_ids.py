"""Token ids of whole texts, each distinct word encoded once per worker.

The vocabulary's library decides what a word becomes; repeated words, which are most of a corpus, are
looked up. Cutting at white space is exact: neither vocabulary has tokens that reach across the places
where it is cut here. Words of plain letters and signs go through the same merges in one call for many
words (the merges as ranks); every other word goes through the library itself, one by one.

The vocabulary file must be readable on the executors, like any installed resource.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Words kept per worker process; beyond that the table starts anew.
MAX_WORDS = 200_000
_SPACE = re.compile("[\n\r\t]")
#: Signs for which ranks and library agree by construction: no normal forms, no special tokens.
_PLAIN = "!-;=-~À-ÿ"
_OTHER = re.compile(f"[^{_PLAIN}\n]")
#: The vocabulary's own word pieces, over plain signs: short endings, letters, single digits, the rest.
_SIGN = r"!-&(-/:-@\[-`{-~×÷"
_PIECES = re.compile(rf"'(?:[stmd]|re|ve|ll)|[a-zß-öø-ÿªµ]+|[0-9]|[{_SIGN}'][{_SIGN}']*")
_END, _NEXT = "\x00", "\n"


def byte_of_sign() -> dict[str, int]:
    """The printable sign that byte-level vocabularies write for each byte, and back."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in shown]
    return signs | {chr(256 + i): b for i, b in enumerate(hidden)}


def _word_end_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary as ranks, the word end written as a zero byte, which no plain word holds."""
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    sign, ranks, spare = byte_of_sign(), {}, max(vocab.values()) + 1
    for token, rank in vocab.items():
        whole = token.endswith("</w>")
        body = bytes(sign[c] for c in (token[:-4] if whole else token))
        ranks[body + _END.encode() * whole] = rank
    ranks[_END.encode()] = spare  # stands alone only before its first merge
    return ranks


class WordIds:
    """Ids of texts under a word-end vocabulary file: lower case, white space dropped."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        ranks = _word_end_ranks(path)
        self.next_id = ranks[_NEXT.encode()]
        self.ranks = tiktoken.Encoding("words", pat_str="[^\x00\n]+\x00|\n", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = [_SPACE.sub(" ", text).split(" ") for text in texts]
        self.learn(set().union(*cut))
        return [b"".join(map(self.known.__getitem__, words)) for words in cut]

    def learn(self, words: set[str]) -> None:
        if len(self.known) > MAX_WORDS:
            self.known = {}
        words = words.difference(self.known)
        plain = list(words)
        if _OTHER.search("\n".join(plain)):
            plain = [w for w in words if not _OTHER.search(w)]
        marked = _PIECES.sub(r"\g<0>" + _END, _NEXT.join(plain).lower())
        ids = np.frombuffer(self.ranks._core_bpe.encode_to_tiktoken_buffer(marked, set()), dtype="<u4")
        ends = [*np.flatnonzero(ids == self.next_id).tolist(), len(ids)]
        data, starts = ids.tobytes(), [0, *(end + 1 for end in ends[:-1])]
        self.known.update(zip(plain, [data[4 * a : 4 * b] for a, b in zip(starts, ends)]))
        for word in words.difference(plain):
            ids = self.library.encode(word, add_special_tokens=False).ids
            self.known[word] = np.array(ids, dtype="<u4").tobytes()


@cache
def word_ids(path: str) -> WordIds:
    """The encoder of this worker process."""
    return WordIds(path)
