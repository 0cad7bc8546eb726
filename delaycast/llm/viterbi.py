"""Token counts of a unigram tokenizer without building its tokens.

An Aho-Corasick automaton lists the vocabulary pieces that end at each
character, and the dynamic programme carries the best score and the piece count.
Words (cut at white space, marked with U+2581) are tokenized one by one, so the
counts of frequent words are kept.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN = "<unk>"
#: How far below the lowest score an unknown character lies, as the tokenizer has it.
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 200_000
#: White space as the tokenizer's splitter has it.
_words = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+").findall
_marked = re.compile(f"{MARK}[^{MARK}]*").findall


def vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece file as a unigram vocabulary: the unknown piece, then the
    ordinary pieces in order of their ids, with log probabilities by Zipf's law of that order."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=model_file)
    names = [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
    whole = math.log(sum(1 / (r + 1) for r in range(len(names))))
    return [(UNKNOWN, 0.0)] + [(name, -math.log(r + 1) - whole) for r, name in enumerate(names)]


class Counter:
    """Best score and piece count of words under a unigram vocabulary."""

    def __init__(self, vocab: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(vocab).items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.singles = {p for p, _ in vocab if len(p) == 1}
        self.unknown = min(s for _, s in vocab) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float]] = {}

    def best(self, word: str) -> tuple[int, float]:
        """Of the ways to cut `word`, the highest score and its number of pieces.

        Ties: the longest last piece. A character that is no piece itself may be
        unknown; unknown characters in a row count as one piece.
        """
        n = len(word)
        score, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
        if self.singles.issuperset(word):
            # matches come by their ends, of one end the longest first: it wins ties
            for last, (size, s) in self.automaton.iter(word):
                at = last + 1 - size
                s += score[at]
                if s > score[last + 1]:
                    score[last + 1], count[last + 1] = s, count[at] + 1
            return count[n], score[n]
        unknown = [False] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, match in self.automaton.iter(word):
            ends[last + 1].append(match)
        for e in range(1, n + 1):
            for size, s in ends[e]:
                s += score[e - size]
                if s > score[e]:
                    score[e], count[e] = s, count[e - size] + 1
            if word[e - 1] not in self.singles and (s := score[e - 1] + self.unknown) > score[e]:
                score[e], count[e], unknown[e] = s, count[e - 1] + (not unknown[e - 1]), True
        return count[n], score[n]

    def word(self, word: str) -> tuple[int, float]:
        parts = [self.best(p) for p in _marked(word if word[0] == MARK else MARK + word)]
        got = (sum(c for c, _ in parts), sum(s for _, s in parts))
        if len(self.known) < CACHED_WORDS:
            self.known[word] = got
        return got

    def text(self, text: str) -> tuple[int, int, float]:
        """Words, pieces and score of a text."""
        words = _words(text)
        if not words:
            return 0, 0, 0.0
        get = self.known.get
        counts, scores = zip(*[get(w) or self.word(w) for w in words])
        return len(words), sum(counts), math.fsum(scores)


@functools.lru_cache(2)
def counter(model_file: str) -> Counter:
    return Counter(vocabulary(model_file))


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_words, n_tokens and best_score (natural log) of every row's whole text.

    Null and empty texts have 0 tokens and score 0; null doc_ids stay; repeated rows each get a row.
    """
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(model_file)
        for frame in frames:
            got = [c.text(t) for t in frame["text"]]
            out = pd.DataFrame(got, columns=["n_words", "n_tokens", "best_score"])
            out.insert(0, "doc_id", frame["doc_id"].astype("Int64").to_numpy())
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        count, "doc_id long, n_words long, n_tokens long, best_score double")
