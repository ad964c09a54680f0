"""Token counts: count-only Viterbi over unigram vocabulary matches.

An Aho-Corasick automaton lists the vocabulary pieces that end at each
character of a word. Dynamic programming carries, for each position, the best
score and the number of pieces of the best segmentation; no segmentation is
kept. Tie rules are those of the unigram model of the tokenizers library: of
segmentations with equal scores the one whose last piece starts first wins; a
character that is no piece costs 10 less than the least score and counts as its
UTF-8 bytes (byte fallback). Words follow that library's Metaspace rule: each
space starts a new word, and the text's start does if it is no space.

The pieces and scores are those of the vocabulary file as they stand. A word's
count depends on the word alone, so each distinct one is counted once, while it
stays in a task's bounded cache.

Defined results: a null or empty text has no tokens. Repeated rows are counted
each. Extra columns are ignored. A long text is read whole, word by word.
"""

from __future__ import annotations

import functools

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_out, vocabulary

CACHE = 600_000
UNKNOWN_PENALTY = 10.0
MARK = "▁"  # stands for a space


def pieces(path: str) -> tuple[list[tuple[str, float]], int]:
    """((piece, score) by id, id of the unknown piece) of a model file."""
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(p.id_to_piece(i), p.get_score(i)) for i in range(p.get_piece_size())], p.unk_id()


class Counter:
    def __init__(self, path: str):
        vocab, _ = pieces(path)
        self.least = min(s for _, s in vocab) - UNKNOWN_PENALTY
        self.single = {p for p, _ in vocab if len(p) == 1}
        self.machine = ahocorasick.Automaton()
        for p, s in vocab:
            self.machine.add_word(p, (len(p), s))
        self.machine.make_automaton()
        self.known: dict[str, int] = {}

    def word(self, w: str) -> int:
        """Tokens of one word (with its mark)."""
        n = len(w)
        score = [0.0] + [None] * n
        count = [0] * (n + 1)
        single, least = self.single, self.least
        done = 0  # positions up to here have their unknown character tried

        def unknown(to: int) -> None:
            nonlocal done
            while done < to:
                c = w[done]
                if c not in single:
                    s = score[done] + least
                    if score[done + 1] is None or s > score[done + 1]:
                        score[done + 1] = s
                        count[done + 1] = count[done] + len(c.encode())
                done += 1
        for end, (size, s) in self.machine.iter(w):  # by end, longest first
            if done < end:
                unknown(end)
            before = score[end + 1 - size]
            if before is not None:
                s += before
                if score[end + 1] is None or s > score[end + 1]:
                    score[end + 1] = s
                    count[end + 1] = count[end + 1 - size] + 1
        unknown(n)
        return count[n]

    def text(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")
        if not words[0]:
            del words[0]  # the text starts with a space: a word's own mark
        known, total = self.known, 0
        for w in words:
            n = known.get(w)
            if n is None:
                n = self.word(MARK + w)
                if len(known) >= CACHE:
                    known.clear()
                if len(w) < 200:
                    known[w] = n
            total += n
        return total


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocab: str | None = None) -> DataFrame:
    """doc_id and n_tokens of every row."""
    path = vocab or vocabulary("piece_bpe_32k.model")

    def run(b: pa.RecordBatch):
        c = counter(path)
        return {"doc_id": b.column("doc_id"),
                "n_tokens": [c.text(t.as_py() or "") for t in b.column("text")]}
    return arrow_out(run, docs.select("doc_id", "text"), "doc_id bigint, n_tokens bigint")
