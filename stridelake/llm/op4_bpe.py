"""BPE encoding and decoding with forced-boundary splitting.

Two symbols that stand side by side inside no vocabulary token can't be joined
by any merge, now or later: between them a cut is certain. Words are cut there,
the fragments are encoded independently (those of distinct words and short ones
once, while they stay in a task's bounded caches) and their ids concatenated. Results equal the
tokenizers library's for a word-end BPE file with add_special_tokens=False,
special tokens in the text included.

Normalisation and words follow the file's rules: canonical composition, lower
case by code point, white space dropped, words of letters, single numbers, runs
of other marks. They never cross white space, so a text is handled by the
chunks between; chunks outside Latin go through the library's own normaliser
and word rule, so that both use the same character tables.

Defined results: a null or empty text has no ids, and both hashes are of the
empty string. Repeated rows are encoded each. Extra columns are ignored. A long
text is handled in pieces that end at white space.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import arrow_out, byte_alphabet, vocabulary

#: Distinct chunks and words kept by a task.
CACHE = 500_000
WORD_CACHE = 200_000
PIECE_CHARS = 1 << 20
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_NEVER = 1 << 60
_SPACE = regex.compile(r"\p{White_Space}+")
_CONTROL_SPACE = re.compile("[\x1c-\x1f]")  # white space to str.split only


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path, self.end = path, model["end_of_word_suffix"]
        self.ids = model["vocab"]
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): k
                     for k, m in enumerate(model["merges"])}
        # the same by first symbol, and what each rank makes
        self.after: dict[str, dict[str, int]] = {t: {} for t in self.ids}
        for (a, b), k in self.rank.items():
            self.after[a][b] = k
        self.made = [a + b for a, b in self.rank]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.joined = {p for t in self.ids for s in [self.symbols(t)] for p in zip(s, s[1:])}
        alphabet = byte_alphabet()
        #: Code points below U+0400 in the byte alphabet (lower case included).
        self.latin = {c: "".join(alphabet[b] for b in chr(c).encode()) for c in range(0x400)}
        self.latin[0x2C65], self.latin[0x2C66] = (
            "".join(alphabet[b] for b in c.encode()) for c in "\u2c65\u2c66")
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") \
            if self.special else None
        self.text_ids = {t: str(i) for t, i in self.ids.items()}
        self.known: dict[str, tuple[str, ...]] = {}
        self.fragments: dict[tuple[str, ...], tuple[str, ...]] = {}
        self.chunks: dict[str, tuple[str, str]] = {}
        self._library = None

    def symbols(self, token: str) -> list[str]:
        """A token's characters, the last with the word end if it has one."""
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    # -- words --------------------------------------------------------------
    def words(self, chunk: str) -> list[str]:
        """Words of a chunk without white space, in the byte alphabet."""
        if chunk.isascii() and chunk.isprintable():
            low = chunk.lower()
            return [low] if low.isalpha() else _WORD.findall(low)
        if max(chunk) > "ɏ":  # beyond Latin: the library's own tables
            if self._library is None:
                from tokenizers import Tokenizer
                self._library = Tokenizer.from_file(self.path)
            t = self._library
            return [w for w, _ in t.pre_tokenizer.pre_tokenize_str(
                t.normalizer.normalize_str(chunk))]
        low = unicodedata.normalize("NFC", chunk)
        low = low.lower()  # below U+0250 no letter's lower case depends on its neighbours
        return [w.translate(self.latin) for w in _WORD.findall(low)]

    # -- merges ---------------------------------------------------------------
    def cut(self, word: str) -> list[tuple[str, ...]]:
        """The word's fragments between forced boundaries."""
        s = [*word[:-1], word[-1] + self.end]
        if self.joined.issuperset(zip(s, s[1:])):
            return [tuple(s)]
        out, start = [], 0
        for k in range(1, len(s)):
            if (s[k - 1], s[k]) not in self.joined:
                out.append(tuple(s[start:k]))
                start = k
        out.append(tuple(s[start:]))
        return out

    def merge(self, fragment: tuple[str, ...]) -> list[str]:
        """The fragment's tokens: the pair of least rank joins first, of equal
        ones the leftmost."""
        if len(fragment) > 48:
            return self._merge_long(fragment)
        if len(fragment) == 1:
            return list(fragment)
        s, after = list(fragment), self.after
        ranks = [after[a].get(b, _NEVER) for a, b in zip(s, s[1:])]
        while ranks and (low := min(ranks)) < _NEVER:
            k = ranks.index(low)
            s[k] = token = self.made[low]
            del ranks[k], s[k + 1]
            if k:
                ranks[k - 1] = after[s[k - 1]].get(token, _NEVER)
            if k < len(ranks):
                ranks[k] = after[token].get(s[k + 1], _NEVER)
        return s

    def _merge_long(self, fragment: tuple[str, ...]) -> list[str]:
        s: list[str | None] = list(fragment)
        after = list(range(1, len(s) + 1))
        before = list(range(-1, len(s) - 1))
        rank = self.rank
        heap = [(rank[p], k, p) for k, p in enumerate(zip(s, s[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, k, (a, b) = heapq.heappop(heap)
            n = after[k]
            if s[k] != a or n >= len(s) or s[n] != b:
                continue  # one of the two has since been joined
            s[k], s[n] = a + b, None
            after[k] = after[n]
            if after[k] < len(s):
                before[after[k]] = k
            for i, j in ((before[k], k), (k, after[k])):
                if i >= 0 and j < len(s) and (p := (s[i], s[j])) in rank:
                    heapq.heappush(heap, (rank[p], i, p))
        return [x for x in s if x is not None]

    def part(self, fragment: tuple[str, ...]) -> Sequence[str]:
        """``merge``, once for a short fragment that several words share."""
        if len(fragment) > 12:
            return self.merge(fragment)
        got = self.fragments.get(fragment)
        if got is None:
            if len(self.fragments) >= WORD_CACHE:
                self.fragments.clear()
            got = self.fragments[fragment] = tuple(self.merge(fragment))
        return got

    def chunk(self, chunk: str) -> tuple[str, str]:
        """The ids of a chunk, joined by spaces, and the text that they decode to."""
        out: list[str] = []
        for word in self.words(chunk):
            got = self.known.get(word)
            if got is None:
                got = tuple([t for f in self.cut(word) for t in self.part(f)])
                if len(word) <= 200:
                    if len(self.known) >= WORD_CACHE:
                        self.known.clear()
                    self.known[word] = got
            out += got
        ids = " ".join([self.text_ids[t] for t in out])
        return ids, self.decode(map(int, ids.split()))

    def _chunk_once(self, chunk: str) -> tuple[str, str]:
        got = self.chunks.get(chunk)
        if got is None:
            got = self.chunk(chunk)
            if len(chunk) <= 200:
                if len(self.chunks) >= CACHE:
                    self.chunks.clear()
                self.chunks[chunk] = got
        return got

    # -- texts ----------------------------------------------------------------
    def parts(self, text: str):
        """(special token or None, chunks) of a text, in pieces."""
        cuts = self.split.split(text) if self.split and any(
            s in text for s in self.special) else [text]
        for c in cuts:
            if c in self.special:
                yield c, []
                continue
            at = 0
            while at < len(c):
                m = _SPACE.search(c, at + PIECE_CHARS) if len(c) - at > PIECE_CHARS else None
                to = m.start() if m else len(c)
                piece = c[at:to] if at or m else c
                yield None, ([x for x in _SPACE.split(piece) if x]
                             if _CONTROL_SPACE.search(piece) else piece.split())
                at = to
        return

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, sha256 of the ids, sha256 of the text that the ids decode to):
        chunks are encoded and decoded one by one, as tokens never span two."""
        ids, decoded, n, sep = hashlib.sha256(), hashlib.sha256(), 0, b""
        memo = self.chunks
        for special, chunks in self.parts(text):
            if special is not None:
                got = [(str(i := self.special[special]), self.decode([i]))]
            else:
                got = list(map(memo.get, chunks))
                if None in got:
                    for k, x in enumerate(got):
                        if x is None:
                            got[k] = self._chunk_once(chunks[k])
            if got:
                a = sep + " ".join([x for x, _ in got]).encode()
                ids.update(a)
                decoded.update(sep + " ".join([x for _, x in got]).encode())
                n += a.count(b" ") + (not sep)
                sep = b" "
        return n, ids.hexdigest(), decoded.hexdigest()

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for special, chunks in self.parts(text):
            if special is not None:
                out.append(self.special[special])
            for c in chunks:
                out += map(int, self.chunk(c)[0].split())
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """As the library decodes a file without a decoder: tokens and
        spaces."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode_decode(docs: DataFrame, vocab: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    path = vocab or vocabulary("word_bpe_49k.json")

    def run(b: pa.RecordBatch):
        bpe = word_bpe(path)
        n, ids, decoded = zip(*[bpe.digest(t.as_py() or "") for t in b.column("text")])
        return {"doc_id": b.column("doc_id"), "n_tokens": n, "ids_sha256": ids,
                "decoded_sha256": decoded}
    return arrow_out(run, docs.select("doc_id", "text"),
                     "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
