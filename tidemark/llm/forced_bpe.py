"""Operator 4, BPE encoding and decoding with forced boundaries.

Two neighbouring bytes that stand next to each other inside no token of the vocabulary can never be merged, so a
word may be cut between them for certain: merges left and right of the cut do not touch each other. A word is cut
at all such places, each fragment is merged by itself (and remembered: fragments are short and recur far more than
words), and the ids are put one after the other. Normalisation and pre-tokenisation are those that the tokenizer's
file names, applied to pieces between white space, across which neither reaches.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from functools import lru_cache
from itertools import chain
from operator import add

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.common import Kept, id_text, record_batch, slices
from tidemark.llm.fragments import LETTERS, WHITE

SCHEMA = "doc_id long,n_tokens long,ids_sha256 string,decoded_sha256 string"
_IDS = "doc_id long,ids array<long>,decoded string"
#: Pieces and fragments that a worker keeps, and the longest fragment that it keeps, in characters.
KEPT_PIECES, KEPT, KEPT_LENGTH = 400_000, 150_000, 64
#: Pieces normalised in one string; symbols up to which a fragment's pairs are scanned rather than kept in a heap.
LEARNED, SCANNED = 1024, 24
_NEVER = (1 << 60, "")
#: Pieces between white space; where no match of the pre-tokenizer goes from a letter on to a comma or full stop,
#: a word of letters before one is a piece of its own.
SPACED = re.compile(f"[^{WHITE}]+")
#: (U+0130 ends in a mark, not a letter, when lower-cased.)
PIECE = re.compile(f"(?:(?!\u0130)[{LETTERS}])++(?![^{WHITE}.,])|[^{WHITE}]+")


class ForcedBPE:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_file(path)
        spec = json.loads(tokenizer.to_str())
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or spec["decoder"] is not None:
            raise ValueError("only plain BPE files without a decoder are supported")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in spec["added_tokens"]):
            raise ValueError("added tokens must be plain")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {p: (i, p[0] + p[1]) for i, p in enumerate(pairs)}
        if model.get("unk_token") and not all({c, c + self.suffix} <= self.vocab.keys() for c in ByteLevel.alphabet()):
            raise ValueError("some byte has no token, and the file's token for unknown ones is not supported")
        strip = len(self.suffix)
        inner = [t[:-strip] if strip and t.endswith(self.suffix) and len(t) > strip else t for t in self.vocab]
        self.inside = {t[i : i + 2] for t in inner for i in range(len(t) - 1)}
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.added = added
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else lambda s: s
        self.pre = tokenizer.pre_tokenizer.pre_tokenize_str
        names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in added.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        alone = all([w for w, _ in self.pre(self.normalize(f"a{c}{d}"))][:1] == [self.normalize("a")] for c in ".," for d in ".,a1- ")
        self.pieces = Kept(KEPT_PIECES, (PIECE if alone else SPACED).findall, self._pieces)
        self.inner: dict[str, list[int]] = {}
        self.ends: dict[str, list[int]] = {}  # of fragments at a word's end

    def cut(self, word: str) -> list[str]:
        """The word's fragments: a cut lies between two bytes that no token holds side by side."""
        held = list(map(self.inside.__contains__, map(add, word, word[1:])))
        if all(held):
            return [word]
        at = [i for i, x in enumerate(held, 1) if not x]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)], strict=True)]

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        if len(symbols) > SCANNED:
            return self._merge_long(symbols)
        rank = self.rank.get
        ranks = [rank(p, _NEVER) for p in zip(symbols, symbols[1:])]  # noqa: B905
        while ranks and (best := min(ranks)) is not _NEVER:
            i = ranks.index(best)
            symbols[i : i + 2] = [best[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((symbols[i - 1], best[1]), _NEVER)
            if i < len(ranks):
                ranks[i] = rank((best[1], symbols[i + 1]), _NEVER)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same by a heap over linked symbols, whose cost grows with n log n."""
        n, rank = len(symbols), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*rank[p], i) for i in range(n - 1) if (p := (symbols[i], symbols[i + 1])) in rank]
        heapq.heapify(heap)
        while heap:
            r, made, i = heapq.heappop(heap)
            j = after[i]
            if not symbols[i] or j >= n or rank.get((symbols[i], symbols[j]), (-1,))[0] != r:
                continue
            symbols[i], symbols[j] = made, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := (made, symbols[k])) in rank:
                    heapq.heappush(heap, (*rank[p], i))
            h = before[i]
            if h >= 0 and (p := (symbols[h], made)) in rank:
                heapq.heappush(heap, (*rank[p], h))
        return [s for s in symbols if s]

    def fragment(self, text: str, last: bool) -> list[int]:
        key = text + self.suffix if last else text
        kept = self.ends if last else self.inner
        if (got := kept.get(text)) is None:
            symbols = list(text)
            symbols[-1:] = [key[len(text) - 1 :]]
            got = [self.vocab[s] for s in self.merge(symbols) if s in self.vocab]
            if len(text) <= KEPT_LENGTH:
                if len(kept) >= KEPT:
                    kept.clear()
                kept[text] = got
        return got

    def word(self, word: str) -> list[int]:
        *first, last = self.cut(word)
        ids: list[int] = []
        for f in first:
            ids += self.fragment(f, False)
        return ids + self.fragment(last, True) if ids else self.fragment(last, True)

    def _ids(self, text: str) -> bytes:
        """Ids of one piece, by itself."""
        ids: list[int] = []
        for part in self.special.split(text) if self.special else (text,):
            if part in self.added:
                ids.append(self.added[part])
            elif part:
                for word, _ in self.pre(self.normalize(part)):
                    ids += self.word(word)
        return array("I", ids).tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        return list(chain.from_iterable(self._learn(pieces[i : i + LEARNED]) for i in range(0, len(pieces), LEARNED)))

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces: all are normalised and pre-tokenised in one string, with a blank between two."""
        odd = {p for p in pieces if self.special.search(p)} if self.special else set()
        plain = [p for p in pieces if p not in odd] if odd else pieces
        text = self.normalize(" ".join(plain))
        ends = [i for i, c in enumerate(text) if c == " "]
        if len(ends) != len(plain) - 1:  # a piece that normalises to white space or to nothing
            return list(map(self._ids, pieces))
        ends.append(len(text))
        ids: list[list[int]] = [[] for _ in plain]
        k = 0
        for word, (_, end) in self.pre(text):
            while end > ends[k]:
                k += 1
            ids[k] += self.word(word)
        done = iter([array("I", x).tobytes() for x in ids])
        return [self._ids(p) if p in odd else next(done) for p in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        return self.pieces.join(texts)

    def decode(self, ids: bytes) -> str:
        """Tokens with a blank between them, as the library joins them where a file names no decoder."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> ForcedBPE:
    return ForcedBPE(path)


def encode_documents(docs: DataFrame, tokenizer: str, digests: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests (n_tokens, ids_sha256, decoded_sha256) of each document, or its ``ids`` and ``decoded`` text.

    One narrow pass. Null text: no ids and an empty decoded text. Null ids and equal rows are kept; an empty table
    gives none; other columns are not read.
    """

    def run(batches):
        model = codec(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = model.encode(part.column(1).to_pylist())
                if digests:
                    yield record_batch([part.column(0), [len(x) >> 2 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(model.decode(x).encode()).hexdigest() for x in ids]], SCHEMA)
                else:
                    yield record_batch([part.column(0), [np.frombuffer(x, "<u4").tolist() for x in ids], list(map(model.decode, ids))], _IDS)

    return id_text(docs, id_col, text_col).mapInArrow(run, (SCHEMA if digests else _IDS).replace(",", ", "))
