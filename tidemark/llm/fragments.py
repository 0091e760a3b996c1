"""Whole texts through a byte-level BPE of the tokenizers library, by fragments that are cut at safe boundaries.

A byte-level pre-tokenizer matches ``'s|...| ?letters| ?digits| ?others|\\s+(?!\\S)|\\s+``. No match joins
non-space characters across white space, save that one space may start a match, and none that holds a letter goes
on to a comma or full stop. So ``FRAGMENT`` ends where a match of the pre-tokenizer ends, whatever follows, and the
ids of a text are those of its fragments in order.
Fragments recur, so each worker keeps the ids of those that it has seen, up to a bound.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from tidemark.llm.common import Kept

#: White space by Unicode, which Python's ``\\s`` extends by four control characters.
WHITE = "\t-\r \x85\xa0  -     　"
#: Letters only: a word of these before a comma, a full stop, white space or the end is a fragment of its own.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
FRAGMENT = re.compile(f" ?[{LETTERS}]++(?![^{WHITE}.,])| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Fragments that a worker keeps.
KEPT_FRAGMENTS = 800_000
#: Fragments in one string for the library.
JOINED = 256
#: UTF-8 bytes in one call of the library.
BATCH_BYTES = 1 << 18


def balanced(items: list[str], limit: int = BATCH_BYTES):
    """Lists of items with about ``limit`` bytes each."""
    part, held = [], 0
    for x in items:
        size = len(x) if x.isascii() else len(x.encode("utf-8", "surrogatepass"))
        if part and held + size > limit:
            yield part
            part, held = [], 0
        part.append(x)
        held += size
    if part:
        yield part


class FragmentEncoder:
    """``encode(texts)`` gives the ids of each text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.kept = Kept(KEPT_FRAGMENTS, FRAGMENT.findall, self._learn)
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = lambda texts: model.encode(texts, num_threads=1)
            self.safe = False
            return
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.library = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        spec = json.loads(tokenizer.to_str())
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        self.line_feed = model["vocab"].get("\u010a")
        white = re.compile(f"[{WHITE}]")
        self.safe = (
            spec["normalizer"] is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex")
            and not pre.get("add_prefix_space")
            and model["type"] == "BPE"
            and not model.get("dropout")
            and self.library(["\n"]) == [[self.line_feed]]
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or white.search(a["content"]) for a in spec["added_tokens"])
        )

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(ids, dtype="<u4").tobytes() for part in balanced(texts) for ids in self.library(part)]

    def _fragment_ids(self, fragments: list[str]) -> list[bytes]:
        """Ids of fragments that hold a character besides white space: ``JOINED`` of them in one string.

        The line feed between them is one token, and no fragment holds it.
        """
        strings = ["\n".join(fragments[i : i + JOINED]) for i in range(0, len(fragments), JOINED)]
        out = []
        for ids in self._ids(strings):
            cuts = (np.flatnonzero(np.frombuffer(ids, "<u4") == self.line_feed) << 2).tolist()
            out += [ids[a:b] for a, b in zip([0, *[c + 4 for c in cuts]], [*cuts, len(ids)], strict=True)]
        return out

    def _learn(self, fragments: list[str]) -> list[bytes]:
        blank = [f for f in fragments if f.isspace()]
        words = [f for f in fragments if not f.isspace()]
        ids = dict(zip(blank, self._ids(blank), strict=True)) | dict(zip(words, self._fragment_ids(words), strict=True))
        return list(map(ids.__getitem__, fragments))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.safe:
            return self._ids(texts)
        return self.kept.join(texts)


@lru_cache(maxsize=4)
def encoder(path: str) -> FragmentEncoder:
    """One for each worker process and tokenizer."""
    return FragmentEncoder(path)
