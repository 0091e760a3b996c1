"""Operator 6, quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Words and pairs of words are hashed into a fixed number of buckets. Two multinomials over the buckets are counted:
the raw one over every document, the target one over documents that the labels call good. A document's score is
its mean log ratio for each n-gram, so length does not matter, and every document is held to one fixed threshold.

Both models are arrays of ``BUCKETS`` numbers whatever the corpus, which is all that is broadcast. Target ids
are a bounded sample of the labels (``TRUSTED_IDS``), so that texts need not be shuffled to find them.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_list, id_text, record_batch, slices, spaced_words

BUCKETS = 1 << 16
#: Labelled documents that make up the target at most: beyond it, those whose hashed id falls into a share of it.
TRUSTED_IDS = 200_000
#: Mean log ratio (natural) below which a document is rejected.
THRESHOLD = -0.2
#: Added to each bucket, over the buckets' number: the weight of what was never seen.
SMOOTH = 1.0
#: Least words; share in percent of words in repeated windows of ``WINDOW`` words above which a text is rejected.
MIN_WORDS, MAX_REPEATED, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
#: Bytes that begin no character of a word: those within a character, and white space.
_BETWEEN = bytes(range(0x80, 0xC0)) + b" \t\n\r\x0b\x0c"
SCHEMA = "doc_id long,n_words long,word_chars long,n_symbols long,n_dup_lines long,n_repeat_words long,base_failed boolean,kept boolean,llr double"
_COUNTS = "bucket int,raw long,target long"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KEPT_WORDS = 150_000
_hashes: dict[bytes, int] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; a worker keeps those it has seen, up to a bound."""
    known = _hashes
    if len(known) > _KEPT_WORDS:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def buckets(h: np.ndarray) -> np.ndarray:
    """Buckets of all single words, then of all pairs."""
    pairs = (h[:-1] * _MIX) ^ h[1:]
    pairs *= _MIX
    return (np.concatenate([h, pairs]) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def repeated_words(h: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window which the text holds twice or more."""
    n = len(h) - window + 1
    if n < 2:
        return 0
    g = h[:n].copy()
    for i in range(1, window):
        g = (g * _MIX) ^ (g >> np.uint64(29))
        g += h[i : i + n]
    _, where, counts = np.unique(g, return_inverse=True, return_counts=True)
    edges = np.zeros(len(h) + 1, dtype=np.int64)
    starts = np.flatnonzero(counts[where] > 1)
    edges[starts] += 1
    edges[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(edges)))


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def trusted_ids(labels: DataFrame, bound: int = TRUSTED_IDS) -> DataFrame:
    """Distinct doc_ids that all their labels call good; about ``bound`` at most."""
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    n = labels.count()
    if n > bound:
        good = good.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < math.floor(0.95 * bound / n * (1 << 20)))
    return good


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRUSTED_IDS) -> np.ndarray:
    """log target - log raw for each bucket, counted over all rows of ``docs`` (doc_id, text)."""

    def count(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                found = ([], [])  # the buckets of the slice's documents, and of its good ones
                for text, good in zip(byte_list(part.column(0)), part.column(1).to_pylist(), strict=True):
                    found[0].append(buckets(word_hashes(spaced_words(text))))
                    if good:
                        found[1].append(found[0][-1])
                for into, each in zip((raw, target), found, strict=True):
                    if each:
                        into += np.bincount(np.concatenate(each), minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield record_batch([seen.astype(np.int32), raw[seen], target[seen]], _COUNTS)

    good = F.broadcast(trusted_ids(labels, bound).withColumn("good", F.lit(True)))  # at most about TRUSTED_IDS rows
    rows = docs.join(good, "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good")).mapInArrow(count, _COUNTS.replace(",", ", "))
    table = rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()  # BUCKETS rows at most
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[table["bucket"]], target[table["bucket"]] = table["raw"], table["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    log = lambda c: np.log((c + SMOOTH) / (c.sum() + SMOOTH * BUCKETS))
    return log(target) - log(raw)


def judge(texts: list[bytes], model: np.ndarray, threshold: float = THRESHOLD) -> list[tuple]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, llr of each text."""
    out = []
    for text in texts:
        words = spaced_words(text)
        h = word_hashes(words)
        n, repeated = len(words), repeated_words(h)
        llr = float(model[buckets(h)].mean()) if n else 0.0
        failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED * n
        out.append((n, len(text.translate(None, _BETWEEN)), len(text) - len(text.translate(None, SYMBOLS)), duplicate_lines(text), repeated, failed, not failed and llr >= threshold, llr))
    return out


def assess(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bound: int = TRUSTED_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base measures, score and verdict of each document, as ``SCHEMA``.

    Null or empty text: no words, fails the base rule. Without a trusted document every score is 0. Labels of
    unknown documents, null labels and null ids are passed over; a document with a bad label beside good ones is
    not trusted. Null ids and equal rows are kept, an empty table gives none, other columns are not read.
    """
    docs = id_text(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, bound))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield record_batch([part.column(0), *map(list, zip(*judge(byte_list(part.column(1)), model.value, threshold), strict=True))], SCHEMA)

    return docs.mapInArrow(run, SCHEMA.replace(",", ", "))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bound: int = TRUSTED_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``assess`` keeps."""
    import pyarrow as pa

    model = docs.sparkSession.sparkContext.broadcast(fit(id_text(docs, id_col, text_col), labels, bound))

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                texts = [t or b"" for t in byte_list(part.column(part.schema.get_field_index(text_col)))]
                yield part.filter(pa.array([x[6] for x in judge(texts, model.value, threshold)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
