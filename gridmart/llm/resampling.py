"""Importance resampling: documents are drawn by how much likelier their word runs are in a target than in the source.

Features are runs of 1 to ``longest`` consecutive words, joined by one blank, and fall into a fixed number of buckets by the
CRC-32 of their bytes. One pass counts the buckets of all documents, another those of the target. A bucket's gain is the
logarithm of its smoothed share in the target over that in the source; a document's weight is the sum of the gains of its
features. Noise of a Gumbel distribution, made of the document's id, is added, and the highest scores are drawn, which is
drawing without replacement by the weights.

Features are interned in a table of open addresses in numpy, a fixed number of occurrences at a time: the place is that of the
xxhash64 of the bytes, or the next free one; equal hashes count as equal features only if all bytes agree. A slot holds the
feature's bucket, made once, and how often it occurs. Occurrences keep the number of their slot and gather gains by it, so
memory does not follow the texts, their number or their features.

A null text has no words. Rows without an id have the noise of an empty id, and come last among equals. Repeated rows
count and are drawn singly. Texts of the target that are null, and an empty target, count nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.numbering import numbered
from gridmart.llm.tables import in_tasks, written
from gridmart.llm.terms import terms_of
from gridmart.llm.words import Words

BUCKETS, LONGEST, MIN_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
AT_ONCE = 1 << 17
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _wide(data: np.ndarray, kind: str) -> np.ndarray:
    """The little-endian number that begins at each byte; ``data`` has seven spare bytes at its end."""
    size = np.dtype(kind).itemsize
    return np.ndarray((len(data) - size + 1,), kind, data, strides=(1,))


def xxhash64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64 with seed 0 of each span; ``data`` has seven spare bytes at its end."""
    out = np.empty(len(starts), np.uint64)
    eight, four = _wide(data, "<u8"), _wide(data, "<u4")
    order = np.argsort(lengths, kind="stable")
    edges = np.searchsorted(lengths[order], np.arange(33))
    for n in range(32):
        some = order[edges[n] : edges[n + 1]]
        if not len(some):
            continue
        at, left = starts[some], n
        h = np.full(len(some), _P5 + np.uint64(n), np.uint64)
        while left >= 8:
            h ^= _turned(eight[at] * _P2, 31) * _P1
            h = _turned(h, 27) * _P1 + _P4
            at, left = at + 8, left - 8
        if left >= 4:
            h ^= four[at].astype(np.uint64) * _P1
            h = _turned(h, 23) * _P2 + _P3
            at, left = at + 4, left - 4
        for _ in range(left):
            h ^= data[at].astype(np.uint64) * _P5
            h = _turned(h, 11) * _P1
            at = at + 1
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        out[some] = h ^ (h >> np.uint64(32))
    for i in order[edges[32] :].tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]])
    return out


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the spans of one length at ``a`` and ``b`` have the same bytes."""
    eight = _wide(data, "<u8")
    out = np.ones(len(a), bool)
    rows, done = np.arange(len(a)), 0
    while len(rows):
        rest = np.minimum(lengths[rows] - done, 8)
        apart = (eight[a[rows] + done] ^ eight[b[rows] + done]) << ((8 - rest) * 8).astype(np.uint64)
        out[rows] = apart == 0
        done += 8
        rows = rows[(apart == 0) & (lengths[rows] > done)]
    return out


class Table:
    """Slots for the distinct features of at most ``AT_ONCE`` occurrences, at most half of them full."""

    def __init__(self, occurrences: int = AT_ONCE, hashed=xxhash64):
        self.hashed = hashed
        size = max(16, 1 << (2 * occurrences - 1).bit_length())
        self.mask = np.int64(size - 1)
        self.owner = np.full(size, -1, np.int64)  # the occurrence that took the slot
        self.buckets = np.zeros(size, np.int32)
        self.counts = np.zeros(size, np.int64)
        self.full = np.zeros(0, np.int64)

    def intern(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int) -> np.ndarray:
        """The slot of each occurrence; what was there before is forgotten."""
        self.owner[self.full] = -1
        hashes = self.hashed(data, starts, lengths)
        at = (hashes & np.uint64(self.mask)).astype(np.int64)
        waiting, taken = np.arange(len(starts)), []
        while len(waiting):
            slots = at[waiting]
            free = self.owner[slots] < 0
            self.owner[slots[free]] = waiting[free]  # one of those that ask for it has it now
            owner = self.owner[slots]
            taken.append(waiting[free][owner[free] == waiting[free]])
            same = (hashes[owner] == hashes[waiting]) & (lengths[owner] == lengths[waiting])
            both = np.flatnonzero(same & (owner != waiting))
            same[both] = same_bytes(data, starts[owner[both]], starts[waiting[both]], lengths[waiting[both]])
            waiting = waiting[~same]
            at[waiting] = (at[waiting] + 1) & self.mask
        first = np.concatenate(taken) if taken else np.zeros(0, np.int64)
        self.full = at[first]
        whole = memoryview(data)
        spans = zip(starts[first].tolist(), (starts[first] + lengths[first]).tolist(), strict=True)
        self.buckets[self.full] = [zlib.crc32(whole[a:b]) % buckets for a, b in spans]
        self.counts[self.full] = np.bincount(at, minlength=len(self.counts))[self.full]
        return at


def features(words: Words, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with spare ones, and start, length and text of every feature of a slice."""
    lengths = words.ends - words.starts
    if longest == 1:
        data = np.concatenate((words.data, np.zeros(8, np.uint8)))
        return data, words.starts, lengths, np.repeat(np.arange(len(words.counts)), words.counts)
    # The words once more with one blank between them, so that a run is one span.
    starts = np.cumsum(lengths + 1) - lengths - 1
    data = np.full(int((lengths + 1).sum()) + 8, 0x20, np.uint8)
    total = int(lengths.sum())
    shift = np.cumsum(lengths) - lengths
    data[np.repeat(starts - shift, lengths) + np.arange(total)] = words.data[np.repeat(words.starts - shift, lengths) + np.arange(total)]
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    left = np.repeat(words.bounds[1:], words.counts) - np.arange(len(text))
    found = []
    for n in range(1, longest + 1):
        some = np.flatnonzero(left >= n)
        found.append((starts[some], starts[some + n - 1] + lengths[some + n - 1] - starts[some], text[some]))
    return data, *(np.concatenate(x) for x in zip(*found, strict=True))


def _counted(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, found = Table(), np.zeros(buckets, np.int64)
        for batch in batches:
            for words in terms_of(batch.column(0)):
                data, starts, lengths, _ = features(words, longest)
                for lo in range(0, len(starts), AT_ONCE):
                    table.intern(data, starts[lo : lo + AT_ONCE], lengths[lo : lo + AT_ONCE], buckets)
                    found += np.bincount(table.buckets[table.full], table.counts[table.full], buckets).astype(np.int64)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(found[some])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    found = in_tasks(texts.select(text), _counted(longest, buckets), "bucket int, n long")
    found = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # a fixed number of rows
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths, rounded down."""
    n = len(source)
    ratio = (target + 1.0) * float(source.sum() + n) / ((source + 1.0) * float(target.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, text: str = "text", longest: int = LONGEST) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``n_features`` and ``weight``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # of fixed size
    others = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, gain = Table(), shared.value
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for words in terms_of(batch.column(batch.schema.get_field_index(text))):
                data, starts, lengths, of = features(words, longest)
                n = len(words.counts)
                here = slice(words.first, words.first + n)
                n_words[here] = words.counts
                n_features[here] = np.bincount(of, minlength=n)
                for lo in range(0, len(starts), AT_ONCE):
                    some = slice(lo, lo + AT_ONCE)
                    slots = table.intern(data, starts[some], lengths[some], len(gain))
                    np.add.at(weight, words.first + of[some], gain[table.buckets[slots]])
            columns = [*(batch.column(batch.schema.get_field_index(c)) for c in others), *map(pa.array, (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "n_words", "n_features", "weight"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    return in_tasks(docs, run, f"{kinds}, n_words long, n_features long, weight long")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of each document; ``rank`` is null for those that are not drawn.

    ``percent`` of the documents with at least ``min_words`` words are drawn, rounded down.
    """
    gains = bucket_gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    rows = weighed(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), gains, longest=longest)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    chance = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 2.0**32
    rows = rows.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(chance))).cast("long"))
    rows = written(rows.withColumn("able", F.col("n_words") >= min_words), "resampling-scores")
    drawn = percent * rows.where("able").count() // 100
    ranked = numbered(rows, [F.col("able").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "place", "resampling-ranks")
    rank = F.when(F.col("able") & (F.col("place") < drawn), F.col("place") + 1)
    return ranked.select(F.col("doc_id").alias(doc_id), "n_features", "weight", "score", rank.alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose id was drawn; a drawn id brings all its rows, rows without an id stay behind."""
    ids = resampled(docs, target, doc_id, text, **settings).where(F.col("rank").isNotNull()).select(doc_id).distinct()
    return docs.join(written(ids, "resampling-ids"), doc_id, "left_semi").select(*docs.columns)
