"""Passages that another document has already: windows of words by level-wise doubling.

A window of ``min_words`` words of a document is repeated if its words also start somewhere in a document of a smaller id;
every word that a repeated window covers is removed. All windows are judged on the input.

Levels double. At half the length, each long window is stood for by the half window of least hash in it, so that equal
windows have equal stand-ins and few rows are compared; only what repeats in another document goes on. A run of windows
with one stand-in is then compared as a whole with its surroundings: runs that are equal throughout need one
comparison, and of each kind of run only the first document's is extended, window by window, to the full length. Every
comparison is by stand-in and window together, that is by 128 bits.

Null texts have no words. Rows without an id are compared with nothing and stay whole. Repeated rows of an id
have no smaller id among themselves, and each is returned. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.tables import by_shuffle, in_tasks, written
from gridmart.llm.words import Words, column_bytes, mixed, ranges, signed, windows, words_of

RUNS = "stand_in long, kind long, doc_id long, version int, first int, last int"
MIN_WORDS = 50


def runs(words: Words, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one stand-in: text, stand-in, kind, first and last start within the text.

    The stand-in of a window is its half window of least hash, the first among equals; ``kind`` is a hash of all words
    of the run's windows and of the stand-in's place among them.
    """
    half = length // 2
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    if len(words.starts) < length:
        return empty
    hashes = words.hashes()
    halves = windows(hashes, half)
    counts = words.counts
    text = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(len(hashes) - length + 1)
    starts = starts[text[starts] == text[starts + length - 1]]
    if not len(starts):
        return empty
    seen = np.lib.stride_tricks.sliding_window_view(halves, length - half + 1)
    least = np.concatenate([starts[i : i + 65536] + seen[starts[i : i + 65536]].argmin(axis=1) for i in range(0, len(starts), 65536)])
    change = np.concatenate(([True], least[1:] != least[:-1]))
    begin = np.flatnonzero(change)
    first, last, place = starts[begin], starts[np.append(begin[1:], len(starts)) - 1], least[begin]
    kind = mixed(ranges(hashes, first, last + length - first) + mixed((place - first + 1).astype(np.uint64)))
    return text[first], halves[place], kind, first - words.bounds[text[first]], last - words.bounds[text[first]]


def _runs(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column(2)):
                text, stand_in, kind, first, last = runs(words, length)
                rows = pa.array(text + words.first)
                yield pa.RecordBatch.from_arrays(
                    [signed(stand_in), signed(kind), batch.column(0).take(rows), batch.column(1).take(rows),
                     pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                    names=["stand_in", "kind", "doc_id", "version", "first", "last"],
                )

    return run


def _extended(length: int) -> Callable:
    """Windows of full length of the runs that are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("asked")
            for words in words_of(batch.column("text")):
                hashes = words.hashes()
                full = windows(hashes, length)
                stand_ins, row, start = [], [], []
                for i in range(len(words.counts)):
                    for x in asked[words.first + i].as_py():
                        n = x["last"] - x["first"] + 1
                        stand_ins += [x["stand_in"]] * n
                        row += [words.first + i] * n
                        start.append(np.arange(x["first"], x["last"] + 1) + words.bounds[i])
                if not row:
                    continue
                at = np.concatenate(start)
                rows = pa.array(row)
                local = at - words.bounds[np.array(row) - words.first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(stand_ins, pa.int64()), signed(full[at]), batch.column("doc_id").take(rows), batch.column("version").take(rows),
                     pa.array(local, pa.int32())],
                    names=["stand_in", "kind", "doc_id", "version", "first"],
                )

    return run


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``version`` tells texts of one id apart."""
    version = F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).bitwiseAND(0x7FFFFFFF).cast("int")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), version.alias("version"), F.col(text).cast("string").alias("text"))


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, version, first, last)``: the first and last start of runs of repeated windows, in words."""
    texts = _texts(docs, doc_id, text).where("doc_id is not null")
    # Half length: what repeats in another document goes on.
    found = written(in_tasks(texts.select("doc_id", "version", "text"), _runs(min_words), RUNS), "substring-runs")
    several = (
        found.groupBy("stand_in")
        .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), (F.min("kind") < F.max("kind")).alias("kinds"))
        .where("a < b").select("stand_in", "kinds")
    )
    alive = written(found.join(written(several, "substring-stand-ins"), "stand_in"), "substring-alive")
    # Equal runs: all but the first document's are repeated throughout.
    kinds = written(alive.groupBy("stand_in", "kind").agg(F.min("doc_id").alias("origin")), "substring-kinds")
    judged = written(alive.join(kinds, ["stand_in", "kind"]), "substring-judged")
    whole = judged.where("doc_id > origin").select("doc_id", "version", "first", "last")
    # Full length, for the first run of each kind whose stand-in has several kinds.
    asked = judged.where("kinds and doc_id = origin").groupBy("doc_id", "version")
    asked = written(asked.agg(F.collect_list(F.struct("stand_in", "first", "last")).alias("asked")), "substring-asked")
    # Copies of a row would give every window twice.
    texts = texts.join(by_shuffle(asked), ["doc_id", "version"])
    full = in_tasks(texts.select("doc_id", "version", "text", "asked"), _extended(min_words), "stand_in long, kind long, doc_id long, version int, first int")
    full = written(full, "substring-windows")
    origins = written(full.groupBy("stand_in", "kind").agg(F.min("doc_id").alias("origin")).where("origin is not null"), "substring-origins")
    single = full.join(origins, ["stand_in", "kind"]).where("doc_id > origin")
    return whole.unionByName(single.select("doc_id", "version", "first", F.col("first").alias("last")))


def covered(n_words: int, spans: list[dict] | None, min_words: int) -> np.ndarray:
    """Which words lie in a repeated window."""
    change = np.zeros(n_words + 1, np.int32)
    for x in spans or ():
        change[x["first"]] += 1
        change[x["last"] + min_words] -= 1
    return np.cumsum(change[:-1]) > 0


def _digest(min_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = column_bytes(batch.column("text"))
            rows = []
            for i, spans in enumerate(batch.column("spans")):
                words = data[at[i] : at[i + 1]].tobytes().split()
                n, removed = len(words), 0
                if spans.is_valid:
                    gone = covered(n, spans.as_py(), min_words)
                    removed = int(gone.sum())
                    words = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
                rows.append((n, removed, sha256(b" ".join(words)).hexdigest()))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return run


def without(text: bytes, spans: list[dict], min_words: int) -> bytes:
    """The text with the covered words taken out, up to the next word that stays."""
    words = next(words_of(pa.array([text], pa.binary())))
    gone = covered(len(words.starts), spans, min_words)
    edges = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
    out, at = [], 0
    for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
        out.append(text[at : int(words.starts[a])])
        at = int(words.starts[b]) if b < len(words.starts) else len(text)
    return b"".join([*out, text[at:]])


def _cleaned(text: str, count: str | None, min_words: int, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {x: batch.column(x) for x in names}
            spans = batch.column(batch.num_columns - 1)
            values, changed = [], []
            for value, own in zip(columns[text], spans, strict=True):
                new = value.as_py()
                if own.is_valid and new is not None:
                    new = without(new.encode(), own.as_py(), min_words).decode()
                values.append(new)
                changed.append(own.is_valid)
            if count is not None:
                old = columns[count].to_pylist()
                columns[count] = pa.array([len(v) if x else o for v, x, o in zip(values, changed, old, strict=True)], columns[count].type)
            columns[text] = pa.array(values, columns[text].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return run


def _with_spans(docs: DataFrame, doc_id: str, text: str, min_words: int, spans: str, keys: tuple[str, str]) -> DataFrame:
    found = repeated_runs(docs, doc_id, text, min_words).groupBy("doc_id", "version")
    found = found.agg(F.collect_list(F.struct("first", "last")).alias(spans))  # of one text
    found = written(found, "substring-spans").withColumnsRenamed({"doc_id": keys[0], "version": keys[1]})
    version = F.coalesce(F.xxhash64(docs[text]), F.lit(0)).bitwiseAND(0x7FFFFFFF).cast("int")
    rows = docs.withColumns({keys[0]: docs[doc_id].cast("long"), keys[1]: version})
    return rows.join(by_shuffle(found), list(keys), "left").drop(*keys)


def removal_digests(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of documents (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = _with_spans(rows, "doc_id", "text", min_words, "spans", ("key_id", "key_version"))
    return in_tasks(rows.select("doc_id", "text", "spans"), _digest(min_words), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", count: str | None = "n_chars", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``; ``count``, if given, is the text's length and follows it."""
    names = docs.columns
    new = [f"_{i}_" + "_".join(names) for i in range(3)]
    rows = _with_spans(docs, doc_id, text, min_words, new[0], (new[1], new[2])).select(*names, new[0])
    return in_tasks(rows, _cleaned(text, count if count in names else None, min_words, names), docs.schema)
