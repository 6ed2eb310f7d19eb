"""Packing examples into sequences under limits on tokens, segments and loss-bearing tokens at once.

A vector bin packing by the dot-product heuristic: an open sequence takes, again and again, the example whose demand has
the largest weighted product with what is left of the limits, among those that fit; the weights are the shares
of the limits that all examples together ask for. Examples of equal demand are one class, so a choice costs the number
of classes. An example longer than a sequence is cut into full sequences and a rest. What no example fills is
filled by cutting one, unless less than ``least_cut`` tokens are left. The last sequence of a block is cut at powers
of two, so that it needs no padding.

Each task packs its own rows in blocks of ``block_tokens`` tokens, so memory is bounded, nothing is shuffled and
only the last sequences of a block differ from what one packing of all rows would give. Rows are taken in the order in
which they come; sequence ids hold the partition's number in their upper bits.

Null texts are empty, and an empty text is the end id alone. Repeated rows and equal ids are examples of
their own; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.memo import RaggedMemo
from gridmart.llm.tables import in_tasks
from gridmart.llm.words import Words, mixed, span_hashes, words_of

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss long"
MAX_TOKENS, MAX_SEGMENTS, LEAST_CUT, BLOCK_TOKENS = 4096, 512, 32, 2_000_000
MEMO_PARTS, SLICE_BYTES = 1_500_000, 1_000_000


_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = _LETTER
_CLASS[0xC3:0xC9] = _LETTER  # U+00C0-U+023F, but for the three below; what follows is of the same class
_CLASS[0x80:0xC0] = _LETTER
_NO_LETTER = [0xC397, 0xC3B7, 0xC4B0]  # signs, and a capital whose lower case is two characters
_AFTER_QUOTE = np.zeros(256, bool)
_AFTER_QUOTE[list(b"strvmldSTRVMLD")] = True


class WordIds:
    """Ids of texts by a word tokenizer: no token of its model crosses white space or the classes of characters.

    Lower case and the split into letters, digits and signs are done here for words of ASCII and U+00C0-U+023F without
    contractions, the library's model does the rest; other words, and those that may hold an added token, go through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        #: How the texts of added tokens begin; a word with such a pair is one for the whole tokenizer.
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(len(t) < 2 or _CLASS[list(t)].min() == _SPACE for t in added):
            raise ValueError(f"Added tokens of one byte or with white space are not supported: {added}")
        self.added = np.array(sorted({t[0] << 8 | t[1] for t in added}), np.uint16)
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(printable)]
        self.letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.memo = RaggedMemo(1, MEMO_PARTS)

    def _spans(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the parts of all words, and which are whole words for the tokenizer."""
        data = words.data
        kind = _CLASS[data]
        pair = data[:-1].astype(np.uint16) << 8 | data[1:]
        odd = kind == _OTHER
        odd[:-1] |= np.isin(pair, _NO_LETTER) | np.isin(pair, self.added) | ((data[:-1] == ord("'")) & _AFTER_QUOTE[data[1:]])
        total = np.concatenate(([0], np.cumsum(odd)))
        whole = total[words.ends] > total[words.starts]
        start = np.zeros(len(data) + 1, bool)
        start[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        change = np.zeros(len(data) + 1, np.int8)
        change[words.starts[whole]] = 1
        change[words.ends[whole]] -= 1
        within = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
        start[:-1] &= ~within & (kind != _SPACE)
        start[words.starts] = True
        starts = np.flatnonzero(start[:-1])
        word = np.searchsorted(words.starts, starts, "right") - 1
        following = np.append(starts[1:], len(data))
        return starts, np.minimum(following, words.ends[word]), whole[word]

    def _ids(self, part: str) -> bytes:
        spelt = part if part.isascii() else "".join([self.letter[b] for b in part.encode()])
        return array("I", [x.id for x in self.model.tokenize(spelt)]).tobytes()

    def of_words(self, words: Words) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if not len(words.starts):
            yield from (np.zeros(0, np.uint32) for _ in words.counts)
            return
        starts, ends, whole = self._spans(words)
        hashes = span_hashes(words.data, starts, ends, lower=True)
        # Added tokens are told with their case.
        hashes[whole] = mixed(span_hashes(words.data, starts[whole], ends[whole]) ^ np.uint64(0x5EED))
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)

        def make(new: np.ndarray) -> tuple[list[bytes]]:
            data, at = words.data.tobytes(), first[new]
            texts = [data[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            odd = [text for text, x in zip(texts, whole[at], strict=True) if x]
            found = iter(self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)) if odd else iter(())
            return ([array("I", next(found).ids).tobytes() if x else self._ids(text.lower()) for text, x in zip(texts, whole[at].tolist(), strict=True)],)

        ids, id_ends = self.memo.joined(0, self.memo.of(keys, make)[inverse], np.uint32)
        bounds = np.searchsorted(starts, np.append(words.starts, len(words.data))[words.bounds])
        edges = np.concatenate(([0], id_ends))[bounds].tolist()
        for a, b in zip(edges, edges[1:], strict=False):
            yield ids[a:b]


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of a file, loaded once in a worker."""
    if path not in _known:
        _known[path] = WordIds(path)
    return _known[path]


def pack(tokens: np.ndarray, loss: np.ndarray, max_tokens: int, max_segments: int, max_loss: int, least_cut: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(example, start, length)``; ``loss`` of an example lies on its last tokens.

    A cut example has its loss-bearing tokens where they lie.
    """
    sequences: list[list[tuple[int, int, int]]] = []
    waiting: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (tokens, loss) left: (example, start)

    def put(example: int, start: int) -> None:
        left = int(tokens[example]) - start
        if left > 0:
            waiting.setdefault((left, min(int(loss[example]), left)), []).append((example, start))

    def learnt(example: int, start: int, length: int) -> int:
        return max(0, start + length - max(start, int(tokens[example] - loss[example])))

    for example in range(len(tokens)):
        start = 0
        while tokens[example] - start >= max_tokens and learnt(example, start, max_tokens) <= max_loss:
            sequences.append([(example, start, max_tokens)])
            start += max_tokens
        put(example, start)
    kinds = sorted(waiting)
    size = np.array([x[0] for x in kinds], np.int64)
    bears = np.array([x[1] for x in kinds], np.int64)
    asked = np.array([sum(x[i] * len(waiting[x]) for x in kinds) / limit for i, limit in ((0, max_tokens), (1, max_loss))])
    parts = sum(len(x) for x in waiting.values()) / max_segments
    weights = asked / max(asked.sum() + parts, 1e-9)

    def take(at: int) -> tuple[int, int]:
        nonlocal size, bears
        kind = (int(size[at]), int(bears[at]))
        found = waiting[kind].pop()
        if not waiting[kind]:
            del waiting[kind]
            size, bears = np.delete(size, at), np.delete(bears, at)
        return found

    while len(size):
        own: list[tuple[int, int, int]] = []
        used = used_loss = 0
        while len(own) < max_segments:
            n = int(np.searchsorted(size, max_tokens - used, "right"))
            # Every example asks for one segment, which adds the same to all products.
            gain = size[:n] * (weights[0] * (max_tokens - used) / max_tokens**2)
            gain += bears[:n] * (weights[1] * (max_loss - used_loss) / max_loss**2)
            gain[bears[:n] > max_loss - used_loss] = -1
            best = int(gain.argmax()) if n else -1
            if best < 0 or gain[best] < 0:
                break
            length, learns = int(size[best]), int(bears[best])
            example, start = take(best)
            own.append((example, start, length))
            used += length
            used_loss += learns
        left = max_tokens - used
        if len(size) and len(own) < max_segments and (left >= least_cut or not own):
            # Cut the largest example: its loss lies at its end, so its start asks for the least.
            length, learns = int(size[-1]), int(bears[-1])
            cut = min(left, length - learns + max_loss - used_loss, length)
            if cut >= min(least_cut, left):
                example, start = take(len(size) - 1)
                own.append((example, start, cut))
                used += cut
                if cut < length:
                    kind = (length - cut, min(learns, length - cut))
                    if kind not in waiting:
                        at = int(np.searchsorted(size, kind[0]))
                        size, bears = np.insert(size, at, kind[0]), np.insert(bears, at, kind[1])
                    put(example, start + cut)
        if not own:
            raise ValueError("an example fits no sequence: the limits are too low")
        if not len(size) and used & (used - 1):
            sequences += _powers_of_two(own, used)
        else:
            sequences.append(own)
    return sequences


def _powers_of_two(own: list[tuple[int, int, int]], used: int) -> list[list[tuple[int, int, int]]]:
    """A last sequence, cut into sequences whose lengths are the powers of two that it is the sum of."""
    out, queue = [], own[::-1]
    for bit in range(used.bit_length() - 1, -1, -1):
        left = used & (1 << bit)
        if left:
            out.append([])
        while left:
            example, start, length = queue.pop()
            taken = min(left, length)
            out[-1].append((example, start, taken))
            left -= taken
            if taken < length:
                queue.append((example, start + taken, length - taken))
    return out


def _packed(tokenizer: str, end_id: int, limits: tuple[int, int, int], least_cut: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = word_ids(tokenizer)
        number = TaskContext.get().partitionId() << 33
        ids: list[np.ndarray] = []
        docs: list[int | None] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal number, ids, docs, held
            tokens = np.array([len(x) for x in ids], np.int64)
            columns: list[list] = [[] for _ in range(8)]
            # All ids but a document's first are predicted.
            for sequence in pack(tokens, tokens - 1, *limits, least_cut):
                offset = 0
                for example, start, length in sequence:
                    crc = zlib.crc32(ids[example][start : start + length])
                    row = (docs[example], start, length, crc, int(tokens[example]), number, offset, length - (start == 0))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += length
                number += 1
            ids, docs, held = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=[x.split()[0] for x in PIECES.split(", ")])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for words in words_of(batch.column(1), size=SLICE_BYTES):
                for i, found in enumerate(own.of_words(words), words.first):
                    ids.append(np.append(found, np.uint32(end_id)).astype("<u4"))
                    docs.append(keys[i])
                    held += len(ids[-1])
                    if held >= block_tokens:
                        yield block()
        if ids:
            yield block()

    return run


def pack_documents(
    documents: DataFrame, tokenizer: str, end_id: int = 2, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_TOKENS, least_cut: int = LEAST_CUT, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The pieces of all documents (doc_id, text) and their places in sequences: ``PIECES``.

    ``tokenizer`` is the path of a tokenizer file; each document ends with ``end_id``.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_tasks(rows, _packed(tokenizer, end_id, (max_tokens, max_segments, max_loss), least_cut, block_tokens), PIECES)
