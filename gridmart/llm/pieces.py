"""Encoding and decoding by a merge-type piece model with byte fallback, without merging texts.

A sequence of pieces is what merging gives for a text if and only if it does so for each two neighbours. So every prefix of
a text has one last piece: one that ends there, is what merging gives for its own letters and goes with the last piece of
the prefix before it. An automaton over all pieces finds the candidates of each position in one pass, a table keeps the last
piece of each prefix, and the ids are read backwards from the end of the text. Which pieces go together is found out
once for each pair, by merging the two alone.

Texts are cut between any two bytes that are neighbours in no piece, since no piece can cross there. The cuts' results are
remembered within bounds. A null text is empty and has no ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.memo import RaggedMemo
from gridmart.llm.tables import in_tasks
from gridmart.llm.words import column_bytes, span_hashes

SPACE = "▁"
NORMAL = 1
MEMO_CUTS, MEMO_PAIRS, SLICE_BYTES = 2_500_000, 1_000_000, 4_000_000


class PieceCoder:
    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: list[float] = []
        self.surface: list[str] = []
        self.byte_of: dict[int, int] = {}
        self.byte_ids: list[int] = [-1] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.score.append(model.get_score(i))
            self.surface.append(piece.replace(SPACE, " "))
            if model.is_byte(i):
                self.byte_of[i] = int(piece[3:5], 16)
                self.byte_ids[self.byte_of[i]] = i
            elif model.is_control(i) or model.is_unknown(i):
                self.surface[i] = "" if model.is_control(i) else " ⁇ "
            elif not model.is_unused(i):
                self.ids[piece] = i
        self.highest_byte = max(self.byte_ids)
        if -1 in self.byte_ids:
            raise ValueError("the model has no byte fallback")
        #: Pairs of neighbouring bytes that some piece has; between all others a text can be cut.
        self.inside = np.zeros(1 << 16, bool)
        for piece in self.ids:
            letters = np.frombuffer(piece.replace(SPACE, " ").encode(), np.uint8).astype(np.int64)
            self.inside[letters[:-1] << 8 | letters[1:]] = True
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == [piece]:  # others never come out of merging
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.pieces = {i: x for x, i in self.ids.items()}
        self.pairs: dict[int, bool] = {}
        self.memo = RaggedMemo(2, MEMO_CUTS)

    def merged(self, text: str) -> list[str]:
        """What merging gives: the best-scored neighbours first, the leftmost among equals."""
        parts, ids, score = list(text), self.ids, self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or score[found] > best):
                    best, at = score[found], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def together(self, left: int, right: int) -> bool:
        """Whether merging leaves the two pieces as they are next to each other."""
        a, b = self.pieces[left], self.pieces[right]
        known = a + b not in self.ids and self.merged(a + b) == [a, b]
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        self.pairs[left << 20 | right] = known
        return known

    def ids_of_cut(self, cut: str) -> list[int]:
        """Ids of letters that no piece enters or leaves; white space is ``SPACE``."""
        n = len(cut)
        last, size = [-1] * n, [0] * n  # of each prefix: its last piece and that piece's length; 0: an unknown letter
        known = self.pairs.get
        for end, (length, i) in self.automaton.iter(cut):
            if size[end]:
                continue
            start = end - length
            if start >= 0 and (before := last[start]) >= 0:
                fits = known(before << 20 | i)
                if fits is None:
                    fits = self.together(before, i)
                if not fits:
                    continue
            last[end], size[end] = i, length
        out, at = [], n - 1
        while at >= 0:
            if size[at]:
                out.append(last[at])
                at -= size[at]
            else:
                out.extend([self.byte_ids[b] for b in reversed(cut[at].encode())])
                at -= 1
        out.reverse()
        return out

    def surface_of(self, ids: list[int]) -> str:
        """Letters of ids; runs of byte ids are decoded together, each wrong byte to U+FFFD."""
        if ids and min(ids) > self.highest_byte:
            return "".join([self.surface[i] for i in ids])
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_decoded(bytes(run)))
                run.clear()
            out.append(self.surface[i])
        if run:
            out.append(_decoded(bytes(run)))
        return "".join(out)

    def starts(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where the cuts of UTF-8 texts begin; ``edges`` are the beginnings of texts that are not empty."""
        start = np.zeros(len(data), bool)
        pair = data[:-1].astype(np.uint16) << 8 | data[1:]
        start[1:] = ~self.inside[pair] & ((data[1:] & 0xC0) != 0x80)
        start[edges] = True
        return np.flatnonzero(start)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        whole = (" " + text.replace(SPACE, " ")).encode()
        at = self.starts(np.frombuffer(whole, np.uint8), np.zeros(1, int)).tolist()
        cuts = [whole[a:b].decode().replace(" ", SPACE) for a, b in zip(at, [*at[1:], len(whole)], strict=True)]
        return [i for cut in cuts for i in self.ids_of_cut(cut)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that every text starts with is taken off."""
        text = self.surface_of(ids)
        return text[1:] if ids and text.startswith(" ") and ids[0] not in self.byte_of else text

    def digests(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, str, str]]:
        """Number and digest of the ids, and digest of the decoded text, of each text between the offsets ``at``.

        The texts are UTF-8 in which ``SPACE`` is a space already.
        """
        empty = at[1:] == at[:-1]
        edges = at + np.concatenate(([0], np.cumsum(~empty)))  # every text but an empty one gets a space in front
        data = np.insert(data[at[0] : at[-1]], at[:-1][~empty] - at[0], 32)
        edges -= at[0]
        starts = self.starts(data, edges[:-1][~empty])
        ends = np.append(starts[1:], len(data))
        keys, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)

        def make(new: np.ndarray) -> tuple[list[bytes], list[bytes]]:
            whole, ids, texts = data.tobytes(), [], []
            for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True):
                found = self.ids_of_cut(whole[a:b].decode().replace(" ", SPACE))
                ids.append((",".join(map(str, found)) + ",").encode())
                texts.append(self.surface_of(found).encode())
            return ids, texts

        rows = self.memo.of(keys, make)[inverse]
        bounds = np.searchsorted(starts, edges)
        ids, id_ends = self.memo.joined(0, rows)
        texts, text_ends = self.memo.joined(1, rows)
        count = np.concatenate(([0], np.cumsum(ids == 44)))
        id_at, text_at = (np.concatenate(([0], x))[bounds] for x in (id_ends, text_ends))
        n = np.diff(count[id_at])
        for i in range(len(n)):
            own = ids[id_at[i] : max(id_at[i], id_at[i + 1] - 1)]
            text = texts[text_at[i] : text_at[i + 1]]
            yield int(n[i]), sha256(own).hexdigest(), sha256(text[1:] if n[i] else text).hexdigest()


def _decoded(data: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that is part of no character."""
    out, at = [], 0
    while at < len(data):
        for length in (1, 2, 3, 4):
            try:
                out.append(data[at : at + length].decode())
                at += length
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_known: dict[str, PieceCoder] = {}


def coder(path: str) -> PieceCoder:
    """The model of a file, loaded once in a worker."""
    if path not in _known:
        _known[path] = PieceCoder(path)
    return _known[path]


def _texts(column: pa.Array, chars: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """Slices of a column and where they start; null texts are empty."""
    first, held, long = 0, [], 0
    for i, value in enumerate(column):
        text = value.as_py() or ""
        held.append(text)
        long += len(text)
        if long >= chars:
            yield first, held
            first, held, long = i + 1, [], 0
    if held:
        yield first, held


def _digested(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model)
        for batch in batches:
            data, at = column_bytes(pc.replace_substring(batch.column(1), SPACE, " "))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SLICE_BYTES, "right")) - 1)
                rows = list(zip(*own.digests(data, at[lo : hi + 1]), strict=True))
                kinds = (pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(x, t) for x, t in zip(rows, kinds, strict=True))],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                lo = hi

    return run


def _encoded(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model)
        for batch in batches:
            for first, texts in _texts(batch.column(1)):
                ids = [own.encode(x) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(ids, pa.list_(pa.int32())), pa.array(map(own.decode, ids), pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    return run


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_documents(documents: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` of each document; ``model`` is the path of a model file."""
    return in_tasks(_rows(documents), _encoded(model), "doc_id long, ids array<int>, decoded string")


def encoding_digests(documents: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: the same as digests of decimal ids and of the text."""
    return in_tasks(_rows(documents), _digested(model), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
