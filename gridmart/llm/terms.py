"""Terms of texts: maximal runs of 0-9, A-Z, a-z and all characters beyond ASCII, with A-Z lower-cased."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from gridmart.llm.words import Words, column_bytes, words_of

#: Each byte as it is in a term; bytes between terms become blanks.
_IN_TERM = np.full(256, 0x20, np.uint8)
for _lo, _hi in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _IN_TERM[_lo : _hi + 1] = np.arange(_lo, _hi + 1)
_IN_TERM[0x41:0x5B] = _IN_TERM[0x61:0x7B]


def terms_of(column: pa.Array) -> Iterator[Words]:
    """The terms of a column of texts in slices of whole texts; a null text has none."""
    data, at = column_bytes(column)
    at = np.ascontiguousarray(at)
    lo, hi = (int(at[0]), int(at[-1])) if len(at) else (0, 0)
    plain = pa.py_buffer(_IN_TERM[data[lo:hi]])
    yield from words_of(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at - lo), plain]))
