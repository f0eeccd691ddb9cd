"""Search terms of texts: runs of ASCII letters and digits and of all characters beyond ASCII, found in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from dockflow.llm.common import text_bytes, word_hashes

#: A term as an expression; A-Z count as a-z.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True


def term_spans(body: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all terms, and the offsets of each row's terms among them."""
    inside = _INSIDE[body]
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = ends[(ends > 0) & (ends < len(inside))]
    before[cuts] = False
    after[cuts - 1] = False
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, stops, np.searchsorted(starts, ends, "left")


def hashed_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every term of a text column, and the offsets of each row's terms; null texts have none."""
    body, ends = text_bytes(column)
    starts, stops, offsets = term_spans(body, ends)
    return word_hashes(body, starts, stops, lower=True), offsets
