"""Byte-level BPE in two tiers: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest.

Tokens never join a character that is not white space to white space after it, so a text falls into segments, each
a run of white space and what follows it, that are encoded apart. Encoded segments are kept in a bounded table of
each Python process.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop as pop, heappush as push

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from dockflow.llm.common import column_text, slices

_SEGMENT = re.compile(r"(?<=\S)(?= )")
_BEHIND_SPACE = re.compile(r"\s ")
_SIGNS = frozenset("!\"#$%&()*+,-./:;<=>?@[]^_`{|}~")
_KEPT = 150_000
_LONGEST_KEPT = 64
_HASH = xxhash.xxh3_64_intdigest


@dataclass
class PerfectHash:
    """A minimal perfect hash of byte strings: n keys in n slots, with a seed per bucket of about four keys.

    Buckets are placed largest first under the first seed that puts all their keys in free slots; the last ones, of a
    single key each, name their slot outright (as a negative number).
    """

    keys: list[bytes]
    values: list[int]
    seeds: list[int]

    @classmethod
    def of(cls, table: dict[bytes, int]) -> PerfectHash:
        n = len(table)
        buckets: list[list[bytes]] = [[] for _ in range(max(1, n // 4))]
        for key in table:
            buckets[_HASH(key) % len(buckets)].append(key)
        keys: list[bytes | None] = [None] * n
        seeds = [0] * len(buckets)
        order = sorted(range(len(buckets)), key=lambda b: -len(buckets[b]))
        for b in order:
            held = buckets[b]
            if len(held) < 2:
                break
            seed = 1
            while True:
                at = []
                for k in held:
                    i = _HASH(k, seed) % n
                    if keys[i] is not None or i in at:
                        break
                    at.append(i)
                if len(at) == len(held):
                    break
                seed += 1
            for k, i in zip(held, at, strict=True):
                keys[i] = k
            seeds[b] = seed
        free = (i for i in range(n) if keys[i] is None)
        for b in order:
            if len(buckets[b]) == 1:
                i = next(free)
                keys[i], seeds[b] = buckets[b][0], -i - 1
        return cls(keys, [table[k] for k in keys], seeds)

    def get(self, key: bytes) -> int | None:
        if not self.keys:
            return None
        seed = self.seeds[_HASH(key) % len(self.seeds)]
        slot = -seed - 1 if seed < 0 else _HASH(key, seed) % len(self.keys)
        return self.values[slot] if self.keys[slot] == key else None


def segments(text: str) -> list[str]:
    """Cut a text before each space that follows something else."""
    if not text or "\0" in text or _BEHIND_SPACE.search(text):
        return _SEGMENT.split(text)
    cut = text.replace(" ", "\0 ").split("\0")
    return cut if cut[0] else cut[1:]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_WIDE = 1 << 20


def joins(ranks: dict[bytes, int]) -> dict[int, int]:
    """The id of every two tokens whose bytes together are a token, under ``left * 2**20 + right``."""
    out = {}
    for whole, rank in ranks.items():
        for cut in range(1, len(whole)):
            left, right = ranks.get(whole[:cut]), ranks.get(whole[cut:])
            if left is not None and right is not None:
                out[left * _WIDE + right] = rank
    return out


def single_bytes(ranks: dict[bytes, int]) -> list[int | None]:
    """The id of each byte."""
    return [ranks.get(bytes([i])) for i in range(256)]


def merge(piece: bytes, ranks: dict[bytes, int], joined: dict[int, int] | None = None, single: list[int | None] | None = None) -> list[int]:
    """Merge the bytes of one pre-token: lowest rank first, leftmost of equals, over a linked list with a heap.

    A heap entry is one number made of the rank, the place and the end of what would be merged. ``ids`` holds the token
    at a live place, ``after`` its next place; the last place and those merged away are followed by the end.
    """
    n = len(piece)
    get = (joins(ranks) if joined is None else joined).get
    # a place and an end take ``wide`` bits each
    wide = n.bit_length()
    low, rankwise = (1 << wide) - 1, 2 * wide
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    single = single or single_bytes(ranks)
    ids = [single[b] for b in piece]
    heap = [rank << rankwise | i << wide | i + 2 for i, (left, right) in enumerate(zip(ids, ids[1:])) if (rank := get(left << 20 | right)) is not None]
    heapify(heap)
    while heap:
        top = pop(heap)
        stop = top & low
        i = top >> wide & low
        j = after[i]
        if j >= n or after[j] != stop:
            continue
        after[j] = n
        after[i] = stop
        mine = ids[i] = top >> rankwise
        if stop < n:
            before[stop] = i
            rank = get(mine << 20 | ids[stop])
            if rank is not None:
                push(heap, rank << rankwise | i << wide | after[stop])
        if i:
            h = before[i]
            rank = get(ids[h] << 20 | mine)
            if rank is not None:
                push(heap, rank << rankwise | h << wide | stop)
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


@dataclass
class Encoder:
    ranks: dict[bytes, int]
    pattern: str
    whole: PerfectHash = field(init=False)
    kept: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.whole = PerfectHash.of(self.ranks)
        self.compiled = regex.compile(self.pattern)
        self.signs_apart = self.pattern == public_tokenizers.PATTERN
        pieces = {v: k for k, v in self.ranks.items()}
        self.tokens = pa.array([pieces.get(i) for i in range(max(pieces, default=-1) + 1)], pa.binary())
        self.joined = joins(self.ranks)
        self.single = single_bytes(self.ranks)

    def piece(self, piece: str) -> bytes:
        """Ids of one pre-token: the whole of it if the vocabulary has it, else its merged bytes."""
        raw = piece.encode()
        known = self.whole.get(raw)
        ids = merge(raw, self.ranks, self.joined, self.single) if known is None else [known]
        return struct.pack(f"<{len(ids)}I", *ids)

    def segment(self, text: str) -> bytes:
        known = self.older.get(text)
        if known:
            return self._keep(text, known)
        # letters after at most one space are one pre-token, a sign behind them is another
        word = text[text[0] == " " :]
        if word.isalpha():
            return self._keep(text, self.piece(text))
        kept, older, piece = self.kept.get, self.older.get, self.piece
        if self.signs_apart and word[-1:] in _SIGNS and word[:-1].isalpha():
            return (kept(text[:-1]) or self.segment(text[:-1])) + (kept(word[-1]) or self._keep(word[-1], older(word[-1]) or piece(word[-1])))
        packed = b"".join([kept(p) or self._keep(p, older(p) or piece(p)) for p in self.compiled.findall(text)])
        return self._keep(text, packed)

    def _keep(self, text: str, packed: bytes) -> bytes:
        """Keep what was encoded; of what was kept before, what is asked for again goes on, the rest goes in its turn."""
        if len(text) <= _LONGEST_KEPT:
            if len(self.kept) >= _KEPT:
                self.older = dict(self.kept)
                self.kept.clear()
            self.kept[text] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian 32-bit integers."""
        kept, segment = self.kept.get, self.segment
        return b"".join([kept(s) or segment(s) for s in segments(text)]) if text else b""

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all([ids])[0].as_py()

    def decode_all(self, ids: list[bytes]) -> pa.Array:
        """The bytes of each list of ids: the tokens of all lists are put side by side at once, then cut by list."""
        tokens = np.frombuffer(b"".join(ids), "<u4")
        taken = self.tokens.take(pa.array(tokens))
        if taken.null_count:
            raise KeyError("an id without a token")
        _, offsets, body = pa.concat_arrays([taken, pa.array([b""], pa.binary())]).buffers()
        ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
        cuts = np.frombuffer(offsets, np.int32)[ends]
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(np.ascontiguousarray(cuts)), body])


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file, built once per Python process."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(read_ranks(path), pattern)
    return _encoders[path, pattern]


def _run(path: str, pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [coder.encode(t) for t in column_text(part.column("text"))]
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        coder.decode_all(ids),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return run


def encode_documents(docs: DataFrame, ranks: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Encode every text and decode it again: (doc_id, n_tokens, ids, decoded), without special tokens.

    ``ids`` holds little-endian unsigned 32-bit integers; ``decoded`` the bytes of the decoded ids. A null or empty
    text has no ids. Long texts are encoded whole, in time n log n in their longest run without a space. Rows are
    independent: repeated rows repeat, an empty table gives an empty result, and other columns are ignored.
    """
    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(_run(path, pattern), f"doc_id {kind}, n_tokens long, ids binary, decoded binary")
