"""Repeated passages found through compact windows of min-hashed word shingles."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.common import mixed, settle, slices, text_bytes, windows_of, word_hashes, word_spans
from dockflow.session import shuffles_dropped

SHINGLE = 5
FUNCTIONS = 4
CHUNK = 128
FEW = 4
CONTEXT = 4
SMALL = 1 << 20
NEAR = 100
SEGMENT_BYTES = 4 << 20
_LINK = "doc long, other long, fn int, at int, shift int, left int, right int"
_ROW = ["signature", "doc", "mark", "at", "left", "right"]
_ROW_DDL = "signature long, doc long, mark int, at int, left int, right int"
_RUN, _SPAN = -1, -2
_ANCHOR = ["anchor", "doc", "at", "left", "right", "ahead", "behind", "around"]
_ANCHOR_DDL = "anchor long, doc long, at int, left int, right int, ahead long, behind long, around long"


def _settled(df: DataFrame, label: str) -> DataFrame:
    """``settle``, and what its query shuffled goes when it is written: the windows, anchors and texts move many times."""
    with shuffles_dropped(df.sparkSession):
        return settle(df, label)


def _narrowed(texts: DataFrame, docs: DataFrame) -> DataFrame:
    """The texts of ``docs``, a written table, before they are shuffled, where these are few enough to tell every task; else all texts."""
    docs = docs.distinct()
    return texts.join(F.broadcast(docs), "doc", "left_semi") if docs.count() <= SMALL else texts


def compact_windows(values: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(left, centre, right) for every subtree of the Cartesian tree of ``values`` that spans ``least`` or more."""
    found = cut_windows(values, least, np.zeros(1, np.int64), np.full(1, len(values), np.int64))
    return list(zip(*(x.tolist() for x in found), strict=True))


def cut_windows(values: np.ndarray, least: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, centre, right) for every subtree of the Cartesian trees of ranges of ``values`` that spans ``least`` or more.

    All subsequences inside a window that hold its centre have their minimum there. The trees of all ranges are cut from
    their roots together: the minimum of a range is its centre, and the parts between such centres follow while they
    are wide enough. Equal minima of a range are cut at once, so repeated words make a tree no deeper; the window of a
    later one begins behind the one before, and of minima side by side only the first has a window.
    """
    out = []
    while True:
        wide = right - left >= max(least, 1)
        left, right = left[wide], right[wide]
        if not len(left):
            break
        length = right - left
        begin = np.concatenate([[0], np.cumsum(length)[:-1]])
        place = np.arange(int(length.sum())) + np.repeat(left - begin, length)
        held = values[place]
        at = place[held == np.repeat(np.minimum.reduceat(held, begin), length)]
        owner = np.searchsorted(left, at, "right") - 1
        first = np.concatenate([[True], owner[1:] != owner[:-1]])
        before = np.where(first, left[owner] - 1, np.concatenate([[-1], at[:-1]]))
        end = right[owner]
        kept = (end - before > least) & (first | (at - before > 1))
        out.append((before[kept] + 1, at[kept], end[kept]))
        last = np.concatenate([first[1:], [True]])
        left, right = np.concatenate([before + 1, at[last] + 1]), np.concatenate([at, end[last]])
        order = np.argsort(left, kind="stable")
        left, right = left[order], right[order]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``count`` consecutive places from each of ``first``, one range after the other."""
    return np.arange(int(count.sum())) + np.repeat(first - np.cumsum(count) + count, count)


def _shingles(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all texts one after the other, and the offsets of each text's shingles among them."""
    body, ends = text_bytes(part.column("text"))
    starts, stops, words = word_spans(body, ends)
    count = np.maximum(np.diff(words) - SHINGLE + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(count)])
    if not offsets[-1]:
        return np.zeros(0, np.uint64), offsets
    # runs that go on in the next text are left out
    return windows_of(word_hashes(body, starts, stops, lower=True), SHINGLE)[_spread(words[:-1], count)], offsets


def _bits(functions: int) -> int:
    """The low bits of a signature that tell its function."""
    return (1 << (functions - 1).bit_length()) - 1


def _marks(shingles: np.ndarray, offsets: np.ndarray, context: int) -> np.ndarray:
    """Two 16-bit hashes in one number for each shingle: of the runs of ``context`` shingles that begin and end with it, 0 where the text has none."""
    short = (run_hashes(shingles, context) >> np.uint64(48)).astype(np.uint32) | np.uint32(1)
    place, number = np.arange(len(shingles)), np.diff(offsets)
    out = np.zeros((2, len(shingles)), np.uint32)
    out[0, : len(short)] = short
    out[1, len(shingles) - len(short) :] = short
    out[0, place + context > np.repeat(offsets[1:], number)] = 0
    out[1, place - context + 1 < np.repeat(offsets[:-1], number)] = 0
    return (out[0] << np.uint32(16) | out[1]).view(np.int32)


def _windows(least: int, functions: int, context: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    seeds = mixed(np.arange(1, functions + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    bits = np.uint64(_bits(functions))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                docs = part.column("doc").to_numpy(zero_copy_only=False)
                shingles, offsets = _shingles(part)
                starts, stops = offsets[:-1], offsets[1:]
                marks = _marks(shingles, offsets, context)
                for fn in range(functions):
                    values = mixed(shingles ^ seeds[fn])
                    left, at, right = cut_windows(values, least, starts, stops)
                    row = np.searchsorted(stops, at, "right")
                    signature = values[at] & ~bits | np.uint64(fn)
                    columns = [marks[at], at - starts[row], at - left, right - at]
                    yield pa.record_batch(
                        [pa.array(signature.view(np.int64)), pa.array(docs[row]), *(pa.array(c.astype(np.int32)) for c in columns)], names=_ROW
                    )

    return run


def _agreeing(rows: np.ndarray) -> np.ndarray:
    """Which windows have the text ahead of their centres or behind them in common with another document of their signature."""
    out = np.zeros(len(rows), bool)
    for half in (0xFFFF, 0xFFFF0000):
        part = rows[:, 2] & half
        order = np.lexsort((rows[:, 1], part, rows[:, 0]))
        key, doc = np.column_stack([rows[order, 0], part[order]]), rows[order, 1]
        begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(rows)), bool), (key[1:] != key[:-1]).any(axis=1)]))
        size = np.diff(np.append(begin, len(rows)))
        # documents are in order within a key
        shared = doc[begin] != doc[begin + size - 1]
        out[order] |= np.repeat(shared, size) & (part[order] != 0)
    return out


def _links(batches: Iterator[pa.RecordBatch], bits: int | None = None) -> Iterator[pa.RecordBatch]:
    """Within each signature, join every window with that of the first document and that of the document before.

    Rows come ordered by signature and document. Of an unfinished signature at most five rows are carried on, so a
    signature that a third of all documents share streams through. Up to three windows all meet each other, if the
    text ahead of their centres or behind them is the same (``_marks``): a shingle alone is often a stock phrase.
    Windows whose signature has more are also given out as they are (``_SPAN``): having the minimum in common does not
    mean having the passage in common, so those are joined again by the anchors around their centres. ``bits`` are those
    of the function in a signature; without them the rows are runs (``_RUN``).
    """
    carry = np.zeros((0, 6), np.int64)
    for batch in batches:
        rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _ROW])
        if not len(rows):
            continue
        kept = len(carry)
        rows = np.vstack([carry, rows])
        # a window repeated by an exact copy of the document is not joined again
        same = np.zeros(len(rows), bool)
        same[1:] = (rows[1:] == rows[:-1]).all(axis=1)
        same[:kept] = False
        rows = rows[~same]
        index = np.arange(len(rows))
        change = np.ones(len(rows), bool)
        change[1:] = rows[1:, 0] != rows[:-1, 0]
        fresh = change.copy()
        fresh[1:] |= rows[1:, 1] != rows[:-1, 1]
        first = np.maximum.accumulate(np.where(change, index, 0))
        begin = np.maximum.accumulate(np.where(fresh, index, 0))
        before = np.where(begin > first, begin - 1, -1)
        later = (index >= kept) & (rows[:, 1] != rows[first, 1])
        chained = later & (before > first)
        mine = np.concatenate([index[later], index[chained]])
        other = np.concatenate([first[later], before[chained]])
        a, b = rows[mine], rows[other]
        mark, differ = a[:, 2], a[:, 2] ^ b[:, 2]
        alike = np.zeros(len(a), bool)
        for half in (0xFFFF, 0xFFFF0000):
            alike |= (mark & half != 0) & (differ & half == 0)
        a, b = a[alike], b[alike]
        fn = np.full(len(a), _RUN) if bits is None else a[:, 0] & bits
        out = [a[:, 1], b[:, 1], fn, a[:, 3], b[:, 3] - a[:, 3], np.minimum(a[:, 4], b[:, 4]), np.minimum(a[:, 5], b[:, 5])]
        many = (index >= kept) & (index - first >= 3) & (bits is not None)
        fourth = index[many & (index - first == 3)]
        picked = np.concatenate([index[many], fourth - 1, fourth - 2, fourth - 3])
        # of a signature that is here from its beginning to its end, only those that agree with another document
        inside = (first[picked] >= kept) & (first[picked] < first[-1])
        spans = rows[np.concatenate([picked[~inside], picked[inside][_agreeing(rows[picked[inside]])]])]
        kind = np.full(len(spans), _SPAN)
        out = [np.concatenate(x) for x in zip(out, [spans[:, 1], spans[:, 1], kind, spans[:, 3], 0 * kind, spans[:, 4], spans[:, 5]], strict=True)]
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5]
        if len(out[0]):
            yield pa.record_batch(
                [pa.array(x.astype(k.to_pandas_dtype())) for x, k in zip(out, kinds, strict=True)],
                names=["doc", "other", "fn", "at", "shift", "left", "right"],
            )
        last = len(rows) - 1
        start = int(first[last])
        picked = sorted({*range(start, min(start + 3, last)), int(before[last]), last} - {-1})
        carry = rows[picked]


def run_hashes(shingles: np.ndarray, least: int) -> np.ndarray:
    """A hash of each run of ``least`` consecutive shingles, from hashes of runs of doubled length that overlap."""
    return runs_of_lengths(shingles, least)[0]


def runs_of_lengths(shingles: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """``run_hashes`` for several lengths, which share the runs of doubled length."""

    def longer(runs: np.ndarray, step: int) -> np.ndarray:
        return mixed(mixed(runs[: max(0, len(runs) - step)]) * np.uint64(0xC2B2AE3D27D4EB4F) + runs[step:])

    out, runs, width = {}, shingles, 1
    for length in sorted(set(lengths)):
        while 2 * width <= length:
            runs, width = longer(runs, width), 2 * width
        out[length] = longer(runs, length - width) if length > width else runs
    return [out[x] for x in lengths]


def anchor_shape(least: int, share: float) -> tuple[int, int, int]:
    """(size, every, need): what two passages of ``least`` shingles with a similarity of ``share`` have in common.

    They have ``need`` shingles in common. A change of one word breaks as many shingles as a shingle has words, one
    fewer where a word is left out, so few changes fit in and one common run is long. The smallest hash of ``every``
    neighbouring runs of ``size`` shingles is an anchor: each common run of that length holds an anchor of both texts,
    and so do the first and the last places of a common run of ``least`` shingles.
    """
    need = min(least, math.ceil(2 * least * share / (1 + share) - 1e-9))
    longest = -(-need // ((least - need) // (SHINGLE - 1) + 1))
    every = max(1, min(6, longest // 3, least - need + 1))
    return longest - every + 1, every, need


def _anchors(least: int, share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each anchor that a passage of ``least`` shingles around the centre of a wanted window may hold.

    ``left`` and ``right`` are the widest extents of the windows it is in; ``ahead`` and ``behind`` the hashes of the
    runs of ``need`` shingles that begin and end with the anchor, 0 where the text is too short; ``around`` that of all
    shingles that a passage of ``least`` with the anchor may have.
    """
    size, every, need = anchor_shape(least, share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                wanted = part.column("wanted")
                asked = pc.list_value_length(wanted).to_numpy(zero_copy_only=False)
                centre, left, right = (wanted.flatten().field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "left", "right"))
                shingles, offsets = _shingles(part)
                # all texts in a row, with room between them for a passage that would go beyond a text
                number = np.diff(offsets)
                begin = offsets[:-1] + least * np.arange(1, len(number) + 1)
                end = begin + number
                row_of = np.zeros(int(offsets[-1]) + least * (len(number) + 1), np.uint64)
                row_of[_spread(begin, number)] = shingles
                short, needed, wide = runs_of_lengths(row_of, size, need, least)
                keys, needed = mixed(short), needed.view(np.int64)
                at = _smallest(keys, _spread(begin, np.maximum(number - size - every + 2, 0)), every)
                base = np.repeat(begin, asked)
                centre, left, right = base + centre, base + centre - left, base + centre + right
                first = np.searchsorted(at, np.maximum(left, centre - least + 1))
                count = np.maximum(np.searchsorted(at, np.minimum(right, centre + least) - size, "right") - first, 0)
                place = _spread(first, count)
                low, high = np.full(len(at), len(row_of)), np.full(len(at), -1)
                np.minimum.at(low, place, np.repeat(left, count))
                np.maximum.at(high, place, np.repeat(right, count))
                at, low, high = (x[high >= 0] for x in (at, low, high))
                doc = np.searchsorted(begin, at, "right") - 1
                rows = np.empty((len(at), 8), np.int64)
                rows[:, 0], rows[:, 1], rows[:, 2] = keys[at].view(np.int64), part.column("doc").to_numpy(zero_copy_only=False)[doc], at - begin[doc]
                rows[:, 3], rows[:, 4] = at - low, high - at
                rows[:, 5] = np.where(at + need <= end[doc], needed[at], 0)
                rows[:, 6] = np.where(at + size - need >= begin[doc], needed[np.maximum(at + size - need, 0)], 0)
                rows[:, 7] = mixed(wide[at] * np.uint64(0xC2B2AE3D27D4EB4F) + wide[at + size - least]).view(np.int64)
                # where words repeat over and over, the first and last of equal anchors side by side tell its place
                equal = (keys[at[1:]] == keys[at[:-1]]) & (doc[1:] == doc[:-1])
                inner = np.zeros(len(at), bool)
                inner[1:-1] = equal[1:] & equal[:-1]
                yield _batch_of(rows[~inner], _ANCHOR)

    return run


def _batch_of(rows: np.ndarray, names: list[str]) -> pa.RecordBatch:
    short = {"fn", "mark", "at", "shift", "left", "right"}
    return pa.record_batch([pa.array(rows[:, i].astype(np.int32 if c in short else np.int64)) for i, c in enumerate(names)], names=names)


def _meet(few: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All pairs of documents that share an anchor, without those that a longer run ties already.

    Rows come ordered by anchor, document and place. The rows of anchors with more than ``few`` are given out as they
    are (``_SPAN``).
    """
    names = ["doc", "other", "fn", "at", "shift", "left", "right", "anchor", "ahead", "behind", "around"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((0, 8), np.int64)
        for batch in itertools.chain(batches, [None]):
            rows = rest
            if batch is not None:
                rows = np.vstack([rest, np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _ANCHOR])])
            if not len(rows):
                continue
            # copies of a document have equal rows
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
            rows = rows[fresh]
            whole = len(rows) if batch is None else int(np.searchsorted(rows[:, 0], rows[-1, 0], "left"))
            rows, rest = rows[:whole], rows[whole:]
            if not len(rows):
                continue
            begin = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
            sizes = np.diff(np.append(begin, len(rows)))
            size = np.repeat(sizes, sizes)
            place = np.arange(len(rows)) - np.repeat(begin, sizes)
            spans = rows[size > few]
            zero = np.zeros(len(spans), np.int64)
            out = [np.column_stack([spans[:, 1], spans[:, 1], zero + _SPAN, spans[:, 2], zero, spans[:, 3], spans[:, 4], spans[:, 0], spans[:, 5], spans[:, 6], spans[:, 7]])]
            for back in range(1, few):
                mine = np.flatnonzero((size <= few) & (place >= back))
                a, b = rows[mine], rows[mine - back]
                tied = ((a[:, 5:7] == b[:, 5:7]) & (a[:, 5:7] != 0)).any(axis=1)
                kept = (a[:, 1] != b[:, 1]) & ~tied
                a, b = a[kept], b[kept]
                zero = np.zeros(len(a), np.int64)
                out.append(np.column_stack([a[:, 1], b[:, 1], zero + _RUN, a[:, 2], b[:, 2] - a[:, 2], np.minimum(a[:, 3], b[:, 3]), np.minimum(a[:, 4], b[:, 4]), zero, zero, zero, zero]))
            yield _batch_of(np.vstack(out), names)

    return run


def _classes(spans: DataFrame, least: int, share: float) -> DataFrame:
    """(anchor, class, doc, place, around, left, right): the documents that hold an anchor of many, by the runs of ``need`` shingles around it.

    Of the first documents of the runs that others share, in reach of its anchor, each document goes to the smallest, that
    one to its own, and so on: documents of a class are tied there by exact runs, which are joined elsewhere. One without
    a shared run is a class alone.
    """
    size, _, need = anchor_shape(least, share)
    runs = spans.select(
        "doc",
        F.explode(F.array(F.struct(F.col("ahead").alias("run"), F.col("at").alias("place")), F.struct(F.col("behind").alias("run"), (F.col("at") + size - need).alias("place")))).alias("r"),
    )
    runs = runs.select("doc", "r.*").filter(F.col("run") != 0).distinct()
    shared = runs.groupBy("run").agg(F.min("doc").alias("head"), F.max("doc").alias("last")).filter(F.col("head") != F.col("last"))
    ties = runs.join(shared, "run").select("doc", "place", "head")
    both = spans.select("doc", F.col("at").alias("place"), "anchor", "around", "left", "right").unionByName(ties, allowMissingColumns=True)
    near = Window.partitionBy("doc").orderBy("place").rangeBetween(size - need - NEAR, NEAR)
    tied = _settled(both.withColumn("head", F.min("head").over(near)).filter(F.col("anchor").isNotNull()), "passage-ties")
    up = tied.groupBy("anchor", "doc").agg(F.min("head").alias("up")).filter(F.col("up") < F.col("doc"))
    while True:
        up = _settled(up, "passage-roots")
        next_up = up.select("anchor", F.col("doc").alias("up"), F.col("up").alias("next"))
        if up.join(next_up, ["anchor", "up"], "left_semi").isEmpty():
            break
        up = up.join(next_up, ["anchor", "up"], "left").select("anchor", "doc", F.coalesce("next", "up").alias("up"))
    return tied.join(up, ["anchor", "doc"], "left").withColumn("class", F.coalesce("up", "doc"))


def _several(classes: DataFrame) -> DataFrame:
    """(anchor, class, doc, place, left, right) where an anchor has several classes: of documents equal wherever a passage may reach, the smallest."""
    several = classes.groupBy("anchor").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("anchor")
    equal = classes.groupBy("anchor", "class", "around").agg(F.min(F.struct("doc", "place", "left", "right")).alias("member"))
    return equal.join(several, "anchor").select("anchor", "class", "member.*")


def beside_shape(least: int, share: float) -> tuple[int, list[int], int, int, int]:
    """(run, steps, short, every, reach): what two passages around a common anchor have in common besides it.

    They have ``need`` shingles in common, which one change cuts into two runs, one of them with the anchor. Either that
    run is long: then a run of ``run`` shingles that begins one of ``steps`` before the anchor is the same. Or the other
    one, at most ``reach`` away, is long enough for the smallest hash of ``every`` neighbouring runs of ``short``.

    Similarity is that of sets, so shingles of one word over and over count once: such a run besides the anchor does not
    make up for what a change costs. An anchor of up to four different shingles, as of one repeated word, says no more
    than these: passages of nothing else share a run of ``need``, others also have some other shingle in common that is
    not one repeated word, since four such lie between any two repeated words.
    """
    size, _, need = anchor_shape(least, share)
    other = max(1, (need - size + 1) // 2)
    more = max(0, need - size - other + 1)
    step = min(5, more + 1)
    short = (other + 2) // 3
    return size + more - step + 1, sorted({min(x, more - step + 1) for x in range(0, more + 1, step)}), short, other - short + 1, math.ceil(least / share)


def _smallest(keys: np.ndarray, start: np.ndarray, every: int) -> np.ndarray:
    """The places of the smallest of ``every`` keys from each of ``start``, the first of equal ones, in order."""
    lowest, back = keys[start], np.zeros(len(start), np.int64)
    for k in range(1, every):
        less = keys[start + k] < lowest
        lowest, back = np.where(less, keys[start + k], lowest), np.where(less, k, back)
    held = np.zeros(len(keys), bool)
    held[start + back] = True
    return np.flatnonzero(held)


def _beside(least: int, share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The wanted anchors of each text, a row for each hash of what else a passage with the anchor may share (``beside_shape``)."""
    size = anchor_shape(least, share)[0]
    length, steps, short, every, reach = beside_shape(least, share)
    names = ["anchor", "class"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                wanted = part.column("wanted")
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
                fields = wanted.flatten()
                shingles, offsets = _shingles(part)
                begin, end = offsets[row], offsets[row + 1]
                at = begin + fields.field("place").to_numpy(zero_copy_only=False)
                runs, long = runs_of_lengths(shingles, short, length)
                runs = mixed(runs)
                owner, keys = [], []
                same = np.zeros(len(shingles), bool)
                same[1:] = shingles[1:] == shingles[:-1]
                same[:-1] |= same[1:].copy()
                own = np.sort(shingles[at[:, None] + np.arange(size)], axis=1)
                fresh = np.ones(own.shape, bool)
                fresh[:, 1:] = own[:, 1:] != own[:, :-1]
                plain = fresh.sum(axis=1) <= FEW
                for step in steps:
                    mine = np.flatnonzero(~plain & (at - step >= begin) & (at - step + length <= end))
                    owner.append(mine)
                    keys.append(mixed(long[at[mine] - step] ^ np.uint64(step + 2)))
                place = _smallest(runs, _spread(offsets[:-1], np.maximum(np.diff(offsets) - short - every + 2, 0)), every)
                place = place[~same[place] | (shingles[place] != shingles[place + short - 1])]
                sides = [(np.maximum(at + size - reach, begin), at), (at + size, np.minimum(at + reach, end))]
                for side, (low, high) in enumerate(sides):
                    first = np.searchsorted(place, low)
                    count = np.where(plain, 0, np.maximum(np.searchsorted(place, high - short, "right") - first, 0))
                    owner.append(np.repeat(np.arange(len(at)), count))
                    keys.append(mixed(runs[place[_spread(first, count)]] ^ np.uint64(side)))
                place = np.flatnonzero(~same)
                first = np.searchsorted(place, sides[0][0])
                count = np.where(plain, np.searchsorted(place, sides[1][1]) - first, 0)
                mine, other = np.repeat(np.arange(len(at)), count), shingles[place[_spread(first, count)]]
                beyond = (own[mine] != other[:, None]).all(axis=1)
                pairs = np.unique(np.column_stack([mine[beyond].astype(np.uint64), mixed(other[beyond])]), axis=0)
                owner, keys = np.concatenate([*owner, pairs[:, 0].astype(np.int64)]), np.concatenate([*keys, pairs[:, 1]]).view(np.int64)
                kept = fields.take(pa.array(owner))
                yield pa.record_batch([*(kept.field(c) for c in names), part.column("doc").take(pa.array(row[owner])), pa.array(keys)], names=[*names, "doc", "key"])

    return run


def _between(beside: DataFrame) -> DataFrame:
    """(anchor, class_a, class_b, doc_a, doc_b): classes of an anchor that share more than it, with the smallest documents that do."""
    ones = beside.groupBy("anchor", "key", "class").agg(F.min("doc").alias("doc"))
    a, b = (ones.select("anchor", "key", F.col("class").alias(f"class_{side}"), F.col("doc").alias(f"doc_{side}")) for side in "ab")
    pairs = a.join(b, ["anchor", "key"]).filter(F.col("class_a") > F.col("class_b"))
    return pairs.groupBy("anchor", "class_a", "class_b").agg(F.min(F.struct("doc_a", "doc_b")).alias("best")).select("anchor", "class_a", "class_b", "best.*")


def _apart(beside: DataFrame, between: DataFrame) -> DataFrame:
    """The same for all documents of the pairs of classes of ``between``, besides those that are there."""
    a, b = (beside.select("anchor", "key", F.col("class").alias(f"class_{side}"), F.col("doc").alias(f"doc_{side}")) for side in "ab")
    wanted = between.select("anchor", "class_a", "class_b").join(a, ["anchor", "class_a"])
    return wanted.join(b, ["anchor", "key", "class_b"]).select(*between.columns).distinct().join(between, between.columns, "left_anti")


def _joined(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Links of the documents of ``between`` at the places that they have the anchor."""
    for side in "ab":
        there = members.select("anchor", F.col("class").alias(f"class_{side}"), F.col("doc").alias(f"doc_{side}"), F.struct("doc", "place", "left", "right").alias(side))
        pairs = pairs.join(there, ["anchor", f"class_{side}", f"doc_{side}"])
    pairs = pairs.filter(F.col("a.doc") != F.col("b.doc")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.select(
        F.col("a.doc").alias("doc"),
        F.col("b.doc").alias("other"),
        F.lit(_RUN).alias("fn"),
        F.col("a.place").alias("at"),
        (F.col("b.place") - F.col("a.place")).alias("shift"),
        F.least("a.left", "b.left").alias("left"),
        F.least("a.right", "b.right").alias("right"),
    )


def _unions(owner: np.ndarray, start: np.ndarray, stop: np.ndarray, shift: np.ndarray, fn: np.ndarray, enough: int) -> np.ndarray:
    """(owner, start, stop, other start, other stop) of the unions of overlapping intervals, which come by owner and start."""
    if not len(owner):
        return np.zeros((0, 5), np.int64)
    # later owners lie beyond all intervals of earlier ones
    room = owner * (int(stop.max() - start.min()) + 1)
    reach = np.maximum.accumulate(stop + room)
    begin = np.flatnonzero(np.concatenate([[True], (start + room)[1:] > reach[:-1]]) | np.concatenate([[True], owner[1:] != owner[:-1]]))
    seen = np.bitwise_or.reduceat(np.left_shift(1, fn - _RUN), begin)
    met = (np.bitwise_count(seen) >= enough) | (seen & 1 == 1)
    ends = (np.maximum.reduceat(stop, begin), np.minimum.reduceat(start + shift, begin), np.maximum.reduceat(stop + shift, begin))
    return np.column_stack([owner[begin], start[begin], *ends])[met]


def _regions(least: int, enough: int, drift: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Join the window pairs of two documents that overlap along the text with nearly the same shift.

    A region is kept if windows of ``enough`` hash functions meet in it, or a whole run of shingles, and if both of
    its sides can hold a passage.
    """
    names = ["doc", "other", "start", "stop", "other_start", "other_stop"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = batch.column("pairs")
            count = pc.list_value_length(pairs).to_numpy(zero_copy_only=False)
            fn, at, shift, left, right = (pairs.flatten().field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("fn", "at", "shift", "left", "right"))
            owner = np.repeat(np.arange(len(count)), count)
            order = np.lexsort((at, at - left, owner))
            fn, shift, owner, start, stop = fn[order], shift[order], owner[order], (at - left)[order], (at + right)[order]
            first = np.cumsum(count) - count
            near = np.maximum.reduceat(shift, first) - np.minimum.reduceat(shift, first) <= drift if len(shift) else np.zeros(0, bool)
            # all shifts of two documents are near each other: their regions are unions of intervals
            own = near[owner]
            rows = _unions(owner[own], start[own], stop[own], shift[own], fn[own], enough)
            found = [rows[np.minimum(rows[:, 2] - rows[:, 1], rows[:, 4] - rows[:, 3]) >= least]]
            for k in np.flatnonzero(~near).tolist():
                part = slice(first[k], first[k] + count[k])
                open_: list[list] = []
                for start_, stop_, shift_, fn_ in zip(*(x[part].tolist() for x in (start, stop, shift, fn)), strict=True):
                    for r in open_:
                        if start_ <= r[1] and abs(shift_ - r[2]) <= drift:
                            r[1], r[2] = max(r[1], stop_), shift_
                            r[3], r[4] = min(r[3], start_ + shift_), max(r[4], stop_ + shift_)
                            r[5].add(fn_)
                            break
                    else:
                        open_.append([start_, stop_, shift_, start_ + shift_, stop_ + shift_, {fn_}])
                met = [r for r in open_ if len(r[5]) >= enough or _RUN in r[5]]
                met = [(k, r[0], r[1], r[3], r[4]) for r in met if min(r[1] - r[0], r[4] - r[3]) >= least]
                found.append(np.array(met, np.int64).reshape(-1, 5))
            rows = np.vstack(found)
            sides = [batch.column(c).take(pa.array(rows[:, 0])) for c in ("doc", "other")]
            yield pa.record_batch([*sides, *(pa.array(rows[:, i]) for i in range(1, 5))], names=names)

    return run


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted shingles of each text, as 32-bit hashes; a few megabytes in a batch, however many are wanted."""

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = {"pair": pa.int64(), "side": pa.int32(), "start": pa.int64(), "segment": pa.binary()}
        return pa.record_batch([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds.values())], names=list(kinds))

    for batch in batches:
        for part in slices(batch, "text"):
            out, held = [], 0
            shingles, offsets = _shingles(part)
            whole = shingles.astype(np.uint32)
            for begin, end, wanted in zip(offsets[:-1].tolist(), offsets[1:].tolist(), part.column("wanted").to_pylist(), strict=True):
                short = whole[begin:end]
                for w in wanted:
                    out.append((w["pair"], w["side"], w["start"], short[w["start"] : w["stop"]].tobytes()))
                    held += len(out[-1][3])
                    if held > SEGMENT_BYTES:
                        yield batch_of(out)
                        out, held = [], 0
            yield batch_of(out)


def _by_document(wanted: DataFrame, fields: list[str], chunk: int = CHUNK) -> DataFrame:
    """(doc, wanted): what is wanted of each document, in rows of about ``chunk`` entries.

    A document that a third of all others are compared with has so many more rows, each joined with its text.
    """
    sizes = wanted.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > chunk)
    dealt = wanted.join(sizes, "doc", "left").withColumn(
        "part", F.pmod(F.xxhash64(*fields), F.coalesce(F.ceil(F.col("n") / chunk), F.lit(1)))
    )
    return dealt.groupBy("doc", "part").agg(F.collect_list(F.struct(*fields)).alias("wanted")).select("doc", "wanted")


def _among(a: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``a`` are in ``known``, which is sorted."""
    return known.take(known.searchsorted(a), mode="clip") == a


def _distinct(a: np.ndarray) -> np.ndarray:
    """``np.unique`` for short arrays, without its fixed cost."""
    a = np.sort(a)
    fresh = np.ones(len(a), bool)
    np.not_equal(a[1:], a[:-1], out=fresh[1:])
    return a[fresh]


def _longest(hit: np.ndarray, penalty: float, least: int) -> tuple[int, int]:
    """The longest run in which hits outweigh ``penalty`` times the rest, without misses at its ends beyond ``least``.

    For places with a running sum below all before, others would be inside a longer run, the farthest one whose sum is
    no smaller is found among the largest sums from there on.
    """
    hits = int(np.count_nonzero(hit))
    if hits == len(hit) and hits >= least:
        return 0, hits
    if hits * (1 + 1 / penalty) < least - 1:
        return 0, 0
    total = np.zeros(len(hit) + 1)
    np.where(hit, 1.0, -penalty).cumsum(out=total[1:])
    lowest = np.minimum.accumulate(total)
    places = np.concatenate([[0], (total[1:] < lowest[:-1]).nonzero()[0] + 1])
    behind = np.maximum.accumulate(total[::-1])
    far = len(hit) - behind.searchsorted(total[places])
    best = int((far - places).argmax())
    start, stop = int(places[best]), int(far[best])
    inside = np.flatnonzero(hit[start:stop])
    if stop - start < least or not len(inside):
        return 0, 0
    first, last = start + int(inside[0]), start + int(inside[-1]) + 1
    lower = max(start, min(first, last - least))
    return lower, min(stop, max(last, lower + least))


def common_passages(a: np.ndarray, b: np.ndarray, least: int, share: float) -> Iterator[tuple[int, int, int, int, float]]:
    """Passages of ``a`` that ``b`` repeats: bounds in both, and the Jaccard similarity of their shingles.

    The longest run of ``a`` is taken in which shingles that the other side has outweigh the others, with the longest
    such run of ``b`` for it; then what is left of it and right of it is searched. Others first weigh so that ``share``
    of a run must be common, then, if the runs are not similar enough as sets, twice as much against it, and at last
    none may be in it.
    """
    if len(a) == len(b) and (a == b).all():
        if len(a) >= least:
            yield 0, len(a), 0, len(b), 1.0
        return
    whole = float(len(a) + len(b) + 1)
    loose = share / (1 - share) if share < 1 else whole
    hit = _among(a, np.sort(b)) if len(b) else np.zeros(len(a), bool)
    todo = [(0, len(a))]
    while todo:
        left, right = todo.pop()
        # a run that is similar enough has so many hits, rounding aside
        if right - left < least or np.count_nonzero(hit[left:right]) < share * least - 1:
            continue
        for penalty in (loose, 2 * loose, whole):
            s, e = _longest(hit[left:right], penalty, least)
            if e - s < least:
                break
            s, e = s + left, e + left
            x = _distinct(a[s:e])
            t, f = _longest(_among(b, x), penalty, least)
            if f - t < least:
                continue
            y = _distinct(b[t:f])
            both = int(np.count_nonzero(_among(x, y)))
            alike = both / (len(x) + len(y) - both)
            if alike >= share:
                yield s, e, t, f, alike
                todo += [(left, s), (e, right)]
                break


def _verify(least: int, share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                a, b = (np.frombuffer(row[k], np.uint32) for k in ("segment", "other_segment"))
                for s, e, t, f, alike in common_passages(a, b, least, share):
                    out.append((row["pair"], row["start"] + s, row["start"] + e + SHINGLE - 1, row["other_start"] + t, row["other_start"] + f + SHINGLE - 1, alike))
            kinds = [pa.int64()] * 5 + [pa.float64()]
            yield pa.record_batch(
                [pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=["pair", "start_word", "end_word", "other_start", "other_end", "similarity"]
            )

    return run


def _compared(texts: DataFrame, links: DataFrame, least: int, share: float, enough: int, drift: int) -> DataFrame:
    """(doc, other, bounds, similarity) of the passages that the documents of the links have in common."""
    paired = links.groupBy("doc", "other").agg(F.collect_list(F.struct("fn", "at", "shift", "left", "right")).alias("pairs"))
    regions = paired.mapInArrow(_regions(least, enough, drift), "doc long, other long, start long, stop long, other_start long, other_stop long")
    regions = _settled(regions.withColumn("pair", F.monotonically_increasing_id()), "passage-regions")
    wanted = regions.select(
        F.explode(
            F.array(
                F.struct("doc", "pair", F.lit(0).alias("side"), F.greatest(F.col("start"), F.lit(0)).alias("start"), "stop"),
                F.struct(F.col("other").alias("doc"), "pair", F.lit(1).alias("side"), F.greatest(F.col("other_start"), F.lit(0)).alias("start"), F.col("other_stop").alias("stop")),
            )
        ).alias("w")
    )
    wanted = _by_document(wanted.select("w.*"), ["pair", "side", "start", "stop"])
    texts = _narrowed(texts, regions.select("doc").unionByName(regions.select(F.col("other").alias("doc"))))
    read = texts.select("doc", "text").join(wanted, "doc").select("text", "wanted").mapInArrow(_segments, "pair long, side int, start long, segment binary")
    both = read.groupBy("pair").agg(
        F.max(F.when(F.col("side") == 0, F.struct("start", "segment"))).alias("a"), F.max(F.when(F.col("side") == 1, F.struct("start", "segment"))).alias("b")
    )
    verified = both.select("pair", F.col("a.start").alias("start"), F.col("a.segment").alias("segment"), F.col("b.start").alias("other_start"), F.col("b.segment").alias("other_segment")).mapInArrow(
        _verify(least, share), "pair long, start_word long, end_word long, other_start long, other_end long, similarity double"
    )
    return verified.join(regions.select("pair", "doc", "other"), "pair").drop("pair")


def repeated_passages(
    docs: DataFrame, words: int = 50, share: float = 0.8, functions: int = FUNCTIONS, enough: int = 1, drift: int = 16
) -> DataFrame:
    """Passages of at least ``words`` words that two different documents have in common.

    Result: (doc_id, start_word, end_word, other_id, other_start, other_end, similarity), word positions from 0, ends
    exclusive; Jaccard similarity of the five-word shingles of both passages is ``share`` or more. Every document is
    joined, per signature, with the first document that has it and with the one before it, so the passages of all
    documents that share one are tied together without all pairs of them. A document equal to others is searched
    once, as its smallest id; each copy of at least ``words`` words has a row for the whole text.

    A passage repeated word for word has the same minimum in both texts under every hash function. Where more than
    three windows share a minimum, which may lie in a stock phrase, anchors and runs around
    their centres are joined too (``_meet``, ``_classes``); pairs inside a class are not expanded. An edited passage is a candidate if
    ``enough`` of ``functions`` bring its two windows together. Null, empty and short texts have no passages. Rows
    that repeat an id and text are one document; a null id is reported as null. An empty table gives an empty
    result; other columns are ignored. Documents are told apart by a 64-bit hash of their text.
    """
    least = words - SHINGLE + 1
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).withColumn("doc", F.xxhash64("text"))
    # a passage has a common run of four times so many shingles
    size, every, _ = anchor_shape(least, share)
    context = max(1, min(CONTEXT, (size + every - 1) // 4))
    linked = lambda rows, bits: rows.repartition("signature").sortWithinPartitions("signature", "doc", "at").mapInArrow(partial(_links, bits=bits), _LINK)
    links = _settled(linked(texts.select("doc", "text").mapInArrow(_windows(least, functions, context), _ROW_DDL), _bits(functions)), "passage-links")
    spans = _by_document(links.filter(F.col("fn") == _SPAN).select("doc", "at", "left", "right").distinct(), ["at", "left", "right"], chunk=1 << 40)
    anchors = _settled(texts.select("doc", "text").join(spans, "doc").select("doc", "text", "wanted").mapInArrow(_anchors(least, share), _ANCHOR_DDL), "passage-anchors")
    runs = anchors.select(F.explode(F.array("ahead", "behind")).alias("signature"), "doc", F.lit(-1).alias("mark"), "at", "left", "right").filter(F.col("signature") != 0)
    met = _settled(
        anchors.repartition("anchor").sortWithinPartitions("anchor", "doc", "at").mapInArrow(_meet(FEW), _LINK + ", anchor long, ahead long, behind long, around long"), "passage-anchors-met"
    )
    names = links.columns
    links = links.filter(F.col("fn") >= 0).unionByName(linked(runs, None)).unionByName(met.filter(F.col("fn") == _RUN).select(*names))
    classes = _settled(_classes(met.filter(F.col("fn") == _SPAN), least, share), "passage-classes")
    members = _settled(_several(classes), "passage-members")
    wanted = _by_document(members.select("doc", "anchor", "class", "place"), ["anchor", "class", "place"])
    beside = _settled(
        _narrowed(texts, members.select("doc")).select("doc", "text").join(wanted, "doc").select("doc", "text", "wanted").mapInArrow(_beside(least, share), "anchor long, class long, doc long, key long"),
        "passage-beside",
    )
    between = _settled(_between(beside), "passage-class-pairs")
    links = links.unionByName(_joined(between, members)).distinct()
    found = _settled(_compared(texts, links, least, share, enough, drift), "passages-found")
    # classes that no pair of their documents ties yet: where the first are not alike, others may be
    pairs = found.select("doc", "other").distinct()
    a, b = (classes.select("anchor", F.col("doc").alias(name), F.col("class").alias(f"class_{name}")).distinct() for name in ("doc", "other"))
    tied = pairs.join(a, "doc").join(b, ["anchor", "other"]).select("anchor", F.greatest("class_doc", "class_other").alias("class_a"), F.least("class_doc", "class_other").alias("class_b"))
    apart = between.join(tied.distinct(), ["anchor", "class_a", "class_b"], "left_anti")
    more = _joined(_settled(_apart(beside, apart), "passage-class-pairs"), members).distinct().join(pairs, ["doc", "other"], "left_anti").select(*names)
    found = found.unionByName(_settled(_compared(texts, more, least, share, enough, drift), "passages-found"))
    heads = _settled(texts.select("doc", "doc_id").distinct(), "passage-documents")
    ids = heads.groupBy("doc").agg(F.min("doc_id").alias("head"))
    named = (
        found.join(ids.select("doc", F.col("head").alias("doc_id")), "doc")
        .join(ids.select(F.col("doc").alias("other"), F.col("head").alias("other_id")), "other")
    )
    again = _settled(heads.join(ids, "doc").filter(~F.col("doc_id").eqNullSafe(F.col("head"))), "passage-copies")
    n_words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_words")
    sizes = _settled(_narrowed(texts, again.select("doc")).select("doc", n_words).distinct(), "passage-sizes")
    copies = again.join(sizes.filter(F.col("n_words") >= words), "doc")
    zero = F.lit(0).cast("long")
    return named.select("doc_id", "start_word", "end_word", "other_id", "other_start", "other_end", "similarity").unionByName(
        copies.select(
            "doc_id",
            zero.alias("start_word"),
            F.col("n_words").alias("end_word"),
            F.col("head").alias("other_id"),
            zero.alias("other_start"),
            F.col("n_words").alias("other_end"),
            F.lit(1.0).alias("similarity"),
        )
    )
