"""Jaccard join of documents on word shingles by T-occurrence search.

Two sets with Jaccard similarity of at least ``share`` have at least T shingles in common, where T follows from their
sizes. Ordered from rare to frequent, one of the first ``size - T + 1`` shingles of each must be common, so these are
the short lists of the search across the cluster: an exchange by shingle brings each inverted list together. Pairs
from lists of a few documents are bounded in number; longer lists only tie their documents together. Tied documents
form clusters, and inside a cluster (in blocks, if it is large) DivideSkip runs on inverted lists: short lists are
merged with a heap and counted, long ones probed by binary search for the documents that can still reach T.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import mixed, settle, slices, text_bytes, windows_of, word_hashes, word_spans
from dockflow.llm.components import components

BUCKETS = 1 << 22
SHORT_RUN = 16
LONG_RUN = 4096
BLOCK = 2_000_000


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def _hash_rows(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    body, ends = text_bytes(part.column("text"))
    starts, stops, words = word_spans(body, ends)
    return word_hashes(body, starts, stops, lower=True), words


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, _ = _hash_rows(part)
            at, n = np.unique(hashes & np.uint64(BUCKETS - 1), return_counts=True)
            counts[at.astype(np.int64)] += n
    held = np.flatnonzero(counts)
    for k in range(0, len(held), 1 << 16):
        yield pa.record_batch([pa.array(held[k : k + (1 << 16)], pa.int32()), pa.array(counts[held[k : k + (1 << 16)]])], names=["bucket", "n"])


def frequent_words(docs: DataFrame) -> dict[int, int]:
    """Logarithm of the count of each hash bucket of words that holds over four times the mean of all buckets.

    Counts cover all words of all documents. By that bound there are fewer than a quarter as many entries as buckets,
    whatever the input. They only decide the order of shingles, never a result; they are whole numbers (in 1024ths), so
    that a shingle has the same place in that order in every text.
    """
    counts = settle(docs.select("text").mapInArrow(_count_words, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")), "overlap-words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = counts.filter(F.col("n") * F.lit(BUCKETS) > F.lit(4 * total)).collect()
    return {r["bucket"]: int(round(np.log2(r["n"]) * 1024)) for r in rows}


def parity_sketch(keys: np.ndarray) -> bytes:
    """One bit per hash class, set where the class holds an odd number of keys; at least four times as many as keys.

    The XOR of two sketches (folded to the smaller one) has no more bits set than the sets have different members.
    """
    bits = 1 << max(7, int(4 * len(keys) - 1).bit_length())
    flags = np.bincount((mixed(keys) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flags.astype(np.uint8), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def shingle_rows(
    frequent: dict[int, int], width: int, percent: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Size, digest, first shingles in rare-to-frequent order, and parity sketch of every text's shingle set."""
    ids = np.array(sorted(frequent), np.int64)
    logs = np.array([frequent[i] for i in ids.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, words = _hash_rows(part)
                bucket = (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
                at = np.searchsorted(ids, bucket)
                at[at == len(ids)] = 0
                weight = np.where(ids[at] == bucket, logs[at], 0) if len(ids) else np.zeros(len(bucket), np.int64)
                run_ = np.concatenate([[0], np.cumsum(weight)])
                size, node, prefix, sketch = [], [], [], []
                for a, b in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
                    keys = windows_of(hashes[a:b], width)
                    wide = min(width, b - a)
                    common = run_[a + wide : b + 1] - run_[a : b + 1 - wide] if b > a else np.zeros(0, np.int64)
                    keys, first = np.unique(keys, return_index=True)
                    n = len(keys)
                    size.append(n)
                    node.append(hashlib.md5(keys.tobytes()).digest())
                    least = ceil_div(percent * n, 100)
                    order = np.lexsort((keys, common[first]))[: n - least + 1] if n else []
                    prefix.append(keys[order].tobytes() if n else b"")
                    sketch.append(parity_sketch(keys))
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(node, pa.binary()), pa.array(prefix, pa.binary()), pa.array(sketch, pa.binary())],
                    names=["doc_id", "n", "node", "prefix", "sketch"],
                )

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 1000):
            part = batch.slice(k, 1000)
            lists = [np.frombuffer(x, np.int64) for x in part.column("prefix").to_pylist()]
            owner = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
            tokens = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array(tokens), part.column("node").take(owner), part.column("n").take(owner)], names=["token", "node", "n"])


_PAIR, _MEMBER, _TIE = 0, 1, 2
_FOUND = pa.schema([("kind", pa.int32()), ("token", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("na", pa.int64()), ("nb", pa.int64())])
_FOUND_DDL = "kind int, token long, a binary, b binary, na long, nb long"


def _runs(percent: int, short: int, long_: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Read inverted lists in order, holding at most ``long_`` nodes.

    Lists of up to ``short`` nodes give the pairs whose sizes fit. Longer ones are passed on as they are, to be
    compared by sketch. Those over ``long_`` stream through, each node tied to the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, held, first, out = None, [], None, set()

        def close() -> None:
            if first is None and len(held) > short:
                out.update((_MEMBER, token, node, None, n, None) for node, n in held)
            elif first is None:
                for j, (b, nb) in enumerate(held):
                    for a, na in held[:j]:
                        if 100 * na >= percent * nb:
                            out.add((_PAIR, 0, a, b, na, nb) if a < b else (_PAIR, 0, b, a, nb, na))

        def batch_of(rows: set) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND, strict=True)], schema=_FOUND)

        for batch in batches:
            tokens = batch.column("token").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(tokens)) + 1
            bounds = np.concatenate([[0], edges, [len(tokens)]]).astype(int)
            nodes, sizes = batch.column("node"), batch.column("n").to_numpy(zero_copy_only=False)
            last = len(bounds) - 2
            for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                if b == a:
                    continue
                if tokens[a] != token:
                    close()
                    token, held, first = int(tokens[a]), [], None
                    if b - a == 1 and k < last:
                        continue
                for node, n in zip(nodes.slice(a, b - a).to_pylist(), sizes[a:b].tolist(), strict=True):
                    if held and held[-1][0] == node:
                        continue
                    if first is None and len(held) == long_:
                        first = held[0]
                        out.update((_TIE, 0, first[0], other, first[1], m) for other, m in held[1:])
                        held = held[-1:]
                    if first is None:
                        held.append((node, n))
                    else:
                        out.add((_TIE, 0, first[0], node, first[1], n))
                        held = [(node, n)]
                if len(out) > 50_000:
                    yield batch_of(out)
                    out.clear()
        close()
        if out:
            yield batch_of(out)

    return run


def _folded(sketch: bytes, bits: int) -> np.ndarray:
    x = np.frombuffer(sketch, np.uint8)
    while len(x) * 8 > bits:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x.view(np.uint64)


def sketch_forest(nodes: list, sizes: np.ndarray, sketches: list[bytes], percent: int) -> list[tuple]:
    """Edges that connect all nodes of one list, in order of size, whose sketches do not rule a link out."""
    group = np.arange(len(nodes))
    bits = np.array([len(x) * 8 for x in sketches])
    upper = np.searchsorted(sizes, 100 * sizes // percent, "right")
    edges = []
    for width in np.unique(bits):
        rows = np.flatnonzero((bits == width) | (bits == 2 * width))
        table = np.stack([_folded(sketches[r], int(width)) for r in rows])
        for k, i in enumerate(rows.tolist()):
            if bits[i] != width:
                continue
            stop = int(np.searchsorted(rows, upper[i]))
            open_ = k + 1 + np.flatnonzero(group[rows[k + 1 : stop]] != group[i])
            if not len(open_):
                continue
            apart = np.bitwise_count(table[open_] ^ table[k]).sum(axis=1)
            near = rows[open_[(100 + percent) * apart <= (100 - percent) * (sizes[i] + sizes[rows[open_]])]]
            for j in near.tolist():
                if group[j] != group[i]:
                    edges.append((nodes[i], nodes[j]))
                    group[group == group[j]] = group[i]
    return edges


def _forests(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists in order of token and size, compared by sketch within each list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, held, out = None, [], set()

        def close() -> None:
            if len(held) > 1:
                sizes = np.array([n for _, n, _ in held])
                out.update(sketch_forest([x for x, _, _ in held], sizes, [x for _, _, x in held], percent))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("token", "node", "n", "sketch"))
            for t, node, n, sketch in zip(*columns, strict=True):
                if t != token:
                    close()
                    token, held = t, []
                held.append((node, n, sketch))
            yield pa.record_batch([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], names=["a", "b"])
            out.clear()
        close()
        yield pa.record_batch([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return run


def _near(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keep pairs whose sketches differ in no more bits than sets this similar may differ in members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = [x + y for x, y in zip(batch.column("na").to_pylist(), batch.column("nb").to_pylist(), strict=True)]
            keep = [
                (100 + percent) * sketch_distance(x, y) <= (100 - percent) * n
                for x, y, n in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), total, strict=True)
            ]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def divide_skip(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect all sets joined by links, by DivideSkip search of each set among the smaller ones.

    ``side`` is 0, or 1 and 2 where only sets of different sides are to be compared. Candidates that an earlier link
    already connects are left out, so the links form a forest.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[k]) for k in order])
    side = side[order]
    flat = np.concatenate([sets[k] for k in order])
    owner = np.repeat(np.arange(len(order)), size)
    tokens, token = np.unique(flat, return_inverse=True)
    lists = np.sort(token.astype(np.int64) * len(order) + owner)
    starts = np.searchsorted(lists, np.arange(len(tokens) + 1, dtype=np.int64) * len(order))
    length = np.diff(starts)
    ends = np.cumsum(size)
    group = np.arange(len(order))
    links = []
    for q in range(1, len(order)):
        n = int(size[q])
        own = token[ends[q] - n : ends[q]]
        own = own[np.argsort(length[own], kind="stable")]
        least = ceil_div(percent * n, 100)
        lowest = int(np.searchsorted(size, least))
        if lowest >= q:
            continue
        longest = int(length[own[-1]])
        skipped = min(least - 1, int(least / (0.0085 * np.log2(longest + 1) + 1)))
        short, long_ = own[: n - skipped], own[n - skipped :]
        short = short[length[short] > 1]
        total = int(length[short].sum())
        if total == 0:
            continue
        parts = [lists[starts[t] : starts[t + 1]] % len(order) for t in short.tolist()]
        if total <= 512:
            seen, times, last = [], [], -1
            for c in heapq.merge(*(p.tolist() for p in parts)):
                if c == last:
                    times[-1] += 1
                elif lowest <= c < q:
                    seen.append(c)
                    times.append(1)
                    last = c
            found, count = np.array(seen, np.int64), np.array(times, np.int64)
        else:
            found, count = np.unique(np.concatenate(parts), return_counts=True)
            inside = (found >= lowest) & (found < q)
            found, count = found[inside], count[inside]
        need = -(-percent * (n + size[found]) // (100 + percent))
        keep = (count + len(long_) >= need) & (group[found] != group[q])
        if side[q]:
            keep &= side[found] != side[q]
        found, count, need = found[keep], count[keep], need[keep]
        best = np.argsort(-count, kind="stable")
        for k in best.tolist():
            c = int(found[k])
            if group[c] == group[q]:
                continue
            wanted = long_.astype(np.int64) * len(order) + c
            at = np.minimum(np.searchsorted(lists, wanted), len(lists) - 1)
            if int(count[k]) + int((lists[at] == wanted).sum()) >= int(need[k]):
                links.append((int(order[c]), int(order[q])))
                group[group == group[c]] = group[q]
    return links


def _join_block(percent: int, width: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in block["keys"]]
        links = divide_skip(sets, block["side"].to_numpy(), percent)
        nodes = block["node"].tolist()
        return pd.DataFrame({"a": [nodes[i] for i, _ in links], "b": [nodes[j] for _, j in links]}, columns=["a", "b"])

    return run


def _sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, words = _hash_rows(part)
                keys = [np.unique(windows_of(hashes[a:b], width)).tobytes() for a, b in zip(words[:-1], words[1:], strict=True)]
                rest = [c for c in part.schema.names if c != "text"]
                yield pa.record_batch([*(part.column(c) for c in rest), pa.array(keys, pa.binary())], names=[*rest, "keys"])

    return run


def similar_documents(
    docs: DataFrame, width: int = 3, percent: int = 90, short_run: int = SHORT_RUN, long_run: int = LONG_RUN, block: int = BLOCK
) -> DataFrame:
    """Components of documents under Jaccard similarity of word shingles: (doc_id, n_shingles, component_id).

    Words are runs of characters other than ASCII white space, A-Z in lower case; a set holds the distinct runs of
    ``width`` words, or the whole of a shorter text. Sets A and B link when ``100 |A & B| >= percent |A | B|``;
    ``component_id`` is the smallest id reachable. Shingles are compared by 64-bit hashes.

    Inverted lists of up to ``short_run`` documents are paired, those of up to ``long_run`` are compared by sketch in
    one task, longer ones tie all their documents; ``block`` bounds the shingles one task holds of each side. None of
    them changes the result.

    Null and empty texts have no shingles, link with nothing and are their own component. Documents with equal sets
    are one node of the search. A repeated id with different texts is so many documents; a null id can be linked but
    names a component only if all its members are null. Where short lists hold over 512 entries together, DivideSkip
    counts them by sorting instead of merging by a heap, with the same result. An empty table gives an empty result; other columns are
    ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", "text")
    rows = settle(
        texts.mapInArrow(
            shingle_rows(frequent_words(docs), width, percent), f"doc_id {kind}, n long, node binary, prefix binary, sketch binary"
        ),
        "overlap-rows",
    )
    heads = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("head"))
    nodes = rows.filter("n > 0").join(heads, "node").filter(F.col("doc_id").eqNullSafe(F.col("head")))
    runs = (
        nodes.select("prefix", "node", "n")
        .mapInArrow(_entries, "token long, node binary, n long")
        .repartition("token")
        .sortWithinPartitions("token", "n", "node")
        .mapInArrow(_runs(percent, short_run, long_run), _FOUND_DDL)
    )
    found = settle(runs, "overlap-runs")
    sketches = nodes.select("node", "sketch").dropDuplicates(["node"])
    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    pairs = found.filter(F.col("kind") == _PAIR).groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"))
    near = pairs.join(left, "a").join(right, "b").select("na", "nb", "sa", "sb", "a", "b").mapInArrow(_near(percent), "a binary, b binary")
    listed = found.filter(F.col("kind") == _MEMBER).select("token", F.col("a").alias("node"), F.col("na").alias("n")).join(sketches, "node")
    forests = listed.repartition("token").sortWithinPartitions("token", "n", "node").mapInArrow(_forests(percent), "a binary, b binary")
    ties = found.filter(F.col("kind") == _TIE).select("a", "b")
    clusters = settle(components(near.unionAll(forests).unionAll(ties), "overlap-clusters"), "overlap-members")

    members = rows.join(heads, "node").filter(F.col("doc_id").eqNullSafe(F.col("head"))).select("node", "doc_id", "n").distinct()
    members = members.join(clusters, "node").select("node", "doc_id", "n", F.col("root").alias("cluster"))
    members = settle(members, "overlap-heads")
    placed = blocks_of(members, percent, block)
    keyed = texts.join(placed.withColumnRenamed("doc_id", "_head"), texts.doc_id.eqNullSafe(F.col("_head"))).select("node", "parts", "text")
    sized = keyed.mapInArrow(_sets(width), f"node binary, parts {dict(placed.dtypes)['parts']}, keys binary")
    # a repeated id brings several texts to one head; only the text of the node's own set belongs to it
    own = sized.filter(F.unhex(F.md5("keys")) == F.col("node")).dropDuplicates(["node"])
    dealt = own.select("node", "keys", F.explode("parts").alias("p")).select("node", "keys", F.col("p.block").alias("block"), F.col("p.side").alias("side"))
    links = settle(dealt.groupBy("block").applyInPandas(_join_block(percent, width), "a binary, b binary"), "overlap-links")
    roots = components(links, "overlap-roots")
    named = rows.select("doc_id", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = settle(named.select("doc_id", "n", F.when(F.col("n") > 0, F.col("root")).alias("root")), "overlap-named")
    # written, so that the join has nothing but two exchanges below it and Spark can split a component of very many rows
    smallest = settle(named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id")), "overlap-smallest")
    return named.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def blocks_of(members: DataFrame, percent: int, block: int) -> DataFrame:
    """Which blocks a cluster member is compared in: (node, doc_id, parts), parts of (block, side).

    A cluster of up to ``block`` shingles is one block. In a larger one, members are dealt to size classes, so wide
    that sets of classes further apart than one cannot be similar enough, and each class to shares of up to ``block``
    shingles by hash. Every two shares of a class, and of neighbouring classes, make a block of two sides.
    """
    ratio = F.log(F.lit(100.0 / percent))
    whole = members.groupBy("cluster").agg(F.sum("n").alias("all"))
    step = members.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / ratio - 1e-9))
    sizes = step.groupBy("cluster", "class").agg(F.ceil(F.sum("n") / block).alias("shares"))
    near = lambda d, name: sizes.select("cluster", (F.col("class") - d).alias("class"), F.col("shares").alias(name))
    placed = (
        step.join(whole, "cluster")
        .join(sizes, ["cluster", "class"])
        .join(near(-1, "lower"), ["cluster", "class"], "left")
        .join(near(1, "upper"), ["cluster", "class"], "left")
        .withColumn("share", F.pmod(F.xxhash64("node"), F.col("shares")))
    )
    name = lambda c, s, d, t: F.concat_ws(":", F.hex("cluster"), c, s, d, t)
    count = lambda n: F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(n), F.lit(0)) - 1)
    some = lambda n, f: F.when(F.coalesce(F.col(n), F.lit(0)) > 0, F.transform(count(n), f)).otherwise(F.array())
    part = lambda at, side: F.struct(at.alias("block"), side.cast("int").alias("side"))
    own, share = F.col("class"), F.col("share")
    same = F.transform(
        count("shares"),
        lambda s: part(
            name(own, F.least(share, s), own, F.greatest(share, s)), F.when(s == share, 0).when(share < s, 1).otherwise(2)
        ),
    )
    above = some("upper", lambda s: part(name(own, share, own + 1, s), F.lit(1)))
    below = some("lower", lambda s: part(name(own - 1, s, own, share), F.lit(2)))
    parts = F.when(F.col("all") <= block, F.array(part(F.hex("cluster"), F.lit(0)))).otherwise(F.concat(same, above, below))
    return placed.select("node", "doc_id", parts.alias("parts"))
