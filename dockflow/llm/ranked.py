"""Ranked search: the best documents of each item, from K2-treaps over the grid of terms and documents."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.common import settle, slices
from dockflow.llm.terms import hashed_terms

_BELOW = np.array([bin(mask & (1 << q) - 1).count("1") for mask in range(16) for q in range(4)], np.int64)
_TILE = "docs array<{kind}>, n binary, held binary, rows binary, times binary, full long, words long"


@dataclass(frozen=True)
class Treap:
    """A quadtree over a grid of ``1 << height`` rows and columns that keeps non-empty cells only.

    ``mask`` has a bit for each quarter of a cell that holds anything, ``first`` counts the quarters before it (the
    place of its first one), and ``most`` is the largest impact in the cell. Cell 0 is empty, cell 1 the whole grid;
    a cell's quarters are numbered upper left, upper right, lower left, lower right (rows are terms).
    """

    height: int
    mask: np.ndarray
    first: np.ndarray
    most: np.ndarray


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of a number moved to the even places."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(keep)
    return x


def treap(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> Treap:
    """The K2-treap of grid points: points in Z order, then from the single cells up, one level at a time."""
    height = max(1, int(max(rows.max(initial=0), columns.max(initial=0))).bit_length())
    place = _spread(rows) << np.uint64(1) | _spread(columns)
    order = np.argsort(place)
    place, most = place[order], impacts[order]
    levels = [(np.zeros(len(place), np.uint8), most)]
    for _ in range(height):
        quarter = (place & np.uint64(3)).astype(np.uint8)
        place = place >> np.uint64(2)
        heads = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, np.int64)
        mask = np.bitwise_or.reduceat(np.uint8(1) << quarter, heads) if len(place) else np.zeros(0, np.uint8)
        most = np.maximum.reduceat(most, heads) if len(place) else most
        place = place[heads]
        levels.append((mask, most))
    mask = np.concatenate([np.zeros(1, np.uint8), *(m for m, _ in reversed(levels))])
    most = np.concatenate([np.zeros(1, np.int64), *(v for _, v in reversed(levels))])
    held = _BELOW[mask.astype(np.int64) * 4 + 3] + (mask >> 3 & 1)
    first = 2 + np.cumsum(held) - held
    return Treap(height, mask.astype(np.int64), first, most)


def search(tree: Treap, rows: np.ndarray, times: np.ndarray, k: int, least: int = 1, batch: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores of the ``k`` best columns for some rows and all that tie with the last; scores below ``least`` are left out.

    A range of columns is met by one cell for each row; the sum of their largest impacts bounds every column inside.
    Ranges are taken best first, ``batch`` at a time, and halved, all rows' cells descending together, until the
    best bound left is below the k-th score found.
    """
    height = tree.height
    root = 1 if len(tree.mask) > 1 else 0
    cells = np.full((1, len(rows)), root, np.int64)
    column, level, bound = np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([tree.most[root] * times.sum()])
    found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    while True:
        stays = bound >= least
        if not stays.any():
            return found, scores
        if not stays.all():
            cells, column, level, bound = cells[stays], column[stays], level[stays], bound[stays]
        if len(bound) > batch:
            order = np.argpartition(bound, len(bound) - batch)
            rest, now = order[:-batch], order[-batch:]
        else:
            rest, now = np.zeros(0, np.int64), np.arange(len(bound))
        down = (rows[None, :] >> (height - 1 - level[now])[:, None] & 1) * 2
        mask, first = tree.mask[cells[now]], tree.first[cells[now]]
        halves = [(cells[rest], column[rest], level[rest], bound[rest])]
        for side in (0, 1):
            quarter = down + side
            child = np.where(mask >> quarter & 1, first + _BELOW[mask * 4 + quarter], 0)
            upto = tree.most[child] @ times
            good = np.flatnonzero(upto >= least)
            halves.append((child[good], column[now][good] * 2 + side, level[now][good] + 1, upto[good]))
        cells, column, level, bound = (np.concatenate(x) for x in zip(*halves, strict=True))
        leaf = level == height
        if leaf.any():
            found, scores = np.concatenate([found, column[leaf]]), np.concatenate([scores, bound[leaf]])
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                found, scores = found[scores >= least], scores[scores >= least]
            cells, column, level, bound = cells[~leaf], column[~leaf], level[~leaf], bound[~leaf]


def _postings(vocabulary: np.ndarray, columns: int, kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tiles of up to ``columns`` documents: ids, terms of each, and how often each holds which words of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def made() -> pa.RecordBatch:
            ids, n, held, rows, times = zip(*waiting, strict=True)
            n = np.concatenate(n)
            cells = [pa.array([x.tobytes()], pa.binary()) for x in (n, *(np.concatenate(c).astype(np.int32) for c in (held, rows, times)))]
            docs = pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(kind))
            sums = [pa.array([int(x)], pa.int64()) for x in ((n > 0).sum(), n.sum())]
            return pa.record_batch([docs, *cells, *sums], names=["docs", "n", "held", "rows", "times", "full", "words"])

        for batch in batches:
            for part in slices(batch, "text"):
                hashes, offsets = hashed_terms(part.column("text"))
                row = np.searchsorted(vocabulary, hashes)
                row[row == len(vocabulary)] = 0
                known = np.flatnonzero(vocabulary[row] == hashes) if len(vocabulary) else np.zeros(0, np.int64)
                doc = np.searchsorted(offsets, known, "right") - 1
                pairs, times = np.unique(doc * len(vocabulary) + row[known], return_counts=True)
                held = np.bincount(pairs // max(1, len(vocabulary)), minlength=part.num_rows)
                edges = np.concatenate([[0], np.cumsum(held)])
                at = 0
                while at < part.num_rows:
                    free = columns - sum(len(w[1]) for w in waiting)
                    stop = min(part.num_rows, at + free)
                    inside = slice(edges[at], edges[stop])
                    waiting.append((part.column("doc_id").slice(at, stop - at), np.diff(offsets[at : stop + 1]), held[at:stop], pairs[inside] % len(vocabulary) if len(vocabulary) else pairs[inside], times[inside]))
                    if stop - at == free:
                        yield made()
                        waiting = []
                    at = stop
        if waiting:
            yield made()

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, df) of the terms of each tile."""
    for batch in batches:
        rows = np.concatenate([np.frombuffer(x, np.int32) for x in batch.column("rows").to_pylist()] or [np.zeros(0, np.int32)])
        row, df = np.unique(rows, return_counts=True)
        yield pa.record_batch([pa.array(row, pa.int32()), pa.array(df, pa.int64())], names=["row", "df"])


@dataclass(frozen=True)
class Queries:
    """A block of items: rows in the vocabulary and repeats of each item's terms, term weights, and corpus sizes."""

    ids: pa.Array
    terms: list[tuple[np.ndarray, np.ndarray]]
    weights: np.ndarray
    documents: int
    words: int


def impacts(weights: np.ndarray, times: np.ndarray, n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """What a term that occurs so often in a document of ``n`` terms adds to its score; fixed values of the ranking."""
    m = 100 - 25 + 25 * n * documents // words
    return weights * (1_000_000_000 * times // (1000 * times + 12 * m))


def _ranked(queries: Queries, k: int, kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, list]] = [(np.zeros(0, np.int64), []) for _ in queries.terms]
        for batch in batches:
            for tile in batch.to_pylist():
                n = np.frombuffer(tile["n"], np.int64)
                held, rows, times = (np.frombuffer(tile[c], np.int32).astype(np.int64) for c in ("held", "rows", "times"))
                if len(rows) == 0:
                    continue
                # documents of like length side by side: their impacts are alike, which makes the bounds of ranges tight
                order = np.argsort(n, kind="stable")
                column = np.empty(len(n), np.int64)
                column[order] = np.arange(len(n))
                doc = np.repeat(np.arange(len(n)), held)
                tree = treap(rows, column[doc], impacts(queries.weights[rows], times, n[doc], queries.documents, queries.words))
                for i, (wanted, repeats) in enumerate(queries.terms):
                    scores, docs = best[i]
                    least = int(scores.min()) if len(scores) >= k else 1
                    found, new = search(tree, wanted, repeats, k, least)
                    if len(found):
                        best[i] = _first(np.concatenate([scores, new]), docs + [tile["docs"][order[c]] for c in found], k)
        filled = [i for i, (_, docs) in enumerate(best) if docs]
        if filled:
            which = np.repeat(filled, [len(best[i][1]) for i in filled])
            yield pa.record_batch(
                [
                    pa.array(which, pa.int64()),
                    queries.ids.take(pa.array(which, pa.int64())),
                    pa.array([d for i in filled for d in best[i][1]], kind),
                    pa.array(np.concatenate([best[i][0] for i in filled]), pa.int64()),
                ],
                names=["item", "item_id", "doc_id", "score"],
            )

    return run


def _first(scores: np.ndarray, docs: list, k: int) -> tuple[np.ndarray, list]:
    """The ``k`` highest scores, equal ones by document, null first."""
    order = sorted(range(len(docs)), key=lambda j: (-scores[j], docs[j] is not None, docs[j]))[:k]
    return scores[order], [docs[j] for j in order]


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, offsets = hashed_terms(part.column("text"))
            terms = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes.view(np.int64), pa.int64()))
            yield pa.record_batch([part.column("item_id"), terms], names=["item_id", "terms"])


def best_documents(docs: DataFrame, items: DataFrame, k: int = 20, columns: int = 4096, block: int = 1 << 18) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: (item_id, rank, doc_id, score).

    Terms, weights and scores are those of ``impacts``, summed over the item's terms with repeats; documents with a
    score of 0 are not listed, equal scores are ordered by ``doc_id``. Corpus statistics cover all documents.

    Items are the stated queries; they are taken in blocks of about ``block`` terms, whose vocabulary and
    weights go to every task. One pass over the texts writes, for tiles of up to ``columns`` documents, how often each
    holds which terms of the block (every occurrence, however frequent the term). A second pass over the tiles makes
    a K2-treap of impacts of each tile and searches it for every item, each starting from the k-th score that its task
    has found so far; a task returns at most ``k`` documents per item.

    A null or empty text has no terms; a null ``doc_id`` sorts first; rows that repeat a document are documents of
    their own, and rows that repeat an item are items of their own. A text of any length is read whole. Without
    documents, items or common terms the result is empty. Other columns are ignored. Terms are equal by 64-bit hash.
    """
    spark = docs.sparkSession
    id_kind, doc_kind = dict(items.dtypes)["item_id"], dict(docs.dtypes)["doc_id"]
    asked = settle(items.select("item_id", "text").mapInArrow(_item_terms, f"item_id {id_kind}, terms array<long>").filter(F.size("terms") > 0), "search-items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // block))
    results = []
    for b in range(blocks):
        found = _block(docs, asked.filter(F.pmod(F.hash("item_id", "terms"), F.lit(blocks)) == b), k, columns, id_kind, doc_kind)
        if found is not None:
            results.append(found)
    if not results:
        return spark.createDataFrame([], f"item_id {id_kind}, rank int, doc_id {doc_kind}, score long")
    whole = results[0]
    for other in results[1:]:
        whole = whole.unionAll(other)
    return whole


def _block(docs: DataFrame, asked: DataFrame, k: int, columns: int, id_kind: str, doc_kind: str) -> DataFrame | None:
    from pyspark.sql.pandas.types import to_arrow_type

    held = asked.toArrow()
    if held.num_rows == 0:
        return None
    terms = [np.unique(np.array(x, np.int64).view(np.uint64), return_counts=True) for x in held.column("terms").to_pylist()]
    vocabulary = np.unique(np.concatenate([t for t, _ in terms]))
    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    tiles = settle(docs.select("doc_id", "text").mapInArrow(_postings(vocabulary, columns, kind), _TILE.format(kind=doc_kind)), "search-tiles")
    sizes = tiles.agg(F.sum("full").alias("documents"), F.sum("words").alias("words")).first()
    if not sizes["documents"]:
        return None
    counts = tiles.select("rows").mapInArrow(_frequencies, "row int, df long").groupBy("row").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(vocabulary), np.int64)
    df[counts.column("row").to_numpy()] = counts.column("df").to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * sizes["documents"] + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    wanted = [(np.searchsorted(vocabulary, t), times.astype(np.int64)) for t, times in terms]
    queries = Queries(held.column("item_id").combine_chunks(), wanted, weights, sizes["documents"], sizes["words"])
    found = tiles.drop("full", "words").mapInArrow(_ranked(queries, k, kind), f"item long, item_id {id_kind}, doc_id {doc_kind}, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id")))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
