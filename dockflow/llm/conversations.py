"""Repair the turns of conversations with the cheapest edits, found by depth-first branch-and-bound."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import settle

# What edits cost, and the order that roles must have, `(s?(ua)+)?` over role initials.
DELETE, REROLE, INSERT, CUT_SHORT = 2, 1, 5, 5
_SPACES = " \t\n\x0b\x0c\r"
_LEGAL = ("su", "ua", "au")
#: States of the order: nothing yet, after s, after u, after a. A conversation may end in the first or the last one.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_WANTED = "uuau"
_ENDS = (0, 3)
_REACHED = ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))
#: Rows of one search. A longer conversation is searched in blocks, from every state to every state.
BLOCK_BITS = 6
_kept: dict[str, list[list[tuple[int, str] | None]]] = {}


def damaged(conversations: DataFrame) -> DataFrame:
    """Break rows by the CRC of ``conv_id:turn``: lost, emptied, cut short, repeated or given the user's role.

    A null id, turn, role or text counts as one space; a null turn stays null in its column.
    """
    space = lambda c: F.coalesce(c, F.lit(" "))
    kind = F.crc32(F.concat(space(F.col("conv_id").cast("string")), F.lit(":"), space(F.col("turn").cast("string")))) % 20
    role, text = space(F.col("role")), space(F.col("text"))
    return (
        conversations.select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("_times"),
        )
        .withColumn("_time", F.explode(F.array_repeat(F.lit(0), F.col("_times"))))
        .drop("_time", "_times")
    )


def in_order(turns: DataFrame) -> DataFrame:
    """Rows with a number ``at`` that grows by conversation and turn, consecutive within a file of the result.

    Null turns come first; rows with equal turns are ordered by role and text. The table is cut into ranges, so a
    conversation with very many rows spans many tasks. Written once, which fixes the numbers.
    """
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = turns.select("conv_id", "turn", space("role"), space("text"))
    return settle(
        rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .withColumn("at", F.monotonically_increasing_id()),
        "turns-in-order",
    )


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, at, initial, fault) of every row of ``in_order``; the fault is blank, duplicate, truncated or null.

    The first row of equal role and text is found by an aggregate, so a row that repeats very often is not gathered.
    """
    body = F.rtrim(F.col("text"), F.lit(_SPACES))
    seen = rows.select(
        "conv_id",
        "turn",
        "at",
        "role",
        F.substring("role", 1, 1).alias("initial"),
        (body == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )
    firsts = seen.filter("not blank").groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("truncated"), "truncated")
    return seen.join(firsts, "at", "left").select("conv_id", "turn", "at", "initial", fault.alias("fault"))


def suffix_bounds(symbols: str) -> list[int]:
    """A lower bound of what the rows from each place on cost, whatever came before them.

    A row that must go or was cut short costs two at least. Between the others, every pair of neighbours that cannot
    stand side by side needs an edit of one of the two or a row between them, and one edit settles two pairs at most.
    """
    bounds = [0] * (len(symbols) + 1)
    fixed = clashes = 0
    after = ""
    for i in range(len(symbols) - 1, -1, -1):
        c = symbols[i]
        if c == "_" or c.isupper():
            fixed += 2
        else:
            clashes += after != "" and c + after not in _LEGAL
            after = c
        bounds[i] = fixed + (clashes + 1) // 2
    return bounds


def search(symbols: str, entry: int) -> list[tuple[int, str] | None]:
    """The cheapest edits of a block of rows from a state, as (cost, audit) for each state after it; ties ASCII-least.

    A symbol is a row: its role's initial (s, u, a, or x for others), a capital where the text was cut short, and ``_``
    where it must be deleted. The search goes depth first with an explicit stack, cheapest edit first. A prefix is
    dropped when the table of its place and state has a cheaper one or an equal one with a smaller audit (both can be
    completed alike, and neither audit begins with the other), or when its cost and the bound of the rest exceed
    the best known result of every state it can still reach. The stack runs empty only when no better one is left.
    """
    n, bounds = len(symbols), suffix_bounds(symbols)
    best: list[tuple[int, str] | None] = [None] * 4
    table: dict[tuple[int, int], tuple[int, str]] = {(0, entry): (0, "")}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if table[i, state] < (cost, audit):
            continue
        least = cost + bounds[i]
        if not any(best[q] is None or least < best[q][0] or least == best[q][0] and audit <= best[q][1][: len(audit)] for q in _REACHED[state]):
            continue
        moves = [(cost + INSERT, i, _NEXT[state][_WANTED[state]], "I")]
        if i == n:
            if best[state] is None or (cost, audit) < best[state]:
                best[state] = (cost, audit)
        else:
            c = symbols[i]
            moves.append((cost + DELETE, i + 1, state, "D"))
            if c != "_":
                initial, short = c.lower(), CUT_SHORT if c.isupper() else 0
                if initial in _NEXT[state]:
                    moves.append((cost + short, i + 1, _NEXT[state][initial], "K"))
                if initial != _WANTED[state]:
                    moves.append((cost + short + REROLE, i + 1, _NEXT[state][_WANTED[state]], "R"))
        moves.sort(reverse=True)
        for spent, j, to, edit in moves:
            value = (spent, audit + edit)
            if (j, to) not in table or value < table[j, to]:
                table[j, to] = value
                stack.append((j, to, *value))
    return best


def searched(symbols: str) -> list[list[tuple[int, str] | None]]:
    """``search`` from every state; results of short blocks, which recur, are kept in a bounded table per process."""
    if symbols not in _kept:
        if len(_kept) >= 1 << 16:
            _kept.clear()
        found = [search(symbols, q) for q in range(4)]
        if len(symbols) > 16:
            return found
        _kept[symbols] = found
    return _kept[symbols]


def _search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        found = [
            [None if x is None else {"cost": x[0], "audit": x[1]} for row in searched(s) for x in row] for s in batch.column("symbols").to_pylist()
        ]
        yield pa.record_batch([*(batch.column(c) for c in ("conv_id", "block", "initials")), pa.array(found, kind)], names=["conv_id", "block", "initials", "found"])


class _Chain:
    """The best edits of a conversation so far, for each state; what all states begin with is kept once."""

    def __init__(self) -> None:
        self.head: list[str] = []
        self.best: dict[int, tuple[int, str]] = {0: (0, "")}
        self.illegal, self.last = 0, ""

    def add(self, initials: str, found: list[dict | None]) -> None:
        pairs = self.last + initials
        self.illegal += sum(pairs[k : k + 2] not in _LEGAL for k in range(len(pairs) - 1))
        self.last = initials[-1:]
        after: dict[int, tuple[int, str]] = {}
        for state, (cost, tail) in self.best.items():
            for to in range(4):
                step = found[4 * state + to]
                if step is not None:
                    value = (cost + step["cost"], tail + step["audit"])
                    if to not in after or value < after[to]:
                        after[to] = value
        shared = os.path.commonprefix([tail for _, tail in after.values()])
        self.head.append(shared)
        self.best = {q: (cost, tail[len(shared) :]) for q, (cost, tail) in after.items()}

    def result(self) -> tuple[int, str, int]:
        cost, tail = min(self.best[q] for q in _ENDS if q in self.best)
        return cost, "".join(self.head) + tail, self.illegal


def _chained(kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(conv_id, cost, audit, illegal) from blocks sorted by conversation; blocks stream past one chain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chain, done = None, None, []

        def made() -> pa.RecordBatch:
            ids, costs, audits, illegal = zip(*done, strict=True)
            return pa.record_batch([pa.array(ids, kind), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(illegal, pa.int64())], names=["conv_id", "cost", "audit", "illegal"])

        for batch in batches:
            ids, initials, found = (batch.column(c).to_pylist() for c in ("conv_id", "initials", "found"))
            for conv, letters, steps in zip(ids, initials, found, strict=True):
                if chain is None or conv != now:
                    if chain is not None:
                        done.append((now, *chain.result()))
                    now, chain = conv, _Chain()
                chain.add(letters, steps)
            if done:
                yield made()
                done = []
        if chain is not None:
            done.append((now, *chain.result()))
            yield made()

    return run


def cheapest_edits(marked: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, illegal) of every conversation in the rows of ``faults``.

    Blocks of consecutive rows are searched on their own, wherever they lie; a second step strings the blocks of a
    conversation together, state by state. An audit has one letter per row and insertion, the length of its result.
    Blocks are dealt to the session's full number of shuffle partitions: they are small, but searching them takes time.
    """
    wide = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "_").when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    row = F.struct("at", symbol.alias("symbol"), letter.alias("letter"))
    text = lambda name: F.array_join(F.transform("rows", lambda r: r[name]), "")
    blocks = (
        marked.withColumn("block", F.shiftright("at", BLOCK_BITS))
        .repartition(wide, "conv_id", "block")
        .groupBy("conv_id", "block")
        .agg(F.sort_array(F.collect_list(row)).alias("rows"))
        .select("conv_id", "block", text("symbol").alias("symbols"), text("letter").alias("initials"))
    )
    kind = marked.schema["conv_id"].dataType.simpleString()
    found = blocks.mapInArrow(_search_blocks, f"conv_id {kind}, block long, initials string, found array<struct<cost:long,audit:string>>")
    return (
        found.repartition("conv_id")
        .sortWithinPartitions("conv_id", "block")
        .mapInArrow(_chained(_arrow(marked)), f"conv_id {kind}, cost long, audit string, illegal long")
    )


def _arrow(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["conv_id"].dataType)


def _edited(kind: pa.DataType, digests: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Apply audits to rows that stream past sorted by conversation, the audit before the rows of its conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = object()
        audit, place, state, number, digest = "", 0, 0, 0, None
        out: list[tuple] = []

        def line(edit: str, role: str, text: str) -> None:
            nonlocal number
            if digests:
                digest.update((f"\n{role}:{text}" if number else f"{role}:{text}").encode())
            else:
                out.append((now, number, role, text, edit))
            number += 1

        def insert() -> None:
            nonlocal place, state
            while place < len(audit) and audit[place] == "I":
                line("I", "user" if _WANTED[state] == "u" else "assistant", "")
                state = _NEXT[state][_WANTED[state]]
                place += 1

        def close() -> None:
            insert()
            if digests and digest is not None:
                out.append((now, digest.hexdigest(), number))

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            kinds = [kind, pa.string(), pa.int64()] if digests else [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            names = ["conv_id", "repaired_sha256", "repaired_rows"] if digests else ["conv_id", "number", "role", "text", "edit"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        started = False
        for batch in batches:
            for conv, role, text, edits in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit")), strict=True):
                if edits is not None:
                    if started:
                        close()
                    started = True
                    now, audit, place, state, number = conv, edits, 0, 0, 0
                    digest = hashlib.sha256() if digests else None
                    continue
                insert()
                edit = audit[place]
                place += 1
                if edit == "K":
                    state = _NEXT[state][role[:1]]
                    line("K", role, text)
                elif edit == "R":
                    line("R", "user" if _WANTED[state] == "u" else "assistant", text)
                    state = _NEXT[state][_WANTED[state]]
            if out:
                yield made()
                out = []
        if started:
            close()
        if out:
            yield made()

    return run


def _apply(rows: DataFrame, edits: DataFrame, digests: bool, schema: str) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    tagged = rows.select("conv_id", "at", "role", "text", F.lit(None).cast("string").alias("audit")).unionByName(
        edits.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit")
    )
    return tagged.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_edited(_arrow(rows), digests), f"conv_id {kind}, {schema}")


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired rows: (conv_id, number, role, text, edit), numbered from 0; ``edit`` is K, R or I.

    See ``repair_report`` for the rules and for nulls, ties and empty tables.
    """
    rows = in_order(turns)
    return _apply(rows, settle(cheapest_edits(faults(rows)), "conversation-edits"), False, "number long, role string, text string, edit string")


def repair_report(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired rows, per conversation.

    Returns (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, repaired_rows); ``ids``
    names conversations that must appear even without rows (zeros, an empty audit, the digest of nothing).

    Rows whose text is blank or whose role and text came before must go (2); a row may get another role (1); an empty
    row may be put in (5); a row that ends without a closing mark and stays costs 5. What is left must have roles that
    begin with s, if at all, and then alternate u and a, ending with a. A null id is a conversation of its own; null
    turns come first and count in no gap; null roles and texts are one space. Rows with equal turns are ordered by
    role and text, repeated rows are duplicates. A role that is empty or begins otherwise cannot stay. An empty table
    gives an empty result, other columns are ignored, and long texts are only hashed and compared by digest.

    A conversation of any length is numbered, checked and searched in blocks over many tasks. Its audit and the digest
    of its repaired text are single values, so its blocks and then its rows stream past one task that holds one row.
    """
    rows = in_order(turns)
    marked = settle(faults(rows), "turn-faults")
    edits = settle(cheapest_edits(marked), "conversation-edits")
    kinds = ("blank", "duplicate", "truncated")
    per_turn = marked.groupBy("conv_id", "turn").agg(*(F.count_if(F.col("fault") == k).alias(k) for k in kinds))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counts = per_turn.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *(F.sum(k).alias(k) for k in kinds))
    digests = _apply(rows, edits, True, "repaired_sha256 string, repaired_rows long")
    parts = counts.unionByName(edits, allowMissingColumns=True).unionByName(digests, allowMissingColumns=True)
    if ids is not None:
        parts = parts.unionByName(ids.select("conv_id").distinct(), allowMissingColumns=True)
    whole = lambda c: F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c)
    text = lambda c, none: F.coalesce(F.max(c), F.lit(none)).alias(c)
    return parts.groupBy("conv_id").agg(
        *(whole(c) for c in ("gaps", *kinds, "illegal", "cost")),
        text("audit", ""),
        text("repaired_sha256", hashlib.sha256().hexdigest()),
        whole("repaired_rows"),
    )
