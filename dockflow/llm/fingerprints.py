"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests, in DataFrame functions only.

A text is cut into paragraphs: sentences, lines, or 200 characters where neither ends sooner. The distinct 64-bit
digests of its paragraphs go into a sketch of cells (count, XOR of digests, XOR of checksums), each digest into one
cell of each of three parts. Two sketches subtract cell by cell; what both texts share cancels, and peeling recovers
the digests that differ: a cell left with one digest names it, the digest is taken out of its other cells, and so on.
Where peeling gets stuck the sketch is built again larger: digests are dealt to blocks by their leading bits, about
five to a block, and each block has a small sketch that doubles, with new cells for every digest, until it peels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.common import let
from dockflow.llm.ordering import blocks

PARAGRAPH = r"(?s).{1,200}?(?:[.!?]+\s|\n|\z)|.{1,200}"
BASE_CELLS = 24
BLOCK_CELLS = (12, 24, 48, 96, 192, 384, 768)
RECOVERED = "array<struct<k:bigint,n:int>>"
_LOWEST = -(2**63)


def digests(text: Column) -> Column:
    """Distinct digests of a text's paragraphs; none for an empty text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.xxhash64(p)))


def _cells_of(key: Column, n: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(100 * n + j)), F.lit(n // 3)) + j * (n // 3) for j in range(3)]


def _cell(n: Column, k: Column, c: Column) -> Column:
    return F.struct(n.alias("n"), k.alias("k"), c.alias("c"))


def _build(signed: Column, n: int) -> Column:
    """Cells of an array of (k, s): digests with the sign they count by."""
    placed = F.transform(
        signed, lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), F.hash(x["k"]).alias("c"), F.array(*_cells_of(x["k"], n)).alias("at"))
    )
    zero = _cell(F.lit(0), F.lit(0).cast("long"), F.lit(0))

    def cells(items: Column, part: int) -> Column:
        def cell(i: Column) -> Column:
            return F.aggregate(
                items,
                zero,
                lambda a, x: F.when(
                    F.get(x["at"], F.lit(part)) == i,
                    _cell(a["n"] + x["s"], a["k"].bitwiseXOR(x["k"]), a["c"].bitwiseXOR(x["c"])),
                ).otherwise(a),
            )

        return F.transform(F.sequence(F.lit(part * (n // 3)).cast("long"), F.lit((part + 1) * (n // 3) - 1).cast("long")), cell)

    return let(placed, lambda items: F.concat(*(cells(items, part) for part in range(3))))


def sketch(keys: Column, n: int = BASE_CELLS) -> Column:
    """The sketch of an array of digests."""
    return _build(F.transform(keys, lambda k: F.struct(k.alias("k"), F.lit(1).alias("s"))), n)


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: _cell(a["n"] - b["n"], a["k"].bitwiseXOR(b["k"]), a["c"].bitwiseXOR(b["c"])))


def peeled(cells: Column, n: int, steps: Column) -> Column:
    """The digests that peeling recovers, as (k, n) with the sign of their side, or null where it gets stuck."""

    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (F.hash(c["k"]) == c["c"]))
        return let(
            F.get(pure, F.lit(0)),
            lambda one: F.when(one.isNull(), state).otherwise(
                F.struct(
                    let(
                        F.array(*_cells_of(one["k"], n)),
                        lambda at: F.transform(
                            state["cells"],
                            lambda c, i: F.when(
                                F.array_contains(at, i.cast("long")),
                                _cell(c["n"] - one["n"], c["k"].bitwiseXOR(one["k"]), c["c"].bitwiseXOR(one["c"])),
                            ).otherwise(c),
                        ),
                    ).alias("cells"),
                    F.concat(state["found"], F.array(F.struct(one["k"].alias("k"), one["n"].alias("n")))).alias("found"),
                )
            ),
        )

    def finish(state: Column) -> Column:
        left = F.exists(state["cells"], lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["c"] != 0))
        return F.when(~left, state["found"])

    start = F.struct(cells.alias("cells"), F.array().cast(RECOVERED).alias("found"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), start, step, finish)


def difference(left: Column, right: Column, left_cells: Column, right_cells: Column) -> Column:
    """Number of digests that only one of two texts has."""
    return F.size(recovered_digests(left, right, left_cells, right_cells))


def recovered_digests(left: Column, right: Column, left_cells: Column, right_cells: Column) -> Column:
    """The digests that only one of two texts has, by peeling their subtracted sketches: (k, n), n is 1 on the left.

    A block that even 768 cells do not peel, for about five digests, stops the run: equal 96-bit keys would be needed.
    """
    signed = F.array_sort(
        F.concat(
            F.transform(left, lambda k: F.struct(k.alias("k"), F.lit(1).alias("s"))),
            F.transform(right, lambda k: F.struct(k.alias("k"), F.lit(-1).alias("s"))),
        )
    )

    def by_block(all_: Column) -> Column:
        bits = F.greatest(F.length(F.bin((F.size(all_) / 5).cast("long"))) , F.lit(1))
        block = lambda i: F.call_function("shiftright", F.get(all_, i)["k"], 64 - bits)
        starts = F.filter(
            F.sequence(F.lit(0), F.size(all_) - 1), lambda i: (i == 0) | (block(i) != block(F.greatest(i - 1, F.lit(0))))
        )
        found = let(
            starts,
            lambda s: F.transform(
                s,
                lambda i, j: let(
                    F.slice(all_, i + 1, F.coalesce(F.get(s, j + 1), F.size(all_)) - i),
                    lambda items: F.coalesce(
                        *(peeled(_build(items, n), n, F.size(items)) for n in BLOCK_CELLS),
                        F.raise_error(F.lit("a block of paragraph digests does not peel")).cast(RECOVERED),
                    ),
                ),
            ),
        )
        return F.flatten(found)

    whole = peeled(subtract(left_cells, right_cells), BASE_CELLS, F.lit(BASE_CELLS))
    nothing = F.array().cast(RECOVERED)
    return F.coalesce(whole, F.when(F.size(left) + F.size(right) == 0, nothing).otherwise(let(signed, by_block)))


def likeness(left: Column, right: Column, recovered: Column) -> Column:
    """Shared share of all distinct paragraphs of two texts; 1 for two empty ones."""
    total, differ = F.size(left) + F.size(right), F.size(recovered)
    return F.when(total == 0, F.lit(1.0)).otherwise((total - differ) / (total + differ))


def as_text(cells: Column) -> Column:
    """A sketch as text: count, digest and checksum of each cell in hexadecimal."""
    two = lambda c: F.lpad(F.hex(c["n"].cast("long").bitwiseAND(F.lit(255))), 2, "0")
    eight = lambda c: F.lpad(F.hex(c["c"].cast("long").bitwiseAND(F.lit(2**32 - 1))), 8, "0")
    return F.array_join(F.transform(cells, lambda c: F.concat(two(c), F.lpad(F.hex(c["k"]), 16, "0"), eight(c))), "")


def of_side(recovered: Column, sign: int) -> Column:
    """The recovered digests of one side in hexadecimal, sorted, comma-joined."""
    mine = F.transform(F.filter(recovered, lambda x: x["n"] == sign), lambda x: F.lpad(F.hex(x["k"]), 16, "0"))
    return F.array_join(F.sort_array(mine), ",")


def followers(ids: DataFrame) -> DataFrame:
    """For each key, the key before it in descending order and that key's ``third``; the last comes before the first.

    ``ids`` has (key, third). Keys are cut into ranges and written; a range needs only the last key of the one before.
    """
    cut = blocks(ids.groupBy("key").agg(F.max("third").alias("third")), [F.col("key").desc()], "fingerprint-order")
    here = F.struct("key", "third")
    within = Window.partitionBy("_block").orderBy(F.col("key").desc())
    over_blocks = Window.orderBy("_block")
    ends = cut.groupBy("_block").agg(F.min(here).alias("end"))
    ends = ends.select("_block", F.coalesce(F.lag("end").over(over_blocks), F.min("end").over(Window.partitionBy())).alias("from_block"))
    placed = cut.withColumn("inside", F.lag(here).over(within)).join(ends, "_block")
    before = F.coalesce("inside", "from_block")
    return placed.select("key", before["key"].alias("before"), before["third"].alias("before_third"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Sketch every text and its edited text, and compare them by subtraction and peeling.

    The edited text of a document has its last third (rounded down) replaced by as many leading characters of the
    next document in descending id. Result: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, removed, added), one row per input row; the last two are the paragraph digests that
    peeling recovered, of the text and of its edited version.

    A null text is empty; two empty texts are alike (1.0). A null id comes after all others. Where rows repeat an
    id, they share their next document, and the one before takes its text from the row with the smallest start of
    it. An empty table gives an empty result; other columns are ignored.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("key"), body.alias("body"))
    # made before the texts move, so a document's digests and sketch serve it and the document before it
    base = base.withColumn("keys", digests(F.col("body")))
    base = base.withColumn("cells", sketch(F.col("keys")))
    order = followers(base.select("key", F.floor(F.length("body") / 3).cast("int").alias("third")))
    placed = base.join(order, "key")
    following = (
        placed.select(
            F.col("before").alias("key"),
            # the id is carried so that both sides read the same columns and share one exchange of the texts
            F.struct(F.expr("substring(body, 1, before_third)").alias("head"), "keys", "cells", "doc_id").alias("next"),
        )
        .groupBy("key")
        .agg(F.min("next").alias("next"))
    )
    n = F.length("body")
    edited = F.concat(F.expr("substring(body, 1, n_chars - third)"), F.expr("substring(next.head, 1, third)"))
    texts = (
        placed.join(following, "key")
        .select("doc_id", "body", "keys", "cells", "next", n.cast("long").alias("n_chars"), F.floor(n / 3).alias("third"))
        .withColumn("third", F.col("third").cast("int"))
        .withColumn("n_chars", F.col("n_chars").cast("int"))
        .withColumn("edited", edited)
    )
    keyed = texts.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("keys").alias("own"),
        digests(F.col("edited")).alias("other"),
        F.col("next.keys").alias("following"),
        F.col("cells").alias("own_cells"),
        F.col("next.cells").alias("next_cells"),
    )
    sketched = keyed.select("*", sketch(F.col("other")).alias("other_cells"))
    compared = sketched.select(
        "*",
        recovered_digests(F.col("own"), F.col("other"), F.col("own_cells"), F.col("other_cells")).alias("differ_edited"),
        recovered_digests(F.col("own"), F.col("following"), F.col("own_cells"), F.col("next_cells")).alias("differ_next"),
    )
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own_cells")).alias("fingerprint"),
        as_text(F.col("other_cells")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), F.col("differ_edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), F.col("differ_next")).alias("near_next"),
        of_side(F.col("differ_edited"), 1).alias("removed"),
        of_side(F.col("differ_edited"), -1).alias("added"),
    )
