"""Mix sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import WORD, settle
from dockflow.llm.ordering import running


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Target of each source. ``sizes`` has (source, size); result: (source, no_source, source_size, target, rank).

    Sources in code-point order, null last, weigh ``cycle`` again and again and share the total size. A target stops
    at ``most`` times its source's size, and the excess goes to the others by weight until none is above. In the
    order of size per weight the stopped sources come first, so one running total finds the level.
    """
    named = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running(
        named, [F.col("source").asc_nulls_last()], {"rank": F.lit(1), "budget": F.col("source_size")}, "mix-sources"
    )
    weights = F.array(*(F.lit(w) for w in cycle))
    ranked = ranked.select(
        "source",
        "source_size",
        "rank",
        F.col("_total_budget").alias("budget"),
        F.get(weights, ((F.col("rank") - 1) % len(cycle)).cast("int")).cast("long").alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    )
    leveled = running(
        ranked, [F.col("cap") / F.col("weight"), F.col("rank")], {"caps": F.col("cap"), "weights": F.col("weight")}, "mix-levels"
    )
    level = (F.col("budget") - (F.col("caps") - F.col("cap"))).cast("double") / (
        F.col("_total_weights") - (F.col("weights") - F.col("weight"))
    ).cast("double")
    leveled = settle(leveled.withColumn("level", level), "mix-targets")
    open_ = F.col("cap") >= F.col("weight") * F.col("level")
    shared = leveled.filter(open_).agg(F.min_by("level", F.struct(F.col("cap") / F.col("weight"), "rank"))).first()[0]
    cap = F.col("cap").cast("double")
    target = cap if shared is None else F.least(cap, F.col("weight") * F.lit(shared))
    return leveled.select("source", "source_size", "rank", target.alias("target"))


def mix(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3, piece: int = 128) -> DataFrame:
    """How often and how far each document goes into the mix: (doc_id, size, source_size, target, taken, copies).

    Documents of a source are shuffled by the MD5 of their id and served ``most`` times over, in pieces of ``piece``
    words as a fair queue serves packets, so that one long document cannot carry its source past the line. A piece
    finishes at virtual time ``words of its source served up to and with it / target``. Pieces are cut into ranges of
    that time, and the mix ends where their total reaches the budget, the size of all documents. ``taken`` counts
    words, ``copies`` how often the document is in to at least half of its words.

    Null texts and texts without words have size 0 and are never taken; a null source is a source; equal rows are
    separate documents. An empty table gives an empty result. Other columns are ignored.
    """
    sized = settle(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = settle(source_targets(sized.select("source", "size"), cycle, most), "mix-shares")
    rows = sized.join(F.broadcast(targets) if _small(targets) else targets, sized.source.eqNullSafe(targets.source)).select(
        "doc_id", "size", "source_size", "target", "rank", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("dealt")
    )
    queued = settle(
        running(
            rows,
            [F.col("rank"), F.col("dealt"), F.col("doc_id"), F.col("size")],
            {"served": F.col("size"), "place": F.lit(1)},
            "mix-queues",
            by=["rank"],
        ),
        "mix-queued",
    )
    whole, served, size = F.col("_total_served"), F.col("served"), F.col("size")
    pieces = F.ceil(size / piece).cast("long")
    served_pieces = queued.filter("size > 0 and target > 0").select(
        "rank", "place", "size", "target", (served - size).alias("start"), whole.alias("whole"), pieces.alias("pieces"), F.explode(F.sequence(F.lit(0).cast("long"), pieces * most - 1)).alias("piece")
    )
    of_copy = F.col("piece") % F.col("pieces") * piece
    words = F.least(F.lit(piece).cast("long"), size - of_copy)
    upto = F.col("whole") * F.expr("piece div pieces") + F.col("start") + of_copy + words
    budget = queued.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    line = running(
        served_pieces.select("rank", "place", "piece", words.alias("words"), (upto.cast("double") / F.col("target")).alias("finish")),
        [F.col("finish"), F.col("rank"), F.col("place"), F.col("piece")],
        {"total": F.col("words")},
        "mix-line",
    )
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("words"), F.lit(budget) - F.col("total") + F.col("words")))
    taken = line.withColumn("part", part).filter("part > 0").groupBy("rank", "place").agg(F.sum("part").alias("taken"))
    return queued.join(taken, ["rank", "place"], "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce(F.floor((F.col("taken") * 2 + size) / (size * 2)), F.lit(0)).alias("copies"),
    )


def _small(table: DataFrame, most: int = 100_000) -> bool:
    """Whether a written table is small enough to send to every task."""
    return table.limit(most + 1).count() <= most


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, whole, as often as it takes them (``copies``). Columns are those of ``docs``.

    Rows that repeat an id share the highest count among them. Null texts and texts without words are not taken, an
    empty table gives an empty result, and columns may have any name.
    """
    counts = mix(docs, **options).groupBy("doc_id").agg(F.max("copies").alias("times"))
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("kept"))
    joined = packed.join(counts, F.col("kept.doc_id").eqNullSafe(counts["doc_id"])).filter("times > 0")
    return joined.select("kept", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("kept.*")
