"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import WORD, let, settle

WINDOW = 3


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def kept_length(text: Column, kept: str) -> Column:
    """How many characters of a text are in a regex character class, given as what to keep: ``[^...]+`` of the rest."""
    return F.length(F.regexp_replace(text, kept, "")).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    full = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    return let(full, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(tokens: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, the first time included.

    Windows of one text are sorted by hash with the position in the low bits (as many as the word count needs), so
    equal ones are neighbours; neighbours with equal bits are compared word by word, and covered words are counted from
    the sorted positions.
    """

    def of(w: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size(w).cast("long")))) - 1

        def inner(mask: Column) -> Column:
            hashed = F.transform(
                F.sequence(F.lit(0), F.size(w) - WINDOW),
                lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")),
            )

            def positions(s: Column) -> Column:
                word = lambda x, k: F.get(w, x.bitwiseAND(mask).cast("int") + k)
                alike = lambda x, y: y.isNotNull() & (x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(mask)) == 0)
                equal = lambda x, y: (word(x, 0) == word(y, 0)) & (word(x, 1) == word(y, 1)) & (word(x, 2) == word(y, 2))
                same = lambda x, y: F.when(alike(x, y), equal(x, y)).otherwise(False)
                twice = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
                return F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(mask)))

            start = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(-WINDOW).cast("long").alias("last"))
            return F.aggregate(
                let(F.sort_array(hashed), positions),
                start,
                lambda a, p: F.struct((a["covered"] + F.least(F.lit(WINDOW).cast("long"), p - a["last"])).alias("covered"), p.alias("last")),
                lambda a: a["covered"],
            )

        return F.when(F.size(w) <= WINDOW, F.lit(0).cast("long")).otherwise(let(low, inner))

    return let(tokens, of)


def base_counts(docs: DataFrame) -> DataFrame:
    """Word and line counts of every text (null: none), with ``base_failed``; ``text`` and ``doc_id`` are kept."""
    body = F.coalesce(F.col("text"), F.lit(""))
    split_ = docs.select("doc_id", body.alias("text")).withColumn("tokens", words(F.col("text")))
    counted = split_.select(
        "doc_id",
        "text",
        F.size("tokens").cast("long").alias("n_words"),
        kept_length(F.col("text"), r"[\x20\x09-\x0D]+").alias("word_chars"),
        kept_length(F.col("text"), r"[^#*$%&|<>]+").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("tokens")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return counted.withColumn("base_failed", failed)


def rules() -> dict[str, Column]:
    """Rules by name; each is true where it rejects a text that the base rules passed."""
    text, n = F.col("text"), F.col("n_words")
    return {
        "symbols": F.col("n_symbols") * 10 > n,
        "duplicate_lines": F.col("n_dup_lines") * 10 > F.size(F.split(text, "\n")) * 3,
        "shouting": let(kept_length(text, r"[^\p{Lu}]+"), lambda upper: (upper > 50) & (upper * 10 > kept_length(text, r"[^\p{L}]+") * 6)),
        "exclamations": F.regexp_count(text, F.lit("!")) * 4 > n,
        "word_length": (F.col("word_chars") < n * 2) | (F.col("word_chars") > n * 40),
        "doubled_words": F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++\1(?![^\x20\x09-\x0D])")) * 8 > n,
        "letters": kept_length(text, r"[^\p{L}]+") * 10 < F.col("word_chars") * 5,
    }


def ordered_rules(sample: DataFrame, checks: Mapping[str, Column], rounds: int = 3) -> list[str]:
    """Rule names by rejection per cost, highest first, measured on a sample of counted rows.

    Cost is the least of ``rounds`` timed runs of a rule over the written sample, less those of an empty rule;
    selectivity is the share of the sample it rejects. Order changes how much work is done, never a verdict.
    """
    taken = settle(sample, "cascade-sample")

    def seconds(check: Column) -> float:
        best = float("inf")
        for _ in range(rounds):
            start = time.perf_counter()
            taken.agg(F.count(F.when(check & F.col("text").isNotNull(), 1))).collect()
            best = min(best, time.perf_counter() - start)
        return best

    idle = seconds(F.lit(False))
    rejected = taken.agg(F.count(F.lit(1)).alias("rows"), *(F.count(F.when(c, 1)).alias(k) for k, c in checks.items())).first()
    worth = {k: (rejected[k] / max(1, rejected["rows"])) / max(1e-4, seconds(c) - idle) for k, c in checks.items()}
    return sorted(worth, key=lambda k: (-worth[k], k))


def cascade(checks: Mapping[str, Column], order: Sequence[str]) -> Column:
    """Name of the first rule that rejects a row, null if none; later rules are not evaluated then."""
    verdict = None
    for name in order:
        hit = F.lit(name)
        verdict = F.when(checks[name], hit) if verdict is None else verdict.when(checks[name], hit)
    return verdict


def quality_rules(docs: DataFrame, checks: Mapping[str, Column] | None = None, sample: int = 2000) -> DataFrame:
    """Counts, base verdict and cascade verdict of every document.

    Result: (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept). Null and empty
    texts have no words and fail the base rule; repeated rows are judged each; an empty table gives an empty result;
    other columns are ignored. Costs are measured on rows of the same table whose id hashes into one of as many
    classes as make about ``sample`` rows; the verdict itself is computed for every row.
    """
    checks = checks or rules()
    share = max(1, docs.count() // sample)
    picked = base_counts(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0))
    order = ordered_rules(picked.filter(~F.col("base_failed")), checks)
    rejected = F.when(~F.col("base_failed"), cascade(checks, order))
    return base_counts(docs).withColumn("kept", ~F.col("base_failed") & rejected.isNull()).drop("text")
