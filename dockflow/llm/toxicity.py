"""Toxic language by fuzzy lexicon search: Levenshtein automata over a lexicon trie, weighed by their context."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.automata import Dfa, Nfa, determinise
from dockflow.llm.common import column_text, map_texts, settle, slices

_TERM = r"[\p{L}\p{M}]+"
_MASKS = "0123456789@$!*#%+|€£¡"
# Families of quotation marks; which one opens and which one closes shows in the characters around it.
_QUOTES = ('"', "'‘’‚", "“”„", "«»", "‹›", "「」", "『』")
_tables: dict[str, np.ndarray] = {}


@dataclass(frozen=True)
class Model:
    """Lexicon terms (a final ``*`` stands for any ending), the weight of each as written and misspelled, and the rest.

    ``quoted`` is the share that an occurrence inside a quotation keeps; ``middle`` and ``slope`` shape the score.
    """

    terms: tuple[str, ...]
    weights: tuple[float, ...]
    misspelled: tuple[float, ...]
    quoted: float = 0.3
    window: int = 8
    shortest_fuzzy: int = 5
    middle: float = 0.95
    slope: float = 4.0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """Texts with a label, from the rows that may be learned from: (doc_id, text, label).

    At most about ``most`` documents per label value, those whose id hashes lowest; the rest of the table is not
    needed to fit a small model. The chosen ids are few enough to be sent to every task.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).filter(~held(F.col("doc_id"), folds, held_out))
    usable = usable.groupBy("doc_id").agg(F.max(label).alias("label"))
    sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    scale = 1 << 20
    bound = F.lit(scale)
    for value, n in sizes.items():
        bound = F.when(F.col("label") == value, F.lit(min(scale, math.ceil(scale * most / n)))).otherwise(bound)
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < bound)
    return docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")


def held(doc_id: Column, folds: int, remainder: int) -> Column:
    """Whether a row is held out by the CRC of its id; a null id is never learned from and not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == remainder, F.lit(False))


def learn_lexicon(sample: DataFrame, least: int = 3, most: int = 4096, stem: int = 5, fuzzy: float = 1.0) -> Model:
    """Terms that mark toxic documents, from a bounded labelled sample: words, and word beginnings of ``stem`` letters.

    A term needs ``least`` toxic documents and as many different words before it, so that copies of one document do
    not turn all its words into terms. Nine tenths of its documents must be toxic, and that must be less likely than
    chance allows among so many candidates; what it exceeds that by is its weight, up to 1. The ``most`` strongest
    are kept; that bounds the automaton, whose size is a model parameter. A misspelled occurrence of a term counts as
    much as the term if no clean document of the sample has one, and less the more of them do.
    """
    words = F.regexp_extract_all(F.lower("text"), F.lit(_TERM), F.lit(0))
    split_ = sample.select("doc_id", "label", words.alias("w"))
    stemmed = lambda x: F.when(F.length(x) > stem, F.concat(F.substring(x, 1, stem), F.lit("*")))
    toxic = split_.filter("label = 1")
    pairs = F.transform(F.col("w"), lambda x, i: F.struct(x.alias("term"), F.coalesce(F.get(F.col("w"), i - 1), F.lit("")).alias("lead")))
    leads = toxic.select(F.explode(pairs).alias("p")).select(F.explode(F.array_compact(F.array("p.term", stemmed(F.col("p.term"))))).alias("term"), "p.lead")
    found = (
        leads.groupBy("term", "lead")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("leads"))
        .filter((F.col("leads") >= least) & (F.length("term") >= 3))
    )
    per_doc = lambda df, name: df.select(F.explode(F.array_distinct(F.concat("w", F.array_compact(F.transform("w", stemmed))))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias(name))
    n = {r["label"]: r["count"] for r in split_.groupBy("label").count().collect()}
    toxic_n, clean_n = n.get(1, 0), n.get(0, 0)
    counted = found.join(per_doc(toxic, "in_toxic"), "term").filter(F.col("in_toxic") >= least)
    counted = counted.join(per_doc(split_.filter("label = 0"), "in_clean"), "term", "left").withColumn("in_clean", F.coalesce("in_clean", F.lit(0)))
    both = F.col("in_toxic") + F.col("in_clean")
    usual, share = toxic_n / max(1, toxic_n + clean_n), F.col("in_toxic") / both
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - usual))).otherwise(0.0)
    surprise = both * (share * F.log(share / usual) + rest) / math.log(10)
    counted = settle(counted.withColumn("surprise", surprise).withColumn("share", share), "toxic-terms")
    chance = math.log10(max(1, counted.count()))
    strong = counted.filter((F.col("share") > 0.9) & (F.col("surprise") > chance))
    rows = strong.orderBy(F.col("surprise").desc(), "term").limit(most).collect()
    rows = sorted(rows, key=lambda r: r["term"])
    weights = [round(min(1.0, (r["surprise"] - chance) / 2), 4) for r in rows]
    model = Model(tuple(r["term"] for r in rows), tuple(weights), tuple(weights))
    dfa, meanings = lexicon_automaton(model.terms, model.shortest_fuzzy, spread=True)
    hits = sample.select("label", "text").mapInArrow(_tags(model, dfa), "label int, tag int")
    clean = {r["tag"]: r["n"] for r in hits.filter("label = 0").groupBy("tag").agg(F.count(F.lit(1)).alias("n")).collect()}
    seen = {i: clean.get(tag, 0) for tag, (i, edits) in enumerate(meanings) if edits}
    return Model(model.terms, model.weights, tuple(round(fuzzy * w / (1 + seen.get(i, 0)), 4) for i, w in enumerate(weights)))


def _symbols(terms: Sequence[str]) -> np.ndarray:
    """The automaton's symbol of each code point: its place among the letters of the terms, 0 for all others."""
    out = np.zeros(0x110000, np.uint16)
    for i, c in enumerate(_letters(terms)):
        out[ord(c)] = i + 1
    return out


def _letters(terms: Sequence[str]) -> list[str]:
    return sorted({c for t in terms for c in t.removesuffix("*")})


def _tags(model: Model, dfa: Dfa) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(label, tag) once for each text and tag found in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = _symbols(model.terms)
        for batch in batches:
            for part in slices(batch, "text"):
                rows, tags, _ = occurrences(column_text(part.column("text")), dfa, symbols, model.window)
                pairs = np.unique(np.column_stack([rows, tags]), axis=0).reshape(-1, 2)
                labels = part.column("label").cast(pa.int32()).take(pa.array(pairs[:, 0], pa.int64()))
                yield pa.record_batch([labels, pa.array(pairs[:, 1], pa.int32())], names=["label", "tag"])

    return run


def lexicon_automaton(terms: Sequence[str], shortest_fuzzy: int = 5, spread: bool = False) -> tuple[Dfa, list[tuple[int, int]]]:
    """The trie of the terms intersected with the automaton of all strings within one edit, made deterministic.

    States of the product are (trie node, edits used). A move on the node's letter keeps the edits; any letter at the
    same node is an insertion; any letter to a child is a substitution; a free move to a child is a deletion. Terms
    shorter than ``shortest_fuzzy`` match only exactly, and so do terms for any ending, unless ``spread`` is set: then
    the beginning may have an edit too, and two letters that changed places are one edit. Tags number (term, edits)
    from 1, the exact ones first.
    """
    letters = _letters(terms)
    symbol = {c: i + 1 for i, c in enumerate(letters)}
    n_symbols = len(letters) + 1
    everything = (1 << n_symbols) - 1
    nfa = Nfa()
    nodes: dict[tuple[int, str], tuple[int, int]] = {}
    root = (nfa.state(), nfa.state())
    meanings: list[tuple[int, int]] = [(-1, 0)]
    tags: dict[tuple[int, int], int] = {}
    for edits in (0, 1):
        for i in range(len(terms)):
            tags[i, edits] = len(meanings)
            meanings.append((i, edits))

    def grow(start: tuple[int, int], term: str, fuzzy: bool, salt: str) -> tuple[int, int]:
        at = parent = start
        for k in range(len(term)):
            name = (0, salt + term[: k + 1])
            if name not in nodes:
                exact, edited = nfa.state(), nfa.state()
                nodes[name] = (exact, edited)
                one = 1 << symbol[term[k]]
                nfa.moves[at[0]].append((one, exact))
                if fuzzy:
                    nfa.moves[at[1]].append((one, edited))
                    nfa.moves[at[0]].append((everything & ~one, edited))
                    nfa.free[at[0]].append(edited)
                    if spread and k and term[k] != term[k - 1]:
                        swapped = nfa.state()
                        nfa.moves[parent[0]].append((one, swapped))
                        nfa.moves[swapped].append((1 << symbol[term[k - 1]], edited))
            parent, at = at, nodes[name]
        if fuzzy:
            for node in [start, *(nodes[0, salt + term[: k + 1]] for k in range(len(term)))]:
                if (everything, node[1]) not in nfa.moves[node[0]]:
                    nfa.moves[node[0]].append((everything, node[1]))
        return at

    strict_root = (nfa.state(), nfa.state())
    start = nfa.state()
    nfa.free[start] += [root[0], strict_root[0]]
    for i, term in enumerate(terms):
        fuzzy = len(term.removesuffix("*")) >= shortest_fuzzy and (spread or not term.endswith("*"))
        end = grow(root if fuzzy else strict_root, term.removesuffix("*"), fuzzy, "~" if fuzzy else "=")
        if term.endswith("*"):
            loop = nfa.state()
            nfa.moves[loop].append((everything, loop))
            nfa.free[end[0]].append(loop)
            nfa.accepts[loop] = tags[i, 0]
        else:
            nfa.accepts[end[0]] = tags[i, 0]
        if fuzzy and term.endswith("*"):
            loop = nfa.state()
            nfa.moves[loop].append((everything, loop))
            nfa.free[end[1]].append(loop)
            nfa.accepts[loop] = tags[i, 1]
        elif fuzzy:
            nfa.accepts[end[1]] = tags[i, 1]
    dfa = determinise(nfa, start, n_symbols, search=False, tag=lambda states: min((nfa.accepts[s] for s in states if s in nfa.accepts), default=0))
    return Dfa(dfa.table, dfa.classes, dfa.n_classes, dfa.tags.astype(np.int32)), meanings


def _table(kind: str) -> np.ndarray:
    """Per code point, whether it is part of a word, its family of quotation marks, or whether it may mask a letter."""
    if kind not in _tables:
        n = 0x110000
        out = np.zeros(n, bool)
        if kind == "quote":
            out = np.zeros(n, np.int8)
            for family, marks in enumerate(_QUOTES, 1):
                out[[ord(c) for c in marks]] = family
        elif kind == "mask":
            out[[ord(c) for c in _MASKS]] = True
        else:
            import unicodedata

            out[:] = [unicodedata.category(chr(c))[0] in "LM" for c in range(n)]
        _tables[kind] = out
    return _tables[kind]


def occurrences(texts: Sequence[str], dfa: Dfa, symbols: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, tag and quotation flag of every word that the automaton accepts.

    A word is a run of letters; two runs with one digit or sign between them, and nothing else, are also read as one
    word, as are more runs joined that way. A word is quoted when the nearest quotation mark on its left opens, the
    nearest on its right closes, both are of one family, and both stand within ``window`` words.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t) + 1 for t in lowered])
    inside = _table("word")[points]
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if len(starts) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(bool)
    joined = np.zeros(len(starts) + 1, bool)
    joined[1:-1] = (starts[1:] - stops[:-1] == 1) & _table("mask")[points[stops[:-1]]]
    # the first and last part of each word: all single ones, then the joined ones
    heads = np.flatnonzero(~joined[:-1] & joined[1:])
    tails = np.flatnonzero(joined[:-1] & ~joined[1:])
    single = np.arange(len(starts))
    head, tail = np.concatenate([single, heads]), np.concatenate([single, tails])
    tags = dfa.run(symbols[points], starts[head], stops[tail] - starts[head], sticky=False)
    at = np.flatnonzero(tags)
    head, tail = head[at], tail[at]
    rows = np.searchsorted(ends, starts[head], "right")
    row_start = np.concatenate([[0], ends[:-1]])[rows]
    lead = np.maximum(np.where(head >= window, stops[np.maximum(head - window, 0)], 0), row_start)
    trail = np.minimum(np.where(tail + window < len(starts), starts[np.minimum(tail + window, len(starts) - 1)], len(points)), ends[rows] - 1)
    return rows, tags[at], _quoted(points, inside, starts[head], stops[tail], lead, trail)


def _quoted(points: np.ndarray, inside: np.ndarray, starts: np.ndarray, stops: np.ndarray, lead: np.ndarray, trail: np.ndarray) -> np.ndarray:
    """Whether ``lead``..``starts`` ends inside a quotation that ``stops``..``trail`` closes.

    A mark opens when something other than a space follows it, or its shape says so, and no letter or digit comes
    before it, and closes the other way round; a mark between letters, as in a contraction, does neither.
    """
    family = _table("quote")[points]
    marks = np.flatnonzero(family)
    solid = points > 32
    wordlike = inside | (points >= 48) & (points <= 57)
    around = lambda flags: (np.concatenate([[False], flags])[marks], np.concatenate([flags, [False]])[marks + 1])
    (before, after), (word_before, word_after) = around(solid), around(wordlike)
    left_hand, right_hand = (np.isin(points[marks], [ord(c) for c in hand]) for hand in ("«‹「『“„", "»›」』”"))
    opens, closes = (after | left_hand) & ~word_before, (before | right_hand) & ~word_after
    both = opens | closes
    marks, opens, closes = marks[both], opens[both], closes[both]
    if len(marks) == 0:
        return np.zeros(len(starts), bool)
    left, right = np.searchsorted(marks, starts) - 1, np.searchsorted(marks, stops)
    there = (left >= 0) & (right < len(marks))
    left, right = np.maximum(left, 0), np.minimum(right, len(marks) - 1)
    near = (marks[left] >= lead) & (marks[right] < trail)
    return there & near & opens[left] & closes[right] & (family[marks[left]] == family[marks[right]])


def _scored(model: Model, dfa: Dfa, meanings: list[tuple[int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, np.ndarray]]]:
    """Parts of the batches, with the score of each of their rows."""
    term_of = np.array([m[0] for m in meanings])
    worth = np.array([0.0] + [model.misspelled[i] if edits else model.weights[i] for i, edits in meanings[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        symbols = _symbols(model.terms)
        for batch in batches:
            for part in slices(batch, "text"):
                rows, tags, quoted = occurrences(column_text(part.column("text")), dfa, symbols, model.window)
                value = worth[tags] * np.where(quoted, model.quoted, 1.0)
                # the best occurrence of each term of a text counts once
                key = rows * len(term_of) + term_of[tags] if len(rows) else rows
                order = np.lexsort((-value, key))
                first = np.flatnonzero(np.diff(key[order], prepend=-1))
                best = order[first]
                evidence = np.bincount(rows[best], value[best], part.num_rows) if len(best) else np.zeros(part.num_rows)
                yield part, 1 / (1 + np.exp(-model.slope * (evidence - model.middle)))

    return run


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """Score every text from 0 to 1: (doc_id, score).

    Each lexicon term counts by its best occurrence: as learned if misspelled by one edit (a letter more, less or
    other, two that changed places, or a digit or sign for a letter), less if inside a quotation.
    A null or empty text has no evidence and gets the lowest score; a long text is read whole; repeated rows repeat;
    an empty table gives an empty result; other columns are ignored. A model without terms scores all alike.
    """
    scored = _scored(model, *lexicon_automaton(model.terms, model.shortest_fuzzy, spread=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, score in scored(batches):
            yield pa.record_batch([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below the threshold, with all their columns. Texts do not move.

    Null, empty, long and repeated texts score as in :func:`toxicity_scores`; a row without any term stays. An empty
    table stays empty, and columns may have any name.
    """
    scored = _scored(model, *lexicon_automaton(model.terms, model.shortest_fuzzy, spread=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, score in scored(batches):
            yield part.filter(pa.array(score < threshold))

    return map_texts(docs, run)


def learn_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, most: int = 20000) -> Model:
    """A model from the labelled rows outside the held-out fold, at most about ``most`` of each label."""
    return learn_lexicon(labelled_sample(docs, labels, "toxic", folds, held_out, most))


def toxicity_report(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document, with a model learned outside the held-out fold."""
    model = learn_toxicity(docs, labels, folds, held_out)
    return toxicity_scores(docs, model).select(
        "doc_id",
        held(F.col("doc_id"), folds, held_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
