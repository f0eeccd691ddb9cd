"""Scan texts for secrets with one deterministic automaton for all rules."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.automata import Dfa, Nfa, add_regex, determinise
from dockflow.llm.common import map_texts, slices, text_bytes

SPANS = "array<struct<kind:string,start:long,end:long>>"


@dataclass(frozen=True)
class Rule:
    """``scan`` is what the automaton looks for; ``exact`` then gives the spans; ``long`` is (group, least length)."""

    kind: str
    scan: str
    exact: str
    long: tuple[int, int] = (0, 0)


# The three base rules with their least lengths, then well-known key formats.
_NAMES = r"(?i:password|passwd|secret|token|api_?key)"
RULES = (
    Rule("assign", _NAMES + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", (2, 8)),
    Rule("access", r"AKIA[A-Z0-9]{12}", r"AKIA[A-Z0-9]+", (0, 16)),
    Rule("hex", r"[0-9a-f]{32}", r"[0-9a-f]+", (0, 32)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{4}", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{4}", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


def automaton(rules: tuple[Rule, ...] = RULES) -> Dfa:
    """All rules in one minimal automaton over bytes; rule number i sets bit i."""
    nfa = Nfa()
    start = nfa.state()
    for i, rule in enumerate(rules):
        add_regex(nfa, start, rule.scan, 1 << i)
    return determinise(nfa, start, 256, search=True)


def spans_of(segment: str, hits: int, rules: tuple[Rule, ...], exact: list[re.Pattern]) -> Iterator[tuple[int, int, int]]:
    for i, rule in enumerate(rules):
        if hits >> i & 1:
            for m in exact[i].finditer(segment):
                if m.end(rule.long[0]) - m.start(rule.long[0]) >= rule.long[1]:
                    yield m.start(), i, m.end()


class _Chars:
    """Code points before a byte position, asked in rising order within each text: every byte is counted once."""

    def __init__(self, body: np.ndarray):
        self.heads = (body & 0xC0) != 0x80
        self.at = self.count = 0

    def upto(self, start: int, position: int) -> int:
        if self.at < start:
            self.at, self.count = start, 0
        self.count += int(np.count_nonzero(self.heads[self.at : position]))
        self.at = position
        return self.count


def _scan(dfa: Dfa, rules: tuple[Rule, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list[list[dict]]]]]:
    """Row ranges of the batches, with the spans of each of their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[dict]]]]:
        exact = [re.compile(r.exact) for r in rules]
        resets = dfa.resets()
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                body, ends = text_bytes(part.column("text"))
                cut = resets[body]
                inside = ~cut
                first = inside.copy()
                first[1:] &= cut[:-1]
                first[ends[:-1][(ends[:-1] < len(body))]] |= inside[ends[:-1][(ends[:-1] < len(body))]]
                starts = np.flatnonzero(first)
                last = inside.copy()
                last[:-1] &= cut[1:]
                tails = ends[1:][ends[1:] > 0] - 1
                last[tails] |= inside[tails]
                stops = np.flatnonzero(last) + 1
                hits = dfa.run(body, starts, stops - starts, sticky=True)
                found: list[list[tuple[int, int, int]]] = [[] for _ in range(part.num_rows)]
                flagged = np.flatnonzero(hits)
                rows = np.searchsorted(ends, starts[flagged], "right") - 1
                chars = _Chars(body)
                for j, row in zip(flagged.tolist(), rows.tolist(), strict=True):
                    before = chars.upto(int(ends[row]), int(starts[j]))
                    segment = body[starts[j] : stops[j]].tobytes().decode()
                    found[row] += [(before + a, i, before + b) for a, i, b in spans_of(segment, int(hits[j]), rules, exact)]
                yield part, [[{"kind": rules[i].kind, "start": a, "end": b} for a, i, b in sorted(f)] for f in found]

    return run


def _spans(dfa: Dfa, rules: tuple[Rule, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    scan = _scan(dfa, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, spans in scan(batches):
            yield pa.record_batch([part.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

    return run


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of secrets in every text: (doc_id, spans), spans by start, then in rule order; code points, end exclusive.

    One automaton reads each byte once. Bytes on which it always returns to its start cut a text into segments that no
    match crosses; segments where a rule was seen are read again by that rule's own expression for the exact spans,
    leftmost and without overlap for each rule, too short ones dropped.

    Null and empty texts have no spans; long texts are scanned whole; repeated rows repeat; an empty table gives an
    empty result; other columns are ignored.
    """
    dfa = automaton(rules)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(_spans(dfa, rules), f"doc_id {kind}, spans {SPANS}")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts of the base rules, a digest of their spans, and all spans as text, per document."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return find_secrets(docs).select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def _redact(dfa: Dfa, rules: tuple[Rule, ...], mark: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    scan = _scan(dfa, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, spans in scan(batches):
            texts = [t if not s else masked(t, s, mark) for t, s in zip(part.column("text").to_pylist(), spans, strict=True)]
            yield part.set_column(part.schema.names.index("text"), "text", pa.array(texts, pa.string()))

    return run


def masked(text: str, spans: list[dict], mark: str) -> str:
    """A text with each run of overlapping spans replaced by the mark."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], mark]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """The same rows with every secret replaced by a mark; see :func:`find_secrets` for long and repeated texts.

    All columns stay, whatever their names; null texts stay null, and an empty table stays empty.
    """
    return map_texts(docs, _redact(automaton(rules), rules, mark))
