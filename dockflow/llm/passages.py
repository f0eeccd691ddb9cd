"""Document quality by attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import slices, text_bytes, windows_of, word_hashes, word_spans
from dockflow.llm.toxicity import held, labelled_sample

PASSAGE = 64
_KINDS = ("lower", "upper", "digit", "symbol", "mark", "bang", "line", "space", "high")
FEATURES = 16


def _kind_of_byte() -> np.ndarray:
    out = np.full(256, 4)
    out[97:123], out[65:91], out[48:58] = 0, 1, 2
    out[[ord(c) for c in "#*$%&|<>"]] = 3
    out[[ord("!"), ord("?")]] = 5
    out[10] = 6
    out[[32, 9, 11, 12, 13]] = 7
    out[128:] = 8
    return out


_KIND = _kind_of_byte()


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a text column, and each row's offsets among them.

    A passage is a run of 64 words of one text, the last one shorter; a text without words has one empty passage.
    Features say what its bytes are, how long its words are, and how much it repeats itself and the rest of its text.
    """
    body, ends = text_bytes(column)
    starts, stops, words = word_spans(body, ends)
    n_words = np.diff(words)
    per_row = np.maximum(1, -(-n_words // PASSAGE))
    bags = np.concatenate([[0], np.cumsum(per_row)])
    total = int(bags[-1])
    row_of_word = np.repeat(np.arange(len(n_words)), n_words)
    in_row = np.arange(len(starts)) - words[:-1][row_of_word]
    of_word = bags[:-1][row_of_word] + in_row // PASSAGE
    heads = np.flatnonzero(in_row % PASSAGE == 0)
    # bytes go to the passage of the last word begun before them, those before a text's first word to its first
    of_byte = np.zeros(len(body) + 1, np.int64)
    steps = np.zeros(len(body) + 1, np.int64)
    np.add.at(steps, starts[heads[in_row[heads] > 0]], 1)
    np.add.at(steps, ends[1:], 1)
    np.cumsum(steps, out=of_byte)
    kinds = np.bincount(of_byte[:-1] * len(_KINDS) + _KIND[body], minlength=total * len(_KINDS))[: total * len(_KINDS)].reshape(total, -1).astype(float)
    hashes = word_hashes(body, starts, stops, lower=True)
    count = np.bincount(of_word, minlength=total).astype(float)
    size = np.maximum(kinds.sum(axis=1), 1)
    letters = np.maximum(kinds[:, 0] + kinds[:, 1] + kinds[:, 8], 1)

    def distinct(owner: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
        order = np.lexsort((keys, owner))
        o, k = owner[order], keys[order]
        new = np.ones(len(o), bool)
        new[1:] = (o[1:] != o[:-1]) | (k[1:] != k[:-1])
        return np.bincount(o[new], minlength=n).astype(float)

    own = distinct(of_word, hashes, total) / np.maximum(count, 1)
    repeated = np.zeros(total)
    same_next = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        same_next[1:] = (hashes[1:] == hashes[:-1]) & (row_of_word[1:] == row_of_word[:-1])
        keys = hashes.copy()
        keys[1:] = keys[1:] * np.uint64(3) + hashes[:-1]
        # a text's first word has none before it, whatever text the batch has before this one
        begin = words[:-1][n_words > 0]
        keys[begin] = hashes[begin] * np.uint64(5) + np.uint64(1)
        order = np.lexsort((keys, row_of_word))
        again = np.zeros(len(keys), bool)
        again[order[1:]] = (keys[order[1:]] == keys[order[:-1]]) & (row_of_word[order[1:]] == row_of_word[order[:-1]])
        repeated = np.bincount(of_word, again, total)
    doubled = np.bincount(of_word, same_next, total)
    row_of_bag = np.repeat(np.arange(len(per_row)), per_row)
    out = np.column_stack(
        [
            kinds[:, 1] / letters,
            kinds[:, 2] / size,
            kinds[:, 3] / np.maximum(count, 1),
            kinds[:, 4] / np.maximum(count, 1),
            kinds[:, 5] / np.maximum(count, 1),
            kinds[:, 6] / np.maximum(count, 1) * 8,
            kinds[:, 7] / size,
            kinds[:, 8] / size,
            letters / size,
            np.minimum((size - kinds[:, 7] - kinds[:, 6]) / np.maximum(count, 1) / 8, 4),
            own,
            repeated / np.maximum(count, 1),
            doubled / np.maximum(count, 1),
            count / PASSAGE,
            np.log1p(n_words[row_of_bag]) / 8,
            np.log1p(per_row[row_of_bag]) / 4,
        ]
    )
    return np.clip(out, 0, 4), bags


@dataclass
class Attention:
    """Passage encoder, gated attention and a score on the weighted passage representation."""

    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        z = (x - self.mean) / self.scale
        h = np.tanh(z @ w["enc"] + w["enc0"])
        v = np.tanh(h @ w["v"])
        u = 1 / (1 + np.exp(-(h @ w["u"])))
        e = (v * u) @ w["a"]
        top = np.maximum.reduceat(e, bags[:-1])
        owner = np.repeat(np.arange(len(bags) - 1), np.diff(bags))
        p = np.exp(e - top[owner])
        p /= np.add.reduceat(p, bags[:-1])[owner]
        m = np.add.reduceat(h * p[:, None], bags[:-1], axis=0)
        y = 1 / (1 + np.exp(-np.clip(m @ w["out"] + w["out0"], -40, 40)))
        return {"z": z, "h": h, "v": v, "u": u, "p": p, "m": m, "y": y, "owner": owner}

    def gradients(self, x: np.ndarray, bags: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.w, self.forward(x, bags)
        dy = (f["y"] - label) * weight / weight.sum()
        dm = np.outer(dy, w["out"])[f["owner"]]
        dp = (dm * f["h"]).sum(axis=1)
        de = f["p"] * (dp - np.add.reduceat(f["p"] * dp, bags[:-1])[f["owner"]])
        gate = np.outer(de, w["a"])
        dv, du = gate * f["u"] * (1 - f["v"] ** 2), gate * f["v"] * f["u"] * (1 - f["u"])
        dh = (dm * f["p"][:, None] + dv @ w["v"].T + du @ w["u"].T) * (1 - f["h"] ** 2)
        return {
            "enc": f["z"].T @ dh,
            "enc0": dh.sum(axis=0),
            "v": f["h"].T @ dv,
            "u": f["h"].T @ du,
            "a": (f["v"] * f["u"]).T @ de,
            "out": f["m"].T @ dy,
            "out0": np.array([dy.sum()]),
        }


def fit(x: np.ndarray, bags: np.ndarray, label: np.ndarray, hidden: int = 16, epochs: int = 60, rate: float = 0.02, decay: float = 1e-3, seed: int = 7) -> Attention:
    """Fit by Adam on shuffled batches of documents; both labels weigh the same in all, and weights shrink by ``decay``."""
    rng = np.random.default_rng(seed)
    w = {
        "enc": rng.normal(0, 0.3, (x.shape[1], hidden)),
        "enc0": np.zeros(hidden),
        "v": rng.normal(0, 0.3, (hidden, 8)),
        "u": rng.normal(0, 0.3, (hidden, 8)),
        "a": rng.normal(0, 0.3, 8),
        "out": rng.normal(0, 0.3, hidden),
        "out0": np.zeros(1),
    }
    model = Attention(x.mean(axis=0), np.maximum(x.std(axis=0), 0.02), w)
    share = label.mean()
    weight = np.where(label == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    step, sizes = 0, np.diff(bags)
    for _ in range(epochs):
        for docs in np.array_split(rng.permutation(len(label)), max(1, len(label) // 256)):
            ends = np.cumsum(sizes[docs])
            rows = np.repeat(bags[docs] - np.concatenate([[0], ends[:-1]]), sizes[docs]) + np.arange(ends[-1])
            grads = model.gradients(x[rows], np.concatenate([[0], ends]), label[docs], weight[docs])
            step += 1
            for k, g in grads.items():
                g = g + decay * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


def pooled(bag: np.ndarray, most: int) -> np.ndarray:
    """The features of a document's passages, those of neighbours averaged where there are more than ``most`` of them."""
    if len(bag) <= most:
        return bag
    edges = np.linspace(0, len(bag), most, endpoint=False).astype(int)
    return np.add.reduceat(bag, edges, axis=0) / np.diff([*edges, len(bag)])[:, None]


def _features(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, bags = passages(part.column("text"))
                packed = [pooled(x[a:b], most).astype("<f4").tobytes() for a, b in zip(bags[:-1], bags[1:], strict=True)]
                yield pa.record_batch([part.column("label").cast(pa.int32()), pa.array(packed, pa.binary())], names=["label", "bag"])

    return run


def learn_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, most: int = 2000, longest: int = 200) -> Attention:
    """Fit on at most about ``most`` labelled documents of each label outside the held-out fold.

    Only features leave the tasks, ``longest`` rows of them for a document at most: in a longer one every row is the
    mean of several passages, so all passages take part, and what the driver holds is bounded by the sample whatever the
    length of its texts. Without both labels the model is not fitted.
    """
    sample = labelled_sample(docs, labels, "quality", folds, held_out, most).select("text", "label")
    rows = sample.mapInArrow(_features(longest), "label int, bag binary").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["bag"])))
    parts = [np.frombuffer(r["bag"], "<f4").reshape(-1, FEATURES).astype(float) for r in rows]
    if len({r["label"] for r in rows}) < 2:
        parts, truth = [np.zeros((1, FEATURES)), np.ones((1, FEATURES))], np.array([0.0, 1.0])
        return fit(np.vstack(parts), np.array([0, 1, 2]), truth, epochs=0)
    return fit(np.vstack(parts), np.cumsum([0, *map(len, parts)]), np.array([float(r["label"]) for r in rows]))


def _scores(model: Attention) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, bags = passages(part.column("text"))
                yield pa.record_batch([part.column("doc_id"), pa.array(model.forward(x, bags)["y"])], names=["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, model: Attention) -> DataFrame:
    """Score every text from 0 to 1: (doc_id, score). All passages of a text are encoded.

    A null or empty text is one passage without words. Long texts are read whole; repeated rows repeat; an empty
    table gives an empty result; other columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(_scores(model), f"doc_id {kind}, score double")


def quality_report(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document, with a model learned outside the held-out fold."""
    model = learn_quality(docs, labels, folds, held_out)
    return quality_scores(docs, model).select(
        "doc_id",
        held(F.col("doc_id"), folds, held_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
