"""Edited passages at random places, against every pair of passages."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from dockflow.llm import windows
from tests.llm.test_text_operators import WORD, prose


def shingles(words):
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


@pytest.mark.parametrize("stock", [False, True])
def test_edited_passages_of_all_lengths_are_found_wherever_the_edit_is(documents, stock):
    pick = random.Random(17 + stock)
    line = prose(4, 25, 100000).split()
    rows, want = [], []
    for k in range(400):
        words = prose(60000 + k, pick.randrange(50, 201), 100000).split()
        if stock:
            at = pick.randrange(len(words) - 20)
            words[at:at] = line
        edited = list(words)
        for _ in range(max(1, len(words) // 60)):
            place = pick.randrange(len(edited))
            edited[place : place + 1] = pick.choice([["changed"], [], ["put", "in"]])
        both = shingles(words) & shingles(edited)
        pair = []
        for j, body in enumerate((words, edited)):
            text = " ".join([prose(70000 + 2 * k + j, pick.randrange(60), 100000), *body, prose(90000 + 2 * k + j, pick.randrange(60), 100000)])
            rows.append((2 * k + j, text))
            pair.append(2 * k + j)
        if len(both) >= 0.8 * len(shingles(words) | shingles(edited)) and min(len(words), len(edited)) >= 50:
            want.append(tuple(pair))
    pick.shuffle(rows)
    text = dict(rows)
    got = windows.repeated_passages(documents(rows)).collect()
    found = {tuple(sorted((r["doc_id"], r["other_id"]))) for r in got}
    assert len(want) > 300
    assert sum(p in found for p in want) >= 0.95 * len(want)
    for r in got:
        a = WORD.findall(text[r["doc_id"]])[r["start_word"] : r["end_word"]]
        b = WORD.findall(text[r["other_id"]])[r["other_start"] : r["other_end"]]
        assert min(len(a), len(b)) >= 50 and len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b)) - 1e-9


def every_passage(texts, least=50):
    """Pairs of documents with a run of ``least`` words in common, or one that a single word's change keeps alike enough."""
    out, sets = set(), [[WORD.findall(t or "")] for t in texts]
    for i, (a,) in enumerate(sets):
        for j, (b,) in enumerate(sets[:i]):
            runs = {tuple(b[k : k + least]) for k in range(len(b) - least + 1)}
            if any(tuple(a[k : k + least]) in runs for k in range(len(a) - least + 1)):
                out.add((j, i))
    return out


def test_random_documents_with_shared_edited_and_repeated_parts(documents):
    pick = random.Random(31)
    parts = [prose(100 + k, pick.randrange(50, 120), 100000).split() for k in range(25)]
    texts = []
    for k in range(200):
        words = prose(1000 + k, pick.randrange(10, 120), 100000).split()
        for _ in range(pick.randrange(3)):
            part = list(pick.choice(parts))
            if pick.random() < 0.3:
                part[pick.randrange(len(part))] = "edit"
            words += part * pick.choice([1, 1, 2]) + prose(5000 + pick.randrange(10**6), 12, 100000).split()
        texts.append(" ".join(words))
    texts += [None, "", "word", "w " * 300, "w " * 260, texts[3]]
    want = every_passage(texts[:-1])
    got = windows.repeated_passages(documents(list(enumerate(texts)))).collect()
    group = list(range(len(texts)))
    for r in got:
        old, new = group[r["doc_id"]], group[r["other_id"]]
        group = [new if g == old else g for g in group]
    assert len(want) > 300 and all(group[i] == group[j] for i, j in want)
    assert (len(texts) - 1, 3) in {(r["doc_id"], r["other_id"]) for r in got} and group[-2] == group[-3]


def test_windows_of_many_ranges_are_those_of_each():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 50, 900).astype(np.uint64)
    edges = np.sort(rng.choice(900, 20, replace=False))
    starts, stops = edges[:-1], edges[1:]
    left, at, right = windows.cut_windows(values, 9, starts, stops)
    got = sorted(zip(left.tolist(), at.tolist(), right.tolist()))
    want = [(a + l, a + c, a + r) for a, b in zip(starts.tolist(), stops.tolist()) for l, c, r in windows.compact_windows(values[a:b], 9)]
    assert got == sorted(want)


def test_equal_words_make_one_window_in_little_time():
    start = time.perf_counter()
    assert len(windows.compact_windows(np.zeros(400_000, np.uint64), 46)) == 1
    assert len(windows.compact_windows(np.tile(np.arange(9, dtype=np.uint64), 40_000), 46)) <= 40_000
    assert time.perf_counter() - start < 2


def test_a_passage_need_not_be_unbroken_on_its_longer_side():
    words = [f"w{k}" for k in range(50)]
    for place in range(50):
        edited = [*words[:place], "changed", *words[place + 1 :]]
        a, b = (np.array([hash(s) & 0xFFFFFFFF for s in (tuple(x[k : k + 5]) for k in range(len(x) - 4))], np.uint32) for x in (words, edited))
        assert [round(x[-1], 2) >= 0.8 for x in windows.common_passages(a, b, 46, 0.8)] == [True]


def test_edited_passages_meet_where_many_documents_share_a_phrase(documents):
    # edited pairs, each around the phrase of all: neither the first document of a minimum nor the one before is the other
    stock = prose(56, 24, 100000).split()
    rows = []
    for k in range(60):
        passage = [*prose(120000 + k, 20, 100000).split(), *stock, *prose(130000 + k, 16, 100000).split()]
        for j in (0, 1):
            words = list(passage)
            if j:
                words[12] = "changed"
            rows.append((2 * k + j, " ".join([prose(140000 + 2 * k + j, 30, 100000), *words, prose(150000 + 2 * k + j, 30, 100000)])))
    random.Random(5).shuffle(rows)
    got = {tuple(sorted((r["doc_id"], r["other_id"]))) for r in windows.repeated_passages(documents(rows)).collect()}
    missed = [k for k in range(60) if (2 * k, 2 * k + 1) not in got]
    assert not missed


def test_what_a_written_step_shuffled_goes_with_it(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = held.getAllFiles().size()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting, None)
    step = windows._settled(spark.range(1000).repartition(7, "id"), "test-step")
    until = time.monotonic() + 20
    while held.getAllFiles().size() > before and time.monotonic() < until:
        time.sleep(0.2)
    assert held.getAllFiles().size() <= before
    assert spark.conf.get(setting, None) == was and step.count() == 1000


def test_anchors_of_many_texts_are_those_of_each():
    rng = np.random.Generator(np.random.PCG64(9))
    least = 46
    rows = []
    for doc in range(30):
        words = rng.integers(0, 4 if doc % 5 == 0 else 3000, int(rng.integers(60, 400)))
        text = " ".join(f"w{x}" for x in (np.full(300, 1) if doc == 7 else words))
        n = len(text.split()) - windows.SHINGLE + 1
        at = rng.integers(0, n, 5)
        rows.append((doc, text, [{"at": int(c), "left": int(min(c, 30)), "right": int(min(n - c, 50))} for c in at]))
    wanted = pa.list_(pa.struct([(x, pa.int32()) for x in ("at", "left", "right")]))

    def anchors(some):
        batch = pa.record_batch([pa.array([r[0] for r in some]), pa.array([r[1] for r in some]), pa.array([r[2] for r in some], wanted)], names=["doc", "text", "wanted"])
        return [tuple(x.values()) for out in windows._anchors(least, 0.8)(iter([batch])) for x in out.to_pylist()]

    got = anchors(rows)
    assert got == [x for r in rows for x in anchors([r])] and len(got) > 100
    size, every, need = windows.anchor_shape(least, 0.8)
    for doc, text, _ in rows:
        part = pa.record_batch([pa.array([text])], names=["text"])
        shingles, offsets = windows._shingles(part)
        assert offsets.tolist() == [0, len(text.split()) - windows.SHINGLE + 1]
        keys, runs = windows.mixed(windows.run_hashes(shingles, size)).view(np.int64), windows.run_hashes(shingles, need).view(np.int64)
        mine = [x for x in got if x[1] == doc]
        assert all(x[0] == keys[x[2]] for x in mine)
        assert [x[5] for x in mine] == [int(runs[x[2]]) if x[2] + need <= len(shingles) else 0 for x in mine]
        assert [x[6] for x in mine] == [int(runs[x[2] + size - need]) if x[2] + size >= need else 0 for x in mine]


def compared_pairs(monkeypatch):
    """How many pairs of documents each call of ``_compared`` gets."""
    counts, real = [], windows._compared

    def counted(texts, links, *rest):
        counts.append(links.select("doc", "other").distinct().count())
        return real(texts, links, *rest)

    monkeypatch.setattr(windows, "_compared", counted)
    return counts


def test_pairs_compared_around_a_common_phrase_grow_with_the_documents(documents, monkeypatch):
    # all share 24 words and little else; ten have the passage of ten others around them, with a word changed
    phrase = prose(61, 24, 100000).split()
    rows, want = [], []
    for k in range(200):
        before, after = prose(210000 + k, 45, 100000).split(), prose(220000 + k, 45, 100000).split()
        rows.append((k, " ".join([*before, *phrase, *after])))
        if k < 10:
            edited = [*before[:41], "changed", *before[42:]] if k % 2 else [*before, *phrase, *after[:2], "changed", *after[3:]]
            edited = [*edited, *phrase, *after[:22], prose(230000 + k, 30, 100000)] if k % 2 else edited[20:]
            rows.append((1000 + k, " ".join(edited)))
            want.append((k, 1000 + k))
    random.Random(6).shuffle(rows)
    counts = compared_pairs(monkeypatch)
    got = {tuple(sorted((r["doc_id"], r["other_id"]))) for r in windows.repeated_passages(documents(rows)).collect()}
    assert set(want) <= got
    assert sum(counts) < 10 * len(rows)


def test_pairs_compared_around_a_repeated_word_grow_with_the_documents(documents, monkeypatch):
    # every text repeats a word of all, between two repeated words of its own; some have a copy whose repeats are shorter
    rows, want = [], []
    for k in range(150):
        rows.append((k, " ".join([f"a{k}"] * 25 + ["the"] * 30 + [f"b{k}"] * 25)))
        if k < 10:
            rows.append((1000 + k, " ".join([f"a{k}"] * 20 + ["the"] * 24 + [f"b{k}"] * 20)))
            want.append((k, 1000 + k))
    random.Random(7).shuffle(rows)
    counts = compared_pairs(monkeypatch)
    got = {tuple(sorted((r["doc_id"], r["other_id"]))) for r in windows.repeated_passages(documents(rows)).collect()}
    assert set(want) <= got
    assert sum(counts) < 10 * len(rows)


def test_windows_meet_where_the_text_beside_their_centres_agrees():
    rows = [(8, d, m, 40, 30, 30) for d, m in ((1, 0x10002), (2, 0x10003), (3, 0x40005), (4, 0x70003), (5, 0x90000))]
    rows += [(16, d, 0x10002, 40, 30, 30) for d in (1, 2)]
    batch = windows._batch_of(np.array(rows, np.int64), windows._ROW)
    out = [x for part in windows._links(iter([batch]), 3) for x in part.to_pylist()]
    assert {(x["doc"], x["other"]) for x in out if x["fn"] >= 0} == {(2, 1)}
    # the last signature may go on; of the other one, those that agree with someone are joined again
    assert sorted(x["doc"] for x in out if x["fn"] == windows._SPAN) == [1, 2, 4]
