"""Text operators against brute force, the tokenizer libraries, and hand-made edge rows."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from dockflow.llm import bpe, cascade, fingerprints, mixing, overlap, passages, secrets, token_cache, toxicity, windows
from dockflow.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed, n, vocabulary=3600):
    rng = random.Random(seed)
    return " ".join("w" + "".join(chr(97 + int(d)) for d in str(rng.randrange(vocabulary))) for _ in range(n))


BASE = prose(1, 120)
EDGE = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, BASE),
    (5, BASE),
    (5, BASE),
    (6, BASE.replace("w", "W", 3)),
    (7, BASE + " tail"),
    (8, "one two"),
    (9, prose(2, 4000)),
    (10, "password=abcdefgh1234 and été 0123456789abcdef0123456789abcdef\n" * 3),
    (None, "no id here"),
    (None, None),
]


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# mixing


def mixed_by_hand(rows, piece=128):
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    whole = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in names}
    target, open_ = {s: 0.0 for s in names}, set(names)
    left = sum(size)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * whole[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3 * whole[s]
            left -= 3 * whole[s]
        open_ -= over
    served, start = collections.defaultdict(int), {}
    order = sorted(range(len(rows)), key=lambda i: (hashlib.md5(str("" if rows[i][0] is None else rows[i][0]).encode()).hexdigest(), rows[i][0] or 0, size[i]))
    for i in order:
        start[i] = served[rows[i][2]]
        served[rows[i][2]] += size[i]
    pieces = []
    for i, (_, _, s) in enumerate(rows):
        for e in range(3):
            for at in range(0, size[i], piece):
                n = min(piece, size[i] - at)
                if target[s] > 0:
                    pieces.append(((e * whole[s] + start[i] + at + n) / target[s], names.index(s), start[i], e, at, i, n))
    budget, taken = sum(size), collections.Counter()
    for *_, i, n in sorted(pieces):
        part = min(n, budget)
        taken[i] += part
        budget -= part
    return size, whole, target, taken


def test_mix_against_loop(documents):
    rng = random.Random(4)
    rows = [(i, prose(i, rng.randrange(0, 400)), rng.choice(["a", "b", "é", None, "tiny"])) for i in range(120)]
    rows = [(i, t[:20] if s == "tiny" else t, s) for i, t, s in rows]
    size, whole, target, taken = mixed_by_hand(rows)
    got = {r["doc_id"]: r for r in mixing.mix(documents(rows)).collect()}
    assert len(got) == len(rows)
    for i, (doc_id, _, s) in enumerate(rows):
        r = got[doc_id]
        assert (r["size"], r["source_size"]) == (size[i], whole[s])
        assert r["target"] == pytest.approx(target[s])
        assert r["taken"] <= 3 * size[i]
    by_source = collections.Counter()
    for i, (doc_id, _, s) in enumerate(rows):
        by_source[s] += got[doc_id]["taken"]
        assert got[doc_id]["taken"] == taken[i]
    for s, n in by_source.items():
        assert abs(n - target[s]) <= 256
    assert sum(by_source.values()) == sum(size)


def test_mix_edges(documents, spark):
    got = mixing.mix(documents([*EDGE, (20, "x y", None)])).collect()
    assert len(got) == len(EDGE) + 1
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix(documents(EDGE).filter("false")).collect() == []
    assert mixing.mix(documents([(1, None), (2, "")])).agg({"taken": "sum"}).first()[0] == 0


def test_mixed_documents_repeat_whole_rows(documents):
    rows = [(i, prose(i, 100), "big" if i < 40 else "small") for i in range(50)]
    docs = documents(rows)
    times = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    got = collections.Counter(r["doc_id"] for r in mixing.mixed_documents(docs).collect())
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert got == collections.Counter({k: v for k, v in times.items() if v})


# cascade


def counts_by_hand(text):
    words = WORD.findall(text or "")
    windows_ = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = collections.Counter(windows_)
    covered = {i + k for i, w in enumerate(windows_) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_cascade_counts(documents, spark, small):
    junk = [(30, "SHOUT!! " * 60), (31, "a b c " * 40), (32, "\n".join(["same line of words here"] * 30)), (33, "a\x0bb\x0cc\rd  e\n\n# | <x>"), (34, "aaa aaa aaa aaa")]
    docs = documents([*EDGE, *junk])
    for df in (docs, table(spark, small, "documents")):
        want = collections.Counter((i, *counts_by_hand(t)) for i, t in texts(df))
        got = cascade.quality_rules(df).collect()
        assert collections.Counter(tuple(r)[:7] for r in got) == want
        assert not any(r["kept"] for r in got if r["base_failed"])
    kept = {r["doc_id"]: r["kept"] for r in cascade.quality_rules(docs).collect()}
    assert kept[4] and kept[9] and not kept[30] and not kept[32]
    assert cascade.quality_rules(docs.filter("false")).collect() == []


def test_cascade_keeps_labelled_clean_documents(spark, small):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, small, "labels").collect()}
    got = [r for r in cascade.quality_rules(table(spark, small, "documents")).collect() if r["doc_id"] in labels]
    clean = [r for r in got if labels[r["doc_id"]] == 1 and not r["base_failed"]]
    assert all(r["kept"] for r in clean)
    assert not any(r["kept"] for r in got if labels[r["doc_id"]] == 0 and r["n_symbols"] * 10 > r["n_words"])


def test_rule_order_follows_rejection_per_cost(spark):
    from pyspark.sql import functions as F

    df = spark.range(4000).select(F.lit("x y z " * 50).alias("text"), F.col("id"))
    costly = F.length(F.regexp_replace(F.repeat("text", 40), "[a-w]", "")) < 0
    assert cascade.ordered_rules(df, {"never": costly, "often": F.col("id") % 2 == 0})[0] == "often"


# fingerprints


def test_fingerprints_by_hand(documents):
    rows = [*EDGE, (40, "A. B. C. " * 30), (41, prose(7, 900).replace(" w3", ". w3"))]
    got = fingerprints.fingerprint_edits(documents(rows)).collect()
    assert len(got) == len(rows)
    unique = {}
    for i, t in rows:
        key = -(2**63) if i is None else i
        unique[key] = min(unique.get(key, (t or "")), t or "")
    order = sorted(unique, reverse=True)
    follow = {k: unique[order[(n + 1) % len(order)]] for n, k in enumerate(order)}
    pattern = re.compile(r"(?s).{1,200}?(?:[.!?]+\s|\n|\Z)|.{1,200}")
    want = collections.Counter()
    for i, t in rows:
        text, following = t or "", follow[-(2**63) if i is None else i]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        a, b, c = (set(pattern.findall(x)) - {""} for x in (text, edited, following))
        near = [round(len(a & x) / len(a | x), 9) if a | x else 1.0 for x in (b, c)]
        want[(i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near)] += 1
    have = collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got)
    assert have == want
    same = {r["fingerprint"] for r in got if r["doc_id"] in (4, 5)}
    assert len(same) == 1
    assert fingerprints.fingerprint_edits(documents(EDGE).filter("false")).collect() == []


def test_large_differences_are_recovered(spark):
    from pyspark.sql import functions as F

    rows = [([*range(a)], [*range(b, b + c)]) for a, b, c in [(0, 0, 0), (1, 5, 1), (500, 250, 500), (3000, 9000, 2500), (40, 0, 41)]]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>").select(*(F.transform(c, lambda k: F.xxhash64(k)).alias(c) for c in "ab"))
    df = df.select("*", fingerprints.sketch(F.col("a")).alias("x"), fingerprints.sketch(F.col("b")).alias("y"))
    got = [r[0] for r in df.select(fingerprints.difference(*(F.col(c) for c in "abxy"))).collect()]
    assert got == [len(set(a) ^ set(b)) for a, b in rows]


# token counts


def test_token_cache_counts_once_and_appends(documents, spark, tmp_path):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    cache = str(tmp_path / "cache")
    first = documents(EDGE)
    want = collections.Counter((i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t in EDGE)
    assert collections.Counter(tuple(r) for r in token_cache.cached_counts(first, cache).collect()) == want
    stored = spark.read.parquet(cache)
    distinct = len({(t or "").replace(" ", "▁") for _, t in EDGE})
    assert stored.count() == distinct
    more = documents([*EDGE, (50, "something new"), (51, "something▁new")])
    assert token_cache.cached_counts(more, cache).count() == len(EDGE) + 2
    assert spark.read.parquet(cache).count() == distinct + 1
    assert token_cache.cached_counts(first.filter("false"), str(tmp_path / "none")).collect() == []


def test_other_tokenizers(documents, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    rows = [(1, "a<|endoftext|>b c"), (2, "x" * 300)]
    got = token_cache.cached_counts(documents(rows), str(tmp_path / "c"), path, normalised=lambda c: c).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(whole.encode(t, add_special_tokens=False).ids) for i, t in rows}


# byte-level BPE


def test_encoding_matches_library(documents, spark, small):
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = [(60 + k, t) for k, t in enumerate(["  a  b\n\n c\t", "it's 3½ ²x's", "日本語のテキスト 😀", "<|endoftext|>", "x" * 3000, "a b　c \x1c d", " \n"])]
    for df in (documents([*EDGE, *odd]), table(spark, small, "documents")):
        want = collections.Counter()
        for i, t in texts(df):
            ids = library.encode_ordinary(t or "")
            want[(i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode())] += 1
        assert collections.Counter((r[0], r[1], bytes(r[2]), bytes(r[3])) for r in bpe.encode_documents(df).collect()) == want
    assert bpe.encode_documents(documents(EDGE).filter("false")).collect() == []


def test_perfect_hash_is_minimal_and_complete():
    table_ = {str(i).encode(): i * 3 for i in range(3000)}
    held = bpe.PerfectHash.of(table_)
    assert len(held.keys) == len(table_)
    assert all(held.get(k) == v for k, v in table_.items())
    assert held.get(b"absent") is None
    assert bpe.PerfectHash.of({}).get(b"x") is None


# secrets


def spans_by_hand(text):
    found = []
    for i, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.exact, text):
            if m.end(rule.long[0]) - m.start(rule.long[0]) >= rule.long[1]:
                found.append((m.start(), i, m.end()))
    return [f"{secrets.RULES[i].kind}:{a}:{b}" for a, i, b in sorted(found)]


def test_secrets_against_regexes(documents, spark, small):
    rng = random.Random(9)
    parts = ["password", "PassWd", "token", "api_key", "apikey", " ", "=", ":", '"', "'", "abc12345", "0123456789abcdef" * 2, "AKIA", "ABCDEFGHIJKL", "é", "\n", ",", "ghp_", "a" * 36, "eyJabcdefgh", ".", "xoxb-", "-----BEGIN RSA PRIVATE KEY-----"]
    odd = [(100 + k, "".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for k in range(400)]
    for df in (documents([*EDGE, *odd]), table(spark, small, "documents")):
        want = collections.Counter()
        for i, t in texts(df):
            spans = spans_by_hand(t or "")
            base = [s for s in spans if s.split(":")[0] in secrets.BASE]
            n = [sum(s.startswith(k + ":") for s in base) for k in secrets.BASE]
            want[(i, *n, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(spans))] += 1
        assert collections.Counter(tuple(r) for r in secrets.secret_report(df).collect()) == want
    assert secrets.secret_report(documents(EDGE).filter("false")).collect() == []


def test_redaction(documents):
    docs = documents(EDGE)
    got = secrets.redacted(docs)
    assert got.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in got.collect()}
    assert text[10] == "[secret] and été [secret]\n" * 3 and text[1] is None and text[4] == BASE


# toxicity


def toxic_corpus(n=400):
    bad = ["scumbag", "vermin", "worthless", "trashy", "moronic"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = prose(i, 60).split()
        if toxic:
            for _ in range(4):
                words[random.Random(i * 7 + len(words)).randrange(len(words))] = "x"
                words.insert(random.Random(i * 5 + len(words)).randrange(len(words)), random.Random(i * 3 + len(words)).choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_learns_and_holds_out(documents, spark):
    rows, labels = toxic_corpus()
    table_ = spark.createDataFrame([*labels, (9000, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    docs = documents([*rows, *[(1000 + (i or 0), t) for i, t in EDGE if i]])
    got = {r["doc_id"]: r for r in toxicity.toxicity_report(docs, table_).collect()}
    for i, _, toxic in labels:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["predicted"] == toxic
    assert all(got[1000 + i]["predicted"] == 0 and 0 <= got[1000 + i]["score"] <= 1 for i, _ in EDGE if i)
    assert toxicity.toxicity_report(docs.filter("false"), table_).collect() == []
    nothing = toxicity.toxicity_report(docs, table_.filter("false")).collect()
    assert {r["predicted"] for r in nothing} == {0}


def test_misspelled_and_quoted_terms(documents):
    model = toxicity.Model(("scumbag", "vermin", "idio*"), (1.0, 1.0, 1.0), (0.6, 0.6, 0.6))
    rows = [(1, "you scumbag vermin"), (2, "you scumbg vermim x"), (3, 'he said "scumbag" and "vermin" yesterday'), (4, "skumbagg is far"), (5, "IDIOTIC Vermin"), (6, None), (7, "vérmin")]
    score = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(documents(rows), model).collect()}
    assert score[1] > score[2] > 0.5 > score[3] > score[4] == score[6]
    assert score[5] == score[1] and score[4] < score[7] < 0.5


def test_one_misspelled_term_decides(documents, spark):
    rows, labels = toxic_corpus()
    table_ = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.learn_toxicity(documents(rows), table_)
    exact = ["scumbag", "vermin", "worthless", "moronic"]
    wrong = ["scubmag", "vremin", "vermni", "wrothless", "mor0nic", "v*rmin", "scumb@g", "w0rthlessly", "mornoically", "vermn", "moroniic"]
    inside = ["scumbag@home", "x*vermin"]
    found = [prose(3000 + k, 30) + f" {w} " + prose(4000 + k, 30) for k, w in enumerate(exact + wrong + inside)]
    clean = [prose(5000, 60), "you said 'vremin' once", "3*4 a@b.c 0x1f 5", "scxbga", ""]
    score = [r["score"] for r in toxicity.toxicity_scores(documents(list(enumerate(found + clean))).orderBy("doc_id").coalesce(1), model).collect()]
    missed = [w for w, s in zip(exact + wrong + inside, score) if s < 0.5]
    assert not missed
    assert all(s < 0.5 for s in score[len(found) :])


def test_spread_automaton_against_edits():
    rng = random.Random(3)
    terms = ["abcab", "bacca", "caabbc", "abc", "ccbab*"]
    dfa, meanings = toxicity.lexicon_automaton(terms, spread=True)
    symbols = np.zeros(0x110000, np.uint16)
    for i, c in enumerate("abc"):
        symbols[ord(c)] = i + 1

    def near(word, term):
        swaps = {term[:k] + term[k + 1] + term[k] + term[k + 2 :] for k in range(len(term) - 1)}
        return edits(word, term) <= 1 or word in swaps

    for _ in range(4000):
        word = "".join(rng.choice("abcz") for _ in range(rng.randrange(1, 9)))
        codes = np.array([symbols[ord(c)] for c in word])
        tag = int(dfa.run(codes, np.array([0]), np.array([len(word)]), sticky=False)[0])
        exact = word in terms or word.startswith("ccbab")
        edited = any(near(word, t) for t in terms if len(t) == 5 or len(t) == 6 and "*" not in t)
        edited |= any(near(word[:k], "ccbab") for k in range(len(word) + 1))
        assert (tag > 0) == (exact or edited), word
        if tag:
            assert (meanings[tag][1] == 0) == exact


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_accepts_exactly_one_edit():
    rng = random.Random(2)
    terms = ["abcab", "bacca", "caabbc", "abc", "abca*"]
    dfa, meanings = toxicity.lexicon_automaton(terms)
    symbols = np.zeros(0x110000, np.uint16)
    for i, c in enumerate("abc"):
        symbols[ord(c)] = i + 1
    for _ in range(3000):
        word = "".join(rng.choice("abcz") for _ in range(rng.randrange(1, 8)))
        codes = np.array([symbols[ord(c)] for c in word])
        tag = int(dfa.run(codes, np.array([0]), np.array([len(word)]), sticky=False)[0])
        exact = word in terms or word.startswith("abca")
        near = any(len(t) >= 5 and not t.endswith("*") and edits(word, t) == 1 for t in terms)
        assert (tag > 0) == (exact or near)
        if tag:
            assert (meanings[tag][1] == 0) == exact


# quality


def test_quality_on_held_out_documents(documents, spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(300):
        good = i % 3 != 0
        words = prose(i, rng.randrange(30, 300)).split()
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [w + "$$$" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), 0))
    table_ = spark.createDataFrame([*labels, (9000, None, None)], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r for r in passages.quality_report(documents([*rows, (1000, None), (1001, "")]), table_).collect()}
    held = [r for i, r in got.items() if r["held_out"] and i < 1000]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert sum(r["predicted"] == labels[r["doc_id"]][1] for r in held) >= 0.97 * len(held)
    assert all(0 <= got[i]["score"] <= 1 for i in (1000, 1001))
    assert passages.quality_report(documents(rows).filter("false"), table_).collect() == []


def test_gradients_are_derivatives():
    rng = np.random.default_rng(1)
    x, bags = rng.normal(size=(9, 16)), np.array([0, 2, 5, 9])
    label, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    model = passages.fit(x, bags, label, hidden=5, epochs=1)

    def loss():
        y = model.forward(x, bags)["y"]
        return -(weight * (label * np.log(y) + (1 - label) * np.log(1 - y))).sum() / weight.sum()

    grads = model.gradients(x, bags, label, weight)
    for name, g in grads.items():
        w = model.w[name]
        for index in [tuple(rng.integers(0, s) for s in w.shape) for _ in range(3)]:
            old = w[index].copy()
            w[index] = old + 1e-5
            up = loss()
            w[index] = old - 1e-5
            down = loss()
            w[index] = old
            assert (up - down) / 2e-5 == pytest.approx(g[index], abs=1e-6)


# overlap


def groups_by_hand(rows, percent=90):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    out = collections.Counter()
    for i, (doc_id, _) in enumerate(rows):
        named = [x for x in least[find(i)] if x is not None]
        out[doc_id, len(sets[i]), (min(named) if named else None) if sets[i] else doc_id] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"short_run": 1, "long_run": 4, "block": 600}, {"short_run": 2, "block": 5000}])
def test_overlap_join_against_all_pairs(documents, options):
    rng = random.Random(6)
    rows = list(EDGE)
    for family in range(4):
        words = prose(100 + family, rng.randrange(60, 200)).split()
        for copy in range(25):
            changed = [w if rng.random() > 0.012 * (copy % 4) else f"edit{rng.randrange(10**6)}" for w in words]
            rows.append((200 + 100 * family + copy, " ".join(changed[: len(changed) - copy % 3])))
    rows += [(900 + i, "shared licence text of common words " * 3 + prose(i, 20)) for i in range(30)]
    got = overlap.similar_documents(documents(rows), **options).collect()
    assert collections.Counter(tuple(r) for r in got) == groups_by_hand(rows)
    if not options:
        assert overlap.similar_documents(documents(rows).filter("false")).collect() == []
        assert collections.Counter(tuple(r) for r in overlap.similar_documents(documents([(1, None), (2, "")])).collect()) == {(1, 0, 1): 1, (2, 0, 2): 1}


def test_divide_skip_links_the_same_components():
    rng = np.random.default_rng(5)
    pool = np.sort(rng.integers(0, 2**62, 4000, dtype=np.uint64))
    sets = []
    for _ in range(20):
        base = rng.choice(pool, rng.integers(5, 120), replace=False)
        for _ in range(6):
            keep = base[rng.random(len(base)) > 0.04]
            sets.append(np.unique(np.concatenate([keep, rng.choice(pool, 2)])))
    links = overlap.divide_skip(sets, np.zeros(len(sets), int), 90)
    parent = list(range(len(sets)))

    def find(p, x):
        while p[x] != x:
            x = p[x]
        return x

    for i, j in links:
        parent[find(parent, i)] = find(parent, j)
    want = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                want[find(want, i)] = find(want, j)
    for i in range(len(sets)):
        for j in range(i):
            assert (find(parent, i) == find(parent, j)) == (find(want, i) == find(want, j))


# passages


def test_compact_windows_cover_every_long_subsequence():
    rng = np.random.default_rng(8)
    values = rng.permutation(90).astype(np.uint64)
    found = windows.compact_windows(values, 12)
    for i in range(len(values)):
        for j in range(i + 12, len(values) + 1):
            at = i + int(values[i:j].argmin())
            assert sum(a <= i and j <= b and c == at for a, c, b in found) == 1


def test_repeated_passages_are_found(documents):
    passage = prose(77, 60, 100000)
    rows = [(i, " ".join([prose(1000 + i, 80, 100000), passage, prose(2000 + i, 40, 100000)])) for i in range(12)]
    edited = passage.split()
    edited[30] = "changed"
    rows += [(20, " ".join(edited) + " " + prose(5, 70, 100000)), (21, prose(6, 300, 100000)), (22, rows[3][1]), *[(30 + (i or 0), t) for i, t in EDGE]]
    got = windows.repeated_passages(documents(rows)).collect()
    text = dict(rows)
    hit = {r["doc_id"] for r in got} | {r["other_id"] for r in got}
    assert set(range(12)) <= hit and 20 in hit and 22 in hit and 21 not in hit
    for r in got:
        a = WORD.findall(text[r["doc_id"]])[r["start_word"] : r["end_word"]]
        b = WORD.findall(text[r["other_id"]])[r["other_start"] : r["other_end"]]
        x, y = ({tuple(z[k : k + 5]) for k in range(len(z) - 4)} for z in (a, b))
        assert len(a) >= 50 and len(x & y) >= 0.8 * len(x | y)
    assert windows.repeated_passages(documents(EDGE).filter("false")).collect() == []


def test_a_frequent_passage_is_found_in_every_document(documents):
    passage = prose(78, 70, 100000)
    rows = [(i, " ".join([prose(5000 + i, 30, 100000), passage, prose(9000 + i, 30, 100000)])) for i in range(1500)]
    got = windows.repeated_passages(documents(rows)).collect()
    assert {r["doc_id"] for r in got} | {r["other_id"] for r in got} == set(range(1500))
    # few enough others: one document ties all
    parent = list(range(1500))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in got:
        parent[find(r["doc_id"])] = find(r["other_id"])
    assert len({find(i) for i in range(1500)}) == 1
    assert len(got) < 10 * 1500


def test_passages_around_a_frequent_line_meet(documents):
    # each passage is in two documents; all passages hold the same stock phrase, so most minima are in it
    stock = prose(55, 34, 100000)
    rows = []
    for k in range(60):
        passage = " ".join([prose(20000 + k, 13, 100000), stock, prose(30000 + k, 13, 100000)])
        rows += [(2 * k + j, " ".join([prose(40000 + 2 * k + j, 30, 100000), passage, prose(50000 + 2 * k + j, 30, 100000)])) for j in (0, 1)]
    order = list(range(len(rows)))
    random.Random(4).shuffle(order)
    got = windows.repeated_passages(documents([rows[i] for i in order])).collect()
    runs = {}
    for i, text in rows:
        words = WORD.findall(text)
        for a in range(len(words) - 49):
            runs.setdefault(tuple(words[a : a + 50]), set()).add(i)
    want = {tuple(sorted(x)) for x in runs.values() if len(x) > 1}
    assert len(want) == 60
    assert want <= {tuple(sorted((r["doc_id"], r["other_id"]))) for r in got if r["end_word"] - r["start_word"] >= 60}


def test_runs_of_shingles_have_one_hash():
    values = np.random.default_rng(3).integers(0, 2**63, 200, dtype=np.uint64)
    for least in (1, 2, 7, 46):
        hashes = windows.run_hashes(np.concatenate([values, values[50:150]]), least)
        assert len(hashes) == 300 - least + 1 and len(np.unique(hashes)) == 200 - least + 1 + least - 1
        assert (hashes[200 : 300 - least + 1] == hashes[50 : 150 - least + 1]).all()
    assert all(len(windows.run_hashes(values[:n], 46)) == 0 for n in range(46))


def test_most_edited_passages_at_the_least_similarity_are_found(documents):
    rows = []
    for k in range(300):
        words = prose(60000 + k, 50, 100000).split()
        rows.append((2 * k, " ".join([prose(70000 + k, 30, 100000), *words, prose(80000 + k, 30, 100000)])))
        words[24] = "changed"
        rows.append((2 * k + 1, " ".join([prose(90000 + k, 30, 100000), *words, prose(95000 + k, 30, 100000)])))
    got = {tuple(sorted((r["doc_id"], r["other_id"]))) for r in windows.repeated_passages(documents(rows)).collect()}
    found = sum((2 * k, 2 * k + 1) in got for k in range(300))
    assert found >= 294


def test_a_document_wanted_by_many_is_cut(spark):
    wanted = spark.range(5000).selectExpr("cast(id % 3 = 0 as long) as doc", "id as pair", "0 as side", "id as start", "id + 60 as stop")
    rows = windows._by_document(wanted, ["pair", "side", "start", "stop"], chunk=64).collect()
    assert max(len(r["wanted"]) for r in rows) < 128
    assert sorted((r["doc"], w["pair"]) for r in rows for w in r["wanted"]) == sorted((int(i % 3 == 0), i) for i in range(5000))


def test_ranks_file_is_read_whole():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        assert bpe.read_ranks(path) == {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
