"""Personal data, conversation repair and ranked search against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.llm import conversations as conv
from dockflow.llm.private import Disclosure, base_spans, private_report, private_spans, sanitised
from dockflow.llm.ranked import best_documents, search, treap

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# --- personal data -------------------------------------------------------------------------------------------------


def luhn(digits):
    doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def plain_spans(text):
    """Base spans by the expressions as they are given."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    found = [(m.start(), i, m.end()) for i, (_, rx, good) in enumerate(rules) for m in re.finditer(rx, text) if good(m)]
    return sorted(found)


KINDS = ("email", "ip", "card", "phone", "generalised", "removed")


def brute_private(texts, rule):
    """The method with dictionaries: [(start, kind, end)] of every text."""
    docs = []
    for text in texts:
        base = plain_spans(text or "")
        terms = [(m.start(), m.end(), lowered(m.group())) for m in TERM.finditer(text or "")]
        free = [t for t in terms if not any(t[0] < b and t[1] > a for a, _, b in base)]
        docs.append((text or "", base, terms, free))
    near, pairs = {}, {}
    for i, (text, base, _, free) in enumerate(docs):
        for a, kind, b in base:
            value = text[a:b]
            value = value.lower() if kind == 0 else value if kind == 1 else re.sub("[^0-9]", "", value)
            left, right = [t for t in free if t[1] <= a], [t for t in free if t[0] >= b]
            context = (tuple(t[2] for t in left[-2:]), tuple(t[2] for t in right[:2]))
            words = {t[2] for t in left[-rule.window :] + right[: rule.window]}
            for name in [None, *words, *((w[: rule.stem],) for w in words if len(w) > rule.stem)]:
                near.setdefault((i, kind, value, name), context)
    for (i, kind, value, name), context in near.items():
        pairs.setdefault(((kind, value), name), []).append((i, context))
    holds = {}
    for i, (_, _, terms, _) in enumerate(docs):
        words = {t[2] for t in terms}
        for name in words | {(w[: rule.stem],) for w in words if len(w) > rule.stem}:
            holds.setdefault(name, set()).add(i)
    told = set()
    for (entity, name), found in pairs.items():
        mentions = pairs[entity, None]
        if name is not None and len({c for _, c in found}) >= rule.contexts:
            content = math.log(len(docs) / len(mentions))
            pmi = math.log(len(docs) * len(found) / (len(mentions) * len(holds[name])))
            if pmi > 0 and pmi >= rule.share * content:
                told.add(name)
    out = []
    for _, base, _, free in docs:
        more = []
        for a, b, w in free:
            if w in told:
                more.append((a, 5 if len(w) <= rule.stem or (w[: rule.stem],) in told else 4, b))
        out.append(sorted(base + more))
    return out


SNIPPETS = [
    "a@b.c@d.example", "x.y+z@mail.example.org", "@no.example", "a@b", "1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1", "001.02.3.255", "4539 1488 0343 6467",
    "4539-1488-0343-6467", "4539148803436468", "5" * 40, "+49 (30) 123-456-78", "+1", "+12 34", "+" + "7" * 16, "é@é.é", "um+a@b-c.de.", "+4930 1234567 1.2.3.4",
]


def test_base_spans_are_those_of_the_expressions():
    pick = random.Random(3)
    texts = [*SNIPPETS, *("".join(pick.choice("a1 .@+-()2") for _ in range(pick.randrange(40))) for _ in range(4000))]
    texts += [pick.choice(["", " ", "x"]).join(pick.choices(SNIPPETS, k=4)) for _ in range(300)]
    for text in texts:
        data = text.encode()
        chars = [len(data[:x].decode(errors="ignore")) for x in range(len(data) + 1)]
        assert [(chars[a], k, chars[b]) for a, k, b in base_spans(data)] == plain_spans(text), text


@pytest.mark.parametrize("text", ["1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "a@" * 100_000, "+1 " * 60_000, "+1" + " " * 200_000, "1 " * 100_000])
def test_base_spans_take_linear_time(text):
    import time

    start = time.perf_counter()
    base_spans(text.encode())
    assert time.perf_counter() - start < 3


def mentioning(pick):
    """Texts in which some words always stand near one address, in different surroundings."""
    common = ["the", "of", "station", "über", "bike", "report", "said", "Was", "dock", "rain"]
    texts = []
    for i in range(60):
        words = pick.choices(common, k=pick.randrange(4, 30))
        if i % 6 == 0:
            at = pick.randrange(len(words))
            words[at:at] = pick.sample(["Zephyrine", "zep", "Quixby"], k=pick.randrange(1, 4)) + [pick.choice(["Ann@Home.example", "ann@home.example"])]
        elif i % 6 == 1:
            words.insert(pick.randrange(len(words)), pick.choice(["10.0.0.7", "+49 30 1234567", "4539 1488 0343 6467"]))
        elif i % 17 == 0:
            words.insert(0, pick.choice(["Zephyrine", "zephyrs", "Quixby"]))
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_revealing_terms_against_brute_force(spark, documents, seed):
    texts = mentioning(random.Random(seed)) + [None, "", "ann@home.example quixby " * 30]
    rule = Disclosure(share=0.8)
    rows = private_spans(documents(list(enumerate(texts))), rule).collect()
    found = {r.doc_id: [(s.start, KINDS.index(s.kind), s.end) for s in r.spans] for r in rows}
    want = brute_private(texts, rule)
    assert len(rows) == len(texts)
    assert [found[i] for i in range(len(texts))] == want
    assert {k for spans in want for _, k, _ in spans} >= {0, 1, 2, 3}
    assert any(k >= 4 for spans in want for _, k, _ in spans)


def test_copies_are_no_evidence(documents):
    copies = [(i, "write to Zephyrine at ann@home.example for more") for i in range(20)]
    spans = private_spans(documents(copies + [(99, "Zephyrine was here")])).collect()
    assert {s.kind for r in spans for s in r.spans} == {"email"}


def test_report_of_personal_data(documents):
    text = "é 1.2.3.4 or +49 30 1234567, ann@home.example"
    row = private_report(documents([(1, text)])).collect()[0]
    want = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(text))
    assert row.spans == want and row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 0, 1)


def test_sanitised_keeps_rows_and_columns(documents):
    names = ("row", "kept", "base", "hits", "spans", "term", "class", "start")
    rows = [(i, f"w{i} v{i} Zephyrine ann@home.example u{i} x{i}") for i in range(8)] + [(20, None), (20, ""), (None, "zephyrine")] + [(30 + i, "other") for i in range(40)]
    docs = documents(rows)
    for name in names:
        docs = docs.withColumn(name, F.lit("other"))
    docs = docs.withColumn("a.b", F.lit(1))
    out = sanitised(docs, Disclosure(contexts=3))
    assert out.columns == docs.columns
    texts = sorted((r.doc_id is None, r.doc_id or 0, str(r.text)) for r in out.collect())
    assert texts[0][2] == "w0 v0  [email] u0 x0"
    assert [t[2] for t in texts[8:10]] + [texts[-1][2]] == ["", "None", ""]
    assert sanitised(docs.limit(0)).count() == 0


# --- conversations -------------------------------------------------------------------------------------------------


def cheapest(symbols, entry=0):
    """(cost, audit) for each state after the rows, by dynamic programming over states."""

    def closed(now):
        while True:
            more = dict(now)
            for q, (cost, audit) in now.items():
                to, value = {0: 2, 1: 2, 2: 3, 3: 2}[q], (cost + 5, audit + "I")
                if to not in more or value < more[to]:
                    more[to] = value
            if more == now:
                return now
            now = more

    now = closed({entry: (0, "")})
    for c in symbols:
        after = {}
        for q, (cost, audit) in now.items():
            moves = [(cost + 2, audit + "D", q)]
            if c != "_":
                late = 5 if c.isupper() else 0
                if c.lower() in conv._NEXT[q]:
                    moves.append((cost + late, audit + "K", conv._NEXT[q][c.lower()]))
                moves.append((cost + late + 1, audit + "R", {0: 2, 1: 2, 2: 3, 3: 2}[q]))
            for spent, edits, to in moves:
                if to not in after or (spent, edits) < after[to]:
                    after[to] = (spent, edits)
        now = closed(after)
    return [now.get(q) for q in range(4)]


def test_search_proves_the_optimum_on_all_short_conversations():
    for n in range(4):
        for rows in itertools.product("suaxSUAX_", repeat=n):
            for entry in range(4):
                assert conv.search("".join(rows), entry) == cheapest(rows, entry)


def test_search_on_long_blocks():
    pick = random.Random(5)
    for _ in range(60):
        rows = "".join(pick.choices("uauauasxUAS_", k=pick.randrange(20, 65)))
        for entry in range(4):
            assert conv.search(rows, entry) == cheapest(rows, entry), rows


def test_bounds_never_exceed_the_cheapest_repair():
    for rows in itertools.product("suaxUA_", repeat=4):
        bounds = conv.suffix_bounds("".join(rows))
        for i in range(5):
            assert bounds[i] <= min(v[0] for e in range(4) for v in cheapest(rows[i:], e) if v)


def brute_report(rows):
    """{conv_id: report} of damaged rows (conv_id, turn, role, text)."""
    out = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1], r[2], r[3]))
        seen, symbols, counts, initials = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}, ""
        for _, _, role, text in mine:
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            symbols += "_" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
            initials += letter
        cost, audit = min(v for v in (cheapest(symbols)[0], cheapest(symbols)[3]) if v)
        turns = {t for _, t, _, _ in mine if t is not None}
        lines, state, left = [], 0, list(mine)
        for edit in audit:
            wanted = "assistant" if state == 2 else "user"
            if edit == "I":
                lines.append(f"{wanted}:")
            else:
                _, _, role, text = left.pop(0)
                if edit == "D":
                    continue
                lines.append(f"{role}:{text}" if edit == "K" else f"{wanted}:{text}")
                if edit == "K":
                    state = conv._NEXT[state][role[0]]
                    continue
            state = 3 if wanted == "assistant" else 2
        out[key] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts.values(),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def brute_damage(rows):
    out = []
    for key, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(key, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def random_turns(pick, conversations, longest):
    rows = []
    for key in [*range(conversations), None]:
        for turn in range(pick.randrange(1, longest)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = pick.choice(["Hello there.", "Why?", "no end", "", " \n\t", None, "éh!\x0b ", f"turn {turn}."])
            rows.append((key, pick.choice([turn, turn, turn, turn, None, turn + 3]), role, text))
    return rows


@pytest.mark.parametrize(("seed", "conversations", "longest"), [(1, 60, 9), (2, 3, 400)])
def test_repair_against_brute_force(spark, seed, conversations, longest):
    rows = random_turns(random.Random(seed), conversations, longest)
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.lit("x")).withColumn("audit", F.lit("y")).withColumn("_times", F.lit(1)).repartition(4)
    broken = conv.damaged(turns)
    assert sorted(map(str, (tuple(r) for r in broken.collect()))) == sorted(map(str, brute_damage(rows)))
    report = {r[0]: tuple(r)[1:9] for r in conv.repair_report(broken, turns).collect()}
    want = brute_report(brute_damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert report == {key: want.get(key, nothing) for key in {r[0] for r in rows}}


def test_a_conversation_over_many_blocks_and_tasks(spark):
    pick = random.Random(9)
    rows = [(7, i, pick.choice(["user", "assistant"]), pick.choice([f"t{i}.", f"t{i}", "same."])) for i in range(3000)]
    rows += [(8, i, "user", "again.") for i in range(1500)]
    report = {r.conv_id: tuple(r)[1:9] for r in conv.repair_report(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()}
    assert report == brute_report(rows)


def test_repaired_rows_follow_the_order_of_roles(spark):
    rows = random_turns(random.Random(4), 40, 9)
    out = conv.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    by = {}
    for r in sorted(out, key=lambda r: r.number):
        by.setdefault(r.conv_id, []).append(r.role[:1])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(roles)) for roles in by.values()) and len(by) > 20


def test_no_conversations(spark):
    assert conv.repair_report(spark.createDataFrame([], SCHEMA)).count() == 0


# --- ranked search -------------------------------------------------------------------------------------------------


def brute_ranked(docs, items, k):
    """[(item, rank, doc, score)] by the stated arithmetic."""
    terms = [[lowered(m.group()) for m in TERM.finditer(t or "")] for _, t in docs]
    full, words = sum(bool(t) for t in terms), sum(len(t) for t in terms)
    df = {}
    for t in terms:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for (doc, _), t in zip(docs, terms):
            score = 0
            for w in [lowered(m.group()) for m in TERM.finditer(text or "")]:
                if w in df and t:
                    weight = math.floor(1000 * math.log((2 * full + 2) / (2 * df[w] + 1)))
                    m, tf = 100 - 25 + 25 * len(t) * full // words, t.count(w)
                    score += weight * (1000000000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, doc is not None, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, doc) in enumerate(sorted(scores)[:k])]
    return out


def test_treap_holds_the_largest_impact_of_every_cell():
    rng = np.random.default_rng(1)
    rows, columns = np.divmod(rng.choice(37 * 50, 400, replace=False), 50)
    impacts = rng.integers(0, 1000, 400)
    tree = treap(rows, columns, impacts)
    assert tree.most[1] == impacts.max() and len(tree.mask) < 4 * 64 * 64 // 3
    grid = np.zeros((64, 64), np.int64)
    grid[rows, columns] = impacts
    for row in range(37):
        found, scores = search(tree, np.array([row]), np.array([2]), 5, batch=3)
        want = grid[row] * 2
        assert (want[found] == scores).all()
        assert set(np.flatnonzero((want > 0) & (want >= np.sort(want)[-5]))) == set(found)


def test_treap_of_nothing():
    none = np.zeros(0, np.int64)
    assert len(search(treap(none, none, none), np.array([0]), np.array([1]), 5)[0]) == 0


@pytest.mark.parametrize("seed", range(2))
def test_search_against_brute_force(spark, documents, seed):
    pick = random.Random(seed)
    words = ["a", "B", "über", "dock", "bike", "rain", "x1", "zz", "Ünit", "the", "The"]
    docs = [(i if i % 50 else None, " ".join(pick.choices(words, weights=range(1, 12), k=pick.randrange(0, 40)))) for i in range(400)]
    docs += [(1000 + i, "same dock text") for i in range(30)] + [(2000, None), (2000, "..., "), (2001, "bike " * 5000), (7, "dock"), (7, "dock")]
    items = [(i, " ".join(pick.choices([*words, "absent"], k=pick.randrange(1, 8)))) for i in range(12)] + [(50, None), (51, "absent"), (3, "dock dock"), (None, "rain")]
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    for columns, block in ((64, 1 << 18), (4096, 20)):
        got = [tuple(r) for r in best_documents(documents(docs), asked, 7, columns, block).collect()]
        assert sorted(got, key=str) == sorted(brute_ranked(docs, items, 7), key=str)


def test_search_without_documents_or_items(spark, documents):
    asked = spark.createDataFrame([(1, "dock")], "item_id bigint, text string")
    assert best_documents(documents([(1, None)]).limit(0), asked).count() == 0
    assert best_documents(documents([(1, "dock")]), asked.limit(0)).count() == 0
    assert best_documents(documents([(1, "..."), (2, None)]), asked).count() == 0
