"""Fill-in-middle, the similarity join and conversation repair against brute force and odd rows."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabveil.llm import conversations, fill_middle, jaccard_join

DOCS = "doc_id long, text string, row string, mark string, body string, n string, form string, node string"
LONG = "é \U0001f600 ﬁ\n" * 40_000 + "x" * 300_000
ODD = [
    (1, "a b c d e f g h i j k l", "x", "y", "z", "n", "f", "o"), (1, "a b c d e f g h i j k l", "x", "y", "z", "n", "f", "o"),
    (2, "A b c d e f g h i j k l\n\nm", None, None, None, None, None, None), (3, None, "x", "y", "z", "n", "f", "o"),
    (4, "", "x", "y", "z", "n", "f", "o"), (5, " \n\t", "x", "y", "z", "n", "f", "o"), (None, "a b c d e f g h i j k m", "x", "y", "z", "n", "f", "o"),
    (6, LONG, "x", "y", "z", "n", "f", "o"), (6, "another\r\ntext\nof $1 the \\2 same id\n", "x", "y", "z", "n", "f", "o"),
    (7, "one", "x", "y", "z", "n", "f", "o"), (8, "one", "x", "y", "z", "n", "f", "o"), (9, "has <S> in it\nand more", "x", "y", "z", "n", "f", "o"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def middle(key, text, percent=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return len(units), "plain", text, None, None
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return len(units), "spm" if h4 % 100 < spm else "psm", out, len(p), len(m)


def test_middles_equal_slices_of_units(spark, odd, folder):
    corpus = spark.read.parquet(f"{folder}/documents.parquet")
    for docs, percent in ((odd, 100), (corpus, 100), (corpus, 40)):
        made = fill_middle.fill_in_middle(docs, percent=percent)
        got = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
        want = [middle(r["doc_id"], r["text"], percent) for r in docs.collect()]
        assert Counter((r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"]) for r in got) == Counter(want)
        assert all(r["back"] == (r["row"]["text"] or "") for r in got)
    assert {f for _, f, *_ in want} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(odd.limit(0)).count() == 0


def test_markers_are_told_apart(odd):
    for markers in (("<P>", "P>", "<M>"), ("aa", "b", "c"), ("ab", "ca", "d"), ("", "b", "c")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(odd, markers=markers)
    markers = ("[$1]", "[.*]", "[\\E]")
    made = fill_middle.fill_in_middle(odd, markers=markers)
    back = made.select(F.col("row.text").alias("t"), fill_middle.restored(F.col("output"), F.col("form"), markers).alias("b"), "form").collect()
    assert all(r["b"] == (r["t"] or "") for r in back) and sum(r["form"] != "plain" for r in back) > 5


def shingles(text, size):
    w = (text or "").encode().lower().split()
    size = min(size, len(w))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()


def brute_join(rows, size, percent):
    sets = [(k, shingles(t, size)) for k, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            parent[root(i)] = root(j)
    low = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return Counter((k, len(s), low.get(root(i)) if s else k) for i, (k, s) in enumerate(sets))


def joined(docs, **more):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.similar_documents(docs, **more).collect())


def near_texts():
    """Groups around 0.8: an original, copies with some words changed, copies of copies, and a shared passage."""
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(40))
    rows, k = [], 0
    for group in range(6):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(90 + 40 * group)]
        texts = [base]
        for _ in range(25):
            t = list(rng.choice(texts))
            for _ in range(rng.randrange(6)):
                t[rng.randrange(len(t))] = f"x{rng.randrange(10 ** 6)}"
            texts.append(t[: len(t) - rng.randrange(8)])
        for t in texts:
            k += 1
            rows.append((k, " ".join(t) + (f" {passage}" if rng.random() < 0.5 else "")))
    return rows + [(k, t) for k, t in rows[::9]] + [(1000 + i, " ".join(f"w{i}" for i in range(n))) for i, n in enumerate((1, 2, 4, 5, 6, 7, 8, 9, 10, 11))]


def test_join_equals_all_pairs(spark, odd, folder, monkeypatch):
    assert joined(odd) == brute_join([(r[0], r[1]) for r in ODD], 5, 80)
    rows = near_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Many blocks, each divided by its members.
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 3)
    monkeypatch.setattr(jaccard_join, "GROUP_MEMBERS", 7)
    assert joined(docs) == brute_join(rows, 5, 80)
    corpus = spark.read.parquet(f"{folder}/documents.parquet")
    assert joined(corpus) == brute_join([(r["doc_id"], r["text"]) for r in corpus.collect()], 5, 80)
    assert joined(odd.limit(0)) == Counter()


def test_merge_skips_nothing():
    rng = np.random.default_rng(1)
    for _ in range(300):
        lists = [np.unique(rng.integers(0, 40, rng.integers(0, 30))) for _ in range(rng.integers(1, 9))]
        counts = Counter(int(x) for one in lists for x in one)
        for least in range(1, 6):
            assert dict(jaccard_join.merged(lists, least)) == {k: c for k, c in counts.items() if c >= least}


def test_least_occurrences_lose_no_pair():
    # Else a partner could be in none of a set's short lists.
    for n in range(1, 400):
        assert jaccard_join.least_occurrences(n, 80) >= 1


def cheapest(rows):
    """Shortest path over (rows read, roles so far as one state), by (cost, initials): independent of the parser."""
    def moves(state, role):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, role))

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, made = heapq.heappop(heap)
        if at == len(rows) and state in ("", "a"):
            return cost, audit, made
        if (cost, audit, at, state) in done or cost > 5 * len(rows) + 10:
            continue
        done.add((cost, audit, at, state))
        for r, name in (("u", "user"), ("a", "assistant")):
            if (to := moves(state, r)) is not None:
                heapq.heappush(heap, (cost + 5, audit + "I", at, to, (*made, f"{name}:")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, made))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if (to := moves(state, role[:1])) is not None:
                heapq.heappush(heap, (cost + extra, audit + "K", at + 1, to, (*made, f"{role}:{text}")))
            for r, name in (("u", "user"), ("a", "assistant")):
                if (to := moves(state, r)) is not None:
                    heapq.heappush(heap, (cost + 1 + extra, audit + "R", at + 1, to, (*made, f"{name}:{text}")))


def brute_repair(rows):
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of rows (conv, turn, role, text, times)."""
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        own = [r for r in own for _ in range(r[4])]
        seen, faults = set(), []
        for _, _, role, text, _ in own:
            solid = re.sub("[ \t-\r]", "", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        known = [r[1] for r in own if r[1] is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        cost, audit, made = cheapest([(r[2], r[3], f) for r, f in zip(own, faults)])
        out.append((
            conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(made).encode()).hexdigest(),
        ))
    return Counter(out)


ROWS = "conv long, turn long, role string, text string, times int"


def test_repair_is_the_cheapest(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for conv in range(220):
        for turn in range(rng.choice((0, 1, 2, 3, 4, 5, 6, 7))):
            role = rng.choice(("user", "assistant", "user", "assistant", "system", "tool", " ", ""))
            text = rng.choice(("Yes.", "No!", "Cut", "", " \n", f"Text {rng.randrange(3)}?", f"Text {turn}.\n", "Cut and\nmore"))
            rows.append((conv, 2 * turn if rng.random() < 0.2 else turn, role, text, rng.choice((1, 1, 1, 1, 0, 2))))
        rows = list({(r[0], r[1]): r for r in rows}.values())
        rows.append((conv, None, "user", "Null turn.", rng.choice((0, 1))))
    rows += [(None, t, "user", f"{t}.", 1) for t in range(4)]
    want = brute_repair(rows)
    for bits in (10, 1, 0):
        monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
        made = conversations.with_digests(*conversations.repair(spark.createDataFrame(rows, ROWS)))
        assert Counter(tuple(r) for r in made.collect()) == want


def test_one_conversation_of_many_rows(spark, monkeypatch):
    # One key with all rows, over many blocks; equal rows of one turn are one row with a number.
    rows = [(1, i // 2, "user" if i % 7 else "assistant", f"{i % 50}." if i % 3 else f"{i}.", 1) for i in range(600)]
    rows += [(1, 5000, "user", "The same.", 1)] * 300
    monkeypatch.setattr(conversations, "BLOCK_BITS", 4)
    repaired, report = conversations.repair(spark.createDataFrame(rows, ROWS))
    got = report.first()
    left = [r["role"][0] for r in repaired.orderBy("place").collect()]
    assert re.fullmatch("(s?(ua)+)?", "".join(left)) and len(left) == sum(x != "D" for x in got["audit"])
    monkeypatch.setattr(conversations, "BLOCK_BITS", 12)
    assert conversations.repair(spark.createDataFrame(rows, ROWS))[1].first() == got
    assert got["duplicate"] >= 299


def test_damage_and_odd_conversations(spark, folder):
    schema = "conv_id long, turn long, role string, text string, conv string, place string, audit string"
    odd = [(1, 0, None, None, "x", "y", "z"), (1, None, "user", "Hello.", "x", "y", "z"), (None, None, None, "", "x", "y", "z"), (2, 1, "user", "a " * 200_000 + ".", "x", "y", "z")]
    whole = spark.read.parquet(f"{folder}/conversations.parquet")
    for table in (spark.createDataFrame(odd, schema), whole):
        want = []
        for r in table.collect():
            conv, turn, role, text = (" " if r[c] is None else r[c] for c in ("conv_id", "turn", "role", "text"))
            fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            want.append((r["conv_id"], r["turn"], "user" if fault == 4 else role, text, {0: 0, 3: 2}.get(fault, 1)))
        rows = conversations.damaged(table, "conv_id", "turn", "role", "text")
        assert Counter(tuple(r) for r in rows.collect()) == Counter(want)
        made = conversations.with_digests(*conversations.repair(rows))
        assert Counter(tuple(r) for r in made.collect()) == brute_repair(want)
    plain = conversations.turns(whole)
    assert conversations.repair(plain)[1].count() == whole.select("conv_id").distinct().count()
    assert conversations.with_digests(*conversations.repair(plain.limit(0))).count() == 0
