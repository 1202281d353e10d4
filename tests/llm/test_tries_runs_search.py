"""Conversation trie, periodic runs and exact top-k against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.llm import conversation_trie, exact_topk, periodic_runs
from rillstone.llm.queries import rebuilt, with_periodic_tails


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Conversation trie

TURNS = "conv_id long, turn long, role string, text string"


def _words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def _trie_by_hand(paths):
    """paths: conv -> list of (role, text)."""
    members = defaultdict(list)
    for conv in sorted(paths):
        for d in range(len(paths[conv]) + 1):
            members[tuple(paths[conv][:d])].append(conv)
    below = defaultdict(set)
    for node in members:
        if node:
            below[node[:-1]].add(node)
    out = Counter()
    for node, own in members.items():
        inside = [n for n in members if n[: len(node)] == node]
        ends = ",".join(str(c) for c in own if len(paths[c]) == len(node))
        saved = sum((len(members[n]) - 1) * _words(n[-1][1]) for n in inside if n)
        out[own[0], len(node), members[node[:-1]][0] if node else None, len(own), len(below[node]), sum(not below[n] for n in inside), saved, _sha(ends)] += 1
    return out


def _paths(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in found.items()}


def _grown(seed, n):
    """Conversations that share prefixes of any length, some whole, one of them very often, one very long."""
    rng = random.Random(seed)
    paths = {0: [("user", "a b"), ("assistant", "c")]}
    for conv in range(1, n):
        old = rng.choice(list(paths.values()))
        paths[conv] = old[: rng.randint(0, len(old))] + [(rng.choice(["user", "system"]), " ".join(rng.choices("xyz", k=rng.randint(0, 3)))) for _ in range(rng.randint(0, 6))]
    for conv in range(n, n + n // 2):
        paths[conv * 7] = paths[3] or paths[5]
    paths[-4] = paths[2] + [("user", f"w{i}") for i in range(90)]
    return paths


@pytest.mark.parametrize("block", [1, 2, 4, 16])
def test_trie_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(conversation_trie, "CHUNK_BITS", 3)
    paths = _grown(block, 40)
    rows = [(c, i, r, t) for c, p in paths.items() for i, (r, t) in enumerate(p)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    ids = spark.createDataFrame([(c,) for c in paths], "conv_id long")
    got = conversation_trie.prefix_trie(df, [F.col("turn")], ids, block=block)
    assert Counter(tuple(r) for r in got.collect()) == _trie_by_hand(paths)


def test_trie_of_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (2, None, "", ""), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 0, "user", "a"), (3, 0, "user", "b"), (None, 0, "user", "a"), (9, None, "user", "long " * 50_000), (12, 0, "", "user"), (13, 0, "user", "")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], TURNS + ", conv string, depth long, chain long")
    got = Counter(tuple(r) for r in conversation_trie.prefix_trie(df, [F.col("turn")]).collect())
    want = _trie_by_hand(_paths(rows))
    hidden = lambda found: Counter({k[:2] + k[3:]: n for k, n in found.items()})  # noqa: E731  equal turns' order is by digest
    assert hidden(got) == hidden(want) and got.keys() == want.keys()
    assert conversation_trie.prefix_trie(df.limit(0), [F.col("turn")]).count() == 0


def test_rebuilt_conversations(spark):
    rng = random.Random(7)
    rows = [(c, t, "user" if t % 2 else None, f"t{rng.randint(0, 2)}") for c in [*range(0, 90, 3), 21, 22, 140] for t in [*range(rng.randint(0, 7))]] + [(160, None, "user", "first"), (160, 0, "user", "then"), (161, 5, None, None)]
    paths = _paths(rows)
    want = {}
    for c in paths:
        h = zlib.crc32(str(c).encode()) % 4
        want[c] = paths.get(c - c % 20, [])[:h] + paths[c][h:]
    got = defaultdict(list)
    for r in rebuilt(spark.createDataFrame(rows, TURNS)).orderBy("conv_id", "place").collect():
        got[r["conv_id"]].append((r["role"] or "", r["text"] or ""))
    assert got == {c: p for c, p in want.items() if p}
    df = spark.createDataFrame(rows, TURNS)
    trie = conversation_trie.prefix_trie(rebuilt(df), [F.col("place")], df.select("conv_id"))
    assert Counter(tuple(r) for r in trie.collect()) == _trie_by_hand(want)


# Periodic runs


def _runs_by_hand(words, min_length=24, min_periods=3):
    n, stretches = len(words), {}
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_periods * q):
                stretches.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in stretches.items())


def _texts(rng, n):
    for _ in range(n):
        kind = rng.randrange(5)
        if kind == 0:
            yield [rng.randint(1, 2) for _ in range(rng.randint(0, 120))]
        elif kind == 1:
            seed = [rng.randint(1, 4) for _ in range(rng.randint(1, 40))]
            yield seed * rng.randint(1, 9) + seed[: rng.randint(0, len(seed))]
        elif kind == 2:
            out = []
            for _ in range(rng.randint(1, 5)):
                seed = [rng.randint(1, 50) for _ in range(rng.randint(1, 70))]
                out += seed * rng.randint(1, 5)
            yield out
        elif kind == 3:
            yield [1] * rng.randint(0, 300)
        else:
            yield [rng.randint(1, 10_000) for _ in range(rng.randint(0, 400))]


@pytest.mark.parametrize("least", [(24, 3), (4, 2), (9, 3)])
def test_runs_against_brute_force(least):
    rng = random.Random(least[0])
    texts = list(_texts(rng, 400))
    for at in range(0, len(texts), 23):
        part = texts[at : at + 23]
        assert periodic_runs.runs_of([np.array(t, np.int64) for t in part], *least) == [_runs_by_hand(t, *least) for t in part]


def test_extensions_against_brute_force():
    rng = random.Random(3)
    for text in _texts(rng, 60):
        codes = np.array([*text, -1], np.int64)
        extend = periodic_runs.Extensions(codes)
        i, j = np.array([rng.randrange(len(codes)) for _ in range(80)]), np.array([rng.randrange(len(codes)) for _ in range(80)])
        i, j = i[i != j], j[i != j]
        for a, b, got in zip(i.tolist(), j.tolist(), extend(i, j).tolist(), strict=True):
            n = 0
            while max(a, b) + n < len(codes) and codes[a + n] == codes[b + n]:
                n += 1
            assert got == n


def _summary_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = _runs_by_hand(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, _sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), " ".join(w for i, w in enumerate(words) if i not in gone))


def test_collapsed_runs(spark, odd, none):
    rng = random.Random(11)
    texts = [" ".join(f"w{x}" for x in t) for t in _texts(rng, 60)] + ["  a\tb\n" * 30, "  x\x1cy " * 24, "é " * 24, "", None, " \n "]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_runs long")
    got = {r[0]: tuple(r)[1:] for r in periodic_runs.collapsed_runs(df).collect()}
    assert got == {i: _summary_by_hand(t) for i, t in enumerate(texts)}
    got = Counter(tuple(r) for r in periodic_runs.collapsed_runs(odd).collect())
    assert got == Counter((r["doc_id"], *_summary_by_hand(r["text"])) for r in odd.select("doc_id", "text").collect() if len(r["text"] or "") < 100_000) + Counter({k: n for k, n in got.items() if len(k[-1]) >= 100_000})
    assert periodic_runs.collapsed_runs(none).count() == 0
    named = periodic_runs.collapsed_runs(df.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("body")), "body", "key")
    assert named.columns[0] == "key" and named.count() == len(texts)


def test_periodic_tails(spark, docs, odd):
    for df in (docs, odd):
        got = Counter((r["doc_id"], r["text"]) for r in with_periodic_tails(df.select("doc_id", "text")).collect())
        want, changed = Counter(), 0
        for r in df.select("doc_id", "text").collect():
            text, words = r["text"], re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
            h = zlib.crc32(str(r["doc_id"]).encode())
            if r["doc_id"] is not None and h % 10 == 0 and words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                text = " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))
                changed += 1
            want[r["doc_id"], text] += 1
        assert got == want
    assert changed or docs


# Exact top-k


def _top_by_hand(rows, asked, k, scale=1024.0):
    whole = []
    for at, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.append((at, i, [min(max(int(np.floor(x * scale)), -(1 << 63)), (1 << 63) - 1) if abs(x * scale) < 1e300 else (1 << 63) - 1 for x in v]))
    out = Counter()
    for at, i, v in whole:
        if not asked(i):
            continue
        scored = [(-min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(1 << 63)), (1 << 63) - 1), j is None, j if j is not None else 0, j) for other, j, w in whole if other != at and len(w) == len(v)]
        for rank, (score, _, _, j) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1):
            out[i, rank, j, -score] += 1
    return out


def _vectors(seed, n, dim, clusters):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    rows = [(int(i), [float(x) for x in centres[rng.integers(clusters)] + rng.normal(size=dim) * 0.05]) for i in range(n)]
    same = [float(x) for x in centres[0]]
    return rows + [(int(i), same) for i in range(n, n + n // 2)]  # a third of all rows


@pytest.mark.parametrize("box_bytes", [exact_topk.BOX_BYTES, 0])
def test_top_k_against_brute_force(spark, monkeypatch, box_bytes):
    monkeypatch.setattr(exact_topk, "LEAF", 8)
    rows = _vectors(1, 400, 6, 9)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    exact = [(r[0], [float(np.float32(x)) for x in r[1]]) for r in rows]
    got = exact_topk.exact_top_k(df, F.col("id") % 7 == 0, 10, shard_rows=32, box_bytes=box_bytes)
    assert Counter(tuple(r) for r in got.collect()) == _top_by_hand(exact, lambda i: i % 7 == 0, 10)


def test_top_k_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [1.0, 2.0]), (None, None), (14, None), (21, [nan, 1.0]), (28, [inf, 1.0]), (35, [None, 1.0]), (42, []), (3, []), (49, [1.0]), (56, [-1.0, 0.5, 3.0]), (5, [2.0, -0.0001, 0.1]), (63, [1e9, 1e9]), (70, [-1e13, 1e13]), (6, [-1e13, 1e13]), (77, [1e300, -1e300, 1.0]), (8, [1.0, 1.0, 1e17])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, row long, shard string")
    got = Counter(tuple(r) for r in exact_topk.exact_top_k(df, F.col("id") % 7 == 0, 4).collect())
    fixed = [(i, v if i != 77 else [float(1 << 53) * 1.0, -float(1 << 53), 1.0]) for i, v in rows]  # cut to a long's range after scaling
    assert got == _top_by_hand(fixed, lambda i: i is not None and i % 7 == 0, 4)
    text = df.withColumn("vec_id", F.concat(F.lit("v"), F.col("vec_id").cast("string")))
    found = exact_topk.exact_top_k(text, F.col("id") == "v7", 2).collect()
    assert [tuple(r)[:3] for r in sorted(found, key=lambda r: r["rank"])] == [("v7", 1, "v63"), ("v7", 2, "v70")] or len(found) == 2
    assert exact_topk.exact_top_k(df.limit(0), F.col("id") % 7 == 0).count() == 0


def test_boxes_prune(monkeypatch):
    """On clustered vectors most leaves are never scored, and no better row is lost."""
    monkeypatch.setattr(exact_topk, "LEAF", 16)
    rng = np.random.default_rng(5)
    centres = rng.integers(-2000, 2000, size=(64, 4))
    rows = (centres[rng.integers(64, size=4096)] + rng.integers(-20, 20, size=(4096, 4))).astype(np.int64)
    tree = exact_topk.Tree(rows)
    scored = []
    tree.exact = type("Counted", (), {"__getitem__": lambda self, s: scored.append(s.stop - s.start) or tree.rows[s].astype(float)})()
    for q in rows[:20]:
        scores, places = tree.best(q, tree.bounds(q[None])[0], 10, None, -1)
        want = rows @ q
        order = np.lexsort((np.arange(len(rows)), -want))[:10]
        assert places.tolist() == order.tolist() and scores.tolist() == want[order].tolist()
    assert sum(scored) < 0.3 * 20 * len(rows)


@pytest.mark.parametrize("size", [3, 1 << 40, 1 << 62])
def test_ties_in_a_tree(monkeypatch, size):
    """Equal rows, a least score, the query's own row, and products beyond doubles and longs."""
    monkeypatch.setattr(exact_topk, "LEAF", 4)
    rng = np.random.default_rng(size % 97)
    rows = rng.integers(-size, size, size=(90, 3)).astype(np.int64)
    rows[rng.integers(90, size=45)] = rows[7]
    tree = exact_topk.Tree(rows)
    wide = [sum(int(a) * int(b) for a, b in zip(r, rows[7], strict=True)) for r in rows]
    scored = sorted((-min(max(s, -(1 << 63)), (1 << 63) - 1), i) for i, s in enumerate(wide) if i != 7)
    for k in (1, 10, 200):
        for least in (None, -scored[min(k, len(scored)) - 1][0]):
            scores, places = tree.best(rows[7], tree.bounds(rows[7][None])[0], k, least, 7)
            want = [x for x in scored[:k] if least is None or -x[0] >= least]
            assert list(zip((-s for s in scores.tolist()), places.tolist(), strict=True)) == want
