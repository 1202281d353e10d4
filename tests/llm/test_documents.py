"""Operators over documents: brute force on small tables, defined results for odd rows."""

from __future__ import annotations

import hashlib
import itertools
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillstone.llm import decontam, line_dedup, media, near_dedup, packing, pii, sharding, suffix_dedup, toxicity
from rillstone.llm._common import scratch_dir
from rillstone.llm.components import components
from rillstone.llm.queries import QUERIES, VOCABULARY

from .conftest import SF


def _utf8(text):
    return (text or "").encode()


# Line dedup


def _lines_by_hand(rows, min_docs):
    keys = Counter(k for _, t in rows for k in {line_dedup.line_key(x) for x in _utf8(t).split(b"\n")} if k)
    out = []
    for i, t in rows:
        lines = _utf8(t).split(b"\n")
        kept = [x for x in lines if keys[line_dedup.line_key(x)] < min_docs]
        out.append((i, b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
    return Counter(out)


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_KEY_BYTES, 0])
@pytest.mark.parametrize("which", ["docs", "odd"])
def test_line_dedup(request, which, limit):
    df = request.getfixturevalue(which)
    got = Counter(tuple(r) for r in line_dedup.drop_repeated_lines(df, min_docs=3, broadcast_bytes=limit).collect())
    assert got == _lines_by_hand([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], 3)


def test_line_dedup_keeps_the_first(spark):
    df = spark.createDataFrame([(2, "A\nx\na "), (1, "b\n a\na"), (3, "a")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(df, min_docs=2, keep_first=True).collect()}
    assert got == {1: "b\n a", 2: "x", 3: ""}


def test_line_dedup_full_filter_is_exact(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "MIN_FILTER_BITS", 1 << 10)
    monkeypatch.setattr(line_dedup, "LINES_PER_DOCUMENT", 0)
    monkeypatch.setattr(line_dedup, "CHUNK_BYTES", 1 << 7)
    got = Counter(tuple(r) for r in line_dedup.drop_repeated_lines(docs, min_docs=3).collect())
    assert got == _lines_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()], 3)


@pytest.mark.parametrize("bits", [1 << 10, 1 << 20])
def test_line_dedup_by_ranges_of_hashes(docs, monkeypatch, bits):
    """Beyond the largest filter: each range of hashes has its own, full ones included."""
    monkeypatch.setattr(line_dedup, "MAX_FILTER_BITS", 1 << 10)
    monkeypatch.setattr(line_dedup, "RANGE_BITS", bits)
    got = Counter(tuple(r) for r in line_dedup.drop_repeated_lines(docs, min_docs=3).collect())
    assert got == _lines_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()], 3)


def test_line_dedup_sends_suspects_alone(docs):
    """By ranges of hashes too, the keys that leave a task are those that more than one document has, and few others."""
    texts = [_utf8(r["text"]) for r in docs.collect()]
    keys = Counter(k for t in texts for k in {line_dedup.line_key(x) for x in t.split(b"\n")} if k)
    suspects = line_dedup.range_suspects(docs, "text", 4)
    found = {bytes(r["key"]): r["n"] for r in line_dedup._by_key(docs.coalesce(1), "doc_id", "text", 1, line_dedup.suspects_filter(suspects, 1 << 20)).groupBy("key").agg(F.sum("n").alias("n")).collect()}
    repeated = {k: n for k, n in keys.items() if n > 1}
    assert {k: n for k, n in found.items() if n > 1} == repeated and len(found) <= len(repeated) + 0.01 * len(keys)


def test_line_dedup_keeps_other_columns(odd, docs):
    got = line_dedup.without_repeated_lines(odd.withColumns({"n_lines": F.lit(1), "row": F.lit("r")}), min_docs=3)
    assert got.columns == [*odd.columns, "n_lines", "row"]
    assert Counter(r["text"] for r in got.collect()) == Counter(t for (_, t, _, _), n in _lines_by_hand([(r["doc_id"], r["text"]) for r in odd.collect()], 3).items() for _ in range(n))
    texts = line_dedup.drop_repeated_lines(docs.withColumn("doc_id", F.col("doc_id").cast("string")), min_docs=3)
    assert texts.schema["doc_id"].dataType.simpleString() == "string" and texts.count() == docs.count()


# Packing


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(3)
    for capacity in (7, 40, 128):
        lengths = rng.integers(1, capacity + 1, 900)
        free: list[int] = []
        for x in sorted(lengths, reverse=True):
            k = min((i for i, f in enumerate(free) if f >= x), key=lambda i: free[i], default=None)
            if k is None:
                free.append(capacity - x)
            else:
                free[k] -= x
        plan = packing.best_fit_plan(dict(Counter(lengths.tolist())), capacity)
        used = defaultdict(list)
        for length, a, b, first, each, offset in plan:
            for r in range(b - a):
                used[first + r // each].append((offset + r % each * length, length))
        assert len(used) == len(free)
        for slots in used.values():
            at = 0
            for offset, length in sorted(slots):
                assert offset == at
                at += length
            assert at <= capacity
        assert Counter(x for s in used.values() for _, x in s) == Counter(lengths.tolist())


def test_word_encoder_equals_the_tokenizer(docs):
    encoder = packing.WordEncoder(VOCABULARY)
    odd = ["It's a TEST. don't, ÉTÉ. İstanbul ΣΑΣ. x<|endoftext|>. a).b!? <|ENDOFTEXT|> 1,234.5 ́a é. \tq\r\n z  'S o'clock.' ''re, ﬁ² Ⅷ. x̀, 中文,字。", "", " ", "\n\n", "...", "I'LL. 'll's"]
    odd += ["".join(np.random.default_rng(i).choice(list("aB'.,s t\n<|é́!1Σ²I"), 60)) for i in range(300)]
    texts = odd + [r["text"] for r in docs.collect()] + [None]
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packed_documents(request, which, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", 20)
    df = request.getfixturevalue(which)
    rows = packing.pack_documents(df, VOCABULARY).collect()
    tokenizer = packing.WordEncoder(VOCABULARY).tokenizer
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        for p, a in enumerate(range(0, len(ids), 2048)):
            want[r["doc_id"], p, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    used = defaultdict(list)
    for r in rows:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(used) <= 1.1 * sum(r["length"] for r in rows) / 2048 + 1


# Media


def test_interleaved_html():
    items = media.interleaved('<p>One &amp; two<img src="media:ab" alt="x">three</p><script>no</script><figure><img src="media:cd"><figcaption>A <b>cap</b></figcaption></figure><p>four<p>')
    assert [(i["position"], i["kind"], i["text"], i["digest"], i["caption"]) for i in items] == [(0, "text", "One & two", None, None), (1, "media", None, "ab", "x"), (2, "text", "three", None, None), (3, "media", None, "cd", "A cap"), (4, "text", "four", None, None)]
    assert media.interleaved(None) == []
    assert [(i["kind"], i["digest"]) for i in media.interleaved('<figure><img src="media:x"><figcaption>left open')] == [("media", "x")]


def test_resolve_keeps_order_and_unknown_digests(spark):
    pages = spark.createDataFrame([(1, 0, '<p>a</p><img src="media:d1" alt="c1"><p>b</p><img src="media:nope"><img src="media:d1" alt="c2">')], "page long, lane int, html string")
    stored = spark.createDataFrame([("d1", 0, 7)], "digest string, lane int, size int")
    got = media.resolve(media.parse_sequences(pages, "html", "page", "lane"), stored, "page").orderBy("position").collect()
    assert [(r["position"], r["kind"], r["text"], r["caption"], r["size"]) for r in got] == [(0, "text", "a", None, None), (1, "media", None, "c1", 7), (2, "text", "b", None, None), (3, "media", None, None, None), (4, "media", None, "c2", 7)]


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_document_media(request, which):
    df = request.getfixturevalue(which)
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        b = _utf8(r["text"])
        p = b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
        image = b"P5\n64 %d\n255\n" % (len(p) // 64) + p
        first, _, rest = (r["text"] or "").partition("\n")
        texts = [" ".join(t.split()) for t in (first, rest) if t.split()]
        want[r["doc_id"], len(b), 1 if first.split() else 0, "text as samples", len(texts), hashlib.sha256("\n".join(texts).encode()).hexdigest(), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(image), hashlib.sha256(image).hexdigest(), media.feature(p)] += 1
    assert Counter(tuple(r) for r in media.document_media(df).collect()) == want


# PII

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(d):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def _base_by_hand(text):
    out = []
    for i, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")), "card": lambda: 14 <= len(d) <= 19 and _luhn(d), "phone": lambda: 10 <= len(d) <= 15}[kind]():  # noqa: B023
                out.append((m.start(), i, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_base_spans(spark, docs, odd):
    rng = np.random.default_rng(5)
    hard = [(i, "".join(rng.choice(list("ab.@-+%1 2(9)é\n0 +.4"), 200))) for i in range(200)]
    hard += [(1000, "a@b.c%d@e.f 1.2.3.4.5.6.7.8"), (1001, "1.1.1.1 " * 3000), (1002, "@" * 3000 + "a@" + "b." * 20_000 + "c"), (1003, "9" * 50_000), (1004, "a" * 50_000 + "@")]
    df = docs.select("doc_id", "text").union(odd.select("doc_id", "text")).union(spark.createDataFrame(hard, "doc_id long, text string"))
    got = Counter((r["doc_id"], r["s"]) for r in pii.pii_spans(df).select("doc_id", pii.written(F.col("base")).alias("s")).collect())
    assert got == Counter((r["doc_id"], _base_by_hand(r["text"])) for r in df.collect())


def _with_check_digit(rng, n):
    d = rng.integers(1, 10, n - 1).tolist()
    return "".join(map(str, d)) + next(str(c) for c in range(10) if _luhn("".join(map(str, d)) + str(c)))


def test_added_spans_and_redaction(spark):
    """Planted spans that no base pattern finds: cards written with dots, addresses with (at), IPs with [.]. Runs of digits
    that are no cards, and versions of programs, look otherwise and stay."""
    rng = np.random.default_rng(6)
    rows, planted = [], {}
    for i in range(900):
        card, octets, name = _with_check_digit(rng, 16), rng.integers(1, 255, 4).tolist(), f"user{i}"
        said = {0: f"card {card} paid", 1: f"card {'.'.join(card[k : k + 4] for k in range(0, 16, 4))} paid", 2: f"mail {name}@mail.example.com now", 3: f"mail {name} (at) mail.example.com now", 4: f"host {'.'.join(map(str, octets))} up", 5: f"host {'[.]'.join(map(str, octets))} up", 6: f"batch {rng.integers(10**11, 10**12)} of goods", 7: f"see v{i % 9}.{i % 7}.0 of it or ask me{i}@home", 8: f"call tel +1 (988) 555-{1000 + i} now"}[i % 9]
        rows.append((i, said))
        planted[i] = {1: "card", 3: "email", 5: "ip"}.get(i % 9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = pii.pii_spans(df)
    got = {r["doc_id"]: (r["b"], r["a"]) for r in spans.select("doc_id", pii.written(F.col("base")).alias("b"), pii.written(F.col("added")).alias("a")).collect()}
    found = [i for i, kind in planted.items() if kind and got[i][1].startswith(kind)]
    assert len(found) >= 0.9 * sum(k is not None for k in planted.values())
    assert all(got[i][0] == "" for i in found)
    assert sum(bool(got[i][1]) for i, kind in planted.items() if kind is None) <= 0.02 * len(rows)
    text = df.join(spans, "doc_id").filter("doc_id in (1, 8)").orderBy("doc_id").select(pii.redacted(F.col("text"), F.concat("base", "added")).alias("t")).collect()
    assert [r["t"] for r in text] == ["card [card] paid", "call tel [phone] now"]


def test_phones_are_added(spark):
    """Ninety phones of a form that no base pattern finds, beside order numbers."""
    rng = np.random.default_rng(4)
    rows = [(i, f"reach +{rng.integers(10, 99)}/{rng.integers(100, 999)}/{rng.integers(100000, 999999)} today") for i in range(90)] + [(i, f"order {rng.integers(10**11, 10**12)} sent") for i in range(90, 210)]
    spans = pii.pii_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["a"] for r in spans.select("doc_id", pii.written(F.col("added")).alias("a")).collect()}
    assert sum(got[i].startswith("phone:6:") for i in range(90)) >= 81 and not any(got[i] for i in range(90, 210))


def test_free_and_overlapping_candidates(spark):
    each = spark.createDataFrame([(1, 1, 0, 0, 5), (1, 1, 0, 5, 9), (1, 1, 1, 8, 20), (1, 1, 2, 30, 40), (2, 2, 0, 0, 5)], "k1 long, k2 long, kind int, start int, end int")
    base = spark.createDataFrame([(1, 1, 9, 12), (1, 1, 5, 6), (1, 1, 31, 33)], "k1 long, k2 long, start int, end int")
    assert {(r["k1"], r["start"]): r["free"] for r in pii._free(each, base).collect()} == {(1, 0): True, (1, 5): False, (1, 8): False, (1, 30): False, (2, 0): True}


# Toxicity


def test_nearest_is_exact():
    rng = np.random.default_rng(2)
    weight = np.zeros(toxicity.TERMS)
    weight[:60] = rng.uniform(0.5, 5, 60)
    share = 1 / np.arange(1, 61)  # some terms are rows of the index, some are postings
    examples = [(np.sort(rng.choice(60, n, replace=False, p=share / share.sum())).astype(np.int32), rng.integers(1, 4, n)) for n in rng.integers(0, 9, 900)]
    index = toxicity.BlockMaxIndex(weight, examples, rng.integers(0, 2, 900), list(range(900)))
    assert len(index.rows) and len(index.at)

    def dense(terms, counts):
        x = np.zeros(60)
        x[terms] = (1 + np.log(counts)) * weight[terms]
        return x / (np.linalg.norm(x) or 1)

    all_ = np.array([dense(*e) for e in examples])
    for e in examples[:80]:
        at, cosine = next(index.nearest_of([e]))
        scores = np.sort(all_ @ dense(*e))[::-1]
        scores = scores[scores > 1e-12]
        want = scores[scores >= scores[min(toxicity.K, len(scores)) - 1] - toxicity.TIE] if len(scores) else scores
        assert np.allclose(cosine, want, atol=1e-6)
        assert all(abs(all_[index.ids[k]] @ dense(*e) - c) < 1e-6 for k, c in zip(at, cosine, strict=True))


def test_isotonic_rises():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.2, 0.6, 0.9]), np.array([0, 1, 0, 0, 1.0]))
    assert (np.diff(x) >= 0).all() and (np.diff(y) >= 0).all() and (0 < y).all() and (y < 1).all()


def test_toxicity_separates(spark, odd, none):
    bad = "scum trash idiot moron".split()
    rows = [(i, f"word{i} other{i % 5} {bad[i % 4] if i % 3 == 0 else 'fine'} end", int(i % 3 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic").filter("doc_id < 300"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, _, y in rows)
    assert toxicity.score(odd, model).count() == odd.count() and toxicity.score(none, model).count() == 0
    without = toxicity.fit(odd, df.select("doc_id", "toxic").limit(0))
    assert {r["score"] for r in toxicity.score(odd, without).collect()} == {0.0}


def test_toxicity_scores_by_hand(spark):
    """Frequencies, relevance, cosines, votes and calibration of a small table, worked out word by word."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join([f"w{k}" for k in rng.integers(0, 50, 12)] + ["awful"] * int(i % 4 == 0)), int(i % 4 == 0) if i < 60 else None) for i in range(90)] + [(90, "", None), (91, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    counts = {i: Counter((t or "").split()) for i, t, _ in rows}
    df_of = Counter(w for c in counts.values() for w in c)
    known = [int(i) for i in model.index.ids]
    assert sorted(known) == list(range(60))
    label = {i: int(y) for i, _, y in rows if y is not None}

    def weights(of):
        out = {}
        ones = sum(label[i] for i in of)
        vocabulary = {w for i in of for w in counts[i]}
        for w in df_of:
            a = sum(label[i] for i in of if w in counts[i])
            n = sum(w in counts[i] for i in of)
            table = [(a, n * ones), (n - a, n * (len(of) - ones)), (ones - a, (len(of) - n) * ones), (len(of) - ones - n + a, (len(of) - n) * (len(of) - ones))]
            g = 2 * sum(x * np.log(x * len(of) / e) for x, e in table if x)
            g = max(0, g - 2 * np.log(len(vocabulary))) if a * (len(of) - ones) > (n - a) * ones else 0
            out[w] = np.log((len(rows) + 1) / (df_of[w] + 0.5)) * (toxicity.LEAST_RELEVANCE + np.sqrt(g / (g + toxicity.HALF_RELEVANCE)))
        return out

    def vote(of, i):
        weight = weights(of)

        def vector(c):
            x = {w: (1 + np.log(n)) * weight[w] for w, n in c.items()}
            return {w: v / np.sqrt(sum(u * u for u in x.values())) for w, v in x.items()}

        cosines = sorted(((sum(v * vector(counts[j]).get(w, 0) for w, v in vector(counts[i]).items()), j) for j in of), reverse=True)
        cosines = [(c, j) for c, j in cosines if c > 0]
        if not cosines:
            return sum(label[j] for j in of) / (len(of) + 1)
        cosines = [(c, j) for c, j in cosines if c >= cosines[min(toxicity.K, len(cosines)) - 1][0] - toxicity.TIE]
        return sum(label[j] / (1 - c + toxicity.SMOOTH) for c, j in cosines) / sum(1 / (1 - c + toxicity.SMOOTH) for c, _ in cosines)

    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    for i in (0, 1, 61, 64, 90, 91):
        assert got[i] == pytest.approx(float(np.interp(vote(known, i), *model.map)), abs=1e-4)


def test_toxicity_labels_with_odd_rows(spark):
    docs = spark.createDataFrame([(1, "bad one"), (1, "bad two"), (2, "good"), (3, "good"), (None, "good"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (None, 1), (4, None), (9, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert sorted(model.index.ids) == ["1", "2"] and model.index.labels.tolist() == [1, 1]  # equal texts: the larger label
    clash = docs.withColumns({"score": F.lit(7), "row": F.lit("x"), "evidence": F.lit(1)})
    assert Counter(r["doc_id"] for r in toxicity.score_rows(clash, model).select("row.*").collect()) == Counter([1, 1, 2, 3, None, 4])


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op7_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").select("predicted", "toxic").collect()
    both = sum(r["predicted"] and r["toxic"] for r in got)
    assert both > 0.9 * sum(r["toxic"] for r in got) and both > 0.85 * sum(r["predicted"] for r in got)


# Near-duplicates


def _classes_by_hand(rows, least):
    shingler = near_dedup.Shingler()
    made = [(shingler.words(t), t) for _, t in rows]
    reps, sets = [near_dedup.representative(t, w) for w, t in made], [shingler.shingles(w) for w, _ in made]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if reps[a] == reps[b] or near_dedup.similarity(sets[a], sets[b]) >= least:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        groups[find(k)].append(i)
    out = Counter()
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        out.update((i, min(known) if known else None, len(ids)) for i in ids)
    return out


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_near_duplicates(request, which):
    df = request.getfixturevalue(which)
    got = Counter(tuple(r) for r in near_dedup.near_duplicate_classes(df).collect())
    assert got == _classes_by_hand([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], 0.8)


def test_near_chain_is_one_class(spark):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(12):  # each differs a little from the one before, and the first from the last by much
        words = [f"x{i}" if k // 10 == i else w for k, w in enumerate(words)]
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["class_id"] for r in near_dedup.near_duplicate_classes(df).collect()} == {0}
    assert [r["doc_id"] for r in near_dedup.keep_one(df).collect()] == [0]


def test_near_pairs_hidden_in_a_template(spark):
    """400 pairs of similarity 0.817 among texts that are 0.78 alike: buckets hold many texts, leaders meet few of the pairs."""
    template = [f"t{i}" for i in range(204)]
    rows = [(i, " ".join(template + [f"p{i // 2}x{k}" for k in range(5)] + [f"u{i}x{k}" for k in range(23)])) for i in range(800)]
    got = near_dedup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == {i: i - i % 2 for i in range(800)}


def _prefix_join(spark, texts):
    """The pairs of the prefix join over the texts, as indices, and their sets."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shingler = near_dedup.Shingler()
    words = [shingler.words(t) for t in texts]
    of = {near_dedup.representative(t, w): i for i, (t, w) in enumerate(zip(texts, words, strict=True))}
    wanted = near_dedup.sketches(df, "doc_id", "text").select("k1", "k2", "rep")
    sets = near_dedup.shingle_sets(df, "text", wanted).cache()
    strict = sets.mapInArrow(near_dedup._strict_sketches, "rep binary, bucket array<long>, bits array<long>, marks array<long>, extent double")
    pairs = near_dedup._prefix_pairs(sets, strict, spark.createDataFrame([], "node binary, comp binary"), 0.8)
    return {tuple(sorted((of[r["a"]], of[r["b"]]))) for r in pairs.collect()}, [shingler.shingles(w) for w in words]


def test_texts_that_are_almost_alike_are_ruled_out_before_they_meet(spark):
    """Each text changes 5 of 15 words of a template, no two more than 3 of the same; those that share 3 are 0.76 alike."""
    chosen = []
    for some in itertools.combinations(range(15), 5):
        if len(chosen) < 150 and all(len({*some} & c) < 4 for c in chosen):
            chosen.append({*some})
    got, sets = _prefix_join(spark, [" ".join(f"a{k // 10}" if k % 10 == 5 and k // 10 in c else f"t{k}" for k in range(150)) for c in chosen])
    likest = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if len(chosen[a] & chosen[b]) == 3]
    assert len(likest) > 1_000 and 0.75 < near_dedup.similarity(sets[likest[0][0]], sets[likest[0][1]]) < 0.77
    assert len(got) < 100


def test_prefix_join_keeps_every_alike_pair(spark):
    """Sets of all sizes, some with repeated shingles, around the least similarity."""
    rng, texts = np.random.default_rng(7), []
    for n in (9, 40, 150, 700, 2500):
        for repeated in (0, 1, 3):
            template = [f"t{n}r{repeated}x{i}" for i in range(n)]
            for _ in range(6):
                at, cut = int(rng.integers(0, n)), int(rng.integers(0, n // 9 + 1))
                text = template[:at] + [f"u{rng.integers(1 << 40)}" for _ in range(cut)] + template[at + int(rng.integers(0, cut + 1)) :]
                texts.append(" ".join(text + text[: n // 3] * repeated))
    texts = list(dict.fromkeys(texts))
    got, sets = _prefix_join(spark, texts)
    alike = {(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if near_dedup.similarity(sets[a], sets[b]) >= 0.8}
    assert len(alike) > 60 and alike <= got


def test_keep_one(odd):
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({1: 1, None: 1, 3: 1, 5: 1, 7: 1, 8: 1, 9: 1, 10: 1})


def test_registers_estimate_similarity():
    rng = np.random.default_rng(4)
    a = np.unique(rng.integers(1, 1 << 62, 300, dtype=np.uint64))
    b = np.concatenate((a[:240], np.unique(rng.integers(1, 1 << 62, 60, dtype=np.uint64))))
    x, y = rng.integers(1, 4, len(a)), rng.integers(1, 4, len(b))
    sets = (a, x), (np.sort(b), y[np.argsort(b)])
    holds = near_dedup.prob_min_hash([s[0] for s in sets], [s[1] for s in sets], 4096)
    assert abs((holds[0] == holds[1]).mean() - near_dedup.similarity(*sets)) < 0.04
    share = sum(1 / sum(max(p.get(j, 0) / p[i], q.get(j, 0) / q[i]) for j in {*p, *q}) for p, q in [(dict(zip(*map(list, sets[0]), strict=True)), dict(zip(*map(list, sets[1]), strict=True)))] for i in p if i in q)
    assert abs(near_dedup.similarity(*sets) - share) < 1e-9


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(500, 499), (499, 500)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 499: 499, 500: 499}


# Suffix dedup


def _repeats_by_hand(texts: list[bytes | None]) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for p in range(len(t or b"") - suffix_dedup.LENGTH + 1):
            seen[t[p : p + suffix_dedup.LENGTH]] = seen.get(t[p : p + suffix_dedup.LENGTH], 0) + 1
    out = []
    for t in texts:
        t = t or b""
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - suffix_dedup.LENGTH + 1):
            if seen[t[p : p + suffix_dedup.LENGTH]] > 1:
                gone[p : p + suffix_dedup.LENGTH] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_halves_of_a_refined_bucket_are_independent():
    """Spans that agree in one half by force still differ in the other; equal spans agree in both."""
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 900, dtype=np.uint8)
    data[600:800] = data[:200]
    both = suffix_dedup.FIRST(data), suffix_dedup.SECOND(data)
    start = np.arange(700)
    one, two = suffix_dedup.refined(both, start, suffix_dedup.LENGTH)
    assert one[0] == one[600] and two[0] == two[600] and len(np.unique(one)) == len(np.unique(two)) == 699
    for half, blind in ((1, 0), (0, 1)):
        forced = list(both)
        forced[blind] = np.zeros_like(both[blind])
        halves = suffix_dedup.refined(tuple(forced), start, suffix_dedup.LENGTH)
        assert len(np.unique(halves[blind])) == 1 and len(np.unique(halves[half])) == 699


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_remove_repeats(request, which):
    df = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want = Counter((i, *w) for (i, _), w in zip(rows, _repeats_by_hand([_utf8(t) for _, t in rows]), strict=True))
    got = suffix_dedup.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in got.collect()) == want


def test_long_documents_are_cut_into_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 5000, dtype=np.uint8).tobytes()
    whole = suffix_dedup._Part(np.frombuffer(data, np.uint8)).chosen
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    parts = [suffix_dedup._Part(x).chosen + at for at, x in suffix_dedup._blocks(data)]
    assert np.array_equal(np.concatenate(parts), whole)


# Decontamination and sharding


def test_contaminated(spark, docs, odd):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog, while seven wise owls look!"), (2, "Too short"), (3, None), (None, "words that no document has in this very order at all"), (None, "count the stars of the northern sky"), (5, "quick brown fox"), (5, "alone"), (5, "alone"), (6, "fox quick"), (7, "?!"), (8, "")], "item_id long, text string")
    got = Counter(tuple(r)[:2] for r in decontam.contaminated(odd, items).collect())
    assert got == Counter({(5, 1): 3, (6, 1): 1, (5, None): 3, (6, None): 1, (5, 5): 3, (6, 5): 1, (None, 5): 1})
    left = decontam.drop_contaminated(odd, items)
    assert left.columns == odd.columns and left.count() == odd.count() - 5
    assert decontam.contaminated(docs, items.limit(0)).count() == 0 and decontam.contaminated(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_shards_hold_every_row(request, spark, which):
    df = request.getfixturevalue(which)
    store = sharding.ShardStore(spark, f"{scratch_dir(spark)}/store-{uuid.uuid4().hex}", target_bytes=40_000, fanout=3)
    for k in range(7):
        store.append(df.withColumn("lane", F.lit(k)), F.coalesce(F.col("source"), F.lit("none")))
    rows = Counter(tuple(r) for k in range(7) for r in df.withColumn("lane", F.lit(k)).collect())
    version = store.versions()[-1]
    merged = store.compact()
    assert merged and store.versions()[-1] > version
    assert Counter(tuple(r) for r in store.read().collect()) == rows == Counter(tuple(r) for r in store.read(version).collect())
    with pytest.raises(sharding.VersionTaken, match="exist"):  # another writer was first
        store.commit({"version": version, "schema": None}, [], None)
    assert store.vacuum() == 0  # all is younger than the time of grace
    assert store.vacuum(0) > 0
    assert Counter(tuple(r) for r in store.read().collect()) == rows


def test_shards_of_two_writers_and_odd_columns(spark, none):
    root = f"{scratch_dir(spark)}/two-writers-{uuid.uuid4().hex}"
    one, two = sharding.ShardStore(spark, root), sharding.ShardStore(spark, root)
    rows = spark.createDataFrame([(1, "x", "a"), (2, None, "b"), (2, None, "b")], "doc_id long, __arrival string, `part-0` string")
    publish, done = one.commit, []

    def late(before, runs, schema):
        if not done:
            done.append(two.append(rows.limit(1), F.lit("other")))  # between the other writer's reading and its commit
        return publish(before, runs, schema)

    one.commit = late
    one.append(rows, F.col("doc_id"))
    one.append(none.select("doc_id", "text"), F.lit("empty"))
    assert one.versions() == [1, 2, 3]
    assert Counter(tuple(r) for r in one.read().select("doc_id", "__arrival", "part-0").collect()) == Counter([(1, "x", "a")] * 2 + [(2, None, "b")] * 2)
    assert one.read().columns == ["doc_id", "__arrival", "part-0", "text"]
    assert sharding.shard_arrivals(none, f"{root}-none", F.col("source")).count() == 0


def test_shards_keep_the_types_of_columns(spark):
    root = f"{scratch_dir(spark)}/types-{uuid.uuid4().hex}"
    store, other = sharding.ShardStore(spark, root), sharding.ShardStore(spark, root)
    of = lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)
    store.append(of("k long, t string", (1, "a")), F.lit("x"))
    store.append(of("k int, n float", (2, 0.5)), F.lit("x"))
    for ddl, row in (("k string", "3"), ("k double", 3.0), ("t long", 3), ("n double", 3.0)):
        with pytest.raises(sharding.TypeChanged):
            store.append(of(ddl, (row,)), F.lit("x"))
    assert store.versions() == [1, 2] and sorted(map(tuple, store.read().collect())) == [(1, "a", None), (2, None, 0.5)]
    commit, done = store.commit, []

    def late(before, runs, schema):
        if not done:
            done.append(other.append(of("z string", ("s",)), F.lit("y")))
        return commit(before, runs, schema)

    store.commit = late
    with pytest.raises(sharding.TypeChanged):  # the other writer has brought z as text meanwhile
        store.append(of("z long", (4,)), F.lit("x"))
    assert store.versions() == [1, 2, 3] and store.read().count() == 3


def test_scratch_folder_where_none_is_named():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            applicationId, master = "app-2", "local"

    found = scratch_dir(Session)
    assert found == scratch_dir(Session) and found.startswith("file:///tmp/spark-")
    Session.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session)


# All of them


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "op7_toxicity"))
def test_queries_return_a_row_for_each(spark, name):
    rows = QUERIES[name](spark, SF).count()
    table = "pages" if name.startswith("op1_") else "documents"
    if name == "op13_exact_topk":
        assert rows == 10 * spark.read.parquet(f"{SF}/embeddings.parquet").filter("vec_id % 100 = 0").count()
    elif name not in ("op2_best_fit_packing", "op6_benchmark_decontamination", "op11_conversation_trie"):
        assert rows == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_ids_of_text(spark, docs):
    """Operators take ids of any type; results are those of the same rows with numbers."""
    some = docs.filter("doc_id < 60")
    named = some.withColumn("doc_id", F.format_string("%05d", "doc_id"))
    for run in (lambda d: packing.pack_documents(d, VOCABULARY).select("doc_id", "piece", "length", "ids_crc32"), near_dedup.near_duplicate_classes, lambda d: near_dedup.keep_one(d).select("doc_id"), suffix_dedup.remove_repeats):
        number = lambda r: tuple(int(x) if isinstance(x, str) and len(x) == 5 and x.isdigit() else x for x in r)
        assert Counter(map(number, run(named).collect())) == Counter(map(tuple, run(some).collect()))


def test_empty_tables(none):
    assert line_dedup.drop_repeated_lines(none).count() == 0
    assert packing.pack_documents(none, VOCABULARY).count() == 0
    assert media.document_media(none).count() == 0
    assert pii.pii_spans(none).count() == 0
    assert near_dedup.near_duplicate_classes(none).count() == 0
    assert near_dedup.keep_one(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
