"""The pipeline's stages and their whole against brute force, on a table with planted cases and odd rows."""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rillstone.llm import line_dedup, near_dedup, packing
from rillstone.llm.queries import VOCABULARY

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, piece int, score string"
BAD = "awful horrid nasty vile".split()
ITEM = "seven grey geese fly slowly over the quiet harbour at dawn"


def _words(rng, n):
    return " ".join(f"w{k}" for k in rng.integers(0, 4000, n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, rows = np.random.default_rng(11), []
    for i in range(120):
        text = _words(rng, 80)
        if i % 5 == 0:
            text += " " + " ".join(rng.choice(BAD, 5))
        if i % 3 == 0:
            text = "Share this page\n" + text + "\n share THIS page \t"
        if i % 10 == 1:
            text += "\n" + ITEM
        rows.append((i, text, "en", "a", len(text), i, "s"))
    for i in (2, 4, 7):
        near = rows[i][1].replace(rows[i][1].split()[-3], "changed", 1)
        rows += [(200 + i, rows[i][1], None, "b", 1, 0, None), (300 + i, near, "en", None, 1, 0, "x")]
    rows += [(400, None, None, None, None, None, None), (401, "", "en", "a", 0, 0, ""), (None, _words(rng, 30), "en", "a", 1, 1, ""), (402, "...", "en", "a", 3, 1, ""), (403, "...", "en", "a", 3, 1, ""), (404, "Share this page", "en", "a", 1, 1, "")]
    rows += [(405, _words(rng, 9000), "en", "c", 1, 1, "")] * 2
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(120)] + [(None, 1, 1), (400, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (None, "no document says this at all in any way")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def _toxic(rows):
    return [r for r in rows if not set(BAD) & set((r["text"] or "").split())]


def _without_lines(rows):
    keys = Counter(k for r in rows for k in {line_dedup.line_key(x) for x in (r["text"] or "").encode().split(b"\n")} if k)
    out = []
    for r in rows:
        text = b"\n".join(x for x in (r["text"] or "").encode().split(b"\n") if keys[line_dedup.line_key(x)] < 10).decode()
        out.append({**r, "text": text, "n_chars": len(text)})
    return out


def _one_of_each(rows):
    shingler = near_dedup.Shingler()
    words = [shingler.words(r["text"]) for r in rows]
    sets, group = [shingler.shingles(w) for w in words], list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        same = (rows[a]["text"] or "") == (rows[b]["text"] or "")
        if group[a] != group[b] and (same or near_dedup.similarity(sets[a], sets[b]) >= 0.8):
            group = [group[a] if g == group[b] else g for g in group]
    classes = defaultdict(list)
    for r, g in zip(rows, group, strict=True):
        classes[g].append(r)
    return [min(c, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)) for c in classes.values()]


def _clean(rows):
    run = lambda text: [x for x in re.split(r"[^\w]+", text.lower()) if x]
    of = lambda text: {tuple(run(text)[k : k + 5]) for k in range(len(run(text)) - 4)}
    return [r for r in rows if 10 * len(of(ITEM) & of(r["text"] or "")) < 8 * len(of(ITEM))]


STEPS = [("drop_toxic", _toxic), ("drop_lines", _without_lines), ("drop_near_copies", _one_of_each), ("drop_benchmark", _clean)]


def _counted(rows):
    return Counter(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)


def _pieces(rows):
    tokenizer, out = packing.WordEncoder(VOCABULARY).tokenizer, Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        out.update((r["doc_id"], p, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for p, a in enumerate(range(0, len(ids), 2048)))
    return out


def test_stages_and_whole(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    want = [r.asDict() for r in docs.collect()]
    for name, by_hand in STEPS:
        docs = getattr(corpus_pipeline, name)(spark, docs, tables)
        want = by_hand(want)
        assert f"{docs.columns}" == f"{SCHEMA.replace(',', '').split()[::2]}"
        got = [r.asDict() for r in docs.collect()]
        assert _counted(got) == _counted(want), name
        docs = spark.createDataFrame(got, docs.schema)
    assert Counter(tuple(r)[:5] for r in corpus_pipeline.pack(spark, docs, tables).collect()) == _pieces(want)
    whole = corpus_pipeline.run(spark, tables).collect()
    assert Counter(tuple(r)[:5] for r in whole) == _pieces(want)
    used = Counter()
    for r in whole:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048


def test_stages_over_an_empty_table(spark, tables):
    none = spark.read.parquet(f"{tables}/documents.parquet").withColumn("extra", F.lit(1)).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, none, tables)
        assert got.count() == 0, name
        assert name == "best_fit_packing" or got.columns == none.columns
