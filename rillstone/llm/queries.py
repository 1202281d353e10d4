"""opN_<name> queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import conversation_trie, decontam, exact_topk, line_dedup, media, near_dedup, packing, periodic_runs, pii, sharding, suffix_dedup, toxicity, url_filter
from ._common import scratch_dir, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
MIN_LINE_DOCS, MIN_LINE_LENGTH = 10, 1


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, URL_RULES, url_filter.page_labels(pages)).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), VOCABULARY)


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.document_media(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption", "n_texts", "texts_sha256")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(table(spark, sf_dir, "documents"))
    counts = [pii.n_of(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    spans = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(spans).alias("spans"), F.size(spans).cast("long").alias("n_spans"), F.size("added").cast("long").alias("n_added"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), min_docs=MIN_LINE_DOCS, min_length=MIN_LINE_LENGTH)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _remainder(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(_remainder("doc_id") != 0))
    done = toxicity.score(docs, model)
    evidence = F.concat_ws(";", F.transform("evidence", lambda e: F.concat_ws(":", e["example"], e["label"], e["cosine"])))
    return done.select("doc_id", (_remainder("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), evidence.alias("evidence"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive source by source; what the last manifest lists is read back."""
    docs = table(spark, sf_dir, "documents")
    kept = sharding.shard_arrivals(docs, f"{scratch_dir(spark)}/shards-{uuid.uuid4().hex}", F.col("source"))
    return kept.select("doc_id", "lang", "source", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"))


def _crc(value: Column) -> Column:
    return F.crc32(value.cast("string").cast("binary"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the first h original turns of conversation c - c % 20, then c's own after its first h,
    h = crc32(c) % 4, in the order of place."""
    by = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    numbered = turns.filter("conv_id is not null").select("conv_id", "role", "text", F.row_number().over(by).alias("pos"))
    h = _crc(F.col("conv_id")) % 4
    heads = numbered.filter("pos <= 3").withColumnRenamed("conv_id", "base")
    headed = turns.filter("conv_id is not null").select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % 20).join(heads, "base")
    first = headed.filter(F.col("pos") <= h).select("conv_id", F.col("pos").alias("place"), "role", "text")
    return first.unionByName(numbered.filter(F.col("pos") > h).select("conv_id", (F.col("pos") + 3).alias("place"), "role", "text"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversation_trie.prefix_trie(rebuilt(turns), [F.col("place")], turns.select("conv_id"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) whose text has its last words repeated where crc32(doc_id) % 10 is 0: each word i >= a is word
    a + (i - a) % p."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    chosen = docs.withColumns({"_h": _crc(F.col("doc_id")), "_words": F.when(_crc(F.col("doc_id")) % 10 == 0, words)})
    g, n = F.floor(F.col("_h") / 10), F.size("_words")
    placed = chosen.withColumn("_a", F.when(n > 0, g % n).cast("int")).withColumn("_p", (F.floor((n - F.col("_a")) / (g % 8 + 3)) + 1).cast("int"))
    source = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    repeated = F.array_join(F.transform("_words", lambda w, i: F.get("_words", source(i))), " ")
    return placed.withColumn("text", F.when(F.col("_a").isNotNull(), repeated).otherwise(F.col("text"))).drop("_h", "_words", "_a", "_p")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = periodic_runs.collapsed_runs(with_periodic_tails(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return done.withColumn("text", F.sha2("text", 256)).withColumnRenamed("text", "collapsed_sha256")


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_best_fit_packing, op3_media_columns, op4_pii, op5_line_dedup, op6_benchmark_decontamination, op7_toxicity, op8_minhash_near_dedup, op9_suffix_dedup, op10_sharding, op11_conversation_trie, op12_periodic_runs, op13_exact_topk)}

#: CRC-32 of a text's ASCII characters, bit by bit.
_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({0}, ''), lambda ch: CAST(ord(ch) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLES = {
    "op5_line_dedup": f"""
        WITH lines AS (
          SELECT row_id, doc_id, n, lines[n] AS line,
            translate(regexp_replace(regexp_replace(lines[n], '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', ''), {_ASCII}) AS key
          FROM (SELECT row_id, doc_id, lines, unnest(range(1, len(lines) + 1)) AS n
                FROM (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
        hot AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT row_id) >= {MIN_LINE_DOCS})
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE h.key IS NOT NULL) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE h.key IS NULL), '')) AS kept_sha256
        FROM lines l LEFT JOIN hot h ON l.key = h.key GROUP BY row_id, doc_id""",
    "op6_benchmark_decontamination": r"""
        WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
        i AS (SELECT item, item_id, w, least(5, len(w)) AS m
              FROM (SELECT row_number() OVER () AS item, item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM (SELECT DISTINCT item_id, text FROM benchmark))
              WHERE len(w) > 0),
        ds AS (SELECT DISTINCT row_id, doc_id, m, array_to_string(w[k : k + m - 1], ' ') AS s
               FROM (SELECT row_id, doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM i) WHERE len(w) >= m)),
        its AS (SELECT DISTINCT item, item_id, m, array_to_string(w[k : k + m - 1], ' ') AS s FROM (SELECT item, item_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM i)),
        n AS (SELECT item, count(*) AS n FROM its GROUP BY item)
        SELECT doc_id, item_id, count(*) AS n_shared, n AS n_shingles FROM ds JOIN its USING (m, s) JOIN n USING (item)
        GROUP BY row_id, doc_id, item, item_id, n HAVING count(*) * 10 >= n * 8""",
    "op10_sharding": "SELECT doc_id, lang, source, CAST(strlen(text) AS BIGINT) AS n_bytes, sha256(text) AS text_sha256 FROM documents",
    "op11_conversation_trie": f"""
        WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
        c AS (SELECT conv_id, {_CRC.format('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
        r AS (SELECT c.conv_id, t.pos AS place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos <= c.h
              UNION ALL SELECT t.conv_id, t.pos + 3, t.role, t.text FROM t JOIN c USING (conv_id) WHERE t.pos > c.h),
        l AS (SELECT c.conv_id, coalesce(list(sha256(strlen(r.role) || ':' || r.role || r.text) ORDER BY r.place) FILTER (WHERE r.place IS NOT NULL), []) AS d,
                coalesce(list(len(regexp_extract_all(r.text, '[^\\x20\\x09-\\x0D]+')) ORDER BY r.place) FILTER (WHERE r.place IS NOT NULL), []) AS w FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
        p AS (SELECT conv_id, len(d) AS n, depth, sha256(array_to_string(d[1 : depth], ',')) AS node, CASE WHEN depth > 0 THEN sha256(array_to_string(d[1 : depth - 1], ',')) END AS above, CASE WHEN depth > 0 THEN w[depth] ELSE 0 END AS words
              FROM (SELECT *, unnest(range(0, len(d) + 1)) AS depth FROM l)),
        v AS (SELECT node, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = depth AS leaf, (count(*) - 1) * any_value(words) AS saved,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256 FROM p GROUP BY node, depth),
        s AS (SELECT top.node, count(*) FILTER (WHERE v.leaf) AS n_leaves, CAST(sum(v.saved) AS BIGINT) AS saved_tokens FROM v JOIN p AS top ON top.conv_id = v.conv_id AND top.depth <= v.depth GROUP BY top.node),
        k AS (SELECT above AS node, count(*) AS n FROM v WHERE above IS NOT NULL GROUP BY above)
        SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n, 0) AS n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
        FROM v JOIN s USING (node) LEFT JOIN k USING (node) LEFT JOIN v AS u ON u.node = v.above""",
    "op12_periodic_runs": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {_CRC.format('CAST(doc_id AS VARCHAR)')} AS h FROM documents),
        g AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
        a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM g),
        p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
        m AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM p),
        x AS (SELECT r, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM m),
        e AS (SELECT x.r, y.i - x.i AS q, x.i FROM x JOIN x AS y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
        f AS (SELECT r, q, min(i) AS s, count(*) + q AS len FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM e) GROUP BY r, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
        u AS (SELECT r, s, len, min(q) AS q FROM f GROUP BY r, s, len),
        gone AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM u),
        kept AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.i) AS text FROM x ANTI JOIN gone ON gone.r = x.r AND gone.i = x.i GROUP BY x.r),
        best AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM u GROUP BY r),
        top AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY r ORDER BY len / q DESC, s, q) = 1)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS "start", len AS length, q AS period, 1000 * len // q AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM m LEFT JOIN best USING (r) LEFT JOIN top USING (r) LEFT JOIN kept USING (r)""",
    "op13_exact_topk": """
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v AS q JOIN v AS c ON q.r <> c.r WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s) WHERE n <= 10""",
}
