"""URL filter: longest-match rules by host and path, and boosted trees on lexical features for URLs no rule decides.

Labelled URLs train the trees. No table labels URLs, so pages do: page_labels() calls a page poor (label 1) if its visible
text has fewer than MIN_PAGE_WORDS words or more than MAX_PAGE_SYMBOLS of its characters are neither letters, digits, space
nor common punctuation. Rules take no part in it. Features: lengths, depth, digit and punctuation ratios, character
entropy, parameter counts, and the smoothed share of label 1 under the host's last one, two and three labels (suffix
statistics, kept for suffixes with MIN_SUFFIX_ROWS labelled URLs of the sample, so their number is bounded by it). A
training row's suffix shares come from the other folds, so its own label takes no part in them. One fold of the labelled URLs
is held out of the trees: they decide only if label 1 is, with confidence, more frequent among the held-out URLs that they
would block than among all. Labels that URLs do not show so block nothing.

Defined cases: null URLs and those without :// have an empty host and path and fall to the trees; URLs of any length are
read whole; repeated rows are judged each, a URL with both labels is a row of either; among rules of one length the
alphabetically first wins; where the trees do not decide (also without labels, or with one label only), every undecided URL is
allowed, its score still given; null labels are none; only id and URL are read, so other columns may have any name; an empty table gives an
empty result. Only DataFrame functions and Spark's own learner are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boosting
from ._common import bounded_sample, save

#: Rules up to so many become one expression; more are joined on the host's suffixes.
COMPILED_RULES = 200
MIN_SUFFIX_ROWS, PRIOR_ROWS, FOLDS = 10, 10, 5
#: Labelled URLs the trees are fitted on, a documented bound.
TRAINING_ROWS = 5_000
MIN_PAGE_WORDS, MAX_PAGE_SYMBOLS = 60, 0.03
#: URLs with this score or more are blocked; normal deviates by which held-out ones must beat the label rate.
BLOCK_FROM, CONFIDENCE = 0.5, 2.58
FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_punctuation", "f_entropy", "f_parameters", "f_query_length", "f_fragment", "f_secure", "f_suffix1", "f_suffix2", "f_suffix3"]
SUFFIXES = (1, 2, 3)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, _URL, 1), _UPPER, _LOWER), F.regexp_extract(text, _URL, 2)


def _split(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def match_rules(urls: DataFrame, rules: list[tuple[str, str]], compiled: int = COMPILED_RULES) -> DataFrame:
    """urls (with host, path) and the longest fitting rule and its verdict, null where none fits. rules: (rule, verdict)."""
    if len(rules) <= compiled:
        made = F.lit(None).cast("string")
        verdict = F.lit(None).cast("string")
        for rule, said in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
            host, path = _split(rule)
            fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
            made, verdict = F.when(fits, rule).otherwise(made), F.when(fits, said).otherwise(verdict)
        return urls.withColumns({"rule": made, "rule_verdict": verdict})
    spark = urls.sparkSession
    table = spark.createDataFrame([(*_split(r), r, v) for r, v in rules], "_suffix string, _path string, rule string, rule_verdict string")
    # Distinct (host, path) pairs meet the rules once; a host has as many suffixes as labels.
    pairs = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    fitting = pairs.withColumn("_suffix", F.explode(suffixes)).join(table, "_suffix").filter(F.col("path").startswith(F.col("_path")))
    best = fitting.groupBy("host", "path").agg(F.min(F.struct((-F.length("rule")).alias("n"), "rule", "rule_verdict")).alias("b")).select("host", "path", "b.rule", "b.rule_verdict")
    return urls.join(best, ["host", "path"], "left")


def lexical(urls: DataFrame, url_col: str) -> DataFrame:
    """urls (with host, path) and the lexical features of the whole URL."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    query, size = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), F.greatest(F.length(url), F.lit(1))
    share = lambda pattern: F.length(F.regexp_replace(url, pattern, "")) / size
    counts = F.transform(F.array_distinct(F.split(url, "")), lambda c: size - F.length(F.replace(url, c, F.lit(""))))
    entropy = F.aggregate(counts, F.lit(0.0), lambda a, n: a + F.when(n > 0, -(n / size) * F.log2(n / size)).otherwise(0.0))
    return urls.withColumns({
        "f_length": F.length(url).cast("double"), "f_host_length": F.length("host").cast("double"), "f_path_length": F.length("path").cast("double"),
        "f_depth": F.size(F.array_remove(F.split("path", "/"), "")).cast("double"), "f_labels": F.size(F.split("host", r"\.")).cast("double"),
        "f_digits": 1 - share("[0-9]"), "f_punctuation": 1 - share(r"[^a-zA-Z0-9]"), "f_entropy": entropy,
        "f_parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))).cast("double"), "f_query_length": F.length(query).cast("double"),
        "f_fragment": F.contains(url, F.lit("#")).cast("double"), "f_secure": url.startswith("https").cast("double"),
        **{f"_s{n}": F.substring_index("host", ".", -n) for n in SUFFIXES},
    })


def page_labels(pages: DataFrame, url_col: str = "url", html_col: str = "html", rows: int = TRAINING_ROWS) -> DataFrame:
    """(url, label): 1 for the URLs of poor pages, of about twice rows of them by the hash of the URL, as the trees take rows.
    Pages without HTML give no label."""
    n, space = pages.count(), 1 << 30
    if n > 2 * rows:
        pages = pages.filter(F.pmod(F.xxhash64(url_col), F.lit(space)) < int(2 * rows / n * space) + 1)
    text = F.regexp_replace(F.col(html_col).cast("string"), r"(?is)<(script|style)\b[^>]*+>.*?</\1>|<[^>]*+>", " ")
    words = F.size(F.array_remove(F.split(text, r"\s+"), ""))
    symbols = F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s.,;:!?'\x22()&-]", "")) / F.greatest(F.length(text), F.lit(1))
    return pages.filter(F.col(html_col).isNotNull()).select(F.col(url_col).alias("url"), ((words < MIN_PAGE_WORDS) | (symbols > MAX_PAGE_SYMBOLS)).cast("double").alias("label"))


def _suffix_shares(sample: DataFrame, base: float, n: int) -> tuple[DataFrame, DataFrame]:
    """(suffix, share) of the whole sample, and (suffix, fold, share) of the folds but that one."""
    key = f"_s{n}"
    folds = sample.groupBy(key, "_fold").agg(F.sum("_label").alias("ones"), F.count("*").alias("n"))
    whole = folds.groupBy(key).agg(F.sum("ones").alias("all_ones"), F.sum("n").alias("all_n")).filter(F.col("all_n") >= MIN_SUFFIX_ROWS)
    share = lambda ones, rows: ((ones + PRIOR_ROWS * base) / (rows + PRIOR_ROWS)).alias(f"f_suffix{n}")
    rest = folds.join(whole, key).select(key, "_fold", share(F.col("all_ones") - F.col("ones"), F.col("all_n") - F.col("n")))
    return whole.select(key, share(F.col("all_ones"), F.col("all_n"))), rest


class UrlModel:
    """Trees and suffix shares learnt from a bounded sample of labelled URLs (url, label)."""

    def __init__(self, labelled: DataFrame, rows: int = TRAINING_ROWS):
        host, path = host_and_path(F.col("url"))
        labelled = save(labelled.filter(F.col("label").isNotNull()), "url-labels")
        known = labelled.select("url", host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("_label"))
        # The sample's size is a documented bound; so is that of the suffix tables made from it.
        sample = lexical(bounded_sample(known, "url", rows), "url").withColumn("_fold", F.pmod(F.xxhash64("url", F.lit(5)), F.lit(FOLDS)))
        sample = save(sample, "labelled-urls")
        self.base = sample.agg(F.coalesce(F.avg("_label"), F.lit(0.0))).first()[0]
        self.shares, self.decides = [], False
        training = sample
        for k in SUFFIXES:
            whole, rest = _suffix_shares(sample, self.base, k)
            self.shares.append((f"_s{k}", save(whole, "suffixes")))
            training = training.join(F.broadcast(save(rest, "suffixes")), [f"_s{k}", "_fold"], "left")
        training = self._filled(training)
        self.model = boosting.fit(training.filter("_fold <> 0"), FEATURES, "_label", "url", rows)
        if self.model is not None:
            held_out = self.model.score(training.filter("_fold = 0"), "_p").filter(F.col("_p") >= BLOCK_FROM)
            n, ones = held_out.agg(F.count("*"), F.coalesce(F.sum("_label"), F.lit(0.0))).first()
            self.decides = boosting.at_least(ones, n, CONFIDENCE) > self.base

    def _filled(self, df: DataFrame) -> DataFrame:
        return df.fillna({f"f_suffix{k}": self.base for k in SUFFIXES})

    def score(self, urls: DataFrame, url_col: str) -> DataFrame:
        """urls (with host, path) and block_score."""
        if self.model is None:
            return urls.withColumn("block_score", F.lit(0.0))
        known = lexical(urls, url_col)
        for key, whole in self.shares:
            known = known.join(F.broadcast(whole), key, "left")
        return self.model.score(self._filled(known), "block_score")


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame, id_col: str = "page_id", url_col: str = "url", rows: int = TRAINING_ROWS) -> DataFrame:
    """(id, url, host, path, rule, verdict, block_score). labelled: (url, label), label 1 to block."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    judged = match_rules(pages.select(F.col(id_col), F.col(url_col).cast("string").alias(url_col), host.alias("host"), path.alias("path")), rules)
    model = UrlModel(labelled, rows)
    scored = model.score(judged, url_col)
    verdict = F.coalesce("rule_verdict", F.when((F.col("block_score") >= BLOCK_FROM) & model.decides, "block").otherwise("allow"))
    return scored.select(id_col, url_col, "host", "path", "rule", verdict.alias("verdict"), "block_score")
