"""Personal data: base spans by pattern and check, further spans by boosted trees over high-recall candidates.

Base spans (email, ip, card, phone) are leftmost matches that do not overlap within their kind, kept where their check
passes. Looser generators propose spans that may overlap: other separators, missing prefixes, written-out signs. A
candidate's label is a check of its content that no base pattern makes: the Luhn sum of 13 to 19 digits, four octets, a
domain that ends in letters, a number of dialled digits behind a dialling sign. The trees see only how it is written and what
stands around it. For cards, addresses and hosts no feature shows the check; for phones the features do (digits, first sign),
and what their trees learn is which ways of writing pass it. Each kind has trees of its own, fitted on either half of its
candidates and used on the other, so every score is of trees that have not seen the candidate. A kind's threshold is the
least score at and above which MIN_PRECISION of its candidates pass their check, by the lower end of a confidence interval;
candidates above it that overlap no base span are added, of overlapping ones the best.

Start and end are code points, end exclusive. Positions come from the lengths of what lies between matches; sums run in
blocks, overlaps by running maxima, so texts with very many matches stay cheap. Patterns are possessive and start at the
start of a run, or where the last match ended, which finds the plain patterns' matches in linear time and constant stack.

Defined cases: null texts are empty and have no spans; texts are read whole, of any length; rows with a null or repeated
id are treated each; ties between overlapping candidates go to the later start, then kind; only id and text are read, so
other columns may have any name; of a kind without candidates of both labels nothing is added, nor of one whose precision is
not shown by its candidates; an empty table gives an empty result. Only DataFrame functions and Spark's own learner are used.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import boosting
from ._common import save, small, text_key

KINDS = ["email", "ip", "card", "phone"]
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a base pattern to match it anywhere: one quick scan spares two others.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
#: (kind, pattern, what a text must have for it).
CANDIDATES = [
    ("email", r"(?<![^\s@])[^\s@]++@[^\s@]++", "@"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9()\[\].-]++", r"[(\[]at[)\]]"),
    ("ip", r"(?<![0-9.])[0-9]++(?:(?:\.|\[\.\]|\(\.\))[0-9]++){2,8}+", r"[0-9][.)(\[]"),
    ("card", r"(?<![0-9+])[0-9](?:[\x20./_-]{0,2}[0-9]){8,40}+", "[0-9]"),
    ("phone", r"(?<![0-9+])(?:\+|\(|00)?[0-9](?:[\x20()./-]{0,3}[0-9]){6,40}+", "[0-9]"),
]
#: A threshold's precision, and the normal deviate of the confidence with which it is reached.
MIN_PRECISION, CONFIDENCE, BINS, FOLDS = 0.95, 1.28, 50, 2
FEATURES = ["f_length", "f_digits", "f_letters", "f_separators", "f_dots", "f_brackets", "f_groups", "f_longest", "f_plus", "f_first", "f_before_space", "f_before_digit", "f_before_word", "f_after_space", "f_after_digit", "f_after_word", "f_cue"]
#: Words of four languages that stand before personal data; a context feature, not a rule.
CUES = r"(?i)(mail|tel|phone|fon|call|card|karte|carte|tarjeta|kont|ip|addr|adres|server|host)[^\n]{0,8}$"
BLOCK, ADDED_ROWS = 64, 1_000_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _running(lengths: Column) -> Column:
    """Sums of the first 1, 2, ... lengths."""
    n = F.ceil(F.size(lengths) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))
    before = lambda bs: F.aggregate(bs, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + _total(b))))
    within = lambda b, at: F.transform(b, lambda x, i: at + _total(F.slice(b, 1, i + 1)))
    return let(blocks, lambda bs: let(before(bs), lambda at: F.flatten(F.zip_with(bs, F.slice(at, 1, F.size(bs)), within))))


def located(text: Column, pattern: str, needs: str) -> Column:
    """Array of matches (start, end, hit, before, after); before and after are up to 16 and 8 characters around it. Only a
    text that has a match of needs can have any."""
    kind = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"

    def place(v: Column) -> Column:
        gaps, hits = v["gaps"], v["hits"]
        lengths = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
        made = lambda ends: F.transform(hits, lambda h, i: F.struct((F.get(ends, i) - F.length(h)).alias("start"), F.get(ends, i).alias("end"), h.alias("hit"), F.right(F.get(gaps, i), F.lit(16)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(8)).alias("after")))
        return F.when(F.size(hits) == 0, F.array().cast(kind)).otherwise(let(let(lengths, _running), made).cast(kind))

    found = let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")), place)
    return F.when(text.rlike(needs), found).otherwise(F.array().cast(kind))


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.sequence(F.lit(1), F.length(number)), lambda i: let(F.substr(number, i, F.lit(1)).cast("int") * F.when((F.length(number) - i) % 2 == 1, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return (F.length(number) > 0) & (F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0)


def _passes(kind: str, hit: Column) -> Column:
    n = F.length(digits(hit))
    if kind == "ip":
        return hit.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        return F.when(n.between(14, 19), luhn(digits(hit))).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _base_of(i: int, kind: str, text: Column) -> Column:
    good = F.filter(located(text, BASE[kind], NEEDS[kind]), lambda m: _passes(kind, m["hit"]))
    return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(i).alias("kind"), m["end"].alias("end")))


def _base(text: Column) -> Column:
    """Array of (start, kind number, end) in order of start, then kind."""
    return F.array_sort(F.concat(*[_base_of(i, k, text) for i, k in enumerate(KINDS)]))


def _candidates_of(kind: str, pattern: str, needs: str, text: Column) -> Column:
    i = KINDS.index(kind)
    return F.transform(located(text, pattern, needs), lambda m: F.struct(F.lit(i).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["hit"].alias("hit"), m["before"].alias("before"), m["after"].alias("after")))


def _candidates(text: Column) -> Column:
    return F.concat(*[_candidates_of(*c, text) for c in CANDIDATES])


def n_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _checked(c: DataFrame) -> DataFrame:
    """Candidates with label: whether the content passes the check of its kind, however it is written."""
    hit, number = F.col("hit"), digits(F.col("hit"))
    plain = F.regexp_replace(F.regexp_replace(hit, r" ?[(\[]at[)\]] ?", "@"), r"[(\[](?:dot|\.)[)\]]", ".")
    n = F.length(number)
    octets = plain.rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$")
    passes = (
        F.when(F.col("kind") == KINDS.index("email"), F.regexp_replace(plain, "[^A-Za-z0-9]++$", "").rlike(r"^[^@]*[A-Za-z0-9][^@]*@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}$"))
        .when(F.col("kind") == KINDS.index("ip"), octets)
        .when(F.col("kind") == KINDS.index("card"), F.when(n.between(13, 19), luhn(number)).otherwise(False))
        .otherwise(n.between(10, 15) & hit.rlike(r"^(?:\+|00|\()") & ~octets)
    )
    return c.withColumn("label", F.coalesce(passes, F.lit(False)).cast("double"))


def _features(c: DataFrame) -> DataFrame:
    hit = F.col("hit")
    count = lambda pattern: F.length(hit) - F.length(F.regexp_replace(hit, pattern, ""))
    groups = F.split(hit, "[^0-9]+")
    made = {
        "f_length": F.least(F.length(hit), F.lit(200)), "f_digits": F.length(digits(hit)), "f_letters": count("[A-Za-z]"), "f_separators": count(r"[\x20/_-]"), "f_dots": count("[.]"), "f_brackets": count(r"[()\[\]]"),
        "f_groups": F.size(groups), "f_longest": F.array_max(F.transform(groups, F.length)), "f_plus": hit.startswith("+"), "f_first": F.coalesce(F.try_to_number(F.left(digits(hit), F.lit(1)), F.lit("9")), F.lit(-1)),
        "f_before_space": F.col("before").rlike(r"(^|\s)$"), "f_before_digit": F.col("before").rlike("[0-9]$"), "f_before_word": F.col("before").rlike(r"\p{L}$"), "f_after_space": F.col("after").rlike(r"^(\s|$)"), "f_after_digit": F.col("after").rlike("^[0-9]"), "f_after_word": F.col("after").rlike(r"^\p{L}"), "f_cue": F.col("before").rlike(CUES),
    }
    return c.withColumns({k: v.cast("double") for k, v in made.items()})


def _free(each: DataFrame, base: DataFrame) -> DataFrame:
    """each (k1, k2, kind, start, end, ...) with free: no base span of the text overlaps it. A span overlaps one that starts
    no later if any of those ends after its start, and one that starts no earlier if the first of those starts before its end."""
    both = each.withColumn("_base", F.lit(False)).unionByName(base.withColumn("_base", F.lit(True)), allowMissingColumns=True)
    order = Window.partitionBy("k1", "k2").orderBy("start")
    earlier = F.max(F.when(F.col("_base"), F.col("end"))).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    later = F.min(F.when(F.col("_base"), F.col("start"))).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    free = F.coalesce(earlier <= F.col("start"), F.lit(True)) & F.coalesce(later >= F.col("end"), F.lit(True))
    return both.withColumn("free", free).filter("not _base").drop("_base")


def thresholds(scored: DataFrame, precision: float = MIN_PRECISION) -> dict[int, float]:
    """Of each kind the least score, in steps of 1 / BINS, at and above which, with confidence, that share of the candidates pass
    their check."""
    bins = scored.groupBy("kind", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.count("*").alias("n"), F.sum("label").alias("good")).collect()  # 4 kinds of BINS bins
    least: dict[int, float] = {}
    for kind in range(len(KINDS)):
        n = good = 0
        for r in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"]):
            n, good = n + r["n"], good + r["good"]
            if boosting.at_least(good, n, CONFIDENCE) >= precision:
                least[kind] = r["bin"] / BINS
    return least


def _added(found: DataFrame, rows: int) -> DataFrame | None:
    """(k1, k2, added): spans beside the base ones, from (k1, k2, base, candidates). Texts that repeat count once."""
    each = found.select("k1", "k2", F.explode("candidates").alias("c")).select("k1", "k2", "c.*").distinct()
    base = found.select("k1", "k2", F.explode("base").alias("b")).select("k1", "k2", F.col("b.start").alias("start"), F.col("b.end").alias("end")).distinct()
    each = save(_free(_checked(each), base), "pii-candidates")
    fold = F.pmod(F.xxhash64("hit", "before"), F.lit(FOLDS))
    parts = []
    for kind in range(len(KINDS)):  # trees of its own, and each candidate's score is of trees that have not seen it
        for k in range(FOLDS):
            own = each.filter(F.col("kind") == kind)
            model = boosting.fit(_features(own.filter(fold != k)), FEATURES, "label", "hit", rows)
            if model is not None:
                parts.append(model.score(_features(own.filter(fold == k)), "p").select("k1", "k2", "kind", "start", "end", "label", "free", "p"))
    if not parts:
        return None
    scored = save(reduce(DataFrame.unionByName, parts), "pii-scores")
    threshold = F.lit(2.0)
    for kind, t in thresholds(scored).items():
        threshold = F.when(F.col("kind") == kind, t).otherwise(threshold)
    chosen = scored.filter(F.col("free") & (F.col("p") >= threshold))
    order = Window.partitionBy("k1", "k2").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    group = F.sum(F.when(F.col("start") < F.col("_reach"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = chosen.withColumn("_reach", reach).withColumn("_group", group)
    best = runs.groupBy("k1", "k2", "_group").agg(F.max(F.struct("p", "start", "kind", "end")).alias("s"))
    return best.groupBy("k1", "k2").agg(F.collect_list(F.struct("s.start", "s.kind", "s.end")).alias("added"))  # of one text


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = boosting.MAX_TRAINING_ROWS) -> DataFrame:
    """(id, k1, k2, base, added): arrays of (start, kind number in KINDS, end); k1 and k2 are the text's key."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = save(docs.select(F.col(id_col).alias("id"), *text_key(text), _base(text).alias("base"), _candidates(text).alias("candidates")), "pii")
    added = _added(found, rows)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if added is None:
        return found.select(F.col("id").alias(id_col), "k1", "k2", "base", none.alias("added"))
    added = save(added, "pii-added")
    joined = found.join(small(added, added.count(), ADDED_ROWS), ["k1", "k2"], "left")
    return joined.select(F.col("id").alias(id_col), "k1", "k2", "base", F.coalesce("added", none).alias("added"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))


def redacted(text: Column, spans: Column) -> Column:
    """text with each span, in order of start, replaced by [kind]; a span that begins inside the one before is part of it."""
    names = F.array(*map(F.lit, KINDS))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        out = F.concat(a["out"], F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), F.get(names, s["kind"]), F.lit("]"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], out).otherwise(a["out"]).alias("out"))

    return F.aggregate(F.array_sort(spans), start, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1, F.length(text))))
