"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Each rule is a ratio (higher is worse) with a fixed grid of cutoffs.  A *policy* is a cutoff
for some of the rules; it rejects a document that passes any of them.  Labelled documents are
split in two by a checksum of the id.  A third proposes: for each of a few levels, every
rule's best cutoff that rejects at most that share of the good documents.  The rest is the
holdout: for every stratum and policy an exact binomial test asks whether the *whole policy*
rejects good documents at a rate of at most ``alpha``.  A policy may be used if its p-value
stays below ``delta`` divided by the number of all tests (Bonferroni), so with probability
``1 - delta`` the policies in use reject together at most ``alpha`` of the good documents in
every stratum.  Of a stratum's proven policies the one that separates best is taken.

A trial is a different text: rows of one id count once, and so do ids with equal texts in a
stratum, or copies would pass for evidence.  Strata with too few good trials in the holdout
for any policy to be proven, even without a single false rejection, are tested together as one
(``POOL``), and the promise then holds for them together; strata without labels use no policy.

Everything is DataFrame expressions; no shuffle carries texts.

Defined results: a null text counts as empty (no words: the base rules reject it); a null
stratum is a stratum; a ``doc_id`` labelled both ways counts as good, and so does a text; of an
id with several texts one is the trial (smallest hash); rows with null ids or labels teach
nothing; without labels no policy applies; repeated rows each get their result and
change no cutoff; ties go to the higher cutoff, then the safer level; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import WHITE_CHARS, text_of, words
from demandloom.session import stage

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Largest rate of false rejections of all rules together in one stratum, and the chance of error.
ALPHA = 0.03
DELTA = 0.05
#: One policy per level: the share of ``alpha`` that a rule may reject among the proposing documents.
LEVELS = [0.0, 0.0625, 0.125, 0.25]
#: Of this many parts of the labelled documents one proposes.
PARTS = 3
#: The name under which small strata are tested together; a stratum's own name begins with a letter and a colon.
POOL = "pool"
#: Terms of a binomial tail that are summed one by one.
TERMS = 10_000
CUTOFFS = [0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
#: Rules over the columns of ``features``; a ratio with nothing below it is 0.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "bangs": ("n_bangs", "word_chars"),
    "same_words": ("n_same_words", "n_words"),
}


def repeat_words(hashes: Column) -> Column:
    """Windows of ``WINDOW`` word hashes as one hash each."""
    last = F.size(hashes) - WINDOW
    return F.when(
        last >= 0, F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))
    ).otherwise(F.array().cast("array<bigint>"))


def features(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts per document; the row's own arrays do the work, no shuffle."""
    strat = F.col(stratum).cast("string") if stratum in docs.columns else F.lit(None).cast("string")
    base = docs.select("doc_id", strat.alias("stratum"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, WHITE_CHARS, "") != "")
    length = lambda drop: F.length(F.translate("text", drop, ""))
    counted = base.select(
        "doc_id",
        "stratum",
        F.struct(F.xxhash64("text").alias("a"), F.hash("text").alias("b"), F.length("text").alias("n")).alias("text_key"),
        F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"),
        length(WHITE_CHARS).cast("long").alias("word_chars"),
        (F.length("text") - length(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length("text") - length(UPPER)).cast("long").alias("n_upper"),
        (F.length("text") - length("!")).cast("long").alias("n_bangs"),
        lines.alias("lines"),
    )
    windows = counted.select(
        "*", repeat_words(F.col("hashes")).alias("windows"), F.size(F.array_distinct("hashes")).alias("n_kinds")
    )
    # Only texts with a repeated window sort their windows.
    ranked = windows.withColumn(
        "ranked",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    same = lambda k, x: F.coalesce(F.get("ranked", k)["h"] == x["h"], F.lit(False))
    starts = ranked.withColumn(
        "starts",
        F.sort_array(
            F.transform(F.filter("ranked", lambda x, k: same(k - 1, x) | same(k + 1, x)), lambda x: x["i"])
        ),
    )
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total")),
        lambda a, p: F.struct(
            (p + WINDOW).alias("end"), (a["total"] + p + WINDOW - F.greatest(p, a["end"])).alias("total")
        ),
        lambda a: a["total"],
    )
    return starts.select(
        "doc_id",
        "stratum",
        "text_key",
        F.size("hashes").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_upper",
        "n_bangs",
        (F.size("hashes") - F.col("n_kinds")).cast("long").alias("n_same_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratio(rule: str) -> Column:
    over, under = RULES[rule]
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(0.0)


def log_gamma(z: Column) -> Column:
    """ln Gamma(z) for z >= 1 by Stirling's series, eight places further up."""
    shift = F.lit(0.0)
    for i in range(8):
        shift = shift + F.log(z + i)
    x = z + 8.0
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x) - 1 / (1680 * F.pow(x, 7.0))
    return (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series - shift


def lower_tail(k: Column, n: Column, p: float, terms: int = TERMS) -> Column:
    """P(X <= k) of a binomial variable, summed from k downwards.

    The terms shrink at least as fast as a geometric series; what is left after ``terms``
    of them is replaced by that series, so the result is never too small.
    """
    kd, nd, odds = k.cast("double"), n.cast("double"), (1 - p) / p
    first = log_gamma(nd + 1) - log_gamma(kd + 1) - log_gamma(nd - kd + 1) + kd * math.log(p) + (nd - kd) * math.log1p(-p)
    ratio_at = lambda i: i / (nd - i + 1) * odds
    # Above the mean the tail is over a third anyway and no policy passes.
    below = k <= p * n
    stop = F.greatest(k - terms, F.lit(0).cast("long"))
    steps = F.when(below & (k > 0), F.sequence(k, stop + 1, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    one = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def add(a: Column, i: Column) -> Column:
        t = a["t"] * ratio_at(i.cast("double"))
        return F.struct(t.alias("t"), (a["s"] + t).alias("s"))

    def close(a: Column) -> Column:
        r = ratio_at(stop.cast("double"))
        return F.exp(first) * (a["s"] + F.when(stop > 0, a["t"] * r / (1 - r)).otherwise(0.0))

    return F.when(~below, F.lit(1.0)).otherwise(F.least(F.aggregate(steps, one, add, close), F.lit(1.0)))


def trials(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per stratum and different labelled text: ``good``, ``proposes`` and the counts."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    counts = sorted({c for pair in RULES.values() for c in pair})
    per_id = (
        feats.join(known, "doc_id").groupBy("doc_id")
        .agg(F.max("quality").alias("quality"), F.min(F.struct("text_key", "stratum", *counts)).alias("t"))
    )
    per_text = per_id.groupBy(F.col("t.stratum").alias("stratum"), F.col("t.text_key").alias("text_key")).agg(
        (F.max("quality") == 1).alias("good"),
        F.min("doc_id").alias("doc_id"),
        F.min(F.struct(*[F.col(f"t.{c}").alias(c) for c in counts])).alias("c"),
    )
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(PARTS))
    return per_text.select("stratum", "good", (fold == 0).alias("proposes"), "c.*")


def cells(tried: DataFrame, alpha: float, delta: float) -> tuple[DataFrame, float]:
    """(stratum, cell) for every labelled stratum, and the p-value a policy must reach."""
    per_stratum = tried.groupBy("stratum").agg(F.sum((F.col("good") & ~F.col("proposes")).cast("long")).alias("n"))
    tests = (per_stratum.count() + 1) * len(LEVELS)
    need = math.log(delta / tests) / math.log1p(-alpha)
    own = F.coalesce(F.concat(F.lit("s:"), "stratum"), F.lit("n:"))
    named = per_stratum.select("stratum", F.when(F.col("n") >= need, own).otherwise(POOL).alias("cell"))
    return named, delta / tests


def proposals(tried: DataFrame, alpha: float) -> DataFrame:
    """(cell, level, cut_<rule> ...): the policies that the proposing part suggests."""
    counts = [
        F.sum(F.when(ratio(rule) > c, 1).otherwise(0)).alias(f"{rule}_{j}") for rule in RULES for j, c in enumerate(CUTOFFS)
    ]
    table = tried.filter("proposes").groupBy("cell", "good").agg(F.count("*").alias("n"), *counts)
    grid = ", ".join(
        f"named_struct('rule', '{rule}', 'cutoff', {c}D, 'k', {rule}_{j})" for rule in RULES for j, c in enumerate(CUTOFFS)
    )
    long = table.select("cell", "good", "n", F.explode(F.expr(f"array({grid})")).alias("c")).select("cell", "good", "n", "c.*")
    rates = long.groupBy("cell", "rule", "cutoff").agg(*_split("k", "n")).withColumn("gain", _gain()).filter("gain > 0")
    levels = F.explode(F.array([F.struct(F.lit(i).alias("level"), F.lit(x * alpha).alias("share")) for i, x in enumerate(LEVELS)]))
    allowed = rates.withColumn("l", levels).filter(F.col("k_good") <= F.col("l.share") * F.col("n_good"))
    best = allowed.groupBy("cell", F.col("l.level").alias("level"), "rule").agg(F.max(F.struct("gain", "cutoff")).alias("b"))
    return best.groupBy("cell", "level").agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("b.cutoff"))).alias(f"cut_{rule}") for rule in RULES]
    )


def _split(k: str, n: str) -> list[Column]:
    pick = lambda flag, col: F.coalesce(F.sum(F.when(F.col("good") == flag, F.col(col))), F.lit(0)).cast("long")
    return [pick(True, n).alias("n_good"), pick(True, k).alias("k_good"), pick(False, n).alias("n_bad"), pick(False, k).alias("k_bad")]


def _gain() -> Column:
    """Share of bad documents rejected less that of good ones; 0 where no bad one is."""
    rate = lambda k, n: F.when(F.col(n) > 0, F.col(k) / F.col(n)).otherwise(0.0)
    return F.when(F.col("k_bad") > 0, rate("k_bad", "n_bad") - rate("k_good", "n_good")).otherwise(0.0)


def rejected() -> Column:
    """Whether any cutoff of the row's policy is passed."""
    found = F.lit(False)
    for rule in RULES:
        found = found | F.coalesce(ratio(rule) > F.col(f"cut_{rule}"), F.lit(False))
    return found


def policies(feats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, cell, level, cut_<rule> ..., n_good, k_good, n_bad, k_bad, p_value) of the policies in use."""
    tried = stage(trials(feats, labels), "rule-trials")
    named, most = cells(tried, alpha, delta)
    named = stage(named, "rule-cells")
    strata = named.withColumnRenamed("stratum", "s")
    tried = tried.join(strata, F.expr("stratum <=> s")).drop("s")
    proposed = stage(proposals(tried, alpha), "rule-policies")
    holdout = tried.filter("not proposes").join(proposed, "cell")
    counted = (
        holdout.select("cell", "level", "good", F.lit(1).alias("one"), rejected().cast("long").alias("k"))
        .groupBy("cell", "level").agg(*_split("k", "one")).withColumn("gain", _gain())
    )
    proven = (
        counted.filter("gain > 0 and n_good > 0")
        .withColumn("p_value", lower_tail(F.col("k_good"), F.col("n_good"), alpha))
        .filter(F.col("p_value") <= most)
    )
    figures = ["n_good", "k_good", "n_bad", "k_bad", "p_value"]
    best = proven.groupBy("cell").agg(F.max(F.struct("gain", (-F.col("level")).alias("safe"), "level", *figures)).alias("b"))
    best = best.select("cell", "b.level", *[f"b.{x}" for x in figures])
    return named.join(best.join(proposed, ["cell", "level"]), "cell")


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The base counts, ``base_failed`` and ``kept`` per document."""
    feats = stage(features(docs, stratum), "rule-features")
    chosen = stage(policies(feats, labels, alpha, delta), "rules").select(F.col("stratum").alias("known"), *[f"cut_{r}" for r in RULES])
    judged = feats.join(chosen, F.expr("stratum <=> known"), "left")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~rejected()).alias("kept"),
    )
