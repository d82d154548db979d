"""Quality rules: text statistics and learned decision lists (operator 3).

Everything here is DataFrame expressions.  The learner sees only labelled statistics:
each growing step is one aggregate over the labelled rows, a count per feature and bin.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stored, whole

#: Words per window of the repetition count.
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Learner: conditions per rule, the share of rejected rows in a rule's pruning rows, the
#: rejected rows a rule must cover there, and regions set aside in a row before it ends.
MAX_CONDITIONS, MIN_PRECISION, MIN_COVER, MAX_ASIDE = 4, 0.97, 5, 4
#: Quantiles of a feature between which thresholds lie: 16 evenly, the extremes, and tails
#: down to one row in 4,096.
QUANTILES = sorted({0.0, 1.0, *((i + 0.5) / 16 for i in range(16)), *(2.0**-k for k in range(6, 13)), *(1 - 2.0**-k for k in range(6, 13))})
#: Of this many parts of the labelled rows one prunes; the others grow.
FOLDS = 3

_SPACES = r"[\x20\x09-\x0D]"
_SYMBOLS = r"[#*$%&|<>]+"

FEATURES = ("n_words", "mean_word_chars", "symbol_share", "upper_share", "exclamation_share", "bar_share", "dup_line_share", "repeat_share")


def _count(pattern: str) -> Column:
    """Characters of ``__text`` in runs that match ``pattern``."""
    return (F.length("__text") - F.length(F.regexp_replace("__text", F.lit(pattern), F.lit("")))).cast("long")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and, in ``__s``, a struct of its text's statistics.

    A word is a run of characters other than space, tab, line feed, vertical tab, form
    feed and carriage return.  Null is an empty text: no words, all counts 0.
    """
    n = F.size("__words")
    out = docs.withColumn("__text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    out = out.withColumn("__words", F.filter(F.split("__text", _SPACES + "+"), lambda w: w != ""))
    out = out.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    gram = lambda i: F.xxhash64(*[F.get("__words", i + j) for j in range(WINDOW)])
    empty = F.array().cast("array<bigint>")
    out = out.withColumn("__grams", F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), gram)).otherwise(empty))
    # windows found twice, sorted so that equal ones are neighbours; most texts have none
    twice = F.size(F.array_distinct("__grams")) < F.size("__grams")
    pairs = F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    out = out.withColumn("__sorted", F.when(twice, F.sort_array(pairs)).otherwise(F.array().cast("array<struct<g:bigint,i:int>>")))
    same = lambda x, i: (x["g"] == F.get("__sorted", i - 1)["g"]) | (x["g"] == F.get("__sorted", i + 1)["g"])
    places = F.sort_array(F.transform(F.filter("__sorted", lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"]))
    covered = F.aggregate(  # words in the union of the windows at those places
        places, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")), lambda a: a["n"].cast("long"))
    # exploded from an array of one, so that a filter on the statistics is not moved below
    # them, where every use of an array would be computed anew
    out = out.withColumn("__s", F.explode(F.array(F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        _count(_SYMBOLS).alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        _count(r"\p{Lu}+").alias("n_upper"),
        _count("!+").alias("n_exclamations"),
        _count(r"\|+").alias("n_bars")))))
    return out.drop("__text", "__words", "__lines", "__grams", "__sorted")


def features(s: str = "__s") -> dict[str, Column]:
    """The learner's features of a struct of statistics; 0 where there is nothing to divide by."""
    c = lambda name: F.col(f"{s}.{name}")
    share = lambda a, b: F.when(c(b) > 0, c(a) / c(b)).otherwise(F.lit(0.0))
    return {
        "n_words": c("n_words").cast("double"), "mean_word_chars": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "word_chars"),
        "upper_share": share("n_upper", "word_chars"), "exclamation_share": share("n_exclamations", "n_words"), "bar_share": share("n_bars", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words")}


def base_failed(s: str = "__s") -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col(f"{s}.n_words") < MIN_WORDS) | (100 * F.col(f"{s}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{s}.n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        f = F.col(self.feature)
        return f > self.threshold if self.above else f <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The first rule that rejects a row, as text; null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(_all(rule), F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds: midpoints between neighbouring quantiles of each feature over
    either class, so that a threshold keeps its distance from the values it separates.
    One aggregate."""
    q = lambda f, own: F.percentile_approx(F.when(F.col(own) > 0, F.col(f)), QUANTILES, 10_000).alias(f"{f}_{own}")
    got = rows.agg(*[q(f, own) for f in FEATURES for own in ("bad", "good")]).first()
    values = {f: sorted({*(got[f"{f}_bad"] or []), *(got[f"{f}_good"] or [])}) for f in FEATURES}
    return {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in values.items()}


def _best(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[float, float, list[tuple[float, Condition, float, float]]]:
    """(rejected, accepted) of ``rows`` and every candidate condition with its gain."""
    bin_of = lambda f: F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda t: t < F.col(f)))
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), bin_of(f).alias("b")) for f in FEATURES if cuts[f]]))
    got = rows.select("bad", "good", cells.alias("c")).groupBy("c.f", "c.b").agg(F.sum("bad").alias("p"), F.sum("good").alias("n")).collect()
    out, p0, n0 = [], 0, 0
    for f in FEATURES:
        mine = {r["b"]: (r["p"], r["n"]) for r in got if r["f"] == f}
        if not mine:
            continue
        p0, n0 = (sum(x[k] for x in mine.values()) for k in (0, 1))
        p = n = 0
        for b, t in enumerate(cuts[f]):
            p, n = p + mine.get(b, (0, 0))[0], n + mine.get(b, (0, 0))[1]
            out += [(_gain(p, n, p0, n0), Condition(f, False, t), p, n), (_gain(p0 - p, n0 - n, p0, n0), Condition(f, True, t), p0 - p, n0 - n)]
    return p0, n0, out


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> list[Rule]:
    """Two rules from the growing rows: the one grown by information gain, and the single
    condition that covers most rejected rows precisely."""
    grown: Rule = ()
    plain: list[Rule] = []
    while any(cuts.values()) and len(grown) < MAX_CONDITIONS:
        p0, n0, found = _best(rows.filter(_all(grown)), cuts)
        if not grown:
            if p0 < MIN_COVER:
                break
            precise = [x for x in found if x[2] >= MIN_COVER and x[2] >= MIN_PRECISION * (x[2] + x[3]) and n0]
            plain = [(max(precise, key=lambda x: x[2])[1],)] if precise else []
        found = [x for x in found if x[0] > 1e-9 and x[1] not in grown]
        if not p0 or not n0 or not found:
            break
        grown += (max(found, key=lambda x: x[0])[1],)
    return ([grown] if grown else []) + plain


def _pruned(rows: DataFrame, rule: Rule) -> Rule | None:
    """``rule`` without the final conditions that the pruning rows do not need; None if it is
    not precise enough on them."""
    sums = [F.sum(F.when(_all(rule[:k]), F.col(c)).otherwise(0)).alias(f"{c}{k}") for k in range(1, len(rule) + 1) for c in ("bad", "good")]
    got = rows.agg(*sums).first()
    count = lambda c, k: got[f"{c}{k}"] or 0
    value = lambda k: (count("bad", k) - count("good", k)) / max(1, count("bad", k) + count("good", k))
    k = max(range(1, len(rule) + 1), key=lambda k: (value(k), -k))
    p, n = count("bad", k), count("good", k)
    return rule[:k] if p >= MIN_COVER and p >= MIN_PRECISION * (p + n) else None


def learn(rows: DataFrame) -> list[Rule]:
    """A decision list from rows of the features, ``bad`` and ``good`` (label counts) and
    ``prune`` (boolean).

    Sequential covering, with thresholds taken anew from the rows left before each rule: a
    rule grows by the condition of most information gain on the growing rows until it covers
    no accepted row, then loses final conditions as long as that does not lower
    (p - n) / (p + n) on the pruning rows.  If it is not precise enough there, the single
    condition that covers most rejected rows precisely is tried.  Rows that a rule covers
    leave.  Where neither is precise, the grown rule's region is set aside for growing (not
    for pruning) and learning goes on; it ends when fewer than MIN_COVER rejected rows are
    left to grow from, or after MAX_ASIDE such regions in a row.  Ties go to the earlier
    feature, then the lower threshold, then <=.  Without labels of both classes the list is
    empty.
    """
    rules: list[Rule] = []
    aside: list[Rule] = []
    missed = 0
    while missed < MAX_ASIDE:
        left = rows
        for r in rules:
            left = left.filter(~_all(r))
        free = left.filter(~F.col("prune"))
        for r in aside:
            free = free.filter(~_all(r))
        tried = _grow(free, _thresholds(free))
        if not tried:
            break
        good = next((x for x in (_pruned(left.filter("prune"), r) for r in tried) if x), None)
        if good:
            rules.append(good)
            missed = 0
        else:
            aside.append(tried[0])
            missed += 1
    return rules


def labelled(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Features of the labelled rows of ``statistics`` that pass the base rule (the others
    need no verdict) with their label counts, stored.  Labels are summed per id first, so a repeated label or id does not multiply rows; null
    ids and null labels are no labels."""
    marks = labels.select(F.col(label_id).alias("__id"), F.col(quality).alias("__q")).filter("__id is not null and __q is not null")
    marks = marks.groupBy("__id").agg(F.sum((F.col("__q") == 0).cast("long")).alias("bad"), F.sum((F.col("__q") != 0).cast("long")).alias("good"))
    own = rows.filter(~base_failed()).select(F.col(doc_id).alias("__id"), *[c.alias(f) for f, c in features().items()])
    return stored(own.join(marks, "__id").select(*FEATURES, "bad", "good", (F.pmod(F.xxhash64("__id"), F.lit(FOLDS)) == 0).alias("prune")), "labelled")


def judged(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows of ``statistics`` with ``__base_failed``, ``__rule`` and ``__kept``."""
    held = rows.withColumns({"__base_failed": base_failed(), **{f"__f_{f}": c for f, c in features().items()}})
    named = [tuple(Condition(f"__f_{c.feature}", c.above, c.threshold) for c in r) for r in rules]
    held = held.withColumn("__rule", F.regexp_replace(verdict(named), "__f_", ""))
    return held.withColumn("__kept", ~F.col("__base_failed") & F.col("__rule").isNull()).drop(*[f"__f_{f}" for f in FEATURES])


def assess(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the statistics, base_failed, rule (the learned
    rule that rejects it, or null) and kept.

    Null and empty texts have no words and fail the base rule; equal rows get equal
    results; an empty table gives no rows; without usable labels only the base rule holds.
    Other columns of ``docs`` are ignored.
    """
    rows = stored(statistics(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))).drop("text"), "statistics")
    rules = learn(labelled(rows, labels))
    return judged(rows, rules).select(
        "doc_id", "__s.*", F.col("__base_failed").alias("base_failed"), F.col("__rule").alias("rule"), F.col("__kept").alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rejected rows, all columns kept (cases as in ``assess``).  The
    statistics are computed for the learner and again for the filter: cheaper than moving
    the texts to join them."""
    rules = learn(labelled(statistics(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))), labels))
    return judged(statistics(docs.select(whole(docs), F.col(f"`{text}`").alias("text"))), rules).filter("__kept").select("row.*")
