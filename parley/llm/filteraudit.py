"""Filter interaction audit by failing-id relations (operator 13).

Each filter has a stored table of the ids that fail it.  What survives a prefix of filters
is what a chain of left-anti joins with their tables leaves; what the next filter removes
are the survivors that a left-semi join finds in its table.  A prefix counts as a set, so
that the 120 orders of five filters are read off the joins of its 31 proper prefixes.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import stored

#: The filters; E, a text that a smaller id has, is a relation between documents.
LETTERS = "ABCDE"


def conditions() -> dict[str, Column]:
    """Failure conditions of the filters A to D on the columns ``words`` and ``text``."""
    n = F.size("words")
    capitals = F.length("text") - F.length(F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct("words")) < 50 * n,
        "C": 100 * capitals > 3 * F.length("text"),
        "D": F.col("text").rlike(r"[#$%&*|]"),
    }


def base_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """A stored row per row of ``docs``: its number ``row``, ``part`` (a null is an empty
    string), whether it fails A, B, C, D and E, and whether it is labelled good or toxic.

    The texts are read once and not moved: E compares two 64-bit hashes of them.  A null
    text is empty; a null id is smaller than none and none is smaller than it, so it never
    fails E; equal rows (same id and text) do not fail E by each other.  A document is good
    (toxic) if any label row of its id says so.
    """
    bare = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), bare.alias("text"),
        F.filter(F.split(bare, "[ \\t-\\r]+"), lambda w: w != F.lit("")).alias("words"))
    flags = [c.alias(letter) for letter, c in conditions().items()]
    own = stored(own.select("row", "id", "part", F.xxhash64("text").alias("t"), F.xxhash64(F.lit("second"), "text").alias("u"), *flags), "audit-flags")
    first = stored(own.filter("id is not null").groupBy("t", "u").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last"), "audit-first")
    copies = own.join(first.hint("merge"), ["t", "u"]).filter("id > first").select("row", F.lit(True).alias("E"))
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marks = own.select("row", "id").join(stored(marks, "audit-labels").withColumnRenamed("doc_id", "id").hint("merge"), "id").select("row", "good", "toxic")
    yes = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    rows = own.join(stored(copies, "audit-copies").hint("merge"), "row", "left").join(stored(marks, "audit-marks").hint("merge"), "row", "left")
    return stored(rows.select("row", "part", *[yes(x) for x in LETTERS], yes("good"), yes("toxic")), "audit-rows")


def failing_ids(rows: DataFrame, letters: str = LETTERS) -> dict[str, DataFrame]:
    """One stored table per filter of the ids (``row``) that fail it."""
    return {x: stored(rows.filter(F.col(x)).select("row"), f"audit-fails-{x}") for x in letters}


def _counts(df: DataFrame, name: str, given: str) -> DataFrame:
    n = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    return df.groupBy("part").agg(F.count(F.lit(1)).alias("n"), n("good"), n("toxic")).select("part", F.lit(name).alias("what"), F.lit(given).alias("given"), "n", "good", "toxic")


def prefixes(rows: DataFrame, fails: Mapping[str, DataFrame]) -> DataFrame:
    """(part, what, given, n, good, toxic): ``what`` = ``all`` counts the rows, ``kept`` the
    survivors of the filters ``given`` (letters in order), a letter what that filter removes
    of them.

    Rows that fail no filter survive every prefix; they are counted once, and only the
    others are joined.  The prefixes are a tree: what survives one is stored, and one more
    anti-join gives what survives the next; the counts are stored for the prefixes of each
    length.  So a plan holds a few joins (one plan of all prefixes, 185 exchanges, took more
    memory of the driver than it has).
    """
    letters = sorted(fails)
    ids = fails[letters[0]]
    for x in letters[1:]:
        ids = ids.union(fails[x])
    bad = stored(rows.select("row", "part", "good", "toxic").join(ids.hint("merge"), "row", "left_semi"), "audit-bad")
    out = stored(_counts(rows, "all", ""), "audit-count")
    alive = {"": bad}
    for k in range(len(letters) + 1):
        found = []
        for given in map("".join, combinations(letters, k)):
            if k:
                rest = alive[given[:-1]].join(fails[given[-1]].hint("merge"), "row", "left_anti")
                alive[given] = rest if given[-1] == letters[-1] else stored(rest, "audit-alive")  # the last letter opens no branch
            found.append(_counts(alive[given], "kept", given))
            if k in (0, len(letters) - 1):  # what a filter fails in all, and what it alone fails
                for x in letters:
                    if x not in given:
                        found.append(_counts(alive[given].join(fails[x].hint("merge"), "row", "left_semi"), x, given))
        out = out.union(stored(reduce(DataFrame.union, found), "audit-count"))
    return out


def audit(rows: DataFrame, fails: Mapping[str, DataFrame]) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley (all counts long).

    An empty table gives no rows (there is no part).
    """
    letters = sorted(fails)
    counts = stored(prefixes(rows, fails), "audit-counts")
    by = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(F.concat("what", F.lit(":"), "given"), F.struct("n", "good", "toxic")))).alias("m"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    steps = by.select("part", "m", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    steps = steps.withColumn("x", F.expr("substring(filter_order, step, 1)"))

    def in_order(given: str) -> Column:
        return F.array_join(F.array_sort(F.split(F.expr(given), "")), "")

    def n(what: str | Column, given: Column, field: str = "n") -> Column:
        key = F.concat(F.lit(what) if isinstance(what, str) else what, F.lit(":"), given)
        return F.coalesce(F.try_element_at("m", key)[field], F.lit(0).cast("long"))

    clean = n("all", F.lit("")) - n("kept", F.lit(""))
    before, after = in_order("substring(filter_order, 1, step - 1)"), in_order("substring(filter_order, 1, step)")
    others = F.expr(f"translate('{''.join(letters)}', x, '')")
    gone = lambda field: n("kept", before, field) - n("kept", after, field)
    table = steps.select(
        "part", "filter_order", "step", "x", (clean + n("kept", after)).alias("kept"), gone("n").alias("removed"), n(F.col("x"), F.lit("")).alias("failing"),
        n(F.col("x"), others).alias("unique_fails"), gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"))
    shapley = F.sum("removed").over(Window.partitionBy("part", "x"))  # 120 rows each
    return table.select("part", "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
                        "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"))
