"""Line dedup by winnowing over line hashes (operator 7).  DataFrame expressions only.

A document is its lines.  Two runs of at least ``run`` equal consecutive lines share the
minimum of their line hashes in every window of ``run`` lines, so the window minima are
fingerprints that no repeated run can avoid.  A shorter run of at least LONG_BYTES is a
window, and its hash a fingerprint, of its own.  Positions are joined on them: a
fingerprint that occurs once anywhere is dropped.  Around each other position the match is extended
both ways, to the windows that hold it; a window equal to an earlier one (by document id,
then place) is a later copy and its lines go.  Overlapping windows make up whole runs, so
a run of any length goes as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stored, whole

#: Lines of the shortest run that counts as repeated whatever its length, and UTF-8 bytes
#: (line feeds aside) from which a shorter run does: some 40 words.
RUN, LONG_BYTES = 3, 200

_KEY = ("__d", "__t", "__u")


def _key(doc_id: str, text: str) -> list[Column]:
    """What tells documents apart: the id and two hashes of the text (a null text is '')."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return [F.col(f"`{doc_id}`").alias("__d"), F.xxhash64(t).alias("__t"), F.xxhash64(F.lit("second"), t).alias("__u")]


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n", -1)


def fingerprints(docs: DataFrame, doc_id: str, text: str, run: int) -> DataFrame:
    """Per document its key and, as ``__f``, its fingerprints as structs of hash,
    place, and the windows that hold it, as structs of start, lines and two hashes
    (s, k, w, v).

    They are each distinct last minimum of the windows of ``run`` lines, and each shorter
    run of at least LONG_BYTES.  Each array is a column of its own, which the lambdas read
    by place.
    """
    d = docs.select(*_key(doc_id, text), F.transform(_lines(text), lambda x: F.struct(F.xxhash64(x).alias("h"), F.octet_length(x).alias("n"))).alias("__x"))
    d = d.select(*_KEY, F.transform("__x", lambda x: x["h"]).alias("__h"), F.transform("__x", lambda x: x["n"].cast("long")).alias("__n"))
    d = d.withColumn("__p", F.transform("__h", lambda h, i: F.struct(h.alias("h"), (-i).alias("i"))))
    places = lambda n, of: F.filter(F.sequence(F.lit(0), F.size(of)), lambda i: i <= F.size(of) - n)
    # a column that is read once would be computed anew for each element of a lambda
    d = d.withColumn("__l", F.transform(places(run, "__p"), lambda i: F.array_min(F.slice("__p", i + 1, run))))
    # their places never go back, so equal ones are neighbours
    d = d.withColumn("__m", F.filter("__l", lambda x, i: (i == 0) | (x["i"] != F.get("__l", i - 1)["i"])))
    lines = lambda s, k: [F.get("__h", s + j) for j in range(k)]
    window = lambda s, k: F.struct(
        s.alias("s"), F.lit(k).alias("k"), F.xxhash64(*lines(s, k)).alias("w"), F.xxhash64(F.lit("second"), F.lit(k), *lines(s, k)).alias("v"))
    around = lambda i: F.sequence(F.greatest(F.lit(0), i - (run - 1)), F.least(i, F.size("__h") - run))
    prints = [F.transform("__m", lambda x: F.struct(x["h"].alias("h"), (-x["i"]).alias("i"), F.transform(around(-x["i"]), lambda s: window(s, run)).alias("around")))]
    for k in range(1, run):
        long = F.filter(places(k, "__h"), lambda s: sum((F.get("__n", s + j) for j in range(k)), F.lit(0)) >= LONG_BYTES)  # noqa: B023
        prints.append(F.transform(long, lambda s: F.struct(F.xxhash64(F.lit("long"), *lines(s, k)).alias("h"), s.alias("i"), F.array(window(s, k)).alias("around"))))  # noqa: B023
    return d.select(*_KEY, F.concat(*prints).alias("__f"))


def later_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = RUN) -> DataFrame:
    """Per document with lines to delete: its key and ``__gone``, their places, sorted.

    Equal rows (same id, same text) cannot be told apart and count as one document.  What
    is joined is stored first: then either side of a join is a plain exchange, which
    adaptive execution can split where one line or passage is in very many documents.
    The joins sort at every size, so that work grows evenly with the input.
    """
    docs = docs.select(F.col(f"`{doc_id}`").alias(doc_id), F.col(f"`{text}`").alias(text))
    prints = stored(fingerprints(docs, doc_id, text, run), "line-prints")
    places = prints.select(*_KEY, F.explode("__f").alias("__x")).select(*_KEY, F.col("__x.h").alias("__hash"), F.col("__x.i").alias("__at"), "__x.around")
    # a fingerprint is worth extending if it stands at two different places
    spot = {"d": F.xxhash64(F.col("__d")), "t": F.col("__t"), "u": F.col("__u"), "i": F.col("__at")}
    ends = places.groupBy("__hash").agg(*[f(c).alias(f"{n}_{k}") for k, c in spot.items() for n, f in (("least", F.min), ("most", F.max))])
    two = F.lit(False)
    for k in spot:
        two = two | (F.col(f"least_{k}") != F.col(f"most_{k}"))
    shared = stored(ends.filter(two).select("__hash"), "line-shared")
    # extend: the windows of `run` lines around the position, inside the document, or the long run
    windows = places.select(*_KEY, "__hash", F.explode("around").alias("__w"))
    windows = stored(windows.join(shared.hint("merge"), "__hash", "left_semi").select(*_KEY, "__w.*").distinct(), "line-windows")
    place = F.struct(*_KEY, "s")  # equal windows are of equally many lines
    first = windows.groupBy("w", "v").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = stored(first.filter(~F.col("first").eqNullSafe(F.col("last"))).select("w", "v", "first"), "line-firsts")
    later = windows.join(first.hint("merge"), ["w", "v"]).filter(~place.eqNullSafe(F.col("first")))
    gone = F.flatten(F.transform(F.collect_set(F.struct("s", "k")), lambda x: F.sequence(x["s"], x["s"] + x["k"] - 1)))
    return stored(later.groupBy(*_KEY).agg(F.sort_array(F.array_distinct(gone)).alias("__gone")), "line-gone")


def _shortened(docs: DataFrame, doc_id: str, text: str, run: int) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, its ``text``, ``__gone`` (places of the
    deleted lines, null if none) and ``__new``, the text without them."""
    gone = later_lines(docs, doc_id, text, run)
    keyed = docs.select(whole(docs), *[c.alias(f"__own{k}") for c, k in zip(_key(doc_id, text), _KEY)])
    same = F.lit(True)
    for k in _KEY:
        same = same & F.col(f"__own{k}").eqNullSafe(F.col(k))
    out = keyed.join(gone.hint("merge"), same, "left").withColumn("text", F.col(f"row.`{text}`"))
    out = out.withColumn("__lines", F.when(F.col("__gone").isNotNull(), _lines("text")))
    # the stretches between deleted lines
    out = out.withColumn("__edge", F.concat(F.array(F.lit(-1)), F.col("__gone"), F.array(F.size("__lines"))))
    gaps = F.transform("__edge", lambda e, i: F.struct((F.get("__edge", i - 1) + 1).alias("a"), (e - F.get("__edge", i - 1) - 1).alias("n")))
    kept = F.transform(F.filter(gaps, lambda g: g["n"] > 0), lambda g: F.slice("__lines", g["a"] + 1, g["n"]))
    return out.withColumn("__new", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(kept), "\n")))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = RUN, length: str | None = None) -> DataFrame:
    """``docs`` with every later copy of a run of at least ``run`` lines, or of LONG_BYTES in
    fewer, deleted from ``text``, the other lines joined by line feeds as before; ``length``, if named, is set
    to the new number of code points of a changed text.  All rows and columns stay.

    "Earlier" is by document id (nulls first), then place in the text; texts that share an
    id are ordered by hash.  Equal rows are one document and keep or lose the same lines.
    Empty lines are lines.  A null text has no line to delete and stays null; a document
    whose every line is a later copy keeps an empty text.  An empty table gives none.
    """
    out = _shortened(docs, doc_id, text, run)
    changed = {text: F.col("__new")}
    if length:
        changed[length] = F.when(F.col("__gone").isNull(), F.col(f"row.`{length}`")).otherwise(F.length("__new").cast(docs.schema[length].dataType))
    return out.select([changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def line_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = RUN) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_deleted and the text that is left
    (see ``dedup_lines`` for every case; a null text has no lines)."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines("text"))).cast("long")
    n_deleted = F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long")
    return _shortened(rows, "doc_id", "text", run).select("row.doc_id", n_lines.alias("n_lines"), n_deleted.alias("n_deleted"), F.col("__new").alias("text"))
