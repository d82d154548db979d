"""Merkle fixity audit of archive replicas (operator 1).

A replica is a table of records: archive, offset, n_bytes and digest.  Records are hashed
into nodes by ranges of LEAF_BYTES of their archive's offsets, nodes into parents of FAN
consecutive ranges, up to a root per archive.  Two replicas are compared root by root; below a
root that differs only the children that differ are followed, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import stored

#: Bytes of an archive whose records make a leaf, and children of a node.
LEAF_BYTES, FAN = 1 << 16, 16
#: Leaves over which records without an offset are dealt, by their digests.
UNPLACED = 1 << 16
#: Copies of a record laid out from one row, and leading hex digits of the digests that share a cell.
COPIES, DIGITS = 1 << 16, 4
#: Records in an archive that ``warc_records`` lays out.
ARCHIVE_RECORDS = 1000


def _digest(parts: Column) -> Column:
    """SHA-256 of structs (place, text), in the order of their places."""
    return F.sha2(F.array_join(F.transform(F.sort_array(parts), lambda x: F.concat_ws(" ", x["place"].cast("string"), x["text"])), "\n"), 256)


def _leaf() -> Column:
    """The leaf of a record: the range of its offset, or below 0 one by its digest."""
    return F.when(F.col("offset") >= 0, F.floor(F.col("offset") / LEAF_BYTES)).otherwise(-1 - F.pmod(F.xxhash64("n_bytes", "digest"), F.lit(UNPLACED))).cast("long")


def _levels(records: DataFrame, depth: int) -> list[DataFrame]:
    """The nodes (archive, range, digest) of each level, leaves first, roots (range 0) last."""
    entry = F.struct(F.col("offset").alias("place"), F.concat_ws(" ", F.col("n_bytes").cast("string"), "digest", F.col("copies").cast("string")).alias("text"))
    spots = records.groupBy("archive", "offset", "n_bytes", "digest").agg(F.count(F.lit(1)).alias("copies"))
    leaves = spots.groupBy("archive", _leaf().alias("range")).agg(_digest(F.collect_list(entry)).alias("digest"))
    out = [stored(leaves, "merkle-leaves")]
    child = F.struct(F.col("range").alias("place"), F.col("digest").alias("text"))
    for _ in range(depth):
        up = out[-1].groupBy("archive", F.floor(F.col("range") / FAN).cast("long").alias("range")).agg(_digest(F.collect_list(child)).alias("digest"))
        out.append(stored(up, "merkle-nodes"))
    return out


def _differing(ours: DataFrame, theirs: DataFrame, within: DataFrame | None) -> DataFrame:
    """(archive, range) of the nodes that are not alike, among the children of ``within``."""
    if within is not None:
        parent = within.select("archive", F.col("range").alias("parent"))
        ours, theirs = (x.withColumn("parent", F.floor(F.col("range") / FAN).cast("long")).join(parent, ["archive", "parent"], "left_semi") for x in (ours, theirs))
    both = ours.select("archive", "range", F.col("digest").alias("a")).join(theirs.select("archive", "range", F.col("digest").alias("b")), ["archive", "range"], "full")
    return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("archive", "range")


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """One row per record that is not alike in two replicas: archive, offset, status
    ('changed', 'missing' from theirs, 'extra' in theirs), n_bytes and digest in ours, and
    their_bytes and their_digest.

    Replicas are (archive string, offset long, n_bytes long, digest string); a record is
    named by archive and offset.  Repeated records are compared as a multiset: where the
    counts differ, each is reported.  A null archive is '', a null offset -1, null digests
    are equal to each other only.  Equal or empty replicas give no rows.  Other columns are
    ignored.

    A leaf holds each distinct record once, with its number of copies; records below offset
    0 are dealt over UNPLACED leaves of their archive by digest.  A leaf then has as many
    entries as different records start in LEAF_BYTES.
    """
    def clean(x: DataFrame) -> DataFrame:
        return x.select(F.coalesce("archive", F.lit("")).alias("archive"), F.coalesce(F.col("offset").cast("long"), F.lit(-1)).alias("offset"),
                        F.coalesce(F.col("n_bytes").cast("long"), F.lit(-1)).alias("n_bytes"), F.coalesce("digest", F.lit("-")).alias("digest"))

    ours, theirs = clean(ours), clean(theirs)
    most = ours.select("offset").union(theirs.select("offset")).agg(F.max("offset").alias("m")).first()["m"] or 0
    depth, ranges = 0, most // LEAF_BYTES + 1
    while ranges > 1:
        depth, ranges = depth + 1, -(-ranges // FAN)
    trees = _levels(ours, depth + 1), _levels(theirs, depth + 1)
    wrong = None
    for level in range(depth + 1, -1, -1):
        wrong = stored(_differing(trees[0][level], trees[1][level], wrong), "merkle-wrong")
    spot = ["archive", "offset"]

    def own(x: DataFrame) -> DataFrame:
        held = x.withColumn("range", _leaf()).join(wrong, ["archive", "range"], "left_semi")
        return held.groupBy(*spot, "n_bytes", "digest").agg(F.count(F.lit(1)).alias("copies"))

    a, b = own(ours), own(theirs)
    odd_a, odd_b = (x.join(y, [*spot, "n_bytes", "digest", "copies"], "left_anti") for x, y in ((a, b), (b, a)))
    odd_b = odd_b.select(*spot, F.col("n_bytes").alias("their_bytes"), F.col("digest").alias("their_digest"), F.col("copies").alias("their_copies"))
    status = F.when(F.col("their_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("changed")
    return odd_a.join(odd_b, spot, "full").select(*spot, status.alias("status"), "n_bytes", "digest", "their_bytes", "their_digest")


def warc_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` as WARC resource records: archive, offset, n_bytes, digest, and the page's
    id and payload.  An archive holds the records of ARCHIVE_RECORDS consecutive integer
    ids, in order of id, then digest; nulls count as -1 and as empty texts."""
    own = F.coalesce(F.col(f"`{page_id}`").cast("long"), F.lit(-1))
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    payload = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), own.cast("string"), F.lit(">\r\nWARC-Target-URI: "), F.coalesce(F.col(f"`{url}`"), F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))
    return pages.select(own.alias("page_id"), F.format_string("%08d.warc", F.floor(own / ARCHIVE_RECORDS).cast("long")).alias("archive"), payload.alias("payload"))


def indexed(records: DataFrame) -> DataFrame:
    """page_id, archive, n_bytes, digest and offset of the records (page_id, archive,
    payload): in each archive end to end, in order of id, then digest (nulls first).

    A null payload has no bytes and a null digest.  Equal records lie next to each other.
    An empty table gives no rows; other columns are ignored.  Offsets are sums in two
    steps, over the distinct records of a cell (an id and the first DIGITS of the digest)
    and over the cells before it, so one id may hold any share of the rows.
    """
    rows = records.select("page_id", "archive", F.coalesce(F.octet_length("payload"), F.lit(0)).cast("long").alias("n_bytes"), F.sha2("payload", 256).alias("digest"))
    cell = ["archive", "page_id", "__cell"]
    once = rows.groupBy("archive", "page_id", "n_bytes", "digest").agg(F.count(F.lit(1)).alias("__n")).withColumn("__cell", F.substring("digest", 1, DIGITS))
    once = stored(once, "warc-distinct")
    so_far = lambda w, n: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = once.groupBy(*cell).agg(F.sum(F.col("n_bytes") * F.col("__n")).alias("__bytes"))
    bases = cells.select(*cell, so_far(Window.partitionBy("archive").orderBy("page_id", "__cell"), "__bytes").alias("__base"))
    placed = once.withColumn("__in", so_far(Window.partitionBy(*cell).orderBy("digest"), F.col("n_bytes") * F.col("__n")))
    same = F.lit(True)
    bases = bases.select(*[F.col(c).alias(f"__b_{c}") for c in cell], "__base")
    for c in cell:
        same = same & F.col(c).eqNullSafe(F.col(f"__b_{c}"))
    placed = placed.join(bases, same)
    # copies: rows of up to COPIES first, so that no array is longer than that
    many = placed.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(COPIES).cast("long"))))
    each = many.withColumn("__i", F.explode(F.sequence("__from", F.least(F.col("__n"), F.col("__from") + COPIES) - 1)))
    return each.select("page_id", "archive", "n_bytes", "digest", (F.col("__base") + F.col("__in") + F.col("__i") * F.col("n_bytes")).cast("long").alias("offset"))


def damaged(records: DataFrame, index: DataFrame) -> DataFrame:
    """A replica to audit: of the ``index``'ed records, those whose digest starts with 00
    have their last byte changed, with 01 are lost, with 02 have a stray second entry.

    Equal records share their fate; those without a digest or an id stay as they are.  An
    empty index gives no rows; other columns are ignored.
    """
    first = F.substring("digest", 1, 2)
    changed = F.sha2(F.concat(F.expr("substring(payload, 1, length(payload) - 1)"), F.lit("X")), 256)
    bad = records.select("page_id", "archive", F.sha2("payload", 256).alias("digest"), changed.alias("bad")).filter(first == "00").distinct()
    kept = index.filter(first.isNull() | (first != "01")).join(bad, ["page_id", "archive", "digest"], "left").select("archive", "offset", "n_bytes", F.coalesce("bad", "digest").alias("digest"))
    return kept.union(index.filter(first == "02").select("archive", F.col("offset") + 1, "n_bytes", "digest"))
