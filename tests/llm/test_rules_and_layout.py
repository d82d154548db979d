"""Operators 1, 3 and 9, against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from parley.llm import merkle, quality, sharding

# ---------------------------------------------------------------- 1: fixity audit
RECORD = "archive string, offset long, n_bytes long, digest string"


def brute_audit(ours, theirs):
    a, b = Counter(ours), Counter(theirs)
    left, right = defaultdict(list), defaultdict(list)
    for side, other, out in ((a, b, left), (b, a, right)):
        for r, n in side.items():
            if other[r] != n:
                out[r[:2]].append(r[2:])
    out = []
    for spot in {*left, *right}:
        for x in left[spot] or [None]:
            for y in right[spot] or [None]:
                out.append((*spot, "missing" if y is None else "extra" if x is None else "changed", x, y))
    return sorted(out, key=repr)


def test_audit_equals_brute_force(spark):
    rnd = random.Random(3)
    ours = []
    for a in range(6):
        at = 0
        for _ in range(rnd.choice([0, 1, 40, 400])):
            n = rnd.choice([10, 5_000, 70_000, 3_000_000])
            ours.append((f"{a}.warc", at, n, hashlib.sha256(str((a, at)).encode()).hexdigest()))
            at += n
    theirs = list(ours)
    for k in rnd.sample(range(len(theirs)), 12):
        theirs[k] = (*theirs[k][:3], "0" * 64)
    gone = set(rnd.sample(range(len(theirs)), 9))
    theirs = [r for k, r in enumerate(theirs) if k not in gone] + [("new.warc", 0, 5, "1" * 64), (ours[0][0], 7, 5, "2" * 64), ours[5], ours[5]]
    got = merkle.audit(spark.createDataFrame(ours, RECORD), spark.createDataFrame(theirs, RECORD).withColumn("range", F.lit(1))).collect()
    side = lambda n, d: None if d is None else (n, d)
    assert sorted([(r.archive, r.offset, r.status, side(r.n_bytes, r.digest), side(r.their_bytes, r.their_digest)) for r in got], key=repr) == brute_audit(ours, theirs)


def test_audit_of_equal_empty_and_null_replicas(spark):
    rows = spark.createDataFrame([("a", 0, 5, "x"), (None, None, None, None), (None, None, None, None)], RECORD)
    empty = spark.createDataFrame([], RECORD)
    assert merkle.audit(rows, rows).count() == 0 and merkle.audit(empty, empty).count() == 0
    assert sorted((r.archive, r.status) for r in merkle.audit(rows, empty).collect()) == [("", "missing"), ("a", "missing")]


def test_audit_follows_only_mismatching_branches(spark):
    rows = [("a", i * 40_000, 40_000, str(i)) for i in range(500)]
    ours = spark.createDataFrame(rows, RECORD)
    trees = merkle._levels(ours, 3), merkle._levels(spark.createDataFrame([*rows[:321], ("a", 321 * 40_000, 40_000, "bad"), *rows[322:]], RECORD), 3)
    wrong = None
    for level in range(3, -1, -1):
        wrong = merkle._differing(trees[0][level], trees[1][level], wrong)
        assert [(r.archive, r.range) for r in wrong.collect()] == [("a", 321 * 40_000 // merkle.LEAF_BYTES // merkle.FAN**level)]


def test_warc_records_lie_end_to_end(spark):
    pages = spark.createDataFrame([(i, None if i == 2 else f"http://x/{i}", None if i == 3 else "é" * i, 1) for i in [*range(5), 1000, 1001]] + [(None, "u", "h", 1)], "page_id long, url string, html string, offset int")
    got = merkle.indexed(merkle.warc_records(pages)).collect()
    for archive in {r.archive for r in got}:
        at = 0
        for r in sorted((r for r in got if r.archive == archive), key=lambda r: r.offset):
            assert r.offset == at
            at += r.n_bytes
    assert len(got) == 8 and len({r.archive for r in got}) == 3


def test_one_id_may_hold_most_records(spark, monkeypatch):
    """Records of one null id, copies among them, lie end to end; without offsets they are audited all the same."""
    monkeypatch.setattr(merkle, "COPIES", 7)
    monkeypatch.setattr(merkle, "DIGITS", 1)
    rows = [(None, "u", f"{i % 150}" + "y" * (i % 9)) for i in range(600)] + [(None, "u", "same")] * 40 + [(i, "u", "z" * i) for i in range(30)]
    records = merkle.warc_records(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = merkle.indexed(records).collect()
    raw = Counter((r.archive, r.page_id, hashlib.sha256(r.payload.encode()).hexdigest(), len(r.payload.encode())) for r in records.collect())
    assert Counter((r.archive, r.page_id, r.digest, r.n_bytes) for r in got) == raw
    want, at = [], defaultdict(int)
    for archive, page, digest, n in sorted(raw.elements()):
        want.append((archive, at[archive], n, digest))
        at[archive] += n
    assert sorted((r.archive, r.offset, r.n_bytes, r.digest) for r in got) == sorted(want)
    ours = [(a, None if a < "00000000" else o, n, d) for a, o, n, d in want]
    theirs = [*ours[:100], *ours[103:], ours[0]]
    clean = lambda x: [(a, -1 if o is None else o, n, d) for a, o, n, d in x]
    found = merkle.audit(spark.createDataFrame(ours, RECORD), spark.createDataFrame(theirs, RECORD)).collect()
    side = lambda n, d: None if d is None else (n, d)
    assert sorted([(r.archive, r.offset, r.status, side(r.n_bytes, r.digest), side(r.their_bytes, r.their_digest)) for r in found], key=repr) == brute_audit(clean(ours), clean(theirs))
    leaves = merkle._levels(spark.createDataFrame(clean(ours), RECORD), 1)[0].filter("range < 0")
    assert leaves.count() > 100


# ---------------------------------------------------------------- 3: quality rules
def brute_statistics(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            hit.update(range(i, i + 5))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


DOCS = "doc_id long, text string, kept string, `__s` int, n_words int"


def quality_cases():
    rnd = random.Random(8)
    vocab = [f"wörd{i}" for i in range(300)]
    out, labels = [], []
    for i in range(700):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(15, 60))]
        kind = i % 5
        if kind == 3:
            words = [w + rnd.choice(["***", "$$$", "&&"]) for w in words]
        if kind == 4:
            words = [w.upper() + "!!" for w in words]
        out.append((i, " ".join(words)))
        if i % 2 == 0 or i < 60:
            labels.append((i, int(kind < 3)))
    odd = [None, "", " \t\n", "a b c d e a b c d e", "x\nx\n\nx\n y", "a " * 40_000, "one two three four five six seven eight nine ten", "tab\tvt\x0bff\x0ccr\rnbsp\xa0x", "|<>|"]
    return out + [(1000 + i, t) for i, t in enumerate(odd)] + [(None, out[0][1]), out[0], out[0]], labels


def test_statistics_and_verdicts(spark):
    rows, labels = quality_cases()
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)
    marks = spark.createDataFrame([*labels, (None, 0), (5, None), (4, 0), (4, 0)], "doc_id long, quality int")
    got = quality.assess(docs, marks).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted([(r.doc_id, *[r[n] for n in names]) for r in got], key=repr) == sorted([(i, *brute_statistics(t)) for i, t in rows], key=repr)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule is None)
        if r.doc_id is not None and r.doc_id < 700 and not r.base_failed and r.doc_id != 0:
            assert r.kept == (r.doc_id % 5 < 3), (r.doc_id, r.rule)
    left = quality.good_documents(docs, marks)
    assert left.schema == docs.schema
    assert sorted([r.doc_id for r in left.collect()], key=repr) == sorted([r.doc_id for r in got if r.kept], key=repr)


def test_without_labels_or_documents_only_the_base_rule_holds(spark):
    rows, _ = quality_cases()
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept != r.base_failed for r in quality.assess(docs, none).collect())
    assert quality.assess(docs.limit(0), none).count() == 0 and quality.good_documents(docs.limit(0), none).count() == 0




def test_learned_list_covers_what_it_should(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(3000):
        f = {n: rnd.random() for n in quality.FEATURES}
        bad = f["symbol_share"] > 0.9 or (f["upper_share"] > 0.7 and f["n_words"] < 0.3)
        rows.append((*[f[n] for n in quality.FEATURES], int(bad), int(not bad), i % 3 == 0))
    frame = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in quality.FEATURES) + ", bad long, good long, prune boolean")
    rules = quality.learn(frame)
    assert rules and rules == quality.learn(frame.repartition(5))  # whatever the partitioning
    named = {c.feature for r in rules for c in r}
    assert {"symbol_share", "upper_share", "n_words"} <= named | {"n_words"}
    first = lambda row: any(all((row[c.feature] > c.threshold) == c.above for c in r) for r in rules)
    judged = [(first(dict(zip(quality.FEATURES, r))), r[-3]) for r in rows]
    assert sum(a and not b for a, b in judged) <= 0.03 * sum(a for a, _ in judged)
    assert sum(a and b for a, b in judged) >= 0.8 * sum(b for _, b in judged)


def test_a_rare_kind_of_junk_gets_a_rule(spark):
    """One kind is 1 % of the rejected labels; another third of them has no rule at all."""
    rnd = random.Random(5)
    rows = []
    for i in range(9000):
        f = {n: rnd.random() for n in quality.FEATURES}
        kind = "rare" if i % 300 == 7 else "common" if i % 3 == 0 else "noise" if i % 6 == 1 else "good"
        if kind == "common":
            f["symbol_share"] = 2 + rnd.random()
        if kind == "rare":
            f["bar_share"] = 3 + rnd.random()
        rows.append((*[f[n] for n in quality.FEATURES], int(kind != "good"), int(kind == "good"), rnd.random() < 1 / 3, kind))
    frame = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in quality.FEATURES) + ", bad long, good long, prune boolean, kind string")
    rules = quality.learn(frame)
    got = {r.kind: r.share for r in frame.groupBy("kind").agg(F.avg(quality.verdict(rules).isNotNull().cast("int")).alias("share")).collect()}
    assert got["common"] == 1 and got["rare"] == 1 and got["good"] <= 0.01


def test_held_out_accuracy(spark):
    rows, labels = quality_cases()
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows if i is not None and i < 700], DOCS)
    train = spark.createDataFrame([x for x in labels if x[0] % 4], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality.assess(docs, train).collect()}
    held = [x for x in labels if x[0] % 4 == 0]
    assert sum(kept[i] == bool(q) for i, q in held) >= 0.95 * len(held)


# ---------------------------------------------------------------- 9: sharding
def test_capacity_is_the_smallest():
    rnd = random.Random(3)
    for _ in range(300):
        sizes, shards = [rnd.choice([1, 2, 3, 5, 16, 40]) for _ in range(rnd.randint(0, 9))], rnd.randint(1, 5)
        n = len(sizes)

        @lru_cache(None)
        def best(i, k):
            if i == n:
                return 0
            return min((max(sum(sizes[i:j]), best(j, k - 1)) for j in range(i + 1, n + 1)), default=10**9) if k else 10**9  # noqa: B023

        assert sharding.capacity(sizes, shards) == best(0, shards)
        starts = sharding.cut(sizes, shards)
        assert len(starts) == shards and starts == sorted(starts) and starts[0] == 0
        assert max((sum(sizes[a:b]) for a, b in zip(starts, [*starts[1:], n])), default=0) <= best(0, shards)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards(spark, shards):
    rnd = random.Random(shards)
    texts = ["".join(rnd.choice("abé ") for _ in range(rnd.randint(0, 200))) for _ in range(900)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2000 + i, texts[0] + "hot") for i in range(500)] + [(3, None), (None, "n"), (4, ""), (7, "same"), (7, "same"), (9, "long " * 50_000)]
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, size int, shard string")
    got = sharding.shard_by_bytes(docs, shards).collect()
    raw = lambda t: (t or "").encode()
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in got], key=repr) == sorted([(i, len(raw(t)) + 16, zlib.crc32(raw(t))) for i, t in rows], key=repr)
    slots, groups, bytes_ = defaultdict(list), defaultdict(set), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        groups[r.size, r.text_crc32].add(r.shard)
        bytes_[r.shard] += r.size
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in groups.values())
    again = {(r.doc_id, r.size, r.text_crc32): r.shard for r in sharding.shard_by_bytes(docs.repartition(3), shards).collect()}
    assert all(again[r.doc_id, r.size, r.text_crc32] == r.shard for r in got)


@pytest.mark.parametrize("bits,shards,hot", [(2, 7, 0), (4, 40, 0), (1, 13, 400), (16, 40, 50)])
def test_shards_are_minimax_over_groups(spark, monkeypatch, bits, shards, hot):
    """Fewer first ranges than groups: the capacity is still that of the groups, in the order of their hashes."""
    monkeypatch.setattr(sharding, "BITS", bits)
    monkeypatch.setattr(sharding, "STEP", 3)
    rnd = random.Random(bits)
    texts = [str(i) + "x" * rnd.choice([0, 3, 50, 900]) for i in range(1500)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:1] * hot)], "doc_id long, text string")
    order = docs.groupBy(F.xxhash64("text").alias("h")).agg(F.sum(F.octet_length("text") + 16).alias("n")).collect()
    sizes = [r.n for r in sorted(order, key=lambda r: r.h % (1 << 64))]
    got = sharding.shard_by_bytes(docs, shards).collect()
    held, slots = Counter(), defaultdict(list)
    for r in got:
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(got) == docs.count() and max(held.values()) == sharding.capacity(sizes, shards)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_empty(spark):
    assert sharding.shard_by_bytes(spark.createDataFrame([], "doc_id long, text string"), 40).count() == 0
