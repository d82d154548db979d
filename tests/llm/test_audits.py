"""Operators 11 to 13 against brute-force versions."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
import xxhash

from parley.llm import filteraudit, phrases, simhash

SCHEMA = "doc_id long, text string, lang string, phrase string, fp int, `row` int, part string, words string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 1, 2, "y", "z") for i, t, g in rows], SCHEMA)


# ---------------------------------------------------------------- 11: collocations
def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_collocations(rows, least, top=phrases.TOP):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i : i + k])) for k in range(1, 6) for i in range(len(ws) - k + 1))
    many = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= least}
    gone = {
        (g, p[i:j]) for (g, p), c in many.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
        if j - i < len(p) and 100 * c >= 100 * f[g, p[i:j]]}
    out = defaultdict(list)
    for (g, p), a in many.items():
        if (g, p) not in gone:
            score, _, left, right = min((1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k, f[g, p[:k]], f[g, p[k:]]) for k in range(1, len(p)))
            out[g].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((g, i + 1, p.decode(), -a, x, y, n[g], -s) for g, rs in out.items() for i, (s, a, p, x, y) in enumerate(sorted(rs)[:top]))


def phrase_cases():
    rnd = random.Random(3)
    pool = ["a", "B", "cé", "the", "of", "new", "york", "#x", "日本", "z z", "rare"]
    def text(n):
        return "".join(rnd.choice(pool) + rnd.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n", " "]) for _ in range(n))
    rows = [(i, text(rnd.randint(0, 60)), rnd.choice(["en", "fr", None, ""])) for i in range(80)]
    rows += [(900 + i, "New York of the a B c" + "!" * i, "en") for i in range(12)]
    return rows + [rows[3], rows[3], (None, "new york new york", "en"), (500, None, "en"), (501, "", None), (502, " .,;\n", "xx"), (503, "a " * 5000 + "end", "fr"), (504, "the of " * 3000, "en")]


def collected(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("least,block", [(3, 300), (12, phrases.BLOCK)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, block):
    rows = phrase_cases()
    got = collected(phrases.collocations(frame(spark, rows), least=least, bits=16))
    assert got == brute_collocations(rows, least) and len(got) > 10
    # the blocks of one task, with long texts cut inside
    import pyarrow as pa

    monkeypatch.setattr(phrases, "BLOCK", block)
    batch = pa.RecordBatch.from_arrays([pa.array([g or "und" for _, _, g in rows]), pa.array([t or "" for _, t, _ in rows])], names=["lang", "text"])
    n = sum(int(b.own.sum()) for b, _ in phrases._blocks(batch))
    assert n == sum(len(re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", t or "")) for _, t, _ in rows)
    class All:
        value = b"\xff" * (1 << 13)
    counts = Counter()
    for out in phrases._windows(16, All)(iter([batch])):
        for r in out.to_pylist():
            counts[r["lang"], tuple(r[w] for w in phrases.WINDOW)] += r["n"]
    want = Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall(r"[^\x20\x09]+", piece) + [""] * 4
            want.update((lang or "und", tuple(ws[i : i + 5])) for i in range(len(ws) - 4))
    assert counts == want


def test_collocations_top_ties_and_empty(spark):
    rows = [(i, "p q. r s. r s t", "en") for i in range(5)] + [(i, "p q", "fr") for i in range(3)]
    assert collected(phrases.collocations(frame(spark, rows), least=3, top=2, bits=16)) == brute_collocations(rows, 3, 2)
    assert phrases.collocations(frame(spark, []), bits=16).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, None), (2, "", "en")]), bits=16).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, left, right = 10**14 - 7, 10**16 - 3, 10**14 - 1, 10**14 - 3
    counts = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, left), ("en", "y", 1, right)], "lang string, phrase string, k int, f long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(phrases, "phrase_counts", lambda *_: (counts, totals))
        assert phrases.collocations(spark.range(0)).first()["score"] == 1000 * a * n // (left * right)


def test_a_task_holds_the_counters_of_one_part():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    parts, slot = 48, np.array([7], np.uint32)
    given = [next(phrases._parts(slot, np.array([2], np.int64), "<u1"))[1:4] for _ in range(2)]  # 2 + 2 >= 3, in every part
    names = ["part", "low", "sizes", "counts"]

    def batches():
        for part in range(parts):
            cols = [[part] * 2, *zip(*given)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), *[pa.binary()] * 3))], names=names)

    tracemalloc.start()
    found = {}
    for out in phrases._often(3, 28)(batches()):
        found.update((r["part"], np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8))).tolist()) for r in out.to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {part: [7] for part in range(parts)}
    assert peak < 10 * 4 * phrases._PART  # all parts at once: 48 times 4 MB


def test_windows_of_frequent_pairs_move_only_as_long_as_they_are_frequent(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice("abcdef") for _ in range(100)), "en") for i in range(30)]  # a triple: some 14 times
    rows += [(100 + i, "p q r s t u", "en") for i in range(30)]
    made = {}
    plain = phrases.stored
    def kept(df, name):
        made[name] = plain(df, name)
        return made[name]
    monkeypatch.setattr(phrases, "stored", kept)
    got = collected(phrases.collocations(frame(spark, rows), least=30, bits=20))
    assert got == brute_collocations(rows, 30) and len(got) > 2
    moved = Counter(sum(r[w] != "" for w in phrases.WINDOW) for r in made["phrase-windows"].collect())
    assert moved[5] == 2 and sum(moved.values()) <= 6 + 36 + 6


def test_a_task_gives_each_window_once(monkeypatch):
    import pyarrow as pa

    class All:
        value = b"\xff" * (1 << 13)

    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("ab") for _ in range(50)) for _ in range(200)]
    batches = [pa.RecordBatch.from_arrays([pa.array(["en", "fr"] * 10), pa.array(texts[i : i + 20])], names=["lang", "text"]) for i in range(0, 200, 20)]
    monkeypatch.setattr(phrases, "BLOCK", 300)
    want = Counter()
    for i, text in enumerate(texts):
        ws = text.split() + [""] * 4
        want.update(("en" if i % 2 == 0 else "fr", *ws[j : j + 5]) for j in range(50))
    for kept, most in ((1 << 19, len(want)), (20, 4 * 200 * 50)):  # all held; and given out in parts
        monkeypatch.setattr(phrases, "KEPT", kept, raising=False)
        got = [tuple(r.values()) for out in phrases._windows(16, All)(iter(batches)) for r in out.to_pylist()]
        counts = Counter()
        for *window, n in got:
            counts[tuple(window)] += n
        assert counts == want and len(want) <= len(got) <= most
        assert kept > 20 or len(got) > len(want)


# ---------------------------------------------------------------- 12: SimHash
def brute_fingerprint(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    sh = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or ([" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """fps: (doc_id, fingerprint); the least id reachable for each fingerprint."""
    own, label = sorted({f for _, f in fps}), {}
    for f in own:
        if f in label:
            continue
        label[f], front = f, [f]
        while front:
            x = front.pop()
            for y in own:
                if y not in label and (x ^ y).bit_count() <= 3:
                    label[y] = f
                    front.append(y)
    least = {}
    for i, f in fps:
        if i is not None:
            least[label[f]] = min(least.get(label[f], i), i)
    return {f: least.get(label[f]) for f in own}


def test_simhash_equals_brute_force(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(300)] + ["É", "Straße", "B b"]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 400))] for _ in range(40)]
    rows = []
    for i, b in enumerate(base):
        rows.append((i, " ".join(b), "en"))
        for j in range(4):
            c = list(b)
            c[rnd.randrange(len(c))] = rnd.choice(words)
            rows.append((1000 + 10 * i + j, "\t".join(c).upper() if j == 1 else "\n ".join(c), "en"))
    rows += [rows[0], (None, rows[0][1], "en"), (None, "only null", "x"), (5000, None, None), (5001, "", "x"), (5002, " \n\t", "x"), (5003, "one", "x"), (5004, "One", "x"), (5005, "long text " * 60_000, "x")]
    fps = [(i, brute_fingerprint(t)) for i, t, _ in rows]
    least = brute_components(fps)
    got = simhash.near_duplicates(frame(spark, rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(((i, f"{f:016x}", least[f]) for i, f in fps), key=key)
    assert len(set(least.values())) < len(least)  # some fingerprints are linked
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_long_text_in_pieces():
    text = ("Añb c\x0bd  e\n" * 5000).encode()
    whole = simhash.fingerprint(memoryview(text))
    assert whole == brute_fingerprint(text.decode())
    with pytest.MonkeyPatch.context() as m:
        m.setattr(simhash, "word_pieces", lambda raw, limit=7, own=simhash.word_pieces: own(raw, limit))
        assert simhash.fingerprint(memoryview(text)) == whole


def test_dense_blocks_are_dealt_again(spark, monkeypatch):
    """A cluster far larger than a bucket, chains of single bits, and lone fingerprints."""
    monkeypatch.setattr(simhash, "BUCKET", 8)
    rnd = random.Random(2)
    center = rnd.getrandbits(64)
    fps = {center} | {center ^ (1 << i) ^ (1 << j) ^ (1 << k) for i, j, k in ([rnd.randrange(64) for _ in range(3)] for _ in range(150))}
    fps |= {center ^ sum(1 << i for i in rnd.sample(range(20), rnd.randint(5, 8))) for _ in range(100)}
    x = rnd.getrandbits(64)
    for _ in range(30):
        x ^= sum(1 << i for i in rnd.sample(range(64), 3))
        fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(50)} | {0, 7, 2**64 - 1}
    signed = [(simhash._signed(f),) for f in fps]
    links = {(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(spark.createDataFrame(signed, "fp long")).collect()}
    label = {f: f for f in fps}
    def find(f):
        while label[f] != f:
            f = label[f]
        return f
    for a, b in links:
        label[find(a)] = find(b)
    want = brute_components([(f, f) for f in fps])
    groups = defaultdict(set)
    for f in fps:
        groups[find(f)].add(want[f])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))
    assert len(links) < len(fps) * 8 * 4


# ---------------------------------------------------------------- 13: filter audit
def brute_audit(rows, labels):
    ids = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            ids[t or ""].append(i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for i, t, g in rows:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {x for x, c in zip("ABCDE", (
            len(ws) < 200, 100 * len(set(ws)) < 50 * len(ws), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and min(ids[t]) < i)) if c}
        parts[g or ""].append((fails, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part, docs in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                shapley[part, x] += len(gone)
                out[part, order, step] = (
                    len(left), len(gone), sum(x in f for f, _, _ in docs) - len(gone), sum(f == {x} for f, _, _ in docs), sum(g for _, g, _ in gone), sum(t for _, _, t in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit_equals_brute_force(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["Big", "CAPS", "é#", "$5", "a|b"]
    rows = []
    for i in range(120):
        pool = rnd.sample(words, rnd.choice([5, 60, 400]))
        if rnd.random() < 0.7:
            pool = [w for w in pool if not re.search("[A-Z#$|]", w)] or ["x"]
        rows.append((i, rnd.choice([" ", "\n", "\x0b "]).join(rnd.choice(pool) for _ in range(rnd.choice([20, 199, 200, 260]))), rnd.choice(["en", "fr", None, ""])))
    rows += [(200 + i, rows[i % 7][1], "en") for i in range(30)] + [rows[0], rows[0], (None, rows[1][1], "fr"), (None, None, None), (300, None, "en"), (301, "", "en"), (302, "a b " * 100_000, "de"), (-5, rows[2][1], "es")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 260, 2)] + [(0, 1, 0), (0, 0, 1), (None, 1, 1), (9999, 1, 1)]
    frame_l = spark.createDataFrame([(i, q, t, "x") for i, q, t in labels], "doc_id long, quality int, toxic int, lang string")
    rows_t = filteraudit.base_rows(frame(spark, rows), frame_l)
    got = filteraudit.audit(rows_t, filteraudit.failing_ids(rows_t))
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in names) for r in got.collect()} == brute_audit(rows, labels)
    empty = filteraudit.base_rows(frame(spark, []), frame_l.limit(0))
    assert filteraudit.audit(empty, filteraudit.failing_ids(empty)).count() == 0


def test_filter_audit_makes_no_large_plan(spark, monkeypatch):
    """One plan of all prefixes (185 exchanges) took more memory than the driver has."""
    exchanges = []
    kept = filteraudit.stored

    def watched(df, name):
        exchanges.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return kept(df, name)

    monkeypatch.setattr(filteraudit, "stored", watched)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = filteraudit.base_rows(spark.createDataFrame([(1, "a $", "en"), (2, "a $", "de")], "doc_id long, text string, lang string"), labels)
    assert filteraudit.audit(rows, filteraudit.failing_ids(rows)).count() == 2 * 120 * 5
    assert max(exchanges) <= 40
