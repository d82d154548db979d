"""Operators across documents: 6, 7 and 10, against brute-force versions."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from parley.llm import chunks, components, linededup, orderminhash

SCHEMA = "doc_id long, text string, class_id string, kept string, `__gone` int, `__t` int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in pairs], SCHEMA)


# ---------------------------------------------------------------- 7: line dedup
def brute_lines(pairs, run=linededup.RUN):
    seen, out = {}, {}
    for i, t in sorted({p for p in pairs if p[1] is not None}, key=lambda p: (p[0] is not None, p[0] or 0)):
        lines, gone = t.split("\n"), set()
        for n in range(1, run + 1):
            for k in range(len(lines) - n + 1):
                window = tuple(lines[k : k + n])
                if (n == run or len("".join(window).encode()) >= linededup.LONG_BYTES) and seen.setdefault(window, (i, t, k)) != (i, t, k):
                    gone.update(range(k, k + n))
        out[i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def line_cases():
    rnd = random.Random(4)
    pool = ["a", "b", "", "long line é", "c", "d"]
    pairs = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 12)))) for i in range(60)]
    unique = [(100 + i, f"x{i}\ny{i}\nz{i}\nboiler 1\nboiler 2\nboiler 3\nw{i}") for i in range(20)]
    long = ["é" * 100, "x" * 199, "y" * 120, "z" * 80, "w" * 79]  # runs of one or two lines, by bytes
    pairs += [(300 + i, "\n".join(rnd.choice([*long, "a"]) for _ in range(rnd.randint(1, 4)))) for i in range(40)]
    pairs += [(400, long[0]), (401, long[0]), (402, long[1]), (403, long[1])]
    return [*pairs, *unique, (200, unique[3][1]), (None, unique[4][1]), (201, None), (202, ""), (203, "\n" * 50), (204, "\n".join(str(k) for k in range(50_000))), (204, "\n".join(str(k) for k in range(50_000)))]


def test_line_dedup_equals_brute_force(spark):
    pairs = line_cases()
    want = brute_lines(pairs)
    docs = frame(spark, pairs)
    got = linededup.line_report(docs).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[1] is None)
    assert sorted([(r.doc_id, r.text) for r in got], key=key) == sorted([(i, want.get((i, t))) for i, t in pairs], key=key)
    out = linededup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == len(pairs)


def test_line_dedup_empty_and_length(spark):
    assert linededup.line_report(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(1, "a\nb\nc\nd", 9), (2, "z\na\nb\nc", 9)], "doc_id long, text string, n_chars long")
    got = linededup.dedup_lines(docs, length="n_chars").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, "a\nb\nc\nd", 9), (2, "z", 1)]


# ---------------------------------------------------------------- 6: near-duplicates
def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else {("", text or "")})


def near_cases():
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(500)]
    make = lambda n: [rnd.choice(vocab) for _ in range(n)]
    pairs, nid = [], 0
    for group in (2, 3, 30, 120):
        base = make(150)
        for k in range(group):
            w = list(base)
            if k:
                for _ in range(rnd.randint(0, 2)):
                    w[rnd.randrange(len(w))] = "edited"
            pairs.append((nid, " ".join(w).upper() if k == 1 else " ".join(w)))
            nid += 1
    passage = " ".join(make(60))  # a passage in many texts makes no duplicates of them
    for _ in range(60):
        pairs.append((nid, " ".join(make(60)) + " " + passage + " " + " ".join(make(60))))
        nid += 1
    for t in (None, "", "?!", "?!", "one two", "one, two!", "one three", "x " * 30_000):
        pairs.append((nid, t))
        nid += 1
    return pairs + [(pairs[0][0], pairs[0][1]), (None, "only a null id has this text here"), (None, None)]


def test_near_duplicates_equal_brute_force(spark):
    pairs = near_cases()
    sets = [shingles(t) for _, t in pairs]
    label = list(range(len(pairs)))
    for a, b in combinations(range(len(pairs)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    want = sorted((pairs[i][0] is not None, pairs[i][0] or 0, min([p[0] for p, x in zip(pairs, label) if x == label[i] and p[0] is not None], default=-1), label.count(label[i])) for i in range(len(pairs)))
    docs = frame(spark, pairs)
    got = orderminhash.near_duplicates(docs)
    assert sorted((r.doc_id is not None, r.doc_id or 0, -1 if r.class_id is None else r.class_id, r.class_size) for r in got.collect()) == want
    left = orderminhash.dedup(docs)
    assert left.columns == docs.columns
    assert left.count() == len(set(label))


def test_near_duplicates_within_a_template_family(spark):
    """Texts that share a template are no duplicates, and one of them is every bucket's hub:
    pairs among the others have to be found beside it, whatever their lengths."""
    rnd = random.Random(12)
    new = lambda n: [f"u{rnd.randrange(10**9)}" for _ in range(n)]
    template, pairs, want = new(400), [], set()
    for k in range(300):
        own = new(rnd.choice((80, 90, 180)))
        pairs.append((len(pairs), " ".join(template + own)))
        if k % 5 == 0:
            want.add((len(pairs) - 1, len(pairs)))
            pairs.append((len(pairs), " ".join(template + own[: len(own) // 2] + new(len(own) // 2))))
    sets = [shingles(t) for _, t in pairs]
    alike = {(a, b) for a, b in combinations(range(len(pairs)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert alike <= want and len(alike) >= 30
    got = {r.doc_id: r.class_id for r in orderminhash.near_duplicates(frame(spark, pairs)).collect()}
    assert {(c, i) for i, c in got.items() if c != i} == alike


def test_near_duplicates_are_whole_among_many_edited_copies(spark):
    """Copies of one text with a few words changed in each: many are no duplicates of the
    hub of their bucket, and are linked to it or to each other only through further copies."""
    rnd = random.Random(0)
    new = lambda: f"u{rnd.randrange(10**9)}"
    base, pairs = [new() for _ in range(150)], []
    for i in range(300):
        words = list(base)
        for k in rnd.sample(range(150), rnd.randint(1, 3)):
            words[k] = new()
        pairs.append((i, " ".join(words)))
    sets = [shingles(t) for _, t in pairs]
    label = list(range(len(pairs)))
    for a, b in combinations(range(len(pairs)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    got = {r.doc_id: r.class_id for r in orderminhash.near_duplicates(frame(spark, pairs)).collect()}
    assert [got[i] for i in range(len(pairs))] == label


def test_a_bucket_in_tiles_equals_one_tile(spark, monkeypatch):
    """Blocks of a few members meet two by two: the same classes as in one block."""
    docs = frame(spark, near_cases())
    rows = lambda: sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in orderminhash.near_duplicates(docs).collect())
    want = rows()
    monkeypatch.setattr(orderminhash, "MEMBERS", 3)
    assert rows() == want


def test_near_duplicates_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert orderminhash.near_duplicates(empty).count() == 0 and orderminhash.dedup(empty).count() == 0


def test_sketches_are_sensitive_to_order():
    from parley.llm.words import Words

    def sketch(text):
        raw = text.encode()
        return orderminhash.sketches(orderminhash.labelled(*(k := orderminhash.kmers(Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))))), k[1])[0]

    a, b = (" ".join(f"{p}{i}" for i in range(100)) for p in "ab")
    same = (sketch(f"{a} {b}") == sketch(f"{a} {b} tail")).sum()
    swapped = (sketch(f"{a} {b}") == sketch(f"{b} {a}")).sum()
    assert same > 12 and swapped < 12


@pytest.mark.parametrize("edits", [0, 1, 5, 40])
def test_alignment_is_the_longest_common_subsequence(edits):
    rnd = random.Random(edits)
    for _ in range(30):
        a = [rnd.randrange(30) for _ in range(rnd.randint(1, 60))]
        b = list(a)
        for _ in range(edits):
            at = rnd.randrange(len(b) + 1)
            b[at : at + rnd.randint(0, 1)] = [rnd.randrange(30)] * rnd.randint(0, 1)
        b = b or [1]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        m = table[-1][-1]
        want = m / (len(a) + len(b) - m)
        got = orderminhash.similarity(np.array(a, "<u4"), np.array(b, "<u4"), 0.8)
        assert got == pytest.approx(want) if want >= 0.8 else got < 0.8


def test_components(spark):
    links = [("a", "b"), ("c", "b"), ("d", "c"), ("x", "y"), ("z", "z")] + [(f"n{i}", f"n{i + 1}") for i in range(10, 40)]
    got = dict(components.components(spark.createDataFrame(links, "a string, b string")).collect())
    assert {got[k] for k in "abcd"} == {"a"} and got["x"] == got["y"] == "x" and {got[f"n{i}"] for i in range(10, 41)} == {"n10"}


# ---------------------------------------------------------------- 10: substring dedup
def cut(text):
    raw = (text or "").encode()
    starts, _ = chunks.boundaries(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    edges = [*starts.tolist(), len(raw)]
    return [(a, raw[a:b]) for a, b in zip(edges, edges[1:])]


def chunk_cases():
    rnd = random.Random(6)
    bits = ["a", "b ", "é", "😀", "word ", "line\n", "ü"]
    make = lambda n: "".join(rnd.choice(bits) for _ in range(n))
    passage = make(250)
    pairs = [(i, make(rnd.randint(0, 300)) + (passage if i % 3 == 0 else "") + make(100)) for i in range(40)]
    long = make(60_000)
    return pairs + [(50, pairs[4][1]), (50, pairs[4][1]), (51, None), (52, ""), (53, "x" * 5000), (None, pairs[5][1]), (54, long), (55, long[5:])]


def test_chunks_tile_and_stay_characters():
    for _, t in chunk_cases():
        assert b"".join(c for _, c in cut(t)).decode() == (t or "")
        for _, c in cut(t):
            c.decode()
    several = [t or "" for _, t in chunk_cases()]
    raw = [t.encode() for t in several]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    starts, at = chunks.boundaries(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for i, t in enumerate(several):  # a text is cut alike alone and among others
        assert (starts[at[i] : at[i + 1]] - offsets[i]).tolist() == [a for a, _ in cut(t)]


def test_chunks_are_short():
    """Place and length share a number: no chunk may be as long as 1,024 bytes."""
    for t in ("x" * 5000, "é" * 3000, "😀" * 2000, "a" * 63, "ab" * 40, *[t or "" for _, t in chunk_cases()]):
        assert max((len(c) for _, c in cut(t)), default=0) <= chunks.SPAN + 16 + 3


def test_chunks_resist_insertions():
    base = "".join(random.Random(3).choice("abcdefgh ") for _ in range(4000))
    a, b = {c for _, c in cut(base)}, {c for _, c in cut(base[:700] + "inserted" + base[700:])}
    assert len(a - b) <= 8


@pytest.mark.parametrize("filter_bits", [chunks.FILTER_BITS, 8])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, filter_bits):
    """Also with a filter that lets nearly every chunk pass."""
    pairs = chunk_cases()
    first, want = {}, {}
    for i, t in sorted(set(pairs), key=lambda p: (p[0] is None, p[0] or 0)):
        found = []
        for at, c in cut(t):
            if first.setdefault(c, (i, t, at)) != (i, t, at):
                found.append({"at": at, "n": len(c), "source": first[c][0]})
        want[i, t] = chunks.stretches(found, chunks.RUN_BYTES)
    monkeypatch.setattr(chunks, "FILTER_BITS", filter_bits)
    docs = frame(spark, pairs)
    got = chunks.dedup_substrings(docs).collect()
    assert len(got) == len(pairs)
    result = {}
    for i, t in pairs:
        raw, out, at = (t or "").encode(), b"", 0
        for a, n, _ in want[i, t]:
            out, at = out + raw[at:a], a + n
        result[i, t] = (i, len(raw), tuple((a, n) for a, n, _ in want[i, t]), tuple(sorted({s for *_, ids in want[i, t] for s in ids if s is not None})), (out + raw[at:]).decode())
    own = sorted(((r.doc_id, r.n_bytes, tuple((x.at, x.n) for x in r.repeats), tuple(r.source_ids), r.text) for r in got), key=repr)
    assert own == sorted([result[p] for p in pairs], key=repr)
    assert any(w for w in want.values())
    assert chunks.dedup_substrings(spark.createDataFrame([], SCHEMA)).count() == 0
