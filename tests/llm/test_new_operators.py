"""Manifest proofs, exact duplicates and resampling against brute force, with odd rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import crc, gracehash, manifest, resampling

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
CLASHES = ("_part", "_place", "position", "kind", "rep", "id", "h", "n", "many", "content", "row", "key", "sha", "k", "s",
           "keep_id", "kept", "tree", "idx", "width", "block", "leaf", "claimed", "level", "digest", "_source", "_at", "begin",
           "weight", "score", "rank", "bucket", "n_words")


def rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé ABZ09,.") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    out = [(k, "hot" if k % 3 else f"s{k % 7}", "en", k, text(rng.randint(1, 60))) for k in range(120)]
    out += [(200 + k, "hot", "de", 1, "same  text\n again" if k % 2 else "same text again") for k in range(40)]
    out += [(300, None, None, None, None), (301, "", "", 0, ""), (302, "hot", "en", 3, " \n\t "), (303, "alone", None, 9, "one"),
            (304, "hot", "en", 1, "word, " * 20_000), (305, "hot", "en", 1, "x" * 200_000), (7, "hot", "en", 7, "same text again"),
            (7, "hot", "en", 7, "same text again"), (None, "hot", None, None, "same text again"), (None, None, None, None, None),
            (306, "größe", "fr", 1, "é" * 300 + "\nline"), (-5, "hot", "en", 1, "a\n\nb")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    return df.withColumns({c: F.lit(f"c-{c}") for c in CLASHES})


# --- exact duplicates

def groups(data):
    out = {}
    for k, _, _, _, t in data:
        for c in "\t\n\x0b\x0c\r":
            t = (t or "").replace(c, " ")
        while "  " in t:
            t = t.replace("  ", " ")
        out.setdefault(t, []).append(k)
    return out


@pytest.mark.parametrize("sizes", [{}, {"table_bytes": 30_000, "local_bytes": 600}, {"bucket_bytes": 40_000, "local_bytes": 1}])
def test_exact_groups(docs, sizes):
    got = [tuple(r) for r in gracehash.exact_groups(docs, **sizes).collect()]
    want = []
    for t, ids in groups(rows()).items():
        some = [i for i in ids if i is not None]
        keep, sha = min(some) if some else None, hashlib.sha256(t.encode()).hexdigest()
        left = 1
        for i in sorted(ids, key=lambda i: (i is None, i)):
            want.append((i, keep, len(ids), left == 1, sha))
            left = 0
    assert sorted(got, key=str) == sorted(want, key=str)


def test_exact_groups_odd_tables(docs, empty, spark):
    assert gracehash.exact_groups(empty).count() == 0
    assert gracehash.drop_copies(empty).count() == 0
    wide = clashing(docs)
    kept = gracehash.drop_copies(wide)
    assert kept.columns == wide.columns
    assert kept.count() == len(groups(rows()))
    assert [r[0] for r in kept.select("keep_id").distinct().collect()] == ["c-keep_id"]
    named = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x")], "doc_id string, text string")
    assert sorted((r.doc_id or "", r.keep_id, r.kept) for r in gracehash.exact_groups(named).collect()) == [
        ("", "a", False), ("a", "a", True), ("b", "a", False)]


def test_table_compares_contents():
    table = gracehash.ContentTable(10_000)
    assert [table.entry(5, b"a"), table.entry(5, b"b"), table.entry(5, b"a"), table.entry(6, b"a")] == [(0, True), (1, True), (0, False), (2, True)]
    table = gracehash.ContentTable(1 << 20)
    for k in range(3000):
        assert table.entry(k % 7, str(k).encode()) == (k, True)
    assert all(table.entry(k % 7, str(k).encode()) == (k, False) for k in range(3000))
    full = gracehash.ContentTable(400)
    assert [full.entry(k, bytes([k]) * 100)[0] for k in range(3)] == [0, -1, -1] and full.entry(0, b"\0" * 100) == (0, False)


# --- manifest

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(k, source, lang, n, text):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (k, source, lang, n, text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def proof_path(tree, i):
    out = []
    for nodes in tree[:-1]:
        lo = i // 3 * 3
        out.append((nodes[lo:i], nodes[i + 1:lo + 3]))
        i //= 3
    return out


def folded(d, path):
    for before, after in path:
        d = digest(*before, d, *after)
    return d


def brute_manifest(data):
    by = {}
    for r in data:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append(levels([leaf(*r) for r in by[s]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            path = proof_path(trees[k], i) + proof_path(top, k)
            torn = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            end = folded(leaf(*r[:4], r[4].replace("\n", "")) if torn else leaf(*r), path)
            out.append((r[0], leaf(*r), trees[k][-1][0], top[-1][0], digest(*[x for a, b in path for x in a + b]), end, end == top[-1][0]))
    return out


def claims():
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False)) & F.col("text").contains("\n")
    return F.when(hit, manifest.leaf_digest(text=F.replace("text", F.lit("\n"), F.lit(""))))


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest(docs, monkeypatch, height):
    monkeypatch.setattr(manifest, "HEIGHT", height)
    monkeypatch.setattr(manifest, "BLOCK", 3 ** height)
    got = [tuple(r) for r in manifest.prove(manifest.build(manifest.leaves_of(clashing(docs), claims()))).collect()]
    want = brute_manifest(rows())
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_some_leaves(docs):
    made = manifest.build(manifest.leaves_of(docs))
    some = made.leaves.where("doc_id % 10 = 3")
    got = [tuple(r) for r in manifest.prove(made, some).collect()]
    want = [r for r in brute_manifest(rows()) if r[0] is not None and r[0] % 10 == 3]
    assert sorted(r[:5] for r in got) == sorted(r[:5] for r in want) and all(r[-1] for r in got)


def test_manifest_small_tables(spark, empty):
    assert manifest.prove(manifest.build(manifest.leaves_of(empty))).count() == 0
    one = spark.createDataFrame([(1, "a", "en", 1, "x")], SCHEMA)
    r = manifest.prove(manifest.build(manifest.leaves_of(one))).first()
    assert r.leaf == r.subroot == r.root == r.folded_root == leaf(1, "a", "en", 1, "x") and r.proof_sha256 == digest() and r.verified


def test_missing_coordinates_are_minimal():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 90)
        some = rng.sample(range(n), rng.randint(1, n))
        missing, held = manifest.climb(some, n)
        widths = manifest.widths(n)
        need, derivable = set(), {(0, i) for i in some}
        for level, width in enumerate(widths[:-1]):
            for i in some:
                p = i // 3 ** (level + 1)
                derivable.add((level + 1, p))
                need |= {(level, q) for q in range(3 * p, min(3 * p + 3, width))}
        assert sorted(missing) == sorted(need - derivable)
        assert [len(x) for x in held] == [len({i // 3 ** k for i in some}) for k in range(len(widths))]


# --- resampling

def words(text):
    out, now = [], ""
    for c in text or "":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c.isascii() and not ("0" <= c <= "9" or "a" <= c <= "z"):
            out.append(now)
            now = ""
        else:
            now += c
    return [w for w in [*out, now] if w]


def buckets(text, size):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % size for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_resample(data, target, size, percent=5):
    def count(texts):
        c = [0] * size
        for t in texts:
            for b in buckets(t, size):
                c[b] += 1
        return c, sum(c)
    (s, S), (t, T) = count(r[4] for r in data), count(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + size) / ((s[b] + 1) * (T + size)))) for b in range(size)]
    out = []
    for k, _, _, _, text in data:
        b = buckets(text, size)
        h = int(hashlib.sha256(f"42:{'null' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in b)
        out.append((k, len(words(text)), len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, able[: percent * len(able) // 100]


TARGET = ["abc de é09 ab", "word word word", None, "", "zzz " * 40]


@pytest.mark.parametrize("percent", [5, 40])
def test_resample(docs, spark, percent):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = resampling.resample(clashing(docs), target, percent=percent, buckets=500).collect()
    every, drawn = brute_resample(rows(), TARGET, 500, percent)
    key = lambda r: str(tuple(r)[:5])
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(every, key=str)
    ranks = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranks] == [*range(1, len(drawn) + 1)]
    assert [key(r) for r in ranks] == [str(r) for r in drawn]


def test_resample_odd_tables(docs, spark, empty):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(empty, none, buckets=50).count() == 0
    got = resampling.resample(docs, none, buckets=50).collect()
    assert len(got) == len(rows())
    assert sorted((r.n_features, r.weight) for r in got) == sorted((r[2], r[3]) for r in brute_resample(rows(), [], 50)[0])


def test_long_texts_are_cut_between_words(monkeypatch):
    texts = [r[4] for r in rows()] + ["ab," * 900 + "x" * 5000 + " tail of it", "x" * 3000]
    want = np.bincount([b for t in texts for b in buckets(t, 97)], minlength=97)
    for piece in (1 << 21, 700, 64):
        monkeypatch.setattr(resampling.T, "PIECE", piece)
        total = np.zeros(97, dtype=int)
        per = np.zeros(len(texts), dtype=int)
        for row, bucket, _ in resampling.features(pa.array(texts), 97):
            total += np.bincount(bucket, minlength=97)
            per += np.bincount(row, minlength=len(texts))
        assert (total == want).all() and per.tolist() == [len(buckets(t, 97)) for t in texts]


def test_substring_crc():
    rng = np.random.default_rng(1)
    stream = rng.integers(0, 256, 70_000, dtype=np.uint8)
    s = rng.integers(0, stream.size, 400)
    e = np.minimum(stream.size, s + np.r_[rng.integers(0, 300, 300), rng.integers(0, stream.size, 100)])
    got = crc.substring_crc(crc.registers(stream, s), crc.registers(stream, e), e - s)
    assert got.tolist() == [zlib.crc32(stream[a:b].tobytes()) for a, b in zip(s, e)]
