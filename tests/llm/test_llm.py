"""The training-data operators against brute force, with the odd rows that tables hold."""

import glob
import hashlib
import os
import random
import struct
import time
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import components, decontaminate, licenses, linededup, minhash, mixing, ngramlm, quality, suffixes, toxicity, warc
from quarry.session import scratch_dir

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = {"size": 1, "taken": "x", "target": "t", "kept": "k", "n_words": "w", "score": "s", "removed_lines": "r",
           "n_shingles": "n", "_key2": 0, "whole": 1, "edge": 2, "n_bytes": "b", "words": "v"}


def split(text):
    for c in BLANKS[1:]:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, n):
    out = []
    for k in range(n):
        out.append("".join(rng.choice(["ta", "ri", "no", "ve", "sol", "mé", "qu", "Än"]) for _ in range(rng.randint(1, 5))))
        if k % 12 == 11:
            out[-1] += ".\n"
    return " ".join(out).replace("\n ", "\n")


def rows():
    rng = random.Random(7)
    docs = [prose(rng, rng.randint(8, 160)) for _ in range(60)]
    out = [(k, t, "en" if k % 3 else "de", f"s{k % 4}", len(t)) for k, t in enumerate(docs)]
    for k in range(60, 72):                                      # near copies: a few words changed
        w = docs[k % 5 + 40].split(" ")
        w[rng.randrange(len(w))] = "changed"
        out.append((k, " ".join(w), "en", None, 0))
    shared = prose(rng, 40)
    out += [(72 + k, f"{prose(rng, 9)}\n{shared}\n{prose(rng, 5)}", "fr", "hot", 0) for k in range(5)]
    out += [(80, None, None, None, None), (81, "", "en", "", 0), (82, " \n\t ", "en", "hot", 0), (83, "one", "en", "hot", 3),
            (84, "abc " * 30_000, "en", "hot", 0), (85, docs[3], "en", "hot", 0), (85, docs[3], "en", "hot", 0),
            (85, docs[4], "en", "hot", 0), (None, docs[5], "en", "hot", 0), (None, None, None, None, None),
            (86, "x" * 5000, None, "hot", 0), (87, "é " * 400, "xx", "hot", 0)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def plain(spark):
    """Rows with distinct ids only, for the brute-force versions."""
    seen = {}
    for r in rows():
        if r[0] is not None:
            seen.setdefault(r[0], r)
    return spark.createDataFrame(list(seen.values()), SCHEMA), [(r[0], r[1]) for r in seen.values()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    return df.withColumns({k: F.lit(v) for k, v in CLASHES.items()})


@pytest.mark.parametrize("op", [
    quality.judge, quality.keep, linededup.dedup_lines, minhash.near_duplicates, minhash.keep_one, mixing.mix,
    ngramlm.backoff_scores, suffixes.remove_repeats, suffixes.repeat_groups, licenses.license_scan])
def test_odd_rows_and_empty_tables(op, docs, empty):
    assert op(clashing(empty)).count() == 0
    n = op(clashing(docs)).count()
    if op not in (quality.keep, linededup.dedup_lines, minhash.keep_one, suffixes.repeat_groups, licenses.license_scan):
        assert n == docs.count()


INTERNAL = ("_row", "_lang", "_left", "_removed", "_key", "_doc", "_place", "_words", "_classes", "whole", "removed", "changed", "left", "doc")


@pytest.mark.parametrize("op", [quality.judge, quality.keep, linededup.dedup_lines])
def test_columns_named_like_internal_ones(op, docs):
    """The names an operator gives inside don't touch a table's columns, nor do these touch it."""
    wide = docs.withColumns({c: F.lit(f"own {c}") for c in INTERNAL})
    out = op(wide)
    assert [c for c in out.columns if c in wide.columns] == wide.columns
    assert {tuple(r) for r in out.select(*INTERNAL).distinct().collect()} == {tuple(f"own {c}" for c in INTERNAL)}
    assert sorted(out.select("doc_id", "text").collect(), key=str) == sorted(op(docs).select("doc_id", "text").collect(), key=str)


def test_workers_need_no_install(tmp_path):
    """A driver that alone can import the package: functions for the workers travel with the task."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from quarry.session import get_spark
spark = get_spark("local[2]", shuffle_partitions=2)
from quarry.llm import gracehash, licenses, manifest, minhash, ngramlm, resampling, suffixes, toxicity, warc
docs = spark.createDataFrame([(k, "a few words of text " * (k % 4 + 6), "en", "s", 1) for k in range(9)], "doc_id long, text string, lang string, source string, n_chars long")
labels = spark.createDataFrame([(k, k % 2) for k in range(9)], "doc_id long, label int")
pages = docs.selectExpr("doc_id page_id", "'u' url", "text html")
for f in (gracehash.exact_groups, licenses.license_scan, minhash.near_duplicates, ngramlm.backoff_scores, suffixes.remove_repeats,
          lambda d: resampling.resample(d, d), lambda d: manifest.prove(manifest.build(manifest.leaves_of(d))),
          lambda d: toxicity.score(d, toxicity.train(d, labels)), lambda d: warc.read_archives(warc.write_archives(pages))):
    f(docs).count()
print("all", "ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=500)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_filters_keep_columns(docs):
    wide = clashing(docs)
    for op in (quality.keep, linededup.dedup_lines, minhash.keep_one):
        out = op(wide)
        assert out.columns == wide.columns
        assert {r.kept for r in out.select("kept").distinct().collect()} <= {"k"}


def test_quality_counts(plain):
    df, texts = plain
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    for key, t in texts:
        w, t = split(t), t or ""
        grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        twice = {i for i, g in enumerate(grams) if grams.count(g) > 1} if len(w) < 1000 else set(range(len(grams)))
        lines = [x for x in t.split("\n") if split(x)]
        covered = {i + k for i in twice for k in range(5)}
        r = got[key]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)), key
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_line_dedup_brute(plain):
    df, texts = plain
    seen, gone = [], {}
    for key, t in sorted(texts):
        for k, line in enumerate((t or "").split("\n")):
            s = set(split(line))
            if not s:
                continue
            if any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                gone.setdefault(key, []).append(k)
            seen.append(s)
    got = {r._key: sorted(x.line_no for x in r.l) for r in
           linededup.repeated_lines(df).groupBy("_key").agg(F.collect_list(F.struct("line_no")).alias("l")).collect()}
    assert got == gone and gone


def test_addresses_that_would_break_a_header(spark):
    """Control characters of an address are percent-encoded, a null one stays null."""
    df = spark.createDataFrame([(1, "http://a/\r\nWARC-Type: metadata", "<p>x</p>"), (2, None, "y"), (3, "http://b/?q=%0A&é", None), (4, "", "z")],
                               "page_id long, url string, html string")
    back = {r.page_id: (r.url, bytes(r.payload)) for r in warc.read_archives(warc.write_archives(df)).collect()}
    assert back == {1: ("http://a/%0D%0AWARC-Type: metadata", b"<p>x</p>"), 2: (None, b"y"), 3: ("http://b/?q=%0A&é", b""), 4: ("", b"z")}


def test_line_dedup_takes_short_lines(spark):
    texts = ["All rights reserved.\none\n\nthe first line of five words", "all rights reserved.\nAll  rights reserved.\none two\nkept",
             "one\nAll rights reserved.", "one two three four\none two three four five\n ", "one two three four\nlast"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()} == {
        0: texts[0], 1: "all rights reserved.\none two\nkept", 3: "one two three four\n ", 4: "last"}


def test_line_dedup_finds_a_changed_inner_word(spark):
    """Of 20 words one differs: 19 of 21 are shared.  Two that differ leave 18 of 22, three 17 of 23."""
    line = [f"w{i}" for i in range(20)]
    texts = [" ".join(w if k not in changed else f"x{k}" for k, w in enumerate(line)) for changed in ((), (9,), (3, 9), (3, 9, 15))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # the last shares 17 of 23 with the first, but all save one word with the third
    assert [r._key for r in linededup.repeated_lines(df).orderBy("_key").collect()] == [1, 2, 3]
    pair = df.where("doc_id in (0, 3)")
    assert linededup.repeated_lines(pair).count() == 0


def test_line_dedup_against_all_pairs_of_random_lines(spark):
    """Lines of 1 to 300 words near each other's threshold, from few words, so that all filters are met."""
    rng = random.Random(5)
    lines = []
    for size in [1, 2, 4, 5, 6, 9, 10, 11, 19, 20, 40, 64, 128, 300]:
        for _ in range(6):
            base = [f"v{int(900 * rng.random() ** 3)}" for _ in range(size)]
            lines.append(base)
            for share in (0.02, 0.08, 0.11, 0.13, 0.2):
                lines.append([w if rng.random() > share else f"n{rng.randrange(400)}" for w in base] + ["n1"] * rng.randrange(2))
    rng.shuffle(lines)
    docs = [(d, "\n".join(" ".join(w) for w in lines[d::40])) for d in range(40)]
    seen, gone = [], set()
    for d, t in docs:
        for k, line in enumerate(t.split("\n")):
            s = set(line.split(" "))
            if any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                gone.add((d, k))
            seen.append(s)
    got = linededup.repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r._key, r.line_no) for r in got.collect()} == gone and len(gone) > 50


def test_near_duplicates_brute(plain):
    df, texts = plain
    sets = {}
    for key, t in texts:
        w = split(lower(t))
        sets[key] = {tuple(w[i:i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())
    comp = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    got = {r.doc_id: r for r in minhash.near_duplicates(df, size=4).collect()}
    assert {k: r.component_id for k, r in got.items()} == comp
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    assert sum(not r.kept for r in got.values()) >= 3


def test_links_across_components():
    """A block compare finds what neither end of a band shows, and only across components."""
    import pyarrow as pa
    base = list(range(100))
    table = pa.table({"node": [1, 2, 3], "c": [1, 1, 3], "items": pa.array([base, base[:50], base[5:] + [200]], pa.list_(pa.int64()))})
    assert minhash._links_across(80)(table).to_pylist() == [{"u": 1, "v": 3}]


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (103, 101), (200, 200)]
    got = dict(components.components(spark.createDataFrame(chain, "u long, v long")).collect())
    assert all(got[k] == 0 for k in range(41)) and got[103] == got[101] == 100 and got[200] == 200


def test_patience_alignment_brute(docs, spark):
    texts = ["", None, "Released under the MIT License.", "x " * 50 + "released UNDER (the) mit, license " + "y " * 40,
             "Released under the MIT License. " * 3, "License MIT the under released", "released under a new MIT license " + "z " * 20,
             "foo " + licenses.TEMPLATES["mit"].replace("merge", "blend") + " bar", licenses.TEMPLATES["gpl-3.0-header"]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = lambda t: split("".join(" " if c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c for c in lower(t)))
    want = set()
    for k, t in enumerate(texts):
        for name, body in licenses.TEMPLATES.items():
            b = words(body)
            matched, first, last = licenses.best_alignment(words(t or ""), b)
            if 100 * matched >= 80 * len(b):
                want.add((k, name, matched, -first, -last))
    got = {(r.doc_id, r.license, r.matched, r.first_word, r.last_word) for r in licenses.license_scan(df).collect()}
    assert got == want
    assert {k for k, *_ in got} == {2, 3, 4, 6, 7, 8}
    assert licenses.align(list("abxcd"), list("abcd")) == [(0, 0), (1, 1), (3, 2), (4, 3)]


def test_licenses_are_told_apart(spark):
    every = {**licenses.TEMPLATES, **licenses.MORE}
    said = {"Released under the BSD License.": {"bsd-notice"}, "Licensed under CC BY-SA 4.0": {"cc-by-sa-4.0-notice"},
            "Licensed under CC BY 4.0": {"cc-by-4.0-notice"}, "Licensed under CC BY-NC 4.0.": {"cc-by-nc-4.0-notice"},
            "This work is licensed under the GNU Lesser General Public License, version 3.": {"lgpl-3.0-notice"},
            "This work is licensed under the GNU General Public License, version 2.": {"gpl-2.0-notice"},
            "This work is licensed under the GNU Lesser General Public License, version 3, or the GNU General Public License, version 3.":
            {"lgpl-3.0-notice", "gpl-3.0-notice"}, "Released under the new BSD or some other License": set()}
    full = [n for n in every if not n.endswith("notice")]
    texts = [*said, *("Copyright A. N. Other\n" + every[n] for n in full)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in licenses.license_scan(df).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    for k, want in enumerate(said.values()):
        assert got.get(k, set()) == want, texts[k]
    for k, n in enumerate(full, len(said)):
        # a full text may hold its own license's header or notice, but names no other license
        assert n in got[k] and {x.split("-")[0] for x in got[k]} == {n.split("-")[0]}, (n, got[k])
        if not n[0].isdigit() and n not in licenses.TEXTS:
            assert {x for x in got[k] if not x.endswith("notice")} <= {n}, (n, got[k])


def test_mix_brute(plain):
    df, texts = plain
    got = mixing.mix(df).collect()
    sources = {}
    for r in got:
        sources[r.source] = sources.get(r.source, 0) + r.size
    names = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    left, open_, target = sum(sources.values()), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if share * weight[s] > 3 * sources[s]]
        for s in full or open_:
            target[s] = 3 * sources[s] if full else share * weight[s]
        left -= sum(3 * sources[s] for s in full)
        open_ = open_ - set(full) if full else set()
    taken = {s: 0 for s in names}
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sources[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) < 1 for s in names)
    again = {(r.doc_id, r.taken) for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_backoff_brute(plain):
    import math
    df, texts = plain
    words = {k: split(lower(t)) for k, t in texts}
    got = {r.doc_id: r for r in ngramlm.backoff_scores(df).collect()}
    total = sum(map(len, words.values()))
    for key in list(words)[::9]:
        w, rest = words[key], [x for k, x in words.items() if k != key]
        uni, bi = {}, {}
        for x in rest:
            for i, a in enumerate(x):
                uni[a] = uni.get(a, 0) + 1
                if i:
                    bi[x[i - 1], a] = bi.get((x[i - 1], a), 0) + 1
        score = 0.0
        for i, a in enumerate(w):
            if i and bi.get((w[i - 1], a)):
                score += math.log10(bi[w[i - 1], a] / uni[w[i - 1]])
            else:
                score += (math.log10(0.4) if i else 0) + math.log10((uni.get(a) or 0.4) / (total - len(w)))
        assert got[key].n_words == len(w) and abs(got[key].log_score - score) < 1e-3


def test_repeats_brute(plain):
    df, texts = plain
    seen, want = {}, {}
    data = sorted((k, (t or "").encode()) for k, t in texts if len(t or "") < 50_000)
    for k, t in data:
        for i in range(len(t) - 99):
            seen.setdefault(t[i:i + 100], (k, i))
    for k, t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - 99):
            if seen[t[i:i + 100]] != (k, i):
                gone[i:i + 100] = b"\1" * 100
        left = bytes(c for c, g in zip(t, gone) if not g)
        want[k] = (len(t), len(t) - len(left), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(left).hexdigest(), left)
    small = df.where("text is null or length(text) < 50000")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept_text)) for r in suffixes.remove_repeats(small, with_text=True).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 2000


def test_repeat_groups_hold_all_occurrences(spark):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    x, y = letters(120), letters(110)
    texts = [letters(50) + x + letters(60), letters(70) + x + letters(10) + y, y + letters(30), letters(20) + x + letters(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in suffixes.repeat_groups(df).collect():
        found.setdefault(r["repeat"], set()).add((r.doc_id, r.start, r.n_bytes))
    for places in found.values():
        bodies = {texts[d][s:s + n] for d, s, n in places}
        assert len(bodies) == 1
        body = bodies.pop()
        assert {(d, i) for d, t in enumerate(texts) for i in range(len(t)) if t.startswith(body, i)} == {(d, s) for d, s, _ in places}
    assert {frozenset(d for d, *_ in p) for p in found.values()} >= {frozenset({0, 1, 3}), frozenset({1, 2})}


def test_decontamination(spark, empty):
    rng = random.Random(11)
    tests = [prose(rng, n) for n in (15, 30, 60, 9)] + [None, ""]
    docs = [prose(rng, rng.randint(30, 300)) for _ in range(40)]
    planted = set()
    for k in range(0, 32):
        w = split(tests[k % 4])
        for i in rng.sample(range(len(w)), len(w) // 10):
            w[i] = "swapped"
        docs[k] = docs[k] + " " + " ".join(w) + " " + prose(rng, 20)
        planted.add((k, k % 4))
    items = spark.createDataFrame(list(enumerate(tests)) + [(None, tests[0])], "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(docs)) + [(99, None), (98, ""), (None, docs[0]), (0, docs[0])], "doc_id long, text string")
    found = decontaminate.leaks(df, items).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == planted
    assert len(found) == len(got)
    # brute force: every shift of every pair
    import pyarrow as pa
    from quarry.llm import tokens as T
    h = lambda t: T.bare_word_hashes(pa.array([t], pa.string()))[0]
    want = {}
    for i, a in ((i, h(t)) for i, t in enumerate(tests)):
        for k, b in ((k, h(t)) for k, t in enumerate(docs)):
            best = max((decontaminate.best_overlap(a, b, s)[::-1] for s in range(-a.size, b.size)), default=(0, 0, 0))
            if a.size and best[0] >= decontaminate.words_needed(a.size) and 100 * best[0] >= 75 * best[1]:
                want[k, i] = best[:2]
    assert {(r.doc_id, r.item_id): (r.matched, r.overlap) for r in found} == want
    kept = {r.doc_id for r in decontaminate.without_leaks(df, items).collect()}
    assert kept == {*range(32, 40), 98, 99, None}
    assert decontaminate.leaks(empty, items).count() == 0
    assert decontaminate.leaks(df, items.where("false")).count() == 0


def test_warc_roundtrip(spark, tmp_path):
    big = "<p>" + "é" * 200 + "</p>"
    pages = [(5, "u5", big), (3, "u3", big), (9, "u9", big), (1, "u1", "tiny"), (2, "u2", "tiny"), (7, None, None), (8, "u8", ""),
             (None, "n", big), (3, "u3", big), (4, "u4", "<html>" + "z" * 300_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("record_type", F.lit("x")).repartition(2)
    archives = warc.write_archives(df, str(tmp_path / "arc"))
    names = [r.archive for r in archives.collect()]
    back = warc.read_archives(archives).collect()
    want = sorted((str(i), "revisit" if h == big and i != 3 else "response", 3 if h == big and i != 3 else None, len((h or "").encode()),
                   hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in pages)
    assert sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in back) == want
    assert all(bytes(r.payload).decode() in {h or "" for *_, h in pages} for r in back if r.record_type == "response")
    for name in names:                                           # an independent reader agrees on directory and members
        with zipfile.ZipFile(name) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {0}
            body = z.read(warc.DATA)
            for line in z.read(warc.INDEX).splitlines():
                at, n = map(int, line.split(b"\t"))
                assert zlib.decompress(body[at:at + n], 31).startswith(b"WARC/1.1\r\n")
    none = df.where("false")
    assert warc.read_archives(warc.write_archives(none)).count() == 0


def test_zip_directories_of_other_writers(tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("x/one", b"first")
        with z.open("two", "w", force_zip64=True) as f:
            f.write(b"second")
        z.writestr("packed", b"z" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"PK comment"
    raw = path.read_bytes()
    found = warc.members(lambda at, n: raw[at: at + n], len(raw))
    assert {k: raw[a: a + n] for k, (a, n) in found.items()} == {"x/one": b"first", "two": b"second"}
    with pytest.raises(ValueError):
        warc.members(lambda at, n: b"none"[at: at + n], 4)
    assert struct.calcsize("<IHHHHHIIIHH") == 30


def test_toxicity(spark):
    rng = random.Random(5)
    bad = ["vile", "foul", "nasty"]
    texts, labels = [], []
    for k in range(600):
        w = prose(rng, rng.randint(20, 60)).split(" ")
        y = k % 4 == 0
        if y:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "!", ","]))
        texts.append((k, " ".join(w)))
        labels.append((k, int(y)))
    docs = spark.createDataFrame(texts + [(900, None), (901, ""), (None, "vile foul nasty vile"), (902, "calm " * 30_000)], "doc_id long, text string")
    learnt = spark.createDataFrame([x for x in labels if x[0] % 5] + [(1, None), (None, 1), (2, 0)], "doc_id long, label int")
    w = toxicity.train(docs, learnt)
    got = {r.doc_id: r for r in toxicity.score(docs.withColumn("score", F.lit("x")), w).collect()}
    held = [(k, y) for k, y in labels if k % 5 == 0]
    assert sum(got[k].predicted == y for k, y in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[900].score == got[901].score < 0.5
    assert 0 < (w != 0).sum() < 2000
    assert (toxicity.train(docs.repartition(5), learnt.repartition(3)) != 0).sum() == (w != 0).sum()
    nothing = docs.where("false")
    assert toxicity.score(nothing, toxicity.train(nothing, learnt.where("false"))).count() == 0


def test_toxicity_learns_from_the_whole_sample(spark):
    """The weights are those of plain passes over all labelled rows in the order of their hash."""
    import numpy as np
    import pyarrow as pa
    rng = random.Random(6)
    rows = [(k, prose(rng, 30) + " vile rancid" * (k % 5 == 0), int(k % 5 == 0)) for k in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    got = toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int"))
    rows.sort(key=lambda r: hashlib.md5(f"{toxicity.SEED}{r[0]}".encode()).hexdigest())
    slots, begin = toxicity.features(pa.array([r[1] for r in rows]))
    z, n = np.zeros(1 << toxicity.BITS), np.zeros(1 << toxicity.BITS)
    for _ in range(toxicity.EPOCHS):
        toxicity.learn(z, n, slots, begin, np.array([r[2] for r in rows], dtype=float))
    assert np.allclose(got, toxicity.weights_of(z, n)) and (got > 0).any()


def test_pipeline(spark, tmp_path):
    """Every stage once, each against brute force on its own input."""
    import corpus_pipeline as P
    mine = rows()[:24] + rows()[60:66] + [r for r in rows() if r[0] in (80, 81, 83)]
    mine = [(k, t + "\nAll rights reserved." if k in (2, 5, 7) else t, *r) for k, t, *r in mine]
    leak = " ".join(split(mine[10][1])[:30])
    spark.createDataFrame(mine, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        now, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
        columns = now.columns
        for name, stage in P.STAGES:
            now = P.written(stage(spark, now, str(tmp_path)), "t")
            assert name == P.STAGES[-1][0] or now.columns == columns
            seen.append({r.doc_id: r for r in now.collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    judged, lined, single, clean, mixed = seen
    assert set(judged) == {r[0] for r in mine if len(split(r[1])) >= 10}
    lines, left = [], {}
    for k in sorted(judged):
        keep = []
        for line in judged[k].text.split("\n"):
            s = set(split(line))
            if not any(s and 5 * len(s & o) >= 4 * len(s | o) for o in lines):
                keep.append(line)
            lines.append(s)
        if split("\n".join(keep)):
            left[k] = "\n".join(keep)
    assert {k: r.text for k, r in lined.items()} == left
    sets = {k: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for k, w in ((k, split(lower(t))) for k, t in left.items())}
    group = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    assert set(single) == {k for k in group if group[k] == k}
    assert set(clean) == {k for k in single if k != 10}
    assert set(mixed) == set(clean) and all(0 <= r.taken <= 3 * r.size == 3 * len(split(r.text)) for r in mixed.values())


def test_quality_reads_a_text_once_for_its_classes(spark):
    """One pattern over the whole text, the others over what it leaves; windows are made of word hashes."""
    text = " ".join(f"w{i}" for i in range(6_000)) + " w0 w1 w2 w3 w4 w5"
    df = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    r = quality.judge(df).first()
    assert (r.n_words, r.n_repeat_words, r.base_failed) == (6_006, 12, False)
    plan = quality.features(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(coalesce(text") == 1 and "xxhash64(slice(" not in plan


def test_suffix_array_over_many_short_slices():
    """Order and common prefixes as by sorting; a loop over slices in Python took most of the time."""
    rng = np.random.default_rng(5)
    text = rng.integers(97, 100, 4000, dtype=np.uint8)
    end = np.cumsum(rng.integers(1, 40, 400))
    end = np.append(end[end < text.size], text.size)
    at = np.flatnonzero(rng.random(text.size) < 0.5)
    stop = end[np.searchsorted(end, at, "right")]
    order, lcp = suffixes.suffix_array(text, at, end)
    tails = [text[a:b].tobytes() for a, b in zip(at, stop)]
    assert order.tolist() == sorted(range(len(tails)), key=lambda i: (tails[i], i))
    assert lcp[1:].tolist() == [len(os.path.commonprefix([tails[i], tails[j]])) for i, j in zip(order, order[1:])]

    text, end = rng.integers(97, 123, 4_000_000, dtype=np.uint8), np.arange(1, 2_000_001) * 2
    began = time.process_time()
    np.cumsum(np.argsort(rng.permutation(text.size)))
    usual = time.process_time() - began
    began = time.process_time()
    suffixes.suffix_array(text, np.arange(0, text.size, 100), end)
    assert time.process_time() - began < 4 * usual


def test_line_dedup_moves_and_keeps_less(spark, tmp_path):
    """The last join moves numbers of lines, no texts; the table of all prefixes goes once its classes are written."""
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(1, "a b c\nd"), (2, "a b c"), (None, None)], "doc_id long, text string").write.parquet(path)
    here = scratch_dir(spark, "line-prefixes-*").removeprefix("file:")
    before = glob.glob(here)
    set_to = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in set_to}
    try:
        for k, v in set_to.items():
            spark.conf.set(k, v)
        df = linededup.op2_line_dedup(spark, str(tmp_path))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.index("Exchange hashpartitioning") < plan.index("split(")
    assert glob.glob(here) == before
    assert {tuple(r) for r in df.collect()} == {(1, 2, 0, ""), (2, 1, 1, "0"), (None, 1, 0, "")}


def test_line_dedup_leaves_one_table(spark):
    """Of its tables only the lines to remove are left; the last join moves a text once."""
    df = spark.createDataFrame([(1, "a b c d e\nz", "x"), (2, "a b c d e f", "y"), (3, "a b c d e", "z")], "doc_id long, text string, lang string")
    here = scratch_dir(spark, "line*").removeprefix("file:")
    before = set(glob.glob(here))
    out = linededup.dedup_lines(df)
    assert [os.path.basename(p)[:12] for p in set(glob.glob(here)) - before] == ["line-removed"]
    assert "text" not in out._jdf.queryExecution().optimizedPlan().toString().split(" AS _row")[0].split("struct(")[-1]
    assert {tuple(r) for r in out.collect()} == {(1, "a b c d e\nz", "x")}


def test_line_dedup_splits_a_line_once(spark):
    """That a line has a word is seen without its words; blanks other than spaces part words too."""
    df = spark.createDataFrame([(1, "a  b\tc\x0bd\x0ce\rf a\n \t\x0b\x0c\r\n\nb")], "doc_id long, text string")
    found = linededup._itemized(linededup._lines(df))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in "".join(line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Filter"))
    assert {(r.line_no, len(r["items"])) for r in found.collect()} == {(0, 6), (3, 1)}


def test_line_dedup_finds_distinct_words_outside_lambdas(spark):
    """What a lambda reads is not compiled: the distinct items of a line are found around the lambdas, in one step with the sort."""
    df = spark.createDataFrame([(1, "a  b a\tc ")], "doc_id long, text string")
    change, middle = linededup._rarity(df)
    found = linededup._itemized(linededup._lines(df), linededup._ranked(change))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_except(transform(transform(" in plan and "array_distinct" not in plan
    plain = linededup._itemized(linededup._lines(df)).first()["items"]
    items = found.first()["items"]
    assert len(set(items)) == len(items) == 3 and len(set(plain)) == 3
    low = (1 << (64 - linededup.BUCKETS)) - 1                   # ranks take the place of the top bits only
    assert sorted(h & low for h in items) == sorted(h & low for h in plain)
    assert sum(h >= middle for h in items) in (1, 2, 3)


def test_line_dedup_moves_few_narrow_rows(spark):
    """A row per item has seven numbers; of a line of 90 words 19 meet, and 11 in the first meeting."""
    line = " ".join(f"w{i}" for i in range(90))
    seen = []
    old = linededup._places
    linededup._places = lambda classes: seen.append(old(classes)) or seen[-1]
    keep, linededup.remove = linededup.remove, lambda *_: None
    try:
        linededup.repeated_lines(spark.createDataFrame([(1, line)], "doc_id long, text string")).collect()
    finally:
        linededup._places, linededup.remove = old, keep
    assert [r.columns for r in seen] == [["_key", "line_no", "n", "lo", "hi", "room", "item"]] * 2
    assert [r.count() for r in seen] == [19, 19] and seen[0].where(F.col("room") >= F.col("n") * 4).count() == 11


def test_line_dedup_of_subsets(spark):
    """Longer and shorter sets with a shared core, in both orders, some of them at the threshold."""
    rng = random.Random(11)
    lines = []
    for core in (4, 8, 16, 36, 80, 160):
        base = [f"c{core}_{k}" for k in range(core)]
        for extra in (0, 1, core // 8, core // 4, core // 4 + 1, core // 2):
            lines.append(base + [f"x{core}_{k}" for k in range(extra)])
            lines.append(base[extra // 2:] + [f"y{core}_{k}" for k in range(extra - extra // 2)])
    for turn in range(3):
        rng.shuffle(lines)
        seen, gone = [], set()
        for k, w in enumerate(lines):
            s = set(w)
            if any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                gone.add(k)
            seen.append(s)
        df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(lines)], "doc_id long, text string")
        assert {r._key for r in linededup.repeated_lines(df).collect()} == gone and gone


def test_line_dedup_joins_texts_alike_at_any_size(spark):
    """A short list of lines to remove is merged as a long one is, so measured growth is that of one path."""
    df = spark.createDataFrame([(1, "a b c d e\nz"), (2, "a b c d e f"), (3, "k")], "doc_id long, text string")
    out = linededup.dedup_lines(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {tuple(r) for r in out.collect()} == {(1, "a b c d e\nz"), (3, "k")}
