"""Fixed cases from the fixtures list and properties against Python."""

import random
import re

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.fold import ascii_fold, transliterate


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_t1_fixed_cases(spark):
    cases = {
        "§§ 12": "Sub Sec. 12", "§ 5": "Sec. 5", "café": "cafe", "“quote” ‘x’": "\"quote\" 'x'",
        "5°": "5 degrees", "a​b": "a b", "ctl\x01": "ctl\x01", "»x«": "<<x<<", "ĵ": "L",
        "Ŵ": "z", "ß": "ss", "€": "", "日本": "",
    }
    for src, want in cases.items():
        assert one(spark, ascii_fold(F.col("s")), src) == want, src


def test_t1_all_bmp_equals_byte_run(spark):
    """The table applied to UTF-8 bytes, entry after entry, over all of the basic plane."""
    from quarry.functions.fold import T1_TABLE
    chars = [chr(c) for c in range(0x20, 0x10000) if not 0xD800 <= c < 0xE000]
    rows = [("".join(chars[i:i + 256]),) for i in range(0, len(chars), 256)] + [("§§§ §§",)]
    want = []
    for (text,) in rows:
        raw = text.encode("utf-8")
        for k, v in T1_TABLE.items():
            raw = raw.replace(k.encode("utf-8"), v.encode("ascii"))
        want.append(raw.decode("ascii", "ignore"))
    got = [r["r"] for r in spark.createDataFrame(rows, "s string").coalesce(1).select(ascii_fold(F.col("s")).alias("r")).collect()]
    assert got == want


def test_t2_counts_what_it_drops(spark):
    from quarry.functions.fold import n_dropped
    rows = [("Привет мир",), ("Crème — “x”",), ("plain",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").coalesce(1).select(n_dropped(F.col("s"))).collect()]
    assert got == [9, 0, 0, 0]


def test_t2_transliterate(spark):
    assert one(spark, transliterate(F.col("s")), "Crème brûlée — Æsop’s “fable” … ß") == \
        "Creme brulee -- AEsop's \"fable\" ... ss"


def _rand_text(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def _py_chain(s, rules):
    for p, r in rules:
        s = re.sub(p, r, s)
    return s


def test_t5_matches_python_re(spark):
    rng = random.Random(7)
    alphabet = [" ", " ", "\n", "\r", "\t", ".", ",", '"', "a", "b", "\x0b", "\x1c", "  "]
    texts = [_rand_text(rng, alphabet, rng.randint(0, 60)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r["r"] for r in df.select(T.normalise_whitespace(F.col("s")).alias("r")).collect()]
    assert got == [_py_chain(t, T.WHITESPACE_RULES) for t in texts]


def test_t3_matches_python_re(spark):
    rng = random.Random(11)
    alphabet = ["#", "# ", "*", "* ", " ", "\n", "Image", "FOR IMMEDIATE RELEASE:", "Washington, D.C. -- ",
                "washington dc ", "##  ", "> ", " ~~~~ ", "x", "."]
    texts = [_rand_text(rng, alphabet, rng.randint(0, 25)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r["r"] for r in df.select(T.strip_boilerplate(F.col("s")).alias("r")).collect()]
    assert got == [_py_chain(t, [(p, "") for p in T.BOILERPLATE_PATTERNS]) for t in texts]


def test_t6_signer_cases(spark):
    def py(text, signers=("Sincerely", "Respectfully")):
        for s in signers:
            parts = text.split(s)
            if len(parts) > 1:
                return parts[1][:100], s
        return None, None

    texts = ["Thanks.\nSincerely", "A Sincerely B Sincerely C", "Respectfully, Jo", "none here",
             "x Respectfully y Sincerely z", "Sincerely" + "q" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    post, phrase = T.signer_split(F.col("s"))
    got = [(r["p"], r["f"]) for r in df.select(post.alias("p"), phrase.alias("f")).collect()]
    assert got == [py(t) for t in texts]
    assert got[0] == ("", "Sincerely")          # found at the very end: empty text, still found


def test_t8_split_reply(spark):
    df = spark.createDataFrame([("Head\nbody\nmore",), ("no newline",)], "s string")
    h, rest = T.split_reply(F.col("s"))
    rows = df.select(h.alias("h"), rest.alias("r")).collect()
    assert (rows[0]["h"], rows[0]["r"]) == ("Head", "body\nmore")
    assert (rows[1]["h"], rows[1]["r"]) == ("no newline", None)


def test_p_filenames_and_headline(spark):
    df = spark.createDataFrame([("AG-2024-0001-0002", "Title " * 30, "Jour", "Head line")],
                               "id string, t string, j string, h string")
    r = df.select(T.comment_filename(F.col("id"), F.col("t")).alias("f"),
                  T.post_headline(F.col("j"), F.col("h")).alias("p")).first()
    assert r["f"] == "$H-PUBCOM-AG" + ("Title " * 30)[:85]
    assert r["p"] == "The Jour posted research article in 'Head line'"


def test_text_rules_take_few_passes(spark):
    df = spark.createDataFrame([("a",)], "s string")
    plan = lambda c: df.select(c.alias("r"))._jdf.queryExecution().analyzed().toString()
    # blanks: a regex a pass, none for a literal; the two marks and the two rules of line ends share one
    assert plan(T.normalise_whitespace(F.col("s"))).count("regexp_replace(") == 4
    # long results: only those that occur are replaced, however many there are
    for fold in (transliterate, ascii_fold):
        assert plan(fold(F.col("s"))).replace("regexp_replace(", "").count("replace(") <= 4


def test_folds_match_their_plan_for_every_character(spark):
    from quarry.functions.fold import fold_python
    rng = random.Random(5)
    chars = [chr(x) for x in [*range(0x80, 0x250), *range(0x2000, 0x2070), 0x20AC, 0x2122, 0x4E00, 0x1F600]] + ["§§", "a", " ", "."]
    rows = ["".join(rng.choice(chars) for _ in range(40)) for _ in range(400)] + chars
    df = spark.createDataFrame([(r,) for r in rows], "s string").coalesce(1)
    for fold, table in ((ascii_fold, "T1"), (transliterate, "T2")):
        assert [r[0] for r in df.select(fold(F.col("s"))).collect()] == [fold_python(r, table) for r in rows]


def test_drop_report_counts_by_what_a_text_loses(spark):
    from quarry.operators.aggregates import drop_report
    df = spark.createDataFrame([("Привет, мир и 😀😀",), ("и é",), ("plain",), (None,)], "t string")
    rep = drop_report(df, "t")
    assert "filter(" not in rep._jdf.queryExecution().analyzed().toString()
    got = {chr(r.code_point): (r.n, r.n_rows) for r in rep.collect()}
    assert got == {"П": (1, 1), "р": (2, 1), "и": (4, 2), "в": (1, 1), "е": (1, 1), "т": (1, 1), "м": (1, 1), "😀": (2, 1)}
