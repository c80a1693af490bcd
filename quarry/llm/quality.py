"""Quality rules: distance of a document's histograms from its language's reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import drop_clashing, packed, plain_words, unpacked, written

# fixed values: frequent function words of English, German, French and Spanish, each counted once
COMMON_WORDS = (
    "the of and to in a is that it for on was as with be by are at from this or an not "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "le et les des que dans pour qui pas sur une par plus "
    "de la el en y los se del las un con no su para al es lo"
).split()
COMMON_WORDS = list(dict.fromkeys(COMMON_WORDS))
# fixed values: character classes counted by pattern; blanks and the rest follow from the totals
CLASSES = (
    ("symbol", r"[#*$%&|<>]+"),
    ("upper", r"[A-Z]+"),
    ("digit", r"[0-9]+"),
    ("mark", r"[!-\"'-),-/:;=?@\[-`{}~+]+"),
    ("other", r"[^\x00-\x7F]+"),
)
NO_CLASS = r"[a-z\x20\x09-\x0D]+"     # most of a text, in none of the classes
MIN_WORDS = 10              # below: failed
MAX_REPEAT_PERCENT = 20     # above: failed
MIN_CHARS_JUDGED = 200      # word characters a text needs before its classes are judged
MIN_WORDS_JUDGED = 100      # words a text needs before its common words are judged
MIN_REFERENCE_WORDS = 2000  # words a reference needs before it judges
MAX_CLASS_DISTANCE = 0.31
MAX_WORD_DISTANCE = 0.32
WINDOW = 5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = (*BASE, "base_failed", "class_distance", "word_distance", "kept")
HISTOGRAMS = ("_classes", "_common")


def features(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, base_failed and the two histograms (arrays of counts)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n_chars = F.length(text)
    d = drop_clashing(docs, *ADDED, *HISTOGRAMS).withColumn("_words", plain_words(text))
    d = d.withColumn("n_words", F.size("_words").cast("long"))
    d = d.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
    d = d.withColumn("_marked", F.regexp_replace(text, NO_CLASS, ""))
    counts = {name: (F.length("_marked") - F.length(F.regexp_replace("_marked", p, ""))).cast("long") for name, p in CLASSES}
    d = d.withColumns({"n_symbols": counts["symbol"]} | {f"_{n}": c for n, c in counts.items() if n != "symbol"})
    d = d.withColumn("_blank", n_chars - F.col("word_chars"))
    shown = [F.col("n_symbols"), F.col("_upper"), F.col("_digit"), F.col("_mark"), F.col("_other"), F.col("_blank")]
    rest = n_chars.cast("long")
    for c in shown:
        rest = rest - c
    d = d.withColumn("_classes", F.array(*shown, rest)).drop("_upper", "_digit", "_mark", "_other", "_blank", "_marked")

    # lines with a word that equal an earlier line
    d = d.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")).drop("_lines")

    # words inside five-word windows that occur twice or more: sort the window hashes, take the
    # positions whose neighbour in that order is equal, and measure the union of their windows
    # (a window is hashed from its words' hashes, which are made once)
    d = d.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    d = d.withColumn("_grams", F.slice(F.transform(
        "_hashes", lambda h, i: F.xxhash64(h, *[F.get("_hashes", i + k) for k in range(1, WINDOW)])),
        1, F.greatest(F.size("_hashes") - (WINDOW - 1), F.lit(0)))).drop("_hashes")
    d = d.withColumn("_pairs", F.when(
        F.size("_grams") != F.size(F.array_distinct("_grams")),
        F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
        .otherwise(F.lit(None)))
    same = F.filter("_pairs", lambda x, i: F.coalesce(F.get("_pairs", i - 1)["g"] == x["g"], F.lit(False))
                    | F.coalesce(F.get("_pairs", i + 1)["g"] == x["g"], F.lit(False)))
    d = d.withColumn("_at", F.sort_array(F.transform(same, lambda x: x["i"])))
    d = d.withColumn("n_repeat_words", F.coalesce(F.aggregate(
        "_at", F.struct(F.lit(-WINDOW).alias("p"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(p.alias("p"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["p"]).cast("long")).alias("n")),
        lambda acc: acc["n"]), F.lit(0).cast("long"))).drop("_grams", "_pairs", "_at")

    d = d.withColumn("_hits", F.filter("_words", lambda w: w.isin(COMMON_WORDS))).drop("_words")
    # sorted with each listed word once more, so every word has a run; a run's length is the
    # distance of its end from the end of the run before
    in_order = sorted(COMMON_WORDS, key=lambda w: w.encode())
    d = d.withColumn("_runs", F.sort_array(F.concat("_hits", F.array(*[F.lit(w) for w in in_order]))))
    ends = F.filter(F.transform("_runs", lambda w, i: F.when(~F.get("_runs", i + 1).eqNullSafe(w), i + 1)), lambda e: e.isNotNull())
    d = d.withColumn("_ends", F.concat(F.array(F.lit(0)), ends))
    counted = F.transform(F.array(*[F.lit(in_order.index(w)) for w in COMMON_WORDS]),
                          lambda k: (F.get("_ends", k + 1) - F.get("_ends", k) - 1).cast("long"))
    d = d.withColumn("_common", F.concat(counted, F.array(F.col("n_words") - F.size("_hits")))).drop("_hits", "_runs", "_ends")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def references(judged: DataFrame) -> DataFrame:
    """Summed histograms of each language over all documents that pass the base rules."""
    both = F.concat("_classes", "_common")
    n_classes = len(CLASSES) + 2
    # no filter on computed columns here: the optimizer would move it below and compute them twice
    cells = (judged.select("lang", "base_failed", F.posexplode_outer(both).alias("k", "n"))
             .groupBy("lang", "k").agg(F.sum(F.when(~F.col("base_failed"), F.col("n")).otherwise(F.lit(0))).alias("n")))
    rows = cells.groupBy(F.col("lang").alias("_lang")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("k", "n"))), lambda x: x["n"]).alias("_all"))
    return rows.select("_lang", F.slice("_all", 1, n_classes).alias("_ref_classes"),
                       F.slice("_all", n_classes + 1, len(COMMON_WORDS) + 1).alias("_ref_common"))


def _total(hist: str):
    return F.aggregate(hist, F.lit(0).cast("long"), lambda a, x: a + x)


def _shares(hist: str):
    """Each count's share of their total, which is summed once and not for every count; null without any."""
    return F.get(F.transform(F.array(_total(hist)), lambda n: F.when(n > 0, F.transform(hist, lambda x: x / n))), 0)


def _distance(hist: str, ref: str):
    """Jensen-Shannon distance (base 2, 0 to 1) of a histogram from the shares ``ref``, to six digits."""
    p, q = _shares(hist), F.col(ref)

    def part(a, b):
        both = (a + b) / 2
        return (F.when(a > 0, a * F.log2(a / both)).otherwise(F.lit(0.0))
                + F.when(b > 0, b * F.log2(b / both)).otherwise(F.lit(0.0)))

    total = F.aggregate(F.zip_with(p, q, part), F.lit(0.0), lambda s, x: s + x)
    return F.round(F.sqrt(F.greatest(total / 2, F.lit(0.0))), 6)


def verdicts(judged: DataFrame, refs: DataFrame) -> DataFrame:
    """``judged`` with class_distance, word_distance and kept; null distance: not judged."""
    refs = refs.select("_lang", _total("_ref_common").alias("_ref_words"), _shares("_ref_classes").alias("_ref_classes"),
                       _shares("_ref_common").alias("_ref_common"))
    d = judged.join(refs, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    able = F.coalesce(F.col("_ref_words") >= MIN_REFERENCE_WORDS, F.lit(False))
    d = d.withColumn("class_distance", F.when(able & (F.col("word_chars") >= MIN_CHARS_JUDGED), _distance("_classes", "_ref_classes")))
    d = d.withColumn("word_distance", F.when(able & (F.col("n_words") >= MIN_WORDS_JUDGED), _distance("_common", "_ref_common")))
    far = (F.coalesce(F.col("class_distance") > MAX_CLASS_DISTANCE, F.lit(False))
           | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False)))
    return d.withColumn("kept", ~F.col("base_failed") & ~far).drop(
        "_lang", "_ref_words", "_ref_classes", "_ref_common", *HISTOGRAMS)


def judge(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the base counts, both distances and ``kept``.

    One pass over the texts sums the language references, which are written (a row per language)
    and joined back; the second pass judges each row where it is read.  Null and empty texts have
    no words and fail the base rule.  A null language is a language of its own.  Short texts, and
    languages with fewer than ``MIN_REFERENCE_WORDS`` words, are not judged by distance.  Equal
    rows get equal verdicts.  An empty table gives no rows.  Columns named like the added ones are
    replaced; all others are kept.
    """
    refs = written(references(features(docs.select("text", "lang"))), "quality-refs")
    judged = verdicts(features(packed(docs, "text", "lang")), refs)
    return unpacked(judged, docs.columns, *ADDED)


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns as they were; null, empty and short texts go."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), "text", "lang")
    # the place keeps the filter above the computed columns, see ``references``
    placed = judge(rows).withColumn("_place", F.monotonically_increasing_id())
    return placed.where(F.col("kept") & (F.col("_place") >= 0)).select("whole.*")


def op1_quality_divergence(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    counts = written(features(docs).drop("text"), "quality-features")
    out = verdicts(counts, written(references(counts), "quality-refs"))
    return out.select("doc_id", *BASE, "base_failed", "kept", "class_distance", "word_distance")


def _sql() -> str:
    common = ", ".join(f"'{w}'" for w in COMMON_WORDS)
    cut = {n: f"CAST(length(t) - length(regexp_replace(t, '{p.replace(chr(39), chr(39) * 2)}', '', 'g')) AS BIGINT)" for n, p in CLASSES}
    js = """round(sqrt(greatest(list_sum(list_transform(range(1, len({h}) + 1), lambda i:
        CASE WHEN {h}[i] > 0 THEN ({h}[i] / list_sum({h})) * log2(({h}[i] / list_sum({h})) / (({h}[i] / list_sum({h}) + {r}[i] / list_sum({r})) / 2)) ELSE 0.0 END
      + CASE WHEN {r}[i] > 0 THEN ({r}[i] / list_sum({r})) * log2(({r}[i] / list_sum({r})) / (({h}[i] / list_sum({h}) + {r}[i] / list_sum({r})) / 2)) ELSE 0.0 END)) / 2, 0.0)), 6)"""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT rid, i, w[i:i + {WINDOW - 1}] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c >= 2),
repeats AS (
  SELECT rid, CAST(sum(least({WINDOW}, i - coalesce(p, i - {WINDOW}))) AS BIGINT) AS n_repeat_words
  FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM rep) GROUP BY rid),
lines AS (
  SELECT rid, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
f AS (
  SELECT d.rid, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, {cut['symbol']} AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         {cut['upper']} AS upper, {cut['digit']} AS digit, {cut['mark']} AS mark, {cut['other']} AS other, length(t) AS n_chars,
         list_filter(w, lambda x: list_contains([{common}], x)) AS hits
  FROM d LEFT JOIN repeats USING (rid) LEFT JOIN lines USING (rid)),
h AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         [n_symbols, upper, digit, mark, other, n_chars - word_chars,
          n_chars - n_symbols - upper - digit - mark - other - (n_chars - word_chars)] AS hc,
         list_append(list_transform([{common}], lambda v: len(list_filter(hits, lambda x: x = v))), n_words - len(hits)) AS hw
  FROM f),
rc AS (
  SELECT lang, list(n ORDER BY k) AS rc FROM (
    SELECT lang, k, CAST(coalesce(sum(hc[k]) FILTER (NOT base_failed), 0) AS BIGINT) AS n FROM h, range(1, {len(CLASSES) + 3}) r(k)
    GROUP BY lang, k) GROUP BY lang),
rw AS (
  SELECT lang, list(n ORDER BY k) AS rw FROM (
    SELECT lang, k, CAST(coalesce(sum(hw[k]) FILTER (NOT base_failed), 0) AS BIGINT) AS n FROM h, range(1, {len(COMMON_WORDS) + 2}) r(k)
    GROUP BY lang, k) GROUP BY lang),
j AS (
  SELECT h.*, CASE WHEN list_sum(rw) >= {MIN_REFERENCE_WORDS} AND word_chars >= {MIN_CHARS_JUDGED} THEN {js.format(h='hc', r='rc')} END AS class_distance,
         CASE WHEN list_sum(rw) >= {MIN_REFERENCE_WORDS} AND n_words >= {MIN_WORDS_JUDGED} THEN {js.format(h='hw', r='rw')} END AS word_distance
  FROM h LEFT JOIN rc ON h.lang IS NOT DISTINCT FROM rc.lang LEFT JOIN rw ON h.lang IS NOT DISTINCT FROM rw.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(class_distance > {MAX_CLASS_DISTANCE}, false)
       AND NOT coalesce(word_distance > {MAX_WORD_DISTANCE}, false) AS kept,
       class_distance, word_distance
FROM j
"""


OP1_SQL = _sql()
