"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words that one inserted, deleted or replaced code point sets apart, the
shorter (either, if equally long) is cut into two disjoint chunks that cover
it. The edit falls into at most one of them, so the other chunk is a gram of
the longer word, at its own place or shifted by one: the first chunk unshifted
if the edit comes after it, the second one shifted by the difference in length
if the edit comes before. So every word gives its two chunks, and of its
positional grams those that such a chunk can meet: for a partner of its own
length and for one a code point shorter. Words meet on (length, chunk number,
chunk), and a meeting is verified with the edit distance.

A chunk shared by many words (a common beginning or ending) would be a key
with too many meetings. What the key leaves over of a word still holds the
edit, so the rest is cut in the same way and the key grows by the chunk of the
rest that stays. This is repeated until a key makes at most ``most_pairs``
meetings, or until a single code point is left over: then all words of the key
are variants of one another, and the alphabet bounds them. No partner is lost
at any step, and no key is capped.

A word's form is its near word of largest count (ties: the smallest in
code-point order) if that count is ``ratio`` times its own or more. Counts
grow along forms, so roots are found by pointer doubling in a few rounds.

Defined results: null text has no words; a null id is written as the empty
text where ids matter; repeated rows count again; texts of any length are read
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

LETTERS = "[A-Za-zÀ-ÿ]+"
MIN_CHARS = 5
MIN_COUNT = 3
MOST_PAIRS = 1 << 14
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def word_runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, run)``: the maximal runs of letters, one row each, A-Z lower-cased."""
    runs = F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(LETTERS), F.lit(0))
    rows = df.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("doc_id"), F.explode(runs).alias("run"))
    return rows.select("doc_id", lower_ascii(F.col("run")).alias("run"))


def count_words(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of a column ``word``: the long and frequent enough ones."""
    long_enough = words.filter(F.char_length("word") >= min_chars)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


_STATE = ("word", "n", "gram", "extra", "at", "len", "key")


def _sides(vocabulary: DataFrame) -> DataFrame:
    """Every word as a chunk side, and as a gram side for partners of its own
    length (``extra`` 0) and for those one code point shorter (1)."""
    sides = "array(struct(false AS gram, 0 AS extra), struct(true AS gram, 0 AS extra), struct(true AS gram, 1 AS extra))"
    rows = vocabulary.selectExpr("word", "n", "char_length(word) AS len", f"explode({sides}) AS side")
    return rows.selectExpr("word", "n", "side.gram", "side.extra", "1 AS at", "len", "CAST(len - side.extra AS LONG) AS key")


def _cut(state: DataFrame) -> DataFrame:
    """Each rest cut into two chunks: the key takes one up, the other is the new rest."""
    half = state.selectExpr("*", "CAST((len - extra) DIV 2 AS INT) AS q")
    first = "struct(xxhash64(key, 1, substr(word, at, q)) AS key, at + q AS at, len - q AS len)"
    second = "struct(xxhash64(key, 2, substr(word, at + q + extra, len - extra - q)) AS key, at AS at, q + extra AS len)"
    parts = half.selectExpr("word", "n", "gram", "extra", f"explode(array({first}, {second})) AS part")
    return parts.selectExpr("word", "n", "gram", "extra", "part.at", "part.len", "part.key")


def near_pairs(vocabulary: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``(a, a_n, b, b_n)``: every two words of ``(word, n)`` that exactly one
    edit sets apart, once each."""
    spark = vocabulary.sparkSession
    state, found = stored(_cut(_sides(vocabulary)), "spelling-keys"), []
    while True:
        meetings = state.groupBy("key").agg(
            F.count_if(~F.col("gram")).alias("chunks"),
            F.count_if("gram").alias("grams"),
            F.min(F.col("len") - F.col("extra")).alias("left"),
        )
        # a chunk side always meets its own word: one gram is no meeting
        hot = F.expr(f"chunks * grams > {most_pairs} AND left > 1").alias("hot")
        live = stored(meetings.filter("chunks > 0 AND grams > 1").select("key", hot), "spelling-meetings")
        rows = state.join(live, "key")
        cool = rows.filter("NOT hot")
        close = "((y.extra = 0 AND x.word < y.word) OR y.extra = 1) AND levenshtein(x.word, y.word, 1) = 1"
        met = cool.filter("NOT gram").alias("x").join(cool.filter("gram").alias("y"), F.expr(f"x.key = y.key AND {close}"))
        pair = met.selectExpr("least(x.word, y.word) AS a", "greatest(x.word, y.word) AS b", "x.n AS x_n", "y.n AS y_n", "x.word AS w")
        found.append(stored(pair.selectExpr("a", "IF(w = a, x_n, y_n) AS a_n", "b", "IF(w = a, y_n, x_n) AS b_n"), "spelling-pairs"))
        if live.filter("hot").isEmpty():
            break
        state = stored(_cut(rows.filter("hot").select(*_STATE)), "spelling-keys")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: the last form, by pointer doubling."""
    now = stored(forms.selectExpr("word", "form AS root"), "spelling-roots")
    while True:
        nxt = now.selectExpr("word AS root", "root AS further")
        if now.join(nxt, "root", "left_semi").isEmpty():
            return now
        now = stored(now.join(nxt, "root", "left").selectExpr("word", "coalesce(further, root) AS root"), "spelling-roots")


def spelling_variants(vocabulary: DataFrame, ratio: int = 2, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for every row of ``(word, n)``
    (words are distinct)."""
    words = stored(vocabulary.select("word", "n"), "spelling-words")
    pairs = near_pairs(words, most_pairs)
    both = pairs.selectExpr(
        "inline(array(struct(a AS word, a_n AS n, b AS other, b_n AS other_n), struct(b AS word, b_n AS n, a AS other, a_n AS other_n)))"
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best")
    )
    near = words.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0) AS n_near", f"IF(-best.less >= {ratio} * n, struct(best.other AS form, -best.less AS n), NULL) AS kept"
    )
    named = stored(near.selectExpr("word", "n", "n_near", "kept.form AS form", "kept.n AS form_n"), "spelling-forms")
    roots = _roots(named.filter("form IS NOT NULL"))
    return named.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


TYPO_EVERY = 97


def op12_spelling_variants(spark, sf_dir):
    runs = word_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    hashed = runs.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary")))
    at = F.expr("CAST(h % char_length(run) AS INT)")
    less = F.concat(F.substring("run", F.lit(1), at), F.expr(f"substr(run, CAST(h % char_length(run) AS INT) + 2)"))
    words = hashed.select(F.when(F.col("h") % TYPO_EVERY == 0, less).otherwise(F.col("run")).alias("word"))
    return spelling_variants(count_words(words)).select("word", "form", "root", "n", "n_near", "form_n")


def crc32_sql(text: str) -> str:
    """DuckDB: the unsigned CRC-32 (UTF-8) of a string of code points below
    U+0800; needs the one-row table ``crc(tbl)`` of ``CRC_TABLE_SQL``."""
    units = (
        f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN unicode(ch) < 128 "
        "THEN [unicode(ch)::BIGINT] ELSE [192 + unicode(ch) // 64, 128 + unicode(ch) % 64] END))"
    )
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {units}), lambda c, b: xor(c // 256, tbl[xor(c, b) % 256 + 1])))"


CRC_TABLE_SQL = """crc AS (
  SELECT list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) ORDER BY k) AS tbl
  FROM range(256) r(k)
)"""

# Another way to the same rows: words of one length that agree without position
# i differ there; a longer word without a position is the shorter one.
OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL}, runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
         unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents
), per_doc AS (
  SELECT d, run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, {crc32_sql("d || ':' || run")} AS h FROM per_doc, crc
), edited AS (
  SELECT CASE WHEN h % {TYPO_EVERY} = 0
              THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
              ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE length(word) >= {MIN_CHARS}
  GROUP BY word HAVING sum(n) >= {MIN_COUNT}
), gone AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM gone x JOIN gone y ON x.i = y.i AND x.less = y.less AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM gone x JOIN words y ON x.less = y.word
  UNION SELECT y.word, y.n, x.word, x.n FROM gone x JOIN words y ON x.less = y.word
), best AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS r
  FROM near
), forms AS (
  SELECT word, n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM best WHERE r = 1
), walk AS (
  SELECT word, form AS root FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT w.word, f.form FROM walk w JOIN forms f ON f.word = w.root WHERE f.form IS NOT NULL
), roots AS (
  SELECT w.word, w.root FROM walk w LEFT JOIN forms f ON f.word = w.root WHERE f.form IS NULL
)
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, CAST(coalesce(f.n_near, 0) AS BIGINT) AS n_near,
       CAST(f.form_n AS BIGINT) AS form_n
FROM words w LEFT JOIN forms f ON f.word = w.word LEFT JOIN roots r ON r.word = w.word
"""

QUERIES = {"op12_spelling_variants": op12_spelling_variants}
ORACLE = {"op12_spelling_variants": OP12_SQL}
