"""Quality rules: a table of thresholds compiled into Spark projections.

Every measure is an integer computed by built-in expressions from one row's
text, and every rule bounds the ratio of two measures, so the whole operator
is a chain of projections: no shuffle, no user functions, nothing collected.

Defined results
* null or blank text: no words, every measure 0, ``base_failed`` true.
* empty table: no rows.
* very long text: linear, but for texts with a repeated 3-word window, whose
  windows are sorted once (n log n).
* repeated rows, ties: each row is judged alone.
* columns named like an output are replaced by the output; other columns pass.

3-word windows are compared by the 64-bit hash of their three words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import words_of

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German, Spanish.
STOP_WORDS = (
    "the of and to in a is that it for as was with be by on not he his but at are this have from or had an they "
    "which one you were all her she there would their we him been has when who will no more if out so what up its "
    "le la les de des du et un une en que qui dans pour pas sur est par au aux avec ce il elle ne se plus son sa "
    "der die das den dem und von zu mit sich ist nicht ein eine einer im auf für als auch es an aus er sie nach bei "
    "el los las del y que una por con para su no se lo como más al ha sus o pero le"
).split()


@dataclass(frozen=True)
class Rule:
    """``at_least`` <= 100 * numerator / denominator <= ``at_most`` (percent;
    ``None``: no bound). Without a denominator the numerator itself is bound."""

    name: str
    numerator: str
    denominator: str | None
    at_least: int | None
    at_most: int | None

    def passes(self) -> str:
        value = f"100 * {self.numerator}" if self.denominator else self.numerator
        unit = self.denominator or "1"
        parts = []
        if self.at_least is not None:
            parts.append(f"{value} >= {self.at_least} * {unit}")
        if self.at_most is not None:
            parts.append(f"{value} <= {self.at_most} * {unit}")
        return "(" + " AND ".join(parts) + ")"


# Base rules decide ``base_failed``; the others complete the verdict.
BASE_RULES = (
    Rule("enough_words", "n_words", None, 50, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 50),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 2000),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 20),
    Rule("stop_words", "n_stop_words", "n_words", 3, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def verdict(rules=RULES, base=BASE_RULES) -> tuple[str, str]:
    """SQL conditions ``(base_failed, kept)`` over the measure columns; the
    same text is valid in Spark and in the oracle's SQL."""
    base_ok = " AND ".join(r.passes() for r in base)
    rest = " AND ".join(r.passes() for r in rules) or "true"
    return f"NOT ({base_ok})", f"({base_ok}) AND ({rest})"


def _helper(df: DataFrame) -> str:
    """A beginning that no column of ``df`` has."""
    lead = "__"
    while any(c.lower().startswith(lead) for c in df.columns):
        lead += "_"
    return lead


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns of MEASURES (long). Helper columns have names
    that the input lacks, the text is carried once, and what a step does not
    need any more is not passed on."""
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(STOP_WORDS)))
    n = _helper(df)
    t = f"coalesce(CAST(`{text}` AS STRING), '')"
    kept = [f"`{c}`" for c in df.columns]
    words, lines, hashes, order, places = (f"{n}{x}" for x in "wlhsp")
    split = df.selectExpr(
        *kept,
        f"{words_of(t)} AS {words}",
        f"filter(split({t}, '\\n'), l -> btrim(l, ' \\t\\n\\u000b\\u000c\\r') != '') AS {lines}",
        f"CAST(length(translate({t}, ' \\t\\n\\u000b\\u000c\\r', '')) AS BIGINT) AS {n}word_chars",
        f"CAST(length({t}) - length(translate({t}, '{SYMBOLS}', '')) AS BIGINT) AS {n}n_symbols",
    )
    hashed = split.selectExpr(
        *kept,
        f"IF(size({words}) < 3, CAST(array() AS ARRAY<BIGINT>), transform(slice({words}, 1, size({words}) - 2), "
        f"(w, i) -> xxhash64(w, get({words}, i + 1), get({words}, i + 2)))) AS {hashes}",
        f"{n}word_chars",
        f"{n}n_symbols",
        f"CAST(size({words}) AS BIGINT) AS {n}n_words",
        f"CAST(size(filter({words}, w -> lower(w) IN ({stop}))) AS BIGINT) AS {n}n_stop_words",
        f"CAST(size({lines}) - size(array_distinct({lines})) AS BIGINT) AS {n}n_dup_lines",
        f"CAST(size({lines}) AS BIGINT) AS {n}n_lines",
    )
    done = [f"{n}{m}" for m in MEASURES if m != "n_repeat_words"]
    # windows equal to a neighbour in sorted order, by position
    sorted_ = hashed.selectExpr(
        *kept,
        *done,
        f"IF(size(array_distinct({hashes})) = size({hashes}), NULL, "
        f"sort_array(transform({hashes}, (h, i) -> struct(h AS h, i AS i)))) AS {order}",
    )
    again = sorted_.selectExpr(
        *kept,
        *done,
        f"sort_array(transform(filter({order}, (x, j) -> x.h <=> get({order}, j - 1).h OR x.h <=> get({order}, j + 1).h), "
        f"x -> x.i)) AS {places}",
    )
    # each repeated window covers its three words, overlaps counted once
    covered = (
        f"coalesce(aggregate(transform({places}, (p, j) -> least(3, coalesce(get({places}, j + 1) - p, 3))), "
        "0L, (a, x) -> a + x), 0L)"
    )
    last = {m: f"{n}{m}" for m in MEASURES} | {"n_repeat_words": covered}
    # not deterministic to the optimizer: a filter on the verdict stays above this projection,
    # where pushing it down would repeat the whole chain once per reference
    last["n_words"] = f"IF(monotonically_increasing_id() < 0, NULL, {n}n_words)"
    passed = [f"`{c}`" for c in df.columns if c not in MEASURES]
    return again.selectExpr(*passed, *[f"{last[m]} AS {m}" for m in MEASURES])


def quality_rules(df: DataFrame, text: str = "text", rules=RULES, base=BASE_RULES) -> DataFrame:
    """``df`` with the measures, ``base_failed`` and ``kept``."""
    failed, kept = verdict(rules, base)
    outputs = {*MEASURES, "base_failed", "kept"}
    judged = measured(df, text).withColumns({"base_failed": F.expr(failed), "kept": F.expr(kept)})
    return judged.select(*[F.col(f"`{c}`") for c in df.columns if c not in outputs], *MEASURES, "base_failed", "kept")


def kept_rows(df: DataFrame, text: str = "text", rules=RULES, base=BASE_RULES) -> DataFrame:
    """The rows of ``df`` that the rules keep, all columns as they are."""
    plain = [f"c{i}" for i in range(len(df.columns))]  # an input column may be called like a measure
    place = df.columns.index(text)
    return quality_rules(df.toDF(*plain), plain[place], rules, base).filter("kept").select(*plain).toDF(*df.columns)


def op3_quality_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs.select("doc_id", "text")).select("doc_id", *MEASURES, "base_failed", "kept")


_FAILED, _KEPT = verdict()
_STOP_SQL = ", ".join("'" + w + "'" for w in sorted(set(STOP_WORDS)))

OP3_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM d
), tri AS (
  SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)
), again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM tri) WHERE n >= 2
), cover AS (
  SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + k AS p FROM again, (SELECT unnest([0, 1, 2]) AS k))
  GROUP BY rid
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(list_filter(ws, lambda x: lower(x) IN ({_STOP_SQL}))) AS BIGINT) AS n_stop_words
  FROM w LEFT JOIN cover USING (rid)
)
SELECT *, {_FAILED} AS base_failed, {_KEPT} AS kept FROM m
"""

QUERIES = {"op3_quality_rules": op3_quality_rules}
ORACLE = {"op3_quality_rules": OP3_SQL}
