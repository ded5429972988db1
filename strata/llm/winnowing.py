"""Document fingerprints by winnowing, in built-in expressions.

A text's words are hashed once, every ``GRAM`` consecutive words give a 32-bit
gram hash, and of each ``WINDOW`` consecutive grams the least is chosen, the
rightmost of equal ones. Hash and position are packed into one number (hash
high, distance from the right low), so the choice is a plain minimum, rolled
over the windows by doubling: minima of 2, then 4, then 6 neighbours. The
chosen grams with their positions are the fingerprint.

Guarantee: two texts that share ``GRAM + WINDOW - 1`` consecutive words share
the hash chosen there; no match shorter than ``GRAM`` words is reported.

Likeness of two fingerprints is the Jaccard index of their hashes (1 for two
empty ones, 0 for one).

``next_documents`` finds each document's successor in the order of ids
without sorting in one task: range partitions are ordered on their own, and
the few partition heads are chained.

Defined results: null text is empty; texts without words have an empty
fingerprint; fewer words than a gram make one gram of all words; fewer grams
than a window make one window; rows that agree in id and text are one document
with one successor; rows with one id and different texts follow each other by
the text's hash; null ids come last in descending order; texts are read whole,
however long; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored, words_of

GRAM = 4
WINDOW = 6


def with_marks(df: DataFrame, text: str, into: str, gram: int = GRAM) -> DataFrame:
    """``df`` with ``into``: the chosen grams as ascending-by-window packed
    longs ``hash32 << 31 | (2^31 - 1 - position)``."""
    w, h, g, two, four = (f"__{x}_{into}" for x in ("w", "h", "g", "m2", "m4"))
    rolled = ", ".join(f"get({h}, i + {k})" for k in range(1, gram))
    none = "CAST(array() AS ARRAY<BIGINT>)"
    packed = "shiftleft(shiftrightunsigned(xxhash64({0}), 32), 31) + (2147483647L - i)"
    steps = [
        (w, words_of(f"coalesce(CAST(`{text}` AS STRING), '')")),
        (h, f"transform({w}, x -> xxhash64(x))"),
        (
            g,
            f"CASE WHEN size({h}) = 0 THEN {none} "
            f"WHEN size({h}) < {gram} THEN transform(array({h}), (x, i) -> {packed.format('x')}) "
            f"ELSE transform(slice({h}, 1, size({h}) - {gram - 1}), (x, i) -> {packed.format('x, ' + rolled)}) END",
        ),
        (two, f"transform({g}, (x, i) -> least(x, get({g}, i + 1)))"),
        (four, f"transform({two}, (x, i) -> least(x, get({two}, i + 2)))"),
        (
            into,
            # windows that begin too late hold fewer grams: only the first {size - WINDOW + 1} count, at least one
            f"array_distinct(transform(slice({four}, 1, IF(size({g}) = 0, 0, greatest(1, size({g}) - {WINDOW - 1}))), "
            f"(x, i) -> least(x, get({four}, i + 2))))",
        ),
    ]
    for name, e in steps:
        df = df.withColumn(name, F.expr(e))
    return df.drop(w, h, g, two, four)


def fingerprints(df: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``df`` with ``into``: array of ``struct<hash bigint, position int>``."""
    row = F.struct("*").alias("__row")
    marked = with_marks(df.select(row, F.col(f"`{text}`").alias("__x")), "__x", "__marks")
    marks = F.expr(
        "transform(__marks, m -> struct(shiftright(m, 31) AS hash, CAST(2147483647L - (m & 2147483647L) AS INT) AS position))"
    )
    passed = [F.col(f"__row.`{c}`") for c in df.columns if c != into]
    return marked.select(*passed, marks.alias(into))


def hashes(marks: str) -> Column:
    return F.expr(f"array_distinct(transform({marks}, m -> CAST(shiftright(m, 31) - 2147483648L AS INT)))")


def digest(marks: str) -> Column:
    """Short name of a fingerprint, positions included."""
    return F.lower(F.lpad(F.hex(F.xxhash64(F.col(marks))), 16, "0"))


def likeness(a: str, b: str) -> Column:
    return F.expr(
        f"IF(size({a}) + size({b}) = 0, 1D, "
        f"size(array_intersect({a}, {b})) / CAST(size(array_union({a}, {b})) AS DOUBLE))"
    )


def next_documents(light: DataFrame) -> DataFrame:
    """``light`` (``doc_id, h, n``) with ``next_id, next_h``: the next row in
    descending order of ``doc_id``, then ``h``; the first after the last."""
    keys = [F.col("doc_id").desc_nulls_last(), F.col("h").desc()]
    ranged = stored(light.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "winnow-order")
    within = Window.partitionBy("part").orderBy(*keys)
    this = F.struct("doc_id", "h")
    rows = ranged.withColumns({"__next": F.lead(this).over(within), "__i": F.row_number().over(within)})
    rows = stored(rows, "winnow-next")
    # one row a partition
    chain = Window.orderBy("part")
    heads = rows.filter("__i = 1").select("part", this.alias("head"))
    heads = heads.select(
        F.col("part").alias("__p"),
        F.coalesce(F.lead("head").over(chain), F.first("head").over(chain)).alias("__head"),
    )
    linked = rows.join(heads, F.col("part") == F.col("__p"))
    following = F.coalesce("__next", "__head")
    return linked.select("doc_id", "h", "n", following["doc_id"].alias("next_id"), following["h"].alias("next_h"))


KEY = ["h", "id", "no_id"]  # of a document: the hash of its text, and its id without nulls


def op2_winnowing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    docs = docs.withColumn("h", F.xxhash64("text"))
    own_id = F.expr("IF(no_id, NULL, id)").alias("doc_id")
    order = next_documents(docs.select(own_id, "h", F.length("text").alias("n")).distinct())
    # dealt out by key once, and read by both joins: they use the same columns
    marked = with_marks(docs, "text", "marks").select(
        *KEY, "text", digest("marks").alias("fingerprint"), hashes("marks").alias("hashes")
    )
    before = order.selectExpr(
        "coalesce(doc_id, 0) AS p_id", "doc_id IS NULL AS p_no_id", "h AS p_h", "n AS p_n",
        "coalesce(next_id, 0) AS id", "next_id IS NULL AS no_id", "next_h AS h",
    )
    # the next document's share of the edited text, sent to the document before it
    sent = marked.join(before, KEY).selectExpr(
        "p_h AS h", "p_id AS id", "p_no_id AS no_id",
        "struct(substring(text, 1, CAST(floor(p_n / 3) AS INT)) AS tail, hashes, fingerprint) AS next",
    )
    sent = sent.groupBy(*KEY).agg(F.first("next").alias("next"))  # a repeated row is sent once
    rows = marked.join(sent, KEY).select(
        own_id,
        F.length("text").cast("long").alias("n_chars"),
        F.expr("substring(text, 1, length(text) - CAST(floor(length(text) / 3) AS INT)) || next.tail").alias("edited"),
        "fingerprint",
        "hashes",
        F.col("next.hashes").alias("next_hashes"),
        F.col("next.fingerprint").alias("next_fingerprint"),
    )
    rows = with_marks(rows, "edited", "marks").withColumn("edited_hashes", hashes("marks"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        digest("marks").alias("edited_fingerprint"),
        likeness("hashes", "edited_hashes").alias("near_edited"),
        likeness("hashes", "next_hashes").alias("near_next"),
        "next_fingerprint",
    )


QUERIES = {"op2_winnowing": op2_winnowing}
ORACLE = {}
