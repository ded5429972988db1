"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words. Among all document rates between 0
and the cap c, entropy balancing takes those closest to uniform (in the
bounded entropy) that meet the target. The solution tilts exponentially in
the constrained quantity, the document's size: ``r = c / (1 + (c - 1)
exp(-lambda * size))``, so lambda = 0 leaves every rate at 1. The dual is
convex with one multiplier a source; Newton steps, kept inside a bracket,
solve it on the histogram of (source, size), which is grouped map-side, so a
hot source is many small partial counts and never one group of rows.

Rates are rounded into copies by a threshold: document d gets its whole copies
and one more if ``u(d) - fraction(d) < tau(source)``, u being a hash of its
id, its text and, among rows equal in both, a number. tau = 0 is plain
randomised rounding; the tau that brings the source nearest its target is found by narrowing an interval with grouped sums of
``BINS`` bins a round, again combined map-side. All sums are exact (integers
or decimals), so nothing depends on the order of rows and reruns agree.

Defined results: null text counts 0 words; null sources form one source,
ordered last; a document without words is taken 0 words; sources without
words have target 0; an empty table gives an empty result; repeated rows are
documents of their own, rounded each, and so are rows with one id or none;
texts are counted whole, however long; other columns are ignored, or pass
``take_copies``, where rows are told apart by hashes of whole rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import row_hashes, stored, words_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BINS = 64
TOLERANCE = 1e-9
MAX_STEPS = 60  # Newton steps; if the targets are not met by then, the mix fails
ROUNDS = 9  # of narrowing by BINS: as many as the 53 bits of a row's draw can tell apart
BLOCK = 65536  # equal rows are numbered by so many at a time


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, source_size, target)``. Weights repeat over the sources in
    code point order (null last) and divide ``share`` of all words; no target
    passes ``cap`` times its source, the excess goes to the others by weight.

    That is water filling: target = min(cap * size, level * weight). With the
    sources ordered by cap * size / weight, those before some point are full
    and the level follows from the rest. One row a source goes through the
    two windows, however many documents there are.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    picks = ", ".join(map(str, weights))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = totals.withColumn("__i", F.row_number().over(by_name) - 1).selectExpr(
        "source", "source_size", f"CAST(get(array({picks}), __i % {len(weights)}) AS DOUBLE) AS w"
    )
    full = named.selectExpr("*", f"{float(cap)}D * source_size AS most")
    order = Window.orderBy(F.expr("most / w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = full.withColumns(
        {
            "__spent": F.coalesce(F.sum("most").over(before), F.lit(0.0)),
            "__w": F.sum("w").over(rest),
            "__all": F.sum("source_size").over(Window.partitionBy()),
        }
    ).withColumn("__level", F.expr(f"({float(share)}D * __all - __spent) / __w"))
    # the level of the first source that it does not fill
    level = F.min(F.when(F.col("__level") * F.col("w") < F.col("most"), F.struct("__spent", "__level")))
    named_level = levels.withColumn("__at", level.over(Window.partitionBy())["__level"])
    return named_level.select(
        "source", "source_size", F.expr("least(most, coalesce(__at * w, most))").alias("target")
    )


def _rate(cap: float) -> str:
    return f"IF(full, {float(cap)}D, {float(cap)}D / (1 + ({float(cap)}D - 1) * exp(-lam * size / unit)))"


def balanced_multipliers(sized: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """``(source, source_size, target, unit, full, lam)``: the dual solution.

    ``unit`` (the mean size) scales the multiplier; ``full`` marks sources
    whose target is the cap itself, where the multiplier would be infinite.
    """
    hist = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-sizes")
    units = hist.groupBy("source").agg(F.expr("greatest(1D, sum(n * size) / sum(n))").alias("unit"))
    state = targets.join(units.withColumnRenamed("source", "__s"), F.expr("source <=> __s")).selectExpr(
        "source", "source_size", "target", "unit", f"target >= {float(cap)}D * source_size AS full",
        "0D AS lam", "-1e9D AS lo", "1e9D AS hi",
    )
    state = stored(state, "mix-dual")
    rate = _rate(cap)
    for _ in range(MAX_STEPS):
        joined = hist.withColumnRenamed("source", "__s").join(state, F.expr("source <=> __s"))
        slopes = joined.withColumn("r", F.expr(rate)).selectExpr(
            "source AS __g",
            "n * size * r AS taken",
            f"n * size * (size / unit) * r * ({float(cap)}D - r) / {float(cap)}D AS slope",
        )
        # exact sums: the same whatever the order of the rows
        exact = [F.sum(F.col(c).cast("decimal(38,9)")).cast("double").alias(c) for c in ("taken", "slope")]
        sums = slopes.groupBy("__g").agg(*exact)
        gap = state.join(sums, F.expr("source <=> __g")).drop("__g").withColumn("gap", F.expr("taken - target"))
        gap = gap.withColumns(
            {"lo": F.expr("IF(gap < 0, lam, lo)"), "hi": F.expr("IF(gap > 0, lam, hi)")}
        ).withColumn("__newton", F.expr("lam - gap / IF(slope > 0, slope, 1D)"))
        # a step that leaves the bracket is replaced by its middle, or by a
        # doubling while one end is still open
        step = """CASE WHEN full OR gap = 0 THEN lam
                       WHEN slope > 0 AND __newton > lo AND __newton < hi AND abs(__newton - lam) <= 4 + abs(lam) THEN __newton
                       WHEN hi >= 1e9D THEN greatest(1D, 4 * abs(lam) + 1)
                       WHEN lo <= -1e9D THEN -greatest(1D, 4 * abs(lam) + 1)
                       ELSE (lo + hi) / 2 END"""
        state = stored(
            gap.withColumn("__next", F.expr(step)).selectExpr(
                "source", "source_size", "target", "unit", "full", "__next AS lam", "lo", "hi",
                "IF(full, 0D, abs(gap) / greatest(target, 1D)) AS off",
            ),
            "mix-dual",
        )
        worst = state.agg(F.max("off")).first()[0]
        state = state.drop("off")
        if worst is None or worst <= TOLERANCE:
            break
    else:
        raise RuntimeError(f"no multipliers after {MAX_STEPS} steps: a source is {worst:.3g} of its target off")
    return state.select("source", "source_size", "target", "unit", "full", "lam")


def rounding_thresholds(rated: DataFrame) -> DataFrame:
    """``(source, tau)`` from rows ``(source, size, base, v, target)``."""
    need = rated.groupBy("source").agg(F.expr("first(target) - sum(base * size)").alias("need"))
    state = stored(need.selectExpr("source", "need", "-1D AS lo", "1.0000001D AS hi"), "mix-tau")
    for _ in range(ROUNDS):
        rows = rated.select(F.col("source").alias("__s"), "size", "v").join(state, F.expr("source <=> __s"))
        inside = rows.filter("v >= lo AND v < hi").selectExpr(
            "source", "need", "lo", "hi", f"least({BINS - 1}, CAST((v - lo) / (hi - lo) * {BINS} AS INT)) AS bin", "size"
        )
        bins = inside.groupBy("source", "need", "lo", "hi", "bin").agg(
            F.sum("size").alias("words"), F.count("*").alias("rows")
        )
        # at most BINS rows a source
        upto = Window.partitionBy("source").orderBy("bin")
        cum = bins.withColumn("__c", F.sum("words").over(upto)).filter("__c - words <= need")
        # the last bin that still begins within the need
        last = cum.groupBy("source").agg(F.max(F.struct("bin", "need", "lo", "hi", "words", "rows", "__c")).alias("b"))
        moved = last.selectExpr(
            "source AS __m",
            "b.need - (b.__c - b.words) AS need",
            f"b.lo + b.bin * (b.hi - b.lo) / {BINS} AS lo",
            f"b.lo + (b.bin + 1) * (b.hi - b.lo) / {BINS} AS hi",
            "b.words AS words",
            "b.rows AS rows",
        )
        state = stored(
            state.withColumnsRenamed({"need": "n0", "lo": "l0", "hi": "h0"}).join(moved, F.expr("source <=> __m"), "left")
            .selectExpr(
                "source", "coalesce(need, n0) AS need", "coalesce(lo, l0) AS lo",
                "IF(need IS NULL, l0, hi) AS hi", "coalesce(words, 0) AS words", "coalesce(rows, 0) AS rows",
            ),
            "mix-tau",
        )
        keep = state
        state = state.drop("words", "rows")
        if (keep.agg(F.max("rows")).first()[0] or 0) <= 1:
            break  # every last bin is one row
    # what is left of the last bin, rows of one draw at most, is taken whole or not at all
    return keep.selectExpr("source", "IF(2 * need >= words, hi, lo) AS tau")


def mix_sources(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, rate, copies, taken)``,
    one row per input row."""
    return _plan(df, doc_id, text, source, weights, share, cap).drop("text_hash", "number")


def _plan(df, doc_id="doc_id", text="text", source="source", weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """``mix_sources`` with ``text_hash`` and ``number``, which tell rows of one
    id and source apart: rows equal in all three are numbered from 0."""
    each = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__t"),
    ).select(
        "doc_id",
        "source",
        F.expr(f"CAST(size({words_of('__t')}) AS BIGINT)").alias("size"),
        F.xxhash64("__t").alias("text_hash"),
    )
    # counted map-side and dealt out again, so equal rows meet in no task
    counted = each.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("__n"))
    blocks = counted.withColumn("__b", F.explode(F.expr(f"sequence(0L, (__n - 1) DIV {BLOCK})")))
    numbered = blocks.withColumn(
        "number", F.explode(F.expr(f"sequence(__b * {BLOCK}, least(__n, (__b + 1) * {BLOCK}) - 1)"))
    )
    sized = stored(numbered.drop("__n", "__b"), "mix-rows")
    dual = balanced_multipliers(sized, source_targets(sized, weights, share, cap), cap)
    rated = (
        sized.withColumnRenamed("source", "__s")
        .join(dual, F.expr("source <=> __s"))
        .drop("__s")
        .withColumn("rate", F.expr(_rate(cap)))
        .withColumn("base", F.expr(f"CAST(least(floor(rate), {cap - 1}) AS BIGINT)"))
        # 53 bits of the hash
        .withColumn(
            "v",
            F.expr("shiftrightunsigned(xxhash64(doc_id, text_hash, number), 11) / 9007199254740992D - (rate - base)"),
        )
        .select("doc_id", "source", "size", "text_hash", "number", "source_size", "target", "rate", "base", "v")
    )
    rated = stored(rated, "mix-rates")
    tau = rounding_thresholds(rated)
    return (
        rated.join(tau.withColumnRenamed("source", "__s"), F.expr("source <=> __s"))
        .withColumn("copies", F.expr("base + IF(v < tau, 1, 0)"))
        .withColumn("taken", F.expr("copies * size"))
        .select(
            "doc_id", "source", "size", "text_hash", "number", "source_size", "target", "rate", "copies", "taken"
        )
    )


def take_copies(df: DataFrame, **how) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as it is taken."""
    doc_id, text, source = (how.get(k, k) for k in ("doc_id", "text", "source"))
    key = ["doc_id", "source", "text_hash"]
    # one row for all that agree in id, source and text: how many there are, and the copies of them all
    plan = _plan(df, **how).groupBy(*key).agg(F.count("*").alias("__n"), F.sum("copies").alias("__all"))
    rows = df.select(
        F.struct("*").alias("__row"),
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("text_hash"),
        *row_hashes(df),
    )
    # such rows have one size, so their copies differ by one at most; the first by hash get the more.
    # Rows equal in every column are counted map-side, and travel once with their number of copies.
    kinds = rows.groupBy(*key, "__a", "__b").agg(F.count("*").alias("__m"))
    first = Window.partitionBy(*key).orderBy("__a", "__b")
    kinds = kinds.withColumn("__before", F.sum("__m").over(first) - F.col("__m"))
    same = " AND ".join(f"k.{c} <=> p.{c}" for c in key)
    dealt = kinds.alias("k").join(plan.filter("__all > 0").alias("p"), F.expr(same)).selectExpr(
        "__a", "__b", "__m * (__all DIV __n) + greatest(0, least(__m, __all % __n - __before)) AS copies"
    )
    whole = rows.groupBy("__a", "__b").agg(F.first("__row").alias("__row"))
    taken = whole.join(dealt.filter("copies > 0"), ["__a", "__b"])
    few = taken.filter(f"copies <= {BLOCK}").selectExpr("__row", "explode(sequence(1L, copies)) AS __i")
    # a row with very many copies is dealt out again by blocks of them
    many = taken.filter(f"copies > {BLOCK}").selectExpr(
        "__row", "__a", "copies", f"explode(sequence(0L, (copies - 1) DIV {BLOCK})) AS __block"
    )
    spread = many.repartition("__a", "__block").selectExpr(
        "__row", f"explode(sequence(__block * {BLOCK}, least(copies, (__block + 1) * {BLOCK}) - 1)) AS __i"
    )
    return few.unionByName(spread).select("__row.*")


def op9_entropy_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


QUERIES = {"op9_entropy_mixing": op9_entropy_mixing}
ORACLE = {}
