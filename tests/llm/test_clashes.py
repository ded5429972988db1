"""Tables with other columns that are called like the operators' own, and many equal rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm.mixing import mix_sources, take_copies
from strata.llm.packing import pack_documents
from strata.llm.quality_model import fit, statistics
from strata.llm.quality_rules import kept_rows, quality_rules
from strata.llm.simhash import blocks_for, simhash_keep, simhash_links
from strata.llm.token_io import read_corpus, write_corpus
from tests.llm.conftest import SCHEMA

NAMES = (
    "h n id no_id fp key first component least part row at ids before size rate copies target taken base v lam lo hi "
    "text_hash number stats held_out label score kept base_failed n_words n_stop_words record head w l s p c0 c1 "
    "__row __x __t __w __a __b __m __n __all __k __p __i __h _ ___w"
).split()


@pytest.fixture(scope="module")
def clashing(tricky):
    return tricky.select("*", *[F.lit(f"{n}!").alias(n) for n in NAMES], F.create_map(F.lit("a"), F.lit(1)).alias("m"))


def same(a, b):
    columns = sorted(set(a.columns))
    assert sorted(map(repr, a.select(*columns).collect())) == sorted(map(repr, b.select(*columns).collect()))


def test_rules(tricky, clashing):
    own = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    same(quality_rules(tricky).select(*own), quality_rules(clashing).select(*own))
    kept = kept_rows(clashing)
    assert kept.columns == clashing.columns and {r["kept"] for r in kept.select("kept").collect()} == {"kept!"}
    same(kept_rows(tricky), kept.select(*tricky.columns))


def test_simhash(tricky, clashing):
    kept = simhash_keep(clashing)
    assert kept.columns == clashing.columns
    same(simhash_keep(tricky), kept.select(*tricky.columns))


def test_statistics_and_fit(tricky, clashing):
    got = statistics(clashing)
    assert got.columns.count("stats") == 1 and "h" in got.columns
    same(statistics(tricky).select("doc_id", "stats"), got.select("doc_id", "stats"))
    labelled = lambda df: statistics(df).select((F.coalesce("doc_id", F.lit(0)) % 2).alias("label"), "stats")
    a, b = fit(labelled(tricky)), fit(labelled(clashing))
    assert a.log_dets == pytest.approx(b.log_dets) and a.log_odds == b.log_odds


def test_mixing(tricky, clashing):
    plan = mix_sources(clashing)
    same(mix_sources(tricky), plan)
    taken = take_copies(clashing)
    assert taken.columns == clashing.columns
    copies = lambda df, n: {tuple(r) for r in df.groupBy("doc_id", "source").agg(n).collect()}
    assert copies(taken, F.count("*")) == copies(plan.filter("copies > 0"), F.sum("copies"))


def test_packing_and_corpus(spark, tricky, clashing, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    totals = lambda df: df.agg(F.sum("length"), F.count("*"), F.max("sequence_id")).first()
    assert totals(pack_documents(tricky, path))[0] == totals(pack_documents(clashing, path))[0]
    for name, df in (("a", tricky), ("b", clashing)):
        write_corpus(df, f"{tmp_path}/{name}", path)
    same(read_corpus(spark, f"{tmp_path}/a"), read_corpus(spark, f"{tmp_path}/b"))


def test_stages(spark, clashing, tmp_path):
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "")
        assert docs.columns == clashing.columns, name
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.count() > 10


def test_many_equal_rows_are_dealt_out(spark):
    """100,000 equal rows under a null id: a task passes one row of them on, copies are dealt out by blocks."""
    n = 100_000
    hot = spark.range(n).selectExpr("CAST(NULL AS LONG) AS doc_id", "'the same words' AS text", "'en' AS lang", "'s' AS source", "14L AS n_chars")
    rest = spark.range(50).selectExpr("id AS doc_id", "concat('other words ', id) AS text", "'en' AS lang", "'t' AS source", "9L AS n_chars")
    docs = hot.unionByName(rest).repartition(8)
    kept = simhash_keep(docs).collect()
    assert sum(r["doc_id"] is None for r in kept) <= 1 and len(kept) <= 51
    plan = simhash_keep(docs)._jdf.queryExecution().executedPlan().toString()
    assert "min_by" in plan and "Window" not in plan
    taken = take_copies(docs)
    mix = {r["source"]: (r["t"], r["taken"]) for r in mix_sources(docs).groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("taken")).collect()}
    copies = taken.filter("doc_id IS NULL").count()
    assert 3 * copies == mix["s"][1] and abs(mix["s"][1] - mix["s"][0]) <= 6


def test_blocks_follow_the_fingerprints(spark):
    assert (blocks_for(0), blocks_for(10**6), blocks_for(10**8), blocks_for(10**10)) == (6, 6, 7, 8)
    fps = spark.range(400).selectExpr("xxhash64(id div 3) ^ shiftleft(1L, CAST(id % 3 AS INT)) AS fp")
    links = [sorted(map(tuple, simhash_links(fps, blocks=b).collect())) for b in (6, 8)]
    assert links[0] and all(x == links[0] for x in links)


def test_schema_is_that_of_documents(tricky):
    assert tricky.columns == [c.split()[0] for c in SCHEMA.split(", ")]
