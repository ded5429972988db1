"""The pipeline's stages on tricky rows, each against a plain version."""

import corpus_pipeline as C
from tests.llm.test_packing import whole
from tests.llm.test_suffix import words


def test_stages(spark, tricky, tmp_path):
    names = [n for n, _ in C.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "suffix_array_dedup", "source_mixing", "packing"]
    docs, kept = tricky, {}
    for name, stage in C.STAGES:
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == tricky.columns
    rules = {r["doc_id"] for r in kept["quality_rules"]}
    assert not rules & {400, 401, 402, 403, 404, 405, 407}  # too short, or one line repeated
    assert set(range(24)) <= rules and {100, 105, 200, 300, 304} <= rules
    near = [r["doc_id"] for r in kept["simhash_near_dedup"]]
    assert 3 in near and not {9, 100, 105, 205} & set(near)  # the text of 9 is there under the repeated id 8
    assert set(range(24)) - {9} <= set(near) and near.count(8) == 2
    texts = {r["doc_id"]: words(r["text"]) for r in kept["suffix_array_dedup"]}
    before = {r["doc_id"]: words(r["text"]) for r in kept["simhash_near_dedup"]}
    assert all(texts[d] == before[d] for d in (0, 1, 2, 300)) and len(texts[301]) == len(before[301]) - 70
    copies = {}
    for r in kept["source_mixing"]:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert {n for d, n in copies.items() if d != 8} <= {1, 2} and set(copies) <= set(texts)
    pieces = kept["packing"]
    assert whole(pieces, 4096) == 0
    assert {p["doc_id"] for p in pieces} == set(copies)


def test_run_is_the_stages_in_turn(spark, folder, empty_folder):
    out = C.run(spark, folder)
    assert whole(out.collect(), 4096) == 0
    assert C.run(spark, empty_folder).count() == 0
