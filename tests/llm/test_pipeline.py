import pytest
from tests_support import SCHEMA, rows_of, sentence

import corpus_pipeline
from shelfcast.llm.decontaminate import op10_decontamination

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with planted cases: junk, copies, near copies, a benchmark passage, an address."""
    path = str(tmp_path_factory.mktemp("tables"))
    good = [(i, f"{sentence(i, 80)}.\n{sentence(1000 + i, 60)}.", "en") for i in range(60)]
    junk = [(100 + i, "\n".join(f"{w} | ###" for w in sentence(i, 30).split()), "en") for i in range(30)]
    near = good[0][1].split(" ")
    near[40] = "changed"
    item = sentence(777, 30)
    rows = [
        *good, *junk, (200, good[0][1], "en"), (201, " ".join(near), "en"), (202, f"Intro.\n{item}.\n{item}.", "en"),
        (203, f"{sentence(5000, 70)} call boss@corp.example today.\n{sentence(6000, 40)}.", "en"),
        (204, None, "en"), (205, "", None), (None, f"{sentence(7000, 70)}.", "en"), (5, good[5][1], "en"),
    ]
    spark.createDataFrame(rows_of(rows), SCHEMA).select(*COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(
        [(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(30)], "doc_id bigint, quality int"
    ).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_on_planted_cases(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, folder)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns
    assert set(range(60)) | {200, 201, 202, 203, None} <= set(ids) and not {100 + i for i in range(30)} & set(ids)

    kept = stages["near_dedup"](spark, docs, folder)
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and kept.columns == docs.columns
    assert set(range(60)) | {202, 203, 204, None} <= set(ids) and not {200, 201, 205} & set(ids)

    kept = stages["decontaminate"](spark, docs, folder)
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()}
    assert gone == {r["doc_id"] for r in op10_decontamination(spark, folder).where("contaminated").collect()} == {202}
    assert kept.columns == docs.columns

    clean = {r["doc_id"]: r for r in stages["personal_data"](spark, docs, folder).collect()}
    before = {r["doc_id"]: r for r in docs.collect()}
    assert "[EMAIL]" in clean[203]["text"] and "corp.example" not in clean[203]["text"]
    assert clean[203]["n_chars"] == len(clean[203]["text"]) and clean[204]["text"] is None
    assert all(clean[i]["text"] == before[i]["text"] for i in range(60))

    encoded = stages["pieces"](spark, docs, folder).collect()
    assert len(encoded) == docs.count() and all(r["restored"] for r in encoded)


def test_texts_that_share_an_id_stay_apart(spark, folder):
    """A copy of a smaller id takes no other text of its own id along; a hot id keeps all its texts."""
    text = [sentence(900 + i, 80) for i in range(40)]
    rows = [(1, text[0], "en"), (7, text[0], "en"), (7, text[1], "en"), (8, text[2], "en"), (8, text[3], "en"),
            (9, text[1].upper(), "en"), (10, text[4], "en"), (10, text[4], "en"), (10, text[4], "fr"), (10, None, "en")]
    rows += [(50, t, "en") for t in text[5:]]
    docs = spark.createDataFrame(rows_of(rows), SCHEMA)
    kept = [(r["doc_id"], r["text"]) for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, folder).collect()]
    expected = [(1, text[0]), (7, text[1]), (8, text[2]), (8, text[3]), (10, text[4]), (10, None)]
    assert sorted(kept, key=str) == sorted(expected + [(50, t) for t in text[5:]], key=str)


def test_run_is_its_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    expected = sorted((str(r["doc_id"]), r["ids"]) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["ids"]) for r in corpus_pipeline.run(spark, folder).collect()) == expected
    assert {i for i, _ in expected} >= {str(i) for i in range(60)} | {"203", "None"}


def test_stages_on_messy_and_empty_documents(spark, folder, messy, empty):
    for docs in (messy, empty):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, folder)
            result.collect()
            if name != "pieces":
                assert result.columns == docs.columns and result.dtypes == docs.dtypes
