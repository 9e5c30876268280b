"""The pipeline's stages on odd rows, one after the other."""

import random

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from martwright.llm.common import stored  # noqa: E402

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, result string, score double,"
    " kept boolean, `row` string, own int, features int, carried_0 string"
)
from shared import checkpoint_folder  # noqa: E402, F401


def odd_rows():
    rng = random.Random(6)
    words = [f"wort{i}" for i in range(900)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passage = " ".join(words[:60])
    texts = [(i, text(rng.choice([70, 90, 200]))) for i in range(120)]
    texts += [(200 + i, f"{text(60)} {passage} {text(60)}") for i in range(3)]
    texts += [(300 + i, texts[5][1]) for i in range(50)]  # copies
    texts += [(7, texts[7][1])] * 2 + [(8, text(80))]  # an id with copies, an id with another text
    texts += [(None, text(90)), (None, None), (400, None), (401, ""), (402, " \n"), (403, text(20_000))]
    return [(d, t, "en", "s", len(t or ""), "r", 0.5, True, "row", 1, 2, "c") for d, t in texts]


def run_stages(spark, docs, folder):
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stored(stage(spark, docs, folder), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == before
    return kept


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, 1, 0) for i in range(500)] + [(None, 1, 0), (3, None, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_odd_rows_pass_all_stages(spark, folder):
    rows = odd_rows()
    kept = run_stages(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), folder)
    # Labels of one class, so the classifier rejects nothing.
    assert kept["quality_classifier"].count() == len(rows)
    assert kept["quality_rules"].filter("text is null or trim(text) = ''").count() == 0
    unique = {r.doc_id for r in kept["near_duplicates"].collect()}
    assert 5 in unique and not unique & set(range(300, 350))
    assert kept["near_duplicates"].filter("doc_id = 7").count() == 1
    assert kept["near_duplicates"].filter("doc_id = 8").count() == 2
    assert kept["near_duplicates"].filter("doc_id is null").count() == 1
    cut = {r.doc_id: r for r in kept["substring_dedup"].collect()}
    for i in range(200, 203):
        assert len(cut[i].text.split()) == 120 and cut[i].n_chars == len(cut[i].text)
    assert cut[403].text == next(t for d, t, *_ in rows if d == 403)
    assert (cut[403].result, cut[403].row, cut[403].carried_0) == ("r", "row", "c")
    packed = kept["packing"].groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept["substring_dedup"].collect()}


def test_empty_table_passes_all_stages(spark, folder):
    kept = run_stages(spark, spark.createDataFrame([], SCHEMA), folder)
    assert all(df.count() == 0 for df in kept.values())
