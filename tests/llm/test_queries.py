"""The registered text queries against their SQL, and the pipeline."""

import pytest
from tests.check_oracles import compare, connect

import corpus_pipeline
from faunatally.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(name, spark, folder):
    assert compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert ids and max(map(ids.count, set(ids))) <= 2 and set(ids) <= {r.doc_id for r in docs.select("doc_id").collect()}


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def small_tables(spark, path, docs):
    spark.createDataFrame(docs, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, k % 2) for k in range(4)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_pipeline_without_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, small_tables(spark, tmp_path, [])).collect() == []


def test_pipeline_of_nulls_repeats_and_contaminated_rows(spark, tmp_path):
    words = " ".join(f"w{k}" for k in range(40))
    docs = [
        (1, words, "en", "s", 1),
        (2, words.upper(), "en", "s", 1),
        (2, words.upper(), "en", "s", 1),
        (3, f"{words.replace('w', 'v')} one two three four", "en", None, 1),
        (4, None, None, None, None),
        (5, "", "en", "t", 0),
        (6, words.replace("w", "u"), None, "t", 1),
        (None, "alone", "de", "t", 1),
    ]
    out = corpus_pipeline.run(spark, small_tables(spark, tmp_path, docs)).collect()
    ids = [r.doc_id for r in out]
    # 2 is a near duplicate of 1 and 3 holds a benchmark item; the others may be taken up to twice
    assert {1, 6} <= set(ids) <= {1, 4, 5, 6, None}
    assert max(map(ids.count, ids)) <= 2
    starts = sorted((r.start, r.n_tokens) for r in out)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(len(starts))]
