"""The registered queries against their SQL, and the pipeline on a small table."""

import os

import pytest

pytest.importorskip("destrank.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
duckdb = pytest.importorskip("duckdb")

from destrank.llm import packing  # noqa: E402
from destrank.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))


def test_packing_leaves_no_words_in_idle_workers(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def held(batches):
        import sys

        import pyarrow as pa

        kept = getattr(sys.modules.get("_kept_by_tasks"), "__dict__", {}).get("word encoder")
        words = len(kept[1].known) + len(kept[1].earlier) + len(kept[1].pieces) if kept else 0
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"kept": [kept is not None] * len(batch), "words": [words] * len(batch)})

    packed = corpus_pipeline.packing(spark, docs.repartition(4), SF)
    rows = {(r.doc_id, r.piece): r.ids for r in packed.select("doc_id", "piece", "ids").collect()}
    left = spark.range(0, 8, 1, 4).mapInArrow(held, "kept boolean, words long").collect()
    assert any(r.kept for r in left) and not any(r.words for r in left)
    plain = packing.pack(docs, packing.op3_vocabulary(), special_as_text=True)
    assert rows == {(r.doc_id, r.piece): r.ids for r in plain.select("doc_id", "piece", "ids").collect()}


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op1_language_mixture"](spark, SF).filter("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.9 * len(got)


def test_pipeline(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs, left = documents, documents.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        n = docs.count()
        assert docs.columns == documents.columns and 0 < n <= left, name
        left = n
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == left
