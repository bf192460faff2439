import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

#: Columns that the queries return first.
COLUMNS = {
    1: "doc_id n_bytes n_removed n_spans kept_sha256",
    3: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    4: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    6: "query_id rank vec_id score",
    7: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    8: "page_id host path rule verdict",
    9: "page_id url text n_chars",
    10: "doc_id n_shingles component_id",
    11: "doc_id held_out score predicted",
    12: "lang rank phrase a l r n score",
    13: "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
}


def test_each_operator_has_one_query():
    names = [re.match(r"op(\d+)_", n) for n in E.queries()]
    assert sorted(int(m[1]) for m in names if m) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("n", [4, 6, 8, 9, 11, 12, 13])
def test_columns(spark, n):
    name = next(q for q in E.queries() if q.startswith(f"op{n}_"))
    assert E.queries()[name](spark, SF001).columns[: len(COLUMNS[n].split())] == COLUMNS[n].split()


def test_pipeline_stages(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    n = docs.count()
    assert [k for k, _ in C.STAGES] == ["quality rules", "n-gram Jaccard join", "PII", "mixing sources to target weights", "packing"]
    from shopsight.llm.common import cut

    counts, ids = [n], {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in C.STAGES:
        before = docs
        docs = cut(stage(spark, before, SF001))
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == before.columns
        if name in ("PII", "mixing sources to target weights"):
            assert {r.doc_id for r in docs.select("doc_id").collect()} == ids
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert counts[1] < n and counts[2] <= counts[1] and counts[3] == counts[2] <= counts[4]
