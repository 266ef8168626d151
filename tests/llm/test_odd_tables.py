"""Every corpus query over odd and empty tables: nothing crashes, no row is lost."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import pytest
from conftest import SF_DIR
from tables import empty_dir, odd_dir  # noqa: F401

from shelflake.llm.common import stored, table
from shelflake.llm.queries import QUERIES

EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def collected(spark, name, sf_dir):
    return QUERIES[name](spark, sf_dir).collect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    result = QUERIES[name](spark, empty_dir)
    assert result.collect() == []
    assert result.columns == QUERIES[name](spark, SF_DIR).columns


@pytest.mark.parametrize(
    "name",
    [
        "op2_quality_classifier",
        "op6_secrets",
        "op7_decontaminate",
        "op8_quality_rules",
        "op9_near_dedup",
        "op11_fill_in_middle",
        "op13_sentence_pieces",
    ],
)
def test_a_row_for_each_document(spark, odd_dir, name):
    ids = sorted(r["doc_id"] for r in table(spark, odd_dir, "documents").collect() if r["doc_id"] is not None)
    rows = collected(spark, name, odd_dir)
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == ids
    assert sum(r["doc_id"] is None for r in rows) == 2


@pytest.mark.parametrize("name", ["op1_html_extract", "op3_warc"])
def test_a_row_for_each_page(spark, odd_dir, name):
    ids = [r["page_id"] for r in table(spark, odd_dir, "pages").collect()]
    assert sorted(map(str, ids)) == sorted(str(r["page_id"]) for r in collected(spark, name, odd_dir))


def test_texts_without_words(spark, odd_dir):
    for r in collected(spark, "op7_decontaminate", odd_dir):
        if r["doc_id"] in (4, 5, 6):
            assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (0, 0, 0, False)
            assert r["items_sha256"] == EMPTY_DIGEST
    for r in collected(spark, "op8_quality_rules", odd_dir):
        if r["doc_id"] in (4, 5, 6):
            assert (r["n_words"], r["word_chars"], r["base_failed"], r["kept"]) == (0, 0, True, False)
    for r in collected(spark, "op9_near_dedup", odd_dir):
        if r["doc_id"] in (4, 5, 6):
            assert (r["class_id"], r["kept"]) == (r["doc_id"], True)
    for r in collected(spark, "op6_secrets", odd_dir):
        if r["doc_id"] in (4, 5, 6):
            assert (r["base_sha256"], r["spans"]) == (EMPTY_DIGEST, "")


def test_near_classes_of_odd_documents(spark, odd_dir):
    classes = {(r["doc_id"], r["class_id"]) for r in collected(spark, "op9_near_dedup", odd_dir)}
    assert {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (11, -1), (-1, -1)} <= classes


def test_odd_conversations(spark, odd_dir):
    rows = {r["conv_id"]: r for r in collected(spark, "op4_chat", odd_dir)}
    # 1 and 6 are beginnings of 2, whose turns 3 has too; a NULL text is not an empty one.
    assert set(rows) == {2, 4, 5, 7, 8, None}
    assert rows[2]["n_same"] == 2
    assert rows[2]["text"].endswith("<|im_start|>user\nmore<|im_end|>\n")
    assert rows[7]["text"] == "<|im_start|>a\ntie<|im_end|>\n<|im_start|>b\ntie<|im_end|>\n"


def test_odd_pages(spark, odd_dir):
    texts = {r["page_id"]: r["text"] for r in collected(spark, "op1_html_extract", odd_dir)}
    assert texts[3] == texts[4] == texts[6] == ""
    assert texts[1].startswith("Head\n")


def test_odd_documents_are_packed(spark, odd_dir):
    rows = collected(spark, "op10_packing", odd_dir)
    assert sum(r["piece"] == 0 for r in rows) == table(spark, odd_dir, "documents").count()
    assert {r["length"] for r in rows if r["doc_id"] in (4, 5)} == {1}


def test_odd_documents_are_cut(spark, odd_dir):
    for r in collected(spark, "op11_fill_in_middle", odd_dir):
        if r["doc_id"] in (4, 5):
            assert (r["n"], r["form"], r["prefix_chars"]) == (0, "plain", None)
            assert r["output_sha256"] == r["restored_sha256"] == EMPTY_DIGEST


def test_odd_documents_have_pieces(spark, odd_dir):
    for r in collected(spark, "op13_sentence_pieces", odd_dir):
        if r["doc_id"] in (4, 5):
            assert (r["n_tokens"], r["decoded_sha256"]) == (1, EMPTY_DIGEST)
            assert r["ids_sha256"] == hashlib.sha256(b"2").hexdigest()


def test_odd_embeddings(spark, odd_dir):
    rows = collected(spark, "op12_whitening", odd_dir)
    ids = [r["vec_id"] for r in rows]
    assert not {400, 401, 402, 403, 404, 405} & set(ids)
    assert len(rows) == 4 * (30 + 1 + 200 + 1)
    assert {r["n"] for r in rows} == {30}
    assert ids.count(None) == 4 and ids.count(0) == 8


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stages_keep_the_columns(spark, odd_dir, empty_dir, place):
    name, stage = corpus_pipeline.STAGES[place]
    for sf_dir, empty in ((odd_dir, False), (empty_dir, True)):
        docs = table(spark, sf_dir, "documents")
        result = stored(spark, stage(spark, docs, sf_dir), "stage")
        assert (result.count() == 0) == empty
        if place < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == docs.columns
            assert [f.dataType for f in result.schema] == [f.dataType for f in docs.schema]
            if not empty:
                own = docs.columns[5:]
                assert all(r[c] == "own" for r in result.select(own).collect() for c in own)


def test_pipeline_over_odd_and_empty_tables(spark, odd_dir, empty_dir):
    assert corpus_pipeline.run(spark, odd_dir).count() > 0
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
