"""Every query over tables with awkward rows, and over empty ones."""

import pytest

import __spark_entry__ as E

NAMES = sorted(k for k in E.queries() if k.startswith("op") and k[2:3].isdigit() or k == "pipeline")
#: Columns that a contract names.
COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_token_records": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op3_simhash_dedup": ["doc_id", "fingerprint", "component_id"],
    "op4_spotsigs": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op5_source_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op7_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op9_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op10_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op11_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op12_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op13_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}
#: Queries whose rows aren't those of documents.
ROWS = {"op10_warc": 47, "op11_whitening": 3 * 74, "op12_chat": 9}


def test_one_query_per_operator():
    assert len(NAMES) == 14


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(spark, tables, odd_docs, name):
    df = E.queries()[name](spark, tables)
    rows = df.collect()
    assert set(COLUMNS.get(name, [])) <= set(df.columns)
    if name in COLUMNS:
        assert len(rows) == ROWS.get(name, len(odd_docs))
    else:
        assert rows


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty_tables, name):
    rows = E.queries()[name](spark, empty_tables).collect()
    assert [r[0] for r in rows] == ([-7] if name == "op12_chat" else [])
