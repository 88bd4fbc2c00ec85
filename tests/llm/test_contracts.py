"""Columns and types of every operator's query."""

import pytest

from lexmill.llm.queries import QUERIES

CONTRACTS = {
    "op2": "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    "op3": "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    "op5": "page_id long, host string, path string, rule string, verdict string",
    "op6": "doc_id long, start long, n_tokens long, ids_crc32 long",
    "op7": "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int",
    "op8": "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
    "op9": "vec_id long, n_links long, component_id long, kept boolean",
    "op10": "doc_id long, fingerprint string, component_id long",
    "op11": "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    "op12": "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13": "doc_id long, held_out boolean, lang_pred string, score double",
}


@pytest.mark.parametrize("number", list(CONTRACTS))
def test_query_has_the_columns_and_types_of_its_contract(spark, sf_dir, number):
    name = next(n for n in QUERIES if n.startswith(f"{number}_"))
    got = dict(QUERIES[name](spark, sf_dir).dtypes)
    wanted = dict(c.split() for c in CONTRACTS[number].split(", "))
    assert {c: got.get(c) for c in wanted} == {c: {"long": "bigint"}.get(t, t) for c, t in wanted.items()}
