import pytest
from oracle_check import connect, difference

from claimloom.llm.oracles import ORACLES
from claimloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tables():
    return connect("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, tables, name):
    assert difference(QUERIES[name](spark, "/root/testdata/sf0.01"), tables, ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_contract_columns(spark, name):
    want = {
        "op1_quality": "doc_id bigint, held_out boolean, score double, predicted int",
        "op2_chat_windows": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        "op4_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
        "op5_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
        "op6_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        "op7_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
        "op10_html_text": "page_id bigint, url string, text string, n_chars bigint",
    }[name]
    got = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert ", ".join(f"{c} {t}" for c, t in got.dtypes).startswith(want)
    assert got.count() > 0
