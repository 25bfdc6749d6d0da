"""The registered queries of the training-data operators on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
import check_oracle
from wardline.llm.oracle import ORACLE_SQL
from wardline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
CONTRACTS = {
    "op1_scoring": [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"),
                    ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double")],
    "op4_near_duplicates": [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")],
    "op6_mixing": [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")],
    "op7_near_search": [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")],
    "op8_warc": [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"),
                 ("record_type", "string"), ("refers_to", "bigint")],
    "op9_exact_search": [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")],
    "op11_token_alignment": [("doc_id", "bigint"), ("n_a", "bigint"), ("n_b", "bigint"), ("n_groups", "bigint"), ("n_links", "bigint"),
                             ("n_best", "bigint"), ("count_sum", "bigint"), ("groups_sha256", "string")],
    "op12_lexical_search": [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")],
    "op13_quality": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op10_language": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
}


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(FOLDER)


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    assert check_oracle.compare(spark, con, FOLDER, name, QUERIES[name], ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_columns_are_those_agreed(spark, name):
    assert [c for c in QUERIES[name](spark, FOLDER).dtypes if c in CONTRACTS[name]] == CONTRACTS[name]
