"""Every registered query against its SQL counterpart on an independent engine."""

import pytest

import __spark_entry__ as contract

from .oracle_check import connect, differences


@pytest.fixture(scope="module")
def connection(data):
    return connect(data)


# Beyond SQL: trained models, tokenizers and the like. ``tests/llm`` holds these against brute
# force, round trips and held-out rows.
BEYOND_SQL = {
    "op4_html_text", "op5_toxicity", "op6_pii_surrogates", "op7_token_counts", "op8_piece_merges",
    "op9_language", "op10_packing", "op11_partial_match", "op13_whitening", "pipeline",
}


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, connection, data, name):
    assert differences(spark, connection, data, name) == ""


def test_every_other_query_has_sql():
    """Nothing lacks SQL but the listed operators, which are gone where their package is."""
    assert set(contract.queries()) - set(contract.oracle_sql()) <= BEYOND_SQL
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    result = contract.entry(spark)
    assert result.columns[:3] == ["origin", "month", "departure_delay_band"]
    assert result.count() == 360
