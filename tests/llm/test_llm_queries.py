"""The queries that have a DuckDB twin, and what all of them promise."""

import pytest
from check_oracle import compare, duck

import __spark_entry__ as registered
from wayfare.llm.oracle import ORACLE
from wayfare.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twins(spark, name):
    assert compare(spark, duck(FOLDER), name, FOLDER) == ""


def test_each_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())


def test_planted_conversation(spark):
    row = QUERIES["op7_chat_formatting"](spark, FOLDER).where("conv_id = -7").first()
    assert (row.n_turns, row.loss_chars) == (2, len("</s>[INST] ok [/INST]"))
