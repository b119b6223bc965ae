from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from tidewell.llm.ship import ship_package  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship_package(spark)


AWKWARD = "doc_id long, text string, ids string, score string, length string, node string, kept string, `row key` string, `set_a` string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like those that operators make."""
    long_text = " ".join(f"wort{i % 9973} and{i}" for i in range(30_000))
    prose = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty more"
    rows = [
        (None, None),
        (None, prose),
        (1, ""),
        (2, " \n\t "),
        (3, prose),
        (3, prose),
        (4, "Éa ßü 日本 <|endoftext|> 👍🏽"),
        (5, long_text),
        (6, prose + " again"),
        (7, "x" * 50_000),
        (8, "short"),
        (8, "other text of one id"),
        (9, "Released under the MIT License."),
    ]
    return spark.createDataFrame([(*row, *("clash",) * 7) for row in rows], AWKWARD)


@pytest.fixture(scope="session")
def no_rows(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
