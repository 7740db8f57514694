"""Every operator that returns its input's columns, on tables that already have columns of all names it uses inside."""

import pytest
from pyspark.sql import functions as F

from tiermill.llm import line_dedup, mixing, near_dup, packing, queries

NAMES = "a m x _a _m _x _cell _source mass want own _text _id _whole _gone _hash _stays _rows __id rows stays whole component item bin row last up more grp level".split()


def clashing(df):
    return df.withColumns({n: F.lit(f"own {n}") for n in NAMES})


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).union(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)).cache()


OPERATORS = {
    "mixing": lambda df: mixing.mix_weights(df, queries.topic(), queries.MIX),
    "line dedup": lambda df: line_dedup.drop_lines(df, least=2),
    "near-dedup": near_dup.one_of_each,
    "packing": lambda df: packing.pack(df.withColumn("length", F.length("text").cast("long") % 4096)).drop("sequence_id", "offset"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_own_columns_come_back_untouched(docs, name):
    run = OPERATORS[name]
    got, plain = run(clashing(docs)), run(docs)
    assert all(r[n] == f"own {n}" for r in got.select(*NAMES).collect() for n in NAMES)
    assert rows(got.drop(*NAMES)) == rows(plain)
