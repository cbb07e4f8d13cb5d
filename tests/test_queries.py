"""Every query with an oracle against DuckDB on the smallest tables; the entry point; a stream."""

import collections
import glob
import math
import os
import pathlib
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__
from weftlink.catalog import ORACLE, QUERIES
from weftlink.plans import fixtures, linkage
from weftlink.streaming.incremental import linked_stream

DIR = "/root/testdata/sf0.001"


def bag(df):
    def plain(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        return round(float(v), 6) if hasattr(v, "__float__") and not isinstance(v, str) else str(v)

    return collections.Counter(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        db.execute(f"create view {os.path.basename(f)[:-8]} as from '{f}'")
    return db


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck, name):
    ours, theirs = QUERIES[name](spark, DIR).toPandas(), duck.execute(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert bag(ours) == bag(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() >= 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 67


@pytest.mark.parametrize("also", [[], ["corpus_pipeline.py"]])
def test_entry_without_the_optional_part(tmp_path, also):
    """With the folders of the training-data operators gone, the other queries are still there."""
    here = pathlib.Path(__spark_entry__.__file__).parent
    shutil.copytree(here, tmp_path / "copy", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", *also))
    code = "import __spark_entry__ as e; print(*sorted(e.queries()), len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=env, capture_output=True, text=True, check=True).stdout.split()
    assert got == [*sorted(QUERIES), str(len(ORACLE))]


def test_stream(spark, tmp_path):
    ent = fixtures.doc_entities(spark, DIR)
    ent.where("source = 1").write.parquet(str(tmp_path / "in"))
    other = ent.where("source <> 1")
    config = linkage.Config(passes=("exact",), by_address=False)
    stream = spark.readStream.schema(ent.schema).parquet(str(tmp_path / "in"))
    q = linked_stream(stream, lambda batch: linkage.link(batch.unionByName(other), config), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 67
