"""Every registered query against its SQL twin on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from loomwork.operators import audit
from loomwork.plans import queries as plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def rows(records, columns):
    at = sorted(range(len(columns)), key=columns.__getitem__)
    tidy = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(tidy(r[i]) for i in at) for r in records), key=repr)


@pytest.fixture(scope="module")
def oracle():
    with duckdb.connect() as con:
        for t in TABLES:
            con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
        yield con


@pytest.mark.parametrize("name", plans.QUERIES)
def test_query(spark, oracle, name):
    got = plans.QUERIES[name](spark, SF)
    if name not in plans.SQL:
        assert got.columns and got.count() > 0
        return
    want = oracle.sql(plans.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.collect(), got.columns) == rows(want.fetchall(), want.columns)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("term", ["mid", "long"])
def test_stream_job_audits_its_annotated_rows(spark, term):
    """The audit sink against the same audit over the refined rows, for closed windows; the trace counts all rows."""
    _, refined, trace, audited = plans._streamed(spark, SF, term)
    rows = spark.read.parquet(refined)
    last = rows.selectExpr("max(ts)").first()[0]
    want = audit.windowed_audit(rows.withColumn("timestamp", rows.ts).withColumn("_dq_status", F.lit("PASSED"))).where(F.col("window_end") <= F.lit(last))
    got = spark.read.parquet(audited)
    assert rows.count() > 0 and got.count() > 0
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    assert spark.read.parquet(trace).selectExpr("sum(record_count)").first()[0] == rows.count()


def test_the_entry_without_a_library_of_the_training_data_operators(tmp_path):
    """The core queries stay when a library that only those operators import is missing."""
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert done.stdout.split()[-2:] == [str(len(plans.QUERIES)), str(len(plans.SQL))]
