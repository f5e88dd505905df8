"""The registered queries against their SQL, the pipeline stage by stage against its operators."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tidewatch.llm import queries, shards

TABLES = "documents embeddings benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def value(v):
    return repr(v + 0.0) if isinstance(v, float) else str(v)


def test_every_operator_is_registered():
    names = set(contract.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op") and x[2].isdigit()} and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got, want = queries.queries()[name](spark, sf_dir), duck.sql(queries.oracle_sql()[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    place = [want.columns.index(c) for c in order]
    ours = sorted(tuple(value(v) for v in r) for r in got.select(*order).collect())
    assert ours == sorted(tuple(value(r[i]) for i in place) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql()) - {"op11_whitening"}))
def test_query_returns_a_row_per_document(spark, sf_dir, name):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert queries.queries()[name](spark, sf_dir).count() == documents.count()


def test_whitening_has_eight_rows_per_vector(spark, sf_dir):
    out = queries.queries()["op11_whitening"](spark, sf_dir)
    assert dict(out.dtypes)["deviation"] == "bigint"
    assert out.count() == 8 * spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert out.selectExpr("max(identity_error)").first()[0] < 1e-9


WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, {repo!r})
from tidewatch.llm import queries
from tidewatch.session import local_session
spark = local_session("alone", "4")
spark.sparkContext.setLogLevel("ERROR")
for name, query in sorted(queries.queries().items()):
    print("ROWS", name, query(spark, {sf_dir!r}).count())
"""


def test_workers_need_no_copy_of_the_package(sf_dir, tmp_path):
    repo = os.path.dirname(os.path.abspath(contract.__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = WITHOUT_PACKAGE.format(repo=repo, sf_dir=sf_dir)
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    done = [line.split()[1] for line in run.stdout.splitlines() if line.startswith("ROWS")]
    assert done == sorted(queries.queries()), run.stderr[-3000:]


def test_stages_keep_their_columns_and_decisions(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        path = os.path.join(tmp_path, str(k))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] < counts[4] == counts[5]
    assert sorted(r.slot for r in docs.collect()) == list(range(counts[-1])) and shards.STRIDE == 2 * shards.RECORD + 1
