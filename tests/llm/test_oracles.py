"""The SQL of the queries on small tables that hold what the large ones may."""

from pathlib import Path

import duckdb
import numpy as np
import pytest

from scrubline.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import HARD
from tests.llm.test_vectors import clustered


def same(spark, folder, name):
    database = duckdb.connect()
    for table in ("embeddings", "pages", "documents", "benchmark"):
        if not Path(f"{folder}/{table}.parquet").exists():
            continue
        database.sql(f"create view {table} as from '{folder}/{table}.parquet/*.parquet'")
    wanted = database.sql(ORACLES[name])
    found = QUERIES[name](spark, folder)
    assert sorted(found.columns) == sorted(wanted.columns)
    rows = sorted((tuple(r[c] for c in wanted.columns) for r in found.collect()), key=str)
    assert rows == sorted(wanted.fetchall(), key=str)
    return rows


@pytest.mark.parametrize("name", ["op2_exact_top_k", "op5_embedding_near_duplicates"])
def test_vectors_in_groups(spark, tmp_path, name):
    dice = np.random.default_rng(7)
    rows = clustered(dice, 25, 8, 10, 0.06)
    rows = np.vstack([rows, rows[:20], 2 * rows[20:30]])
    cells = [(i * 5, [float(x) for x in row], int(i % 2)) for i, row in enumerate(rows)]
    # Vectors that take no part; ids do not repeat, as SQL asks a repeated query twice.
    cells += [(10_000 + i, v, 1) for i, (_, v, _) in enumerate(HARD["embeddings"][4:8])]
    cells += [(20_000, None, 0), (20_050, [1.0] * 10, None)]
    schema = "vec_id long, embedding array<float>, label int"
    spark.createDataFrame(cells, schema).write.parquet(str(tmp_path / "embeddings.parquet"))
    spark.createDataFrame([], "page_id long").write.parquet(str(tmp_path / "pages.parquet"))
    found = same(spark, str(tmp_path), name)
    assert name.startswith("op2") or sum(r[1] > 0 for r in found) > 30


@pytest.mark.parametrize("name", ["op11_host_rules", "op12_spelling_variants", "op13_importance_resampling"])
def test_documents(spark, hard_rows, name):
    assert same(spark, hard_rows, name)


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
