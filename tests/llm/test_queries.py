"""Registered queries against SQL, the pipeline against its stages, and the library without this part."""

import builtins
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from resalelake.llm.common import table
from resalelake.llm.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("ORACLE_SF", "0.001")
FOLDER = f"/root/testdata/sf{SF}"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, FOLDER)
    result = duck.execute(ORACLE_SQL[key])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr(tuple(row)) for row in result.fetchall())
    assert sorted(repr(tuple(r[n] for n in names)) for r in df.collect()) == want


COLUMNS = {
    "op1_context_mixing_scores": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3_bit_packed_ids": "doc_id start n_tokens ids_crc32",
    "op6_nonnegative_pu_toxicity": "doc_id held_out score predicted",
    "op7_simhash_near_dedup": "doc_id fingerprint component_id",
    "op9_minimax_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op12_merge_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op13_tokenizer_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op10_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
}


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_query_covers_the_whole_table(spark, key):
    df = QUERIES[key](spark, FOLDER)
    assert df.columns[: len(COLUMNS[key].split())] == COLUMNS[key].split()
    assert df.select("doc_id").distinct().count() == table(spark, FOLDER, "documents").count()


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, FOLDER)
        rows = kept.collect()
        assert kept.columns == docs.columns and len({r.doc_id for r in rows}) == len(rows)
        assert {r.doc_id for r in rows} <= set(before)
        assert all(len(r.text) == r.n_chars for r in rows)
        if name == "line dedup":
            assert len(rows) == len(before)
        before = {r.doc_id: r for r in rows}
        kept = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER)
    assert {r.doc_id for r in packed.collect()} == set(before)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed.collect())


def test_the_rest_imports_without_this_part():
    code = (
        "import builtins, sys\n"
        "real = builtins.__import__\n"
        "import importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('resalelake.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in e.queries())\n"
        "assert set(e.oracle_sql()) == set(e.queries())\n"
    )
    root = Path(__file__).resolve().parents[2]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
    assert builtins.__import__
