"""Each registered query of the subpackage on the smallest tables: against SQL where there is some, else for its columns and rows."""

import duckdb
import pytest

from tests.test_catalog import TABLES, TYPES, plain
from veloframe.llm import registry

COLUMNS = {
    "op1_token_files": "doc_id start n_tokens ids_crc32", "op2_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset", "op3_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op4_substring_dedup": "doc_id n_words n_removed kept_sha256", "op5_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated", "op6_language_id": "doc_id held_out lang_pred score",
    "op7_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op8_licence_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op9_jaccard_join": "doc_id n_shingles component_id", "op10_vector_neardup": "vec_id n_links component_id kept",
}


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    rows = df.collect()
    if name not in registry.ORACLE_SQL:
        key = "vec_id" if "vec_id" in df.columns else "doc_id"
        table = "embeddings" if key == "vec_id" else "documents"
        assert sorted({r[key] for r in rows}) == [r[0] for r in duck.sql(f"select distinct {key} from {table} order by 1").fetchall()]
        return
    sql = duck.sql(registry.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(sql.columns)
    kinds = dict(zip(sql.columns, map(str, sql.types), strict=True))
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    at = [sql.columns.index(c) for c in columns]
    assert plain(tuple(r[c] for c in columns) for r in rows) == plain(tuple(r[i] for i in at) for r in sql.fetchall())
