"""The registered queries: contract columns, whole tables, and their SQL where there is any."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from opslens.llm import oracle, queries
from tools.compare import TABLES, digest

COLUMNS = {
    1: "doc_id n_email n_ip n_card n_phone base_sha256 spans", 2: "page_id payload_bytes payload_digest record_type refers_to",
    3: "doc_id held_out score predicted", 4: "query_id rank vec_id score",
    5: "doc_id n_words n_base first_word last_word base_labels labels score", 6: "doc_id item_id edit_distance",
    7: "page_id host path rule verdict", 8: "doc_id fingerprint component_id", 9: "doc_id n_bytes n_removed n_spans kept_sha256",
    10: "doc_id size source_size target taken", 11: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    12: "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    13: "doc_id start length ids_crc32 doc_tokens sequence_id offset"}
TABLE_OF = {2: "pages", 7: "pages"}


def test_one_query_of_each_number_and_the_pipeline():
    names = E.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(oracle.ORACLE) <= set(E.oracle_sql()) & set(names)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns_and_rows(spark, name):
    n = int(name[2:].split("_")[0])
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert df.columns[:len(COLUMNS[n].split())] == COLUMNS[n].split()
    rows = df.count()
    if n not in (4, 6, 13):
        assert rows == spark.read.parquet(f"{SF_SMALL}/{TABLE_OF.get(n, 'documents')}.parquet").count()


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    cur = con.execute(oracle.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, cur.fetchall())[0]
