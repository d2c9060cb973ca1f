"""Every registered query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from skyledger.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    text = lambda v: "None" if v is None or v != v else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    found = registry.queries()[name](spark, FOLDER)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(found.columns) == sorted(want.columns)
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows(want.columns, want.fetchall())


#: Queries over all keys of a table, some of which are too large at the smallest scale to show.
LARGE_KEYS = ("q_coded_numbers", "q_approach_idents", "q_associations", "q_section_heads", "q_region_faults", "q_procedure_kinds", "q_effective_periods", "q_group_editions", "q_edition_agreement", "q_complete_cycles", "q_printed_pages", "q_chunk_roles")


@pytest.mark.parametrize("name", LARGE_KEYS)
def test_query_matches_sql_on_larger_tables(spark, name):
    folder, con = FOLDER.replace("0.001", "0.01"), duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found, want = registry.queries()[name](spark, folder), con.sql(registry.oracle_sql()[name])
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["q_landing_areas", "q_outline_levels", "q_local_targets"])
def test_queries_whose_operators_are_tested_elsewhere_run(spark, name):
    assert registry.queries()[name](spark, FOLDER).count() > 0
