"""Registered queries next to their SQL texts on the smallest data."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tripleframe import plans
from tools.check_queries import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
SOME = [
    "A12_assemble_nested", "A9_insert_conflicts", "B6_mixed_types", "B8_mixed_types", "E2_collect_none", "JN3_relation_during", "JN3_relation_equals",
    "A4_import_csv_embedded", "A5_flatten_depth_3", "A6_ntriples_round_trip", "A11_triplify_sets_and_lists", "B3_star", "B8_triple_next",
    "C2_distinct", "C7_subsumption", "JN1_and", "JN2_range_join", "JN3_interval_join", "JN8_compatibility_join", "E1_group_by", "E2_collect",
    "O3_start", "F5_substr_generate", "F29_date_duration_time", "F34_interval_relation_typed", "P9_path_variable", "H10_insert",
    "I3_update_triple", "J6_apply_difference", "J7_rebase", "K2_validate_documents", "L1_expand",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    held = duckdb.connect()
    for table in TABLES:
        held.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return held


@pytest.mark.parametrize("name", SOME)
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    good, text = compare(spark, con, FOLDER, name)
    assert good, text


def test_every_query_has_sql_but_the_random_ones():
    assert set(plans.QUERIES) - set(plans.ORACLES) == {"F44_idgen_random", "K5_assign_ids_random"}
    assert set(plans.ORACLES) <= set(plans.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["region", "revenue", "orders"]
