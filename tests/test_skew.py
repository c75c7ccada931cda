"""The same queries on copies of the tables in which one key, user, type or price holds a third of the rows."""

from __future__ import annotations

import compare
import duckdb
import pytest

import __spark_entry__ as E

HOT = {
    "lineitem": "case when hash(l_orderkey, l_linenumber) % 3 = 0 then 5 else l_partkey end as l_partkey, "
    "case when hash(l_linenumber, l_orderkey) % 3 = 0 then 3 else l_suppkey end as l_suppkey",
    "orders": "case when hash(o_orderkey) % 3 = 0 then 7 else o_custkey end as o_custkey",
    "events": "case when hash(event_id) % 3 = 0 then 9 else user_id end as user_id",
    "part": "case when hash(p_partkey) % 3 = 0 then 'HOT' else p_type end as p_type, "
    "case when hash(p_partkey + 1) % 3 = 0 then 5000.0 else p_retailprice end as p_retailprice",
}
QUERIES = (
    "panel_base",
    "impute_mode",
    "impute_group_median",
    "top_genres",
    "tfidf_scores",
    "keyword_lift",
    "encode_train",
    "latest_per_entity",
    "change_4w",
    "overview_ranked",
    "split_counts",
    "split_fallback",
    "dedupe_first",
    "src_resume_anti",
    "src_load_report",
    "src_cache_scan",
    "metrics_append_dedupe",
)


@pytest.fixture(scope="module")
def skewed(sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for t in compare.TABLES:
        replaced = f"* replace ({HOT[t]})" if t in HOT else "*"
        con.execute(f"copy (select {replaced} from '{sf_dir}/{t}.parquet') to '{folder}/{t}.parquet' (format parquet)")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_hot_keys(name, spark, skewed):
    result = E.queries()[name](spark, skewed)
    wanted = compare.oracle_rows(compare.connect(skewed), E.oracle_sql()[name])
    assert compare.difference(compare.spark_rows(result), wanted) is None
