"""Every bound query against its SQL, over whole tables."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
# Names of the operator inventory that must stay registered.
INVENTORY = """scan_delimited scan_parquet sheet_rows_clean union_relaxed snapshot_from_filename load_cities run_metadata
normalize_columns clean_label recode_values remap_codes titlecase_strings parse_dash_numeric join_try_cast join_prefix_key
filter_ilike concat_label fill_nulls row_sum_index rates_per_k deaths_outside occupancy_rate round_columns map_region
flag_capital feature_subset filter_active_snapshot semi_join_active filter_footer count_positive dashboard_filter
star_left_join wide_left_joins inner_chain join_admissions geo_left_join first_last_seen wide_with_pivot agg_beds agg_count
deaths_by_municipality count_distinct_filtered group_by_all wide_municipal_table dedup_ignore_snapshot dedup_latest_per_key
distinct_sorted pivot_fixed pivot_dynamic kpi_overview top5_states cluster_profile cluster_sizes crosstab box_stats
snapshot_audit median_vs_national capacity_ranking kruskal_wallis sort_nulls_last union_align standardize embed_2d
density_cluster recluster_noise variance_filter correlation_filter kmeans_best_of hierarchical_cluster silhouette
align_labels correlation_matrix scan_file list_files base_table_name find_table replace_table csv_round_trip
deaths_with_names kmeans_separated hierarchical_separated""".split()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_inventory_is_registered():
    assert set(INVENTORY) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    result = queries()[name](spark, FOLDER)
    if name in oracle_sql():
        assert compare(result, duck, oracle_sql()[name]) is None
    else:
        assert result.count() > 0


def test_sorted_results_are_in_order(spark):
    rows = queries()["sort_nulls_last"](spark, FOLDER).collect()
    known = [r["price"] for r in rows if r["price"] is not None]
    assert known == sorted(known, reverse=True) and rows[-1]["price"] is None


def test_flagship(spark):
    result = entry(spark)
    assert result.count() > 0 and len(result.columns) == 88
