"""What plans must not hold, and what must reach the scans."""

import re

import pytest

from moraine.plans import registry

#: The sample x taxon grid is every pairing by definition; one-row tables join without keys; containment of names has none.
PAIRINGS = {"q_dense_grid", "q_recommendations_union", "q_recommendation_counts", "q_target_resolution"}
PYTHON = {"q_greedy_cover"}
#: They run jobs while they are built: rounds that are stored, files that are landed.
EAGER = {"q_density_choice", "q_augment_panel", "q_self_redundancy", "q_cluster_representatives", "q_lineage_walk", "q_names_at_ranks"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf):
    return {n: plan(f(spark, sf)) for n, f in registry.QUERIES.items() if n not in EAGER}


def test_no_nested_loops(plans):
    assert not [n for n, p in plans.items() if n not in PAIRINGS and re.search("CartesianProduct|NestedLoopJoin", p)]


def test_python_only_where_an_algorithm_is_sequential(plans):
    assert {n for n, p in plans.items() if re.search("Python|Pandas|InArrow", p)} <= PYTHON


def test_scans_read_what_is_needed(plans):
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plans["q_best_primer"]
    assert re.search(r"PushedFilters: \[.*GreaterThan\(l_quantity,20.0\)", plans["q_union_dedup"])
    assert re.search(r"PushedFilters: \[.*EqualTo\(l_returnflag,R\)", plans["q_done_anti_join"])


def test_aggregates_combine_before_they_shuffle(plans):
    for n in ("q_reason_frequency", "q_kmer_counts", "q_status_counts", "q_matrix_outer_merge", "q_occurrence_bucket"):
        assert "partial_" in plans[n], n
