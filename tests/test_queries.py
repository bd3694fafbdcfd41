"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from check import compare, connect
from shapeloom import workload

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


workload.load_all()


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query_matches_sql(spark, con, name):
    oracle = entry_point.oracle_sql()
    assert name in oracle
    assert compare(entry_point.queries()[name](spark, SF_DIR), con, oracle[name]) == ""


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


NARROW = [
    "nearest_bucket", "min_pixels", "oversize_guard", "resize_plan", "center_crop", "random_crop", "latent_shape",
    "json_sidecar", "valid_metadata", "member_filter", "path_stem", "project_columns", "to_float16", "fp8_quantize",
    "normalize_pixels", "denormalize_pixels", "chw_to_hwc", "pad_tokens", "encode_latents", "caption_rows", "scan_catalog",
]


@pytest.mark.parametrize("name", NARROW)
def test_row_level_queries_do_not_shuffle(spark, plan, name):
    assert "Exchange" not in plan(entry_point.queries()[name](spark, SF_DIR))


def test_scans_are_pruned(spark, plan):
    text = plan(entry_point.queries()["resolution_histogram"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert "partial_count" in text
