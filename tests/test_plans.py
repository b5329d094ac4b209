"""Plan shape guards: no cross products or keyless nested-loop joins, filters
reach the Parquet scan, and the EAV widening is a single aggregation."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

CHECKED = ["c1_process_data", "c2_clean", "c3_merge_and_clean", "c4_inference_dataset", "j9_eav_widen",
           "a5_value_counts_total", "a10_numeric_profile", "a14_quantile", "p14_percentile_filter",
           "e2_binary_auc", "e4_roc_curve", "e7_calibration", "x1_spearman", "x3_kendall_tau", "x4_box_stats",
           "m1_stratified_split", "m4_class_weights", "k8_fcm_predict", "k10_silhouette_sq", "w2_recurrence_flag"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", CHECKED)
def test_no_cross_products(spark, name):
    text = plan_text(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_filters_pushed_to_scan(spark):
    text = plan_text(E.queries()["p8_criteria_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_orderpriority), EqualTo(o_orderstatus,F)" in text


def test_projection_pruned(spark):
    text = plan_text(E.queries()["j9_eav_widen"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text
