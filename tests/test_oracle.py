"""Every registered query against its SQL on the driver's smallest tables."""

from pathlib import Path

import pytest

from tests.oracle import compare, connect
from workload.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        differences = [d for d in compare(con, df, ORACLE[name], tolerance=1e-6) if d != "no rows"]
        assert not differences
    else:
        assert df.collect()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


SLICED = ["agg4_group_median", "agg5_exact_quantiles", "agg6_interpolated_quantiles", "agg15_column_profile", "agg23_score_summary",
          "fs9_limit_imputation", "fs11_age_imputation", "fs13_count_imputation", "mth7_winsorise", "st4_psi_by_month", "st6_auc_by_month",
          "st8_youden_threshold", "st9_precision_brier_logloss", "st11_calibration", "st13_spearman_matrix", "st13_spearman_with_label",
          "st19_selection_checks", "mon2_monthly_summary", "ml1_linear_preprocessing"]


@pytest.mark.parametrize("name", SLICED)
def test_query_with_slices(spark, con, name, monkeypatch):
    """The same queries as if the rows were too many for one task."""
    from panelkit.operators import impute, ranking
    monkeypatch.setattr(ranking, "SMALL", 0)
    monkeypatch.setattr(impute, "SMALL", 0)
    assert not compare(con, QUERIES[name](spark, SF_DIR), ORACLE[name], tolerance=1e-6)
