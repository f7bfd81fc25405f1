"""Registered SQL-checkable queries against DuckDB on sf0.001 (the driver
does the same at sf0.01).  Model queries are covered in test_models."""

import math

import pytest

import __spark_entry__ as E
from data_paths import SF_SMALL

SCALAR = [
    "typed_cast", "fixed_point", "ordinal_encode", "minmax_1_5", "minmax_unit",
    "minmax_bounds", "minmax_constant", "bias_adjust", "round_class", "mismatch_rows",
    "error_fraction", "rmse", "rmse_bias", "hash_split", "hash_split_counts",
    "csv_items_encode", "libsvm_roundtrip",
]


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.9g}")
        return v
    out = sorted((tuple(norm(r[i]) for i in order) for r in rows),
                 key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


def test_every_query_has_oracle_or_is_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    rows_only = set(E._QUERIES) - set(E._ORACLE)
    assert rows_only == {
        "pair_grade_metrics", "pair_grade_bias_metrics", "pair_price_metrics",
        "forest_nodes", "forest_grade_metrics", "forest_grade_subset_metrics",
        "forest_price_metrics", "sweep_grade_bias_metrics",
        "csv_pair_grade_metrics", "pair_grade_pairs_metrics", "csv_sweep_grade_bias_metrics"}


@pytest.mark.parametrize("name", SCALAR)
def test_scalar_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["user", "item", "n", "n_labelled", "rmse", "error_fraction", "n_bias", "rmse_bias",
                          "dropped_train", "dropped_test"]
    assert len(rows) == 1 and rows[0]["n"] > 0


# Model queries: the row set must come out of fit + transform and equal the
# SQL row set (cold-start survivors, factor ids, test rows, counts).
MODEL_KEYS = ["als_user_ids", "als_scored_keys", "forest_class_scored_keys", "pair_grade",
              "pair_grade_bias", "preview25", "csv_pair_grade", "libsvm_forest_grade", "als_pairs_scored_keys"]


@pytest.mark.parametrize("name", MODEL_KEYS)
def test_model_row_set_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(ocols, res.fetchall())
