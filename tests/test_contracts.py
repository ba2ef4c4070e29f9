import pytest

from claimscope.functions.columns import validate_names
from claimscope.operators.monitoring import DEFAULT_RULES, data_quality


@pytest.mark.parametrize("names", [[], ["a", "a"], ["provider_id"], ["dataset_split"], ["bad-name"], ["1x"],
                                   ["x; DROP TABLE y"]])
def test_invalid_feature_lists(names):
    with pytest.raises(ValueError):
        validate_names(names)


def test_valid_feature_list_keeps_order():
    assert validate_names(["b", "a", "c_1"]) == ["b", "a", "c_1"]


def test_missing_quality_rule_fails_closed(spark):
    df = spark.createDataFrame([("p1", "TEST", 0.5)], "provider_id string, dataset_split string, newf double")
    with pytest.raises(ValueError, match="Missing quality rule"):
        data_quality(df, DEFAULT_RULES, ["newf"], monitoring_ts="2024-01-01 00:00:00")


def test_quality_rules_null_is_not_invalid(spark):
    rules = {"x": {"min": 0, "max": 1}, "y": {"min": 0, "allow_null": True}}
    df = spark.createDataFrame([("a", "TEST", None, None), ("b", "TEST", 2.0, -1.0), ("b", "TEST", 0.5, 0.0)],
                               "provider_id string, dataset_split string, x double, y double")
    r = data_quality(df, rules, monitoring_ts="2024-01-01 00:00:00").first()
    assert (r.total_rows, r.unique_providers, r.duplicate_rows) == (3, 2, 1)
    assert r.null_feature_values == 1          # y allows NULL
    assert r.invalid_feature_values == 2       # x=2 (>1), y=-1 (<0); NULLs are not invalid
    assert r.monitoring_status == "ALERT"


def test_no_hidden_now(spark):
    df = spark.createDataFrame([("a", "TEST", 0.5)], "provider_id string, dataset_split string, x double")
    with pytest.raises(ValueError):
        data_quality(df, {"x": {"min": 0}})
