from weekcast.config import CORRECTED, ForecastConfig
from weekcast.operators import parameters


def table(spark, rows, kind="string"):
    return spark.createDataFrame(rows, f"parameter string, value {kind}")


def settings(df):
    return {r.parameter: r.value for r in df.collect()}


def test_defaults_and_overrides(spark):
    empty = table(spark, [])
    assert settings(parameters.resolve_params(empty)) == {
        "average_window": 5, "predict_range": 5, "base_data": 4, "maxyearweek": 201627,
    }
    given = table(spark, [("average_window", "7.9"), ("base_data", "4"), ("other", "1"),
                          ("predict_range", "6"), ("predict_range", "8"), ("maxyearweek", "201610")])
    assert settings(parameters.resolve_params(given)) == {
        "average_window": 7, "predict_range": 8, "base_data": 3, "maxyearweek": 201610,
    }
    assert parameters.config_from_params(given) == ForecastConfig(7, 8, 3, "201610")


def test_default_base_is_n_weeks_when_corrected(spark):
    config = parameters.config_from_params(table(spark, []), CORRECTED)
    assert config.base_back == 3 and config.base_weeks == 4 and config.base_divisor == 4
    assert parameters.config_from_params(table(spark, [])).base_back == 4


def test_entry_rules(spark):
    entries = table(spark, [("average_window", 2), ("average_window", 3), ("average_window", 8),
                            ("average_window", 9), ("predict_range", 4), ("predict_range", 3),
                            ("base_data", 20), ("base_data", 21), ("unknown", 5)], "int")
    valid = parameters.validate_params(entries)
    assert sorted((r.parameter, r.value) for r in valid.collect()) == [
        ("average_window", 3), ("average_window", 8), ("base_data", 20), ("predict_range", 4),
    ]
    both = parameters.append_params(valid, entries)
    assert both.count() == 8


def test_update(spark):
    rows = table(spark, [("average_window", 3), ("average_window", 4), ("base_data", 5)], "int")
    out = parameters.update_param(rows, "average_window", 6)
    assert sorted((r.parameter, r.value) for r in out.collect()) == [
        ("average_window", 6), ("average_window", 6), ("base_data", 5),
    ]
    assert parameters.update_param(rows, "average_window", 99) is rows
    assert parameters.update_param(rows, "unknown", 5) is rows
