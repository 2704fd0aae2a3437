import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.data import mart_frame
from weekcast.sources import files, jdbc, schemas, shared


def test_csv_keeps_nulls_and_types(spark, tmp_path):
    rows = [("A01", None, "PG", "S", "R", "I", "201401", 10, 1, 9.0, 8.0, 0.2, 3.0)]
    df = spark.createDataFrame(rows, schemas.JOINED_SALES)
    files.write_csv(df, f"{tmp_path}/out")
    back = files.read_csv(spark, f"{tmp_path}/out", schemas.JOINED_SALES)
    assert back.schema.names == df.schema.names and back.collect() == df.collect()
    files.write_csv(df.limit(0), f"{tmp_path}/out")  # overwrites
    assert files.read_csv(spark, f"{tmp_path}/out", schemas.JOINED_SALES).count() == 0


def test_csv_is_read_by_the_names_of_its_header(spark, tmp_path):
    (tmp_path / "in.csv").write_text("value,note,PARAMETER\n5,x,average_window\n")
    back = files.read_csv(spark, f"{tmp_path}/in.csv", schemas.PARAMETERS)
    assert back.columns == ["parameter", "value"] and tuple(back.first()) == ("average_window", 5)
    (tmp_path / "bad.csv").write_text("note,parameter\nx,average_window\n")
    with pytest.raises(ValueError, match="missing columns: value"):
        files.read_csv(spark, f"{tmp_path}/bad.csv", schemas.PARAMETERS)
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("parameter,value\naverage_window,5\n")
    (folder / "b.csv").write_text("value,parameter\n6,predict_range\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(folder), schemas.PARAMETERS).collect()


def test_names_in_any_case(spark, tmp_path):
    df = mart_frame(spark, [("201552", 1, 1, 1)])
    files.write_table(files.normalize_columns(df, upper=True), f"{tmp_path}/t")
    back = files.read_table(spark, f"{tmp_path}/t", schemas.MART)
    assert back.columns == schemas.MART_COLUMNS and back.collect() == df.select(*schemas.MART_COLUMNS).collect()
    with pytest.raises(ValueError, match="missing columns"):
        schemas.conform(df.drop("qty"), schemas.MART)
    with pytest.raises(ValueError, match="differ only in case"):
        schemas.conform(df.toDF(*df.columns[:-1], "QTY"), schemas.MART)


def test_bad_text_fails_at_the_edge(spark, tmp_path):
    (tmp_path / "in.csv").write_text("parameter,value\na,12.0\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_csv(spark, f"{tmp_path}/in.csv", schemas.PARAMETERS).collect()


def test_tables(spark, tmp_path):
    df = mart_frame(spark, [("201552", 1, 1, 1), ("201601", 2, 1, 1)])
    files.write_table(df, f"{tmp_path}/t", partition_by=["year"])
    assert {d for d in os.listdir(tmp_path / "t") if "=" in d} == {"year=2015", "year=2016"}
    back = files.read_table(spark, f"{tmp_path}/t", schemas.MART)
    assert back.filter("year = '2016'").first().qty == 2.0
    files.write_table(df, f"{tmp_path}/u")
    files.write_table(df, f"{tmp_path}/u", mode="append")
    assert files.read_table(spark, f"{tmp_path}/u").count() == 4
    assert files.append_rows(df, df).count() == 4
    assert files.preview(df, 1, ["yearweek"]).first().yearweek == "201552"
    assert files.normalize_columns(df, upper=True).columns[0] == "REGIONSEG"


def _session(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))


def test_shared_folder_follows_the_session(spark, tmp_path):
    assert shared.shared_folder(spark) != shared.shared_folder(spark)
    named = _session(**{"spark.checkpoint.dir": f"{tmp_path}/shared/", "spark.master": "yarn"})
    assert shared.shared_folder(named).startswith(f"{tmp_path}/shared/weekcast-")
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared.shared_folder(_session(**{"spark.master": master}))


def test_written_stage_is_a_scan(spark):
    df = shared.write_stage(spark.range(10).withColumn("x", F.col("id") * 2), shared.shared_folder(spark), "s")
    plan = df.select("x")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:bigint>" in plan and df.count() == 10


def test_jdbc_reads_must_be_split(spark):
    assert jdbc.split_options("id", 1, 100, 8)["numPartitions"] == "8"
    assert jdbc.label_predicates("YEARWEEK", ["201401", "201501"]) == [
        "YEARWEEK < '201401' OR YEARWEEK IS NULL",
        "YEARWEEK >= '201401' AND YEARWEEK < '201501'",
        "YEARWEEK >= '201501'",
    ]
    for cuts in ([], ["b", "a"], ["a'"]):
        with pytest.raises(ValueError):
            jdbc.label_predicates("c", cuts)
    with pytest.raises(ValueError, match="split"):
        jdbc.read_jdbc(spark, "jdbc:none:", "t", {})
    with pytest.raises(ValueError):
        jdbc.split_options("id", 1, 2, 0)


def test_a_failed_stage_can_be_written_again(spark):
    folder = shared.shared_folder(spark)
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("int").alias("x"))
    with pytest.raises(Exception, match="stop"):
        shared.write_stage(bad, folder, "s")
    assert shared.write_stage(spark.range(3), folder, "s").count() == 3


def test_stages_follow_their_input(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in/t.parquet")
    before = shared.identity(spark, f"{tmp_path}/in")
    assert before == shared.identity(spark, f"{tmp_path}/in")
    spark.range(4).write.mode("overwrite").parquet(f"{tmp_path}/in/t.parquet")
    assert before != shared.identity(spark, f"{tmp_path}/in")
    shared.drop_folder(spark, f"{tmp_path}/in")
    assert not os.path.exists(tmp_path / "in")


def test_jdbc_statements_and_rows(spark):
    query = jdbc.parameter_query("p", ["a'b", "c"])
    assert query == (
        "SELECT parameter, MAX(CAST(value AS DECIMAL(20, 4))) AS value FROM p "
        "WHERE parameter IN ('a''b', 'c') GROUP BY parameter"
    )
    assert jdbc.write_options(4, 100, True) == {"numPartitions": "4", "batchsize": "100", "truncate": "true"}
    out = jdbc.outgoing(spark.range(0, 100, 1, 7).withColumnRenamed("id", "qty"), 4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.columns == ["QTY"] and "RoundRobinPartitioning(4)" in plan
