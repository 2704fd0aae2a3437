"""Bad rows go to the quarantine, good ones load."""

import pytest
from pyspark.sql import types as T

from weekcast.sources.rejects import TooManyRejected, load_csv, read_rejected

SCHEMA = T.StructType([T.StructField("item", T.StringType()), T.StructField("yearweek", T.StringType()), T.StructField("qty", T.DoubleType()), T.StructField("price", T.LongType())])
LINES = ["PRICE,item,yearweek,qty,note", "1,a,201553,2.5,x", "x,b,201601,1,y", "2,c,201453,n/a,z", "3,d,201600,1,", ",e,,,", "4,f,2016w1,1,w", "5,g,201602", "6,h,201603,1,q,extra", "7,i,000012,1,q"]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.csv").write_text("\n".join(LINES) + "\n")
    return tmp_path


def test_good_rows_load_and_each_fault_is_named(spark, folder):
    rows = load_csv(spark, str(folder / "in"), SCHEMA, str(folder / "out"), ("yearweek",), most_rejected=0.8)
    assert rows.schema.fieldNames() == SCHEMA.fieldNames()
    assert sorted(map(tuple, rows.collect())) == [("a", "201553", 2.5, 1), ("e", None, None, None)]
    found = {(r.column, r.reason) for r in read_rejected(spark, str(folder / "out")).collect()}
    assert found == {("price", "not a value of type bigint"), ("qty", "not a value of type double"), ("yearweek", "no ISO week"), (None, "wrong number of fields")}
    lines = [r.line for r in read_rejected(spark, str(folder / "out")).where("column = 'yearweek'").collect()]
    assert len(lines) == 4 and any('"item":"c"' in x for x in lines)
    assert {r.line for r in read_rejected(spark, str(folder / "out")).where("column IS NULL").collect()} == {"5,g,201602", "6,h,201603,1,q,extra"}


def test_too_many_rejected_rows_stop_the_load(spark, folder):
    with pytest.raises(TooManyRejected, match="7 of 9"):
        load_csv(spark, str(folder / "in"), SCHEMA, str(folder / "out"), ("yearweek",), most_rejected=0.5)
    assert read_rejected(spark, str(folder / "out")).count() == 8
    with pytest.raises(ValueError, match="missing columns: other"):
        load_csv(spark, str(folder / "in"), T.StructType([T.StructField("other", T.LongType())]), str(folder / "none"))


def test_a_clean_table_loads_without_a_quarantined_row(spark, folder):
    (folder / "in" / "part.csv").write_text("item,yearweek,qty,price\na,201601,1,2\n")
    rows = load_csv(spark, str(folder / "in"), SCHEMA, str(folder / "out"), ("yearweek",))
    assert rows.collect() == [("a", "201601", 1.0, 2)] and read_rejected(spark, str(folder / "out")).isEmpty()
