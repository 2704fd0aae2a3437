"""Tables with a commit log: edits, two writers at once, failures in between, compaction."""

import threading

import pytest
from pyspark.sql import functions as F

from weekcast.sources import versions
from weekcast.sources.shared import commit_file, folder_names, read_file
from weekcast.sources.versions import Conflict, VersionedTable

SCHEMA = "name string, week string, value long, note string"


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "t"))
    made.replace(spark.createDataFrame([("a", "1", 1, "x"), ("a", "2", 2, "y"), ("b", "1", 3, None), (None, "1", 4, "z")], SCHEMA))
    return made


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(table, data, schema):
    return table.spark.createDataFrame(data, schema)


def test_edits_apply_in_their_order(table):
    table.update(frame(table, [("a", 10)], "name string, value long"), ["name"])
    table.append(frame(table, [("a", "3", 5, None)], SCHEMA))
    table.delete(frame(table, [("b",)], "name string"), ["name"])
    table.append(frame(table, [("b", "9", 6, "again")], SCHEMA))
    table.update(frame(table, [(None, 40), ("c", 0)], "name string, value long"), ["name"])
    expected = [("a", "1", 10, "x"), ("a", "2", 10, "y"), ("a", "3", 5, None), ("b", "9", 6, "again"), (None, "1", 40, "z")]
    assert rows(table.read()) == sorted(expected, key=str)
    # An older version stays as it was; a later update reaches appended rows.
    assert rows(table.read(2))[0] == ("a", "1", 10, "x") and table.read(2).count() == 4
    table.update(frame(table, [("a", 7), ("a", 8)], "name string, value long"), ["name"])
    assert {r.value for r in table.read().where("name = 'a'").collect()} == {8}


def test_edits_by_other_keys_see_what_earlier_ones_set(table):
    table.update(frame(table, [("1", "new")], "week string, note string"), ["week"])
    table.delete(frame(table, [("new",)], "note string"), ["note"])
    assert rows(table.read()) == [("a", "2", 2, "y")]
    table.update(frame(table, [("a", "2", None)], "name string, week string, note string"), ["name", "week"])
    assert rows(table.read()) == [("a", "2", 2, None)]


def test_an_edit_writes_only_what_it_brings(table, spark):
    big = spark.range(200_000).select(F.col("id").cast("string").alias("name"), F.lit("1").alias("week"), "id", F.lit("n").alias("note"))
    table.replace(big.withColumnRenamed("id", "value"))
    number = table.update(frame(table, [("17", -1)], "name string, value long"), ["name"])
    change = table.commit(number).changes[-1]
    assert spark.read.parquet(f"{table.path}/{change.folder}").count() == 1 and change.columns == ["name", "value"]
    assert table.commit(number).base == table.commit(number - 1).base
    assert table.read().where("name = '17'").first().value == -1 and table.read().count() == 200_000


def test_writers_at_once_lose_no_edit(table, spark):
    failures = []

    def write(k):
        try:
            own = VersionedTable(spark, table.path)
            for n in range(3):
                own.append(spark.createDataFrame([(f"w{k}", str(n), n, None)], SCHEMA))
                own.update(spark.createDataFrame([(f"w{k}", f"by {k}")], "name string, note string"), ["name"])
                if k == 0:
                    own.compact()
        except Exception as e:  # noqa: BLE001
            failures.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failures
    found = rows(table.read().where("name LIKE 'w%'"))
    assert found == [(f"w{k}", str(n), n, f"by {k}") for k in range(4) for n in range(3)]
    assert table.versions() == list(range(1, len(table.versions()) + 1)) and len(table.versions()) >= 25
    assert rows(table.read(1)) == rows(table.read().where("name NOT LIKE 'w%' OR name IS NULL"))


def test_one_writer_takes_a_number(spark, tmp_path):
    path, taken = f"{tmp_path}/_commits/1.json", []
    threads = [threading.Thread(target=lambda k=k: taken.append((commit_file(spark, path, f"text {k}" * 1000), k))) for k in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    winners = [k for won, k in taken if won]
    assert len(winners) == 1 and read_file(spark, path) == f"text {winners[0]}" * 1000
    assert folder_names(spark, f"{tmp_path}/_commits") == ["1.json"]


def test_a_failed_write_leaves_the_old_table(table):
    before = rows(table.read())
    broken = table.read().withColumn("value", F.when(F.col("name") == "b", F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        table.replace(broken)
    with pytest.raises(Exception, match="broken"):
        table.append(broken)
    assert table.versions() == [1] and rows(table.read()) == before


def test_a_commit_that_fails_leaves_the_old_table(table, monkeypatch):
    def fails(*args):
        raise OSError("no space")

    monkeypatch.setattr(versions, "commit_file", fails)
    with pytest.raises(OSError):
        table.replace(table.read().limit(1))
    monkeypatch.undo()
    assert table.versions() == [1] and table.read().count() == 4


def test_a_table_is_replaced_by_rows_read_from_it(table):
    old = table.read()
    number = table.replace(old.where("name = 'a'").withColumn("value", F.col("value") + 1), expected=1, partition_by=["week"])
    # A reader that planned on the old version still reads it whole.
    assert number == 2 and old.count() == 4
    assert rows(table.read()) == [("a", "1", 2, "x"), ("a", "2", 3, "y")] and table.read().columns == ["name", "week", "value", "note"]
    with pytest.raises(Conflict):
        table.replace(old, expected=1)
    assert table.read().count() == 2


def test_compaction_keeps_rows_and_later_changes(table, monkeypatch):
    table.update(frame(table, [("a", 10)], "name string, value long"), ["name"])
    before = rows(table.read())
    written = VersionedTable._written

    def interrupted(self, *args, **kwargs):
        folder = written(self, *args, **kwargs)
        if args[1] == "base":
            VersionedTable(self.spark, self.path).append(frame(self, [("late", "1", 0, None)], SCHEMA))
        return folder

    monkeypatch.setattr(VersionedTable, "_written", interrupted)
    assert table.compact(partition_by=["week"]) == 4
    monkeypatch.undo()
    assert [c.kind for c in table.commit().changes] == ["append"]
    assert rows(table.read()) == sorted([*before, ("late", "1", 0, None)], key=str)
    assert table.compact() == 5 and table.compact() is None and table.commit().changes == []
    gone = table.expire(1)
    assert len(gone) == 4 and table.versions() == [5] and rows(table.read()) == sorted([*before, ("late", "1", 0, None)], key=str)


def test_compaction_gives_way_to_a_replacement(table, monkeypatch):
    table.append(frame(table, [("n", "1", 0, None)], SCHEMA))
    read = VersionedTable.read

    def replaced(self, number=None):
        found = read(self, number)
        VersionedTable(self.spark, self.path).replace(frame(self, [("only", "1", 0, None)], SCHEMA))
        return found

    monkeypatch.setattr(VersionedTable, "read", replaced)
    assert table.compact() is None
    monkeypatch.undo()
    assert rows(table.read()) == [("only", "1", 0, None)]


def test_wrong_edits_are_refused(table, tmp_path):
    with pytest.raises(ValueError, match="no such columns: other"):
        table.update(frame(table, [("a", 1)], "name string, other long"), ["name"])
    with pytest.raises(ValueError, match="missing columns"):
        table.append(frame(table, [("a",)], "name string"))
    with pytest.raises(ValueError, match="nothing to set"):
        table.update(frame(table, [("a",)], "name string"), ["name"])
    with pytest.raises(FileNotFoundError):
        VersionedTable(table.spark, str(tmp_path / "none")).read()
    assert table.versions() == [1]


def test_a_filter_on_the_keys_reaches_the_base(table):
    table.update(frame(table, [("a", 10)], "name string, value long"), ["name"])
    plan = table.read().where("name = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(name,a)" in plan
