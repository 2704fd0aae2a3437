"""Tables with a commit log: atomic overwrite, keyed edits that cost what they change, and compaction.

A table is a folder with a base, the changes made since, and a commit file for each version.  A commit names
the base and the changes that make up its version, so the newest commit file is the only pointer:

* data is written first, to a folder of its own; a write that fails leaves files that no commit names;
* a commit is one file that appears whole or not at all, under a number that only one writer can take.  The loser
  reads the winner's commit and puts its change behind it, so that no edit is lost;
* a reader plans on one commit and reads only files that it names, which nobody rewrites.

Appends, updates and deletions write only the rows they bring.  Reading merges them: the latest change of each key is
found by an aggregate and joined to the rows, null keys equal to null.  ``compact`` writes the merged rows as a new
base; changes committed meanwhile stay behind it.

The number is taken by a hard link on a local file system and elsewhere by a rename that refuses an existing target,
as on HDFS; a store whose rename replaces its target is not safe for two writers at once.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.operators.keyed import match_null_safe
from weekcast.sources.files import write_table
from weekcast.sources.schemas import conform
from weekcast.sources.shared import commit_file, drop_folder, folder_names, read_file

APPEND, UPDATE, DELETE = "append", "update", "delete"
ATTEMPTS = 200


class Conflict(RuntimeError):
    """Another writer has changed the table since the version that a write was based on."""


@dataclass(frozen=True)
class Change:
    """Rows of one edit: whole rows to append, or keys with new values, or keys to delete."""

    kind: str
    folder: str
    columns: list[str]
    keys: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Commit:
    """A version: the base and the changes to apply to it, in their order."""

    number: int
    schema: str
    base: str
    changes: list[Change] = field(default_factory=list)

    def text(self) -> str:
        state = {"number": self.number, "schema": self.schema, "base": self.base, "changes": [vars(c) for c in self.changes]}
        return json.dumps(state)

    @classmethod
    def parsed(cls, text: str) -> Commit:
        state = json.loads(text)
        return cls(state["number"], state["schema"], state["base"], [Change(**c) for c in state["changes"]])

    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class VersionedTable:
    """A table in a folder that all executors reach; see the module's description."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # Versions

    def _commit_path(self, number: int) -> str:
        return f"{self.path}/_commits/{number:020d}.json"

    def versions(self) -> list[int]:
        """Numbers of all versions, in ascending order."""
        names = folder_names(self.spark, f"{self.path}/_commits")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def commit(self, number: int | None = None) -> Commit:
        """A version's commit, the newest one by default."""
        if number is None:
            number = max(self.versions(), default=None)
            if number is None:
                raise FileNotFoundError(f"no table in {self.path}")
        return Commit.parsed(read_file(self.spark, self._commit_path(number)))

    def _take(self, commit: Commit) -> bool:
        return commit_file(self.spark, self._commit_path(commit.number), commit.text())

    # Writing

    def _written(self, df: DataFrame, kind: str, **layout) -> str:
        folder = f"{kind}-{uuid.uuid4().hex}"
        write_table(df, f"{self.path}/{folder}", "errorifexists", **layout)
        return folder

    def replace(self, df: DataFrame, expected: int | None = None, **layout) -> int:
        """Make ``df`` the whole table; returns the version's number.

        Readers see the old rows or the new ones, also when ``df`` reads this table.  With ``expected``, the version that
        ``df`` was computed from, a change made by someone else since then is a :class:`Conflict` instead of being overwritten.
        ``layout`` goes to :func:`write_table`.
        """
        folder, schema = self._written(df, "base", **layout), df.schema.json()
        for _ in range(ATTEMPTS):
            last = max(self.versions(), default=0)
            if expected is not None and last != expected:
                raise Conflict(f"version {expected} was expected, {last} is the newest")
            if self._take(Commit(last + 1, schema, folder)):
                return last + 1
        raise Conflict(f"no version number could be taken in {ATTEMPTS} attempts")

    def _changed(self, kind: str, rows: DataFrame, keys: list[str]) -> int:
        folder = self._written(rows, kind)
        change = Change(kind, folder, rows.columns, keys)
        for _ in range(ATTEMPTS):
            head = self.commit()
            if self._take(replace(head, number=head.number + 1, changes=[*head.changes, change])):
                return head.number + 1
        raise Conflict(f"no version number could be taken in {ATTEMPTS} attempts")

    def _some(self, rows: DataFrame, names: list[str]) -> DataFrame:
        schema = self.commit().columns()
        unknown = set(names) - set(schema.fieldNames())
        if unknown:
            raise ValueError(f"no such columns: {', '.join(sorted(unknown))}")
        return conform(rows, T.StructType([f for f in schema if f.name in names]))

    def append(self, rows: DataFrame) -> int:
        """Add rows; duplicates are kept."""
        return self._changed(APPEND, conform(rows, self.commit().columns()), [])

    def update(self, rows: DataFrame, keys: list[str]) -> int:
        """Set the other columns of ``rows`` in every row of the table with the same keys.

        Keys without a row change nothing; of several rows for one key the one with the largest values is taken.
        """
        if set(rows.columns) <= set(keys):
            raise ValueError("nothing to set beside the keys")
        return self._changed(UPDATE, self._some(rows, rows.columns), keys)

    def delete(self, rows: DataFrame, keys: list[str]) -> int:
        """Remove every row of the table whose keys are in ``rows``."""
        return self._changed(DELETE, self._some(rows, keys), keys)

    def compact(self, **layout) -> int | None:
        """Write the merged rows as a new base; None where the base was replaced meanwhile or there is nothing to merge."""
        old = self.commit()
        if not old.changes:
            return None
        folder = self._written(self.read(old.number), "base", **layout)
        for _ in range(ATTEMPTS):
            head = self.commit()
            if head.base != old.base or head.changes[: len(old.changes)] != old.changes:
                return None
            later = head.changes[len(old.changes) :]
            if self._take(Commit(head.number + 1, head.schema, folder, later)):
                return head.number + 1
        raise Conflict(f"no version number could be taken in {ATTEMPTS} attempts")

    def expire(self, keep: int) -> list[str]:
        """Delete the folders that only versions before the newest ``keep`` name; returns their names."""
        numbers = self.versions()
        named = {n: {c.base, *(x.folder for x in c.changes)} for n in numbers if (c := self.commit(n))}
        kept = set().union(*(named[n] for n in numbers[-keep:])) if keep else set()
        gone = sorted(set().union(*named.values()) - kept) if keep else []
        for number in numbers[:-keep] if keep else []:
            drop_folder(self.spark, self._commit_path(number))
        for folder in gone:
            drop_folder(self.spark, f"{self.path}/{folder}")
        return gone

    # Reading

    def _scan(self, folder: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}").select(*schema.fieldNames())

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, the newest one by default, as they are when this is called."""
        commit = self.commit(number)
        schema = commit.columns()
        rows = self._scan(commit.base, schema)
        if not commit.changes:
            return rows
        rows = rows.withColumn("_since", F.lit(0))
        for at, change in enumerate(commit.changes, 1):
            if change.kind == APPEND:
                rows = rows.unionByName(self._scan(change.folder, schema).withColumn("_since", F.lit(at)))
        edits = [(at, c) for at, c in enumerate(commit.changes, 1) if c.kind != APPEND]
        # Neighbours of one kind, with the same keys and columns, are merged by one join.
        for _, alike in groupby(edits, lambda x: (x[1].kind, x[1].keys, x[1].columns)):
            rows = self._merged(rows, list(alike), schema)
        return rows.select(*schema.fieldNames())

    def _merged(self, rows: DataFrame, edits: list[tuple[int, Change]], schema: T.StructType) -> DataFrame:
        """``rows`` after edits that are alike; a row's ``_since`` tells which came before it."""
        change = edits[0][1]
        brought = T.StructType([f for f in schema if f.name in change.columns])
        every = [self._scan(c.folder, brought).withColumn("_at", F.lit(at)) for at, c in edits]
        union = every[0]
        for other in every[1:]:
            union = union.unionByName(other)
        values = [c for c in change.columns if c not in change.keys]
        latest = union.groupBy(*change.keys).agg(F.max(F.struct("_at", *values)).alias("_edit"))
        joined = match_null_safe(rows, latest, change.keys, "left")
        later = F.col("_edit._at") > F.col("_since")
        if change.kind == DELETE:
            return joined.where(~F.coalesce(later, F.lit(False))).drop("_edit")
        new = {c: F.when(later, F.col(f"_edit.{c}")).otherwise(F.col(c)) for c in values}
        return joined.withColumns(new).drop("_edit")
