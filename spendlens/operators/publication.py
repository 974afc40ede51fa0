"""Joint publication: several tables that readers see change together, by one commit.

Every run writes each output as a new version under the publication's folder; nothing readers see is
overwritten. One small commit file then names the version, and the catalog has a view of each
output that reads the version of the last commit. A run that dies before its commit leaves
every table at the previous run, and a rollback is a further commit that names an older version.

    <root>/data/<output>/RUN_VERSION=<n>/APPLICATION_FAMILY_NAME=<app>/*.parquet
    <root>/commits/<n>.json      one line: commit, version, run date, rows of each output

The view's filter is an equality on the partition column with a scalar subquery, so a reader lists
and scans the one version. Commit files are created exclusively: of two runs that end together one
fails. (A store whose create is not exclusive needs one publisher at a time.)
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.rates import sql_col
from ..session import delete_path, hadoop_path
from .publish import balanced
from .verify import assert_written

VERSION = "RUN_VERSION"
_COMMIT = "commit BIGINT, version BIGINT, run_date STRING, rows MAP<STRING, BIGINT>"


class CommitConflict(Exception):
    """Another run has committed since this one began."""


@dataclass(frozen=True)
class Commit:
    commit: int
    version: int
    run_date: str
    rows: dict[str, int]


@dataclass(frozen=True)
class Output:
    """One table of a publication: its catalog view and the key columns of its rows."""

    view: str
    keys: tuple[str, ...]


class Publication:
    def __init__(self, spark: SparkSession, root: str, outputs: dict[str, Output]):
        self.spark, self.root, self.outputs = spark, root.rstrip("/"), outputs
        if "`" in root:
            raise ValueError("a folder name may not have a backtick")

    # -- layout ------------------------------------------------------------------------------

    def _data(self, name: str) -> str:
        return f"{self.root}/data/{name}"

    def _version(self, name: str, version: int) -> str:
        return f"{self._data(name)}/{VERSION}={version}"

    def _numbers(self, folder: str, pattern: str) -> list[int]:
        fs, path = hadoop_path(self.spark, folder)
        if not fs.exists(path):
            return []
        found = (re.fullmatch(pattern, f.getPath().getName()) for f in fs.listStatus(path))
        return sorted(int(m[1]) for m in found if m)

    def history(self) -> DataFrame:
        """(commit, version, run_date, rows) of every commit. A commit file cut short by a crash is none."""
        folder = f"{self.root}/commits"
        fs, path = hadoop_path(self.spark, folder)
        if not fs.exists(path):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).json(folder).where("commit IS NOT NULL AND version IS NOT NULL")

    def current(self) -> Commit | None:
        last = self.history().orderBy(F.desc("commit")).limit(1).collect()
        return Commit(**last[0].asDict()) if last else None

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """An output's rows of a version, by default the last committed one."""
        if version is None:
            now = self.current()
            if now is None:
                raise ValueError("nothing has been published")
            version = now.version
        return self._typed(self.spark.read.option("basePath", self._version(name, version)).parquet(self._version(name, version)))

    @staticmethod
    def _typed(df: DataFrame) -> DataFrame:
        # Spark guesses the type of a folder's values: a name that looks like a number is still a name
        return df.withColumn(C.APP, F.col(C.APP).cast("string"))

    # -- writing -----------------------------------------------------------------------------

    def publish(self, tables: dict[str, DataFrame], run_date: str) -> Commit:
        """Write a version of every output, verify it against the plan, and commit them together.

        ``tables`` are read twice (written, then verified): hand in relations that are cheap to read again.
        """
        if set(tables) != set(self.outputs):
            raise ValueError(f"a version has {sorted(self.outputs)}, not {sorted(tables)}")
        before = self.current()
        taken = [*self._numbers(f"{self.root}/commits", r"(\d+)\.json"), before.version if before else 0]
        taken += [n for name in self.outputs for n in self._numbers(self._data(name), rf"{VERSION}=(\d+)")]
        version, rows = max(taken) + 1, {}
        for name, df in tables.items():
            if before is not None and dict(self.read(name, before.version).dtypes) != dict(df.dtypes):
                raise ValueError(f"{name}: columns or types differ from the published ones; publish to another folder")
            balanced(df).write.mode("errorifexists").partitionBy(C.APP).parquet(self._version(name, version))
        for name, df in tables.items():
            written = self.read(name, version)
            assert_written(name, df, written, self.outputs[name].keys)
            rows[name] = written.count()
        return self._commit(version, run_date, rows, before)

    def _commit(self, version: int, run_date: str, rows: dict[str, int], before: Commit | None) -> Commit:
        number = max([0, *self._numbers(f"{self.root}/commits", r"(\d+)\.json")]) + 1
        now = self.current()
        if (now and now.commit) != (before and before.commit):
            raise CommitConflict(f"commit {now and now.commit} was made while version {version} was written")
        made = Commit(number, version, run_date, rows)
        fs, path = hadoop_path(self.spark, f"{self.root}/commits/{number:012d}.json")
        try:
            out = fs.create(path, False)
        except Exception as e:
            raise CommitConflict(f"commit {number} exists") from e
        try:
            out.write(bytearray(json.dumps(made.__dict__).encode() + b"\n"))
        finally:
            out.close()
        for name in self.outputs:
            self._view(name)
        return made

    def _view(self, name: str) -> None:
        """The catalog view of an output, made once; which version it shows is the commits' matter."""
        view = self.outputs[name].view
        if self.spark.catalog.tableExists(view):
            return
        names = [sql_col(c) for c in self.read(name).columns if c != C.APP]
        columns = ", ".join([f"CAST({C.APP} AS STRING) AS {C.APP}", *names])
        try:
            self.spark.sql(
                f"CREATE VIEW {view} AS SELECT {columns} FROM parquet.`{self._data(name)}` "
                f"WHERE {VERSION} = (SELECT max_by(version, commit) FROM json.`{self.root}/commits`)"
            )
        except AnalysisException:
            if not self.spark.catalog.tableExists(view):  # made by another run meanwhile
                raise

    def rollback(self, version: int) -> Commit:
        """Show an earlier version again, in all outputs at once."""
        known = self.history().where(F.col("version") == version).orderBy(F.desc("commit")).limit(1).collect()
        if not known:
            raise ValueError(f"version {version} was never committed")
        present = [version in self._numbers(self._data(n), rf"{VERSION}=(\d+)") for n in self.outputs]
        if not all(present):
            raise ValueError(f"version {version} has expired")
        return self._commit(version, known[0].run_date, known[0].rows, self.current())

    def expire(self, keep: int) -> list[int]:
        """Delete all but the ``keep`` last committed versions, those of runs that died included; the current
        one always stays. Versions above it may belong to a run under way and stay too."""
        now = self.current()
        if now is None:
            return []
        last = self.history().groupBy("version").agg(F.max("commit").alias("at")).orderBy(F.desc("at")).limit(max(1, keep))
        kept = {r.version for r in last.collect()}
        found = {n for name in self.outputs for n in self._numbers(self._data(name), rf"{VERSION}=(\d+)")}
        gone = sorted(n for n in found - kept if n < max(kept))
        for name in self.outputs:
            for n in gone:
                delete_path(self.spark, self._version(name, n))
        return gone


def job_publication(spark: SparkSession, root: str, campaign_view: str, channel_view: str) -> Publication:
    """The job's two tables, published together."""
    return Publication(
        spark,
        root,
        {"campaign": Output(campaign_view, C.CAMPAIGN_KEYS), "channel": Output(channel_view, C.KCH)},
    )

