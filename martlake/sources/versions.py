"""Sets of tables that are published together, as versions below one folder.

Layout::

    <root>/versions/<version>/<table>/    written first, by any number of jobs
    <root>/manifests/<version>/           one row of JSON, written last

A version exists for readers once its manifest does, and a manifest is one file
that its job commits by renaming it: what a lost driver leaves behind is never
read, and a build that fails its checks publishes nothing. Each build writes to a
folder of its own, so that builds that run together don't touch each other's
files; readers take the version that was published last. Former versions stay
readable until ``expire`` removes them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.sources.folders import children, remove

MANIFEST = "version string, published_at timestamp_ntz, tables array<string>, about map<string, string>"
STAMP = "%Y%m%dT%H%M%S%f"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Versions:
    """The versions below ``root``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def new(self) -> str:
        """The name of a version to be written; names sort by the time they were given."""
        return f"{_now().strftime(STAMP)}-{uuid.uuid4().hex}"

    def folder(self, version: str) -> str:
        return f"{self.root}/versions/{version}"

    def path(self, version: str, table: str) -> str:
        return f"{self.folder(version)}/{table}"

    def publish(self, version: str, tables: list[str], about: dict[str, str] | None = None) -> None:
        """Makes ``version`` the current one; all its tables have to be written by now."""
        row = self.spark.createDataFrame([(version, _now(), list(tables), dict(about or {}))], MANIFEST)
        row.coalesce(1).write.json(f"{self.root}/manifests/{version}")

    def published(self) -> DataFrame:
        """A row for each published version (its manifest)."""
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.root}/manifests/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def current(self):
        """The manifest of the version published last; None where there is none."""
        return self.published().orderBy(F.desc("published_at"), F.desc("version")).first()

    def read(self, manifest, table: str) -> DataFrame:
        if table not in manifest["tables"]:
            raise KeyError(f"{table} is not in version {manifest['version']}")
        return self.spark.read.parquet(self.path(manifest["version"], table))

    def expire(self, keep: int = 2, unpublished_before: dt.datetime | None = None) -> list[str]:
        """Removes all but the last ``keep`` published versions, and returns the names removed.

        With ``unpublished_before`` (UTC) versions that were begun before and never
        published go too. Manifests go first, so that no reader finds a version
        that is being removed; a reader that has begun on it fails.
        """
        if keep < 1:
            raise ValueError("keep must be at least 1")
        order = [F.desc("published_at"), F.desc("version")]
        names = [r["version"] for r in self.published().orderBy(*order).select("version").collect()]  # a row for each version
        gone = names[keep:]
        for version in gone:
            remove(self.spark, f"{self.root}/manifests/{version}")
        if unpublished_before is not None:
            limit = unpublished_before.strftime(STAMP)
            gone = gone + [v for v in children(self.spark, f"{self.root}/versions") if v < limit and v not in names]
        for version in gone:
            remove(self.spark, self.folder(version))
        return gone
