"""Several tables that change together: rows are staged as Parquet, and one manifest makes them the next version.

A version is a file `versions/<number>` that names the folders of each table's rows. It is written elsewhere and renamed to its
number, which fails where that number is there; so of two writers that read the same version one commits and the other is told. A
reader takes the latest number, and sees all of a batch or nothing. What a writer leaves that dies in between is named by no
version, and goes with `clean()`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import TableSpec, violations


class Conflict(Exception):
    """Another batch was committed since the version that this one read."""


@dataclass(frozen=True)
class Upsert:
    """Rows for a table: new keys are added, and known ones replaced, or left as they are if `immutable`, where they must agree."""

    rows: DataFrame
    immutable: bool = False


class TableStore:
    """The tables of `specs` under `root`, a folder of any file system that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str, specs: list[TableSpec]) -> None:
        self.spark, self.root, self.specs = spark, root.rstrip("/"), {s.name: s for s in specs}
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *parts: str):  # noqa: ANN202 - a path of Hadoop
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _files(self):  # noqa: ANN202
        return self._path().getFileSystem(self._conf)

    def _names(self, folder: str) -> list[str]:
        files = self._files()
        return [x.getPath().getName() for x in files.listStatus(self._path(folder))] if files.exists(self._path(folder)) else []

    def version(self) -> int:
        """The latest version; 0 where nothing is there yet."""
        return max((int(x) for x in self._names("versions") if x.isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """Of a version (the latest): for each table its folder, and the number of its rows."""
        version = self.version() if version is None else version
        if version == 0:
            return {"version": 0, "tables": {}}
        stream = self._files().open(self._path("versions", f"{version:012d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of a version (the latest); without rows before its first batch."""
        found = self.manifest(version)["tables"].get(name)
        schema: StructType = self.specs[name].schema
        return self.spark.read.schema(schema).parquet(f"{self.root}/{found['folder']}") if found else self.spark.createDataFrame([], schema)

    def _merged(self, name: str, change: Upsert, version: int) -> DataFrame:
        spec, old, new = self.specs[name], self.read(name, version), change.rows.select(*self.specs[name].schema.names)
        wrong = violations(new, spec).select("reason").limit(1).collect()
        if wrong:
            raise ValueError(f"{name}: {wrong[0].reason}")
        keys = list(spec.key)
        if change.immutable:
            others = [c for c in spec.schema.names if c not in keys]
            theirs = new.select(*keys, F.struct(F.lit(1), *others).alias("_new"))
            ours = old.select(*keys, F.struct(F.lit(1), *others).alias("_old"))
            if not theirs.join(ours, keys).filter(~F.col("_new").eqNullSafe(F.col("_old"))).isEmpty():
                raise ValueError(f"{name}: a row that can't change would")
            return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))
        return old.join(new.select(*keys), keys, "left_anti").unionByName(new)

    def commit(self, read_version: int, batch: dict[str, Upsert], staged: Callable[[str], None] = lambda name: None) -> int:
        """Makes the next version from `read_version` and the batch; all tables change, or none does.

        Refuses null and repeated keys, other columns than the spec's, and changes of immutable rows (ValueError), and a version
        that isn't the latest (Conflict). A table that isn't in the batch keeps its folder. `staged` is called as each table is
        written, for whoever wants to see that happen.
        """
        if self.version() != read_version:
            raise Conflict(f"read {read_version}, the latest is {self.version()}")
        token, tables = uuid.uuid4().hex, dict(self.manifest(read_version)["tables"])
        for name, change in batch.items():
            folder = f"data/{token}/{name}"
            self._merged(name, change, read_version).write.parquet(f"{self.root}/{folder}")
            rows = self.spark.read.schema(self.specs[name].schema).parquet(f"{self.root}/{folder}").count()
            tables[name] = {"folder": folder, "rows": rows}
            staged(name)
        self._publish({"version": read_version + 1, "parent": read_version, "tables": tables}, token)
        return read_version + 1

    def _publish(self, manifest: dict, token: str) -> None:
        files, target = self._files(), self._path("versions", f"{manifest['version']:012d}")
        files.mkdirs(self._path("versions"))
        aside = self._path("staged", token)
        stream = files.create(aside, False)
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(context.makeQualified(aside), context.makeQualified(target), options)
        except Py4JJavaError as failed:
            if "FileAlreadyExists" in failed.java_exception.getClass().getName():
                raise Conflict(f"version {manifest['version']} is there already") from None
            raise

    def clean(self, keep: int = 2) -> list[str]:
        """Removes the batches that none of the `keep` latest versions names, and what never became a version; their tokens.

        Not while another writer is at work, whose batch has no version yet.
        """
        latest = self.version()
        used = {x["folder"].split("/")[1] for v in range(max(1, latest - keep + 1), latest + 1) for x in self.manifest(v)["tables"].values()}
        gone = sorted(x for x in self._names("data") if x not in used)
        for token in gone:
            self._files().delete(self._path("data", token), True)
        for name in self._names("staged"):
            self._files().delete(self._path("staged", name), True)
        for v in range(1, latest - keep + 1):
            self._files().delete(self._path("versions", f"{v:012d}"), False)
        return gone
