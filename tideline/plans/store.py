"""Versioned tables without a table format: immutable Parquet directories and an atomically renamed pointer (H1, SK9, SK10, SK11, CT4, CT6).

``root/<schema>/<table>/v-<n>`` holds a version; ``_current`` names what counts: a directory of whole rows and, over it,
levels of changed rows. A batch writes its changes alone; a level goes into the one below once that is less than twice
as large, so a row is written again as often as the logarithm of its table's size, and as many levels are read. Readers
never see half a write. One writer at a time, as one replica has.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see: below spark.checkpoint.dir, or a temporary one in local runs."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tideline-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df kept in the shared folder and read back: its lineage ends there, whatever executors are lost."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Store:
    """Tables below a root that Spark's file systems can reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):  # noqa: ANN202
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _read_text(self, name: str) -> str | None:
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, name: str, text: str) -> None:
        """To a new file, then renamed over the old one in one step."""
        fresh = self._path(f"{name}.{uuid.uuid4().hex}")
        stream = self._fs.create(fresh, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        gateway = self.spark.sparkContext._gateway
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(self._fs.makeQualified(fresh), self._fs.makeQualified(self._path(name)), options)

    def _pointer(self, table: str) -> dict[str, Any] | None:
        text = self._read_text(f"{self.root}/{table.replace('.', '/')}/_current")
        return json.loads(text) if text else None

    def exists(self, table: str) -> bool:
        return self._pointer(table) is not None

    def version(self, table: str) -> int:
        return (self._pointer(table) or {"version": -1})["version"]

    def schema(self, table: str) -> StructType:
        found = self._pointer(table)
        if found is None:
            raise KeyError(f"no table {table}")
        return StructType.fromJson(found["schema"])

    def info(self, table: str) -> dict[str, Any]:
        """What was kept with the table: its key, its coordinate and other metadata."""
        return (self._pointer(table) or {}).get("info", {})

    def read(self, table: str) -> DataFrame:
        found = self._pointer(table)
        if found is None:
            raise KeyError(f"no table {table}")
        base = self.spark.read.schema(StructType.fromJson(found["schema"])).parquet(f"{self._folder(table)}/{found['dir']}")
        if not found.get("levels"):
            return base
        changes = self._changes(table, found, found["levels"])
        keys = changes.select(*(F.col(f"row.`{k}`").alias(k) for k in found["key"]))
        return base.join(keys, found["key"], "left_anti").select(*(F.col(f"`{c}`") for c in base.columns)).unionByName(changes.where("not gone").select("row.*"))

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _changes(self, table: str, found: dict[str, Any], levels: list[dict[str, Any]]) -> DataFrame:
        """row and gone of some levels: the last of each key."""
        kind = StructType([StructField("row", StructType.fromJson(found["schema"])), StructField("gone", BooleanType())])
        frames = [self.spark.read.schema(kind).parquet(f"{self._folder(table)}/{level['dir']}") for level in levels]
        if len(frames) == 1:
            return frames[0]
        whole = reduce(DataFrame.unionByName, (f.withColumn("level", F.lit(i)) for i, f in enumerate(frames)))
        keys = [F.col(f"row.`{k}`").alias(f"k{i}") for i, k in enumerate(found["key"])]
        return whole.groupBy(*keys).agg(F.max_by(F.struct("row", "gone"), "level").alias("last")).select("last.*")

    def append(self, table: str, changes: DataFrame, key: list[str], info: dict[str, Any]) -> None:
        """A version with changed rows over what is there: ``row``, a struct of all columns, and ``gone``; a row for a key at most."""
        found = self._pointer(table)
        if found is None:
            raise KeyError(f"no table {table}")
        made = {"dir": f"v-{found['version'] + 1}-{uuid.uuid4().hex[:8]}"}
        changes.write.parquet(f"{self._folder(table)}/{made['dir']}")
        made["rows"] = self._changes(table, found, [made]).count()
        if "rows" not in found:
            found["rows"] = self.spark.read.parquet(f"{self._folder(table)}/{found['dir']}").count()
        levels = found.get("levels", []) + ([made] if made["rows"] else [])
        self.publish({"table": table} | found | {"version": found["version"] + 1, "key": key, "levels": levels, "info": info})
        self._settle(table)

    def _settle(self, table: str) -> None:
        """Levels that are too alike in size become one; rows and what is kept with the table stay as they are."""
        found = self._pointer(table)
        levels = found["levels"]
        sizes = [found["rows"], *(level["rows"] for level in levels)]
        first, total = len(sizes) - 1, sizes[-1]
        while first and sizes[first - 1] < 2 * total:
            first -= 1
            total += sizes[first]
        if first == len(sizes) - 1:
            return
        if not first:
            self.compact(table)
            return
        number = found["version"] + 1
        merged = {"dir": f"v-{number}-{uuid.uuid4().hex[:8]}"}
        self._changes(table, found, levels[first - 1 :]).write.parquet(f"{self._folder(table)}/{merged['dir']}")
        merged["rows"] = self._changes(table, found, [merged]).count()
        self.publish({"table": table} | found | {"version": number, "levels": [*levels[: first - 1], merged]})

    def stage(self, table: str, rows: DataFrame, info: dict[str, Any] | None = None) -> dict[str, Any]:
        """SK11: a version written but not yet published."""
        number = self.version(table) + 1
        name = f"v-{number}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.root}/{table.replace('.', '/')}/{name}")
        return {"table": table, "version": number, "dir": name, "schema": rows.schema.jsonValue(), "info": info if info is not None else self.info(table)}

    def publish(self, staged: dict[str, Any]) -> None:
        """SK10: the staged version becomes the current one."""
        table = staged["table"]
        self._write_text(f"{self.root}/{table.replace('.', '/')}/_current", json.dumps({k: v for k, v in staged.items() if k != "table"}))

    def note(self, table: str, **values: Any) -> None:
        """Values added to what is kept with the table; its rows stay as they are."""
        found = self._pointer(table)
        if found is not None:
            self.publish({"table": table} | found | {"info": found.get("info", {}) | values})

    def discard(self, staged: dict[str, Any]) -> None:
        self._fs.delete(self._path(f"{self.root}/{staged['table'].replace('.', '/')}/{staged['dir']}"), True)

    def write(self, table: str, rows: DataFrame, info: dict[str, Any] | None = None) -> None:
        self.publish(self.stage(table, rows, info))

    def swap(self, staged: list[dict[str, Any]]) -> None:
        """SK9: all tables of a load, published one after the other once every one of them is written.

        A reader may see some of them before the others; one that fails in between is completed by loading again."""
        for s in staged:
            self.publish(s)

    def drop(self, table: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{table.replace('.', '/')}/_current"), False)
        self._fs.delete(self._path(f"{self.root}/{table.replace('.', '/')}"), True)

    def rename(self, table: str, to: str) -> None:
        self._fs.mkdirs(self._path(f"{self.root}/{to.replace('.', '/')}").getParent())
        self._fs.rename(self._path(f"{self.root}/{table.replace('.', '/')}"), self._path(f"{self.root}/{to.replace('.', '/')}"))

    def rename_schema(self, schema: str, to: str) -> None:
        """CT8: all tables of a schema at once."""
        self._fs.rename(self._path(f"{self.root}/{schema}"), self._path(f"{self.root}/{to}"))

    def tables(self, schema: str) -> list[str]:
        path = self._path(f"{self.root}/{schema}")
        if not self._fs.exists(path):
            return []
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(path) if s.isDirectory())
        return [n for n in names if self.exists(f"{schema}.{n}")]

    def vacuum(self, table: str) -> int:
        """CT4: versions that no longer count are deleted; returns how many."""
        found, path = self._pointer(table), self._path(self._folder(table))
        needed = {found["dir"], *(level["dir"] for level in found.get("levels", []))} if found else set()
        gone = 0
        for s in self._fs.listStatus(path) if found else ():
            name = s.getPath().getName()
            if s.isDirectory() and name.startswith("v-") and name not in needed:
                self._fs.delete(s.getPath(), True)
                gone += 1
        return gone

    def compact(self, table: str) -> None:
        """CT4: a table with its levels rewritten as whole rows."""
        if (self._pointer(table) or {}).get("levels"):
            self.write(table, self.read(table))
