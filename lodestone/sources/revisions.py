"""Several tables that change together: each revision is one small file that names the folders of all of them.

A writer starts from a revision, writes new folders beside the old ones, checks what it wants, and then publishes the
next number. Publishing makes a file of that number appear whole or not at all, and only once: if another writer has
published it meanwhile, ``Conflict`` is raised and nothing that was written can be seen. A reader takes one revision and
reads what that names, so it never sees half of a change. What is behind a name is plain Parquet.

A table may be kept in parts (a bucket, a cell, a delta); then a change names only the parts that it replaces or adds.
Publishing needs a file system where a rename or link fails if its target is there: HDFS and local disks are such.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: The part of a table that is kept whole.
WHOLE = "all"


class Conflict(RuntimeError):
    """The revision has moved since the writer read it."""


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/revisions"))

    def head(self) -> int:
        """The newest revision; 0 where there is none."""
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.path}/revisions"))]
        return max([int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()], default=0)

    def manifest(self, revision: int | None = None) -> dict[str, dict]:
        """By table: its schema, and the folder of each part."""
        revision = self.head() if revision is None else revision
        if not revision:
            return {}
        stream = self._fs.open(self._path(self._file(revision)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, table: str, revision: int | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of a table, or of some of its parts; a part that isn't there has none."""
        entry = self.manifest(revision)[table]
        schema = T.StructType.fromJson(entry["schema"])
        folders = [entry["parts"][p] for p in (entry["parts"] if parts is None else parts) if p in entry["parts"]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def change(self, base: int | None = None) -> Change:
        return Change(self, self.head() if base is None else base)

    def sweep(self, keep: int = 2) -> None:
        """Deletes old revisions and what only they name. Not while a writer is at work: what it hasn't published yet
        is named by nobody."""
        head = self.head()
        named = {f.split("/")[1] for r in range(max(1, head - keep + 1), head + 1) for t in self.manifest(r).values() for f in t["parts"].values()}
        for folder in self._fs.listStatus(self._path(f"{self.path}/tables")) if self._fs.exists(self._path(f"{self.path}/tables")) else []:
            if folder.getPath().getName() not in named:
                self._fs.delete(folder.getPath(), True)
        for r in range(1, head - keep + 1):
            self._fs.delete(self._path(self._file(r)), False)

    def _file(self, revision: int) -> str:
        return f"{self.path}/revisions/{revision:012d}.json"

    def _publish(self, revision: int, manifest: dict) -> None:
        jvm = self.spark._jvm
        whole = self._path(f"{self.path}/revisions/_{uuid.uuid4().hex}")
        stream = self._fs.create(whole, False)
        stream.write(bytearray(json.dumps(manifest, ensure_ascii=False), "utf-8"))
        stream.close()
        target = self._path(self._file(revision))
        try:
            if self._fs.getScheme() == "file":
                local = lambda p: jvm.java.nio.file.Paths.get(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
                jvm.java.nio.file.Files.createLink(local(self._fs.makeQualified(target)), local(self._fs.makeQualified(whole)))
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
                never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                context.rename(self._fs.makeQualified(whole), self._fs.makeQualified(target), never)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(f"revision {revision} of {self.path} is there already") from e
            raise
        finally:
            self._fs.delete(whole, False)


class Change:
    """What one writer does to the tables of a revision; nothing can be seen before ``publish``."""

    def __init__(self, store: Store, base: int):
        self.store, self.base = store, base
        self.tables = store.manifest(base)

    def put(self, table: str, rows: DataFrame, part: str = WHOLE, keep: bool = False) -> None:
        """The rows become the table, or, with ``keep``, one part of it beside the others."""
        folder = self._folder()
        rows.write.option("compression", "zstd").parquet(f"{self.store.path}/{folder}")
        old = self.tables[table]["parts"] if keep and table in self.tables else {}
        self.tables[table] = {"schema": rows.schema.jsonValue(), "parts": {**old, part: folder}}

    def put_parts(self, table: str, rows: DataFrame, by: str, replaced: Iterable[str] | None = None) -> None:
        """A part for each value of a column of few values. These replace the parts of ``replaced`` (all parts: None);
        one of these that gets no rows is gone."""
        folder = self._folder()
        rows.write.option("compression", "zstd").partitionBy(by).parquet(f"{self.store.path}/{folder}")
        names = [f.getPath().getName() for f in self.store._fs.listStatus(self.store._path(f"{self.store.path}/{folder}")) if f.isDirectory()]
        new = {n.partition("=")[2]: f"{folder}/{n}" for n in names if n.startswith(f"{by}=")}
        gone = None if replaced is None else set(replaced)
        old = {} if gone is None or table not in self.tables else {p: f for p, f in self.tables[table]["parts"].items() if p not in gone}
        schema = T.StructType([f for f in rows.schema.fields if f.name != by])
        self.tables[table] = {"schema": schema.jsonValue(), "parts": {**old, **new}}

    def staged(self, table: str, parts: Iterable[str] | None = None) -> DataFrame:
        """What the table has with this change, before it is published."""
        entry = self.tables[table]
        schema = T.StructType.fromJson(entry["schema"])
        folders = [f"{self.store.path}/{entry['parts'][p]}" for p in (entry["parts"] if parts is None else parts) if p in entry["parts"]]
        return self.store.spark.read.schema(schema).parquet(*folders) if folders else self.store.spark.createDataFrame([], schema)

    def drop(self, table: str) -> None:
        self.tables.pop(table, None)

    def publish(self) -> int:
        """Makes the change visible as the next revision; raises ``Conflict`` if another one did so first."""
        self.store._publish(self.base + 1, self.tables)
        return self.base + 1

    def _folder(self) -> str:
        return f"tables/{uuid.uuid4().hex}"
