"""Datasets that readers never see half-written.

A dataset is a folder with versions::

    <root>/data-<id>/part-...      one version's files
    <root>/_versions/<number>.json which folder is the version, with its row count

A write fills a folder of its own and then adds one manifest by a rename that
fails if the number is taken. Until that rename readers find the version before;
after it, the new one. A job that dies leaves at most a folder that no manifest
names. Two writers that finish together take two numbers. The version before
the current one is kept for readers that have begun; ``vacuum`` removes folders
that dead jobs left.

Audit rows are kept a folder a run (``append_once``): the folder appears by one
rename, and a run that is replayed finds it there and adds nothing.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"
KEPT = 2  # the current version and the one before


class Folder:
    """File-system operations of one path, on the Hadoop file system that it names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """Names in a folder; none if there is no such folder."""
        at = self._at(name)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def changed(self, name: str) -> float:
        """When a file or folder last changed, in seconds of the epoch."""
        return self._fs.getFileStatus(self._at(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._at(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def rename_new(self, old: str, new: str) -> bool:
        """Rename in one step; False if ``new`` is there already."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        self._fs.mkdirs(self._at(new).getParent())
        try:
            context.rename(self._at(old), self._at(new), _array(self._jvm, rename.NONE))
        except Py4JJavaError:
            if self._fs.exists(self._at(new)):
                return False
            raise
        return True

    def replace(self, old: str, new: str) -> None:
        """Rename a file over another, in one step where the file system can."""
        if self._at("").toUri().getScheme() in (None, "file") and self._fs.getScheme() == "file":
            source, target = (self._fs.makeQualified(self._at(n)).toUri().getPath() for n in (old, new))
            self._fs.delete(self._at(os.path.join(os.path.dirname(new), f".{os.path.basename(new)}.crc")), False)
            os.replace(source, target)
            return
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        context.rename(self._at(old), self._at(new), _array(self._jvm, rename.OVERWRITE))


def _array(jvm, *items):
    out = jvm.java.lang.reflect.Array.newInstance(items[0].getClass(), len(items))
    for i, x in enumerate(items):
        jvm.java.lang.reflect.Array.set(out, i, x)
    return out


def _numbers(folder: Folder) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in folder.names(VERSIONS) if n.endswith(".json") and n[0] != ".")


def _manifest(number: int) -> str:
    return f"{VERSIONS}/{number:012d}.json"


def publish(spark: SparkSession, root: str, write: Callable[[str], dict]) -> dict:
    """Let ``write`` fill a new folder and make it the current version of
    ``root``. What ``write`` returns goes into the manifest, which is returned."""
    folder = Folder(spark, root)
    name = f"data-{uuid.uuid4().hex}"
    told = write(f"{root}/{name}")
    staged = f"{VERSIONS}/.{name}"
    number = max(_numbers(folder), default=0) + 1
    while True:
        manifest = {**told, "version": number, "folder": name, "written_at": time.time()}
        folder.write(staged, json.dumps(manifest))
        if folder.rename_new(staged, _manifest(number)):
            break
        folder.delete(staged)  # another writer took the number
        number += 1
    for old in _numbers(folder)[:-KEPT]:
        gone = json.loads(folder.read(_manifest(old)))["folder"]
        folder.delete(_manifest(old))  # the manifest first: it never names a folder that is gone
        folder.delete(gone)
    return manifest


def current(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The manifest of the current version, or of ``version``."""
    folder = Folder(spark, root)
    numbers = _numbers(folder)
    if not numbers or (version is not None and version not in numbers):
        raise FileNotFoundError(f"{root} has no version{'' if version is None else f' {version}'}")
    return json.loads(folder.read(_manifest(numbers[-1] if version is None else version)))


def data_path(spark: SparkSession, root: str, version: int | None = None) -> str:
    return f"{root}/{current(spark, root, version)['folder']}"


def read_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of the current version of a Parquet dataset."""
    return spark.read.parquet(data_path(spark, root, version))


def vacuum(spark: SparkSession, root: str, older_than_seconds: float = 86_400) -> list[str]:
    """Remove the folders that no manifest names and that have not changed for a
    while (a running writer's folder changes); returns their names."""
    folder = Folder(spark, root)
    named = {json.loads(folder.read(_manifest(n)))["folder"] for n in _numbers(folder)}
    limit = time.time() - older_than_seconds
    dead = [n for n in folder.names() if n.startswith("data-") and n not in named and folder.changed(n) <= limit]
    for n in dead:
        folder.delete(n)
        folder.delete(f"{VERSIONS}/.{n}")
    return dead


def append_once(spark: SparkSession, root: str, run_id: str, rows: DataFrame) -> bool:
    """Add a run's rows to the table ``root`` (partitioned by run_id), all or
    none; False if the run has rows there already, which stay as they are."""
    folder = Folder(spark, root)
    target = f"run_id={run_id}"
    if target in folder.names():
        return False
    staged = f"_staged-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(f"{root}/{staged}")
        return folder.rename_new(staged, target)
    finally:
        folder.delete(staged)  # only there if the rename was not made
