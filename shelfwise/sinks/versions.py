"""Versions of layer tables, published by one manifest file.

A build writes its tables to a folder of its own and then adds one small
manifest that names them all. The newest whole manifest is the current version, so a
build becomes visible in one step or, if it fails, not at all. Readers
resolve the manifest once and go on with the folders it names, which no later
build touches. ``expire`` removes folders that the last versions don't name.

Files are written through Hadoop's file system interface, so any store that
Spark writes to will do.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

#: Manifests that stay when a new one is published.
KEPT_MANIFESTS = 20


class VersionConflict(RuntimeError):
    """Another build has published since the version that this one was made from."""


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _path(spark, path)
    return fs.exists(at)


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, at = _path(spark, path)
    fs.delete(at, True)


def move_folder(spark: SparkSession, staged: str, target: str) -> bool:
    """Put a finished folder in its place in one step; False (and the staged one goes) if the place is taken."""
    fs, at = _path(spark, target)
    source = _path(spark, staged)[1]
    if fs.exists(at):
        fs.delete(source, True)
        return False
    fs.mkdirs(at.getParent())
    if not fs.rename(source, at):
        raise RuntimeError(f"cannot move {staged} to {target}")
    return True


def _create(spark: SparkSession, path: str, text: str) -> None:
    """A new file; an existing one is an error."""
    fs, at = _path(spark, path)
    out = fs.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _text(spark: SparkSession, path: str) -> str:
    fs, at = _path(spark, path)
    data = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()


@dataclass(frozen=True)
class Manifest:
    version: int
    tables: dict[str, str] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)


class VersionedLayers:
    """The versions of the tables under ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    @property
    def _manifests(self) -> str:
        return f"{self.base}/_manifests"

    def new_folder(self) -> str:
        """An unused folder for the tables of a build."""
        return f"{self.base}/versions/{uuid.uuid4().hex}"

    def _numbers(self) -> list[int]:
        fs, at = _path(self.spark, self._manifests)
        if not fs.exists(at):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(at)]
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d{12})\.json", n)))

    def _load(self, number: int) -> Manifest | None:
        try:
            found = json.loads(_text(self.spark, f"{self._manifests}/{number:012d}.json"))
        except ValueError:
            return None  # its writer has not finished it
        return Manifest(found["version"], found["tables"], found["facts"])

    def current(self) -> Manifest | None:
        """The newest whole manifest; None before the first."""
        for number in reversed(self._numbers()):
            if (found := self._load(number)) is not None:
                return found
        return None

    def publish(self, tables: dict[str, str], facts: dict | None = None, after: int | None = None) -> Manifest:
        """Make ``tables`` (name to folder) the current version, in one step.

        With ``after``, only if that is still the newest version (0: none yet).
        """
        numbers = self._numbers()
        newest = numbers[-1] if numbers else 0
        if after is not None and newest != after:
            raise VersionConflict(f"version {newest} came after {after}")
        made = Manifest(newest + 1, dict(tables), dict(facts or {}))
        text = json.dumps({"version": made.version, "tables": made.tables, "facts": made.facts})
        try:
            _create(self.spark, f"{self._manifests}/{made.version:012d}.json", text)
        except Exception as error:
            if exists(self.spark, f"{self._manifests}/{made.version:012d}.json"):
                raise VersionConflict(f"version {made.version} was published meanwhile") from error
            raise
        fs, _ = _path(self.spark, self._manifests)
        for old in numbers[: -KEPT_MANIFESTS]:
            fs.delete(_path(self.spark, f"{self._manifests}/{old:012d}.json")[1], False)
        return made

    def open(self, manifest: Manifest | None = None) -> dict[str, DataFrame]:
        """The tables of a version (the current one); they stay readable while newer ones are published."""
        manifest = manifest or self.current()
        return {} if manifest is None else {name: self.spark.read.parquet(p) for name, p in manifest.tables.items()}

    def expire(self, keep: int = 2) -> list[str]:
        """Delete build folders that none of the last ``keep`` versions names; returns them."""
        fs, at = _path(self.spark, f"{self.base}/versions")
        whole = [m for m in map(self._load, self._numbers()[-keep:]) if m is not None]
        named = " ".join(p for m in whole for p in m.tables.values())
        gone = []
        for folder in fs.listStatus(at) if fs.exists(at) and whole else []:
            if folder.getPath().getName() not in named:
                fs.delete(folder.getPath(), True)
                gone.append(folder.getPath().toString())
        return gone
