"""Published snapshots of a set of tables: build aside, publish in one step, pin, expire.

A build writes files into folders of its own (``<table>/build=<id>/...``) that
nobody reads. Publishing writes a small manifest, which names the folders that
make up each table, and renames it to the next number. The rename fails if that
number is taken, so of two concurrent builders one publishes and the other
starts again from what was published. A reader holds one manifest: whatever is
published meanwhile, its folders stay until the manifest expires by age.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

from ..session import _fs, read_text, write_text

FOLDER = "_snapshots"


class Conflict(RuntimeError):
    """Another builder has published this number."""


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it doesn't exist."""
    fs, p = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) if fs.exists(p) else []


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative paths of the hive partitions ``depth`` levels below ``path``."""
    out = [""]
    for _ in range(depth):
        out = [f"{o}/{s}".lstrip("/") for o in out for s in subfolders(spark, f"{path}/{o}" if o else path) if "=" in s]
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder that no manifest names."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


class Snapshots:
    """The numbered manifests below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, number: int) -> str:
        return f"{self.root}/{FOLDER}/{number:012d}.json"

    def numbers(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.root}/{FOLDER}")
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        return json.loads(read_text(self.spark, self._path(number)))

    def latest(self) -> dict | None:
        have = self.numbers()
        return self.read(have[-1]) if have else None

    def publish(self, manifest: dict, parent: dict | None) -> dict:
        """Makes ``manifest`` the successor of ``parent``; raises ``Conflict`` if there is one already."""
        number = (parent["number"] if parent else 0) + 1
        manifest = manifest | {"number": number, "published": time.time()}
        fs, aside = _fs(self.spark, f"{self.root}/{FOLDER}/.{uuid.uuid4().hex}")
        write_text(self.spark, aside.toString(), json.dumps(manifest))
        jvm = self.spark._jvm
        _, target = _fs(self.spark, self._path(number))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else fs.getUri(),
                                                                     self.spark._jsc.hadoopConfiguration())
        no_overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(aside), fs.makeQualified(target), no_overwrite)
        except Exception as e:
            fs.delete(aside, False)
            if fs.exists(target):
                raise Conflict(f"snapshot {number} is taken") from e
            raise
        return manifest

    def expire(self, older_than_seconds: float, now: float | None = None) -> list[int]:
        """Removes manifests published longer ago than that, but the latest, and builds that no manifest left names.

        A build that isn't published yet is kept as long as a manifest of that age would be.
        """
        limit = (time.time() if now is None else now) - older_than_seconds
        have = self.numbers()
        manifests = {n: self.read(n) for n in have}
        gone = [n for n in have[:-1] if manifests[n]["published"] < limit]
        for n in gone:
            fs, p = _fs(self.spark, self._path(n))
            fs.delete(p, False)
        used = {b for n in have if n not in gone for b in manifests[n]["builds"]}
        fs, top = _fs(self.spark, self.root)
        for t in subfolders(self.spark, self.root):
            for f in subfolders(self.spark, f"{self.root}/{t}") if t != FOLDER else []:
                p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{t}/{f}")
                if f.startswith("build=") and f[6:] not in used and fs.getFileStatus(p).getModificationTime() / 1000 < limit:
                    fs.delete(p, True)
        return gone
