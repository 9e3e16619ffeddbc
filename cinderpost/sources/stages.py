"""Reusable written stages: token tables, keyword lists, vocabularies, models, predictions.

A stage lives under a path that holds a fingerprint of everything it was made from, so a changed
option or input never picks up a stale result. Every write is a version of its own: the data go
to a new folder first, then a manifest with the next number names it. Manifests are created
whole and never changed, so readers see a version or they don't; a write that was interrupted
has none. Readers keep the folder that they began with until it expires.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Seconds for which what is no longer the newest version stays, for those who still read it.
GRACE = 24 * 3600.0
_MANIFESTS = "_versions"


def fingerprint(**facts) -> str:
    return hashlib.sha256(json.dumps(facts, sort_keys=True).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Version:
    """One published write of a stage."""

    name: str
    number: int
    facts: dict
    folder: str
    written: float


class StageStore:
    """Parquet tables under one root folder of any store, addressed by name and fingerprint."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---- files ---------------------------------------------------------------------------

    def _at(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _listed(self, path: str) -> list:
        files, place = self._at(path)
        return list(files.listStatus(place)) if files.exists(place) else []

    def _create(self, path: str, text: str) -> bool:
        """Write a small file that must not be there yet; whether it wasn't."""
        files, place = self._at(path)
        try:
            out = files.create(place, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName() or files.exists(place):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _text(self, path: str) -> str:
        files, place = self._at(path)
        stream = files.open(place)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    # ---- versions ------------------------------------------------------------------------

    def path(self, name: str, **facts) -> str:
        """Folder of all versions of a stage."""
        return f"{self.root}/{name}/{fingerprint(**facts)}"

    def _versions(self, folder: str) -> list[Version]:
        """Published versions, oldest first; a manifest that is still being written is none."""
        found = []
        for status in self._listed(f"{folder}/{_MANIFESTS}"):
            try:
                facts = json.loads(self._text(status.getPath().toString()))
            except ValueError:
                continue
            files, mark = self._at(f"{folder}/{facts['data']}/_SUCCESS")
            if files.exists(mark):
                number = int(status.getPath().getName())
                found.append(Version(facts["name"], number, facts["facts"], f"{folder}/{facts['data']}", facts["written"]))
        return sorted(found, key=lambda v: v.number)

    def versions(self, name: str, **facts) -> list[Version]:
        return self._versions(self.path(name, **facts))

    def catalogue(self) -> list[Version]:
        """The newest version of every stage in the store."""
        newest = []
        for kind in self._listed(self.root):
            for stage in self._listed(kind.getPath().toString()):
                newest += self._versions(stage.getPath().toString())[-1:]
        return newest

    def complete(self, name: str, **facts) -> bool:
        """Whether a version of the stage was written to its end and published."""
        return bool(self.versions(name, **facts))

    def load(self, name: str, version: int | None = None, **facts) -> DataFrame:
        """The newest version, or the one with a number."""
        found = [v for v in self.versions(name, **facts) if version in (None, v.number)]
        if not found:
            raise FileNotFoundError(f"stage {name} with {facts} does not exist in {self.root}")
        return self.spark.read.parquet(found[-1].folder)

    def save(self, df: DataFrame, name: str, **facts) -> DataFrame:
        """Write and publish a version; older ones stay for their readers until they expire.

        Of writers at the same time each gets a number; the higher one is the newest.
        """
        folder, data = self.path(name, **facts), f"data-{uuid.uuid4().hex}"
        df.write.parquet(f"{folder}/{data}")
        manifest = {"name": name, "facts": facts, "data": data, "written": time.time()}
        taken = [int(s.getPath().getName()) for s in self._listed(f"{folder}/{_MANIFESTS}")]
        number = max(taken, default=0) + 1
        while not self._create(f"{folder}/{_MANIFESTS}/{number:08d}", json.dumps(manifest)):
            number += 1
        return self.spark.read.parquet(f"{folder}/{data}")

    def reuse(self, name: str, build: Callable[[], DataFrame], **facts) -> DataFrame:
        """The stored stage when it is complete, else the result of ``build`` written first.

        What an interrupted write left behind counts as absent; any failure to read is raised.
        """
        if self.complete(name, **facts):
            return self.load(name, **facts)
        return self.save(build(), name, **facts)

    def expire(self, grace: float = GRACE) -> int:
        """Delete versions that were replaced more than ``grace`` seconds ago, and data that were
        never published and are older than that. Returns the number of folders deleted.
        """
        now, gone = time.time(), 0
        for kind in self._listed(self.root):
            for stage in self._listed(kind.getPath().toString()):
                folder = stage.getPath().toString()
                versions = self._versions(folder)
                # A version is replaced when the next one is published.
                old = [v for v, after in zip(versions, versions[1:]) if now - after.written >= grace]
                kept = {v.folder.rsplit("/", 1)[1] for v in versions if v not in old}
                files, _ = self._at(folder)
                for v in old:
                    files.delete(self._at(f"{folder}/{_MANIFESTS}/{v.number:08d}")[1], False)
                for status in self._listed(folder):
                    own = status.getPath().getName()
                    if not own.startswith("data-") or own in kept:
                        continue
                    replaced = own in {v.folder.rsplit("/", 1)[1] for v in old}
                    if replaced or now - status.getModificationTime() / 1000 >= grace:
                        files.delete(status.getPath(), True)
                        gone += 1
        return gone

    # ---- predictions ---------------------------------------------------------------------

    def save_predictions(self, predictions: DataFrame, model: str) -> None:
        """Add a model's predictions; doing it again replaces them."""
        self.save(predictions.withColumn("model", F.lit(model)), "predictions", model=model)

    def load_predictions(self, model: str | None = None) -> DataFrame:
        """Predictions of one model, or of all that there are."""
        if model is not None:
            return self.load("predictions", model=model)
        folders = [v.folder for v in self.catalogue() if v.name == "predictions"]
        if not folders:
            raise FileNotFoundError(f"no predictions exist in {self.root}")
        return self.spark.read.parquet(*folders)
