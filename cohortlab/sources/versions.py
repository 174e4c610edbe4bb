"""Tables that are replaced atomically, part by part.

A table is a folder of immutable Parquet versions and small numbered
manifests.  A manifest lists the parts of the table (months, or one part
``all``), the folder, row count and checksum of each, and the schema.  Writing
goes to a new version folder, which is read back and compared with the row
count observed while it was written; only then one new manifest makes it
visible.  Until that moment, and whatever fails before it, readers see the
rows of the manifest before.  A part whose rows are the same as the published
ones keeps its folder, so publishing the same rows again changes nothing.

Two writers at once: the manifest's file is created exclusively, so the second
one fails and its rows stay unpublished.  A manifest that was torn by a crash
is skipped by readers.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = "__part"
#: Name of the only part of a table without parts.
WHOLE = "all"


class VersionedTable:
    """The table below ``path``, a folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jpath = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    # --- manifests -----------------------------------------------------------
    def _numbers(self) -> list[int]:
        folder = self._jpath(f"{self.path}/manifest")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, number: int) -> dict | None:
        stream = self._fs.open(self._jpath(f"{self.path}/manifest/{number:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except json.JSONDecodeError:
            return None  # torn by a crash: never published
        finally:
            stream.close()

    def manifest(self) -> dict:
        """The newest manifest: ``number``, ``schema`` and ``parts``; number 0
        and no parts for a table that was never published."""
        for number in reversed(self._numbers()):
            found = self._load(number)
            if found:
                return found
        return {"number": 0, "schema": None, "parts": {}}

    def _commit(self, schema: str, parts: dict) -> dict:
        number = max(self._numbers(), default=0) + 1
        new = {"number": number, "schema": schema, "parts": parts}
        out = self._fs.create(self._jpath(f"{self.path}/manifest/{number:012d}.json"), False)
        try:
            out.write(bytearray(json.dumps(new, sort_keys=True).encode()))
        finally:
            out.close()
        return new

    def _delete(self, folder: str) -> None:
        self._fs.delete(self._jpath(f"{self.path}/{folder}"), True)

    # --- writing -------------------------------------------------------------
    def publish(self, df: DataFrame, part: Column | None = None, keep_others: bool = False, sources: dict[str, str] | None = None, drop=()) -> list[str]:
        """Replace the table by ``df``; with ``keep_others`` only the parts
        that ``df`` has rows of, and those named in ``drop`` go.  ``part`` is
        a string column (null and characters that don't suit a folder name are
        allowed); without it the table is one part.  ``sources`` notes for a
        part what it was made from.  Returns the parts that changed.

        Parts are periods or the like: their list is collected."""
        name = F.lit(WHOLE) if part is None else F.coalesce(part, F.lit("null"))
        name = F.when(name.rlike("^[A-Za-z0-9_.-]+$"), name).otherwise(F.concat(F.lit("x-"), F.hex(name)))
        version, seen = f"data/{uuid.uuid4().hex}", Observation(f"rows-{uuid.uuid4().hex}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn(_PART, name)
        try:
            counted.hint("rebalance", _PART).write.partitionBy(_PART).parquet(f"{self.path}/{version}")
            new = self._read_back(version, df.schema)
            if sum(p["rows"] for p in new.values()) != seen.get["rows"]:
                raise RuntimeError(f"{self.path}: rows written and rows read back differ; nothing was published")
        except BaseException:
            self._delete(version)
            raise
        old = self.manifest()
        parts = {k: v for k, v in old["parts"].items() if keep_others and k not in drop}
        for key, entry in new.items():
            before = old["parts"].get(key)
            same = before and (before["rows"], before["sum"]) == (entry["rows"], entry["sum"]) and old["schema"] == df.schema.json()
            parts[key] = dict(before if same else entry)
            if sources:
                parts[key]["source"] = sources.get(key)
        changed = sorted(k for k in {*parts, *old["parts"]} if parts.get(k, {}).get("folder") != old["parts"].get(k, {}).get("folder"))
        if changed or parts != old["parts"] or not old["number"]:
            self._commit(df.schema.json(), parts)
        for key, entry in new.items():
            if parts[key]["folder"] != entry["folder"]:
                self._delete(entry["folder"])
        return changed

    def _read_back(self, version: str, schema: T.StructType) -> dict:
        """Rows and an order-independent checksum of each part, from the files."""
        files = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(_PART, T.StringType())]))
        rows = files.option("basePath", f"{self.path}/{version}").parquet(f"{self.path}/{version}")
        total = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in schema.names]).cast("decimal(38,0)"))
        per = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("rows"), total.cast("string").alias("sum"))
        return {r[_PART]: {"folder": f"{version}/{_PART}={r[_PART]}", "rows": r["rows"], "sum": r["sum"]} for r in per.collect()}

    def vacuum(self, keep: int = 1) -> int:
        """Delete versions that none of the last ``keep`` manifests mentions,
        and older manifests; returns the number of folders deleted."""
        numbers = self._numbers()
        kept = [m for m in map(self._load, numbers[-keep:]) if m]
        used = {p["folder"].split("/")[1] for m in kept for p in m["parts"].values()}
        data, gone = self._jpath(f"{self.path}/data"), 0
        for status in self._fs.listStatus(data) if self._fs.exists(data) else ():
            if status.getPath().getName() not in used:
                gone += bool(self._fs.delete(status.getPath(), True))
        for number in numbers[:-keep]:
            self._delete(f"manifest/{number:012d}.json")
        return gone

    # --- reading -------------------------------------------------------------
    def read(self, parts=None) -> DataFrame:
        """The published rows (of the named parts only, if given); a frame that
        was read stays as it is when a newer manifest is published."""
        m = self.manifest()
        if not m["number"]:
            raise FileNotFoundError(f"{self.path}: nothing was published")
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        folders = [f"{self.path}/{e['folder']}" for k, e in sorted(m["parts"].items()) if parts is None or k in parts]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)


def refresh(source: VersionedTable, target: VersionedTable, build, part: Column) -> list[str]:
    """Bring ``target`` up to date with ``source``: the parts of the source
    that are not those which the target was made from are read, passed through
    ``build`` and published; parts that left the source leave the target.
    ``build`` must work part by part (``part`` names the part of a built row
    as the source does).  Returns the parts that were built again; if nothing
    changed, nothing is read."""
    now, done = source.manifest()["parts"], target.manifest()["parts"]
    stale = [k for k, e in now.items() if done.get(k, {}).get("source") != e["folder"]]
    gone = [k for k in done if k not in now]
    if stale or gone or not target.manifest()["number"]:
        target.publish(build(source.read(stale)), part, keep_others=True, sources={k: now[k]["folder"] for k in stale} | {k: done[k].get("source") for k in done if k not in stale}, drop=[*gone, *stale])
    return sorted(stale)
