"""Parquet tables with versions: a version is a small manifest that lists what belongs to it.

Every write goes to a load folder of its own, ``data/_load=<id>``, with one folder per partition below it. A
version's manifest names the loads, and of a load of which only a part is still current the partition folders or
single files that are. A table with a key keeps, per load, what its files may hold (``file_index``), so that a merge
finds the files with a key of its batch and leaves the others alone. The manifest is written last, under a new number, so a version appears at once and a write that fails leaves the
table as it was: nothing that a published version reads is changed or deleted before newer versions replace it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.tables import file_index

LOAD = "_load"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name that Spark gives to NULL
#: Versions that stay readable; files that only older ones use are removed after a new one is published.
KEPT_VERSIONS = 3


class Table:
    def __init__(
        self, spark: SparkSession, path: str, partition_by: Sequence[str] = (), kept_versions: int = KEPT_VERSIONS,
        key: Sequence[str] = (),
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)
        self.key = list(key)
        self.kept_versions = max(1, kept_versions)

    # -- file system ---------------------------------------------------------

    def _fs_path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _text(self, path: str) -> str:
        fs, p = self._fs_path(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _names(self, pattern: str) -> list[str]:
        fs, p = self._fs_path(pattern)
        return sorted(f.getPath().getName() for f in (fs.globStatus(p) or []))

    # -- versions ------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n[1:-5]) for n in self._names(f"{self.path}/versions/v*.json")]

    def manifest(self, number: int | None = None) -> dict:
        """``schema`` and ``loads``: load id to its current partition folders or files, None for all of an unpartitioned load."""
        number = self.versions()[-1] if number is None else number
        return json.loads(self._text(f"{self.path}/versions/v{number:09d}.json"))

    def notes(self) -> dict:
        """What writers have noted about the current version, such as the last batch that it holds."""
        return self.manifest().get("notes", {}) if self.exists() else {}

    def _publish(self, schema: T.StructType, loads: dict, notes: dict | None = None) -> None:
        """Makes a version appear. ``notes`` are added to those of the version before."""
        notes = self.notes() | (notes or {})
        number = (self.versions() or [0])[-1] + 1
        fs, at = self._fs_path(f"{self.path}/versions/v{number:09d}.json")
        _, aside = self._fs_path(f"{self.path}/versions/.{uuid.uuid4().hex}")
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps({"schema": schema.jsonValue(), "loads": loads, "notes": notes}).encode()))
        out.close()
        if not fs.rename(aside, at):
            raise RuntimeError(f"version {number} of {self.path} was published by another writer")
        self._expire()

    def _expire(self) -> None:
        """Removes versions beyond the kept ones, then loads that no kept version names. One writer at a time."""
        numbers = self.versions()
        for n in numbers[:-self.kept_versions]:
            fs, p = self._fs_path(f"{self.path}/versions/v{n:09d}.json")
            fs.delete(p, False)
        used = {load for n in numbers[-self.kept_versions:] for load in self.manifest(n)["loads"]}
        for part in ("data", "bounds", "filters"):
            for name in self._names(f"{self.path}/{part}/{LOAD}=*"):
                if name.partition("=")[2] not in used:
                    fs, p = self._fs_path(f"{self.path}/{part}/{name}")
                    fs.delete(p, True)

    # -- reading -------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self.versions())

    def location(self) -> str:
        """The manifest of the current version."""
        return f"{self.path}/versions/v{self.versions()[-1]:09d}.json"

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.manifest()["schema"])

    def _at(self, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        """Rows of loads, folders or files below the data folder, with all their columns."""
        root = f"{self.path}/data"
        whole = T.StructType([*schema, T.StructField(LOAD, T.StringType())])
        return self.spark.read.schema(whole).option("basePath", root).parquet(*[f"{root}/{p}" for p in paths])

    def _read(self, manifest: dict, only: set[tuple] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths, depth = [], len(self.partition_by)
        for load, entries in manifest["loads"].items():
            if entries is None:
                paths.append(f"{LOAD}={load}")
            else:
                paths += [f"{LOAD}={load}/{f}" for f in entries if only is None or folder_values(f, depth) in only]
        return self._at(paths, schema).select(*schema.fieldNames()) if paths else self.spark.createDataFrame([], schema)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of the current version, or of a kept one by its number."""
        return self._read(self.manifest(number))

    # -- files ---------------------------------------------------------------

    def files(self, manifest: dict | None = None) -> dict[str, int]:
        """Current files by their path below the data folder, with their sizes."""
        out, root = {}, f"{self.path}/data"
        for load, entries in (manifest or self.manifest())["loads"].items():
            entries = None if entries is None else set(entries)
            fs, p = self._fs_path(f"{root}/{LOAD}={load}")
            inside, found = f"/data/{LOAD}={load}/", fs.listFiles(p, True)
            while found.hasNext():
                f = found.next()
                name = f.getPath().toUri().getPath().rpartition(inside)[2]
                if name.endswith(".parquet") and (entries is None or name in entries or name.rpartition("/")[0] in entries):
                    out[f"{LOAD}={load}/{name}"] = f.getLen()
        return out

    def of_files(self, files: Sequence[str]) -> DataFrame:
        """Rows of these files alone."""
        schema = self.schema()
        return self._at(sorted(files), schema).select(*schema.fieldNames()) if files else self.spark.createDataFrame([], schema)

    def _with_file(self, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        """Key columns, and the path of each row's file below the data folder."""
        # the path is that of a URL, in which a plus sign is one
        name = F.substring_index(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), f"/data/{LOAD}=", -1)
        return self._at(paths, schema).select(*self.key, F.concat(F.lit(f"{LOAD}="), name).alias(file_index.FILE))

    def _describe(self, load: str, schema: T.StructType) -> None:
        """Writes what the files of a load may hold; reads their key columns."""
        rows = self._with_file([f"{LOAD}={load}"], schema)
        at = f"{self.path}/bounds/{LOAD}={load}"
        file_index.bounds(rows, self.key).coalesce(1).write.parquet(at)
        sizes = self.spark.read.schema(file_index.bounds_schema([schema[k] for k in self.key])).parquet(at)
        file_index.filters(rows, sizes, self.key).write.parquet(f"{self.path}/filters/{LOAD}={load}")

    def files_with(self, batch: DataFrame) -> list[str]:
        """The current files that hold a key of the batch. Loads written without a key are looked through whole."""
        manifest = self.manifest()
        schema, current = T.StructType.fromJson(manifest["schema"]), self.files(manifest)
        batch = batch.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in self.key])
        described = {n.partition("=")[2] for n in self._names(f"{self.path}/filters/{LOAD}=*")}
        loads = sorted(described & set(manifest["loads"]))
        # a file without a row in the bounds has no key at all
        left = {f for f in current if f.partition("/")[0].partition("=")[2] not in described}
        if loads:
            kinds = file_index.bounds_schema([schema[k] for k in self.key])
            found = self.spark.read.schema(kinds).parquet(*[f"{self.path}/bounds/{LOAD}={n}" for n in loads])
            near = {r[0] for r in file_index.may_hold(found, batch, self.key).select(file_index.FILE).collect()} & set(current)
            hashes = file_index.few_hashes(batch, self.key) if near else None
            if hashes is not None:
                held = sorted({f.partition("/")[0] for f in near})
                stored = self.spark.read.schema(file_index.FILTERS).parquet(*[f"{self.path}/filters/{n}" for n in held])
                near &= {r[0] for r in file_index.hit(stored, hashes).collect()}
            left |= near
        if not left:
            return []
        exact = self._with_file(sorted(left), schema).join(batch.distinct(), self.key, "left_semi")
        return sorted(r[0] for r in exact.select(file_index.FILE).distinct().collect())

    def partitions(self, df: DataFrame) -> set[tuple]:
        """The partitions the rows fall in, as the texts of their values; NULL is a partition of its own."""
        texts = [F.col(c).cast("string").alias(c) for c in self.partition_by]
        return {tuple(r) for r in df.select(*texts).distinct().collect()}

    def only(self, touched: set[tuple]) -> DataFrame:
        """Rows of the touched partitions; the folders of the others aren't read."""
        return self._read(self.manifest(), touched)

    def marks(self, column: str) -> list:
        """Values of a partition column, from the manifest alone, typed by the schema; NULL left out."""
        at = self.partition_by.index(column)
        manifest = self.manifest()
        depth = len(self.partition_by)
        texts = {folder_values(f, depth)[at] for entries in manifest["loads"].values() for f in entries or []} - {None}
        if not texts:
            return []
        kind = T.StructType.fromJson(manifest["schema"])[column].dataType
        rows = self.spark.createDataFrame([(t,) for t in sorted(texts)], "v string")
        return [r.v for r in rows.select(F.col("v").cast(kind)).distinct().collect()]

    # -- writing -------------------------------------------------------------

    def _layout(self, df: DataFrame, cluster_by: Sequence[str] = ()) -> DataFrame:
        if cluster_by:
            return df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        if self.partition_by:
            # few files per partition; a partition with a large part of all rows is split by size
            return df.hint("rebalance", *self.partition_by)
        return df

    def _write(self, df: DataFrame, cluster_by: Sequence[str] = ()) -> tuple[str, list[str] | None]:
        """A load that no version names yet, and its partition folders."""
        load = uuid.uuid4().hex
        at = f"{self.path}/data/{LOAD}={load}"
        writer = self._layout(df, cluster_by).write.mode("error")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(at)
        if self.key:
            self._describe(load, df.schema)
        if not self.partition_by:
            return load, None
        fs, p = self._fs_path(at + "/*=*" * len(self.partition_by))
        found = [f.getPath().toUri().getPath() for f in (fs.globStatus(p) or [])]
        depth = len(self.partition_by)
        return load, sorted("/".join(f.split("/")[-depth:]) for f in found)

    def _ordered(self, fields: Sequence[T.StructField]) -> T.StructType:
        by_name = {f.name: f for f in fields}
        return T.StructType([f for f in fields if f.name not in self.partition_by] + [by_name[c] for c in self.partition_by])

    def replace(self, df: DataFrame, cluster_by: Sequence[str] = (), notes: dict | None = None) -> None:
        """A new version with these rows alone. The old one stays readable."""
        schema = self._ordered(df.schema.fields)
        load, folders = self._write(df, cluster_by)
        self._publish(schema, {load: folders}, notes)

    def empty(self, notes: dict | None = None) -> None:
        """A new version without rows."""
        self._publish(self.schema(), {}, notes)

    def replace_files(
        self, df: DataFrame, gone: Sequence[str], cluster_by: Sequence[str] = (), notes: dict | None = None
    ) -> None:
        """A new version with the rows of df in place of the files `gone`; all other files stay as they are.

        The rows may be derived from the files that they replace: those are read before the version appears.
        """
        manifest = self.manifest()
        schema = T.StructType.fromJson(manifest["schema"])
        load, entries = self._write(df.select(*schema.fieldNames()), cluster_by)
        self._publish(schema, self._without(manifest, set(gone)) | {load: entries}, notes)

    def _without(self, manifest: dict, gone: set[str]) -> dict:
        """The loads of a version without some files: a load that loses one is listed by its files from then on."""
        touched = {f.partition("/")[0].partition("=")[2] for f in gone}
        whole = self.files({"loads": {n: e for n, e in manifest["loads"].items() if n in touched}})
        kept: dict = {}
        for load, entries in manifest["loads"].items():
            if load in touched:
                at = f"{LOAD}={load}/"
                entries = sorted(f[len(at):] for f in whole if f.startswith(at) and f not in gone)
            if entries is None or entries:
                kept[load] = entries
        return kept

    def append(self, df: DataFrame, notes: dict | None = None) -> None:
        manifest = self.manifest()
        schema = T.StructType.fromJson(manifest["schema"])
        load, folders = self._write(df.select(*schema.fieldNames()))
        self._publish(schema, manifest["loads"] | {load: folders}, notes)

    def add_columns(self, fields: Sequence[T.StructField]) -> None:
        """New columns need no rewrite: older files read them as NULL."""
        manifest = self.manifest()
        self._publish(self._ordered([*T.StructType.fromJson(manifest["schema"]), *fields]), manifest["loads"])

    def replace_partitions(
        self, df: DataFrame, touched: set[tuple], others: str = "replace", schema: T.StructType | None = None,
        notes: dict | None = None,
    ) -> None:
        """A new version in which the touched partitions hold the rows of df; the others keep their files.

        Rows of df in partitions beside the touched ones replace those, too, or with ``others="append"`` are added to
        them. The rows may be derived from the partitions that they replace. Until the manifest is written the table is
        as before, so repeating the call after a failure gives the same table. ``schema`` brings new columns along.
        """
        manifest = self.manifest()
        schema = self._ordered(schema or T.StructType.fromJson(manifest["schema"]))
        load, folders = self._write(df.select(*schema.fieldNames()))
        depth = len(self.partition_by)
        gone = set(touched) | ({folder_values(f, depth) for f in folders} if others == "replace" else set())
        kept = {old: [f for f in fs if folder_values(f, depth) not in gone] for old, fs in manifest["loads"].items()}
        self._publish(schema, {old: fs for old, fs in kept.items() if fs} | {load: folders}, notes)


def folder_values(entry: str, depth: int) -> tuple:
    """Texts of the partition values in the name of a folder, or of a file in it; NULL for the folder that stands for it."""
    values = [unquote(part.partition("=")[2]) for part in entry.split("/")[:depth]]
    return tuple(None if v == NULL_FOLDER else v for v in values)
