"""Releases: several tables that readers see change by one write, and the expiry of old versions.

Every version of a table is a folder of its own and a partition of the store table
``<layer>_versions.<name>``. A manifest lists which version of each table belongs together; the
table ``releases.current`` holds the manifest in force, and the views that readers use pick the
version that it names. Making a release adds partitions, writes a manifest, and then gives
``releases.current`` another location: that is the one write that changes what readers see, of all
tables at once. Whatever stops a run before it leaves the release before in force, whole.

``releases.history`` keeps all manifests. Versions that no manifest to be kept names, and folders
of runs that never got to a release, are removed by ``expire``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import DESCRIPTIONS
from ledgerloom.sources.layers import quoted

Name = tuple[str, str]
_ENTRY = "manifest string, made_at timestamp, layer string, name string, version string, path string"


class LayoutChanged(ValueError):
    """A column has another type than in the versions before."""


def open_releases(spark: SparkSession, root: str) -> None:
    """The tables of manifests, empty at first."""
    spark.sql("CREATE DATABASE IF NOT EXISTS releases")
    for name in ("current", "history"):
        if not spark.catalog.tableExists(f"releases.{name}"):
            path = _write_entries(spark, root, [])
            columns = ", ".join(f"`{f.split()[0]}` {f.split()[1]}" for f in _ENTRY.split(", "))
            spark.sql(f"CREATE TABLE releases.{name} ({columns}) USING parquet LOCATION '{path}'")


def _write_entries(spark: SparkSession, root: str, rows: list[tuple]) -> str:
    """A few rows, one per table, in one file."""
    path = f"{root.rstrip('/')}/releases/manifest={uuid.uuid4().hex}"
    spark.createDataFrame(rows, _ENTRY).coalesce(1).write.parquet(path)
    return path


def _entries(spark: SparkSession, table: str) -> list[tuple]:
    return [tuple(r) for r in spark.table(f"releases.{table}").collect()]  # one row per table and release


def add_version(spark: SparkSession, layer: str, name: str, path: str) -> str:
    """Make the rows at ``path`` a version in the store; no reader sees it yet."""
    version = path.rsplit("=", 1)[-1]
    store, new = f"{layer}_versions.`{name}`", spark.read.parquet(path).schema
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}_versions")
    if not spark.catalog.tableExists(f"{layer}_versions.{name}"):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(
            f"CREATE TABLE {store} ({columns}, `_version` string) USING parquet PARTITIONED BY (`_version`) "
            f"LOCATION '{path.rsplit('/', 1)[0]}'"
        )
    stored = {f.name: f.dataType for f in spark.table(store).schema}
    if changed := [f.name for f in new if f.name in stored and stored[f.name] != f.dataType]:
        raise LayoutChanged(f"{layer}.{name}: {', '.join(changed)} changed type; publish under another name")
    if added := [f for f in new if f.name not in stored]:
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {store} ADD COLUMNS ({types})")
    spark.sql(f"ALTER TABLE {store} ADD IF NOT EXISTS PARTITION (`_version` = '{version}') LOCATION '{path}'")
    return version


def _show(spark: SparkSession, layer: str, name: str, columns: list[str]) -> None:
    """The view that readers use: the version that the manifest in force names, described."""
    view, comments = f"{layer}.`{name}`", DESCRIPTIONS.get(name, {})
    if spark.catalog.tableExists(f"{layer}.{name}"):
        if spark.catalog.getTable(f"{layer}.{name}").tableType != "VIEW":
            spark.sql(f"DROP TABLE {view}")
        elif spark.table(view).columns == columns:
            return
    described = ", ".join(f"`{c}`" + quoted(comments.get(c)) for c in columns)
    chosen = f"SELECT max(version) FROM releases.current WHERE layer = '{layer}' AND name = '{name}'"
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} ({described}){quoted(comments.get(''))} AS "
        f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {layer}_versions.`{name}` WHERE `_version` = ({chosen})"
    )


def release(
    spark: SparkSession, root: str, tables: Mapping[Name, str], whole_layers: tuple[str, ...] = ()
) -> str:
    """Put the versions at the given paths in force together, by (layer, name); returns the manifest.

    Tables not given stay at their version, but for those of ``whole_layers``, which go.
    """
    open_releases(spark, root)
    for layer in {layer for layer, _ in tables}:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    versions = {key: add_version(spark, *key, path) for key, path in tables.items()}
    columns = {key: spark.read.parquet(path).columns for key, path in tables.items()}
    before = _entries(spark, "current")
    for (layer, name), own in columns.items():
        # A column that goes is shown until the switch, one that comes is NULL until then.
        shown = f"{layer}.{name}"
        view = spark.catalog.tableExists(shown) and spark.catalog.getTable(shown).tableType == "VIEW"
        old = spark.table(f"{layer}.`{name}`").columns if view else []
        _show(spark, layer, name, [*own, *[c for c in old if c not in own]])
    made_at = dt.datetime.now(dt.timezone.utc)
    manifest = f"{made_at:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    kept = [r for r in before if (r[2], r[3]) not in tables and r[2] not in whole_layers]
    gone = [r for r in before if (r[2], r[3]) not in tables and r[2] in whole_layers]
    rows = [(manifest, made_at, *key, versions[key], path) for key, path in tables.items()]
    rows += [(manifest, made_at, *r[2:]) for r in kept]
    _switch(spark, root, "history", [*_entries(spark, "history"), *rows])
    _switch(spark, root, "current", rows)
    for (layer, name), own in columns.items():
        _show(spark, layer, name, own)
    for _, _, layer, name, _, _ in gone:
        spark.sql(f"DROP VIEW IF EXISTS {layer}.`{name}`")
    return manifest


def _switch(spark: SparkSession, root: str, table: str, rows: list[tuple]) -> None:
    path = _write_entries(spark, root, rows)
    spark.sql(f"ALTER TABLE releases.{table} SET LOCATION '{path}'")


def expire(
    spark: SparkSession, root: str, keep_since: dt.datetime, keep_newest: int = 1,
    layers: tuple[str, ...] | None = None,
) -> DataFrame:
    """Remove versions that no kept manifest names; returns every version with ``kept``.

    Kept are the manifest in force, the ``keep_newest`` newest ones and those made at
    ``keep_since`` or later (UTC); ``layers`` leaves the tables of other layers alone. Folders below ``root`` of which no manifest knows go if they were last
    written before ``keep_since``, so a build that is under way keeps its own.
    """
    open_releases(spark, root)
    written = _entries(spark, "history")
    history = [r for r in written if layers is None or r[2] in layers]
    made = sorted({(r[1], r[0]) for r in history}, reverse=True)
    since = _utc(keep_since)
    stay = {m for _, m in made[:keep_newest]} | {m for at, m in made if at.astimezone(dt.timezone.utc) >= since}
    stay |= {r[0] for r in _entries(spark, "current")}
    needed = {r[2:] for r in history if r[0] in stay}
    every = sorted({r[2:] for r in history})
    for layer, name, version, path in every:
        if (layer, name, version, path) not in needed:
            spark.sql(f"ALTER TABLE {layer}_versions.`{name}` DROP IF EXISTS PARTITION (`_version` = '{version}')")
    _switch(spark, root, "history", [r for r in written if r not in history or r[0] in stay])
    for path in {r[3] for r in every} - {r[3] for r in needed}:
        remove_folder(spark, path)
    known = {_bare(r[5]) for r in written}
    lost = [
        path
        for layer in sorted({r[0] for r in every})
        for table in folders(spark, f"{root.rstrip('/')}/{layer}")
        for path in folders(spark, table[0], since)
        if path[1] and _bare(path[0]) not in known
        # A version may be a folder inside: one of the checks that were written together.
        and not any(k.startswith(_bare(path[0]) + "/") for k in known)
    ]
    for path, _ in lost:
        remove_folder(spark, path)
    rows = [(*r, r in needed) for r in every]
    rows += [(*path.rstrip("/").rsplit("/", 3)[1:3], path.rsplit("=", 1)[-1], path, False) for path, _ in lost]
    return spark.createDataFrame(rows, "layer string, name string, version string, path string, kept boolean")


def _utc(time: dt.datetime) -> dt.datetime:
    return time if time.tzinfo else time.replace(tzinfo=dt.timezone.utc)


def _bare(path: str) -> str:
    """A path without its scheme, for comparing."""
    return "/" + path.split(":", 1)[-1].strip("/")


def folders(spark: SparkSession, path: str, before: dt.datetime | None = None) -> list[tuple[str, bool]]:
    """Folders in a folder, and whether they were last changed before a time."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return []
    limit = _utc(before).timestamp() * 1000 if before else float("inf")
    found = [(s.getPath().toString(), s.getModificationTime() < limit) for s in system.listStatus(at) if s.isDirectory()]
    return sorted(found)


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def versions_in_force(spark: SparkSession) -> DataFrame:
    """The manifest in force: a row per table."""
    return spark.table("releases.current").select("layer", "name", "version", F.col("path"))
