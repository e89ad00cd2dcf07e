"""Snapshots on disk: a version is visible as a whole or not at all.

A version is a manifest below ``published`` with the next free number. It names the files of each
table and the state of the sequences. Manifests appear whole and only where there is none of that
number yet, so of two writers on one base the first gets the number. The second is put on top of
it where it has not touched the same tables, and is refused otherwise.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from reknit.operators.references import ForeignKey, dangling
from reknit.operators.rows import Rewrite, Snapshot
from reknit.operators.sequences import Counter
from reknit.session import hadoop_path

# Tables that are written at the same time.
WRITERS = 4


class ConflictError(RuntimeError):
    """Another writer has changed the same tables since the base version was read."""


class DanglingError(RuntimeError):
    """Rows refer to parents that the version does not have."""


class Published(dict):
    """A snapshot read from a published version, which knows where its tables lie."""

    def __init__(self, tables: Snapshot, root: str, version: str, manifest: dict):
        super().__init__(tables)
        self.root, self.version, self.manifest = root, version, manifest

    @property
    def files(self) -> dict[str, list[str]]:
        """The files of every table, relative to the root."""
        return {name: entry["files"] for name, entry in self.manifest["tables"].items()}

    @property
    def sequences(self) -> dict[str, Counter]:
        return {name: Counter(**state) for name, state in self.manifest["sequences"].items()}


def publish(spark: SparkSession, snapshot: Snapshot, root: str, base: Snapshot | None = None,
            rewrites: Mapping[str, Rewrite] | None = None,
            sequences: Mapping[str, Counter] | None = None,
            references: Iterable[ForeignKey] = (), reads: Iterable[str] = ()) -> str:
    """Write the tables, then publish them as the next version; returns the version.

    Tables that are still the very DataFrames of ``base``, a version read from the same root,
    are not written again, of those in ``rewrites`` only the new rows are, and ``sequences``
    that are not named keep their state. A failure leaves the earlier version current.

    If others have published since ``base`` was read, their tables are taken over, unless they
    have changed one that is changed here or named in ``reads``, or a sequence that is: then
    nothing is published. Without a ``base`` the snapshot replaces whatever is there.
    ``references`` are checked on the tables as written; a dangling one stops the publication.
    """
    root, rewrites = root.rstrip("/"), dict(rewrites or {})
    on_base = isinstance(base, Published) and base.root == root
    entries = {name: base.manifest["tables"][name] for name, table in snapshot.items()
               if name not in rewrites and table is base.get(name)} if on_base else {}
    if rewrites and not on_base:
        raise ValueError("files can be kept of a base version only")
    changed = [name for name in snapshot if name not in entries]
    states = {name: {"last": c.last, "called": c.called} for name, c in (sequences or {}).items()}
    folder = f"versions/{uuid.uuid4().hex}"

    def write(name: str) -> dict:
        rewrite = rewrites.get(name)
        table = rewrite.part if rewrite else snapshot[name]
        table.write.parquet(f"{root}/{folder}/{name}")
        schema = snapshot[name].schema.jsonValue()
        return {"files": [*(rewrite.kept if rewrite else ()),
                          *_data_files(spark, root, f"{folder}/{name}")], "schema": schema}

    first = _number(base.version) if on_base else _newest(published_versions(spark, root))
    with ThreadPoolExecutor(WRITERS) as pool:
        entries.update(zip(changed, pool.map(write, changed)))
    before = base.manifest if on_base else {"tables": {}, "sequences": {}}
    manifest = {"tables": entries, "sequences": {**before["sequences"], **states}}
    number = first + 1
    while True:
        _check(spark, root, manifest, references)
        if _place(spark, root, number, manifest):
            return f"{number:020d}"
        version = published_versions(spark, root)[-1]
        newest = _manifest(spark, root, version)
        if not on_base:
            raise ConflictError(f"{root}: version {version} was published meanwhile")
        clash = sorted(_differing(before, newest, "tables") & {*changed, *reads}
                       | _differing(before, newest, "sequences") & set(states))
        if clash:
            raise ConflictError(f"{root}: version {version} has changed {', '.join(clash)}")
        dropped = set(before["tables"]) - set(entries)
        tables = {name: entry for name, entry in newest["tables"].items() if name not in dropped}
        manifest = {"tables": {**tables, **{name: entries[name] for name in changed}},
                    "sequences": {**newest["sequences"], **states}}
        number = _number(version) + 1


def _newest(versions: list[str]) -> int:
    """The number of the newest version, 0 where there is none."""
    return _number(versions[-1]) if versions else 0


def _number(version: str) -> int:
    return int(version)


def _differing(before: dict, after: dict, part: str) -> set[str]:
    one, other = before[part], after[part]
    return {name for name in {*one, *other} if one.get(name) != other.get(name)}


def _data_files(spark: SparkSession, root: str, folder: str) -> list[str]:
    files, path = hadoop_path(spark, f"{root}/{folder}")
    names = sorted(status.getPath().getName() for status in files.listStatus(path))
    return [f"{folder}/{name}" for name in names if name.startswith("part-")]


def _check(spark: SparkSession, root: str, manifest: dict,
           references: Iterable[ForeignKey]) -> None:
    references = list(references)
    if not references:
        return
    named = {table for key in references for table in (key.child, key.parent)}
    found = dangling({name: _table(spark, root, entry)
                      for name, entry in manifest["tables"].items() if name in named},
                     references).take(5)
    if found:
        raise DanglingError("; ".join(
            f"{row.child}.{row.key} = {row.value} ({row.rows} rows) is not in {row.parent}"
            for row in found))


def _place(spark: SparkSession, root: str, number: int, manifest: dict) -> bool:
    """Let a manifest appear under a number; False if there is one already."""
    files, mark = hadoop_path(spark, f"{root}/published/{number:020d}")
    _, unfinished = hadoop_path(spark, f"{root}/unpublished-{uuid.uuid4().hex}")
    files.mkdirs(mark.getParent())
    stream = files.create(unfinished, False)
    stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    stream.close()
    try:
        if files.getScheme() != "file":
            # Renaming fails where the name is taken.
            return not files.exists(mark) and files.rename(unfinished, mark)
        # On a disk renaming replaces what is there; a second link does not.
        os.link(*(urlparse(files.makeQualified(p).toUri().toString()).path
                  for p in (unfinished, mark)))
        return True
    except FileExistsError:
        return False
    finally:
        files.delete(unfinished, False)


def _manifest(spark: SparkSession, root: str, version: str) -> dict:
    files, path = hadoop_path(spark, f"{root}/published/{version}")
    return json.loads(spark.read.text(path.toString(), wholetext=True).first().value)


def _table(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    schema = StructType.fromJson(entry["schema"])
    if not entry["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{root}/{name}" for name in entry["files"]))


def published_versions(spark: SparkSession, root: str) -> list[str]:
    """The published versions, oldest first."""
    files, folder = hadoop_path(spark, f"{root.rstrip('/')}/published")
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder))


def read_published(spark: SparkSession, root: str, version: str | None = None) -> Published:
    """The tables of a published version, the newest by default."""
    root = root.rstrip("/")
    versions = published_versions(spark, root)
    version = version or (versions[-1] if versions else None)
    if version not in versions:
        raise FileNotFoundError(f"no published version {version or ''} below {root}")
    manifest = _manifest(spark, root, version)
    return Published({name: _table(spark, root, entry)
                      for name, entry in sorted(manifest["tables"].items())},
                     root, version, manifest)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the catalog has the table, for the optional ones."""
    return spark.catalog.tableExists(name)


def snapshot_from_catalog(spark: SparkSession, names: list[str]) -> dict[str, DataFrame]:
    """The named catalog tables that exist."""
    return {name: spark.table(name) for name in names if table_exists(spark, name)}
