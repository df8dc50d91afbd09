"""Tables as partitioned Parquet folders, with a log that names the folders in use.

Every write goes to a new folder ``v=<version>``; a table has the new rows only once the next entry of
its log is there, which names for every partition the versions that hold it. A run that breaks off
before that leaves the table as it was, and a plan that reads a table may be written to the same
table. Two runs that write one table at a time cannot both make the next entry: the later one is an
error, and nothing of it is seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators.upsert import upsert_rows

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name of a NULL
OLD_ENTRIES = 1


class ConcurrentWrite(RuntimeError):
    """Another run has written the table in the meantime."""


@dataclass(frozen=True)
class Version:
    """Rows that are written but not yet in use; ``counts`` were taken while they were written."""

    table: str
    name: str
    partitions: tuple[str, ...]
    counts: dict


def _values(partition: str) -> tuple[str | None, ...]:
    """``batch_id=a%3Ab/kind=x`` as its values."""
    names = (p.split("=", 1)[1] for p in partition.split("/"))
    return tuple(None if n == NO_VALUE else unquote(n) for n in names)


@dataclass(frozen=True)
class Tables:
    """The tables below one root folder. A table that does not exist yet reads as empty."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    # ---- log ----

    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _names(self, path: str) -> list[str]:
        system, place = self._files(path)
        if not system.exists(place):
            return []
        names = (s.getPath().getName() for s in system.listStatus(place))
        return sorted(n for n in names if not n.startswith((".", "_SUCCESS")))

    def _entries(self, name: str) -> list[int]:
        names = self._names(f"{self.path(name)}/_log")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def _entry(self, name: str, number: int) -> dict[str, list[str]]:
        system, place = self._files(f"{self.path(name)}/_log/{number:010d}.json")
        stream = system.open(place)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(text)

    def state(self, name: str) -> dict[str, list[str]]:
        """The versions in use by partition."""
        entries = self._entries(name)
        return self._entry(name, entries[-1]) if entries else {}

    def _commit(self, name: str, number: int, state: dict[str, list[str]]) -> None:
        folder = f"{self.path(name)}/_log"
        system, draft = self._files(f"{folder}/.{uuid.uuid4().hex}")
        _, entry = self._files(f"{folder}/{number:010d}.json")
        stream = system.create(draft, False)
        stream.write(bytearray(json.dumps(state, ensure_ascii=False).encode()))
        stream.close()
        if system.exists(entry) or not system.rename(draft, entry):
            system.delete(draft, False)
            raise ConcurrentWrite(f"another run has written {name}; run this step again")

    # ---- reads ----

    def _found(self, state: dict[str, list[str]], name: str, schema: T.StructType) -> DataFrame:
        root = self.path(name)
        paths = [f"{root}/v={v}/{p}" for p, versions in sorted(state.items()) for v in versions]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", root).parquet(*paths)
        return rows.select(*schema.fieldNames())

    def _state_of(self, name: str, only: Callable[..., bool] | None, versions: Iterable[str] | None = None):
        state = self.state(name)
        if only is not None:
            state = {p: vs for p, vs in state.items() if only(*_values(p))}
        if versions is not None:
            wanted = set(versions)
            state = {p: [v for v in vs if v in wanted] for p, vs in state.items()}
        return state

    def read(
        self, name: str, schema: T.StructType, only: Callable[..., bool] | None = None,
        versions: Iterable[str] | None = None,
    ) -> DataFrame:
        """Rows in use. ``only`` gets the values of a partition and says whether it is read;
        ``versions`` leaves out all others."""
        return self._found(self._state_of(name, only, versions), name, schema)

    def rows_of(self, version: Version, schema: T.StructType) -> DataFrame:
        """The rows of a version, in use or not."""
        return self._found({p: [version.name] for p in version.partitions}, version.table, schema)

    def partitions(self, name: str) -> list[tuple[str | None, ...]]:
        return sorted((_values(p) for p in self.state(name)), key=str)

    def versions(self, name: str, *values: str) -> list[str]:
        """What a partition is made of, oldest first; it changes with every write to it."""
        return [v for p, vs in self.state(name).items() if _values(p) == values for v in vs]

    def versions_with(
        self, name: str, schema: T.StructType, keys: DataFrame, only: Callable[..., bool] | None = None
    ) -> list[str]:
        """The versions that hold a row whose columns are in ``keys``; only these columns are read."""
        path = F.regexp_extract("_metadata.file_path", r"/v=([0-9a-f]{32})/", 1)
        root = self.path(name)
        state = self._state_of(name, only)
        paths = [f"{root}/v={v}/{p}" for p, versions in sorted(state.items()) for v in versions]
        if not paths:
            return []
        rows = self.spark.read.schema(schema).option("basePath", root).parquet(*paths)
        found = rows.select(*keys.columns, path.alias("_version")).distinct()
        return [r[0] for r in found.join(keys, keys.columns, "left_semi").select("_version").distinct().collect()]

    # ---- writes ----

    def write(self, df: DataFrame, name: str, by: str | list[str], **counts: Column) -> Version:
        """Write rows to a new folder; ``publish`` puts them to use. ``counts`` are aggregates over
        the rows, taken while they are written."""
        by = [by] if isinstance(by, str) else by
        version = uuid.uuid4().hex
        folder = f"{self.path(name)}/v={version}"
        seen = Observation()
        counts = {"rows": F.count(F.lit(1)), **counts}
        counted = df.observe(seen, *[c.alias(k) for k, c in counts.items()])
        counted.write.partitionBy(*by).parquet(folder)
        parts = [""]
        for _ in by:
            parts = [f"{p}/{n}".lstrip("/") for p in parts for n in self._names(f"{folder}/{p}")]
        found = dict(seen.get) if parts else {}
        return Version(name, version, tuple(parts), {"rows": 0, **found})

    def publish(
        self, *versions: Version, replace: bool = False,
        gone: Callable[..., bool] | None = None, old: Iterable[str] = (), table: str | None = None,
    ) -> None:
        """One log entry for versions of one table. With ``replace`` they take the place of the
        partitions that they have rows for; ``gone`` says of which others the rows go, and the versions
        ``old`` go from all partitions."""
        name = table or versions[0].table
        entries = self._entries(name)
        state = dict(self._entry(name, entries[-1])) if entries else {}
        if gone is not None:
            state = {p: v for p, v in state.items() if not gone(*_values(p))}
        if replace:
            for part in {p for v in versions for p in v.partitions}:
                state.pop(part, None)
        old = set(old)
        if old:
            left = {p: [v for v in vs if v not in old] for p, vs in state.items()}
            state = {p: vs for p, vs in left.items() if vs}
        for version in versions:
            for part in version.partitions:
                state[part] = [*state.get(part, ()), version.name]
        self._commit(name, entries[-1] + 1 if entries else 0, state)

    def append(self, df: DataFrame, name: str, by: str | list[str], **counts: Column) -> dict:
        version = self.write(df, name, by, **counts)
        self.publish(version)
        return version.counts

    def replace_partitions(
        self, df: DataFrame, name: str, by: str | list[str], **counts: Column
    ) -> dict:
        """Replace the partitions that ``df`` has rows for, others stay. ``df`` may read the table."""
        version = self.write(df, name, by, **counts)
        self.publish(version, replace=True)
        return version.counts

    def empty_partition(self, name: str, *values: str) -> None:
        """Take all rows out of a partition."""
        if values in self.partitions(name):
            self.publish(table=name, gone=lambda *found: found == values)

    def upsert(
        self, df: DataFrame, name: str, schema: T.StructType, keys: list[str],
        by: str = "batch_id", touched: set | None = None,
    ) -> None:
        """Insert or update rows of a control table by key; only touched partitions change.
        ``touched`` are their values, if they are known."""
        if touched is None:
            touched = {r[0] for r in df.select(by).distinct().toLocalIterator()}
        existing = self.read(name, schema, only=lambda value: value in touched)
        self.replace_partitions(upsert_rows(existing, df, keys), name, by)

    def remove_old(self, names: Iterable[str], keep: int = OLD_ENTRIES) -> None:
        """Remove versions that neither the current log entry nor the ``keep`` before it name.

        Only what was in use once is removed: folders of a run that is still writing stay.
        """
        for name in names:
            entries = self._entries(name)
            old, kept = entries[: -keep - 1], entries[-keep - 1 :]
            used = {(p, v) for e in kept for p, vs in self._entry(name, e).items() for v in vs}
            for number in old:
                for part, versions in self._entry(name, number).items():
                    for version in versions:
                        if (part, version) not in used:
                            system, place = self._files(f"{self.path(name)}/v={version}/{part}")
                            system.delete(place, True)
                system, place = self._files(f"{self.path(name)}/_log/{number:010d}.json")
                system.delete(place, False)
