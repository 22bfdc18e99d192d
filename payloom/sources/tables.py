"""Warehouse tables as parquet folders behind one commit record.

Every write goes to a folder of its own: ``<table>/version=N`` for a whole table, or
``<table>/load=N`` with a folder per period for a batch of a period table.  What counts is
the newest record in ``_commits``: a small JSON file that names, for every table, its version,
or for every period the load that holds it.  A stage publishes all its tables with one
record, written under another name and renamed, so readers see all of the stage or nothing,
and a stage that dies leaves the old state in place.  Periods that a load does not touch
keep their files.  One writer at a time is assumed; a second one with the same record number
fails at the rename.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from payloom.operators.conform import empty
from payloom.schemas import to_ddl

_COMMITS = "_commits"


@dataclass(frozen=True)
class Staged:
    """A written folder that no record names yet."""

    name: str
    folder: str
    number: int
    periods: tuple[str, ...] | None = None


class Warehouse:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self):
        conf = self.spark._jsc.hadoopConfiguration()
        return self._path(self.root).getFileSystem(conf)

    def _names(self, pattern: str) -> list[str]:
        found = self._fs().globStatus(self._path(f"{self.root}/{pattern}"))
        return sorted(str(status.getPath().getName()) for status in found or [])

    def _next(self, name: str, kind: str) -> int:
        return max((int(n.split("=")[1]) for n in self._names(f"{name}/{kind}=*")), default=0) + 1

    # -- commit records --

    def commits(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names(f"{_COMMITS}/*.json"))

    def state(self, commit: int | None = None) -> dict:
        """What a record says, by default the newest: ``{table: {"version": n}}`` or ``{"periods": {...}}``."""
        known = self.commits()
        if not known:
            return {}
        stream = self._fs().open(self._path(f"{self.root}/{_COMMITS}/{known[-1] if commit is None else commit:08d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, *staged: Staged) -> int:
        """Make staged folders current, all at once, after all writes of a stage have succeeded."""
        state, number = self.state(), max(self.commits(), default=0) + 1
        for s in staged:
            if s.periods is None:
                state[s.name] = {"version": s.number}
            else:
                held = state.setdefault(s.name, {"periods": {}})["periods"]
                held.update(dict.fromkeys(s.periods, s.number))
        fs, text = self._fs(), json.dumps(state, indent=1, sort_keys=True)
        hidden = self._path(f"{self.root}/{_COMMITS}/.{uuid.uuid4().hex}")
        record = self._path(f"{self.root}/{_COMMITS}/{number:08d}.json")
        stream = fs.create(hidden, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if fs.exists(record) or not fs.rename(hidden, record):
            fs.delete(hidden, False)
            raise RuntimeError(f"another writer published {record}")
        return number

    # -- whole tables --

    def exists(self, name: str) -> bool:
        return name in self.state()

    def read(self, name: str, schema: dict[str, str]) -> DataFrame:
        """The published version, or an empty frame of ``schema``."""
        held = self.state().get(name)
        if held is None:
            return empty(self.spark, schema)
        return self.spark.read.parquet(f"{self.root}/{name}/version={held['version']:08d}")

    def stage(self, name: str, df: DataFrame) -> tuple[Staged, DataFrame]:
        """Write an unpublished version; returns it and the stored rows."""
        number = self._next(name, "version")
        folder = f"{self.root}/{name}/version={number:08d}"
        df.write.parquet(folder)
        return Staged(name, folder, number), self.spark.read.parquet(folder)

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Full refresh: stage and publish."""
        staged, stored = self.stage(name, df)
        self.publish(staged)
        return stored

    # -- period tables --

    def has_periods(self, name: str) -> bool:
        return bool(self.state().get(name, {}).get("periods"))

    def _read_loads(self, name: str, loads: dict[str, int], schema: dict[str, str]) -> DataFrame:
        paths = [f"{self.root}/{name}/load={n:08d}/{period}" for period, n in sorted(loads.items())]
        read = self.spark.read.option("basePath", f"{self.root}/{name}").schema(to_ddl(schema))
        return read.parquet(*paths).select(*schema)

    def read_periods(self, name: str, schema: dict[str, str]) -> DataFrame:
        held = self.state().get(name, {}).get("periods")
        return self._read_loads(name, held, schema) if held else empty(self.spark, schema)

    def stage_periods(self, name: str, batch: DataFrame, period: str = "competencia") -> tuple[Staged, DataFrame]:
        """Write a batch as a load that will replace its periods, NULL included, and no others.

        The rebalance hint groups rows by period for few files, and lets adaptive
        execution split a period that holds a large share of the batch.
        """
        number = self._next(name, "load")
        folder = f"{self.root}/{name}/load={number:08d}"
        batch.hint("rebalance", period).write.partitionBy(period).parquet(folder)
        periods = tuple(self._names(f"{name}/load={number:08d}/{period}=*"))
        staged, schema = Staged(name, folder, number, periods), dict(batch.dtypes)
        if not periods:
            return staged, empty(self.spark, schema)
        return staged, self._read_loads(name, dict.fromkeys(periods, number), schema)

    def replace_periods(self, name: str, batch: DataFrame, period: str = "competencia") -> None:
        """Replace the periods that occur in ``batch`` and keep all others."""
        self.publish(self.stage_periods(name, batch, period)[0])

    # -- superseded folders --

    def drop_superseded(self, keep: int = 10) -> list[str]:
        """Delete the folders of published tables that none of the last ``keep`` records names.

        Folders above the highest published number may belong to a running stage and stay.
        """
        known = self.commits()
        kept = [self.state(c) for c in known[-keep:]]
        fs, dropped = self._fs(), []
        for name, held in (self.state() if known else {}).items():
            kind = "load" if "periods" in held else "version"
            used = {
                f"{kind}={n:08d}"
                for state in kept if name in state
                for n in (state[name]["periods"].values() if kind == "load" else [state[name]["version"]])
            }
            for folder in self._names(f"{name}/{kind}=*"):
                if used and folder not in used and folder < max(used):
                    fs.delete(self._path(f"{self.root}/{name}/{folder}"), True)
                    dropped.append(f"{name}/{folder}")
        for c in known[:-keep]:
            fs.delete(self._path(f"{self.root}/{_COMMITS}/{c:08d}.json"), False)
        return dropped
