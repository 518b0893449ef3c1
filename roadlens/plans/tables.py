"""Domain tables derived from the driver tables for one (spark, sf_dir)."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history_partials as HP
from ..operators import lifecycle as L
from ..operators.scan import levels_for
from ..sinks import keyed_table as KT
from ..sinks import writers as W
from ..session import ensure_checkpoint_dir, materialise
from ..sources import driver as D
from ..streaming import vocabulary as V


HOURLY = levels_for("1 hour")


class Tables:
    """Lazily built domain DataFrames; nothing is collected.  Inputs that stand
    for files (text lines, the stored history) are written once to the shared
    folder and read from there.

    Instances are shared per (session, folder), so the registered checks reuse
    already analysed plans instead of re-planning the adapter and lifecycle
    for every query; every action still scans the tables.
    """

    _shared: "weakref.WeakKeyDictionary[SparkSession, dict[str, Tables]]" = weakref.WeakKeyDictionary()

    def __new__(cls, spark: SparkSession, sf_dir: str):
        per_session = cls._shared.setdefault(spark, {})
        inst = per_session.get(sf_dir)
        if inst is None:
            inst = super().__new__(cls)
            inst.spark, inst.sf_dir, inst._raw, inst._files = spark, sf_dir, {}, {}
            per_session[sf_dir] = inst
        return inst

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = D.table(self.spark, self.sf_dir, name)
        return self._raw[name]

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

    @cached_property
    def incidents(self) -> DataFrame:
        return D.incidents(self.events)

    @cached_property
    def positions(self) -> DataFrame:
        return D.positions(self.events)

    @cached_property
    def requests(self) -> DataFrame:
        return D.requests(self.events)

    @cached_property
    def hist_full(self) -> DataFrame:
        return L.incident_lifecycle(self.incidents, self.positions, HOURLY)

    @cached_property
    def hist_traffic(self) -> DataFrame:
        """The stored history table (B3): written once per session and folder,
        read with day folders; the history questions are asked of it."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/history-{uuid.uuid4().hex}"
        W.append_history(L.hist_traffic(self.incidents, self.positions, HOURLY), path, 1)
        return W.read_history(self.spark, path)

    @cached_property
    def hist_partials(self) -> DataFrame:
        """The folded history: three loads of the stored rows, each reduced once."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/partials-{uuid.uuid4().hex}"
        for load in range(3):
            HP.append(self.hist_traffic.where(F.dayofmonth("tod") % 3 == load), path, load)
        return HP.read(self.spark, path)

    @cached_property
    def querylog_table(self) -> str:
        """A keyed table of the query log: three writes, the first two compacted."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/querylog-{uuid.uuid4().hex}"
        rows = D.querylog_events(self.events)
        for load in range(3):
            KT.write_delta(rows.where(F.col("seq") % 3 == load), ["query_type", "ts"], ["seq"], path, load)
            if load == 1:
                KT.compact(self.spark, path, ["query_type", "ts"], ["seq"])
        return path

    @cached_property
    def vocabulary(self) -> str:
        """The words of all documents in four loads, the first two compacted."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/words-{uuid.uuid4().hex}"
        for load in range(4):
            V.add_words(D.text_lines(self.raw("documents").where(F.col("doc_id") % 4 == load)), path, load)
            if load == 1:
                KT.compact(self.spark, path, V.KEYS, V.ORDER)
        return path

    @cached_property
    def lifecycle_state(self) -> DataFrame:
        return materialise(L.lifecycle_state(self.incidents, self.positions, HOURLY), "state")

    def text_file(self, name: str, lines: Callable[[], DataFrame]) -> str:
        """A folder of text lines, written once: the files the loaders read."""
        if name not in self._files:
            path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
            lines().select("value").write.text(path)
            self._files[name] = path
        return self._files[name]

    def table_file(self, name: str, df: Callable[[], DataFrame]) -> str:
        """A Parquet folder, written once: the table a scan reads."""
        if name not in self._files:
            path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
            df().write.parquet(path)
            self._files[name] = path
        return self._files[name]
