"""Partitioned Parquet tables with upserts.

A table is one folder of Parquet partitions in which every key is there once. An upsert reads the
partitions that its rows fall in, merges, and overwrites just these (dynamic partition overwrite);
nothing else is read or written, and readers need no merge.

Which row of a key counts does not depend on clocks. A write without a version replaces what is
stored. A write with ``writer`` and ``version`` also replaces what is stored, unless that came from
the same writer with a higher version: a stream that repeats an old batch after a crash, or a load
that is run again out of order, changes nothing that its later writes have set.

One driver writes a table at a time; its threads take turns. A write that fails leaves the stored
partitions as they were until Spark commits it. A reader that overlaps a commit may miss a file
that has just been replaced and has to be run again.

Partition columns include ``p``, the period a row's time falls in, and every time bound is
repeated on ``p`` because Catalyst cannot derive it. Beside the table, ``<path>-series`` has a row per
series with its oldest period, so that readers of the newest rows know when to stop.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from threading import RLock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a partition are spread by series over this many tasks and files at most.
SPREAD = 16
# Up to this many touched partitions are named in the path that is listed.
NAMED_PARTITIONS = 500
STORED, INCOMING, NEWER = 0, 1, 2

_LOCKS: defaultdict[str, RLock] = defaultdict(RLock)


@dataclass(frozen=True)
class UpsertTable:
    spark: SparkSession
    path: str

    schema: T.StructType = None
    keys: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    series: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()
    # Of these columns a key keeps the least value it ever had.
    first_values: tuple[str, ...] = ()

    @property
    def values(self) -> list[str]:
        return [name for name in self.schema.names if name not in self.keys]

    @property
    def stored_schema(self) -> T.StructType:
        extra = [
            T.StructField("_w", T.StringType()),
            T.StructField("_v", T.LongType()),
            T.StructField("p", T.DateType()),
        ]
        return T.StructType([*self.schema.fields, *extra])

    @property
    def writing(self) -> RLock:
        """Held by the thread that writes the table."""
        return _LOCKS[self.path.rstrip("/")]

    def period(self) -> Column:
        raise NotImplementedError

    def create(self) -> None:
        """Makes the empty table; an existing one is left alone."""
        self.spark.createDataFrame([], self.stored_schema).write.mode("ignore").partitionBy(
            *self.partitions
        ).parquet(self.path)

    # ---- writing

    def upsert(self, rows: DataFrame, version: int | None = None, writer: str = "") -> None:
        """Inserts or replaces rows, whose keys are unique among themselves."""
        present = set(rows.columns)
        columns = [
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema.fields
        ]
        owner = F.lit(None if version is None else writer).cast("string")
        incoming = rows.select(
            *columns, owner.alias("_w"), F.lit(version).cast("long").alias("_v")
        ).withColumn("p", self.period()).persist()
        try:
            with self.writing:
                touched = incoming.select(*self.partitions).distinct().collect()
                if touched:
                    self._replace(self._merged(self._touched(touched), incoming, version, writer))
                    self._note_series(incoming)
        finally:
            incoming.unpersist()

    def _merged(self, stored: DataFrame, incoming: DataFrame, version: int | None, writer: str) -> DataFrame:
        """One row per key. Rows are shuffled once, by partition and series."""
        rank = F.lit(STORED)
        if version is not None:
            newer = F.col("_w").eqNullSafe(F.lit(writer)) & (F.col("_v") > version)
            rank = F.when(newer, NEWER).otherwise(STORED)
        both = stored.withColumn("_rank", rank).unionByName(incoming.withColumn("_rank", F.lit(INCOMING)))
        keys = list(dict.fromkeys([*self.partitions, *self.keys]))
        values = [name for name in self.stored_schema.names if name not in keys]
        return self._spread(both).groupBy(*keys, "_b").agg(*[
            F.min(c).alias(c) if c in self.first_values else F.max_by(c, "_rank").alias(c) for c in values
        ])

    def _spread(self, rows: DataFrame) -> DataFrame:
        spread = rows.withColumn("_b", F.pmod(F.hash(*self.series), F.lit(SPREAD)))
        return spread.repartition(*self.partitions, "_b")

    def _replace(self, rows: DataFrame) -> None:
        """Overwrites the partitions that the rows fall in. Sorted rows make statistics selective."""
        (
            rows.drop("_b").select(*self.stored_schema.names)
            .sortWithinPartitions(*self.partitions, *self.sort)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partitions).parquet(self.path)
        )

    # ---- reading

    def raw(self, folders: str | None = None) -> DataFrame:
        """Every stored row. ``folders`` is a pattern of partition folders: listing all partitions of
        a long history would take longer than a job that reads its newest ones."""
        return self._parquet(self.path, self.stored_schema, folders)

    def _parquet(self, path: str, schema: T.StructType, folders: str | None = None) -> DataFrame:
        """The rows of a folder, none if there is no such folder yet."""
        reader = self.spark.read.schema(schema).option("basePath", path)
        try:
            return reader.parquet(f"{path}/{folders}" if folders else path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _touched(self, partitions: list) -> DataFrame:
        """The stored rows of these partitions, whose number grows with periods, not with rows."""
        folders, values = None, [[str(row[name]) for row in partitions] for name in self.partitions]
        if len(partitions) <= NAMED_PARTITIONS and all(re.fullmatch(r"[\w.-]+", v) for vs in values for v in vs):
            folders = "/".join(
                f"{name}={{{','.join(sorted(set(found)))}}}"
                for name, found in zip(self.partitions, values, strict=True)
            )
        wanted = {"/".join(row) for row in zip(*values, strict=True)}
        place = F.concat_ws("/", *(F.col(name).cast("string") for name in self.partitions))
        return self.raw(folders).where(place.isin(*wanted))

    def read(self, *conditions: Column, folders: str | None = None) -> DataFrame:
        rows = self.raw(folders)
        for condition in conditions:
            rows = rows.where(condition)
        return rows.select(*self.schema.names)

    # ---- series

    @property
    def series_path(self) -> str:
        return f"{self.path.rstrip('/')}-series"

    def known_series(self) -> DataFrame:
        """The series that the table has or had, each with its ``oldest`` period."""
        return self._parquet(self.series_path, self._series_schema)

    @property
    def _series_schema(self) -> T.StructType:
        return T.StructType([*(self.schema[c] for c in self.series), T.StructField("oldest", T.DateType())])

    def _note_series(self, incoming: DataFrame) -> None:
        """Adds new series and older beginnings, which most writes have none of."""
        known = self.known_series()
        found = incoming.groupBy(*self.series).agg(F.min("p").alias("found"))
        news = found.join(known, list(self.series), "left").where(
            F.col("oldest").isNull() | (F.col("found") < F.col("oldest"))
        )
        added = [tuple(row[name] for name in (*self.series, "found")) for row in news.collect()]
        if not added:
            return
        # A series is a key of the table: one small row for each, however long its history.
        fresh = self.spark.createDataFrame(added, self._series_schema)
        units = {row[0] for row in added}
        kept = known.where(F.col(self.series[0]).isin(*units)).unionByName(fresh)
        (
            kept.groupBy(*self.series).agg(F.min("oldest").alias("oldest")).coalesce(1)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.series[0]).parquet(self.series_path)
        )
