"""Parquet tables whose content is switched as a whole, and a table that takes update-or-insert batches.

Each write goes to a new folder under ``data/``. A small JSON file under ``commits/`` names the folders that make up
the table from then on; it appears by an atomic rename that fails if another writer was faster. A reader uses the
newest commit, so it never sees half a write, and a write that dies before its commit leaves the table as it was.
Every ``KEPT_VERSIONS`` commits the versions older than that many are dropped. A store without atomic rename needs one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions import descending
from tillbook.operators import latest_per_key, merge_rows
from tillbook.schemas import STG_ORDERS
from tillbook.session import scratch_path
from tillbook.sources import files

_SEQUENCE = "_sequence"
_CATALOG = "spark_catalog.default"
_TRACKED = "spark.sql.hive.manageFilesourcePartitions"

# Compacted rows: a folder per compaction and bucket.
_ROWS, _RUN, _PART = "rows", "run", "part"

#: Versions that stay when old ones are dropped: a day of five-minute batches.
KEPT_VERSIONS = 288

#: Most bytes of the Bloom filter of a row group: ten bits a key for 3 million keys.
BLOOM_BYTES = 4 << 20


class VersionedTable:
    """A table replaced by full refresh or extended by appends."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = files.qualified(spark, path)

    def state(self) -> dict[str, Any]:
        """The newest commit; version 0 stands for a table never written."""
        commits = self._commits()
        return self._parsed(commits[-1]) if commits else {"version": 0, "folders": [], "schema": None, "facts": {}}

    def facts(self) -> dict[str, Any]:
        """What the last refresh stated about the content."""
        return self.state()["facts"]

    def overwrite(self, df: DataFrame, facts: dict[str, Any] | None = None) -> None:
        """Replace the content; the old content may be read while doing so."""
        state = self.state()
        self._commit(state, folders=[self._write(df)], schema=df.schema.json(), facts=facts or {})

    def create(self, schema: T.StructType) -> None:
        """Replace the content by an empty table of ``schema``."""
        self.overwrite(self.spark.createDataFrame([], schema))

    def append(self, df: DataFrame) -> None:
        """Add the rows of ``df``, whose columns are matched by name; what was stated about the content lapses."""
        state = self.state()
        if state["schema"] is not None:
            df = df.select(*T.StructType.fromJson(json.loads(state["schema"])).names)
        folders = [*state["folders"], self._write(df)]
        self._commit(state, folders=folders, schema=state["schema"] or df.schema.json(), facts={})

    def read(self, state: dict[str, Any] | None = None) -> DataFrame:
        """The newest content, or that of a state taken before."""
        state = state or self.state()
        if state["schema"] is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._load(state["folders"], T.StructType.fromJson(json.loads(state["schema"])))

    def drop_old_versions(self, keep: int = 1) -> None:
        """Delete all but the newest ``keep`` versions. Who still reads an older one will fail.

        Only folders that an old commit names and no kept commit does are deleted, so a write under way is safe.
        """
        if keep < 1:
            raise ValueError("the newest version stays")
        commits = self._commits()
        old, kept = commits[:-keep], commits[-keep:]
        in_use = {folder for commit in kept for folder in self._folders(self._parsed(commit))}
        for commit in old:
            for folder in self._folders(self._parsed(commit)):
                if folder not in in_use:
                    files.remove(self.spark, f"{self.path}/data/{folder}")
            files.remove(self.spark, f"{self.path}/commits/{commit}")

    def _commits(self) -> list[str]:
        names = files.list_names(self.spark, f"{self.path}/commits")
        return sorted(name for name in names if name.endswith(".json") and not name.startswith("."))

    def _parsed(self, commit: str) -> dict[str, Any]:
        return json.loads(files.read_text(self.spark, f"{self.path}/commits/{commit}"))

    @staticmethod
    def _folders(state: dict[str, Any]) -> list[str]:
        return [*state["folders"], *state.get("batches", [])]

    def _load(self, folders: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{folder}" for folder in folders))

    def _write(self, df: DataFrame, **options: str) -> str:
        folder = uuid.uuid4().hex
        df.write.options(**options).parquet(f"{self.path}/data/{folder}")
        return folder

    def _commit(self, state: dict[str, Any], **changes: Any) -> None:
        after = {**state, **changes, "version": state["version"] + 1}
        files.publish_text(self.spark, f"{self.path}/commits/{after['version']:012d}.json", json.dumps(after))
        if after["version"] % KEPT_VERSIONS == 0:
            self.drop_old_versions(KEPT_VERSIONS)


class MergeTable(VersionedTable):
    """One row per key; a batch overwrites the rows it brings anew and adds the others, whatever their stamps say.

    A batch is written as it is, so its cost follows its own size and not that of the table. Reading lets the newest
    batch of a key win: the batches since the last compaction are reduced to one row per key, and the compacted rows
    of those keys are filtered out. ``compact`` folds the batches in.

    The compacted rows are bucketed and sorted by the key, each bucket in a partition folder of its own, so a compaction
    writes the buckets it touches anew and leaves the others in place. (Overwriting partitions in place would do the same
    with less, but a job that dies between the removal of a partition and the renaming of its new files loses rows, and
    readers can see it without either.) A join on the key shuffles only the other side, so neither reading nor compaction
    moves the large part of the table, and a lookup of one key opens one bucket. A bucket should suit one task, so their
    number is that of the shuffle partitions unless ``buckets`` says otherwise; a new number applies from the next
    compaction on, which writes all rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str = "order_id",
        schema: T.StructType = STG_ORDERS,
        buckets: int | None = None,
    ):
        super().__init__(spark, path)
        self.key = key
        self.schema = schema
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def state(self) -> dict[str, Any]:
        return {"batches": [], "buckets": self.buckets, "feed": None, "last_batch": -1, **super().state()}

    def overwrite(self, df: DataFrame, facts: dict[str, Any] | None = None) -> None:
        """Replace the content by rows with unique keys; batches so far are dropped."""
        state = self.state()
        self._commit(state, batches=[], facts=facts or {}, **self._compacted_to(df))

    def create(self, schema: T.StructType) -> None:
        """Make the table empty, and ready for another feed."""
        self._commit(self.state(), folders=[], batches=[], schema=schema.json(), facts={}, feed=None, last_batch=-1)

    def append(self, df: DataFrame) -> None:
        raise TypeError("use merge: an append could break the one-row-per-key rule")

    def merge(self, df: DataFrame, feed: str | None = None, batch_id: int | None = None) -> bool:
        """Update-or-insert ``df``, which holds one row per key.

        A streaming caller names its feed and batch. A batch that was committed before is left out, and a feed that
        lost its checkpoint (same table, other feed) is refused, because its batch numbers mean something else.
        The first batch of an empty table counts as compacted, since there is nothing it could replace.
        Returns whether the batch was applied.
        """
        state = self.state()
        if feed is not None:
            if state["feed"] not in (None, feed):
                raise RuntimeError(f"{self.path} is fed by {state['feed']}, not by {feed}")
            if batch_id <= state["last_batch"]:
                return False
        if state["folders"] or state["batches"]:
            sequence = F.lit(state["version"]).cast("bigint")
            rows = df.select(*self.schema.names).withColumn(_SEQUENCE, sequence)
            folder = self._write(rows, **self._bloom_filters())
            changes = {"batches": [*state["batches"], folder]}
        else:
            changes = self._compacted_to(df)
        progress = {} if feed is None else {"feed": feed, "last_batch": batch_id}
        self._commit(state, facts={}, **changes, **progress)
        return True

    def read(self, state: dict[str, Any] | None = None) -> DataFrame:
        state = state or self.state()
        compacted = self._compacted(state)
        if not state["batches"]:
            return compacted
        return merge_rows(compacted, self._newest(state), self.key, among=self._batches(state))

    def compact(self) -> None:
        """Fold the batches into the compacted rows; content and feed progress stay as they are.

        Only the buckets that a batch has rows of are read and written; the others keep their files. With the batches
        split like the buckets and a merge join, the old rows are read, filtered and written bucket by bucket.
        """
        state = self.state()
        if not state["batches"]:
            return
        # once, as parquet: the buckets, the keys of the join and the rows to add are each read from it
        path, kept = scratch_path(self.spark, "newest"), []
        self._newest(state).write.parquet(path)
        newest = self.spark.read.schema(self.schema).parquet(path)
        if state["buckets"] == self.buckets:
            touched = {row[0] for row in newest.select(self._part()).distinct().collect()}  # a number per bucket at most
            kept = [folder for folder in state["folders"] if int(folder.rpartition("=")[2]) not in touched]
        old = self._compacted({**state, "folders": [folder for folder in state["folders"] if folder not in kept]})
        merged = merge_rows(old, newest.repartition(self.buckets, self.key).hint("merge"), self.key)
        self._commit(state, batches=[], **self._compacted_to(merged, kept))
        files.remove(self.spark, path)

    def _bloom_filters(self) -> dict[str, str]:
        """Options of a write that let a lookup pass over the row groups of a batch that lack its key.

        A batch is not sorted, so smallest and largest keys tell little. The filter of a row group is as large as its
        distinct keys ask for, up to ``BLOOM_BYTES``.
        """
        return {
            f"parquet.bloom.filter.enabled#{self.key}": "true",
            "parquet.bloom.filter.adaptive.enabled": "true",
            "parquet.bloom.filter.max.bytes": str(BLOOM_BYTES),
        }

    def _part(self) -> Column:
        """The bucket of a row, as bucketed writes number them."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets)).alias(_PART)

    def _batches(self, state: dict[str, Any]) -> DataFrame:
        sequenced = T.StructType([*self.schema.fields, T.StructField(_SEQUENCE, T.LongType())])
        return self._load(state["batches"], sequenced)

    def _newest(self, state: dict[str, Any]) -> DataFrame:
        """One row per key of the batches."""
        batches = self._batches(state)
        if len(state["batches"]) > 1:
            batches = latest_per_key(batches, [self.key], [descending(_SEQUENCE)])
        return batches.drop(_SEQUENCE)

    def _compacted(self, state: dict[str, Any]) -> DataFrame:
        """The folders of all buckets as one bucketed table: those of other runs are pruned as partitions.

        A bucketed read goes through a catalog entry, needed only to resolve the plan; partitions are those of the folders,
        not of the catalog, as it is gone when the plan runs.
        """
        if not state["folders"]:
            return self.spark.createDataFrame([], self.schema)
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in self.schema)
        entry = f"{_CATALOG}.merge_{uuid.uuid4().hex}"
        location = f"{self.path}/data/{_ROWS}".replace("\\", "\\\\").replace("'", "\\'")
        tracked = self.spark.conf.get(_TRACKED)
        self.spark.conf.set(_TRACKED, "false")
        try:
            self.spark.sql(
                f"CREATE TABLE {entry} ({columns}, {_RUN} string, {_PART} int) USING parquet PARTITIONED BY ({_RUN}, {_PART}) "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {state['buckets']} BUCKETS LOCATION '{location}'"
            )
            df = self.spark.table(entry)
            self.spark.sql(f"DROP TABLE {entry}")
        finally:
            self.spark.conf.set(_TRACKED, tracked)
        folder = F.concat(F.lit(f"{_ROWS}/{_RUN}="), _RUN, F.lit(f"/{_PART}="), F.col(_PART).cast("string"))
        return df.filter(folder.isin(state["folders"])).select(*self.schema.names)

    def _compacted_to(self, df: DataFrame, kept: Sequence[str] = ()) -> dict[str, Any]:
        """Write a folder for each bucket ``df`` has rows of, beside those ``kept``; the catalog entry of the write goes."""
        run, entry = f"{_ROWS}/{_RUN}={uuid.uuid4().hex}", f"{_CATALOG}.merge_{uuid.uuid4().hex}"
        rows = df.select(*self.schema.names, self._part()).repartition(self.buckets, self.key)
        # a root of its own: such a write empties its root first
        rows.write.format("parquet").partitionBy(_PART).bucketBy(self.buckets, self.key).sortBy(self.key).option(
            "path", f"{self.path}/data/{run}"
        ).saveAsTable(entry)
        self.spark.sql(f"DROP TABLE {entry}")
        written = files.list_names(self.spark, f"{self.path}/data/{run}")
        folders = [*kept, *(f"{run}/{name}" for name in written if name.startswith(_PART))]
        return {"folders": folders, "buckets": self.buckets, "schema": self.schema.json()}
