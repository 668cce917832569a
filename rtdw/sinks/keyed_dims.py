"""Dimension tables in buckets of their key: a change rewrites its buckets, a lookup reads them.

A table is a folder of Parquet files by bucket, each sorted by key, so that the files' own
statistics lead to a key within its bucket. A version is a small manifest that names one
folder for each bucket; versions share the folders that did not change. A manifest appears
as a whole and the first one of a batch stands, so a batch that fails is not seen and a
repeated one is not applied again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rtdw.operators.cdc import drop_deletes
from rtdw.session import fresh_dir, listed_paths, publish_text, remove_dir
from rtdw.sinks.dims import DEFAULT_PK

BUCKETS = 64
#: Per column, the ``seq`` of the change that set it; the map lies beside the columns.
SEQS = "__seqs"


class KeyedDimension:
    """One dimension table of text columns below ``root``.

    ``buckets`` holds for a new table only; an existing one keeps its own number. Choose it
    so that a bucket is a few hundred megabytes. A change sets the columns that its ``after``
    image names, unless a change of higher ``seq`` has set them, also in an earlier batch.
    Deletes are left out, as everywhere in the dimension layer, and so are rows without key.
    Columns of the stored table that are not among ``columns`` stay as they are.
    """

    def __init__(
        self, spark: SparkSession, root: str, columns: Iterable[str], pk: str = DEFAULT_PK,
        buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.root, self.pk = spark, root.rstrip("/"), pk
        self.columns = [c for c in columns if c != pk]
        self._buckets = buckets

    # Versions

    def _manifests(self) -> dict[int, str]:
        paths = listed_paths(self.spark, f"{self.root}/_manifest/batch=*.json")
        return {int(path.rpartition("=")[2].removesuffix(".json")): path for path in paths}

    def version(self) -> dict:
        """The newest manifest: its number of buckets and the folder of each bucket."""
        manifests = self._manifests()
        if not manifests:
            return self._first_version()
        return self._manifest(manifests[max(manifests)])

    def _first_version(self) -> dict:
        return {"buckets": self._buckets, "columns": self.columns, "folders": {}}

    def _manifest(self, path: str) -> dict:
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])

    def _bucket(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")

    def _rows(self, folders: Iterable[str], columns: list[str] | None = None) -> DataFrame:
        fields = ", ".join(f"`{c}` string" for c in [self.pk, *(columns or self.columns)])
        schema = f"{fields}, `{SEQS}` map<string,bigint>"
        paths = [f"{self.root}/{folder}" for folder in sorted(folders)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # Reading

    def read(self) -> DataFrame:
        """All rows of the newest version."""
        return self._rows(self.version()["folders"].values()).select(self.pk, *self.columns)

    def lookup(self, keys: DataFrame, key: str) -> DataFrame:
        """The rows whose key is among the values of ``keys``; other buckets are not read.

        The driver sees bucket numbers only, at most as many as the table has.
        """
        version = self.version()
        bucket = self._bucket(F.col(key), version["buckets"])
        hit = [row[0] for row in keys.select(bucket).where(F.col(key).isNotNull()).distinct().collect()]
        folders = version["folders"]
        rows = self._rows(folders[str(b)] for b in hit if str(b) in folders)
        wanted = keys.select(F.col(key).cast("string").alias(self.pk))
        return rows.join(wanted, self.pk, "left_semi").select(self.pk, *self.columns)

    def lookup_one(self, value: str) -> DataFrame:
        """The row of one key, read from one bucket with the key pushed down to its files."""
        version = self.version()
        bucket = self.spark.range(1).select(self._bucket(F.lit(value), version["buckets"])).first()[0]
        folder = version["folders"].get(str(bucket))
        rows = self._rows([folder] if folder else [])
        return rows.where(F.col(self.pk) == value).select(self.pk, *self.columns)

    # Writing

    def load(self, rows: DataFrame, batch_id: int = -1) -> bool:
        """Make the first version from stored rows with different keys; any change wins over them."""
        empty = F.expr("cast(map() as map<string,bigint>)")
        text = [F.col(c).cast("string").alias(c) for c in [self.pk, *self.columns]]
        keyed = rows.where(F.col(self.pk).isNotNull()).select(*text, empty.alias(SEQS))
        return self._write(keyed, batch_id, self._first_version())

    def apply(self, changes: DataFrame, batch_id: int) -> bool:
        """Apply one batch of ``after``, ``type``, ``seq``; false if it was applied before.

        ``batch_id`` grows from batch to batch. Only the buckets of changed keys are read and
        written; the driver sees their numbers.
        """
        if batch_id in self._manifests():
            return False
        version = self.version()
        columns = list(dict.fromkeys([*version["columns"], *self.columns]))
        # Written, as three jobs read it.
        newest = self._changed(changes, columns)
        path = fresh_dir(self.spark, "keyed-changes")
        newest.write.parquet(path)
        changed = self.spark.read.schema(newest.schema).parquet(path)
        bucket = self._bucket(F.col(self.pk), version["buckets"])
        touched = [str(row[0]) for row in changed.select(bucket).distinct().collect()]
        folders = version["folders"]
        current = self._rows((folders[b] for b in touched if b in folders), columns)
        try:
            return self._write(self._merged(current, changed, columns), batch_id, {**version, "columns": columns})
        finally:
            remove_dir(self.spark, path)

    def _changed(self, changes: DataFrame, columns: list[str]) -> DataFrame:
        """Per key and column, the newest change that names the column: struct(seq, value)."""
        after = F.col("after")
        images = drop_deletes(changes).select(after[self.pk].alias(self.pk), "after", "seq")
        newest = [
            F.max(F.when(F.map_contains_key(after, c), F.struct("seq", after[c].alias("value")))).alias(c)
            for c in columns
        ]
        # The key is counted as well: a table may have no other column.
        return images.where(F.col(self.pk).isNotNull()).groupBy(self.pk).agg(F.count("*").alias("__n"), *newest)

    def _merged(self, current: DataFrame, changed: DataFrame, columns: list[str]) -> DataFrame:
        a, b = current.alias("a"), changed.alias("b")

        def wins(c: str) -> Column:
            old = F.col(f"a.{SEQS}")[c]
            return F.col(f"b.{c}.seq").isNotNull() & (old.isNull() | (F.col(f"b.{c}.seq") >= old))

        values = [F.when(wins(c), F.col(f"b.{c}.value")).otherwise(F.col(f"a.{c}")).alias(c) for c in columns]
        numbers = [
            F.struct(F.lit(c).alias("key"), F.when(wins(c), F.col(f"b.{c}.seq")).otherwise(F.col(f"a.{SEQS}")[c]).alias("value"))
            for c in columns
        ]
        seqs = F.filter(F.array(*numbers), lambda entry: entry["value"].isNotNull()) if numbers else None
        seqs = F.map_from_entries(seqs) if numbers else F.expr("cast(map() as map<string,bigint>)")
        key = F.coalesce(F.col(f"a.{self.pk}"), F.col(f"b.{self.pk}")).alias(self.pk)
        joined = a.join(b, F.col(f"a.{self.pk}") == F.col(f"b.{self.pk}"), "full_outer")
        return joined.select(key, *values, seqs.alias(SEQS))

    def _write(self, rows: DataFrame, batch_id: int, version: dict) -> bool:
        buckets = version["buckets"]
        batch = f"batch={batch_id}-{uuid.uuid4().hex}"
        dealt = rows.withColumn("bucket", self._bucket(F.col(self.pk), buckets))
        dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", self.pk)
        dealt.write.partitionBy("bucket").parquet(f"{self.root}/{batch}")
        written = listed_paths(self.spark, f"{self.root}/{batch}/bucket=*")
        fresh = {path.rpartition("=")[2]: f"{batch}/bucket={path.rpartition('=')[2]}" for path in written}
        manifest = {**version, "folders": {**version["folders"], **fresh}}
        path = f"{self.root}/_manifest/batch={batch_id}.json"
        publish_text(self.spark, path, json.dumps(manifest))
        return batch in json.dumps(self._manifest(path)) or not fresh

    def vacuum(self, keep: int = 2) -> None:
        """Remove the folders that none of the last ``keep`` versions names, and older manifests.

        Not to be run while a batch is being applied.
        """
        manifests = self._manifests()
        kept = sorted(manifests)[-keep:]
        named = {folder for n in kept for folder in self._manifest(manifests[n])["folders"].values()}
        for path in listed_paths(self.spark, f"{self.root}/batch=*/bucket=*"):
            if "/".join(path.split("/")[-2:]) not in named:
                remove_dir(self.spark, path)
        for number in set(manifests) - set(kept):
            remove_dir(self.spark, manifests[number])
