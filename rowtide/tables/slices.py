"""Rows of a table in slices: a partition value and a bucket of the record key, each in as many versions as it was written.

A write makes new versions of the slices it has rows for and leaves the others alone. Layout below the table path:
``data/_attempt=<attempt>/_slice=<attempt>.<bucket>.<digest>/<partition>=<value>/`` and
``slices/<instant>.<attempt>/`` with one small row per rewritten slice. A slice without rows is listed without a folder,
so its previous version does not come back. The number of buckets is stored with the table; a hot partition value spreads
over all of them. With a global key a slice is a bucket alone and holds its rows of all partition values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.lists import broadcast_if_short
from rowtide.operators.meta import FILE_NAME, with_file_name
from rowtide.spec import TableSpec
from rowtide.tables import folders, sizing
from rowtide.tables.folders import ATTEMPT, SLICE, Entry

VERSION, BUCKET = "_version", "_bucket"
# So many slices are opened by their paths; of more, the whole folder is listed and joined with the list.
MOST_PATHS = 1000


class Slices:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, buckets: int | None, by_partition: bool = True):
        self.spark, self.path, self.spec, self.by_partition = spark, path, spec, by_partition
        self.data_path, self.lists_path = f"{path}/data", f"{path}/slices"
        self.key = (*(spec.partition if by_partition else ()), BUCKET)
        stored = self._stored_buckets()
        if buckets is not None and stored is not None and buckets != stored:
            raise ValueError(f"the table has {stored} buckets, not {buckets}")
        self.buckets = stored or buckets or 1

    def _stored_buckets(self) -> int | None:
        names = folders.children(self.spark, f"{self.path}/settings")
        return next((int(n.removeprefix("buckets=")) for n in names if n.startswith("buckets=")), None)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.spec.record_key), F.lit(self.buckets)).cast("int")

    @property
    def _list_schema(self) -> T.StructType:
        key = [*(self.spec.image[p] for p in self.key[:-1]), T.StructField(BUCKET, T.IntegerType())]
        return T.StructType([*key, T.StructField(SLICE, T.StringType()), T.StructField(VERSION, T.StringType())])

    def _listed(self, entries: list[Entry]) -> DataFrame:
        """Rewritten slices of some writes."""
        if not entries:
            return self.spark.createDataFrame([], self._list_schema)
        paths = [f"{self.lists_path}/{e.instant}.{e.attempt}" for e in entries]
        return self.spark.read.schema(self._list_schema).parquet(*paths)

    def newest(self, entries: list[Entry]) -> DataFrame:
        """The last version of every slice."""
        if len(entries) < 2:
            return self._listed(entries)
        last = F.max(F.struct(VERSION, SLICE)).alias("last")
        return self._listed(entries).groupBy(*self.key).agg(last).select(*self.key, "last.*")

    def changed(self, before: list[Entry], after: list[Entry]) -> tuple[DataFrame, DataFrame]:
        """Of the slices that were written between two states, the versions of both."""
        written = self.newest([e for e in after if e not in before])
        old = self.newest(before).alias("o").join(written.alias("n"), self.same("o", "n"), "left_semi")
        return old, written

    def same(self, a: str, b: str) -> Column:
        """Whether two aliases have the same slice."""
        found = F.lit(True)
        for k in self.key:
            found = found & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
        return found

    def read(self, slices: DataFrame, names: bool = False) -> DataFrame:
        """Rows of the given slices; no other folder is opened, and none is listed while there are few."""
        data, columns = self._open(slices, self.spec.record_schema), self.spec.record_schema.fieldNames()
        if data is None:
            empty = self.spark.createDataFrame([], self.spec.record_schema)
            return empty.withColumn(FILE_NAME, F.lit(None).cast("string")) if names else empty
        if names:
            data, columns = with_file_name(data), [*columns, FILE_NAME]
        return data.select(*columns)

    def folders(self, slices: DataFrame) -> DataFrame:
        """The folder columns of the given slices, a row per folder."""
        fields = [T.StructField(c, T.StringType()) for c in (ATTEMPT, SLICE)]
        schema = T.StructType([*fields, *(self.spec.image[p] for p in self.spec.partition)])
        data = self._open(slices, schema)
        return self.spark.createDataFrame([], schema) if data is None else data.select(*schema.fieldNames()).distinct()

    def _open(self, slices: DataFrame, schema: T.StructType) -> DataFrame | None:
        wanted = slices.select(SLICE).filter(F.col(SLICE) > "")
        found = [r[SLICE] for r in wanted.limit(MOST_PATHS + 1).collect()]
        if not found:
            return None
        if len(found) <= MOST_PATHS:
            paths = [f"{self.data_path}/{ATTEMPT}={n.split('.')[0]}/{SLICE}={n}" for n in sorted(found)]
            return self.spark.read.schema(schema).option("basePath", self.data_path).parquet(*paths)
        fields = [*(f for f in schema.fields if f.name != SLICE), T.StructField(SLICE, T.StringType())]
        data = self.spark.read.schema(T.StructType(fields)).parquet(self.data_path)
        # the join is on a folder column; a scan is pruned by the other side only if that side has a bound
        return data.join(broadcast_if_short(wanted), SLICE, "left_semi")

    def write(
        self,
        batch: DataFrame,
        instant: str,
        attempt: str,
        before: list[Entry],
        merge: Callable[[DataFrame], DataFrame],
        max_records_per_file: int = 0,
        file_bytes: int = 0,
    ) -> str:
        """New versions of the slices that ``batch`` has rows of; returns the path of their list.

        ``merge`` turns the batch, and the old rows of those slices if there are any, into their new rows. It must not
        lose columns. The batch is evaluated once. With ``file_bytes`` files are of about that size, see ``sizing``.
        """
        batch = batch.select(*self.spec.record_schema.fieldNames(), self.bucket().alias(BUCKET))
        digest = F.sha1(F.to_json(F.struct(*self.key)).cast("binary"))
        named = F.concat_ws(".", F.lit(attempt), F.col(BUCKET).cast("string"), digest)
        folder, pending = f"{self.data_path}/{ATTEMPT}={attempt}", f"{self.path}/pending/{attempt}"
        touched = None
        if before:
            batch.write.parquet(pending)
            # read back, so that the batch is evaluated once
            batch = self.spark.read.schema(batch.schema).parquet(pending)
            touched = batch.select(*self.key).distinct()
            old = self.newest(before).alias("o").join(touched.alias("n"), self.same("o", "n"), "left_semi")
            batch = self.read(old).withColumn(BUCKET, self.bucket()).unionByName(batch)
        merged = merge(batch).withColumn(SLICE, named).drop(BUCKET)
        if file_bytes:
            # evaluated once, for it is measured, counted and dealt
            merged.write.parquet(f"{pending}-merged")
            merged = self.spark.read.schema(merged.schema).parquet(f"{pending}-merged")
            folder_columns = [*dict.fromkeys([SLICE, *self.spec.partition])]
            merged = sizing.deal(merged, folder_columns, self.spec.record_key, file_bytes, f"{pending}-trial")
        else:
            merged = merged.hint("rebalance", SLICE)
        writer = merged.write.option("maxRecordsPerFile", max_records_per_file)
        writer.partitionBy(SLICE, *self.spec.partition).parquet(folder)
        # the folders that stand now, with what their names say
        there = [n.removeprefix(f"{SLICE}=") for n in folders.children(self.spark, folder) if n.startswith(f"{SLICE}=")]
        if touched is not None:
            held = self.spark.createDataFrame([(n, n) for n in there], f"{SLICE} string, held string")
            rows = touched.withColumn(SLICE, named).join(held, SLICE, "left").withColumn(SLICE, F.coalesce("held", F.lit("")))
        elif there:
            schema = T.StructType([*(self.spec.image[p] for p in self.key[:-1]), T.StructField(SLICE, T.StringType())])
            rows = self.spark.read.schema(schema).parquet(folder).select(*schema.fieldNames()).distinct()
            rows = rows.withColumn(BUCKET, F.split(SLICE, r"\.")[1].cast("int"))
        else:
            rows = self.spark.createDataFrame([], self._list_schema)
        rows = rows.withColumn(VERSION, F.lit(instant))
        listed = self._write_list(rows, instant, attempt)
        if self._stored_buckets() is None:
            folders.create(self.spark, f"{self.path}/settings/buckets={self.buckets}")
        folders.remove_all(self.spark, [pending, f"{pending}-merged", f"{pending}-trial"])
        return listed

    def _write_list(self, rows: DataFrame, instant: str, attempt: str) -> str:
        path = f"{self.lists_path}/{instant}.{attempt}"
        # a row per slice, so one file also after a full load
        rows.select(*self._list_schema.fieldNames()).coalesce(1).write.parquet(path)
        return path

    def join_lists(self, entries: list[Entry], floor: str) -> str:
        """One list of the newest slices of some writes, as of ``floor``; returns its attempt."""
        attempt = folders.new_attempt()
        self._write_list(self.newest(entries).withColumn(VERSION, F.lit(floor)), floor, attempt)
        return attempt

    def clean(self, entries: list[Entry]) -> None:
        """Remove lists and slices that none of the given writes needs, those of failed attempts included."""
        lists = {f"{e.instant}.{e.attempt}" for e in entries}
        gone = [f"{self.lists_path}/{n}" for n in folders.children(self.spark, self.lists_path) if n not in lists]
        folders.remove_all(self.spark, gone)
        attempts = [n for n in folders.children(self.spark, self.data_path) if n.startswith(f"{ATTEMPT}=")]
        if not attempts:
            return
        live = self._listed(entries).select(SLICE).filter(F.col(SLICE) > "").distinct()
        live = live.withColumn(ATTEMPT, F.substring_index(SLICE, ".", 1))
        needed = {r[ATTEMPT]: r["n"] for r in live.groupBy(ATTEMPT).agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
        stale = []
        for name in attempts:
            attempt = name.removeprefix(f"{ATTEMPT}=")
            if attempt not in needed:
                stale.append(f"{self.data_path}/{name}")
                continue
            slices = [n for n in folders.children(self.spark, f"{self.data_path}/{name}") if n.startswith(f"{SLICE}=")]
            if len(slices) > needed[attempt]:
                kept = {r[SLICE] for r in live.filter(F.col(ATTEMPT) == attempt).collect()}
                stale += [f"{self.data_path}/{name}/{n}" for n in slices if n.removeprefix(f"{SLICE}=") not in kept]
        folders.remove_all(self.spark, stale)
