"""A raw archive that a stream appends to and that stays compact.

A stream writes a few small files per micro-batch and date. Compaction rewrites the dates it touches
into files that follow the data, and swaps them in atomically: a reader sees each reading once, before,
during and after it.

Layout below the archive's path (a shared folder)::

    batches/batch=<id>/date=<d>/...   a micro-batch as it came
    merged/gen=<g>/date=<d>/...       dates as compaction <g> rewrote them
    manifest/v=<g>/...                for each date the generation to read, and the last batch in it

A folder counts once its ``_SUCCESS`` mark is there. The newest manifest says which merged dates and
which batches make up the archive; files that it does not name are not read, and go with
:meth:`StreamArchive.vacuum`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .archive import DATE_COL, utc_date

_BATCH, _GEN, _VERSION = "batch", "gen", "v"
_MANIFEST = "date date, gen int, through long"


class StreamArchive:
    """Archive of readings with ``schema`` below ``path``. One stream appends and one process
    compacts; any number read."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, time_col: str = "ts") -> None:
        self.spark, self.path, self.schema, self.time_col = spark, path.rstrip("/"), schema, time_col
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- writing ------------------------------------------------------------------------------

    def append(self, readings: DataFrame, batch_id: int) -> None:
        """Add one batch. An id that is there, or merged already, stays as it is, so a batch that is run
        again changes nothing and disturbs no reader; one that failed half-way is written anew."""
        version = self._versions()[-1:]
        if int(batch_id) in self._complete("batches", _BATCH) or (
                version and int(batch_id) <= self._manifest(version[0])[1]):
            return
        (readings.select(*self.schema.names).withColumn(DATE_COL, utc_date(readings, self.time_col))
         .write.mode("overwrite").partitionBy(DATE_COL).parquet(f"{self.path}/batches/{_BATCH}={int(batch_id)}"))

    def append_stream(self, readings: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Add every micro-batch of a stream, each once however often it is run."""
        writer = (readings.writeStream.foreachBatch(lambda batch, batch_id: self.append(batch, batch_id))
                  .option("checkpointLocation", checkpoint))
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def compact(self, max_records_per_file: int = 5_000_000) -> int:
        """Merge all batches that are not merged yet into the dates they hold; returns the version.

        Only those dates are rewritten, in one job: small dates share a task, a hot date is split. The
        new manifest is written last, in one piece, and makes the new files the archive at once; a
        compaction that fails before leaves the archive as it was."""
        version = self._versions()[-1:]
        manifest, through = self._manifest(version[0] if version else None)
        fresh = [b for b in self._complete("batches", _BATCH) if b > through]
        if not fresh:
            return version[0] if version else 0
        gen = (version[0] if version else 0) + 1
        raw = self._raw(fresh)
        dates = raw.select(DATE_COL).distinct()
        touched = self._merged(manifest.join(dates, DATE_COL, "left_semi"))
        target = f"{self.path}/merged/{_GEN}={gen}"
        (raw.unionByName(touched).hint("rebalance", DATE_COL).sortWithinPartitions(DATE_COL)
         .write.mode("overwrite").option("maxRecordsPerFile", int(max_records_per_file))
         .partitionBy(DATE_COL).parquet(target))
        kept = manifest.join(dates, DATE_COL, "left_anti").select(DATE_COL, _GEN)
        listed = kept.unionByName(dates.select(DATE_COL, F.lit(gen).alias(_GEN)))
        # One row per date: a calendar bounds it.
        (listed.withColumn("through", F.lit(max(fresh)).cast("long")).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifest/{_VERSION}={gen}"))
        return gen

    def vacuum(self, keep: int = 1) -> None:
        """Delete what none of the newest ``keep`` manifests name. A reader that began on an older one
        fails; keep as many as reads may last."""
        versions = self._versions()
        held = [self._manifest(v) for v in versions[-max(1, keep):]]
        if not held:
            return
        alive = {r[_GEN] for manifest, _ in held for r in manifest.select(_GEN).distinct().collect()}
        merged_by_all = min(through for _, through in held)
        stale = [f"merged/{_GEN}={g}" for g in self._all("merged", _GEN) if g not in alive and g <= versions[-1]]
        stale += [f"batches/{_BATCH}={b}" for b in self._all("batches", _BATCH) if b <= merged_by_all]
        stale += [f"manifest/{_VERSION}={v}" for v in versions[:-max(1, keep)]]
        for folder in stale:
            self._fs.delete(self._path(f"{self.path}/{folder}"), True)

    # ---- reading ------------------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """All readings, with their UTC ``date`` (filters on it prune folders): the merged dates of the
        newest manifest (or ``version``) and the batches that came after it."""
        versions = self._versions()
        manifest, through = self._manifest(version if version is not None else (versions or [None])[-1])
        fresh = [b for b in self._complete("batches", _BATCH) if b > through]
        return self._merged(manifest).unionByName(self._raw(fresh))

    # ---- folders ------------------------------------------------------------------------------

    def _numbers(self, pattern: str, name: str) -> list[int]:
        found = self._fs.globStatus(self._path(f"{self.path}/{pattern}")) or []
        parts = [str(f.getPath().toString()).rstrip("/").split("/") for f in found]
        return sorted(int(p.split("=")[1]) for path in parts for p in path[-2:] if p.startswith(f"{name}="))

    def _complete(self, folder: str, name: str) -> list[int]:
        return self._numbers(f"{folder}/{name}=*/_SUCCESS", name)

    def _all(self, folder: str, name: str) -> list[int]:
        return self._numbers(f"{folder}/{name}=*", name)

    def _versions(self) -> list[int]:
        return self._complete("manifest", _VERSION)

    def _manifest(self, version: int | None) -> tuple[DataFrame, int]:
        """The dates and generations of a version, and the last batch that is merged in it."""
        if version is None:
            return self.spark.createDataFrame([], _MANIFEST), -1
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/{_VERSION}={version}")
        return rows, int(rows.agg(F.max("through")).first()[0])

    def _table(self, folder: str, paths: list[str], number: str) -> DataFrame:
        whole = T.StructType([*self.schema.fields, T.StructField(number, T.IntegerType()),
                              T.StructField(DATE_COL, T.DateType())])
        if not paths:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).option("basePath", f"{self.path}/{folder}").parquet(*paths)

    def _raw(self, batches: list[int]) -> DataFrame:
        paths = [f"{self.path}/batches/{_BATCH}={b}" for b in batches]
        return self._table("batches", paths, _BATCH).drop(_BATCH)

    def _merged(self, manifest: DataFrame) -> DataFrame:
        """The merged readings that ``manifest`` names; its rows prune the folders as the query runs."""
        paths = [f"{self.path}/merged/{_GEN}={g}" for g in
                 sorted(r[_GEN] for r in manifest.select(_GEN).distinct().collect())]
        named = F.broadcast(manifest.select(DATE_COL, _GEN))
        return self._table("merged", paths, _GEN).join(named, [DATE_COL, _GEN], "left_semi").drop(_GEN)
