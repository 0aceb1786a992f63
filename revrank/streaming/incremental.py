"""State that grows with every new log slice.

Both jobs read files as they arrive and stop when the backlog is done
(``availableNow``). Results are written to a folder, never gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revrank.operators.ngram import ngram_counts
from revrank.operators.sequences import MAX_SEQ_LEN, append_log, last_n_history


def event_stream(spark: SparkSession, folder: str, files: str = "events*.parquet", per_batch: int = 1) -> DataFrame:
    """File stream over the stored events of a folder; the schema comes from the files."""
    schema = spark.read.option("pathGlobFilter", files).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    return reader.option("maxFilesPerTrigger", per_batch).parquet(folder)


def _run(query_writer, checkpoint: str) -> None:
    query = query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _version(out: str, batch: int) -> str:
    return f"{out}/v={batch}"


def _latest(spark: SparkSession, out: str, before: int | None = None) -> int | None:
    """Highest finished version (below ``before``); a version is finished once its _SUCCESS file is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    done = [
        int(s.getPath().getName().split("=")[1])
        for s in fs.listStatus(path)
        if s.getPath().getName().startswith("v=")
        and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    ]
    return max((v for v in done if before is None or v < before), default=None)


class BucketedHistory:
    """Newest ``cap`` log rows per user, stored in buckets of users by a hash of the id.

    A slice reads and rewrites only the buckets of its own users, under its batch number. A
    small table per batch tells which batch wrote each bucket last (one row per bucket). A
    slice that is run again after a failure starts from the batch before it and gives the
    same result. What neither the newest batch nor the one before needs is deleted.
    """

    def __init__(self, spark: SparkSession, folder: str, cap: int, order: list[str], schema: StructType, buckets: int = 64):
        self.spark, self.folder, self.cap, self.order, self.buckets = spark, folder, cap, order, buckets
        self.schema = schema

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("user_idx"), F.lit(self.buckets)).cast("int")

    def _places(self, batch_id: int | None) -> dict[int, int]:
        """Bucket -> batch that wrote it last, as of ``batch_id``."""
        if batch_id is None:
            return {}
        table = self.spark.read.schema("bucket int, batch int").parquet(_version(f"{self.folder}/places", batch_id))
        return {r["bucket"]: r["batch"] for r in table.collect()}

    def _path(self, bucket: int, batch: int) -> str:
        return f"{_version(f'{self.folder}/rows', batch)}/bucket={bucket}"

    def rows(self, batch_id: int | None, buckets: list[int] | None = None) -> DataFrame:
        """The history as of ``batch_id`` (None: before the first), of all or the named buckets."""
        places = self._places(batch_id)
        paths = [self._path(b, v) for b, v in sorted(places.items()) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def merge(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """Take in a slice; (history before, history after) of the buckets it touches."""
        previous = _latest(self.spark, f"{self.folder}/places", batch_id)
        touched = [r[0] for r in batch.select(self._bucket()).distinct().collect()]
        before = self.rows(previous, touched)
        kept = last_n_history(append_log(before, batch.select(*self.schema.names)), self.cap, self.order).drop("recency")
        placed = kept.withColumn("bucket", self._bucket()).repartition("bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(_version(f"{self.folder}/rows", batch_id))
        old = self._places(previous)
        now = old | dict.fromkeys(touched, batch_id)
        table = self.spark.createDataFrame(list(now.items()), "bucket int, batch int")
        table.coalesce(1).write.mode("overwrite").parquet(_version(f"{self.folder}/places", batch_id))
        return before, self.rows(batch_id, touched)

    def forget(self, batch_id: int) -> None:
        """Delete buckets and place tables that neither ``batch_id`` nor the batch before it needs."""
        previous = _latest(self.spark, f"{self.folder}/places", batch_id)
        if previous is None:
            return
        older = _latest(self.spark, f"{self.folder}/places", previous)
        if older is None:
            return
        needed = self._places(previous)
        for bucket, batch in self._places(older).items():
            if needed[bucket] != batch:
                _delete(self.spark, self._path(bucket, batch))
        _delete(self.spark, _version(f"{self.folder}/places", older))


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stream_user_history(
    stream: DataFrame, cap: int, order: list[str], out: str, checkpoint: str, buckets: int = 64
) -> DataFrame:
    """Newest ``cap`` log rows per user, kept up to date slice by slice (``BucketedHistory``).

    Equal to ``last_n_history`` of all slices, whatever the order in which they come.
    """
    spark = stream.sparkSession
    history = BucketedHistory(spark, out, cap, order, stream.schema, buckets)

    def merge(batch: DataFrame, batch_id: int) -> None:
        history.merge(batch, batch_id)
        history.forget(batch_id)

    _run(stream.writeStream.foreachBatch(merge), checkpoint)
    return history.rows(_latest(spark, f"{out}/places"))


def stream_ngram_counts(
    stream: DataFrame, size: int, order: list[str], out: str, checkpoint: str, max_len: int = MAX_SEQ_LEN,
    buckets: int = 64, fold_every: int = 16,
) -> DataFrame:
    """``ngram_counts`` of all slices so far, kept up to date slice by slice.

    A slice changes only its own users' windows: the windows of their stored newest
    ``max_len`` rows are taken off and those of the new ones put on, so late rows and windows
    that fall out of the history are right, too. Each slice writes the differences it makes;
    every ``fold_every``-th writes the whole sum instead, so a reader adds up few tables.
    """
    spark = stream.sparkSession
    names = list(dict.fromkeys(["user_idx", "item_idx", *order]))
    history = BucketedHistory(spark, f"{out}/history", max_len, order, stream.select(*names).schema, buckets)
    sums = f"{out}/counts"

    def merge(batch: DataFrame, batch_id: int) -> None:
        users = batch.select(F.col("user_idx").alias("__user")).distinct()
        mine = F.col("user_idx").eqNullSafe(F.col("__user"))
        before, after = history.merge(batch, batch_id)
        lost, won = [
            ngram_counts(rows.join(users, mine, "left_semi"), size, order, max_len) for rows in (before, after)
        ]
        parts = won.unionByName(lost.withColumn("c", -F.col("c")))
        fold = batch_id % fold_every == fold_every - 1
        if fold:
            parts = parts.unionByName(_counts_before(spark, sums, batch_id, fold_every))
        _summed(parts).write.mode("overwrite").parquet(_version(sums, batch_id))
        history.forget(batch_id)
        if fold:
            # The tables before the fold before this one are in both sums; no re-run reads them.
            for old in range(max(batch_id - 2 * fold_every, 0), max(batch_id - fold_every, 0)):
                _delete(spark, _version(sums, old))

    _run(stream.writeStream.foreachBatch(merge), checkpoint)
    return _summed(_counts_before(spark, sums, _latest(spark, sums) + 1, fold_every))


def _counts_before(spark: SparkSession, folder: str, batch_id: int, fold_every: int) -> DataFrame:
    """Differences of the batches before ``batch_id``, from the newest whole sum on."""
    first = max(batch_id // fold_every * fold_every - 1, 0)
    paths = [_version(folder, n) for n in range(first, batch_id)]
    empty = spark.createDataFrame([], "ctx array<bigint>, item_idx bigint, c bigint")
    return spark.read.schema(empty.schema).parquet(*paths) if paths else empty


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("ctx", "item_idx").agg(F.sum("c").alias("c")).filter(F.col("c") != 0)


def stream_item_popularity(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Running sum of relevance per item over all slices so far."""
    totals = stream.groupBy("item_idx").agg(F.sum("relevance").alias("score"))
    return _complete(totals, out, checkpoint)


def stream_windowed_popularity(
    stream: DataFrame, out: str, checkpoint: str, window: str = "1 day", late: str = "2 days"
) -> DataFrame:
    """Sum of relevance and rows per item and time window, with a bound on late rows.

    Windows older than the watermark leave the state. Each batch writes only the windows it
    changed; of a window's rows the newest counts.
    """
    timed = stream.withColumn("timestamp", _instant(stream)).withWatermark("timestamp", late)
    totals = (
        timed.groupBy(F.window("timestamp", window), "item_idx")
        .agg(F.sum("relevance").alias("score"), F.count("*").alias("n"))
        .select(F.col("window.start").alias("start"), "item_idx", "score", "n")
    )
    return _updated(totals, ["start", "item_idx"], out, checkpoint)


def _instant(stream: DataFrame) -> Column:
    """Event time as an instant. Stored times carry no zone and are read as UTC, whatever the session zone."""
    if dict(stream.dtypes)["timestamp"] != "timestamp_ntz":
        return F.col("timestamp")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, "timestamp"))


def _complete(totals: DataFrame, out: str, checkpoint: str) -> DataFrame:
    spark = totals.sparkSession

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_version(out, batch_id))

    _run(totals.writeStream.outputMode("complete").foreachBatch(save), checkpoint)
    return spark.read.parquet(_version(out, _latest(spark, out)))


def _updated(totals: DataFrame, keys: list[str], out: str, checkpoint: str) -> DataFrame:
    """Changed rows of every batch under their batch number; read back, the newest per key."""
    spark = totals.sparkSession
    rest = [c for c in totals.columns if c not in keys]

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(totals.writeStream.outputMode("update").foreachBatch(save), checkpoint)
    newest = F.max_by(F.struct(*rest), "batch").alias("newest")
    return spark.read.parquet(out).groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*totals.columns)
