"""Realtime snapshots as a stream (R1-R3) and their batch twins.

* R1: new snapshot files are picked up by a file-source ``readStream``; ``trigger(availableNow)``
  processes whatever has landed since the last checkpoint and stops (the 15-minute poll).
* R2: keep the latest update per key across snapshots.  The stream keeps no state: ``foreachBatch``
  reduces the micro-batch (``max_by`` over (snapshot time, tie-break)) and adds it to the table as a delta;
  readers merge base and deltas, and a compaction folds them (``versions``).  No file that readers see is
  ever overwritten, and a repeated batch changes nothing.
* R3: delay per key per 15-minute tumbling window.  Either Spark's own state with a watermark (append mode:
  a window is emitted once the watermark passes its end, and later rows are dropped), or partial sums, which
  late rows are added to through a side table.

Checkpoints go to the folder the caller passes, normally under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.session import cut_lineage
from adherence.sources import versions as V

WINDOW = "15 minutes"


def snapshot_bucket(ts) -> F.Column:
    """15-minute snapshot time of an event timestamp (start of its tumbling window)."""
    return F.window(ts, WINDOW).start


def latest_snapshot_rows(events: DataFrame, ts: str = "ts") -> DataFrame:
    """S7 on event data: rows of the latest 15-minute snapshot of each service date.

    Per-date max of the snapshot time (partial aggregation), then a semi join back."""
    e = events.withColumn("service_date", F.to_date(ts)).withColumn("snapshot_ts", snapshot_bucket(F.col(ts)))
    last = e.groupBy("service_date").agg(F.max("snapshot_ts").alias("snapshot_ts"))
    return e.join(last, ["service_date", "snapshot_ts"], "left_semi")


def latest_per_key(updates: DataFrame, keys: list[str], order: list[str], value_cols: list[str]) -> DataFrame:
    """R2 batch twin: for each key the values of the row that is greatest under ``order``."""
    best = F.max_by(F.struct(*value_cols, *order), F.struct(*order)).alias("_w")
    return updates.groupBy(*keys).agg(best).select(*keys, "_w.*")


def window_stats(updates: DataFrame, ts: str, keys: list[str], value: str, watermark: str | None = None) -> DataFrame:
    """Count and mean of ``value`` per key per 15-minute tumbling window (batch or stream)."""
    ntz = dict(updates.dtypes).get(ts) == "timestamp_ntz"
    src = updates
    if watermark:
        # watermarks need TIMESTAMP; the wall-clock value is kept (session-zone round trip)
        src = src.withColumn(ts, F.col(ts).cast("timestamp")) if ntz else src
        src = src.withWatermark(ts, watermark)
    g = src.groupBy(F.window(ts, WINDOW).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("avg_value"))
    start, end = F.col("w.start"), F.col("w.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return g.select(start.alias("window_start"), end.alias("window_end"), *keys, "n", "avg_value")


def stream_files(spark, path: str, schema, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A file-source stream over a landing folder."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def _batch_load(batch: DataFrame, epoch_id: int, root: str, checkpoint: str) -> V.Load | None:
    """The load of a micro-batch; None if an earlier attempt has published it.  Its id is the query's (which
    the checkpoint keeps) and the batch's number, so a batch that is repeated finds its own work."""
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or _digest(checkpoint)
    load = V.Load(spark, root, (query, epoch_id))
    return None if load.published() else load


def _digest(text: str) -> str:
    return hashlib.sha1(text.encode()).hexdigest()[:16]


def run_latest_deltas(stream: DataFrame, keys: list[str], order: list[str], value_cols: list[str], root: str, table: str,
                      checkpoint: str, partition_col: str):
    """R2 as merge on read: each micro-batch is reduced and added to the table as a delta, which is all it
    writes.  ``read_latest`` merges base and deltas, ``compact_latest`` folds deltas into the base; both see
    whole batches only, and a batch that was killed half way is written anew when it is repeated."""
    def add(batch: DataFrame, epoch_id: int) -> None:
        load = _batch_load(batch, epoch_id, root, checkpoint)
        if load:
            load.write(latest_per_key(batch, keys, order, value_cols), table, [partition_col])
            load.publish(add=True)

    return (stream.writeStream.outputMode("append").foreachBatch(add)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_latest(spark, root: str, table: str, keys: list[str], order: list[str], value_cols: list[str], keep=None) -> DataFrame | None:
    """The latest row of each key over base and deltas; None before the first batch.  ``keep`` says which
    partitions are read (see ``versions.between``)."""
    rows = V.read(spark, root, table, keep)
    return None if rows is None else latest_per_key(rows, keys, order, value_cols)


def compact_latest(spark, root: str, table: str, keys: list[str], order: list[str], value_cols: list[str], least: int = 2,
                   retain: int = 1) -> int:
    """Folds the loads of each partition that has ``least`` of them at least into one; returns how many
    partitions.  Batches that come meanwhile stay deltas; the ``retain`` versions before stay readable."""
    entry = V.pointer(spark, root)["tables"].get(table)
    folded = {p: loads for p, loads in entry["parts"].items() if len(loads) >= least} if entry else {}
    if not folded:
        return 0
    load = V.Load(spark, root)
    rows = V.read_parts(spark, root, table, entry, folded)
    load.write(latest_per_key(rows, keys, order, value_cols), table, entry["by"])
    load.publish(folded={table: folded}, retain=retain)
    return len(folded)


def run_latest_merge(stream: DataFrame, keys: list[str], order: list[str], value_cols: list[str], table_path: str,
                     checkpoint: str, partition_col: str):
    """R2 as copy on write: the table holds the latest row of each key, and each micro-batch makes new files
    for the partitions that it touches, which replace the old ones when they are complete."""
    root, table = table_path.rstrip("/").rsplit("/", 1)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        load = _batch_load(batch, epoch_id, root, checkpoint)
        if load is None:
            return
        spark = batch.sparkSession
        new = cut_lineage(latest_per_key(batch, keys, order, value_cols))  # decoded once, used twice
        entry = V.pointer(spark, root)["tables"].get(table)
        if entry:
            touched = {V.partition_of(**{partition_col: r[0]}) for r in new.select(F.col(partition_col).cast("string")).distinct().collect()}
            current = V.read_parts(spark, root, table, entry, {p: loads for p, loads in entry["parts"].items() if p in touched})
            new = latest_per_key(current.unionByName(new.select(*current.columns)), keys, order, value_cols)
        load.write(new, table, [partition_col])
        load.publish()

    return (stream.writeStream.outputMode("append").foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# ---------------------------------------------------------------- windows whose late rows count too


def partial_windows(updates: DataFrame, ts: str, keys: list[str], value: str) -> DataFrame:
    """Sums that can be added up: (window_day, window_start, window_end, keys, n, n_values, total)."""
    ntz = dict(updates.dtypes).get(ts) == "timestamp_ntz"
    g = updates.groupBy(F.window(ts, WINDOW).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("n_values"), F.sum(value).alias("total"))
    start, end = F.col("w.start"), F.col("w.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return g.select(F.to_date(start).alias("window_day"), start.alias("window_start"), end.alias("window_end"), *keys, "n", "n_values", "total")


def run_window_sums(stream: DataFrame, ts: str, keys: list[str], value: str, watermark: str, root: str, table: str, checkpoint: str):
    """R3 without a state and without loss: each micro-batch adds partial sums of its windows to ``table``.
    Rows of windows that the watermark (the newest time of earlier batches less ``watermark``) has passed
    are late: their sums go to the side table ``<table>_late``.  ``read_windows`` adds both up, so a file
    that comes however late ends in the totals that a batch over all files gives.  The watermark lies beside
    them in ``<table>_watermark``, one row a batch."""
    side, marks = f"{table}_late", f"{table}_watermark"

    def add(batch: DataFrame, epoch_id: int) -> None:
        load = _batch_load(batch, epoch_id, root, checkpoint)
        if load is None:
            return
        spark = batch.sparkSession
        sums = cut_lineage(partial_windows(batch, ts, keys, value))
        seen = V.read(spark, root, marks)
        late = F.lit(False)
        if seen is not None:
            passed = seen.agg((F.max("newest") - F.expr(f"INTERVAL {watermark}")).alias("passed")).scalar()
            late = F.coalesce(F.col("window_end") <= passed, F.lit(False))
        load.write(sums.where(~late), table, ["window_day"])
        load.write(sums.where(late), side, ["window_day"])
        newest = batch.agg(F.max(F.col(ts).cast(dict(sums.dtypes)["window_end"])).alias("newest")).where("newest is not null")
        load.write(newest.withColumn("day", F.to_date("newest")), marks, ["day"])
        load.publish(add=True)

    return (stream.writeStream.outputMode("append").foreachBatch(add)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_windows(spark, root: str, table: str, keys: list[str], keep=None, late_only: bool = False) -> DataFrame | None:
    """``window_stats`` from the partial sums, those of late rows included (or alone)."""
    frames = [V.read(spark, root, t, keep) for t in ([] if late_only else [table]) + [f"{table}_late"]]
    frames = [f for f in frames if f is not None]
    if not frames:
        return None
    sums = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    g = sums.groupBy("window_start", "window_end", *keys).agg(F.sum("n").alias("n"), F.sum("n_values").alias("_n"), F.sum("total").alias("_total"))
    return g.select("window_start", "window_end", *keys, "n", F.try_divide(F.col("_total"), F.col("_n")).cast("double").alias("avg_value"))


def compact_windows(spark, root: str, table: str, keys: list[str], least: int = 2, retain: int = 1) -> int:
    """Adds up the partial sums of each day that has ``least`` loads at least; returns how many days."""
    tables, folded, load = V.pointer(spark, root)["tables"], {}, V.Load(spark, root)
    sums = ["window_day", "window_start", "window_end", *keys], [F.sum(c).alias(c) for c in ("n", "n_values", "total")]
    for t, (by, total) in {table: sums, f"{table}_late": sums, f"{table}_watermark": (["day"], [F.max("newest").alias("newest")])}.items():
        parts = {p: loads for p, loads in tables.get(t, {"parts": {}})["parts"].items() if len(loads) >= least}
        if parts:
            load.write(V.read_parts(spark, root, t, tables[t], parts).groupBy(*by).agg(*total), t, tables[t]["by"])
            folded[t] = parts
    if folded:
        load.publish(folded=folded, retain=retain)
    return sum(map(len, folded.values()))


def run_window_stats(stream: DataFrame, ts: str, keys: list[str], value: str, watermark: str, sink_path: str,
                     checkpoint: str, mode: str = "append"):
    """R3 as a streaming job.

    ``append``: each window is written once, when the watermark passes its end (rows later than
    the watermark are dropped); Parquet file sink.  ``complete``: the whole result table is
    rewritten each micro-batch through ``foreachBatch`` (state keeps every window)."""
    q = window_stats(stream, ts, keys, value, watermark)
    w = q.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        return w.outputMode("append").format("parquet").option("path", sink_path).start()

    def overwrite(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink_path)

    return w.outputMode("complete").foreachBatch(overwrite).start()


def stream_trip_updates(spark, realtime_root: str, zone: str | None = None, max_files: int | None = None) -> DataFrame:
    """R1 on the real feed: new ``tripupdates.pb`` snapshots under ``realtime_root`` as a stream of
    flat TripUpdates rows (binaryFile stream -> decoder, one snapshot per task)."""
    from adherence.constants import DEFAULT_ZONE
    from adherence.sources import tripupdates as TU

    schema = "path string, modificationTime timestamp, length long, content binary"
    r = (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.pb")
         .option("recursiveFileLookup", "true"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return TU.decode(r.load(realtime_root), zone=zone or DEFAULT_ZONE)


def run_feed_deltas(spark, realtime_root: str, root: str, table: str, checkpoint: str, zone: str | None = None):
    """R1 + R2 on the landing folder: each micro-batch decodes the snapshots since the last one; the latest
    row of each key becomes a delta of ``table``, and snapshots that cannot be decoded rows of
    ``<table>_dead``, both in one version."""
    from adherence.constants import DEFAULT_ZONE
    from adherence.sources import tripupdates as TU

    def add(batch: DataFrame, epoch_id: int) -> None:
        load = _batch_load(batch, epoch_id, root, checkpoint)
        if load:
            rows = cut_lineage(batch)  # decoded once, looked at twice
            load.write(latest_per_key(TU.updates(rows, zone=zone or DEFAULT_ZONE), UPDATE_KEYS, UPDATE_ORDER, UPDATE_VALUES), table, ["service_date"])
            load.write(TU.dead_letters(rows), f"{table}_dead", ["service_date"])
            load.publish(add=True)

    stream = TU.load(spark, realtime_root, stream=True)
    return (stream.writeStream.outputMode("append").foreachBatch(add)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


UPDATE_KEYS = ["service_date", "trip_id", "stop_id", "stop_sequence"]
UPDATE_ORDER = ["snapshot_ts", "actual_epoch", "delay_seconds"]
UPDATE_VALUES = ["route_id", "start_date", "trip_start_epoch", "path"]
