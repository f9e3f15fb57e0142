"""Streaming re-ranker: rating messages -> StreamRecs, one upsert per micro-batch.

``foreachBatch`` runs the batch function of :mod:`pickwise.operators.realtime`
on the whole micro-batch. State lives in parquet tables under ``state_dir`` (a
shared folder):

* ``history``: the rating table as of the start, written once, partitioned by
  ``user_bucket = pmod(xxhash64(user_id), B)``, B about one bucket per million
  ratings (recorded in ``layout`` so a restart reuses it);
* ``similarity``: the ProductRecs table, written once, partitioned by
  ``product_bucket``;
* ``ratings_log``: the valid ratings of each batch, partitioned by ``epoch``
  (a run on a new checkpoint), ``batch_id`` and ``user_bucket``;
* ``stream_recs``: (user_id, recs) per batch, partitioned by ``epoch`` and
  ``batch_id``;
* ``generations``: the folded state of all batches before some (epoch, batch
  id): ``recent``, the newest ratings of each user, as many as the re-ranker
  reads; ``rated``, one bitmap of rated products per user and 32,768 ids;
  ``recs``, the newest recommendations; ``log``, the ratings themselves, in
  segments that are merged by size, so each rating is rewritten a logarithmic
  number of times.

Which generation counts, and up to which batch, says one record that is
published by an atomic rename (:mod:`pickwise.sources.versions`). Readers take
the newest record, its generation, and of ``ratings_log`` and ``stream_recs``
only the batches the generation does not cover. So a compaction that fails
between any two of its steps changes nothing: before the rename the former
record holds, after it the batches that are still to be deleted are not read.
Folders go one compaction later, when no reader can still hold the record that
names them.

A micro-batch reads the recents and bitmaps of the user buckets it touches,
the batches since the last compaction, and the similarity partitions of the
products it needs, so its I/O grows with the batch, not with the ratings so
far. The bucket ids of a batch are at most B integers, the only data brought
to the driver.

Batch N reads log partitions < N and overwrites only its own partitions
(dynamic partition overwrite), so a replayed batch sees the same history and
writes the same rows. The current StreamRecs table is the newest row per user
(:func:`read_stream_recs`); an empty ``recs`` replaces older recommendations,
as an upsert would. Malformed messages are dropped and counted through an
observed metric, so counting costs no extra pass.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise import schemas
from pickwise.operators import realtime
from pickwise.operators.topk import top_k
from pickwise.sources import versions
from pickwise.sources.versions import complete, delete, folders
from pickwise.streaming.source import parse_messages

_RATING_COLS = [f.name for f in schemas.RATING.fields]
ROWS_PER_BUCKET = 1_000_000
KEPT_COUNTS = 1000
MERGED_SEGMENTS = 8  # log segments of one size that become one of the next


def bucket_of(col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


def _write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def _with(schema: T.StructType, **columns: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in columns.items())])


_HISTORY = _with(schemas.RATING, user_bucket=T.IntegerType())
_LOG = _with(schemas.RATING, epoch=T.IntegerType(), batch_id=T.LongType(), user_bucket=T.IntegerType())
_RECS = _with(schemas.USER_RECS, epoch=T.IntegerType(), batch_id=T.LongType())
_RATED = _with(realtime.RATED, user_bucket=T.IntegerType())
_SIMS = _with(schemas.SIMILARITY, product_bucket=T.IntegerType())
_LAYOUT = T.StructType([T.StructField("buckets", T.IntegerType()), T.StructField("sim_buckets", T.IntegerType())])


def _age() -> Column:
    return F.struct("epoch", "batch_id")


def _younger(bound: tuple[int, int]) -> Column:
    """Whether a row belongs to batch ``bound`` = (epoch, batch id) or a later one."""
    epoch, batch_id = bound
    return (F.col("epoch") > epoch) | ((F.col("epoch") == epoch) & (F.col("batch_id") >= batch_id))


def _union(parts: list[DataFrame | None]) -> DataFrame | None:
    found = [p for p in parts if p is not None]
    if not found:
        return None
    out = found[0]
    for p in found[1:]:
        out = out.unionByName(p)
    return out


class _State:
    """What the newest published record of ``state_dir`` says, and the tables it leads to."""

    def __init__(self, spark: SparkSession, state_dir: str):
        self.spark, self.state_dir = spark, state_dir
        records = versions.newest(spark, state_dir)
        self.record = records[0] if records else None

    @property
    def bound(self) -> tuple[int, int]:
        """(epoch, batch id) of the first batch that the generation does not cover."""
        return (self.record["epoch"], self.record["batch_id"]) if self.record else (0, 0)

    def part(self, name: str, schema: T.StructType) -> DataFrame | None:
        """A table of the generation."""
        folder = self.record and self.record.get(name)
        return self.spark.read.schema(schema).parquet(os.path.join(self.state_dir, folder)) if folder else None

    def live(self, name: str, schema: T.StructType) -> DataFrame | None:
        """The batches of ``name`` that the generation does not cover; None before the first one.

        Batches overwrite their own partitions, which appear when they commit and
        leave no marker beside them.
        """
        path = os.path.join(self.state_dir, name)
        if not any(os.path.basename(f).startswith("epoch=") for f in folders(self.spark, path)):
            return None
        return self.spark.read.schema(schema).parquet(path).filter(_younger(self.bound))

    def segments(self) -> DataFrame | None:
        """The covered part of the rating log."""
        return _union([self.spark.read.schema(_LOG).parquet(os.path.join(self.state_dir, folder))
                       for _, folder in (self.record or {}).get("log", [])])


def _newest_recs(parts: list[DataFrame | None]) -> DataFrame | None:
    """(user_id, recs, epoch, batch_id) of the newest batch that touched each user."""
    every = _union(parts)
    if every is None:
        return None
    return every.groupBy("user_id").agg(F.max_by("recs", _age()).alias("recs"), F.max(_age()).alias("a")).select(
        "user_id", "recs", "a.epoch", "a.batch_id")


def read_stream_recs(spark: SparkSession, state_dir: str) -> DataFrame:
    """Current StreamRecs: for each user the recs of the newest batch that touched it."""
    state = _State(spark, state_dir)
    recs = _newest_recs([state.part("recs", _RECS), state.live("stream_recs", _RECS)])
    if recs is None:  # no batch has produced recommendations yet
        return spark.createDataFrame([], schemas.USER_RECS)
    return recs.select("user_id", "recs")


def read_ratings_log(spark: SparkSession, state_dir: str) -> DataFrame:
    """Every valid rating the stream has taken in, with its epoch and batch id, each once."""
    state = _State(spark, state_dir)
    log = _union([state.segments(), state.live("ratings_log", _LOG)])
    log = spark.createDataFrame([], _LOG) if log is None else log
    return log.select(*_RATING_COLS, "epoch", "batch_id")


class StreamRecsJob:
    """Holds the static inputs and the ``foreachBatch`` function of the stream.

    Batch ids start again at 0 with a new checkpoint, so state is ordered by
    (epoch, batch id): ``start`` opens a new epoch when its checkpoint folder
    holds no progress yet. Every ``compact_every`` batches the batches before
    are folded into a new generation, so the number of files stays bounded.
    """

    def __init__(self, spark: SparkSession, state_dir: str, base_ratings: DataFrame,
                 sims: DataFrame, recent_k: int = schemas.MAX_USER_RATINGS_NUM,
                 candidate_k: int = schemas.MAX_SIM_PRODUCTS_NUM,
                 threshold: float = schemas.SIMILARITY_THRESHOLD,
                 buckets: int | None = None, compact_every: int = 50):
        self.spark = spark
        self.state_dir = state_dir
        self.recent_k, self.candidate_k, self.threshold = recent_k, candidate_k, threshold
        self.buckets, self.sim_buckets = buckets, buckets
        self.compact_every = compact_every
        self.layout_path = os.path.join(state_dir, "layout")
        self.epochs_path = os.path.join(state_dir, "epochs")
        self.history_path = os.path.join(state_dir, "history")
        self.sims_path = os.path.join(state_dir, "similarity")
        self.log_path = os.path.join(state_dir, "ratings_log")
        self.recs_path = os.path.join(state_dir, "stream_recs")
        self.malformed: dict[int, int] = {}  # of the newest batches
        self._prepared = False
        self._base_ratings = base_ratings.select(_RATING_COLS)
        self._sims = sims.select("product_id", "rec_product_id", "score")
        self.epoch = self._last_epoch()

    def _last_epoch(self) -> int:
        return max((int(f.rsplit("=", 1)[1]) for f in folders(self.spark, self.epochs_path)), default=0)

    def _open_epoch(self, checkpoint_location: str) -> None:
        """A checkpoint without progress numbers its batches from 0: they follow all earlier ones."""
        if not folders(self.spark, os.path.join(checkpoint_location)):
            self.epoch = self._last_epoch() + 1
            fs, p = versions.filesystem(self.spark, os.path.join(self.epochs_path, f"epoch={self.epoch}"))
            fs.mkdirs(p)

    def _layout(self) -> None:
        """Bucket counts of the state tables: recorded once, reused after a restart."""
        def saved():
            return (self.spark.read.schema(_LAYOUT).parquet(self.layout_path)
                    if complete(self.spark, self.layout_path) else None)
        if saved() is None:
            def sized(rows: DataFrame, given: int | None) -> int:
                return given or max(1, -(-rows.count() // ROWS_PER_BUCKET))
            counts = sized(self._base_ratings, self.buckets), sized(self._sims, self.sim_buckets)
            self.spark.createDataFrame([counts], _LAYOUT).write.mode("overwrite").parquet(self.layout_path)
        self.buckets, self.sim_buckets = saved().first()

    def prepare(self) -> None:
        """Write the bucketed tables and the first generation once (kept across restarts)."""
        if self._prepared:
            return
        self._layout()
        if not complete(self.spark, self.history_path):
            (self._base_ratings.withColumn("user_bucket", bucket_of("user_id", self.buckets))
             .repartition("user_bucket").sortWithinPartitions("user_id")
             .write.mode("overwrite").partitionBy("user_bucket").parquet(self.history_path))
        if not complete(self.spark, self.sims_path):
            (self._sims.withColumn("product_bucket", bucket_of("product_id", self.sim_buckets))
             .repartition("product_bucket").sortWithinPartitions("product_id")
             .write.mode("overwrite").partitionBy("product_bucket").parquet(self.sims_path))
        state = _State(self.spark, self.state_dir)
        if state.record is None or state.record["recent_k"] < self.recent_k:
            # the first generation, or more recents than were kept: folded from the ratings themselves
            rows = self.spark.read.schema(_HISTORY).parquet(self.history_path)
            covered = state.segments()
            if covered is not None:
                rows = rows.unionByName(covered.select(*_RATING_COLS, "user_bucket"))
            folder = os.path.join("generations", versions.fresh("from_ratings"))
            record = dict(state.record or {"epoch": 0, "batch_id": 0, "log": []}, recent_k=self.recent_k)
            record["recent"] = self._put(self._recent_of(rows), folder, "recent", "user_bucket")
            record["rated"] = self._put(self._rated_of(rows), folder, "rated", "user_bucket")
            versions.publish(self.spark, self.state_dir, record)
        self._prepared = True

    # ---- folded state

    def _put(self, df: DataFrame, folder: str, name: str, by: str | None = None) -> str:
        """Write one table of a generation; returns its folder below ``state_dir``."""
        path = os.path.join(folder, name)
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(by) if by else writer).parquet(os.path.join(self.state_dir, path))
        return path

    def _recent_of(self, rows: DataFrame) -> DataFrame:
        """The newest ratings of each user, in its bucket; all the re-ranker reads of older ones."""
        newest = top_k(rows, ["user_id"], realtime.newest_first(), self.recent_k).drop("rank")
        return newest.select(*_RATING_COLS, "user_bucket").repartition("user_bucket").sortWithinPartitions("user_id")

    def _rated_of(self, rows: DataFrame, older: DataFrame | None = None) -> DataFrame:
        """Bitmaps of the products each user has rated, in the user's bucket."""
        # dealt by bucket first: rows travel, not bitmaps of 4 KB
        new = realtime.rated_bitmaps(rows.select("user_bucket", "user_id", "product_id").repartition("user_bucket"),
                                     "user_bucket")
        if older is not None:
            new = realtime.merge_bitmaps(new.unionByName(older.select(new.columns)).repartition("user_bucket"),
                                         "user_bucket")
        return new.repartition("user_bucket").sortWithinPartitions("user_id", "part")

    # ---- one micro-batch

    def _bucket_ids(self, df: DataFrame, col: str, buckets: int) -> list[int]:
        rows = df.select(bucket_of(col, buckets).alias("b")).distinct().collect()
        return sorted(r.b for r in rows)  # at most `buckets` values

    def _live_log(self, state: _State, batch_id: int) -> DataFrame | None:
        """Logged ratings of the batches between the generation and this batch."""
        live = state.live("ratings_log", _LOG)
        return None if live is None else live.filter(~_younger((self.epoch, batch_id)))

    def _history(self, batch_id: int, user_buckets: list[int]) -> DataFrame:
        """Every rating before this batch of the users in these buckets."""
        state = _State(self.spark, self.state_dir)
        parts = [self.spark.read.schema(_HISTORY).parquet(self.history_path), state.segments(),
                 self._live_log(state, batch_id)]
        return _union([p.filter(F.col("user_bucket").isin(user_buckets)).select(_RATING_COLS)
                       for p in parts if p is not None])

    def _before(self, batch_id: int, user_buckets: list[int]) -> tuple[DataFrame, DataFrame]:
        """(ratings that can be among the newest k, bitmaps of folded ratings) of the users in these buckets."""
        state = _State(self.spark, self.state_dir)

        def mine(df):
            return df.filter(F.col("user_bucket").isin(user_buckets))
        rows = [state.part("recent", _HISTORY), self._live_log(state, batch_id)]
        return (_union([mine(p).select(_RATING_COLS) for p in rows if p is not None]),
                mine(state.part("rated", _RATED)).drop("user_bucket"))

    def _stamped(self, df: DataFrame, batch_id: int) -> DataFrame:
        return df.withColumn("epoch", F.lit(self.epoch)).withColumn("batch_id", F.lit(batch_id).cast("long"))

    def process(self, messages: DataFrame, batch_id: int) -> None:
        self.prepare()
        parsed = parse_messages(messages)
        obs = Observation(f"malformed_{batch_id}")
        parsed = parsed.observe(obs, F.count_if(~F.col("valid")).alias("malformed"))
        batch = parsed.filter("valid").select(_RATING_COLS)
        _write_partitions(self._stamped(batch, batch_id)
                          .withColumn("user_bucket", bucket_of("user_id", self.buckets)),
                          self.log_path, ["epoch", "batch_id", "user_bucket"])
        self.malformed[batch_id] = int(obs.get.get("malformed", 0) or 0)
        while len(self.malformed) > KEPT_COUNTS:
            del self.malformed[next(iter(self.malformed))]

        log = _State(self.spark, self.state_dir).live("ratings_log", _LOG)
        if log is None:  # no valid message so far
            return
        written = log.filter((F.col("epoch") == self.epoch) & (F.col("batch_id") == batch_id)).select(_RATING_COLS)
        user_buckets = self._bucket_ids(written, "user_id", self.buckets)
        if user_buckets:
            older, rated = self._before(batch_id, user_buckets)
            # similarities are needed for the triggers' lists and the users' recent products
            recents = realtime.recent_ratings(older.unionByName(written), written.select("user_id").distinct(), self.recent_k)
            needed = recents.select("product_id").unionByName(written.select("product_id"))
            product_buckets = self._bucket_ids(needed, "product_id", self.sim_buckets)
            sims = (self.spark.read.schema(_SIMS).parquet(self.sims_path)
                    .filter(F.col("product_bucket").isin(product_buckets))
                    .select("product_id", "rec_product_id", "score"))
            recs = realtime.stream_recs(older, written, sims, recent_k=self.recent_k,
                                        candidate_k=self.candidate_k, threshold=self.threshold, rated=rated)
            _write_partitions(self._stamped(recs, batch_id), self.recs_path, ["epoch", "batch_id"])
        if (batch_id + 1) % self.compact_every == 0:
            self._compact(batch_id)

    # ---- compaction

    def _done(self, step: str) -> None:
        """Called after each step of a compaction; tests fail here."""

    def _compact(self, batch_id: int) -> None:
        """Fold all batches before this one (which may still be replayed) into a new generation."""
        state = _State(self.spark, self.state_dir)
        bound = (self.epoch, batch_id)
        log = self._live_log(state, batch_id)
        if state.bound < bound and log is not None:
            folder = os.path.join("generations", versions.fresh(f"upto_{self.epoch:08d}_{batch_id:012d}"))
            record = dict(state.record, epoch=self.epoch, batch_id=batch_id)
            rows = log.select(*_RATING_COLS, "user_bucket")
            record["recent"] = self._put(self._recent_of(state.part("recent", _HISTORY).unionByName(rows)),
                                         folder, "recent", "user_bucket")
            self._done("recent")
            record["rated"] = self._put(self._rated_of(rows, state.part("rated", _RATED)), folder, "rated", "user_bucket")
            self._done("rated")
            live = state.live("stream_recs", _RECS)
            recs = _newest_recs([state.part("recs", _RECS), None if live is None else live.filter(~_younger(bound))])
            if recs is not None:
                record["recs"] = self._put(recs, folder, "recs")
            self._done("recs")
            record["log"] = self._merged(state, log, folder)
            self._done("log")
            versions.publish(self.spark, self.state_dir, record)
            self._done("published")
        self._tidy()

    def _merged(self, state: _State, log: DataFrame, folder: str) -> list:
        """The log's segments [level, folder] with the new batches; equal levels merge into the next."""
        segments = list(state.record["log"])
        rows, level = log, 0
        while sum(at == level for at, _ in segments) >= MERGED_SEGMENTS - 1:
            old = [path for at, path in segments if at == level]
            segments = [s for s in segments if s[0] != level]
            rows = _union([rows, *(self.spark.read.schema(_LOG).parquet(os.path.join(self.state_dir, p)) for p in old)])
            level += 1
        rows = rows.select(_LOG.fieldNames()).repartition("user_bucket").sortWithinPartitions("user_id")
        return [*segments, [level, self._put(rows, folder, "log", "user_bucket")]]

    def _tidy(self) -> None:
        """Delete what neither the newest record nor the one before it leads to."""
        records = versions.newest(self.spark, self.state_dir, 2)
        named = {path for r in records for path in
                 [r["recent"], r["rated"], r.get("recs"), *(folder for _, folder in r["log"])] if path}
        for generation in folders(self.spark, os.path.join(self.state_dir, "generations")):
            for table in folders(self.spark, generation):
                if os.path.join("generations", os.path.basename(generation), os.path.basename(table)) not in named:
                    delete(self.spark, table)
            if not folders(self.spark, generation):
                delete(self.spark, generation)
            self._done("generation deleted")
        covered = min((r["epoch"], r["batch_id"]) for r in records)
        for path in (self.log_path, self.recs_path):
            for epoch in folders(self.spark, path):
                for batch in folders(self.spark, epoch):
                    if (int(epoch.rsplit("=", 1)[1]), int(batch.rsplit("=", 1)[1])) < covered:
                        delete(self.spark, batch)
                        self._done("batch deleted")

    def start(self, messages: DataFrame, checkpoint_location: str,
              processing_time: str | None = "2 seconds", available_now: bool = False):
        self.prepare()
        self._open_epoch(checkpoint_location)
        writer = (messages.writeStream.foreachBatch(self.process)
                  .option("checkpointLocation", checkpoint_location))
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif processing_time:
            writer = writer.trigger(processingTime=processing_time)
        return writer.start()
