"""State of the stream across crashes, restarts and compactions."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from pickwise import schemas
from pickwise.operators import realtime
from pickwise.sources import text, versions
from pickwise.streaming import StreamRecsJob, read_ratings_log, read_stream_recs, recs_job
from tests.test_streaming import _as_dict, _inputs


class Crash(Exception):
    pass


class CrashingJob(StreamRecsJob):
    """Fails after the given step of a compaction; counts the steps."""

    fail_at, steps = None, ()

    def _done(self, step):
        self.steps = (*self.steps, step)
        if len(self.steps) - 1 == self.fail_at:
            raise Crash(step)


def _batches(spark, batch, n, size=10):
    rows = batch.orderBy("time_stamp", "user_id", "product_id").limit(n * size).collect()
    return [text.format_rating_lines(spark.createDataFrame(rows[k * size:(k + 1) * size], schemas.RATING), sep="|")
            for k in range(n)]


def _log(spark, state):
    return sorted(tuple(r) for r in read_ratings_log(spark, state).collect())


def test_a_crash_after_any_step_of_a_compaction_changes_nothing(spark, tmp_dir):
    history, batch, sims = _inputs(spark)
    parts = _batches(spark, batch, 7, size=8)

    def job(state, cls=StreamRecsJob):
        return cls(spark, state, history, sims, buckets=2, compact_every=2)
    whole = job(f"{tmp_dir}/whole", CrashingJob)
    for n in range(5):
        whole.process(parts[n], n)
    shutil.copytree(f"{tmp_dir}/whole", f"{tmp_dir}/before")  # records hold relative paths
    whole.steps = ()
    whole.process(parts[5], 5)
    steps = whole.steps
    whole.process(parts[6], 6)
    want_log, want_recs = _log(spark, f"{tmp_dir}/whole"), _as_dict(read_stream_recs(spark, f"{tmp_dir}/whole"))
    assert len(want_log) == 56 and steps[:5] == ("recent", "rated", "recs", "log", "published")
    assert "generation deleted" in steps and "batch deleted" in steps
    tried = sorted({steps.index(step) for step in steps} | {len(steps) - 1})  # every kind of step, and the very last
    for k in tried:
        step = steps[k]
        state = f"{tmp_dir}/crash{k}"
        shutil.copytree(f"{tmp_dir}/before", state)
        first = job(state, CrashingJob)
        first.fail_at = k
        with pytest.raises(Crash, match=step):
            first.process(parts[5], 5)
        seen = _log(spark, state)  # a reader between the crash and the restart
        assert len(seen) == len(set(seen)) == 48
        again = job(state)
        again.process(parts[5], 5)  # the batch was not committed: it is replayed
        again.process(parts[6], 6)
        assert _log(spark, state) == want_log, step
        assert _as_dict(read_stream_recs(spark, state)) == want_recs, step


def test_a_crash_in_the_rename_leaves_the_former_record(spark, tmp_dir, monkeypatch):
    versions.publish(spark, tmp_dir, {"folder": "a"})
    os.makedirs(f"{tmp_dir}/{versions.POINTER}", exist_ok=True)
    open(f"{tmp_dir}/{versions.POINTER}/.draft-left", "w").close()  # as a crash before the rename leaves it
    assert versions.newest(spark, tmp_dir) == [{"folder": "a"}]
    versions.publish(spark, tmp_dir, {"folder": "b"})
    versions.publish(spark, tmp_dir, {"folder": "c"})
    assert versions.newest(spark, tmp_dir, 5) == [{"folder": "c"}, {"folder": "b"}]


def test_log_segments_merge_by_size_and_files_stay_few(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(recs_job, "MERGED_SEGMENTS", 2)
    history, batch, sims = _inputs(spark)
    job = StreamRecsJob(spark, f"{tmp_dir}/state", history, sims, buckets=1, compact_every=1)
    for n, part in enumerate(_batches(spark, batch, 6, size=4)):
        job.process(part, n)
    record = versions.newest(spark, f"{tmp_dir}/state")[0]
    assert sorted(level for level, _ in record["log"]) == [0, 2]  # five batches covered: 4 + 1
    assert len(_log(spark, f"{tmp_dir}/state")) == 24
    assert len(versions.folders(spark, f"{tmp_dir}/state/ratings_log/epoch=0")) <= 3


def test_compaction_keeps_what_the_reranker_sees(spark, tmp_dir):
    """Folded recents and bitmaps give the recommendations that all ratings give."""
    history, batch, sims = _inputs(spark)
    parts = _batches(spark, batch, 6, size=25)
    job = StreamRecsJob(spark, f"{tmp_dir}/state", history, sims, recent_k=3, buckets=3, compact_every=1)
    for n, part in enumerate(parts):
        job.process(part, n)
    rows = batch.orderBy("time_stamp", "user_id", "product_id").limit(150).collect()
    want = {}
    for n in range(6):
        past = history.unionByName(spark.createDataFrame(rows[:25 * n], schemas.RATING)) if n else history
        now = spark.createDataFrame(rows[25 * n:25 * n + 25], schemas.RATING)
        want.update(_as_dict(realtime.stream_recs(past, now, sims, recent_k=3)))
    assert _as_dict(read_stream_recs(spark, f"{tmp_dir}/state")) == want
    # a restart that reads more recents than were kept folds them anew from the ratings
    more = StreamRecsJob(spark, f"{tmp_dir}/state", history, sims, recent_k=50, buckets=3)
    more.prepare()
    older, _ = more._before(6, [0, 1, 2])
    every = more._history(6, [0, 1, 2])
    top = realtime.recent_ratings(every, every.select("user_id").distinct(), 50)
    got = realtime.recent_ratings(older, every.select("user_id").distinct(), 50)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, top.collect()))


def test_bitmaps_exclude_what_the_rating_rows_exclude(spark, tmp_dir):
    history, batch, sims = _inputs(spark)
    odd = spark.createDataFrame([(1, p, 1.0, 5) for p in (-40_000, -1, 0, 1, 32_768, 32_769, 2**31 - 1)], schemas.RATING)
    history = history.unionByName(odd).unionByName(spark.createDataFrame([(None, 3, 1.0, 5)], schemas.RATING))
    far = spark.createDataFrame([(7, p, 0.9) for p in (-40_000, -39_999, -1, 0, 1, 2, 32_768, 32_769, 32_770, 2**31 - 1)],
                                schemas.SIMILARITY)
    triggers = realtime.latest_per_user(batch.unionByName(spark.createDataFrame([(1, 7, 1.0, 2**40)], schemas.RATING)))
    every = sims.unionByName(far)
    bitmaps = realtime.rated_bitmaps(history)
    halves = [realtime.rated_bitmaps(history.filter(F.col("time_stamp") % 2 == k)) for k in (0, 1)]
    want = sorted(map(tuple, realtime.candidate_products(triggers, every, history).collect()))
    for rated in (bitmaps, realtime.merge_bitmaps(halves[0].unionByName(halves[1]))):
        assert sorted(map(tuple, realtime.candidate_products(triggers, every, None, rated=rated).collect())) == want
    assert {p for u, p, _ in want if u == 1} >= {-39_999, 2, 32_770} and not {p for u, p, _ in want if u == 1} & {0, 1, -1}


def test_rows_read_per_batch_fall(spark, tmp_dir):
    history, batch, sims = _inputs(spark)
    many = spark.createDataFrame([(u, 1000 + p, 3.0, p) for u in range(1, 5) for p in range(3000)], schemas.RATING)
    job = StreamRecsJob(spark, f"{tmp_dir}/state", history.unionByName(many), sims, buckets=2)
    job.prepare()
    older, rated = job._before(0, [0, 1])
    rows = job._history(0, [0, 1]).count()
    users = history.unionByName(many).select("user_id").distinct().count()
    assert older.count() <= users * job.recent_k and rated.count() <= 2 * users
    assert older.count() + rated.count() < rows / 4


def test_a_failed_overwrite_leaves_the_former_table(spark, tmp_dir):
    from pickwise.sources import read_table, write_table
    from pickwise.sources.tables import current_path
    df = spark.range(5)
    write_table(df, tmp_dir, "T")
    boom = df.select(F.when(F.col("id") == 4, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        write_table(boom, tmp_dir, "T")
    assert read_table(spark, tmp_dir, "T").count() == 5
    before = read_table(spark, tmp_dir, "T")
    write_table(before.withColumn("id", F.col("id") + 1), tmp_dir, "T")  # from the table itself
    assert sorted(r.id for r in before.collect()) == list(range(5))  # a reader keeps its version
    assert sorted(r.id for r in read_table(spark, tmp_dir, "T").collect()) == list(range(1, 6))
    write_table(df, tmp_dir, "T", mode="append")
    assert read_table(spark, tmp_dir, "T").count() == 10
    write_table(df, tmp_dir, "T", mode="ignore")
    with pytest.raises(ValueError, match="exists"):
        write_table(df, tmp_dir, "T", mode="error")
    write_table(df, tmp_dir, "T")
    assert len([f for f in os.listdir(f"{tmp_dir}/T") if f.startswith("v")]) == 2  # the failed try is gone
    assert os.path.basename(current_path(spark, tmp_dir, "T")).startswith("v-")
    df.write.parquet(f"{tmp_dir}/plain")
    assert read_table(spark, tmp_dir, "plain").count() == 5
