import os

from pyspark.sql import functions as F

from pickwise import schemas
from pickwise.operators import item_cf, realtime
from pickwise.sources import bindings, text
from pickwise.streaming import StreamRecsJob, read_stream_recs, text_messages
from tests.conftest import SF_SMALL

CUT = 1706486400


def _inputs(spark):
    ratings = bindings.ratings_events(spark, SF_SMALL)
    sims = item_cf.item_similarity(ratings).filter(F.col("score") > schemas.SIMILARITY_THRESHOLD)
    return ratings.filter(F.col("time_stamp") < CUT), ratings.filter(F.col("time_stamp") >= CUT), sims


def _as_dict(df):
    return {r.user_id: [(x.product_id, round(x.score, 9)) for x in r.recs] for r in df.collect()}


def _write_messages(df, path, extra=()):
    lines = [r.value for r in text.format_rating_lines(df, sep="|").collect()] + list(extra)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_equals_batch_function_and_counts_malformed(spark, tmp_dir):
    history, batch, sims = _inputs(spark)
    _write_messages(batch, f"{tmp_dir}/in/part-0.txt", extra=["x|1|5.0|0", "1|2|3"])
    job = StreamRecsJob(spark, f"{tmp_dir}/state", history, sims)
    q = job.start(text_messages(spark, f"{tmp_dir}/in"), f"{tmp_dir}/ckpt", available_now=True)
    q.awaitTermination(300)
    got = _as_dict(read_stream_recs(spark, f"{tmp_dir}/state"))
    want = _as_dict(realtime.stream_recs(history, batch, sims))
    assert got == want and len(want) > 0
    assert sum(job.malformed.values()) == 2


def test_replayed_batch_changes_nothing_and_later_batch_wins(spark, tmp_dir):
    history, batch, sims = _inputs(spark)
    b1 = batch.filter(F.col("time_stamp") < CUT + 43200)
    b2 = batch.filter(F.col("time_stamp") >= CUT + 43200)
    job = StreamRecsJob(spark, f"{tmp_dir}/state", history, sims)
    m1 = text.format_rating_lines(b1, sep="|")
    m2 = text.format_rating_lines(b2, sep="|")
    job.process(m1, 0)
    job.process(m2, 1)
    first = _as_dict(read_stream_recs(spark, f"{tmp_dir}/state"))
    job.process(m2, 1)  # replay of the last batch
    assert _as_dict(read_stream_recs(spark, f"{tmp_dir}/state")) == first
    want2 = _as_dict(realtime.stream_recs(history.unionByName(b1), b2, sims))
    want1 = _as_dict(realtime.stream_recs(history, b1, sims))
    expected = {**want1, **want2}
    assert first == expected
    assert set(want1) & set(want2)  # some user is in both batches


def test_batch_reads_only_touched_user_buckets(spark, tmp_dir):
    history, batch, sims = _inputs(spark)
    job = StreamRecsJob(spark, f"{tmp_dir}/state", history, sims, buckets=16)
    job.prepare()
    plan = job._history(0, [3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [user_bucket" in plan and "IN (3,5)" in plan
    got = {r.user_id for r in job._history(0, [3, 5]).select("user_id").distinct().collect()}
    want = {r.user_id for r in history.select("user_id").distinct().collect()
            if r.user_id is not None}
    assert got and got < want


def test_only_malformed_messages_give_empty_recs(spark, tmp_dir):
    history, _, sims = _inputs(spark)
    job = StreamRecsJob(spark, f"{tmp_dir}/state", history, sims, buckets=4)
    job.process(spark.createDataFrame([("x|1|5.0|0",), ("1|2",)], "value string"), 0)
    assert job.malformed[0] == 2
    assert read_stream_recs(spark, f"{tmp_dir}/state").count() == 0


def test_new_checkpoint_opens_a_new_epoch(spark, tmp_dir):
    """Batch ids start again at 0; the later run still wins, and sees the earlier ratings."""
    history, batch, sims = _inputs(spark)
    b1 = batch.filter(F.col("time_stamp") < CUT + 43200)
    b2 = batch.filter(F.col("time_stamp") >= CUT + 43200)
    for n, b in enumerate((b1, b2)):
        _write_messages(b, f"{tmp_dir}/in{n}/part-0.txt")
        job = StreamRecsJob(spark, f"{tmp_dir}/state", history, sims)
        job.start(text_messages(spark, f"{tmp_dir}/in{n}"), f"{tmp_dir}/ckpt{n}", available_now=True).awaitTermination(300)
        assert job.epoch == n + 1
    want = {**_as_dict(realtime.stream_recs(history, b1, sims)),
            **_as_dict(realtime.stream_recs(history.unionByName(b1), b2, sims))}
    assert _as_dict(read_stream_recs(spark, f"{tmp_dir}/state")) == want
    again = StreamRecsJob(spark, f"{tmp_dir}/state", history, sims)
    again._open_epoch(f"{tmp_dir}/ckpt1")  # a checkpoint with progress goes on in its epoch
    assert again.epoch == 2


def test_files_stay_bounded_and_results_do_not_change(spark, tmp_dir):
    history, batch, sims = _inputs(spark)
    rows = batch.orderBy("time_stamp", "user_id", "product_id").limit(120).collect()
    counts, states = [], []
    for name, every in (("plain", 10**9), ("compact", 4)):
        job = StreamRecsJob(spark, f"{tmp_dir}/{name}", history, sims, buckets=2, compact_every=every)
        for n in range(12):
            part = spark.createDataFrame(rows[n * 10:n * 10 + 10], schemas.RATING)
            job.process(text.format_rating_lines(part, sep="|"), n)
        states.append(_as_dict(read_stream_recs(spark, f"{tmp_dir}/{name}")))
        counts.append(sum(f.endswith(".parquet") for _, _, fs in os.walk(f"{tmp_dir}/{name}/ratings_log") for f in fs))
    assert states[0] == states[1]
    assert counts[1] <= counts[0] / 2  # only the batches since the last compaction are left


def test_unfinished_history_is_written_again(spark, tmp_dir):
    history, _, sims = _inputs(spark)
    job = StreamRecsJob(spark, f"{tmp_dir}/state", history, sims, buckets=2)
    job.prepare()
    os.remove(f"{tmp_dir}/state/history/_SUCCESS")  # as after a crash in the commit
    StreamRecsJob(spark, f"{tmp_dir}/state", history, sims, buckets=2).prepare()
    assert os.path.exists(f"{tmp_dir}/state/history/_SUCCESS")
