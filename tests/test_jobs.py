from pyspark.sql import functions as F

from pickwise import schemas
from pickwise.plans import jobs
from pickwise.sources import bindings, read_table, text
from tests.conftest import SF_SMALL


def test_jobs_write_named_tables(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    text.format_product_lines(bindings.products_from_part(spark, SF_SMALL)).write.text(f"{src}/products")
    ratings = bindings.ratings_orders(spark, SF_SMALL)
    ratings.select(F.concat_ws(",", *[F.col(c).cast("string") for c in ratings.columns])).write.text(
        f"{src}/ratings")
    base = f"{tmp_dir}/tables"
    jobs.load_job(spark, base, f"{src}/products", f"{src}/ratings")
    assert read_table(spark, base, jobs.RATING, schemas.RATING).count() == ratings.count()
    jobs.statistics_job(spark, base)
    jobs.item_cf_job(spark, base)
    jobs.content_job(spark, base)
    top = read_table(spark, base, jobs.RATE_MORE_PRODUCTS).first()
    assert top["count"] >= 1
    nested = read_table(spark, base, jobs.ITEM_CF_RECS, schemas.PRODUCT_RECS)
    assert nested.count() > 0
    assert all(1 <= len(r.recs) <= 10 for r in nested.collect())
    assert read_table(spark, base, jobs.CONTENT_RECS, schemas.SIMILARITY).count() > 0
    jobs.content_job(spark, base, k=3)
    lists = read_table(spark, base, jobs.CONTENT_RECS, schemas.PRODUCT_RECS).collect()
    assert lists and all(1 <= len(r.recs) <= 3 for r in lists)


def test_shuffle_partitions_follow_input_size(spark):
    from pickwise.session import input_bytes, size_shuffle_partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = input_bytes(spark, [f"{SF_SMALL}/lineitem.parquet"])
        assert n > 0
        assert size_shuffle_partitions(spark, 100 << 30) == 3200  # 100 GiB * 4 / 128 MiB
        assert size_shuffle_partitions(spark, 1) == 3200  # never lowered
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_to_recs_and_back(spark):
    from pickwise.operators.topk import from_recs, to_recs
    long = spark.createDataFrame([(1, 7, 0.5, 2), (1, 9, 0.9, 1), (2, 3, 0.1, 1)],
                                 "product_id int, rec_product_id int, score double, rank int")
    nested = to_recs(long, "product_id")
    got = {r.product_id: [(x.product_id, x.score) for x in r.recs] for r in nested.collect()}
    assert got == {1: [(9, 0.9), (7, 0.5)], 2: [(3, 0.1)]}
    back = from_recs(nested, "product_id")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))
    by_score = to_recs(long.drop("rank"), "product_id", rank_col=None)
    assert {r.product_id: [x.product_id for x in r.recs] for r in by_score.collect()} == {1: [9, 7], 2: [3]}


def test_materialize_writes_under_the_configured_checkpoint_dir(spark):
    import re

    from pickwise.session import checkpoint_root, materialize

    def local(path):
        return re.sub(r"^file:/+", "/", path)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and local(checkpoint_root(spark)).startswith(configured)
    df = materialize(spark.range(5), "probe")
    files = df.inputFiles()
    assert files and all(local(f).startswith(configured) for f in files)
    assert df.count() == 5


def test_uncapped_lists_in_chunks(spark):
    from pickwise.operators.topk import to_rec_chunks
    long = spark.createDataFrame([(1, p, 1.0 / (1 + p % 7)) for p in range(25)] + [(2, 9, 0.5)],
                                 "product_id int, rec_product_id int, score double")
    rows = to_rec_chunks(long, "product_id", 10).collect()
    assert sorted((r.product_id, r.part, len(r.recs)) for r in rows) == [(1, 0, 10), (1, 1, 10), (1, 2, 5), (2, 0, 1)]
    whole = [(x.product_id, x.score) for r in sorted(rows, key=lambda r: (r.product_id, r.part)) for x in r.recs if r.product_id == 1]
    assert whole == sorted(((p, 1.0 / (1 + p % 7)) for p in range(25)), key=lambda x: (-round(x[1], 9), x[0]))
    assert to_rec_chunks(long.limit(0), "product_id", 10).count() == 0
