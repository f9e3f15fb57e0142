"""End-to-end batch jobs: read named tables, run operators, overwrite named tables.

Table names follow the reference application (Product, Rating, RateMoreProducts,
RateMoreRecentlyProducts, AverageProducts, UserRecs, ProductRecs, CommenRecs,
ItemCFRecs, StreamRecs). Tables are parquet folders under one base folder.
Bounded lists (UserRecs: top 20, ItemCFRecs: top 10) are stored nested as
(key, recs array<struct<product_id, score>>); the uncapped similarity tables
(ProductRecs, CommenRecs) are stored in long form (product_id, rec_product_id,
score) or, with ``--chunk n``, as lists cut into numbered chunks (product_id,
part, recs) of at most n entries, so that no row holds an unbounded list.
Every table is replaced by a new version at once; a job that fails leaves the
former one.

    python -m pickwise.plans.jobs load --base /data/reco --products p.csv --ratings r.csv
    python -m pickwise.plans.jobs statistics --base /data/reco
    python -m pickwise.plans.jobs offline --base /data/reco
    python -m pickwise.plans.jobs content --base /data/reco
    python -m pickwise.plans.jobs itemcf --base /data/reco
    python -m pickwise.plans.jobs tune --base /data/reco
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from pickwise import schemas
from pickwise.operators import als, content, item_cf, statistics
from pickwise.operators.topk import to_rec_chunks, to_recs
from pickwise.session import get_session, input_bytes, size_shuffle_partitions
from pickwise.sources.tables import current_path, read_table, write_table
from pickwise.sources.text import read_products, read_ratings

PRODUCT, RATING = "Product", "Rating"
RATE_MORE_PRODUCTS = "RateMoreProducts"
RATE_MORE_RECENTLY_PRODUCTS = "RateMoreRecentlyProducts"
AVERAGE_PRODUCTS = "AverageProducts"
USER_RECS, PRODUCT_RECS = "UserRecs", "ProductRecs"
CONTENT_RECS, ITEM_CF_RECS = "CommenRecs", "ItemCFRecs"
ALS_GRID = "ALSGrid"


def _ratings(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, RATING, schemas.RATING)


def load_job(spark: SparkSession, base: str, products_path: str, ratings_path: str) -> None:
    write_table(read_products(spark, products_path), base, PRODUCT)
    write_table(read_ratings(spark, ratings_path), base, RATING)


def statistics_job(spark: SparkSession, base: str) -> None:
    ratings = _ratings(spark, base)
    write_table(statistics.rate_more_products(ratings), base, RATE_MORE_PRODUCTS)
    write_table(statistics.rate_more_recently_products(ratings), base, RATE_MORE_RECENTLY_PRODUCTS)
    write_table(statistics.average_products(ratings), base, AVERAGE_PRODUCTS)


def _uncapped(recs: DataFrame, chunk: int | None) -> DataFrame:
    return recs if chunk is None else to_rec_chunks(recs, "product_id", chunk)


def offline_job(spark: SparkSession, base: str, seed: int | None = None, exclude_rated: bool = False,
                chunk: int | None = None) -> None:
    """UserRecs and ProductRecs; with ``exclude_rated``, users are not offered what they have rated."""
    ratings = _ratings(spark, base)
    model = als.train_als(ratings, seed=seed)
    recs = als.als_user_recs(model, exclude_rated=ratings if exclude_rated else None)
    write_table(to_recs(recs, "user_id", item="product_id"), base, USER_RECS)
    write_table(_uncapped(als.als_product_recs(model), chunk), base, PRODUCT_RECS)


def tune_job(spark: SparkSession, base: str) -> DataFrame:
    grid = als.als_tune(_ratings(spark, base))
    write_table(grid, base, ALS_GRID)
    return read_table(spark, base, ALS_GRID).orderBy("rmse").limit(1)


def content_job(spark: SparkSession, base: str, num_features: int | None = schemas.TF_NUM_FEATURES,
                k: int | None = None, chunk: int | None = None) -> None:
    """All similar products in long form or in chunks, or with ``k`` the best k of each product as one nested list."""
    products = read_table(spark, base, PRODUCT, schemas.PRODUCT)
    recs = content.content_similarity(products, num_features, k=k)
    write_table(_uncapped(recs, chunk) if k is None else to_recs(recs, "product_id"), base, CONTENT_RECS)


def item_cf_job(spark: SparkSession, base: str) -> None:
    ratings = _ratings(spark, base)
    # the pair rows of light users outgrow the input: size for them, 40 bytes each
    size_shuffle_partitions(spark, 40 * item_cf.pair_rows(ratings), expansion=1.0)
    write_table(to_recs(item_cf.item_cf_recs(ratings), "product_id"), base, ITEM_CF_RECS)


def stream_job(spark: SparkSession, base: str, servers: str, topic: str, state_dir: str,
               checkpoint_location: str):
    """Starts the streaming re-ranker over Kafka with ProductRecs as similarity."""
    from pickwise.streaming import StreamRecsJob, kafka_messages
    sims = read_table(spark, base, PRODUCT_RECS, schemas.SIMILARITY)
    job = StreamRecsJob(spark, state_dir, _ratings(spark, base), sims)
    return job.start(kafka_messages(spark, servers, topic), checkpoint_location)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="pickwise.plans.jobs")
    ap.add_argument("job", choices=["load", "statistics", "offline", "tune", "content", "itemcf", "stream"])
    ap.add_argument("--base", required=True)
    ap.add_argument("--k", type=int, help="content: keep the best k per product, as nested lists")
    ap.add_argument("--chunk", type=int, help="offline, content: store uncapped lists in chunks of this length")
    ap.add_argument("--exclude-rated", action="store_true", help="offline: leave out what a user has rated")
    ap.add_argument("--products")
    ap.add_argument("--ratings")
    ap.add_argument("--servers")
    ap.add_argument("--topic", default="recommender")
    ap.add_argument("--state")
    ap.add_argument("--checkpoint")
    a = ap.parse_args(argv)
    spark = get_session(f"pickwise-{a.job}")
    inputs = ([a.products, a.ratings] if a.job == "load"
              else [current_path(spark, a.base, PRODUCT if a.job == "content" else RATING)])
    size_shuffle_partitions(spark, input_bytes(spark, [p for p in inputs if p]))
    if a.job == "load":
        load_job(spark, a.base, a.products, a.ratings)
    elif a.job == "statistics":
        statistics_job(spark, a.base)
    elif a.job == "offline":
        offline_job(spark, a.base, exclude_rated=a.exclude_rated, chunk=a.chunk)
    elif a.job == "tune":
        tune_job(spark, a.base).show()
    elif a.job == "content":
        content_job(spark, a.base, k=a.k, chunk=a.chunk)
    elif a.job == "itemcf":
        item_cf_job(spark, a.base)
    elif a.job == "stream":
        stream_job(spark, a.base, a.servers, a.topic, a.state, a.checkpoint).awaitTermination()


if __name__ == "__main__":
    main()
