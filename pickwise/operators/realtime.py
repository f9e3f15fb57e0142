"""Real-time re-ranking of a user's recommendations from a batch of new ratings.

For each user in the batch, the newest rating is the trigger. Then:
1. recents: the user's newest k ratings from the rating log (history plus
   this batch, so the trigger is among them);
2. candidates: products similar to the trigger product, minus every product
   the user had rated before the batch and the trigger, best k by similarity;
   rated products come as rating rows, as bitmaps per user, or both;
3. score of candidate c: mean over recents r with sim(r, c) > t of
   sim(r, c) * score(r), plus log10(#bonus) minus log10(#penalty), where a
   recent with score > 3 is a bonus and otherwise a penalty; a missing count
   counts as 1 (log 0).

All steps are set-at-a-time joins over the whole batch. The rating log and
the similarity table can be far larger than a batch, so they are only ever
semi-joined against small per-batch sets (users, candidate pairs); Spark
broadcasts those sets when it measures them as small, and the large side is
then filtered in place instead of shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise import schemas
from pickwise.functions.columns import above, log10_count
from pickwise.operators.topk import to_recs, top_k

# Exact sets of rated products: one row per user and 32,768 consecutive product ids.
RATED = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("part", T.LongType()),
    T.StructField("bits", T.BinaryType()),
])

PART_BITMAPS = 1 << 14  # bitmaps of one task, 64 MB


def rated_bitmaps(ratings: DataFrame, *keys: str) -> DataFrame:
    """(*keys, user_id, part, bits): the products of each user as bitmaps (``bitmap_construct_agg``).

    Rows travel, not bitmaps of 4 KB, which shrink in a shuffle and would be
    gathered by their small size: without ``keys`` the rows are dealt here, into
    parts sized by the bitmaps they become; with ``keys`` the caller deals them.
    """
    placed = ratings.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull()).select(
        *keys, "user_id", F.bitmap_bucket_number("product_id").alias("part"),
        F.bitmap_bit_position("product_id").alias("bit"))
    if not keys:
        bitmaps = placed.agg(F.approx_count_distinct(F.struct("user_id", "part")).alias("n")).first()["n"]
        least = int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = placed.repartition(max(least, -(-bitmaps // PART_BITMAPS)), "user_id", "part")
    return placed.groupBy(*keys, "user_id", "part").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Bitmaps of one user and part, united."""
    return bitmaps.groupBy(*keys, "user_id", "part").agg(F.bitmap_or_agg("bits").alias("bits"))


def _bit_set(bits: str, position: str) -> Column:
    """Whether a bitmap holds the bit at a position (lowest bit of the first byte is 0)."""
    return F.expr(f"getbit(cast(conv(hex(substring({bits}, cast({position} div 8 as int) + 1, 1)), 16, 10) as int), "
                  f"cast({position} % 8 as int)) = 1")


# Newest first; ties on the second broken by product id then score (both
# descending) so that the order is total.
def newest_first() -> list:
    return [F.desc("time_stamp"), F.desc("product_id"), F.desc("score")]


def latest_per_user(batch: DataFrame) -> DataFrame:
    """The trigger of each user: (user_id, product_id, score, time_stamp)."""
    return top_k(batch, ["user_id"], newest_first(), 1).drop("rank")


def recent_ratings(log: DataFrame, users: DataFrame,
                   k: int = schemas.MAX_USER_RATINGS_NUM) -> DataFrame:
    """Newest k ratings of each given user: (user_id, product_id, score)."""
    mine = log.join(users.select("user_id"), "user_id", "left_semi")
    return top_k(mine, ["user_id"], newest_first(), k).select("user_id", "product_id", "score")


def candidate_products(triggers: DataFrame, sims: DataFrame, history: DataFrame | None,
                       k: int = schemas.MAX_SIM_PRODUCTS_NUM, rated: DataFrame | None = None) -> DataFrame:
    """Top-k products similar to each trigger: (user_id, product_id, sim).

    Left out are the products the user had rated before this batch, and the
    trigger itself. Those before the batch are the rows of ``history`` and the
    bits of ``rated`` (user_id, part, bits); either may hold all or some.
    """
    similar = (triggers.select("user_id", F.col("product_id").alias("trigger"))
               .join(sims.select(F.col("product_id").alias("trigger"),
                                 F.col("rec_product_id").alias("product_id"),
                                 F.col("score").alias("sim")), "trigger")
               .drop("trigger"))
    pairs = similar.select("user_id", "product_id")
    own = triggers.select("user_id", "product_id")
    if history is not None:
        own = own.unionByName(history.select("user_id", "product_id"))
    known = own.join(pairs, ["user_id", "product_id"], "left_semi")
    if rated is not None:
        placed = pairs.distinct().withColumn("part", F.bitmap_bucket_number("product_id")).withColumn(
            "bit", F.bitmap_bit_position("product_id"))
        known = known.unionByName(rated.select("user_id", "part", "bits").join(placed, ["user_id", "part"])
                                  .filter(_bit_set("bits", "bit")).select("user_id", "product_id"))
    unrated = similar.join(known, ["user_id", "product_id"], "left_anti")
    return top_k(unrated, ["user_id"], [F.desc("sim"), F.asc("product_id")], k).drop("rank")


def score_candidates(recents: DataFrame, candidates: DataFrame, sims: DataFrame,
                     threshold: float = schemas.SIMILARITY_THRESHOLD,
                     cutoff: float = schemas.BONUS_SCORE_CUTOFF) -> DataFrame:
    """(user_id, product_id, score) for candidates with at least one similar recent."""
    r = recents.select("user_id", F.col("product_id").alias("recent"), F.col("score").alias("rscore"))
    c = candidates.select("user_id", "product_id")
    s = sims.select(F.col("product_id").alias("recent"), F.col("rec_product_id").alias("product_id"),
                    F.col("score").alias("sim"))
    hits = r.join(c, "user_id").join(s, ["recent", "product_id"]).filter(above("sim", threshold))
    agg = hits.groupBy("user_id", "product_id").agg(
        F.avg(F.col("sim") * F.col("rscore")).alias("base"),
        F.count_if(F.col("rscore") > cutoff).alias("incr"),
        F.count_if(~(F.col("rscore") > cutoff)).alias("decr"))
    score = F.col("base") + log10_count("incr") - log10_count("decr")
    return agg.select("user_id", "product_id", score.alias("score"))


def stream_recs_long(history: DataFrame, batch: DataFrame, sims: DataFrame,
                     recent_k: int = schemas.MAX_USER_RATINGS_NUM,
                     candidate_k: int = schemas.MAX_SIM_PRODUCTS_NUM,
                     threshold: float = schemas.SIMILARITY_THRESHOLD,
                     rated: DataFrame | None = None) -> DataFrame:
    """Scores for one batch in long form: (user_id, product_id, score).

    With ``rated``, bitmaps of rated products, ``history`` need only hold the
    ratings that can be among a user's newest and those the bitmaps lack.
    """
    cols = ["user_id", "product_id", "score", "time_stamp"]
    log = history.select(cols).unionByName(batch.select(cols))
    triggers = latest_per_user(batch.select(cols))
    recents = recent_ratings(log, triggers, recent_k)
    cands = candidate_products(triggers, sims, history, candidate_k, rated)
    return score_candidates(recents, cands, sims, threshold)


def stream_recs(history: DataFrame, batch: DataFrame, sims: DataFrame, **kw) -> DataFrame:
    """UserRecs for every user of the batch: (user_id, recs), recs best first, maybe empty."""
    scores = stream_recs_long(history, batch, sims, **kw)
    # at most candidate_k entries per user, so the nested list is bounded
    nested = to_recs(scores, "user_id", item="product_id", rank_col=None)
    users = batch.select("user_id").distinct()
    empty = F.array().cast(schemas.RECS)
    return users.join(nested, "user_id", "left").select(
        "user_id", F.coalesce(F.col("recs"), empty).alias("recs"))
