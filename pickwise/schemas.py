"""Record types of the recommendation tables, as Spark schemas."""

from pyspark.sql import types as T

PRODUCT = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("tags", T.StringType()),
])

# time_stamp is epoch seconds.
RATING = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("time_stamp", T.LongType()),
])

RECOMMENDATION = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

RECS = T.ArrayType(RECOMMENDATION)

USER_RECS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("recs", RECS),
])

PRODUCT_RECS = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("recs", RECS),
])

# Long-form similarity: one row per ordered pair.
SIMILARITY = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("rec_product_id", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

# Fixed values that must equal the reference jobs' settings.
SIMILARITY_THRESHOLD = 0.6      # cosine and stream similarity cut, strict ">"
USER_MAX_RECOMMENDATION = 20    # ALS user recs per user
ITEM_CF_MAX_RECOMMENDATION = 10  # item-CF recs per product
MAX_USER_RATINGS_NUM = 20       # recent ratings read per user in the stream
MAX_SIM_PRODUCTS_NUM = 20       # candidates per trigger product in the stream
BONUS_SCORE_CUTOFF = 3.0        # a recent score above this is a bonus, else a penalty
TF_NUM_FEATURES = 800           # HashingTF width for tag TF-IDF
ALS_RANK, ALS_MAX_ITER, ALS_REG = 50, 5, 0.01
ALS_GRID_RANKS = (100, 200, 250)
ALS_GRID_REGS = (1.0, 0.1, 0.01, 0.001)
ALS_SPLIT = (0.8, 0.2)
ALS_SPLIT_SEED = 100
PRODUCT_FIELD_SEPARATOR = "^"
RATING_FIELD_SEPARATOR = ","
STREAM_FIELD_SEPARATOR = "|"
TAG_SEPARATOR = "|"
