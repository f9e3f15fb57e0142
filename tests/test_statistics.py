from pickwise import schemas
from pickwise.functions.columns import year_month
from pickwise.operators import statistics


def _ratings(spark, rows):
    return spark.createDataFrame(rows, schemas.RATING)


def test_year_month_is_utc_whatever_the_session_zone(spark):
    df = spark.createDataFrame([(1395676800,), (1704067199,), (0,)], "t long")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        got = [r[0] for r in df.select(year_month("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [201403, 202312, 197001]


def test_statistics_counts_order_and_average(spark):
    r = _ratings(spark, [(1, 10, 5.0, 1395676800), (2, 10, 3.0, 1395676800),
                         (1, 11, 4.0, 1398268800), (3, 12, 1.0, 1398268800)])
    assert [tuple(x) for x in statistics.rate_more_products(r).collect()] == [
        (10, 2), (11, 1), (12, 1)]
    assert [tuple(x) for x in statistics.rate_more_recently_products(r).collect()] == [
        (201404, 11, 1), (201404, 12, 1), (201403, 10, 2)]
    avg = {x.product_id: x.avg for x in statistics.average_products(r).collect()}
    assert avg == {10: 4.0, 11: 4.0, 12: 1.0}
    first = statistics.average_products(r).first()
    assert first.product_id == 10  # tie on 4.0 broken by product id


def test_plan_pushes_projection_to_scan(spark):
    from pickwise.sources import bindings
    from tests.conftest import SF_SMALL
    plan = statistics.rate_more_products(bindings.ratings_orders(spark, SF_SMALL))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in text and "o_totalprice" not in text
