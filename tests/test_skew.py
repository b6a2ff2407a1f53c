"""A third of all rows on one user and on one product: results stay exact,
the hot product is salted, and the hot user collapses before its shuffle."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierbook.operators.book import (
    book_stage_keys,
    combine_partials,
    feature_book,
    prepare_stage_input,
    to_partials,
)
from tierbook.operators.joins import SALT, SALTS, hot_keys, salted_left_join
from tierbook.sources import testdata as td

HOT_USER, HOT_PRODUCT = -1, -7


@pytest.fixture(scope="module")
def skewed(spark):
    sales = td.sales(spark, SF_SMALL)
    third = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0
    return (
        sales.withColumn("user_id", F.when(third, F.lit(HOT_USER).cast("long")).otherwise(F.col("user_id")))
        .withColumn("product_id", F.when(~third & (F.pmod(F.xxhash64("transaction_id", F.lit(1)), F.lit(2)) == 0),
                                         F.lit(HOT_PRODUCT).cast("long")).otherwise(F.col("product_id")))
    )


@pytest.fixture(scope="module")
def products(spark):
    p = td.products(spark, SF_SMALL)
    hot = spark.createDataFrame([(HOT_PRODUCT, "hot", "PROMO")], "product_id long, product_des string, product_category string")
    return p.select("product_id", "product_des", "product_category").unionByName(hot)


def test_hot_product_is_found_and_spread(spark, skewed, products):
    total = skewed.count()
    hot_rows = skewed.where(F.col("product_id") == HOT_PRODUCT).count()
    assert hot_rows / total > 0.25
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_task = -(-total // partitions)
    found = {r.product_id: r[SALTS] for r in hot_keys(skewed, "product_id").collect()}
    assert HOT_PRODUCT in found and len(found) < partitions
    assert found[HOT_PRODUCT] == -(-hot_rows // per_task)
    joined = salted_left_join(skewed, products.select("product_id", "product_category"), "product_id")
    plain = skewed.join(F.broadcast(products.select("product_id", "product_category")), "product_id", "left")
    assert joined.count() == plain.count() == total
    assert sorted(map(tuple, joined.select("transaction_id", "product_category").collect())) == sorted(
        map(tuple, plain.select("transaction_id", "product_category").collect())
    )


def test_salts_bound_rows_per_key_and_task(spark, skewed):
    # each (key, salt) group stays near a task's share, which bounds the number of hot keys too
    per_task = -(-skewed.count() // int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert hot_keys(skewed, "product_id", 1).count() < int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(skewed, "product_id", per_task))
    salted = skewed.join(hot, "product_id", "left").withColumn(
        SALT, F.coalesce(F.pmod(F.xxhash64(*[F.col(c) for c in skewed.columns]), F.col(SALTS)), F.lit(0))
    )
    sizes = salted.where(F.col("product_id") == HOT_PRODUCT).groupBy(SALT).count()
    stats = sizes.agg(F.count("*").alias("salts"), F.max("count").alias("largest")).first()
    hot_rows = skewed.where(F.col("product_id") == HOT_PRODUCT).count()
    assert stats.salts == -(-hot_rows // per_task)
    assert stats.largest <= 2 * per_task


def test_hot_user_collapses_to_bounded_partials(spark, skewed, products):
    spec = td.testdata_spec()
    enriched = skewed.join(F.broadcast(products.select("product_id", "product_category")), "product_id", "left")
    narrow = prepare_stage_input(enriched, spec, td.AS_OF)
    partials = combine_partials(to_partials(narrow, "amount"), book_stage_keys(spec))
    assert partials.where(F.col("user_id") == HOT_USER).count() <= 5 * 5 * 5


def test_plans_agree_under_skew(spark, skewed, products):
    spec = td.testdata_spec()
    enriched = skewed.join(F.broadcast(products.select("product_id", "product_category")), "product_id", "left")
    one = feature_book(enriched, spec, td.AS_OF, "r", "t", method="one_stage")
    two = feature_book(enriched, spec, td.AS_OF, "r", "t")
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_salted_join_plan_shuffles_on_key_and_salt(spark, skewed, products):
    from conftest import plan_text

    joined = salted_left_join(skewed, products.select("product_id", "product_category"), "product_id")
    plan = plan_text(joined)  # not executed: the static plan, before AQE's runtime choices
    import re

    assert re.search(r"hashpartitioning\(product_id#\d+L?, _salt#\d+", plan)
    assert "SortMergeJoin LeftOuter" in plan
    assert "BroadcastExchange" in plan  # the hot-key set (< shuffle partitions)
    assert "explode(sequence(0, (coalesce(_salts" in plan  # hot products replicated once per salt


def test_null_keys_are_spread_and_never_match(spark, skewed, products):
    third = F.pmod(F.xxhash64("transaction_id", F.lit(2)), F.lit(3)) == 0
    nulls = skewed.withColumn("product_id", F.when(third, F.lit(None).cast("long")).otherwise(F.col("product_id")))
    salts = {r.product_id: r[SALTS] for r in hot_keys(nulls, "product_id").collect()}
    assert salts.get(None, 1) > 1  # the NULL group is split, not sent to one task
    dim = products.select("product_id", "product_category")
    joined = salted_left_join(nulls, dim, "product_id")
    plain = nulls.join(F.broadcast(dim), "product_id", "left")
    got = sorted(map(tuple, joined.select("transaction_id", "product_id", "product_category").collect()), key=str)
    want = sorted(map(tuple, plain.select("transaction_id", "product_id", "product_category").collect()), key=str)
    assert got == want
    assert joined.where(F.col("product_id").isNull() & F.col("product_category").isNotNull()).count() == 0


def test_identical_sales_of_a_hot_product_use_several_salts(spark, skewed, products):
    """The book joins partial rows per user, product, payment and age: distinct, so the salt spreads them."""
    from conftest import plan_text
    from tierbook.plans.gold import build_book

    hot = skewed.withColumn("product_id", F.lit(HOT_PRODUCT).cast("long"))
    copies = hot.unionByName(hot).unionByName(hot)
    spec = td.testdata_spec()
    options = dict(latest_sales=False, latest_products=False)
    book = build_book(copies, products, spec, td.AS_OF, "r", "t", max_broadcast_rows=0, **options)
    plan = plan_text(book)
    assert "SortMergeJoin LeftOuter" in plan and "transaction_id" not in plan
    plain = build_book(copies, products, spec, td.AS_OF, "r", "t", **options)
    assert book.exceptAll(plain).count() == 0 and plain.exceptAll(book).count() == 0
