"""What the book's plans ship and hold, whatever the number of users and products."""

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from tierbook.operators.book import feature_book_one_stage, make_spec
from tierbook.operators.books import feature_books
from tierbook.operators.joins import salted_left_join
from tierbook.plans import gold
from tierbook.plans.gold import build_book
from tierbook.sources import testdata as td

SPEC = make_spec((("A", "a"), ("B", "b")), (("X", "x"),))


def _sales(spark):
    rows = [
        (user, p, Decimal(amount), method, ref, dt.date(2001, 7, 1))
        for user, p, amount, method, ref in [
            (1, 1, "2.50", "X", "20010731"), (1, 1, "2.50", "X", "20010731"), (1, 2, "4.00", "Y", "20010401"),
            (None, 1, "7.00", "X", "20010630"), (2, None, "1.00", "X", "bad"), (2, 9, "3.00", None, None),
        ]
    ]
    return spark.createDataFrame(rows, "user_id long, product_id long, amount decimal(18,2), payment_method string, ref string, day date")


def _products(spark):
    return spark.createDataFrame([(1, "A"), (2, "B"), (2, "B"), (None, "A"), (3, None)], "product_id long, product_category string")


def _wide_aggregates(plan: str) -> list[str]:
    return [line for line in re.findall(r"(?:Hash|Sort)Aggregate\(keys?=\[user_id.*", plan) if "CASE WHEN" in line]


def test_no_task_holds_the_wide_rows_of_its_users(spark):
    enriched = _sales(spark).withColumn("product_category", F.lit("A"))
    for book in (
        feature_book_one_stage(enriched, SPEC, "2001-07-31", "r", "t"),
        feature_books(enriched, SPEC, ["2001-06-30", "2001-07-31"], "t"),
        feature_books(enriched, SPEC, ["2001-06-30", "2001-07-31"], "t", past_only=False),
        build_book(_sales(spark), _products(spark), SPEC, "2001-07-31", "r", "t", latest_sales=False, latest_products=False, max_broadcast_rows=0),
    ):
        wide = _wide_aggregates(plan_text(book, "simple"))
        assert wide and all(line.startswith("SortAggregate") for line in wide), wide


def test_book_above_the_broadcast_bound_ships_every_sale_twice_only(spark):
    options = dict(latest_sales=False, latest_products=False)
    book = build_book(td.sales(spark, SF_SMALL), td.products(spark, SF_SMALL), td.testdata_spec(), td.AS_OF, "r", "t", max_broadcast_rows=0, **options)
    shipped = re.findall(r"hashpartitioning\(((?:user_id|product_id)[^)]*)\)", plan_text(book, "simple"))
    keys = sorted(re.sub(r"#\d+L?", "", s).rsplit(",", 1)[0] for s in shipped)
    assert keys == ["product_id, _salt", "product_id, _salt", "user_id"]  # sales and products for the join, then the sales


def test_null_users_products_and_duplicate_products_above_the_bound(spark):
    options = dict(latest_sales=False, latest_products=False)
    books = [
        build_book(_sales(spark), _products(spark), SPEC, "2001-07-31", "r", "t", max_broadcast_rows=bound, method=method, **options)
        for bound in (0, 100) for method in ("two_stage", "one_stage")
    ]
    first = sorted(map(tuple, books[0].collect()), key=str)
    assert len(first) == 3
    for other in books[1:]:
        assert sorted(map(tuple, other.collect()), key=str) == first
    by_user = {r.user_id: r for r in books[0].collect()}
    assert by_user[1].qtd_pcat_a == 2 and by_user[1].qtd_pcat_b == 2 and by_user[1].sum_pcat_b == 8.0
    assert by_user[None].sum_pm_x_u3m == 7.0 and by_user[2].qtd_pm_x == 1 and by_user[2].qtd_pm_x_u12m is None


def test_equal_rows_of_a_hot_key_take_several_salts(spark):
    equal = spark.range(4000).repartition(8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    joined = salted_left_join(equal, spark.createDataFrame([(1, "d")], "k int, d string"), "k")
    assert joined.where("d = 'd'").count() == 4000
    plan = plan_text(joined)
    assert "SPARK_PARTITION_ID()" in plan


def test_books_of_many_dates_hash_no_users(spark):
    enriched = _sales(spark).withColumn("product_category", F.when(F.col("product_id") == 1, "A").otherwise("B"))
    tasks = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    for past_only in (True, False):
        plan = plan_text(feature_books(enriched, SPEC, ["2001-06-30", "2001-07-31"], "t", past_only=past_only), "simple")
        assert re.findall(r"hashpartitioning\(user_id#\d+L?, (\d+)\)", plan) == [str(tasks)]
        assert not re.findall(r"(?:HashAggregate|ObjectHashAggregate)\(keys?=\[user_id", plan)


def test_books_of_a_hot_user_count_every_sale(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("user_id"), F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("amount"),
        F.lit("20010615").alias("ref"), F.lit("A").alias("product_category"), F.lit("X").alias("payment_method"),
    )
    books = {(r.user_id, r.ref): r for r in feature_books(rows, SPEC, ["2001-06-30", "2001-07-31"], "t").collect()}
    assert len(books) == 2 * 1001
    assert books[(-1, "20010731")].qtd_pcat_a_u1m == 2000 and books[(-1, "20010630")].sum_pm_x == 2000.0


def test_many_products_are_broadcast_and_every_sale_shipped_once(spark, monkeypatch):
    options = dict(latest_sales=False, latest_products=False)
    args = (_products(spark), SPEC, "2001-07-31", "r", "t")
    want = sorted(map(tuple, build_book(_sales(spark), *args, **options).collect()), key=str)
    monkeypatch.setattr(gold, "MAX_COMBINED_PRODUCTS", 2)
    book = build_book(_sales(spark), *args, **options)
    shipped = re.findall(r"hashpartitioning\((\w+)", plan_text(book, "simple"))
    assert shipped == ["user_id"], shipped
    assert sorted(map(tuple, book.collect()), key=str) == want
    # above the broadcast bound too the result is the same
    salted = build_book(_sales(spark), *args, max_broadcast_rows=4, **options)
    assert "_salt" in plan_text(salted, "simple")
    assert sorted(map(tuple, salted.collect()), key=str) == want


def test_a_million_and_a_half_products_are_broadcast(spark):
    products = spark.range(1_500_000).select(F.col("id").alias("product_id"), F.lit("A").alias("product_category"))
    book = build_book(_sales(spark), products, SPEC, "2001-07-31", "r", "t", latest_sales=False, latest_products=False)
    assert re.findall(r"hashpartitioning\((\w+)", plan_text(book, "simple")) == ["user_id"]
