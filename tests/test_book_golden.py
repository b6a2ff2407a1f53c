"""Hand-made rows for the book's semantic decisions (spec of the published book)."""

from decimal import Decimal

import pytest

from tierbook.operators.book import REFERENCE_SPEC, literal_spec
from tierbook.plans.gold import build_book

AS_OF = "2024-09-30"
SALES_SCHEMA = (
    "transaction_id string, user_id string, product_id string, dat_creation date, "
    "amount decimal(18,2), payment_method string, ref string, ts_file_generation string, ts_proc string"
)
PRODUCTS_SCHEMA = "product_id string, product_des string, product_category string, ref string, ts_file_generation string, ts_proc string"

D = Decimal
SALES = [
    ("t1", "u1", "p1", None, D("9.50"), "PIX", "20240930"),  # age 0
    ("t2", "u1", "p1", None, D("100.25"), "PIX", "20240801"),  # age 1
    ("t3", "u1", "p2", None, D("10.00"), "Boleto", "20240731"),  # age 2, product listed twice
    ("t4", "u1", "p9", None, D("5.00"), "Cartao Credito", "20230830"),  # unmatched product, age 13
    ("t5", "u1", "p3", None, None, "Cartao Debito", "20250301"),  # unlisted category, NULL amount, future
    ("t6", "u1", "p4", None, D("7.00"), "pix", "20240930"),  # accent / case: no match anywhere
    ("t7", "u1", "p5", None, D("3.00"), "PIX", "202409"),  # malformed ref: whole history only
    ("t8", "u2", "p4", None, D("1.00"), "Dinheiro", "20240930"),  # matches nothing
    ("t9", None, "p1", None, D("1.00"), "PIX", "20240930"),  # NULL user is a group
    ("t10", "u3", "p1", None, D("20.00"), "PIX", "20231231"),  # age 9: literal-mode case
]
PRODUCTS = [
    ("p1", "book a", "Livros"),
    ("p2", "book b", "Livros"),
    ("p2", "book b (dup)", "Livros"),
    ("p3", "misc", "Outros"),
    ("p4", "phone", "Eletrônicos"),
    ("p5", "game", "Jogos"),
]


def _frames(spark):
    sales = spark.createDataFrame([(*r, r[6] + "000000", "20241001000000") for r in SALES], SALES_SCHEMA)
    products = spark.createDataFrame(
        [(*p, "20240930", "20240930000000", "20240930120000") for p in PRODUCTS], PRODUCTS_SCHEMA
    )
    return sales, products


def _book(spark, spec=REFERENCE_SPEC, **kw):
    sales, products = _frames(spark)
    df = build_book(sales, products, spec, AS_OF, "20240930", "20241001000000", latest_sales=False, **kw)
    return {r["user_id"]: r.asDict() for r in df.collect()}, df


@pytest.fixture(scope="module")
def book(spark):
    return _book(spark)[0]


def test_width_is_203(spark):
    _, df = _book(spark)
    assert len(df.columns) == 203
    assert df.columns[:3] == ["user_id", "ref", "ts_proc"]
    assert df.columns[3] == "qtd_pcat_livros" and df.columns[-1] == "avg_pm_boleto_u12m"


def test_category_counts_windows_and_fan_out(book):
    u1 = book["u1"]
    assert u1["qtd_pcat_livros"] == 4  # t1, t2, t3 twice (duplicate product row)
    assert u1["qtd_pcat_livros_u1m"] == 2
    assert u1["qtd_pcat_livros_u3m"] == 4
    assert u1["qtd_pcat_livros_u12m"] == 4
    assert u1["sum_pcat_livros"] == pytest.approx(129.75)
    assert u1["sum_pcat_livros_u1m"] == pytest.approx(109.75)
    assert u1["avg_pcat_livros"] == pytest.approx(129.75 / 4)


def test_min_max_are_numeric_not_lexical(book):
    assert book["u1"]["min_pcat_livros_u1m"] == 9.50
    assert book["u1"]["max_pcat_livros_u1m"] == 100.25


def test_unlisted_accent_and_case_never_match(book):
    u1 = book["u1"]
    assert u1["qtd_pcat_eletr"] is None
    assert u1["qtd_pcat_roupas"] is None
    assert u1["qtd_pm_pix"] == 3  # t1, t2, t7; not the lowercase 'pix'


def test_malformed_ref_only_in_whole_history(book):
    u1 = book["u1"]
    assert u1["qtd_pcat_jogos"] == 1
    assert u1["qtd_pcat_jogos_u12m"] is None


def test_unmatched_product_still_counts_for_payment(book):
    u1 = book["u1"]
    assert u1["qtd_pm_cc"] == 1 and u1["sum_pm_cc"] == 5.0
    assert u1["qtd_pm_cc_u12m"] is None  # age 13


def test_null_amount_counted_but_not_aggregated(book):
    u1 = book["u1"]
    assert u1["qtd_pm_cd"] == 1 and u1["qtd_pm_cd_u1m"] == 1  # future ref is "recent"
    assert u1["sum_pm_cd"] is None and u1["avg_pm_cd"] is None and u1["min_pm_cd"] is None


def test_no_match_is_null_not_zero(book):
    u2 = book["u2"]
    features = {k: v for k, v in u2.items() if k not in ("user_id", "ref", "ts_proc")}
    assert all(v is None for v in features.values())


def test_null_user_is_one_group(book):
    assert book[None]["qtd_pm_pix"] == 1


def test_literal_mode_reproduces_six_month_test(spark):
    default = _book(spark)[0]["u3"]
    literal = _book(spark, literal_spec(REFERENCE_SPEC))[0]["u3"]
    assert default["qtd_pcat_livros_u12m"] == 1 and literal["qtd_pcat_livros_u12m"] is None
    assert default["sum_pcat_livros_u12m"] == 20.0 and literal["sum_pcat_livros_u12m"] is None
    assert default["avg_pcat_livros_u12m"] == literal["avg_pcat_livros_u12m"] == 20.0
    assert default["qtd_pm_pix_u12m"] == literal["qtd_pm_pix_u12m"] == 1


@pytest.mark.parametrize(
    "kw",
    [dict(method="one_stage"), dict(max_broadcast_rows=0), dict(max_broadcast_rows=0, rows_per_task=1)],
    ids=["one_stage", "salted_shuffle_join", "salted_hot_keys"],
)
def test_plans_agree(spark, book, kw):
    other = _book(spark, **kw)[0]
    assert other == book
