"""Property checks of the book on generated rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierbook.operators.book import REFERENCE_SPEC, feature_book

CATS = ["Livros", "Roupas", "Eletronicos", "Jogos", "Outros", None]
PAYS = ["Cartao Debito", "PIX", "Cartao Credito", "Boleto", "Dinheiro", None]
REFS = ["20240930", "20240915", "20240801", "20240731", "20240601", "20240101", "20231001", "20230830", "20250101", "2024", None]

row = st.tuples(
    st.sampled_from(["u1", "u2", "u3", None]),
    st.sampled_from(CATS),
    st.sampled_from(PAYS),
    st.one_of(st.none(), st.decimals(min_value=0, max_value=10_000, places=2, allow_nan=False)),
    st.sampled_from(REFS),
)
SCHEMA = "user_id string, product_category string, payment_method string, amount decimal(18,2), ref string"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_one_stage_equals_two_stage_and_windows_nest(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    one = {r.user_id: r.asDict() for r in feature_book(df, REFERENCE_SPEC, "2024-09-30", "r", "t", method="one_stage").collect()}
    two = {r.user_id: r.asDict() for r in feature_book(df, REFERENCE_SPEC, "2024-09-30", "r", "t").collect()}
    assert one == two
    for book in two.values():
        for dim, labels in (("pcat", ["livros", "roupas", "eletr", "jogos"]), ("pm", ["cd", "pix", "cc", "boleto"])):
            for v in labels:
                counts = [book[f"qtd_{dim}_{v}{w}"] or 0 for w in ("_u1m", "_u3m", "_u6m", "_u12m", "")]
                assert counts == sorted(counts)
                lo, mean, hi = book[f"min_{dim}_{v}"], book[f"avg_{dim}_{v}"], book[f"max_{dim}_{v}"]
                if mean is not None:
                    assert lo <= mean + 1e-9 and mean <= hi + 1e-9
                    n_amount = sum(
                        1 for r in rows
                        if r[0] == book["user_id"] and r[3] is not None
                        and (r[1] if dim == "pcat" else r[2]) == {"livros": "Livros", "roupas": "Roupas", "eletr": "Eletronicos", "jogos": "Jogos", "cd": "Cartao Debito", "pix": "PIX", "cc": "Cartao Credito", "boleto": "Boleto"}[v]
                    )
                    assert abs(book[f"sum_{dim}_{v}"] - mean * n_amount) < 1e-6 * max(1.0, book[f"sum_{dim}_{v}"])
