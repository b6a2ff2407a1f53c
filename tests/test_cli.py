"""The layer jobs through the command line, as a scheduler would run them."""

import json

from tierbook.__main__ import main


def test_layer_jobs_end_to_end(spark, lake, capsys):
    root = lake.bronze.rsplit("/", 1)[0] + "/cli"
    src = f"{root}/sources"
    spark.createDataFrame([("u1", "Ana", "A")], "user_id string, user_name string, segment string").write.parquet(f"{src}/users")
    spark.createDataFrame([("p1", "book", "Livros")], "product_id string, product_des string, product_category string").write.parquet(f"{src}/products")
    spark.createDataFrame(
        [("t1", "u1", "p1", "2024-09-01", "10.00", "PIX"), ("t2", "u1", "p9", "2024-09-02", "4.00", "Boleto")],
        "transaction_id string, user_id string, product_id string, dat_creation string, amount string, payment_method string",
    ).write.parquet(f"{src}/sales")

    for i, subject in enumerate(("users", "products", "sales")):
        main(["bronze", "--subject", subject, "--lake", root, "--ref", "20240930", "--ts", f"2024093012000{i}", "--parquet", f"{src}/{subject}"])
        main(["silver", "--subject", subject, "--lake", root, "--ts-proc", f"2024100108000{i}"])
    capsys.readouterr()

    main(["gold", "--lake", root, "--as-of", "2024-09-30", "--ts-proc", "20241001090000", "--when-ready"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"ran": True}
    # nothing new arrived since that book: the gate stays closed
    main(["gold", "--lake", root, "--as-of", "2024-09-30", "--ts-proc", "20241001100000", "--when-ready"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"ran": False}

    main(["ready", "--lake", root])
    state = [json.loads(l) for l in capsys.readouterr().out.strip().splitlines()]
    assert {s["assunto"] for s in state} == {"users", "products", "sales"} and not any(s["received"] for s in state)

    book = spark.read.parquet(f"{root}/0002_gold/book").collect()
    assert len(book) == 1
    row = book[0]
    assert row.qtd_pcat_livros == 1 and row.sum_pcat_livros == 10.0 and row.qtd_pm_boleto == 1


def test_arrivals_profiles_and_vacuum(spark, lake, capsys):
    from tierbook.sources.testdata import put_file

    root = lake.bronze.rsplit("/", 1)[0] + "/cli2"
    sources = {
        "users": spark.createDataFrame([("u1", "Ana", "A")], "user_id string, user_name string, segment string"),
        "products": spark.createDataFrame([("p1", "book", "Livros")], "product_id string, product_des string, product_category string"),
        "sales": spark.createDataFrame(
            [("t1", "u1", "p1", "2024-07-01", "10.00", "PIX"), ("t2", "u1", "p9", "2024-09-02", "4.00", "Boleto"), ("t3", "u1", "p9", "?", "4.00", "Boleto")],
            "transaction_id string, user_id string, product_id string, dat_creation string, amount string, payment_method string",
        ),
    }

    def out():
        return [json.loads(x) for x in capsys.readouterr().out.strip().splitlines() if x.startswith("{")]

    for subject, rows in sources.items():
        path = put_file(rows, f"{root}/0000_bronze/{subject}/{subject}_20240930_20240930120000.csv")
        main(["commit", "--subject", subject, "--lake", root, "--path", path])
        main(["stream", "--subject", subject, "--lake", root, "--ts-proc", "20241001080000"])
    out()
    main(["gate", "--lake", root, "--as-of", "2024-09-30"])
    main(["gate", "--lake", root, "--as-of", "2024-09-30"])
    assert out() == [{"firing": 1, "ts_proc": "20241001080000"}]
    assert spark.read.parquet(f"{root}/0002_gold/book").count() == 1

    main(["books", "--lake", root, "--dates", "2024-07-31,2024-09-30", "--ts-proc", "20241002000000", "--out", f"{root}/books", "--date-col", "dat_creation"])
    books = {str(r.ref): r for r in spark.read.parquet(f"{root}/books").collect()}
    assert (books["20240731"].qtd_pcat_livros, books["20240731"].qtd_pm_boleto) == (1, None) and books["20240930"].qtd_pm_boleto == 1

    main(["silver", "--subject", "sales", "--lake", root, "--ts-proc", "20241003080000"])
    out()
    main(["profile", "--subject", "sales", "--lake", root])
    assert {r["column"]: (r["null_shift"], r["rank_shift"]) for r in out()}["amount"] == (0.0, 0.0)

    main(["silver", "--subject", "sales", "--lake", root, "--ts-proc", "20241003080000"])
    capsys.readouterr()
    main(["vacuum", "--lake", root, "--hours", "-1"])
    assert capsys.readouterr().out.count("ts_proc=20241003080000") == 1
