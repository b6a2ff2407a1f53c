"""Gold job: latest sales and product batches -> enrichment -> feature book.

Plan shape (two-stage book, product snapshot under the broadcast bound):
scan sales (pruned to the latest batch / lookback) -> broadcast-hash join to
the product categories -> partial aggregate by (user, category key, payment
key, age bucket) -> shuffle (narrow, map-side combined) -> final -> shuffle
by user (<= 125 narrow rows per user) -> wide pivot -> write.

With more than ``MAX_COMBINED_PRODUCTS`` products the sales (four columns) go
to their user as they are, in one exchange: in tables of that size combining
them before it saves less than shipping five measures a row and a second
exchange cost.

Above the broadcast bound the sales (five columns) meet the products in a
sort-merge join whose hot products (more rows than one balanced task) are each
salted over enough tasks, and go by user to the task that reduces and pivots
them: two exchanges of narrow rows, as hardly any two of them share user,
product, payment key and age bucket. AQE's skew-join split stays enabled as a
backstop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierbook.operators.book import (
    BookSpec,
    dimension_key,
    feature_book,
    pivot_rows,
    prepare_stage_input,
)
from tierbook.operators.joins import (
    DEFAULT_MAX_BROADCAST_ROWS,
    fits_broadcast,
    salted_left_join,
)
from tierbook.operators.latest import FILE_FIRST, PROC_FIRST, latest_batch, latest_batch_of_loads
from tierbook.operators.lookback import lookback_filter

MAX_COMBINED_PRODUCTS = 1_000_000


def _latest(df: DataFrame, control: DataFrame | None, order: Sequence[str]) -> DataFrame:
    return latest_batch(df, order) if control is None else latest_batch_of_loads(df, control, order)


def build_book(
    sales: DataFrame,
    products: DataFrame,
    spec: BookSpec,
    as_of,
    ref: str,
    ts_proc: str,
    *,
    latest_sales: bool = True,
    latest_products: bool = True,
    sales_order: Sequence[str] = PROC_FIRST,
    products_order: Sequence[str] = FILE_FIRST,
    lookback_start: str | None = None,
    method: str = "two_stage",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    products_rows: int | None = None,
    rows_per_task: int | None = None,
    sales_control: DataFrame | None = None,
    products_control: DataFrame | None = None,
    user: str = "user_id",
    product_key: str = "product_id",
    amount: str = "amount",
    date_col: str = "ref",
) -> DataFrame:
    sales = lookback_filter(sales, lookback_start)
    if latest_sales:
        sales = _latest(sales, sales_control, sales_order)
    if latest_products:
        products = _latest(products, products_control, products_order)

    # Dimensions whose column comes from the product snapshot.
    from_products = tuple(d for d in spec.dimensions if d.column not in sales.columns)
    own = tuple(d for d in spec.dimensions if d not in from_products)
    dim_cols = sorted({d.column for d in from_products})
    if method == "two_stage":
        # The two-stage plan only needs each product's small integer key:
        # computed once per product on the dimension side, not per sale.
        categories = products.select(product_key, *(dimension_key(d).alias(d.key) for d in from_products))
    else:
        categories = products.select(product_key, *dim_cols)
    sales = sales.drop(*(c for c in dim_cols if c in sales.columns))

    combined_rows = min(max_broadcast_rows, MAX_COMBINED_PRODUCTS) if method == "two_stage" else max_broadcast_rows
    if fits_broadcast(categories, combined_rows, products_rows):
        enriched = sales.join(F.broadcast(categories), product_key, "left")
    elif method == "two_stage":
        narrow = prepare_stage_input(sales, spec, as_of, user, amount, date_col, keep=(product_key,), dimensions=own)
        if combined_rows < max_broadcast_rows and fits_broadcast(categories, max_broadcast_rows, products_rows):
            joined = narrow.join(F.broadcast(categories), product_key, "left")
        else:
            joined = salted_left_join(narrow, categories, product_key, rows_per_task, counted=sales)
        return pivot_rows(joined, spec, ref, ts_proc, user, amount)
    else:
        enriched = salted_left_join(sales, categories, product_key, rows_per_task)
    return feature_book(enriched, spec, as_of, ref, ts_proc, user, amount, date_col, method)


def gold_job(
    spark,
    sales_silver: str,
    products_silver: str,
    gold_dir: str,
    spec: BookSpec,
    as_of,
    ts_proc: str,
    *,
    sales_control: str | None = None,
    products_control: str | None = None,
    **book_options,
) -> str:
    """Read silver, build the book and write it to gold (a load of its own per
    ref/ts_proc, so a rerun of the same stamp replaces its own book, also by an
    empty one). Returns ``gold_dir``.

    The latest batches are found in silver's commit logs. For tables that have
    none (written by another program) the control folders, where given, name
    them, else silver is scanned. The broadcast decision measures the chosen
    product batch itself (one folder).
    """
    from tierbook.functions.dates import ref_stamp
    from tierbook.schemas import PRODUCTS, SALES
    from tierbook.sinks.commits import has_log
    from tierbook.sinks.writers import write_gold
    from tierbook.sources.lake import read_control, read_latest_load, read_silver

    read = {}
    for name, folder, spec_, control, order in (
        ("sales", sales_silver, SALES, sales_control, PROC_FIRST),
        ("products", products_silver, PRODUCTS, products_control, FILE_FIRST),
    ):
        if has_log(spark, folder) and book_options.get(f"latest_{name}", True):
            min_ref = book_options.get("lookback_start") if name == "sales" else None
            read[name] = read_latest_load(spark, folder, spec_, book_options.get(f"{name}_order", order), min_ref)
            book_options[f"latest_{name}"] = False
        else:
            read[name] = read_silver(spark, folder, spec_)
            if control:
                book_options[f"{name}_control"] = read_control(spark, control, missing_ok=True)
    book = build_book(read["sales"], read["products"], spec, as_of, ref_stamp(as_of), ts_proc, **book_options)
    write_gold(book, gold_dir, ref_stamp(as_of), ts_proc)
    return gold_dir


def last_book_stamp(spark, gold_dir: str) -> str | None:
    """Newest ``ts_proc`` of a book: from the commit log, or the partition folders of a table without one."""
    from tierbook.sinks.commits import has_log, live_loads
    from tierbook.sources.storage import list_folder

    if has_log(spark, gold_dir):
        return live_loads(spark, gold_dir).agg(F.max("ts_proc")).first()[0]
    refs = [e.name for e in list_folder(spark, gold_dir) if e.name.startswith("ref=")]
    stamps = [e.name.split("=", 1)[1] for r in refs for e in list_folder(spark, f"{gold_dir}/{r}") if e.name.startswith("ts_proc=")]
    return max(stamps, default=None)


def gold_when_ready(
    spark,
    silver_root: str,
    control_root: str,
    gold_dir: str,
    spec: BookSpec,
    as_of,
    ts_proc: str,
    subjects: Sequence[str] = ("users", "products", "sales"),
    **book_options,
) -> bool:
    """Run the gold job only when every subject has a load newer than the
    last book (the readiness gate); returns whether it ran. The gate resets
    by itself: the new book's stamp becomes the bar for the next run."""
    from tierbook.operators.control import readiness
    from tierbook.sources.lake import read_control

    control = read_control(spark, *(f"{control_root}/{s}" for s in subjects), missing_ok=True)
    state = readiness(spark, control, subjects, last_book_stamp(spark, gold_dir))
    if not state.agg(F.bool_and("received")).first()[0]:
        return False
    gold_job(
        spark,
        f"{silver_root}/sales",
        f"{silver_root}/products",
        gold_dir,
        spec,
        as_of,
        ts_proc,
        sales_control=f"{control_root}/sales",
        products_control=f"{control_root}/products",
        **book_options,
    )
    return True
