"""Category enrichment: sales LEFT JOIN the product snapshot on product_id."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tierbook.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, left_join_dimension
from tierbook.operators.quality import assert_unique


def category_enrichment(
    sales: DataFrame,
    products: DataFrame,
    key: str = "product_id",
    columns: tuple[str, ...] = ("product_category",),
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    products_rows: int | None = None,
    validate_unique: bool = False,
) -> DataFrame:
    """All sales columns plus the product's category.

    Unmatched sales keep a NULL category; a product_id present twice in the
    snapshot yields the sale twice (plain join semantics, see
    ``validate_unique=True`` to fail on such a snapshot instead).
    """
    dim = products.select(key, *columns)
    if validate_unique:
        assert_unique(dim, key)
    joined = left_join_dimension(sales, dim, key, max_broadcast_rows, products_rows)
    return joined.select(*sales.columns, *columns)
