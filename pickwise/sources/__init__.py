from pickwise.sources.bindings import (item_vectors, load_table, products_from_part,
                                       ratings_events, ratings_orders)
from pickwise.sources.tables import read_table, write_table
from pickwise.sources.text import (format_product_lines, format_rating_lines,
                                   parse_product_lines, parse_rating_lines,
                                   read_products, read_ratings)

__all__ = [
    "format_product_lines", "format_rating_lines", "item_vectors", "load_table",
    "parse_product_lines", "parse_rating_lines", "products_from_part",
    "ratings_events", "ratings_orders", "read_products", "read_ratings",
    "read_table", "write_table",
]
