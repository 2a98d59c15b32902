"""Sources: text files (numbers, lines, documents, vectors) and the parquet tables."""

from cairn.sources.text import (parse_numbers, read_numbers, read_lines, text_lines,
                                read_documents, parse_vectors, read_vectors, write_lines)
from cairn.sources.tables import (table, documents, embedding_points, lineitem_points,
                                  order_prices)

__all__ = [
    "parse_numbers", "read_numbers", "read_lines", "text_lines", "read_documents",
    "parse_vectors", "read_vectors", "write_lines",
    "table", "documents", "embedding_points", "lineitem_points", "order_prices",
]
