"""Column-expression building blocks (all JVM-side, codegen friendly)."""

from cairn.functions.tokens import space_tokens, utf16_length, whitespace_tokens, line_split
from cairn.functions.random import hashed_uniform, hashed_digits, hashed_bucket, race_key
from cairn.functions.vectors import as_vector, checked_vector, euclidean, parse_vector

__all__ = [
    "space_tokens", "utf16_length", "whitespace_tokens", "line_split",
    "hashed_uniform", "hashed_digits", "hashed_bucket", "race_key",
    "as_vector", "checked_vector", "euclidean", "parse_vector",
]
