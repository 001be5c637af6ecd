"""Column-level helpers: every function returns a ``Column`` and stays JVM-side."""

from cyclemart.functions.crypto import decrypt_column, encrypt_column
from cyclemart.functions.paths import parse_object_key, route_file_type
from cyclemart.functions.predicates import as_flag, conjunction, missing_from

__all__ = [
    "as_flag", "conjunction", "decrypt_column", "encrypt_column", "missing_from",
    "parse_object_key", "route_file_type",
]
