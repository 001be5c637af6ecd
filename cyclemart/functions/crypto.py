"""Column encryption (CR-1, CR-2) with Spark's built-in AES (GCM by default).

With a plain key the text is the ciphertext.  With a :class:`~cyclemart.functions.keyring.KeyRing`
it names its key, and the key is chosen from it on decryption.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclemart.functions.keyring import KeyRing, _checked, seal, secret, unseal


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _key(key: str | bytes) -> Column:
    """The key as a column that no plan shows."""
    return secret(pa.binary(), _checked(key))


def encrypt_bytes(data: Column, key: str | bytes | KeyRing, mode: str = "GCM") -> Column:
    """Ciphertext of a binary column; with a ring it names its key."""
    return seal(data, key) if isinstance(key, KeyRing) else F.aes_encrypt(data, _key(key), F.lit(mode))


def try_decrypt_bytes(data: Column, key: str | bytes | KeyRing, mode: str = "GCM") -> Column:
    """Inverse of :func:`encrypt_bytes`; NULL for what does not decrypt."""
    return unseal(data, key) if isinstance(key, KeyRing) else F.try_aes_decrypt(data, _key(key), F.lit(mode))


def encrypt_column(value: str | Column, key: str | bytes | KeyRing, mode: str = "GCM") -> Column:
    """``base64`` of the ciphertext as one line of text. NULL stays NULL.

    Spark may wrap long base64 output MIME-style; the line breaks are removed so every
    value stays on one line (a line-encrypted file relies on that).
    """
    return one_line(encrypt_bytes(_col(value).cast("binary"), key, mode))


def one_line(data: Column) -> Column:
    """Base64 without line breaks."""
    return F.translate(F.base64(data), "\r\n", "")


def decrypt_column(
    value: str | Column, key: str | bytes | KeyRing, mode: str = "GCM", strict: bool = False
) -> Column:
    """Inverse of :func:`encrypt_column`.

    Non-strict: text that is not base64, or does not decrypt (damaged, or made with another
    key, or with one the ring lacks), gives NULL.  Strict: a bad value raises at run time.
    """
    raw = F.try_to_binary(_col(value), F.lit("base64"))
    if not strict:
        return try_decrypt_bytes(raw, key, mode).cast("string")
    if isinstance(key, KeyRing):
        opened = unseal(raw, key).cast("string")
        wrong = F.raise_error(F.lit("a value is damaged, or its key is not in the ring"))
        return F.when(_col(value).isNull() | opened.isNotNull(), opened).otherwise(wrong.cast("string"))
    return F.aes_decrypt(F.unbase64(_col(value)), _key(key), F.lit(mode)).cast("string")
