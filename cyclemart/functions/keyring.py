"""Key rings: ciphertext that names the key it was made with (CR-1, CR-2).

A sealed value is a small header and the AES-GCM ciphertext.  The header names the key by its
id and is authenticated with the value, so the reader needs no key but its ring: the key is
chosen from the value, row by row, on the executors.  After a rotation new values are sealed
with the new current key and old ones still open; a value whose key is not in the ring opens
as NULL, like one that was damaged.

    4 bytes magic | 1 byte length of the id | id | 12 bytes IV, ciphertext, 16 bytes tag

Files and frames use envelopes: a data key of their own encrypts the content, and only that
data key is sealed with the ring (:func:`wrap`).  A rotation of what is stored then renews
the sealed data keys and leaves the content as it is.

Keys reach the executors through a scalar subquery over a one-row local table, so no plan
and no event log shows them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MAGIC = b"CMK1"
_ID = re.compile(r"[A-Za-z0-9_.-]{1,64}")


def _checked(key: str | bytes) -> bytes:
    key = key.encode("utf-8") if isinstance(key, str) else bytes(key)
    if len(key) not in (16, 24, 32):
        raise ValueError("AES key must be 16, 24 or 32 bytes long")
    return key


def secret(kind: pa.DataType, value) -> Column:
    """A value as a column that no plan shows: the only row of a local table, read by an
    uncorrelated scalar subquery."""
    # another thread of the driver has no active session of its own
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    return spark.createDataFrame(pa.table({"secret": pa.array([value], kind)})).scalar()


class KeyRing:
    """Named AES keys, one of which is current: it seals, all of them open."""

    def __init__(self, keys: Mapping[str, str | bytes], current: str) -> None:
        if current not in keys:
            raise ValueError(f"the current key {current!r} is not in the ring")
        wrong = [i for i in keys if not _ID.fullmatch(i)]
        if wrong:
            raise ValueError(f"key ids must be 1 to 64 letters, digits, '_', '.' or '-': {wrong}")
        self._keys = {i: _checked(k) for i, k in keys.items()}
        self.current = current

    @property
    def ids(self) -> list[str]:
        return sorted(self._keys)

    def rotated(self, key_id: str, key: str | bytes) -> KeyRing:
        """A ring with a new current key; the earlier ones still open what they sealed."""
        if key_id in self._keys:
            raise ValueError(f"the ring has a key {key_id!r} already")
        return KeyRing({**self._keys, key_id: key}, key_id)

    def without(self, key_id: str) -> KeyRing:
        """A ring that no longer opens what a retired key sealed."""
        return KeyRing({i: k for i, k in self._keys.items() if i != key_id}, self.current)

    def __repr__(self) -> str:  # never the keys
        return f"KeyRing({self.ids}, current={self.current!r})"

    def __getstate__(self):
        raise TypeError("a key ring is not sent to the executors; its keys travel in a subquery")

    def current_key(self) -> Column:
        return secret(pa.binary(), self._keys[self.current])

    def key_of(self, key_id: Column) -> Column:
        """The key of an id; NULL for one that is not in the ring."""
        return F.try_element_at(secret(pa.map_(pa.string(), pa.binary()), list(self._keys.items())), key_id)


def _header(key_id: str) -> bytes:
    return MAGIC + bytes([len(key_id)]) + key_id.encode("ascii")


def _id_length(blob: Column) -> Column:
    return F.conv(F.hex(F.substring(blob, 5, 1)), 16, 10).cast("int")


def key_id(blob: Column) -> Column:
    """The id that a sealed value names; NULL for anything else."""
    named = F.substring(blob, F.lit(6), _id_length(blob)).cast("string")
    return F.when(F.substring(blob, 1, len(MAGIC)) == F.lit(MAGIC), named)


def seal(data: Column, ring: KeyRing) -> Column:
    """``data`` (binary) encrypted with the ring's current key, which the value names."""
    header = F.lit(_header(ring.current))
    return F.concat(header, F.aes_encrypt(data, ring.current_key(), F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), header))


def unseal(blob: Column, ring: KeyRing) -> Column:
    """Inverse of :func:`seal`; NULL if damaged, or sealed with a key the ring lacks."""
    start = _id_length(blob) + len(MAGIC) + 1
    header = F.substring(blob, F.lit(1), start)
    body = F.substring(blob, start + 1, F.length(blob))
    return F.try_aes_decrypt(body, ring.key_of(key_id(blob)), F.lit("GCM"), F.lit("DEFAULT"), header)


#: A data key is sealed like any value.
wrap, unwrap = seal, unseal


def rewrapped(wrapped: Column, ring: KeyRing) -> Column:
    """A wrapped data key under the ring's current key; one the ring cannot open stays."""
    return F.when(key_id(wrapped) == ring.current, wrapped).otherwise(F.coalesce(seal(unseal(wrapped, ring), ring), wrapped))
