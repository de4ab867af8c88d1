"""Field encryption: authenticated encryption with a key id, and a keyed digest to join on.

Keys are arguments without defaults. As they stand in the plan as literals, a deployment sets
``spark.sql.redaction.string.regex`` for plans that are logged. All of it stays in the JVM.

A field is ``<key id>:<base64>`` of AES-GCM with a random nonce, the id being authenticated as
well. So equal values look different, and joins and distinct counts use ``join_digest``
(HMAC-SHA256), which equal values share. NULL stays NULL, and an empty text is a value.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64                     # bytes of a SHA-256 block


def _checked(key: bytes, key_id: str) -> Column:
    if len(key) not in (16, 24, 32):
        raise ValueError("an AES key has 16, 24 or 32 bytes")
    if not key_id or ":" in key_id:
        raise ValueError("a key id is not empty and holds no colon")
    return F.lit(bytearray(key))


def encrypt_field(value: Column, key: bytes, key_id: str) -> Column:
    secret = F.aes_encrypt(F.encode(value, "UTF-8"), _checked(key, key_id), F.lit("GCM"), F.lit("DEFAULT"),
                           F.lit(bytearray()), F.lit(key_id))
    return F.concat(F.lit(key_id + ":"), F.base64(secret))


def decrypt_field(value: Column, keys: Mapping[str, bytes]) -> Column:
    """The plain text; a field under a key that is not given, or that was changed, is an error."""
    secret = F.unbase64(F.substring_index(value, ":", -1))
    known = F.when(value.isNull(), F.lit(None).cast("string"))
    for key_id, key in keys.items():
        plain = F.aes_decrypt(secret, _checked(key, key_id), F.lit("GCM"), F.lit("DEFAULT"), F.lit(key_id))
        known = known.when(value.startswith(key_id + ":"), F.decode(plain, "UTF-8"))
    return known.otherwise(F.raise_error(F.lit("a field is encrypted with a key that was not given")).cast("string"))


def rotate_field(value: Column, keys: Mapping[str, bytes], key_id: str) -> Column:
    """The field under the key ``key_id`` of ``keys``; fields that are under it stay as they are."""
    return F.when(value.startswith(key_id + ":"), value).otherwise(
        encrypt_field(decrypt_field(value, keys), keys[key_id], key_id))


def join_digest(value: Column, key: bytes) -> Column:
    """HMAC-SHA256 of the text in hexadecimal."""
    if not 16 <= len(key) <= BLOCK:
        raise ValueError(f"a digest key has 16 to {BLOCK} bytes")
    padded = key.ljust(BLOCK, b"\0")
    inner, outer = (F.lit(bytearray(b ^ x for b in padded)) for x in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(inner, F.encode(value, "UTF-8")), 256))
    return F.sha2(F.concat(outer, first), 256)
