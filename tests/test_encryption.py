"""Field encryption: round trip, rotation, refusal of unknown keys and changed fields, join digest."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from laminar.functions.encryption import decrypt_field, encrypt_field, join_digest, rotate_field

KEYS = {"a": b"0" * 16, "b": b"1" * 32}
TEXTS = [None, "", "a@b.co", "a@b.co", "Ünï 日本 \U0001F600", "x:y:z", "long " * 2000]


@pytest.fixture()
def sealed(spark, area):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    rows.select("i", encrypt_field(F.col("t"), KEYS["a"], "a").alias("t")).write.parquet(area)
    return spark.read.parquet(area)


def texts(df):
    return [r["t"] for r in df.orderBy("i").collect()]


def test_round_trip(sealed):
    held = texts(sealed)
    assert held[0] is None and all(h.startswith("a:") for h in held[1:])
    assert held[2] != held[3]           # a nonce of its own each time
    assert texts(sealed.select("i", decrypt_field(F.col("t"), KEYS).alias("t"))) == TEXTS


def test_rotation(sealed):
    moved = sealed.select("i", rotate_field(F.col("t"), KEYS, "b").alias("t"))
    assert all(t is None or t.startswith("b:") for t in texts(moved))
    assert texts(moved.select("i", decrypt_field(F.col("t"), {"b": KEYS["b"]}).alias("t"))) == TEXTS
    assert texts(sealed.select("i", rotate_field(F.col("t"), KEYS, "a").alias("t"))) == texts(sealed)


@pytest.mark.parametrize("keys", [{}, {"b": KEYS["b"]}, {"a": b"2" * 16}])
def test_a_missing_or_wrong_key_is_an_error(sealed, keys):
    with pytest.raises(Exception):
        texts(sealed.select("i", decrypt_field(F.col("t"), keys).alias("t")))


def test_a_changed_key_id_is_an_error(sealed):
    renamed = F.regexp_replace("t", "^a:", "c:")
    with pytest.raises(Exception):
        texts(sealed.select("i", decrypt_field(renamed, {"c": KEYS["a"]}).alias("t")))


def test_join_digest_is_hmac(spark):
    got = texts(spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").select(
        "i", join_digest(F.col("t"), KEYS["b"]).alias("t")))
    assert got == [t and hmac.new(KEYS["b"], t.encode(), hashlib.sha256).hexdigest() if t != "" else
                   hmac.new(KEYS["b"], b"", hashlib.sha256).hexdigest() for t in TEXTS]


def test_keys_are_checked():
    for call in (lambda: encrypt_field(F.lit("x"), b"short", "a"), lambda: encrypt_field(F.lit("x"), KEYS["a"], "a:b"),
                 lambda: join_digest(F.lit("x"), b"")):
        with pytest.raises(ValueError):
            call()
