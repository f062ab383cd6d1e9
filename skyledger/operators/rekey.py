"""Customer-supplied-key rotation over a table of encrypted payloads.

Payloads are AES-256-GCM (built-in ``aes_encrypt``); rewriting decrypts with
the old key and encrypts with the new one. Once the old key is dropped,
rows that were not rewritten can no longer be read (``try_aes_decrypt``
yields NULL instead of failing the job).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.text import base64_key


def key_bytes(seed: str) -> Column:
    """A 32-byte key derived from a seed (the base64 form is what a config file holds)."""
    return F.unbase64(base64_key(F.lit(seed)))


def encrypt(df: DataFrame, col: str, key: Column, out: str = "payload") -> DataFrame:
    return df.withColumn(out, F.aes_encrypt(F.col(col).cast("binary"), key, F.lit("GCM")))


def rewrite(df: DataFrame, payload: str, old_key: Column, new_key: Column, where: Column) -> DataFrame:
    """Re-encrypt the selected rows with the new key (the rewrite step of a rotation)."""
    re = F.aes_encrypt(F.aes_decrypt(F.col(payload), old_key, F.lit("GCM")), new_key, F.lit("GCM"))
    return df.withColumn(payload, F.when(where, re).otherwise(F.col(payload))) \
        .withColumn("rewritten", where)


def read_with(df: DataFrame, payload: str, key: Column, out: str = "recovered") -> DataFrame:
    """Decrypt with the only key still configured; NULL where it does not fit."""
    return df.withColumn(out, F.try_aes_decrypt(F.col(payload), key, F.lit("GCM")).cast("string")) \
        .withColumn("readable", F.col(out).isNotNull())
