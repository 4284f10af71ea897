"""Webhook signature checks over captured requests (V1, V2).

HMAC is spelled with the built-in SHA-2 so that it stays inside the JVM. The two padded keys
are computed once on the driver and reach the plan as binary literals; plans that hold them
must not be printed or logged.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64


def _padded(secret: str, byte: int) -> Column:
    key = secret.encode()
    if len(key) > BLOCK:
        key = hashlib.sha256(key).digest()
    return F.lit(bytes(b ^ byte for b in key.ljust(BLOCK, b"\0")))


def hmac_sha256_hex(body: Column, secret: str) -> Column:
    inner = F.sha2(F.concat(_padded(secret, 0x36), F.encode(body, "UTF-8")), 256)
    return F.sha2(F.concat(_padded(secret, 0x5C), F.unhex(inner)), 256)


def body_signature_valid(body: Column, signature: Column, secret: str) -> Column:
    """Hex HMAC of the body equals the header; nothing to compare means invalid (V1)."""
    present = (F.length(signature) > 0) & (F.length(body) > 0)
    return F.coalesce(present & (hmac_sha256_hex(body, secret) == signature), F.lit(False))


def _header_values(header: Column, name: str) -> Column:
    parts = F.filter(F.split(header, ","), lambda p: F.substring_index(F.trim(p), "=", 1) == name)
    return F.transform(parts, lambda p: F.substr(F.trim(p), F.lit(len(name) + 2)))


def gateway_signature_reason(
    body: Column,
    header: Column,
    secret: str,
    now_epoch: Column | None = None,
    tolerance_seconds: int = 300,
) -> Column:
    """NULL when the request is genuine, else ``bad_payload`` or ``bad_signature`` (V2).

    The header holds ``t=<epoch>`` and one or more ``v1=<hex>``; the signed text is
    ``<t>.<body>``. Age is checked only when ``now_epoch`` is given.
    """
    stamp = F.get(_header_values(header, "t"), F.lit(0))
    expected = hmac_sha256_hex(F.concat(stamp, F.lit("."), body), secret)
    genuine = F.array_contains(_header_values(header, "v1"), expected)
    if now_epoch is not None:
        genuine = genuine & (now_epoch - stamp.try_cast("bigint") <= tolerance_seconds)
    return F.when(~F.coalesce(genuine, F.lit(False)), "bad_signature").when(
        F.json_object_keys(body).isNull(), "bad_payload"
    )


def split_by_body_signature(requests: DataFrame, secret: str, header: str) -> tuple[DataFrame, DataFrame]:
    """Requests ``(headers map, body)`` as (accepted, rejected with a reason)."""
    valid = body_signature_valid(F.col("body"), F.col("headers")[header], secret)
    tagged = requests.withColumn("_valid", valid)
    accepted = tagged.filter("_valid").drop("_valid")
    rejected = tagged.filter("NOT _valid").drop("_valid").withColumn("reason", F.lit("bad_signature"))
    return accepted, rejected
