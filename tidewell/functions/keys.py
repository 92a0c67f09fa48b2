"""Stable keys: SHA-256 over a canonical JSON list, and a keyed hash for people.

Control characters below U+0020 other than the usual escapes are written with upper-case hex digits here.
"""

from __future__ import annotations

import hashlib
import hmac
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def json_key(*parts: Column | str) -> Column:
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.to_json(F.array(*columns)), 256)


def instant_text(ts: Column) -> Column:
    """UTC text of fixed width: equal instants give equal texts."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def record_key(version: str, source: Column, record: Column) -> Column:
    return json_key(version, source, record)


def version_key(version: str, source: Column, record: Column, ts: Column) -> Column:
    return json_key(version, source, record, instant_text(ts))


def dimension_key(version: str, natural: Column, valid_from: Column) -> Column:
    return json_key(version, natural, F.date_format(valid_from, "yyyy-MM-dd"))


def keyed_hash(secret: bytes, parts: Column) -> Column:
    """HMAC-SHA256 over the JSON of an array of strings; null for a null array.

    The secret stays in the function's closure: it never stands in a plan or an event log.
    """
    if not secret:
        raise ValueError("the secret is empty")

    @F.pandas_udf("string")
    def hashed(values: pd.Series) -> pd.Series:
        def one(x: object) -> str | None:
            if x is None:
                return None
            message = json.dumps(list(x), ensure_ascii=False, separators=(",", ":")).encode("utf-8")
            return hmac.new(secret, message, hashlib.sha256).hexdigest()

        return values.map(one)

    return hashed(parts)
