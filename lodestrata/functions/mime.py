"""Encoded parts of raw mail: decoded for a scan, scrubbed in place."""

from __future__ import annotations

import base64
import binascii
import email
import quopri
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

ENCODINGS = ("base64", "quoted-printable")


def _decode(payload: bytes, encoding: str) -> bytes | None:
    try:
        return base64.b64decode(b"".join(payload.split()), validate=True) if encoding == "base64" else quopri.decodestring(payload)
    except (binascii.Error, ValueError):
        return None


def _encode(data: bytes, encoding: str) -> bytes:
    return base64.encodebytes(data) if encoding == "base64" else quopri.encodestring(data)


def encoded_parts(raw: bytes) -> Iterator[tuple[int, int, str, bytes]]:
    """(start, end, encoding, decoded bytes) of the encoded text parts, in order."""
    at = 0
    for part in email.message_from_bytes(raw).walk():
        encoding = str(part.get("Content-Transfer-Encoding", "")).strip().lower()
        if part.is_multipart() or encoding not in ENCODINGS or not part.get_content_type().startswith(("text/", "message/")):
            continue
        payload = (part.get_payload() or "").encode("ascii", "surrogateescape")
        start = raw.find(payload, at) if payload.strip() else -1
        if start >= 0 and (data := _decode(payload, encoding)) is not None:
            yield start, start + len(payload), encoding, data
            at = start + len(payload)


def decoded_texts(raw: bytes | None) -> list[str]:
    return [d.decode("latin-1") for *_, d in encoded_parts(bytes(raw or b""))]


def scrub_parts(raw: bytes, scrub: Callable[[bytes], bytes]) -> bytes:
    """The message with scrubbed parts; byte for byte the same where nothing changes."""
    out, at = [], 0
    for start, end, encoding, data in encoded_parts(raw):
        clean = scrub(data)
        if clean != data:
            out += [raw[at:start], _encode(clean, encoding)]
            at = end
    return b"".join([*out, raw[at:]]) if out else raw


decoded_texts_udf = F.pandas_udf(lambda c: pd.Series([decoded_texts(x) for x in c], dtype=object), ArrayType(StringType()))
