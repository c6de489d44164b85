"""Attachments: embedded references, recovery of HTML-only bodies, and what may be published."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import binary
from ..functions.html import depipermail, sanitize_html
from ..functions.text import real_body_empty

_ADDRESS = re.compile(rb"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}")


def resolve_cids(references: DataFrame, attachments: DataFrame) -> DataFrame:
    """(msgid, cid, url): the attachment of the same message that an embedded reference means.

    Of equal ids the later attachment counts; without one, the first whose id is equal
    but for case; else the url is null and the reference goes.
    """
    known = attachments.where("cid is not null")
    exact = known.groupBy("msgid", "cid").agg(F.max_by("url", "pos").alias("_exact"))
    loose = known.groupBy("msgid", F.lower("cid").alias("_low")).agg(F.min_by("url", "pos").alias("_loose"))
    rows = references.join(exact, ["msgid", "cid"], "left").withColumn("_low", F.lower("cid")).join(loose, ["msgid", "_low"], "left")
    return rows.select("msgid", "cid", F.coalesce("_exact", "_loose").alias("url"))


def new_references(references: DataFrame, known: DataFrame, order: str = "pos") -> DataFrame:
    """One row a url that is not stored yet; of several mentions the last."""
    rest = [c for c in references.columns if c != "url"]
    last = references.groupBy("url").agg(F.max_by(F.struct(*rest), order).alias("_r")).select("url", *[F.col(f"_r.{c}").alias(c) for c in rest])
    return last.join(known.select("url").distinct(), "url", "left_anti")


def recover_html(messages: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(msgid, body_html) of messages whose body is only a note of a scrubbed HTML part; (msgid, url) still to fetch.

    The cached source is sanitised anew where it is kept, so a better sanitiser reaches old rows.
    """
    bare = messages.where(F.col("body").ilike("%attachment.htm%") & real_body_empty(F.col("body")) & (F.coalesce("body_html", F.lit("")) == ""))
    url = F.regexp_replace(F.regexp_extract("body", r"(?is)URL:\s*<([^>]*attachment\.html?[^>]*)>", 1), r"\s", "")
    wanted = bare.select("msgid", url.alias("url")).where("url <> ''")
    hit = wanted.join(cache.select("url", "raw_html", F.col("body_html").alias("_cached")), "url")
    clean = F.when(F.col("raw_html").isNotNull(), sanitize_html(depipermail(F.col("raw_html"))))
    found = hit.select("msgid", F.coalesce(clean, "_cached").alias("body_html")).where("body_html <> ''")
    return found, wanted.join(cache.select("url"), "url", "left_anti")


def without_raw(cache: DataFrame) -> DataFrame:
    """Cache rows whose original bytes are missing."""
    return cache.where("raw_bytes is null").select("url")


def publishable(attachments: DataFrame, salt: str) -> DataFrame:
    """``attachments`` with cleaned content and ``withheld``.

    Images lose their metadata; containers are rebuilt with masked members and then
    inspected again; text is masked; whatever cannot be inspected is withheld.
    """
    import hashlib

    from ..functions.privacy import MASKED_DOMAIN

    domain = b"@" + MASKED_DOMAIN.encode()

    def mask(data: bytes) -> bytes:
        def one(m: re.Match) -> bytes:
            low = m[0].lower()
            return m[0] if low.endswith(domain) else b"user-" + hashlib.sha256(salt.encode() + low).hexdigest()[:12].encode() + domain

        return _ADDRESS.sub(one, data)

    def leaks(data: bytes) -> bool:
        return any(not m.lower().endswith(domain) for m in _ADDRESS.findall(data))

    def clean(content: bytes | None, kind: str) -> bytes | None:
        if content is None:
            return None
        if kind.startswith("image/") or content[:2] == b"\xff\xd8" or content.startswith(b"\x89PNG"):
            return binary.strip_image(content, kind)
        if binary.container_kind(content):
            out = binary.rebuild(content, mask)
            inside = binary.members(out) if out is not None else None
            return None if inside is None or any(leaks(n.encode()) or leaks(b) for n, b in inside) else out
        if binary.is_text(content) or leaks(content):
            out = mask(content)
            return None if leaks(out) else out
        return content

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [clean(None if c is None else bytes(c), (t or "").lower()) for c, t in zip(frame["content"], frame["content_type"], strict=True)]
            yield frame.assign(content=out, withheld=[x is None and c is not None for x, c in zip(out, frame["content"], strict=True)])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in attachments.schema.fields)
    return attachments.mapInPandas(run, schema + ", withheld boolean")
