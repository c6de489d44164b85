"""The masking pass, encoded mail parts, attachments."""

from __future__ import annotations

import base64
import gzip

from pyspark.sql import functions as F

from lodestrata.functions import mime
from lodestrata.functions.privacy import verify
from lodestrata.operators import attachments, obfuscation


def test_masking_pass(spark, tmp_path):
    rows = [
        (1, "<a@x.org>", None, "s", "Jo", "jo@x.org", "call 216-515-4000, jo@x.org", 0), (2, "<b@x.org>", "<a@x.org>", "s", "Jo Smith", "jo@x.org", "fine", None),
        (3, "<c@x.org>", None, "s", "", "ann.lee@y.org", "", 0), (4, "<d@masked.invalid>", None, "s", "kept@as.is", "e", "b", 1), (5, "<e@x.org>", None, "s", None, "bob at z.org", None, 0),
    ]
    m = spark.createDataFrame(rows, "id int, msgid string, in_reply_to string, subject string, from_name string, from_email string, body string, obfuscated int")
    (tmp_path / "o.json").write_text('{"_note": "x", "Bob at z.org": "Robert Z"}')
    got = {r.id: r for r in obfuscation.obfuscate(m, "pepper", obfuscation.read_overrides(spark, str(tmp_path / "o.json"))).collect()}
    assert got[2].in_reply_to == got[1].msgid and got[1].from_email == got[2].from_email and got[1].from_email.endswith("@masked.invalid")
    assert (got[1].from_name, got[3].from_name, got[5].from_name) == ("Jo", "Ann Lee", "Robert Z") and "XXX-XXX-XXXX" in got[1].body
    assert got[4].from_name == "kept@as.is" and all(r.obfuscated == 1 for r in got.values())
    done = spark.createDataFrame(list(got.values()), "id int, msgid string, in_reply_to string, subject string, from_name string, from_email string, body string, obfuscated int")
    verify(done.where("id <> 4"), "id", ["msgid", "in_reply_to", "from_name", "from_email", "body"])
    again = {r.id: r for r in obfuscation.obfuscate(done, "pepper").collect()}
    assert again == got


def test_leak_summary(spark):
    df = spark.createDataFrame([(1, "a@x.org b@x.org a@x.org"), (2, "seen at y.org"), (3, "a@x.org")], "id int, body string")
    got = {r.severity: (r.n, r.n_distinct, r.examples) for r in obfuscation.leak_summary(df, "id", ["body"]).collect()}
    assert got == {"leak": (4, 2, ["a@x.org", "b@x.org"]), "prose": (1, 1, ["seen at y.org"])}


def test_encoded_parts_are_scrubbed_in_place(spark):
    secret = base64.encodebytes(b"write to jo@x.org please")
    raw = b"Content-Type: multipart/mixed; boundary=B\n\n--B\nContent-Type: text/plain\nContent-Transfer-Encoding: base64\n\n" + secret + b"\n--B\nContent-Type: text/plain\nContent-Transfer-Encoding: quoted-printable\n\nan=\nn@x.org\n--B--\n"
    assert [t.strip() for t in mime.decoded_texts(raw)] == ["write to jo@x.org please", "ann@x.org"]
    out = mime.scrub_parts(raw, lambda b: b.replace(b"jo@x.org", b"masked"))
    assert mime.decoded_texts(out)[0] == "write to masked please" and out.endswith(raw[-60:]) and mime.scrub_parts(raw, lambda b: b) == raw
    assert spark.createDataFrame([(bytearray(raw),), (None,)], "r binary").select(F.size(mime.decoded_texts_udf("r"))).collect()[0][0] == 2


def test_cids(spark):
    att = spark.createDataFrame([("m", "A", "u1", 1), ("m", "A", "u2", 2), ("m", "b", "u3", 3), ("m", "B", "u4", 4), ("n", "A", "u5", 1)], "msgid string, cid string, url string, pos int")
    refs = spark.createDataFrame([("m", "A"), ("m", "a"), ("m", "zz"), ("n", "A")], "msgid string, cid string")
    assert {(r.msgid, r.cid): r.url for r in attachments.resolve_cids(refs, att).collect()} == {("m", "A"): "u2", ("m", "a"): "u1", ("m", "zz"): None, ("n", "A"): "u5"}
    news = attachments.new_references(att.select("url", "msgid", "pos"), spark.createDataFrame([("u1",)], "url string"))
    assert sorted(r.url for r in news.collect()) == ["u2", "u3", "u4", "u5"]


def test_html_recovery(spark):
    note = "-------------- next part --------------\nAn HTML attachment was scrubbed...\nURL: <http://h/attachment.html>"
    m = spark.createDataFrame([("a", note, None), ("b", note.replace("attachment.html>", "attachment-0001.attachment.html>"), None), ("c", note + "\na real body of more than fifteen letters", None)], "msgid string, body string, body_html string")
    cache = spark.createDataFrame([("http://h/attachment.html", "old", "<tt>&lt;p&gt;new&lt;/p&gt;</tt>", None)], "url string, body_html string, raw_html string, raw_bytes binary")
    found, todo = attachments.recover_html(m, cache)
    assert [tuple(r) for r in found.collect()] == [("a", "<p>new</p>")] and [r.msgid for r in todo.collect()] == ["b"] and attachments.without_raw(cache).count() == 1


def test_publishable(spark):
    data = [("t.txt", "text/plain", b"jo@x.org"), ("z.gz", "application/gzip", gzip.compress(b"jo@x.org", mtime=0)), ("b.gz", "application/gzip", b"\x1f\x8bbroken"), ("g.gif", "image/gif", b"GIF89a"), ("n", None, None)]
    df = spark.createDataFrame([(n, t, None if c is None else bytearray(c)) for n, t, c in data], "filename string, content_type string, content binary")
    got = {r.filename: r for r in attachments.publishable(df, "pepper").collect()}
    assert b"@masked.invalid" in got["t.txt"].content and gzip.decompress(got["z.gz"].content).endswith(b"@masked.invalid")
    assert got["b.gz"].withheld and got["g.gif"].withheld and not got["n"].withheld
