"""Table schemas: messages, attachments, checkpoints, index rows, discussion trees."""

from __future__ import annotations

MESSAGE = (
    "month string, msgid string, in_reply_to string, subject string, from_name string, from_email string, "
    "date_iso string, date_raw string, body string, source string, body_html string, raw binary"
)
ATTACHMENT = "msgid string, month string, url string, filename string, content_type string, size long, content binary, cid string"
IMAP_STATE = "folder string, last_uid long, uidvalidity long, host string, account string"
HTML_CACHE = "url string, body_html string, raw_html string, raw_bytes binary"
_REPLY = "id:string,createdAt:string,body:string,bodyHTML:string,author:struct<login:string>,replyTo:struct<id:string>"
DISCUSSION = f"id string, title string, createdAt string, body string, bodyHTML string, author struct<login:string>, comments struct<nodes:array<struct<{_REPLY},replies:struct<nodes:array<struct<{_REPLY}>>>>>>"
