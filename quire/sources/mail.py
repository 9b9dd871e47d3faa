"""Mail sources."""

from __future__ import annotations

from email import message_from_bytes, policy
from email.header import decode_header, make_header

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.sources.text import PAGE_CHARS, html_text, paginate

MAIL = "subject string, sender string, date string, body string, is_html boolean, attachments array<string>"


def parse(raw: bytes) -> dict:
    """Headers, body (the first HTML part, else the first plain one) and names of attachments."""
    message = message_from_bytes(raw, policy=policy.compat32)
    header = lambda name: str(make_header(decode_header(message.get(name, "")))) if message.get(name) else ""
    bodies: dict[str, str] = {}
    attachments: list[str] = []
    parts = [p for p in message.walk() if not p.is_multipart()]
    for part in parts:
        kind = part.get_content_type()
        if message.is_multipart() and "attachment" in str(part.get("Content-Disposition", "")):
            if part.get_filename():
                attachments.append(part.get_filename())
            continue
        content = part.get_payload(decode=True)
        if content and not bodies.get(kind):
            charset = part.get_content_charset() or "utf-8"
            try:
                bodies[kind] = content.decode(charset, errors="replace")
            except LookupError:
                bodies[kind] = content.decode("utf-8", errors="replace")
    if message.is_multipart():
        is_html = bool(bodies.get("text/html"))
        body = bodies.get("text/html") or bodies.get("text/plain", "")
    else:
        is_html = message.get_content_type() == "text/html"
        body = next(iter(bodies.values()), "")
    return {"subject": header("Subject"), "sender": header("From"), "date": header("Date"), "body": body, "is_html": is_html, "attachments": attachments}


def mail(content: Column) -> Column:
    @F.pandas_udf(MAIL)
    def run(contents: pd.Series) -> pd.DataFrame:
        rows = [parse(bytes(c)) if c is not None else {} for c in contents]
        return pd.DataFrame(rows, columns=["subject", "sender", "date", "body", "is_html", "attachments"])

    return run(content)


def mail_pages(files: DataFrame, page_chars: int = PAGE_CHARS) -> DataFrame:
    """source_path, page_number, native_text, metadata: page 1 carries all headers and the names of
    attachments, other pages the subject."""
    rows = files.select("source_path", mail(F.col("content")).alias("m")).select("source_path", "m.*")
    text = F.when(F.col("is_html"), html_text(F.when(F.col("is_html"), F.col("body")))).otherwise(F.col("body"))
    pages = paginate(rows.withColumn("text", text).drop("body", "is_html"), page_chars=page_chars)
    full = F.create_map(F.lit("subject"), "subject", F.lit("from"), "sender", F.lit("date"), "date", F.lit("attachments"), F.to_json("attachments"))
    metadata = F.when(F.col("page_number") == 1, full).otherwise(F.create_map(F.lit("subject"), F.col("subject")))
    return pages.select("source_path", "page_number", "native_text", metadata.alias("metadata"))


def attachments(files: DataFrame) -> DataFrame:
    """(source_path, attachment) of mails, for a caller to submit again."""
    return files.select("source_path", F.explode(mail(F.col("content"))["attachments"]).alias("attachment"))
