"""Derived WARC records: metadata and plain-text conversion records of response records.

Everything is an expression over the response's columns: no shuffle, no Python.  A derived
record refers to its response by record id, and keeps its target, date and payload digest;
the metadata record also lists the response's HTTP headers and its links.  Ids of derived
records follow from the response's id and the kind, so a repeated run makes the same ones.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import free_name

CRLF = "\r\n"
HEAD_END = "\r\n\r\n"
FIELDS = "application/warc-fields"

# Elements whose content is not text, and tags that part blocks of text.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<noscript\b.*?</noscript\s*>"
# Tag names by their first letters, so that few of them are tried at each tag.
BLOCK = (
    r"(?i)</?(?:a(?:ddress|rticle|side)|b(?:lockquote|r)|d(?:d|iv|l|t)|f(?:ooter|orm)|h(?:[1-6]|eader|r)|li|main|nav|ol"
    r"|p(?:re)?|section|t(?:able|d|h|r)|ul)\b[^>]*>"
)
TAG = r"<[!/?a-zA-Z][^>]*>"
LINK = r"(?i)<a\s(?:[^>]*?\s)?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,15});"
# Named references of HTML 4, and the apostrophe's; the usual ones first.
NAMES = {n: chr(c) for n, c in [("amp", 38), ("lt", 60), ("gt", 62), ("quot", 34), ("apos", 39), ("nbsp", 160), *sorted(name2codepoint.items())]}


def sha256_digest(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """A UUID from the MD5 of the parts, in URN form; it has no random bits."""
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of crawled pages: ``record_id, target_uri, date, headers, payload``."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    size = F.octet_length(payload).cast("string")
    lines = [F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), size)]
    ident = record_id(F.lit("response"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.coalesce(F.col(url), F.lit("")))
    return pages.select(
        F.col(page_id).alias("page_id"), ident.alias("record_id"), F.col(url).cast("string").alias("target_uri"),
        F.lit(date).alias("date"), F.concat_ws(CRLF, *lines).alias("headers"), payload.alias("payload"),
    )


def character(reference: Column) -> Column:
    """The character a reference (without & and ;) stands for, null if it is none."""
    hexadecimal = F.lower(F.substring(reference, 2, 1)) == "x"
    digits = F.when(hexadecimal, F.conv(F.substring(reference, 3, 6), 16, 10)).otherwise(F.substring(reference, 2, 7))
    code = digits.try_cast("int")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    names = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    return F.when(F.startswith(reference, F.lit("#")), numeric).otherwise(F.try_element_at(names, reference))


def without_references(text: Column) -> Column:
    """Character references read in one pass, so that nothing is read twice; unknown ones stay."""

    def read(part: Column, i: Column) -> Column:
        reference = F.regexp_extract(part, REFERENCE, 1)
        known = F.concat(character(reference), F.substr(part, F.length(reference) + 2))
        return F.when(i == 0, part).otherwise(F.coalesce(F.when(reference != "", known), F.concat(F.lit("&"), part)))

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&"), read), "")).otherwise(text)


def visible(html: Column) -> Column:
    """A page without comments, scripts, styles and its head."""
    return F.regexp_replace(html, HIDDEN, " ")


def plain_text(seen: Column) -> Column:
    """The text of a page's visible part, a line per block: tags go, references are read."""
    text = F.regexp_replace(seen, r"[\x09-\x0D ]+", " ")
    text = F.regexp_replace(text, BLOCK, "\n")
    text = without_references(F.regexp_replace(text, TAG, ""))
    return F.trim(F.regexp_replace(F.regexp_replace(text, " *\n[ \n]*", "\n"), "^\n+|\n+$", ""))


def metadata(headers: Column, seen: Column) -> Column:
    """Lines of header fields and of links in the visible part, in order and as often as they stand there."""
    names = F.transform(F.split(headers, CRLF), lambda h: F.concat(F.lit("http-header: "), h))

    def unquoted(u: Column) -> Column:
        return F.when(u.rlike("^[\"']"), F.substr(u, F.lit(2), F.length(u) - 2)).otherwise(u)

    links = F.transform(F.regexp_extract_all(seen, F.lit(LINK), F.lit(1)), lambda u: F.concat(F.lit("outlink: "), unquoted(u)))
    return F.array_join(F.concat(names, links), CRLF)


def _named(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The frame with columns called ``names``; of some alike but for case, the one written just so stays."""
    exact = set(df.columns)
    kept = [(k, c) for k, c in enumerate(df.columns) if c in names or c.lower() not in names or c.lower() not in exact]
    numbered = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    return numbered.select(*(F.col(f"c{k}").alias(c.lower() if c.lower() in names else c) for k, c in kept))


def derive(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record of every response record.

    ``records`` holds ``record_id, target_uri, date, headers`` (the HTTP head) and
    ``payload``; other columns are carried along, those called like a result's give way,
    whatever their case.
    Two rows come out per response: ``record_type, record_id, refers_to, target_uri, date,
    content_type, block, content_length, block_digest, payload_digest``, the last of the
    response's payload.

    Defined cases: null or empty headers or payload give empty blocks; a null record id or
    target stays null (and the derived id then follows from the rest); repeated rows give
    records of equal ids; an empty table gives no rows.
    """
    read = ("record_id", "target_uri", "date", "headers", "payload")
    made = ("record_type", "refers_to", "content_type", "block", "content_length", "block_digest", "payload_digest")
    others = [f"`{c}`" for c in records.columns if c.lower() not in (*made, *read)]
    seen, digest, kind, content, block = (free_name(records, n) for n in ("seen", "digest", "kind", "content", "block_"))
    head, payload = F.coalesce("headers", F.lit("")), F.coalesce("payload", F.lit(""))
    same = ["record_id", "target_uri", "date"]
    base = _named(records, read).select(*others, *same, head.alias("headers"), sha256_digest(payload).alias(digest), visible(payload).alias(seen))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("t"), F.lit(FIELDS).alias("c"), metadata(F.col("headers"), F.col(seen)).alias("b")),
        F.struct(F.lit("conversion").alias("t"), F.lit("text/plain; charset=utf-8").alias("c"), plain_text(F.col(seen)).alias("b")),
    )
    rows = base.select(*others, *same, digest, F.inline(kinds).alias(kind, content, block))
    return rows.select(
        *others,
        F.col(kind).alias("record_type"),
        record_id(F.col(kind), F.coalesce("record_id", F.lit(""))).alias("record_id"),
        F.col("record_id").alias("refers_to"),
        "target_uri", "date", F.col(content).alias("content_type"), F.col(block).alias("block"),
        F.octet_length(block).cast("long").alias("content_length"), sha256_digest(F.col(block)).alias("block_digest"),
        F.col(digest).alias("payload_digest"),
    )


def serialized(derived: DataFrame) -> DataFrame:
    """``record``: each derived record in WARC form, without the two empty lines that end it."""
    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value))

    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")), line("WARC-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("date")),
        line("WARC-Block-Digest", F.col("block_digest")), line("WARC-Source-Payload-Digest", F.col("payload_digest")),
        line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length").cast("string")),
    )
    return derived.select(F.concat(head, F.lit(HEAD_END), F.col("block")).alias("record"))


def write_warc(derived: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write derived records as WARC files, one per partition; every record ends in two empty lines."""
    serialized(derived).write.option("lineSep", HEAD_END).option("compression", compression).text(path)
