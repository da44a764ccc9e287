"""The file name of a document, from what is known of it."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import decode_content_disposition, disposition_name, first_filled, let, safe_name, sanitize_filename, strip
from .url import pdf_basename


def derive_filename(document_id: Column, download_url: Column, link_text: Column, article_title: Column, disposition: Column, strict: bool = False) -> Column:
    """Header, else the URL's .pdf, else a telling link text, else the article's title, else the id; prefixed with the id.

    strict adds a hash of the URL where no id makes the name unique.
    """
    number = F.coalesce(F.nullif(document_id, F.lit("")), F.lit("doc"))
    pdf = lambda c: F.endswith(F.lower(c), F.lit(".pdf"))
    # Blank or dull texts give no name.
    telling = lambda t: F.when((F.length(t) > 2) & ~F.startswith(F.lower(t), F.lit("http")), F.when(pdf(t), t).otherwise(F.concat(t, F.lit(".pdf"))))
    filled = lambda t: F.when(t != "", F.concat(t, F.lit(".pdf")))
    raw = F.coalesce(
        first_filled(decode_content_disposition(disposition)),
        first_filled(pdf_basename(download_url)),
        let(strip(F.coalesce(link_text, F.lit(""))), telling),
        let(strip(F.coalesce(article_title, F.lit(""))), filled),
        F.concat(F.lit("document_"), number, F.lit(".pdf")),
    )
    with_end = lambda c: F.when(pdf(c), c).otherwise(F.concat(c, F.lit(".pdf")))
    hashed = F.concat(F.substring(F.sha2(download_url, 256), 1, 10), F.lit("_")) if strict else F.lit("")
    prefix = F.concat(F.lit("doc_"), number, F.lit("_"))
    named = lambda c: F.when(number == "doc", F.concat(hashed, c)).when(F.startswith(c, prefix), c).otherwise(F.concat(prefix, c))
    return sanitize_filename(let(let(sanitize_filename(raw, strict=strict), with_end), named), strict=strict)


def header_filename(disposition: str | None, document_id: str | None, download_url: str | None, strict: bool = False) -> str | None:
    """The file name of a document whose response names one; None if it does not.

    What derive_filename makes of a header, for a task that holds the open response.
    """
    raw = disposition_name(disposition)
    if not raw:
        return None
    name = safe_name(raw, strict=strict)
    if not name.lower().endswith(".pdf"):
        name += ".pdf"
    number = document_id or "doc"
    if number == "doc":
        name = (hashlib.sha256((download_url or "").encode()).hexdigest()[:10] + "_" if strict else "") + name
    elif not name.startswith(f"doc_{number}_"):
        name = f"doc_{number}_{name}"
    return safe_name(name, strict=strict)
