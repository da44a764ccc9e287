"""What a response makes of a download, before its body is written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.rules import HTML_ERROR

#: How much of a body is looked at: the first chunk of a download.
CHUNK = 65_536


def is_html(body: Column) -> Column:
    """The first chunk, without leading white space, begins as an HTML page does (<!DOCTYPE in capitals, or <html)."""
    head = F.regexp_replace(F.decode(F.substring(body, 1, CHUNK), "ISO-8859-1"), r"\A[ \t\n\r\x0b\f]+", "")
    return F.startswith(head, F.lit("<!DOCTYPE")) | F.startswith(head, F.lit("<html"))


def outcome(status: Column, body: Column, error: Column, existing: Column) -> Column:
    """struct<ok, size, error, empty>: an error or a status from 400 on fails, a file that is there counts, HTML fails, an empty body does not."""
    size = F.coalesce(F.octet_length(body).cast("long"), F.lit(0).cast("long"))
    html = F.coalesce(is_html(body), F.lit(False))
    here = F.coalesce(existing, F.lit(0).cast("long")) > 0
    fault = F.when(error.isNotNull(), error).when(status >= 400, F.concat(F.lit("HTTP "), status.cast("string"))).when(~here & html, F.lit(HTML_ERROR))
    ok = fault.isNull()
    return F.struct(
        ok.alias("ok"), F.when(~ok, F.lit(0).cast("long")).when(here, existing).otherwise(size).alias("size"), fault.alias("error"), (ok & ~here & (size == 0)).alias("empty")
    )
