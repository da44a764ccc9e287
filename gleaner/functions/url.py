"""Scalar functions on URLs."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import PurePosixPath
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .rules import IGNORED_PARTS
from .text import each

#: URLs of which every reader makes the same parts; they are taken apart by columns, all others one by one.
_SAFE = r"[A-Za-z0-9._~!$&'()*+,=:@%-]"
_HOST = r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?"
_ORDINARY = rf"^(?P<scheme>https?)://(?P<host>[A-Za-z0-9.-]+(?::[0-9]+)?)(?P<path>(?:/{_SAFE}*)*)(?:\?(?P<query>(?:{_SAFE}|[/?])+))?(?:#(?P<fragment>(?:{_SAFE}|[/?])+))?$"
#: An absolute reference without dot segments stands for itself.
_ABSOLUTE = rf"^{_HOST}(?:/(?:{_SAFE}*[A-Za-z0-9_~-]{_SAFE}*)?)*(?:\?(?:{_SAFE}|[/?])+)?(?:#(?:{_SAFE}|[/?])+)?$"
#: A path without dot segments goes to the host of its base.
_ROOTED = rf"^(?:/{_SAFE}*[A-Za-z0-9_~-]{_SAFE}*)+/?(?:\?(?:{_SAFE}|[/?])+)?(?:#(?:{_SAFE}|[/?])+)?$"


def _split(url: str | None):
    try:
        return urlsplit(url or "")
    except ValueError:
        return urlsplit("")


def resolved(base: pa.Array, href: pa.Array) -> pa.Array:
    """References resolved against the pages they stand on; null where one is malformed or null."""
    from ..markup.links import resolve

    site = pc.struct_field(pc.extract_regex(base, rf"^(?P<site>{_HOST})(?:[/?#][^\[\]]*)?$"), "site")
    known = pc.is_valid(site)
    absolute = pc.and_(pc.fill_null(pc.match_substring_regex(href, _ABSOLUTE), False), known)
    rooted = pc.and_(pc.fill_null(pc.match_substring_regex(href, _ROOTED), False), known)
    out = pc.if_else(absolute, href, pc.if_else(rooted, pc.binary_join_element_wise(site, href, ""), pa.nulls(len(href), pa.string())))
    rest = pc.and_(pc.invert(pc.or_(absolute, rooted)), href.is_valid())
    if not pc.any(rest).as_py():
        return out
    pairs = zip(pc.filter(base, rest).to_pylist(), pc.filter(href, rest).to_pylist(), strict=True)
    return pc.replace_with_mask(out, rest, pa.array([resolve(b, h) for b, h in pairs], pa.string()))


@arrow_udf(T.StringType())
def _join(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for base, href in columns:
        yield resolved(base, href)


def resolve_url(base: Column, href: Column) -> Column:
    """A reference resolved against the page it stands on; null where it is malformed."""
    return _join(base, href)


_PART_NAMES = ("scheme", "host", "path", "query", "fragment")
_PARTS = T.StructType([T.StructField(k, T.StringType()) for k in _PART_NAMES])


def split_urls(urls: pa.Array) -> pa.StructArray:
    """The parts of URLs; a part that is not there is empty, and so are all parts of a malformed or null one."""
    found = pc.extract_regex(urls, _ORDINARY)
    rest = pc.invert(found.is_valid())
    parts = [pc.fill_null(pc.struct_field(found, k), "") for k in _PART_NAMES]
    if pc.any(rest).as_py():
        odd = [_split(u) for u in pc.filter(urls, rest).to_pylist()]
        parts = [pc.replace_with_mask(p, rest, pa.array([o[i] for o in odd], pa.string())) for i, p in enumerate(parts)]
    return pa.StructArray.from_arrays(parts, _PART_NAMES)


@arrow_udf(_PARTS)
def url_parts(urls: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for a in urls:
        yield split_urls(a)


@arrow_udf(T.MapType(T.StringType(), T.StringType()))
def query_map(urls: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """First value of each name of the query, names in small letters; names without a value are left out."""
    from ..markup.links import query_ids

    for a in urls:
        yield pa.array([None if u is None else list(query_ids(u).items()) for u in a.to_pylist()], pa.map_(pa.string(), pa.string()))


def _last_part(url: str) -> str | None:
    name = PurePosixPath(_split(url).path).name
    return unquote(name) if name.lower().endswith(".pdf") else None


@arrow_udf(T.StringType())
def pdf_basename(urls: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The decoded last part of a URL's path if it ends in .pdf, else null."""
    yield from each(_last_part, urls, lambda a: pc.match_substring(a, ".pdf", ignore_case=True), None)


def is_ignored_link(href: Column) -> Column:
    """The raw link holds a part by which it is not an article's."""
    low = F.lower(href)
    out = F.lit(False)
    for part in IGNORED_PARTS:
        out = out | F.contains(low, F.lit(part))
    return out


def is_document_link(href: Column) -> Column:
    low = F.lower(href)
    return F.contains(low, F.lit("documentdownload.ashx")) | F.endswith(low, F.lit(".pdf")) | F.contains(low, F.lit(".pdf?"))


def is_embedded_document(src: Column, data: Column) -> Column:
    return F.coalesce(F.contains(F.lower(F.coalesce(F.nullif(src, F.lit("")), data)), F.lit(".pdf")), F.lit(False))


def has_content_path(path: Column) -> Column:
    return F.size(F.split(F.regexp_replace(path, "/+$", ""), "/")) >= 2


def page_url(template: Column, number: Column) -> Column:
    return F.replace(template, F.lit("{page}"), number.cast("string"))


def page_number(href: Column) -> Column:
    """The first page number of a pager link, null if it has none."""
    return F.nullif(F.regexp_extract(href, "PageID/([0-9]+)", 1), F.lit("")).cast("int")


def page_template(href: Column) -> Column:
    return F.regexp_replace(href, "PageID/[0-9]+", "PageID/{page}")


def doc_key(document_id: Column, download_url: Column) -> Column:
    """The registry's key: the id if there is one, else the whole URL."""
    return F.when(document_id.isNotNull() & (document_id != ""), F.concat(F.lit("doc_"), document_id)).otherwise(download_url)
