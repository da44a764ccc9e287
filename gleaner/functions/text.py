"""Scalar functions on text, as Catalyst expressions wherever one can say it."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .rules import SPACES, UNNAMED, UNSAFE_CHARACTERS


def let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, rf"\A{SPACES}+|{SPACES}+\z", "")


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def before_hyphen(c: Column) -> Column:
    return strip(F.split_part(c, F.lit("-"), F.lit(1)))


_EDGES = " ._"
_LONGEST_STEM, _LONGEST_EXTENSION = 150, 16


def _trim_edges(c: Column) -> Column:
    return F.btrim(c, F.lit(_EDGES))


def sanitize_filename(name: Column, max_bytes: int = 180, strict: bool = False) -> Column:
    """A safe file name that keeps letters of all scripts.

    A name of more than max_bytes bytes keeps its extension, that is, all from the last
    dot on, and the first 150 characters of its stem; strict cuts further, so that it
    does fit, and takes what has over 16 bytes for no extension.
    """
    one_line = F.translate(name, UNSAFE_CHARACTERS, "_" * len(UNSAFE_CHARACTERS))
    clean = _trim_edges(F.regexp_replace(one_line, rf"{SPACES}+", " "))

    def fit(clean: Column) -> Column:
        # The part after the last dot, if something stands before it.
        last = F.substring_index(clean, ".", -1)
        extension = F.when(F.length(last) < F.length(clean) - 1, F.concat(F.lit("."), last)).otherwise("")
        if strict:
            extension = let(extension, lambda e: F.when(F.octet_length(e) <= _LONGEST_EXTENSION, e).otherwise(""))
        short = let(extension, lambda e: cut(clean, e))
        return F.when(clean == "", F.lit(UNNAMED)).when(F.octet_length(clean) > max_bytes, short).otherwise(clean)

    def cut(clean: Column, extension: Column) -> Column:
        stem = F.substring(clean, F.lit(1), F.length(clean) - F.length(extension))
        short = F.concat(_trim_edges(F.substring(stem, 1, _LONGEST_STEM)), extension)
        if not strict:
            return short
        room = F.greatest(F.lit(1), F.floor((F.lit(max_bytes) - F.octet_length(extension)) / 4)).cast("int")
        tight = F.concat(_trim_edges(F.substring(stem, F.lit(1), F.least(F.lit(_LONGEST_STEM), room))), extension)
        return F.when(F.octet_length(short) <= max_bytes, short).otherwise(tight)

    return F.when(name.isNotNull(), let(clean, fit))


#: One unsafe character, or a run of white space that holds none.
_MARKS = re.compile("(?P<unsafe>[" + re.escape(UNSAFE_CHARACTERS) + "])|(?:(?![" + re.escape(UNSAFE_CHARACTERS) + "])" + re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: "\\u" + m[1].rjust(4, "0"), SPACES) + ")+")


def safe_name(name: str, max_bytes: int = 180, strict: bool = False) -> str:
    """What sanitize_filename makes of one name, for a task that learns it from a response."""
    clean = _MARKS.sub(lambda m: "_" if m["unsafe"] else " ", name).strip(_EDGES) or UNNAMED
    over = lambda text: len(text.encode()) - max_bytes
    if over(clean) <= 0:
        return clean
    head, _, tail = clean.rpartition(".")
    if not head or strict and len(tail.encode()) >= _LONGEST_EXTENSION:
        head, end = clean, ""
    else:
        end = "." + tail
    wide = head[:_LONGEST_STEM].strip(_EDGES) + end
    if not strict or over(wide) <= 0:
        return wide
    return head[: min(_LONGEST_STEM, max(1, -over(end) // 4))].strip(_EDGES) + end


def header_parameters(header: str) -> list[tuple[str, str]]:
    """Names and raw values of a header's parameters; a semicolon within quotes ends none."""
    pieces, quoted = [""], False
    for part in re.split('([";])', header):
        if part == ";" and not quoted:
            pieces.append("")
        else:
            quoted ^= part == '"'
            pieces[-1] += part
    named = (p.partition("=") for p in pieces if "=" in p)
    return [(name.strip(), value.strip()) for name, _, value in named]


def _extended(value: str) -> str | None:
    """The text of an extended value in UTF-8; None for any other charset."""
    charset, _, rest = value.partition("'")
    language, quote, text = rest.partition("'")
    text = text.partition(";")[0]
    return unquote(text) if charset in ("UTF-8", "utf-8") and quote and not language and text else None


def _unquoted(value: str) -> str:
    """A quoted value without its quotes, else its first word; an empty one in quotes stays as it is."""
    inner, end, _ = value[1:].partition('"')
    if value.startswith('"') and end and inner:
        return inner.strip()
    return (value.split() or [""])[0]


def disposition_name(header: str | None) -> str | None:
    """The file name in a Content-Disposition header, the extended one first, damage by a wrong charset mended."""
    given = header_parameters(header or "")
    for name, value in given:
        if name.split()[-1:] == ["filename*"] and (text := _extended(value)) is not None:
            return text
    plain = next((_unquoted(v) for name, v in given if name.split()[-1:] == ["filename"] and v), None)
    if plain is None:
        return None
    try:
        return bytes(map(ord, plain)).decode()
    except ValueError:  # no such bytes, or not in UTF-8
        return plain


def each(f: Callable[[str], object], batches: Iterator[pa.Array], worth: Callable[[pa.Array], pa.Array] | None = None, other: str | None = "same") -> Iterator[pa.Array]:
    """f of each string that is worth it; the others stay the same or become null."""
    for a in batches:
        todo = pc.fill_null(worth(a) if worth else a.is_valid(), False)
        rest = a if other == "same" else pa.nulls(len(a), pa.string())
        picked = pc.filter(a, todo).to_pylist()
        yield pc.replace_with_mask(rest, todo, pa.array([f(x) for x in picked], pa.string())) if picked else rest


@arrow_udf(T.StringType())
def decode_content_disposition(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The file name in a header; null if it has none."""
    yield from each(disposition_name, batches, lambda a: pc.match_substring(a, "filename"), None)


@arrow_udf(T.StringType())
def percent_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """%XX decoded; a plus sign and malformed escapes stay."""
    yield from each(unquote, batches, lambda a: pc.match_substring(a, "%"))
