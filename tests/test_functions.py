import os
import re
from urllib.parse import unquote

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.functions import url as U
from gleaner.functions.filenames import derive_filename, header_filename
from gleaner.functions.text import before_hyphen, decode_content_disposition, disposition_name, header_parameters, percent_decode, safe_name, sanitize_filename, strip


def column(spark, values, f, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    out = spark.createDataFrame(rows, f"i int, v {kind}").select("i", f(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(out)]


def plain_name(name):
    """The rules of a safe name, step by step."""
    name = "".join("_" if c in '\\/*?:"<>|\r\n\t\0' else c for c in name)
    name = " ".join(re.split(r"\s+", name)) if name else name
    name = name.strip(" ._") or "unnamed_document"
    if len(name.encode()) > 180:
        stem, ext = os.path.splitext(name)
        name = stem[:150].strip(" ._") + ext
    return name


NAMES = ["", "a/b.pdf", "  x  y ", "._a_.", "ሕግ" * 80 + ".pdf", "Case No. 12 " + "long " * 60, "a\u00a0\u2003b", "x\x1c\x1dy", "c:\\d?.pdf", "é" * 100, "...", "tail." + "e" * 200]


def test_sanitize_filename(spark):
    assert column(spark, NAMES, sanitize_filename) == [plain_name(n) for n in NAMES]


def test_sanitize_strict_fits(spark):
    assert all(len(n.encode()) <= 180 for n in column(spark, NAMES[:11], lambda c: sanitize_filename(c, strict=True)))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=250), min_size=1, max_size=40))
def test_sanitize_any_text(spark, names):
    assert column(spark, names, sanitize_filename) == [plain_name(n) for n in names]


def test_strip_takes_all_white_space(spark):
    assert column(spark, ["\u00a0 a b\u3000\n", "\x1f", "x"], strip) == ["a b", "", "x"]


def test_before_hyphen(spark):
    assert column(spark, ["A - b", "x", "-y", ""], before_hyphen) == ["A", "x", "", ""]


DISPOSITIONS = {
    'attachment; filename="a b.pdf"': "a b.pdf", "attachment; filename=a.pdf; x": "a.pdf", "x; filename*=UTF-8''%E1%88%95.pdf; y": "ሕ.pdf",
    "filename*=Utf-8''x": None, 'filename="á\x88\x95.pdf"': "ሕ.pdf", 'filename="ሕ.pdf"': "ሕ.pdf", 'filename=""': '""', "inline": None, "": None,
}


def test_content_disposition(spark):
    assert [disposition_name(h) for h in DISPOSITIONS] == list(DISPOSITIONS.values())
    assert column(spark, [*DISPOSITIONS, None], decode_content_disposition) == [*DISPOSITIONS.values(), None]


def test_percent_decode(spark):
    values = ["a%20b+c", "100%", "%zz", "%C3%A9", None]
    assert column(spark, values, percent_decode) == [v and unquote(v) for v in values]


@pytest.mark.parametrize(
    "row, name",
    [
        (("7", "https://h/x.pdf", "Link", "T", 'filename="h.pdf"'), "doc_7_h.pdf"),
        (("7", "https://h/a%20b.PDF?q", "Link", "T", None), "doc_7_a b.PDF"),
        (("7", "https://h/get", " Link text ", "T", None), "doc_7_Link text.pdf"),
        (("7", "https://h/get", "http://h", "T", None), "doc_7_T.pdf"),
        (("7", "https://h/get", "xy", " ", None), "doc_7_document_7.pdf"),
        ((None, "https://h/get", "", "", None), "document_doc.pdf"),
        (("7", "https://h/doc_7_x.pdf", "", "", None), "doc_7_x.pdf"),
        (("", "https://h/get", "a/b", "", None), "a_b.pdf"),
        (("7", "https://h/get", "l", "t", 'filename=""'), None),
    ],
)
def test_derive_filename(spark, row, name):
    df = spark.createDataFrame([row], "i string, u string, t string, a string, d string")
    got = df.select(derive_filename(*(F.col(c) for c in "iutad"))).first()[0]
    assert got == (name or plain_expected(row))


def plain_expected(row):
    raw = plain_name(disposition_name(row[4]))
    raw = raw if raw.lower().endswith(".pdf") else raw + ".pdf"
    return plain_name(f"doc_{row[0]}_{raw}")


LINKS = {
    "https://h/PageID/2": (True, False), "/Login": (True, False), "https://x.document.media/a": (True, False), "/a.pdf": (False, True), "/a.pdf?x=1": (False, True),
    "/a.pdf#p": (True, False), "/DocumentDownload.ASHX?id=1": (False, True), "/detail/1": (False, False), "": (False, False),
}


def test_link_kinds(spark):
    assert column(spark, LINKS, U.is_ignored_link) == [a for a, _ in LINKS.values()]
    assert column(spark, LINKS, U.is_document_link) == [b for _, b in LINKS.values()]


def test_embedded(spark):
    df = spark.createDataFrame([("a.PDF#x", None), ("", "b.pdf"), (None, None), ("x", "y.pdf")], "s string, d string")
    assert [r[0] for r in df.select(U.is_embedded_document(F.col("s"), F.col("d"))).collect()] == [True, True, False, False]


def test_urls(spark):
    assert column(spark, ["/", "/a", "/a/", "//", ""], U.has_content_path) == [False, True, True, False, False]
    df = spark.createDataFrame([("https://h/a/b", "../c d"), ("https://h/a", "//x/y"), ("https://h/a?b", "?q"), ("https://h", "http://[bad"), (None, "/z")], "b string, h string")
    assert [r[0] for r in df.select(U.resolve_url(F.col("b"), F.col("h"))).collect()] == ["https://h/c d", "https://x/y", "https://h/a?q", None, "/z"]
    q = column(spark, ["https://h/?A=1&a=2&b=&c=x+y%20z&c=3", "https://h/", None], U.query_map)
    assert q == [{"a": "2", "c": "x y z"}, {}, None]


def test_keys_and_pages(spark):
    df = spark.createDataFrame([("1", "u"), ("", "u"), (None, "u"), ("0", "u")], "i string, u string")
    assert [r[0] for r in df.select(U.doc_key(F.col("i"), F.col("u"))).collect()] == ["doc_1", "u", "u", "doc_0"]
    assert column(spark, ["/PageID/12/x", "/pageid/3", "PageID/"], U.page_number) == [12, None, None]
    assert column(spark, ["/PageID/12/PageID/3"], U.page_template) == ["/PageID/{page}/PageID/{page}"]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=250), min_size=1, max_size=40))
def test_the_name_in_a_task_is_that_of_the_column(spark, names):
    names = NAMES + names
    rows = spark.createDataFrame([(i, n, f'attachment; filename="{n}"', k) for i, (n, k) in enumerate((n, k) for n in names for k in (None, "", "7"))], "i int, n string, h string, k string")
    for strict in (False, True):
        derived = derive_filename(F.col("k"), F.lit("https://h/get"), F.lit("x"), F.lit(""), F.col("h"), strict)
        for r in rows.select("*", sanitize_filename(F.col("n"), strict=strict).alias("safe"), derived.alias("derived")).collect():
            assert r.safe == safe_name(r.n, strict=strict)
            name = header_filename(r.h, r.k, "https://h/get", strict)
            assert name is None or r.derived == name


def test_header_parameters():
    assert header_parameters('a; b = c ;d="x;y"; e') == [("b", "c"), ("d", '"x;y"')]
    assert header_parameters("") == [] and header_parameters('x="open; y=1') == [("x", '"open; y=1')]


URLS = [
    "https://h.example/a/b.pdf?x=1&y=%20#f", "http://h:80", "https://h/", "https://h/a/../b", "https://h/./a", "https://h/a?", "https://h/a#", "HTTP://h/a", "https://[bad/x", "https://h/ü", "//other/x", "/root/x?q=a/b", "/a/../b",
    "/a/./b", "/a//b", "//", "/", "", "rel/x", "../up", "?q", "#f", "mailto:a@b", "javascript:void(0)", "https://h/a b", "/a b", "https://u:p@h/x", "ftp://h/x", "/..a/b", "/a.b/c", "https://h/a;p", "/a;p?x", "https://h/a/.", "/a/..", "https://h//x", "https://h/…",
]


def test_columns_of_urls_are_those_of_single_urls():
    import pyarrow as pa
    from urllib.parse import urlsplit

    from gleaner.markup.links import resolve

    def parts(u):
        try:
            p = urlsplit(u or "")
        except ValueError:
            p = urlsplit("")
        return {"scheme": p.scheme, "host": p.netloc, "path": p.path, "query": p.query, "fragment": p.fragment}

    assert U.split_urls(pa.array([*URLS, None])).to_pylist() == [parts(u) for u in [*URLS, None]]
    for base in ["https://h.example/list/p?x", "https://h.example", "http://h:8/a/b/../c", "", "https://[bad/x", "rel", "https://h/a#f", "HTTPS://H/a"]:
        assert U.resolved(pa.array([base] * (len(URLS) + 1)), pa.array([*URLS, None])).to_pylist() == [resolve(base, u) for u in URLS] + [None]
