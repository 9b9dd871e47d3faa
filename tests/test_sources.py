import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.functions.jsonpath import path_exists
from quire.functions.text import rstrip, splitlines, strip
from quire.sources import mail, routing, sheets
from quire.sources.text import csv_to_text, file_text, paginate, strip_html


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text", ["", "a", " a ", "\t\n a b \r\n", "\xa0a ", "\x1c\x85x　", "  \n"])
def test_strip_like_python(spark, text):
    c = F.lit(text)
    assert one(spark, strip(c)) == text.strip() and one(spark, rstrip(c)) == text.rstrip()


@pytest.mark.parametrize("text", ["", "a", "a\nb", "a\n", "\n", "a\r\nb\rc\n\nd", "a\x0bb\x0cc\x85d e\x1cf", "\n\n"])
def test_splitlines_like_python(spark, text):
    assert one(spark, splitlines(F.lit(text))) == text.splitlines()


@pytest.mark.parametrize(
    "path,reader,label",
    [
        ("a/b.pdf", "pdf", "pdf"), ("b.DOC", "docx", "doc"), ("x.tar.JPEG", "image", "image"), ("p/q.htm", "text", "text"), ("m.eml", "email", "email"),
        ("t.xlsm", "excel", "excel"), ("noext", "text", "unknown"), ("a.b/c", "text", "unknown"), ("x.zzz", "text", "zzz"), ("y.jpe", "image", "jpe"), ("z.pdf.gz", "pdf", "gz"), ("w.mp3", "text", "mp3"), (".csv", "text", "unknown"),
    ],
)
def test_routes(spark, path, reader, label):
    row = spark.createDataFrame([(path,)], "p string").select(routing.reader(F.col("p")).alias("r"), routing.format_label(F.col("p")).alias("f")).first()
    assert (row.r, row.f) == (reader, label)


@pytest.mark.parametrize("n,pages", [(0, 1), (1, 1), (3000, 1), (3001, 2), (9000, 3)])
def test_pages(spark, n, pages):
    rows = paginate(spark.createDataFrame([(1, "é" * n)], "id long, text string")).orderBy("page_number").collect()
    assert [r.page_number for r in rows] == list(range(1, pages + 1)) and "".join(r.native_text for r in rows) == "é" * n
    assert paginate(spark.createDataFrame([(1, None)], "id long, text string")).first().native_text == ""


def test_html():
    assert " ".join(strip_html("<p>a &amp; b</p><script>x</script>t").split()) == "a & b x t"
    assert strip_html("<p>a &amp; b</p><script>x</script>t", visible=True) == "a & b t"
    assert strip_html("a<p>b <unfinished") == "a b "


def test_csv():
    assert csv_to_text('a,"b, c"\nd,""\n') == "a, b, c\nd, "


def test_file_text(spark):
    rows = [("a.HTML", b"<b>x</b>"), ("b.csv", b"1,2"), ("c.txt", b"caf\xe9"), ("d.md", "é".encode())]
    got = spark.createDataFrame(rows, "p string, c binary").select("p", file_text(F.col("c"), F.col("p")).alias("t")).collect()
    assert {r.p: r.t for r in got} == {"a.HTML": "x", "b.csv": "1, 2", "c.txt": "caf�", "d.md": "é"}


MAIL = b"""Subject: =?utf-8?q?Caf=C3=A9?=
From: a@example.org
Date: Mon, 1 Jan 2024 00:00:00 +0000
MIME-Version: 1.0
Content-Type: multipart/mixed; boundary=B

--B
Content-Type: text/plain; charset=utf-8

plain
--B
Content-Type: text/html; charset=utf-8

<p>rich</p>
--B
Content-Type: application/pdf
Content-Disposition: attachment; filename="x.pdf"

zzz
--B--
"""


def test_mail(spark):
    files = spark.createDataFrame([("m.eml", MAIL), ("n.eml", b"Subject: s\n\nbody")], "source_path string, content binary")
    rows = {r.source_path: r for r in mail.mail_pages(files).collect()}
    assert rows["m.eml"].native_text.strip() == "rich" and rows["m.eml"].metadata == {"subject": "Café", "from": "a@example.org", "date": "Mon, 1 Jan 2024 00:00:00 +0000", "attachments": '["x.pdf"]'}
    assert rows["n.eml"].native_text == "body"
    assert [tuple(r) for r in mail.attachments(files).collect()] == [("m.eml", "x.pdf")]
    long = spark.createDataFrame([("l.eml", b"Subject: s\n\n" + b"x" * 3001)], files.schema)
    assert [r.metadata for r in mail.mail_pages(long).orderBy("page_number").collect()][1] == {"subject": "s"}


def workbook():
    out = io.BytesIO()
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="One" r:id="r1"/><sheet name="Empty" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="/xl/worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t> Name </t></si><si><r><t>To</t></r><r><t>tal</t></r></si></sst>')
        cells = '<row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2" t="s"><v>1</v></c></row><row r="4"><c r="A4" t="inlineStr"><is><t>x</t></is></c><c r="B4"><v>2.0</v></c></row><row r="5"><c r="B5"><v>2.5</v></c></row>'
        z.writestr("xl/worksheets/s1.xml", f'<worksheet xmlns="{main}"><sheetData>{cells}</sheetData><mergeCells><mergeCell ref="A4:A5"/></mergeCells></worksheet>')
        z.writestr("xl/worksheets/s2.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
    return out.getvalue()


def test_sheets(spark):
    rows = sheets.sheet_pages(spark.createDataFrame([("b.xlsx", workbook())], "source_path string, content binary")).orderBy("page_number").collect()
    assert (rows[0].headers, rows[0].rows) == (["Name", "Total"], [["x", "2"], ["x", "2.5"]])
    assert rows[0].markdown == "| Name | Total |\n| --- | --- |\n| x | 2 |\n| x | 2.5 |" and rows[0].native_text == "Name\nTotal\nx\n2\nx\n2.5"
    assert (rows[1].headers, rows[1].rows, rows[1].markdown, rows[1].native_text) == ([], [], "", "")
    with pytest.raises(ValueError):
        sheets.sheets(b"\xd0\xcf old format")


def test_read_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"abc")
    row = routing.read_files(spark, str(tmp_path)).first()
    assert row.content_hash == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad" and row.reader == "text"
    with pytest.raises(Exception):
        routing.read_files(spark, str(tmp_path / "missing")).first()


@pytest.mark.parametrize(
    "path,expected",
    [
        ("$.a", [True, True, False, False]), ("$.a.b", [True, False, False, False]), ("$.c[*].d", [False, True, False, False]), ("$.c[*] ? (@.d > 1)", [False, True, False, False]),
        ("$.c ? (@.d == 1 && @.e == \"x\")", [False, True, False, False]), ("$.c[5]", [False, False, False, False]), ("$", [True, True, True, False]),
    ],
)
def test_json_paths(spark, path, expected):
    rows = ['{"a": {"b": null}}', '{"a": 1, "c": [{"d": 1, "e": "x"}, {"d": 2}]}', "[1]", "no json"]
    got = spark.createDataFrame(list(enumerate(rows)), "i int, t string").select("i", path_exists(F.col("t"), path).alias("x")).orderBy("i").collect()
    assert [r.x for r in got] == expected
    assert one(spark, path_exists(F.lit(None).cast("string"), path)) is False


def test_path_grammar():
    from quire.functions.jsonpath import Path, exists_in

    text = '{"a": [{"b": 1, "t": "xy"}, {"b": 5, "c": {"d": null}}], "n": 2, "odd name": true}'
    true = ["$.a[1].c.d", "$.a[0,7].b", "$.a[*] ? (@.b > 1).c", "$.a ? (@.b == 1 || @.b == 9)", "$ ? (!(@.n > 2))", "$ ? (exists(@.a.c))", '$.a ? (@.t starts with "x")', '$.a ? (@.t like_regex "y$")', "$.**.d", "$.*", '$."odd name" ? (@ == true)', "$.a ? (@.b > 1 && (@.b < 9 || @.b == 1))", "strict $.a ? (@.b == $.a.b)", "$.a ? (@.c.d == null)"]
    false = ["$.a[2]", "$.a[*].x", "$.a ? (@.b > 5)", "$ ? (!(@.n >= 2))", '$.a ? (@.t starts with "y")', "$.a ? (@.b == 1 && @.b == 5)", "$.n ? (@ > \"1\")", "$.a ? (@.b == true)"]
    assert [p for p in true if not exists_in(text, Path(p))] == [] and [p for p in false if exists_in(text, Path(p))] == []
    for wrong in ("a.b", "$.", "$.a ? (@.b)", "$[x]", "$.a)", "$ ? (@.b ==)"):
        with pytest.raises(ValueError):
            Path(wrong)


def test_containment(spark):
    from quire.functions.jsonpath import json_contains

    rows = ['{"a": "x", "b": [1, 2, {"c": "y"}]}', '{"a": 1}', "[1, 2]", "not json", None]
    frame = spark.createDataFrame(list(enumerate(rows)), "i int, j string")
    hits = lambda wanted: [r.i for r in frame.where(json_contains(F.col("j"), wanted)).orderBy("i").collect()]
    assert hits({"a": "x"}) == [0] and hits({"a": 1}) == [1] and hits({"a": "1"}) == [] and hits({"b": [{"c": "y"}, 1]}) == [0]
    assert hits([2]) == [2] and hits(2) == [2] and hits({}) == [0, 1] and hits({"b": [3]}) == []


def test_stems(spark):
    from quire.operators import retrieval

    words = "licenses License parties classes glass bus running runs red ring quickly added as".split()
    rows = retrieval.with_tokens(spark.createDataFrame([(1, " ".join(words)), (2, None)], "id int, overview string")).collect()
    assert rows[0].tokens == [retrieval.stem_word(w.lower()) for w in words] == ["licens", "license", "party", "class", "glass", "bus", "runn", "run", "red", "ring", "quick", "add", "as"]
    assert rows[1].tokens == []
