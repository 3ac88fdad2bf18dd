import hashlib

import pytest
from pyspark.sql import functions as F

from telar.functions import paths, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(f(F.col("t")).alias("x")).first()[0]


def norm(spark, value):
    return one(spark, value, text.normalise)


@pytest.mark.parametrize(
    "a, b",
    [
        ("Bogot\u00e1", "Bogota\u0301"), ("a\nb", "a\r\nb"), ("a\nb", "a\rb"), ("a", "\ufeffa"), ("a b", "a\u00a0b"), ("internacional", "inter\u00adnacional"), ("a\nb", "a\u2028b"), ("a\nb", "a\u2029b"), ("ab", "a\u200e\u200f\u2060b"), ("a b", "  a \t b  "), ("a\n\nb", "a\n\n\n\n\nb"),
    ],
)
def test_same_form(spark, a, b):
    assert norm(spark, a) == norm(spark, b)


def test_line_break_is_kept_and_idempotent(spark):
    assert norm(spark, "L\u00ednea A\nL\u00ednea B") == "L\u00ednea A\nL\u00ednea B"
    once = norm(spark, "  T\u00edtulo\r\n\n\n\nCuerpo\u00a0del   texto.  \n\n\n")
    assert once == "T\u00edtulo\n\nCuerpo del texto." and norm(spark, once) == once


def test_fingerprint(spark):
    assert [one(spark, v, text.fingerprint) for v in (None, "", " \n\t")] == [None] * 3
    h = one(spark, "texto", text.fingerprint)
    assert h == hashlib.sha1(b"texto").hexdigest()[:12]
    assert one(spark, "texto", lambda c: text.fingerprint(c, 16)).startswith(h)


def test_usable(spark):
    assert one(spark, "Figura 3", text.usable) is False
    assert one(spark, "palabra " * 50, text.usable) is True


@pytest.mark.parametrize("line, yes", [("Page 4", True), ("4 / 120", True), ("- 12 -", True), ("P\u00e1gina 7 de 9", True), ("En 2004 hubo 12", False), ("", False), ("12345", False)])
def test_page_numbers(spark, line, yes):
    assert one(spark, line, text.is_page_number) is yes


def test_values_and_records(spark):
    assert one(spark, "- uno\n- dos | tres", text.flatten_value) == "uno; dos / tres"
    assert one(spark, "uno\n\n dos", text.flatten_value) == "uno dos"
    assert one(spark, 3.0, lambda c: text.format_value(c, "double"), "double") == "3"
    assert one(spark, 2.5, lambda c: text.format_value(c, "double"), "double") == "2.5"
    assert one(spark, True, lambda c: text.format_value(c, "boolean"), "boolean") == "s\u00ed"
    assert one(spark, None, lambda c: text.format_value(c, "boolean"), "boolean") == ""
    assert one(spark, "x", lambda c: text.record_line({"a": (c, "string"), "b": (F.lit(" "), "string"), "c": (F.lit(1), "int")})) == "a: x | c: 1"


def test_markup(spark):
    assert one(spark, "# T\n![alt](u) [ver](v) `c`\n```\nx\n```", text.markdown_text) == "T\n ver c"
    assert one(spark, "<p>a&amp;b</p><script>x</script> <b>c</b>", text.html_text) == "a&b c"


def test_shift_and_closers(spark):
    plain = "El observatorio regional presento el informe anual"
    moved = "".join(chr(ord(c) - 29) if 33 <= ord(c) - 29 <= 126 else c for c in plain)
    assert one(spark, plain, text.repair_shift) == plain
    assert "observatorio" in one(spark, "".join(chr(ord(c) + 1) if c != " " else c for c in plain), text.repair_shift)
    assert moved
    arabic = ".\u0645\u0631\u062d\u0628\u0627 \u0628\u0643\u0645 \u0641\u064a \u0627\u0644\u0645\u0646\u0635\u0629"
    assert one(spark, arabic, text.move_closers) == arabic[1:] + "."
    assert one(spark, ".latin text", text.move_closers) == ".latin text"


def test_wraps(spark):
    assert one(spark, "pala-\nbra y\notra. Fin\nNuevo", text.join_wrapped) == "palabra y otra. Fin\nNuevo"


@pytest.mark.parametrize("p, want", [("1_mar/x/a.pdf", 1), ("C:\\datos\\2_orbita\\x\\a.pdf", 2), ("3_f/x.csv", 3), ("otra/x.pdf", None)])
def test_topic(spark, p, want):
    assert one(spark, p, paths.topic) == want


@pytest.mark.parametrize("p, want", [("a/b.PDF", "pdf"), ("b.mvt", "pbf"), ("b.jpeg", "jpg"), ("b.xls", "xlsx"), ("pdf/b.docx", None), ("b.html", None), ("b", None)])
def test_format(spark, p, want):
    assert one(spark, p, paths.format_of) == want


def test_paths(spark):
    assert one(spark, "x/page_07/a.pdf", paths.is_page) and not one(spark, "x/pages/a.pdf", paths.is_page)
    assert one(spark, "a/tiles/5/10/8.pbf", paths.is_tile) and not one(spark, "a/b.pdf", paths.is_tile)
    assert tuple(one(spark, "a/tiles/5/10/x_8.pbf", paths.tile_place)) == (5, 10, 8)
    assert one(spark, "a/b/c/d.pdf", paths.institution) == "a/b"
    assert [one(spark, v, lambda c: paths.topic_code(c, F.lit("3_x/a.pdf"))) for v in ("F2", "2", "Fen\u00f3meno 1", None, "x")] == [2, 2, 1, 3, 3]


def test_catalogue_files_and_alerts(spark):
    f = lambda c: paths.is_catalogue_file(c, ("catalogo", "registro"))
    assert [one(spark, p, f) for p in ("a/Catalogo_1.json", "a/nota.json", "a/tiles/1/2/registro_3.pbf")] == [True, False, False]
    assert one(spark, "A-1", lambda c: text.alert_title(c, F.lit("Norte"))) == "Alerta A-1 — Norte"
    assert one(spark, " ", lambda c: text.alert_title(c, F.lit("Norte"))) == "Alerta Norte"
    assert one(spark, None, lambda c: text.alert_title(c, F.lit(None).cast("string"))) is None


def test_documents_with_a_broken_map(spark):
    good = "The committee reviewed the plan and published a report on the border."
    moved = "".join(chr(ord(c) - 29) if 32 + 29 < ord(c) < 127 else c for c in good)
    broken = "\n".join([moved] * 5 + ["ABC"])
    healthy = "\n".join([good] * 5 + ["XKCD RFC TCP HTTP SSH NTP BGP"])
    d = spark.createDataFrame([(1, broken), (2, healthy), (3, ""), (4, None)], "k int, t string")
    got = {r.k: r for r in d.select("k", text.broken_map(d.t).alias("b"), text.repair_document(d.t).alias("r"), text.blank_unreadable(d.t).alias("x")).collect()}
    assert got[1].b and not got[2].b and got[2].r == healthy and got[2].x == healthy and got[3].r == "" and got[4].r is None
    assert "ABC" in got[1].x and moved not in got[1].x
    assert "ommittee" in got[1].r


def test_strict_paths(spark):
    d = spark.createDataFrame([("x/1_a/f.pdf",), ("sin/f.pdf",)], "p string")
    assert d.where("p LIKE 'x%'").select(paths.strict(paths.topic(d.p).cast("string"), d.p, "topic")).first()[0] == "1"
    with pytest.raises(Exception, match="no topic in sin"):
        d.select(paths.strict(paths.topic(d.p).cast("string"), d.p, "topic")).collect()
