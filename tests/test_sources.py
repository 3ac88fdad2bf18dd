import io
import json
import zipfile

import pytest

from telar.sources import files, pages, sinks, tiles
from telar.streaming import incremental


def xlsx(rows):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    cell = lambda v: f'<c t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f"<c><v>{v}</v></c>"
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="Hoja1" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>" + "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in rows) + "</sheetData></worksheet>")
    return b.getvalue()


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(k, v):
    return varint(k << 3 | 2) + varint(len(v)) + v


def tile():
    feature = varint(1 << 3) + varint(7) + field(2, varint(0) + varint(0) + varint(1) + varint(1))
    layer = field(1, b"limites") + field(2, feature) + field(3, b"name") + field(3, b"area") + field(4, field(1, b"Norte")) + field(4, varint(4 << 3) + varint(42))
    return field(3, layer)


def test_json_paths():
    data = {"a": {"b": "x"}, "s": [{"h": "1", "p": ["2", "3"]}, {"p": "4"}], "f": True, "n": 0}
    assert files.values_at(data, "a.b") == ["x"]
    assert files.values_at(data, "s[].p[]") == ["2", "3", "4"]
    assert files.values_at(data, "f") == [] and files.values_at(data, "n") == ["0"] and files.values_at(data, "zz.y") == []
    assert files.json_document(json.dumps(data), {"texto": ["s[].p[]"], "titulo": ["a.b"]})[:2] == ("2\n3\n4", "x")
    assert "sí" in files.json_document(json.dumps(data), {})[0]


def test_tables():
    text, extra = files.csv_document('col;otra;\n"uno\ndos";3|4;x\n;;\n'.encode())
    assert text == "col: uno dos | otra: 3/4" and extra["delimitador"] == ";"
    assert files.xlsx_document(xlsx([["a", "b"], ["x", 3.0], ["", ""]]))[0] == "hoja: Hoja1\na: x | b: 3"
    assert tiles.features(tile()) == [("limites", "7", {"name": "Norte", "area": "42"})]
    assert tiles.features(b"\xff\xff no tile") == []


def test_corpus(spark, tmp_path):
    root = tmp_path / "c"
    for name, raw in {"1_a/i/x.json": b'{"title": "T", "body": ["uno", "dos"]}', "1_a/i/y.csv": b"a,b\n1,2\n", "2_b/j/z.xlsx": xlsx([["a"], ["v"]]), "2_b/tiles/1/2/3.pbf": tile(), "3_c/k/t.txt": "ñ".encode(), "3_c/k/p.pdf": b"%PDF", "3_c/k/.DS_Store": b"x", "3_c/k/~$t.xlsx": b"x"}.items():
        p = root / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(raw)
    f = files.corpus_files(spark, str(root))
    assert f.count() == 6
    d = {r.fuente: r for r in files.documents(f, {"1_a/i": {"texto": ["body[]"], "titulo": ["title"]}}).collect()}
    assert d["1_a/i/x.json"].text == "uno\ndos" and d["1_a/i/x.json"].title == "T"
    assert d["3_c/k/t.txt"].text == "ñ" and "capa: limites" in d["2_b/tiles/1/2/3.pbf"].text
    assert d["3_c/k/p.pdf"].error and d["3_c/k/p.pdf"].text == ""
    plugged = {r.fuente: r for r in files.documents(f, decoders={"pdf": lambda raw: ("leído", {})}).collect()}
    assert plugged["3_c/k/p.pdf"].text == "leído" and "no mapping" in plugged["1_a/i/x.json"].error
    assert files.documents(f, {}).where("fuente = '1_a/i/x.json'").first().text == "T\nuno\ndos"
    assert [r.fuente for r in files.corpus_files(spark, str(root), only="csv").collect()] == ["1_a/i/y.csv"]


def test_shipped_mappings(spark):
    alert = {"url": "u", "alerta_meta": {"tipo": "T", "municipios": ["A", "B"], "tema_clave": "K", "codigo": "C1"}, "body_paragraphs": ["p"]}
    rows = [("F3_Dinamicas_Territoriales/Alertas_Tempranas/a.json", alert), ("F1_IA_y_Capacidades_Estrategicas/CENIA/b.json", {"title": "T", "sections": [{"heading": "H", "paragraphs": ["x", "y"]}], "lists": ["z"]}), ("F3_Dinamicas_Territoriales/SIPRI/sipri_registro.json", {"url": "u", "nombre": "N", "md5": "m", "v": {"path": "p", "t": "hola"}})]
    f = spark.createDataFrame([(p, "json", bytearray(json.dumps(d).encode())) for p, d in rows], "fuente string, formato string, content binary")
    got = {r.fuente.split("/")[-1]: r for r in files.documents(f).collect()}
    assert got["a.json"].text == "T\nA\nB\nK\np" and got["a.json"].title is None and got["a.json"].extra["codigo"] == "C1"
    assert got["b.json"].text == "T\nH\nx\ny\nz" and got["sipri_registro.json"].text == "N\nhola"


def test_pages_by_engines(spark):
    long = "palabra " * 20

    def broken(raw):
        raise OSError("no")

    def layer(raw):
        return [x.decode() for x in raw.split(b"\f")]

    ocr = lambda raw: ["visto " * 30]
    f = spark.createDataFrame([("a.pdf", "pdf", bytearray(f"{long}\f{long}".encode())), ("b.pdf", "pdf", bytearray(b"x\f")), ("c.jpg", "jpg", bytearray(b"")), ("d.txt", "txt", bytearray(b"t")), ("e.pdf", "pdf", None)], "fuente string, formato string, content binary")
    got = [(r.fuente, r.page_no, r.lector) for r in pages.document_pages(f, [("uno", broken), ("dos", layer)], ocr).orderBy("fuente", "page_no").collect()]
    assert got == [("a.pdf", 0, "dos"), ("a.pdf", 1, "dos"), ("b.pdf", 0, "ocr"), ("c.jpg", 0, "ocr"), ("e.pdf", 0, "ocr")]
    bare = {r.fuente: r for r in pages.document_pages(f, [("uno", broken)]).collect()}
    assert "uno: no" in bare["a.pdf"].error and "no OCR" in bare["c.jpg"].error
    assert pages.document_pages(f, [("dos", layer)]).where("fuente = 'b.pdf'").count() == 2
    assert pages.page_lines(pages.document_pages(f, [("dos", layer)])).where("doc_id = 'a.pdf'").count() == 2


def test_required(spark):
    d = spark.createDataFrame([("a", "x"), ("b", " ")], "doc_id string, texto string")
    assert files.required(d, "doc_id") is d
    for bad in ((d, "texto"), (d, "chunk_id"), (d.limit(0), "doc_id")):
        with pytest.raises(ValueError):
            files.required(*bad)


def test_inventory_sheet(spark, tmp_path):
    p = tmp_path / "inv.xlsx"
    p.write_bytes(xlsx([["Carpeta", "Nombre estandarizado", "DOC_ID", "Fenómeno"], ["a\\b", "x.pdf", "D1", "F2"]]))
    assert [tuple(r)[:4] for r in files.inventory_sheet(spark, str(p)).collect()] == [("a\\b", "x.pdf", "D1", "F2")]
    (tmp_path / "other.xlsx").write_bytes(xlsx([["x", "y"], ["1", "2"]]))
    (tmp_path / "more.xlsx").write_bytes(xlsx([["DOC_ID", "Fenómeno", "Carpeta", "Observatorio", "Nombre estandarizado"], ["D2", "F1", "c", "O", "y.pdf"], ["", "", "", "", ""]]))
    both = files.inventory_sheet(spark, str(tmp_path / "*.xlsx")).orderBy("doc_id_oficial").collect()
    assert [(r.doc_id_oficial, r.carpeta, r.observatorio) for r in both] == [("D1", "a\\b", None), ("D2", "c", "O")]
    with pytest.raises(ValueError):
        files.inventory_sheet(spark, str(tmp_path / "other.xlsx"))


def test_queries_and_jsonl(spark, tmp_path):
    p = tmp_path / "q.jsonl"
    p.write_text('{"query_id": "q2", "texto": " dos "}\n\n{"pregunta": "uno"}\n')
    assert [tuple(r) for r in files.query_file(spark, str(p)).orderBy("query_id").collect()] == [("q002", "uno"), ("q2", "dos")]
    p2 = tmp_path / "t.txt"
    p2.write_text("una\n{x\n")
    assert files.query_file(spark, str(p2)).count() == 2
    rows = files.jsonl(spark, str(p), "query_id string, texto string").collect()
    assert len(rows) == 2
    with pytest.raises(ValueError):
        files.chunks_or_documents(spark.range(1))


def test_graphml_round_trip(spark, tmp_path):
    e = spark.createDataFrame([("A & B", "<C>", "regula", 2), ("C", 'D"', None, 1)], "source string, target string, relation string, n int")
    sinks.write_graphml(e, str(tmp_path / "g"))
    got = sorted((r.source, r.target, r.data["relation"] or "") for r in sinks.read_graphml(spark, str(tmp_path / "g" / "part=2")).collect())
    assert got == [("A & B", "<C>", "regula"), ("C", 'D"', "")]


def test_ordered_jsonl(spark, tmp_path):
    d = spark.createDataFrame([("B", 1), ("A", 10), ("A", 9)], "doc_id string, posicion int")
    sinks.write_jsonl(d, str(tmp_path / "o"), "doc_id", "posicion")
    lines = [x for p in sorted((tmp_path / "o").glob("part*")) for x in p.read_text().split("\n") if x]
    assert [tuple(json.loads(x).values()) for x in lines] == [("A", 9), ("A", 10), ("B", 1)]


def test_resume(tmp_path):
    p = str(tmp_path / "s.json")
    assert sinks.pending(p, {"m": 1}, 10, 4) == 0
    sinks.checkpoint(p, {"m": 1}, 10, 4, 6)
    assert sinks.pending(p, {"m": 1}, 10, 4) == 4
    with pytest.raises(ValueError):
        sinks.pending(p, {"m": 2}, 10, 4)
    with pytest.raises(ValueError):
        sinks.pending(p, {"m": 1}, 10, 5)


def test_manifest_and_triplets(spark, tmp_path):
    got = sinks.manifest(str(tmp_path / "m.json"), {"k": 1}, filas=3)
    assert json.loads((tmp_path / "m.json").read_text()) == got and got["versiones"]["pyspark"] and got["cifras"] == {"filas": 3}
    e = spark.createDataFrame([("a", "b", "regula", "regula;opera", "D1;D2", "c", "e")], "source string, target string, relation string, relations string, doc_ids string, chunk_ids string, evidence string")
    sinks.write_triplets(e, str(tmp_path / "t"))
    lines = [x for p in (tmp_path / "t").glob("part*") for x in p.read_text().split("\n") if x]
    assert [json.loads(x)["relation"] for x in lines] == ["regula"]


def test_incremental_ingest(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "doc_id bigint, text string, ingerido timestamp"
    put = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string, at string").selectExpr("doc_id", "text", "CAST(at AS TIMESTAMP) AS ingerido").write.mode("append").parquet(src)
    put([(1, "uno", "2024-01-01"), (2, " uno", "2024-01-02"), (3, None, "2024-01-02")])
    run = lambda: incremental.ingest_available(incremental.new_documents(spark, src, schema), out, check)
    run()
    put([(4, "uno", "2024-01-03"), (5, "dos", "2024-01-03")])
    run()
    ids = sorted(r.doc_id for r in spark.read.parquet(out).collect())
    assert len(ids) == 3 and 5 in ids and 3 in ids


def test_no_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from telar import session

    fake = lambda master, folder: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: folder), sparkContext=SimpleNamespace(master=master, applicationId="a"))
    assert session.shared_dir(fake("yarn", "hdfs://x/c/")) == "hdfs://x/c/telar-a"
    with pytest.raises(ValueError):
        session.shared_dir(fake("yarn", None))
