import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telar import config as C
from telar.functions import segment
from telar.operators import boilerplate, chunking, graph, ingest, labels, quality, reports, retrieval, tiles


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# --- chunking


def test_pack_at_and_over_the_objective():
    u = lambda n, end=".": " ".join(["p"] * n) + end
    assert [len(x.split()) for x in chunking.pack([u(100), u(100), u(50)], 200)] == [200, 50]
    assert [len(x.split()) for x in chunking.pack([u(260), u(10)], 200)] == [260, 10]
    open_ = "titulo abierto"
    got = chunking.pack([u(195), open_, u(20)], 200)
    assert [len(x.split()) for x in got] == [217]
    assert [len(x.split()) for x in chunking.pack([u(195), open_, u(60)], 200)] == [197, 60]
    assert [len(x.split()) for x in chunking.pack([u(195), open_, u(20)], 200, extend=False)] == [197, 20]


def test_units_keep_every_word():
    rng = random.Random(2)
    text = ". ".join(" ".join(rng.choice("abcdef") * rng.randrange(1, 6) for _ in range(rng.randrange(1, 60))) for _ in range(40)) + "."
    units = chunking.units_of(text, False)
    assert " ".join(units).split() == text.split()
    assert all(chunking.count(x) <= 250 for x in units)
    assert " ".join(chunking.pack(units, 200)).split() == text.split()


def test_long_units():
    items = "; ".join(f"cosa {i} de la lista" for i in range(100))
    got = chunking.shortened(items, 250)
    assert [chunking.count(x) for x in got] == [250, 250] and got[0].startswith("cosa 0 de la lista cosa 1")
    record = " | ".join(f"campo{i}: " + "v " * 30 for i in range(12))
    assert all(chunking.count(x) <= 250 for x in chunking.shortened(record, 250))
    assert chunking.shortened("pmid: 7 | title: " + "x " * 400, 250) == ["pmid: 7", "title: " + ("x " * 400).strip()]
    field = "campo: " + ". ".join("uno dos tres cuatro" for _ in range(100)) + "."
    assert all(x.startswith("campo: uno") for x in chunking.field_sentences(field))
    assert max(map(chunking.count, chunking.subdivide("palabra " * 900, 250))) <= 250


units_ = st.lists(st.tuples(st.integers(1, 30), st.sampled_from([".", "", ":", ","])), max_size=40)


@settings(max_examples=200, deadline=None)
@given(units_, st.integers(5, 40), st.booleans())
def test_packs_are_full_and_extended_by_the_rule(sizes, objective, extend):
    units = [" ".join(f"u{i}" for _ in range(n)) + end for i, (n, end) in enumerate(sizes)]
    packs = [p.split("\x00") for p in chunking.pack(units, objective, "\x00", extend)]
    assert [u for p in packs for u in p] == units
    for k, p in enumerate(packs):
        n = [chunking.count(u) for u in p]
        plain = max(1, max((i for i in range(len(n) + 1) if sum(n[:i]) <= objective), default=1))
        more = len(n) - plain
        assert more <= (2 if extend else 0)
        assert all(chunking.dangling(p[i - 1]) and sum(n[: i + 1]) <= int(1.2 * objective) for i in range(plain, len(n)))
        if k + 1 < len(packs):
            after = sum(n) + chunking.count(packs[k + 1][0])
            assert after > objective and not (extend and more < 2 and chunking.dangling(p[-1]) and after <= int(1.2 * objective))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["uno", "dos", "tres.", "B", "; ", " | ", " / ", "\n", ")/A", "\t", "fin. "]), max_size=120), st.integers(1, 12))
def test_subdivided_pieces_are_within_the_limit_and_keep_the_words(parts, most):
    text = " ".join(parts)
    got = chunking.subdivide(text, most)
    assert all(0 < chunking.count(x) <= most for x in got)
    bare = lambda t: re.sub(r"[\s;|/]+", "", t)
    assert bare("".join(got)) == bare(text)


def plain_subdivide(text, most):
    """The rule as it reads: the first kind of boundary that parts the text, each part by the same rule, neighbours put together."""
    if len(text.split()) <= most:
        return [text.strip()] if text.strip() else []
    for kind in C.EDGES:
        parts = [x for x in re.split(kind, text) if x.strip()]
        if len(parts) > 1:
            return chunking.regrouped([y for x in parts for y in plain_subdivide(x, most)], " ", most)
    return chunking.regrouped(text.split(), " ", most)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["uno", "dos", "tres", "B", ";", "|", " / ", "\n", "\t", "fin. "]), max_size=80), st.integers(1, 9))
def test_subdivide_equals_the_plain_rule(parts, most):
    text = " ".join(parts)
    assert [x.strip() for x in chunking.subdivide(text, most)] == plain_subdivide(text, most)


def test_rejoined_and_output_pieces():
    assert chunking.rejoined("la inter-\nnacional de\nla red.\nOtra:\nno") == "la internacional de la red.\nOtra:\nno"
    assert chunking.for_output("corto") == ["corto"]
    assert chunking.for_output("a b c\nd e\nf", 3) == ["a b c", "d e\nf"]
    assert chunking.for_output("Uno dos. Tres cuatro. Cinco.", 3, "pdf") == ["Uno dos.", "Tres cuatro. Cinco."]
    assert chunking.for_output("a b c d", 3, "csv") == ["a b c d"]


@pytest.mark.parametrize("lang, text, want", [
    ("es", "El Dr. Olmo vino. La pág. 3 no. ¿Y qué? Fin", ["El Dr. Olmo vino.", "La pág. 3 no.", "¿Y qué?", "Fin"]),
    ("en", "Mr. Poe saw it, e.g. here. He left.", ["Mr. Poe saw it, e.g. here.", "He left."]),
    ("de", "Das gilt z.B. hier. Nein!", ["Das gilt z.B. hier.", "Nein!"]),
    ("zh", "他走了。“谁？”没人知道！", ["他走了。", "“谁？”", "没人知道！"]),
    ("hi", "वह आया। कौन? कोई नहीं।", ["वह आया।", "कौन?", "कोई नहीं।"]),
    (None, "1. La red sigue. J. Olmo va… y sigue.", ["1. La red sigue.", "J. Olmo va… y sigue."]),
    ("es", "", []),
])
def test_segments(lang, text, want):
    assert segment.sentences(text, lang) == want


def test_cached_units(spark, tmp_path):
    path = str(tmp_path / "units")
    d = lambda *r: spark.createDataFrame(r, "doc_id string, text string, formato string")
    first = chunking.cached_units(d(("A", "Uno. Dos.", "pdf"), ("B", "x: 1\ny: 2", "csv"), ("A", "Uno. Dos.", "pdf"), ("C", None, None)), path)
    assert {r.doc_id: list(r.unidades) for r in first.collect()} == {"A": ["Uno.", "Dos."], "B": ["x: 1", "y: 2"], "C": []}
    spark.read.parquet(path).createOrReplaceTempView("before")
    changed = d(("A", "Uno. Tres.", "pdf"), ("B", "x: 1\ny: 2", "csv"))
    again = chunking.cached_units(changed, path)
    assert {r.doc_id: list(r.unidades) for r in again.collect()} == {"A": ["Uno.", "Tres."], "B": ["x: 1", "y: 2"]}
    assert spark.read.parquet(path).count() == 4
    assert rows(chunking.chunk_documents(changed, cache=path).select("chunk_id", "texto")) == rows(chunking.chunk_documents(changed).select("chunk_id", "texto"))


def test_chunk_documents(spark):
    d = spark.createDataFrame([("A", "pdf", "Una frase. Otra frase."), ("B", "csv", "a: 1\nb: 2"), ("C", None, None), ("D", "txt", " ")], "doc_id string, formato string, text string")
    got = [(r.chunk_id, r.texto, r.num_words, r.num_tokens) for r in chunking.chunk_documents(d).orderBy("chunk_id").collect()]
    assert got == [("A_c000", "Una frase. Otra frase.", 4, 8), ("B_c000", "a: 1\nb: 2", 4, 8)]


@pytest.mark.parametrize("f, n, want", [("csv", 1800, True), ("xlsx", 1800, True), ("pbf", 1800, True), ("csv", 250, False), ("csv", 251, True), ("pdf", 1800, False), ("json", 1800, False)])
def test_catalogue_flag(spark, f, n, want):
    d = spark.createDataFrame([(f, n)], "f string, n int")
    assert d.select(chunking.is_catalogue(d.f, d.n)).first()[0] is want


def test_encoder_text(spark):
    d = spark.createDataFrame([("t", "Informe anual", 2), ("t", "", None)], "texto string, contexto string, fenomeno int")
    assert [r[0] for r in d.select(chunking.encoder_text(d.texto, d.contexto, d.fenomeno, True)).collect()] == ["Informe anual — fenómeno 2\n\nt", "t"]


# --- tiles


def test_tiles(spark):
    f = spark.createDataFrame(
        [("t/1", "x", 1, "a", {"name": "N", "k": "v", "e": " "}), ("t/2", "x", 2, "a", {"name": "N"}), ("t/3", "x", 2, "a", {"name": "M"}), ("t/3", "x", 2, None, {}), ("t/1", "x", 1, "a", {"name": "N", "k": "v", "e": " "})],
        "fuente string, capa string, zoom int, fid string, props map<string,string>",
    )
    assert rows(tiles.max_zoom(f)) == [("a", "t/2", 2), ("a", "t/3", 2)]
    assert rows(tiles.max_zoom(f, 1)) == [("a", "t/2", 2)]
    assert rows(tiles.richest(f).select("fid", "fuente", "riqueza")) == [("a", "t/1", 2)]
    assert rows(tiles.inconsistent(f)) == [("a", 2)]
    assert ("t/1", "k", 1, "v") in rows(tiles.summary(f))
    assert rows(tiles.summary(f, 0))[0][3] is None
    assert tiles.assigned(f).count() == 2


# --- boilerplate


def test_repeated_lines_and_guard(spark):
    pages = "\n\n".join(f"CABECERA {i}\nuna línea {chr(110 + i)} de texto propio con palabras suficientes\notra línea distinta {chr(97 + i)} con más palabras\n{i}" for i in range(4))
    d = spark.createDataFrame([(1, pages), (2, "\n\n".join(["IGUAL"] * 4)), (3, None)], "doc_id int, text string")
    lines = boilerplate.pages(d)
    forms = {(r.doc_id, r.forma) for r in boilerplate.repeated_lines(lines).collect()}
    assert (1, "CABECERA #") in forms and (2, "IGUAL") in forms
    out = {r.doc_id: r for r in boilerplate.clean(lines).collect()}
    assert "CABECERA" not in out[1].texto and "otra línea distinta a" in out[1].texto
    assert out[2].texto.count("IGUAL") == 4  # more than the share that may go


def test_footers(spark):
    foot = "Siga todas nuestras noticias en la red de siempre"
    rows_ = [("s", i, f"Cuerpo {i} del texto\n{foot}") for i in range(3)] + [("r", 10 + i, f"Otro {i}\n{foot}") for i in range(3)] + [("r", 20, f"{foot}\ny sigue")]
    p = boilerplate.paragraphs(spark.createDataFrame(rows_, "source string, doc_id int, text string"))
    assert [(r.site, r.n) for r in boilerplate.footers(p).collect()] == [("s", 3)]
    assert rows(boilerplate.without_footers(p)) == [(0, 1), (1, 1), (2, 1)]


# --- ingest


def test_coverage_and_duplicates(spark):
    a = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "k string")
    b = spark.createDataFrame([("2",), ("3",)], "k string")
    assert rows(ingest.coverage(a, b, "k")) == [(2, 2, 1, 1, 1)]
    assert rows(ingest.missing(a, b, "k")) == [("1",)]
    assert rows(ingest.duplicate_keys(a, "k")) == [("2", 2)]
    d = spark.createDataFrame([(1, "x"), (2, " x "), (3, ""), (4, None)], "doc_id int, text string")
    assert [(r.n, r.primero) for r in ingest.duplicate_content(d).collect()] == [(2, 1)]


# --- graph and retrieval


def test_triplets():
    terms = graph.lexicon()
    t = graph.triplets_of("Estados Unidos desarrolla sistemas autónomos para la defensa. China regula el software. La Alianza coordina la cumbre.", terms)
    assert {r for _, r, _, _ in t} >= {"desarrolla", "regula", "coordina"}
    assert any(s == "Estados Unidos" and o == "sistemas autónomos" for s, _, o, _ in t)
    assert graph.triplets_of("Nada que ver.", terms) == [] and graph.triplets_of("", terms) == []


def test_entities():
    e = [x.lower() for x in graph.entities_of("La ONU y Colombia en la cumbre sobre software", graph.lexicon())]
    assert {"onu", "colombia", "cumbre", "software"} <= set(e)


def test_edges(spark):
    c = spark.createDataFrame([("D1", "D1_c0", "China regula el software."), ("D2", "D2_c0", "China regula el software."), ("D3", "D3_c0", None)], "doc_id string, chunk_id string, texto string")
    t = graph.triplets(c)
    e = graph.edges(t).collect()
    assert [(x.relation, x.doc_id, x.chunk_id, x.n_docs) for x in e] == [("regula", "D1", "D1_c0", 2)]
    assert [(x.evidence, x.doc_ids, x.chunk_ids) for x in e] == [("China regula el software. || China regula el software.", "D1;D2", "D1_c0;D2_c0")]
    assert graph.edges(t, sources=1).first().doc_ids == "D1"
    assert graph.nodes(t).count() == 2
    q = spark.createDataFrame([("q1", "china"), ("q2", "nadie")], "query_id string, entity string")
    assert rows(graph.candidates(q, t)) == [("q1", "D1"), ("q1", "D2")]
    assert "regula" in retrieval.evidence(t).where("doc_id = 'D1'").first().evidencia


def test_golden_triplets(spark):
    # The three chunks and the four triplets that the survey names as a pair.
    said = [
        ("F1-AIINDEX-001", "Estados Unidos desarrolla sistemas autónomos para defensa. Colombia regula el uso de estos sistemas."),
        ("F2-ESA-005", "La Fuerza Aérea coordina con la ONU para mitigar riesgos espaciales y la basura orbital."),
        ("F3-COL-010", "Colombia afecta la gobernanza territorial y la seguridad regional mediante decisiones de política pública."),
    ]
    c = spark.createDataFrame([(d, f"{d}_c000", t) for d, t in said] * 2, "doc_id string, chunk_id string, texto string")
    got = {(r.subject, r.relation, r.object, r.doc_id) for r in graph.once(graph.triplets(c)).collect()}
    assert got == {("Estados Unidos", "desarrolla", "sistemas autónomos", "F1-AIINDEX-001"), ("Colombia", "regula", "uso", "F1-AIINDEX-001"), ("Colombia", "afecta", "gobernanza territorial", "F3-COL-010"), ("La Fuerza Aérea", "coordina", "con la ONU", "F2-ESA-005")}
    side = retrieval.sidecar(spark.createDataFrame([("q", 1, "F1-AIINDEX-001"), ("q", 2, "otro")], "query_id string, rank int, doc_id string"), graph.once(graph.triplets(c))).orderBy("rank").collect()
    assert [(x.subject, x.object) for x in side[0].graph_evidence] == [("Estados Unidos", "sistemas autónomos"), ("Colombia", "uso")] and side[1].graph_evidence == []


@pytest.mark.parametrize("text", ["China regula Colombia y Rusia opera  Drones Grandes.", "la ia regula la ia. Rusia regula china regula rusia", "EE.UU. regula NATO. Acme Global affects China"])
def test_stated_equals_one_search_per_pair(text):
    es = graph.entities_of(text, graph.lexicon())
    for surface, relation in C.RELATIONS:
        want = {(a, relation, b) for a in es for b in es if a != b and re.search(rf"\b{re.escape(a)}\b\s+{surface}\s+\b{re.escape(b)}\b", text, re.I)}
        assert set(graph._stated(text, es, [(surface, relation)])) == want


def test_candidates_equal_containment(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 6)))
    t = [(word(), "r", word(), f"d{i}", "c", 0, "e") for i in range(60)]
    q = [(f"q{i}", word().upper()) for i in range(12)]
    want = {(k, d) for k, e in q for s, _, o, d, *_ in t if any(e.lower() in x or x in e.lower() for x in (s, o))}
    got = graph.candidates(spark.createDataFrame(q, "query_id string, entity string"), spark.createDataFrame(t, "subject string, relation string, object string, doc_id string, chunk_id string, orden int, evidence string"))
    assert set(rows(got)) == want


def test_fingerprint_tells_orders_apart(spark):
    f = lambda *r: rows(quality.fingerprint(spark.createDataFrame(r, "seq int, k string"), "k", order=("seq",)))[0]
    a, b = f((1, "A0"), (2, "A1")), f((1, "A1"), (2, "A0"))
    assert a != b and a[0] == 2 and f((7, "A0"), (9, "A1")) == a
    assert f((1, "A0"), (2, "A0"))[1] != 0 and f((1, "A0"), (2, "A0"), (3, "A1")) != f((1, "A1"))
    d = spark.createDataFrame([(i, f"k{i % 7}") for i in range(1000)], "seq int, k string")
    assert rows(quality.fingerprint(d.repartition(5), "k", order=("seq",))) == rows(quality.fingerprint(d, "k", order=("seq",)))
    assert rows(quality.fingerprint(d.limit(0), "k")) == [(0, 0)]


def test_fusion(spark):
    a = spark.createDataFrame([("q", "DOC-1", 1), ("q", "DOC-2", 2), ("q", "DOC-3", 3)], "query_id string, doc_id string, rank int")
    b = spark.createDataFrame([("q", "DOC-2", 1), ("q", "DOC-4", 2), ("q", None, 3)], "query_id string, doc_id string, rank int")
    got = [r.doc_id for r in retrieval.fuse(a, b).orderBy("rank").collect()]
    assert got[0] == "DOC-2" and set(got) == {"DOC-1", "DOC-2", "DOC-3", "DOC-4"}


def test_knn_equals_brute_force_in_blocks(spark):
    rng = random.Random(4)
    v = [(i, [rng.choice([0.0, 0.5, 1.0]) for _ in range(6)]) for i in range(120)] + [(999, None)]
    d = spark.createDataFrame(v, "vec_id long, embedding array<float>").repartition(7)
    q = d.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding")
    got = {(r.query_id, r["rank"]): r.vec_id for r in retrieval.knn(d, q, 5, block=2).collect()}
    for a, x in v:
        if a % 20 == 0 and x:
            best = sorted(((-sum(p * r for p, r in zip(x, y)), b) for b, y in v if y))[:5]
            assert [got[a, k + 1] for k in range(5)] == [b for _, b in best]
    assert retrieval.knn(d, q.limit(0), 5).count() == 0


def test_fragments_never_exceed(spark):
    hits = spark.createDataFrame([("q", 1, "D", "c1", "palabra " * 248), ("q", 2, "D", "c2", "  "), ("q", 3, "E", "c3", "corto")], "query_id string, rank int, doc_id string, chunk_id string, texto string")
    ev = spark.createDataFrame([("D", "uno dos tres cuatro"), ("E", "cinco " * 300)], "doc_id string, evidencia string")
    f = retrieval.fragments(hits, ev).orderBy("rank").collect()
    assert [x.chunk_id for x in f] == ["c1", "c3"] and all(len(x.text.split()) <= 250 for x in f)
    assert "Evidencia del grafo" in f[1].text


# --- quality


def test_sample_and_fingerprint(spark):
    d = spark.createDataFrame([(i, 1 if i < 100 else 2 if i < 150 else 3) for i in range(160)], "k int, s int")
    a, b = rows(quality.stratified_sample(d, "k", "s", 32)), rows(quality.stratified_sample(d.orderBy("k", ascending=False), "k", "s", 32))
    assert a == b and {s for _, s in a} == {"1", "2", "3"} and 30 <= len(a) <= 34
    assert quality.fingerprint(d, "k", "s").first() == quality.fingerprint(d.repartition(5), "k", "s").first()
    assert quality.fingerprint(d, "k", "s").first() != quality.fingerprint(d.where("k > 0"), "k", "s").first()


def test_order_statistics(spark):
    rng = random.Random(6)
    v = [rng.randrange(40) for _ in range(333)]
    d = spark.createDataFrame([(x,) for x in v] + [(None,)], "x int")
    s = sorted(v)
    r = quality.order_statistics(d, "x").first()
    assert (r.n, r.minimo, r.mediana, r.p95, r.maximo) == (333, s[0], s[166], s[int(0.95 * 333)], s[-1])


def test_votes_and_integrity(spark):
    d = spark.createDataFrame([("a", 0, "es", 10), ("a", 1, "en", 10), ("a", 2, "en", 5), ("b", 0, "pt", 3), ("b", 1, "es", 3)], "doc_id string, bloque int, lang string, peso int")
    assert [(x.doc_id, x.lang) for x in quality.vote(d).orderBy("doc_id").collect()] == [("a", "en"), ("b", "pt")]
    lines = spark.createDataFrame([('{"a": 1}',), ("",), ("{no",), ('{"b": "x\u2028y"}',)], "value string")
    assert rows(quality.integrity(lines, ["a"])) == [(4, 1, 1, 1, 1, 0, 0)]


def test_label_rules():
    es = "La oficina revisó los datos del plan según el acta, pero no hubo más casos entre los vecinos. "
    en = "The office reviewed the data of the plan, and according to the minutes there were no more cases for them. "
    assert labels.label(es * 3, "pdf")[0] == "es" and labels.label(es * 3, "csv")[0] == "und"
    assert labels.label("corto", "pdf")[0] == "und" and labels.label(None, None)[0] == "und" and labels.label("1 2 3 4 5 6 7 8 9 10 11 12 13", "txt")[0] == "und"
    lang, share, mixed = labels.label("\n\n".join([es * 12, en * 9]), "pdf")
    assert lang == "es" and mixed and 0.5 < share < 0.85
    assert labels.label("委员会公布了年度报告，办公室审查了各站的数据，没有人知道为什么。", "pdf")[0] == "zh"


def test_page_joins_and_isolated_lines(spark):
    d = spark.createDataFrame([(1, "Una frase que\n\nsigue aquí.\n\nOtra página."), (2, "Texto cerrado.\n1. Alcance\nOtra frase larga que sigue."), (3, None)], "doc_id int, text string")
    lines = boilerplate.pages(d)
    assert [(r.doc_id, r.grupo) for r in boilerplate.joined_pages(lines).orderBy("doc_id", "page_no").collect()] == [(1, 1), (1, 1), (1, 2), (2, 1)]
    assert [r.line for r in boilerplate.isolated_lines(lines).where("doc_id = 2").collect()] == ["1. Alcance"]


def test_encoder_plugin(spark):
    d = spark.createDataFrame([(1, "ab"), (2, None)], "id int, t string")
    got = {r.id: r.embedding for r in retrieval.encode(d, "id", "t", lambda: lambda ts: [[float(len(t)), 1.0] for t in ts]).collect()}
    assert got == {1: [2.0, 1.0], 2: [0.0, 1.0]}


# --- checks and reports


def test_inventory_errors_and_coverage(spark):
    i = spark.createDataFrame([("a", "x.pdf", "1", None, None), ("a\\", "x.pdf", "1", None, None), ("a", "y.pdf", "1", None, None), ("a", "z.pdf", " ", None, None), ("a", "w.pdf", "2", None, None), ("a", "w.pdf", "3", None, None)], "carpeta string, nombre_estandarizado string, doc_id_oficial string, fenomeno string, codigo_observatorio string")
    assert rows(ingest.inventory_errors(i)) == [("id_repetido", "1", 2), ("ruta_repetida", "a/w.pdf", 2), ("sin_id", "a/z.pdf", 1)]
    d = spark.createDataFrame([("a/x.pdf",), ("a/y.pdf",), ("a/w.pdf",)], "fuente string")
    with pytest.raises(ValueError):
        ingest.require_coverage(d, i)
    ingest.require_coverage(d, i, only="csv")
    ingest.require_coverage(d, i.where("nombre_estandarizado <> 'z.pdf'"))


def test_index_checks(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.6, 0.8])], "vec_id long, embedding array<float>")
    m = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "vec_id long, texto string")
    assert rows(retrieval.index_check(v, m, 2)) == [(3, 3, 0, 0, 0, True)]
    bad = v.where("vec_id < 3").unionByName(spark.createDataFrame([(2, [2.0]), (9, None)], "vec_id long, embedding array<float>"))
    assert rows(retrieval.index_check(bad, m, 2)) == [(4, 3, 3, 2, 2, False)]

    def model():
        known = {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": [0.6, 0.8]}
        return lambda texts: [known[t] for t in texts]

    assert all(r.ok for r in retrieval.reencode_check(v, m, "vec_id", "texto", model).collect())
    slipped = v.selectExpr("vec_id % 3 + 1 AS vec_id", "embedding")
    assert not any(r.ok for r in retrieval.reencode_check(slipped, m, "vec_id", "texto", model).collect())


def test_reports(spark):
    d = spark.createDataFrame([(1, "x", "1_a/i/p", "pdf"), (2, " x", "1_a/j/q", "csv"), (3, "x", "2_a/i/p", "pdf"), (4, "", "s", "pdf"), (5, None, "t", "pdf")], "doc_id int, text string, fuente string, formato string")
    assert rows(reports.copies(d)) == [("formato", "pdf", 1, 2), ("institucion", "1_a/i", 1, 2), ("todos", "", 1, 2)]
    assert rows(reports.top(spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", None)], "k string, n int"), 2, "n", "k")) == [("b", 3), ("c", 3)]
    l = spark.createDataFrame([(1, "es", False), (2, "und", False), (3, None, True), (4, "en", True)], "doc_id int, lang string, mix boolean")
    assert rows(reports.unlabelled(l, mixed="mix")) == [(2, "und"), (3, "und"), (4, "mixto")]
    f = spark.createDataFrame([("t1", "a"), ("t2", "a"), ("t2", "a"), ("t2", "b"), ("t3", None)], "fuente string, fid string")
    assert rows(reports.redundancy(f)) == [(3, 5, 2, 50.0, 1, 2.0, 3)]
    c = spark.createDataFrame([("D", "c1", "pdf", 300), ("D", "c1", "pdf", 300), ("D", "c2", "pdf", 9), ("E", "c3", "csv", 250)], "doc_id string, chunk_id string, formato string, num_words int")
    assert rows(reports.long_chunks(c)) == [("D", "pdf", 2, 1, 300)]
    j = spark.createDataFrame([('{"id": "1", "t": "x"}',), ('{"id": "1"}',), ("{",), (" ",), ('{"id": "2", "t": "a\u200b"}',)], "value string")
    assert rows(quality.integrity(j, ["t"], "id")) == [(5, 1, 1, 1, 0, 1, 1)]


def test_stratified_sample_meets_its_quotas(spark):
    d = spark.createDataFrame([(i, 1 if i < 1000 else 2 if i < 1500 else 3) for i in range(1600)], "k int, s int")
    got = quality.stratified_sample(d, "k", "s", 32)
    assert rows(got.groupBy("s").count()) == [("1", 20), ("2", 10), ("3", 2)] and rows(got) == rows(quality.stratified_sample(d.repartition(7), "k", "s", 32))


def test_trained_labels(spark):
    words = {"es": "la oficina revisó los datos del plan anual cerca del río según el acta de la mesa técnica", "en": "the office reviewed data of the annual plan near the river according to minutes of the board", "pt": "a secretaria revisou os dados do plano anual perto do rio segundo a ata da mesa técnica não"}
    rng = random.Random(6)
    text = lambda k, n=60: " ".join(rng.choice(words[k].split()) for _ in range(n)) + "."
    d = [(i, text(k), lang, "pdf") for i, (k, lang) in enumerate([(k, [k, k.upper(), k + "-XX", "en"][j % 4] if j % 8 else k) for k in words for j in range(60)])]
    d += [(900, None, "es", "pdf"), (901, text("es") * 5 + "\n\n" + text("en") * 3, "es", "pdf"), (902, text("es"), "es", "csv"), (903, "corto", "es", "pdf")]
    df = spark.createDataFrame(d, "doc_id long, text string, lang string, formato string")
    p = labels.trained(df)
    assert {"en", "es", "pt"} == set(p.names)
    assert all(p(text(k))[0] == k and p(text(k))[1] > 0.9 for k in words for _ in range(5)) and p("12 34") == ("und", 0.0)
    got = {r.doc_id: r for r in labels.labelled(df, p).collect()}
    assert got[901].mixto and got[901].lang == "es" and got[900].lang == got[902].lang == got[903].lang == "und"
    report = {r.lang: r for r in labels.mixed_report(labels.labelled(df, p)).collect()}
    assert report["und"].indeterminados == 3 and report["es"].mixtos == 1
    assert labels.trained(df.limit(0)).names == []
