"""Each operator against nulls, empty and very long texts, repeats, empty tables and clashing columns, and against a plain version of itself."""

import random
import sys
import unicodedata

import numpy as np
import pytest

from telar.llm import chars, encoding, filters, language, leakage, lookalike, mixture, mojibake, quality, repetition, scans, sentences, trees

DOC = "doc_id long, text string, lang string, formato string, k string, n int, form string, word string"
ES = "El comité publicó el informe anual y la oficina revisó los datos de las estaciones. "
EN = "The committee published the annual report and the office reviewed the data of the stations. "


def docs(spark, rows):
    return spark.createDataFrame([(r[0], r[1], *(r[2:] or ("es", "pdf")), "clash", 1, "clash", "clash") for r in rows], DOC)


def prose(seed, sentences_=12):
    rng = random.Random(seed)
    w = "la oficina revisó los datos del plan anual cerca río mesa técnica puerto norte archivo nacional cable radar nube informe acta zona costa".split()
    return ". ".join(" ".join(rng.choice(w) for _ in range(rng.randrange(8, 18))).capitalize() for _ in range(sentences_)) + "."


ODD = [(None, "sin id"), (1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "palabra " * 60_000), (6, ES), (6, ES)]


# --- trees and mixture


def test_trees_are_monotone_and_flat_scores_agree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=600) > 0).astype(float)
    f = trees.fit(x, y, [1, -1, 0])
    assert ((f.score(x) > 0.5) == (y > 0)).mean() > 0.9

    def walk(row):
        total = f.base
        for r in f.roots:
            while f.feature[r] >= 0:
                r = f.left[r] + (row[f.feature[r]] > f.cut[r])
            total += f.value[r]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(f.score(x[:50]), [walk(r) for r in x[:50]])
    grid = np.tile(x[:40], (9, 1, 1))
    for j, sign in ((0, 1), (1, -1)):
        g = grid.copy()
        g[:, :, j] = np.linspace(-3, 3, 9)[:, None]
        s = np.array([f.score(r) for r in g])
        assert (np.diff(s, axis=0) * sign >= -1e-12).all()
    assert trees.fit(np.zeros((5, 2)), np.ones(5), [0, 0]).score(np.zeros((1, 2)))[0] > 0.9
    assert len(f.score(np.zeros((0, 3)))) == 0


def test_mixture_finds_its_components():
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 0.3, (200, 2)) for c in ((0, 0), (4, 4), (0, 5))])
    m = mixture.fit(x, 3, 50)
    k = m.posterior(x).argmax(1)
    assert all(len(set(k[i : i + 200])) == 1 for i in (0, 200, 400)) and len(set(k)) == 3
    assert np.allclose(m.posterior(x).sum(1), 1)


def test_sums_of_a_mixture_are_those_of_its_posterior():
    x = np.random.default_rng(3).normal(0, 30, (300, 4))
    m = mixture.fit(x, 12, 5)
    p, z = m.posterior(x), m.standard(x)
    got = m.sums(x)
    assert np.allclose(got[:-1], np.hstack([p.sum(0)[:, None], p.T @ z**2, p.T @ z]))
    assert got[-1, 0] == pytest.approx(np.logaddexp.reduce(m.log_parts(x), axis=1).sum())


# --- 1 repetition


def plain_share(text):
    words = repetition.words_of(text)
    n = 20 if sum(repetition.is_wide(w) for w in words) > len(words) / 2 else 8
    seen, hit = set(), [False] * len(words)
    for i in range(len(words) - n + 1):
        k = tuple(words[i : i + n])
        if k in seen:
            hit[i : i + n] = [True] * n
        seen.add(k)
    return sum(hit) / len(words) if words else 0.0


@pytest.mark.parametrize("text", [prose(1), ES * 5, prose(2) + " " + prose(2), "Línea 12 de 30\n" * 20, "委员会公布了年度报告，办公室审查了各站的数据。" * 3, "समिति ने सूची प्रकाशित की। " * 4, "a b c", ""])
def test_repeated_share_equals_brute_force(text):
    assert repetition._measured([text])[1][0] == pytest.approx(plain_share(text))


def test_repetition(spark):
    rows = ODD + [(10, prose(3) + (" " + prose(4, 2)) * 8), (11, prose(5)), (12, "a,b\n" * 200, "es", "csv"), (13, "Número 1 de la serie que sigue igual siempre aquí >>> 5\n" * 30)]
    d = docs(spark, rows)
    assert {r.doc_id for r in repetition.found(d).collect()} == {5, 10, 13}
    r = {x.doc_id: x for x in repetition.repetition(d).collect()}
    assert r[1].palabras == 0 and r[2].repetido == 0 and r[3].repetido == 0 and r[5].palabras == 60_000
    assert repetition.found(docs(spark, [])).count() == 0


# --- 2 language


def test_language(spark):
    rows = ODD[:5] + [(20, ES * 4, "es"), (21, ES * 4, "Español"), (22, ES * 4, "es-CO"), (23, ES * 4, "en"), (24, ES * 4, None), (25, ES * 4 + "\n" + EN * 3, "es"), (26, ES * 4 + "«data first, always»", "es"), (27, EN * 4, "und"), (28, ES * 4, "en", "csv"), (29, "2f4a 99 b1 " * 40, None)]
    rows = [r if len(r) in (2, 4) else (*r, "pdf") for r in rows]
    got = {(r.doc_id, r.lang) for r in language.found(docs(spark, rows)).collect()}
    assert got == {(23, "es"), (24, "es"), (25, "es"), (25, "en"), (27, "en")}
    p = language.languages(docs(spark, rows)).where("doc_id = 25").orderBy("inicio").collect()
    assert [x.idioma for x in p] == ["es", "en"] and p[0].fin == p[1].inicio and all(x.confianza > 0.5 for x in p)
    assert language.found(docs(spark, [])).count() == 0


def test_labels(spark):
    codes = language.label_codes(spark)
    want = {"es": "es", "ES": "es", "es_MX": "es", "Español": "es", "spanish": "es", "spa": "es", "zh-Hans": "zh", "Português": "pt", "deu": "de", "ger": "de", "it": "it", "und": None, "xx": None, "N/A": None, "-": None, "": None, None: None, "unknown": None}
    assert {k: language.normal_label(k, codes) for k in want} == want


def test_language_held_out():
    m = language.fit([])
    for k, t in {"es": "Los vecinos pidieron a la autoridad que revise el mapa", "en": "They asked the office to review the map of the coast", "pt": "Os moradores não sabem por que o escritório pediu ajuda", "fr": "Les habitants ont demandé de l’aide au bureau", "de": "Niemand weiß warum das Amt um Hilfe gebeten hat", "ru": "Жители попросили бюро о помощи", "th": "สำนักงานทบทวนข้อมูล"}.items():
        assert language._best(m, t) == k


def strewn(words, seed, n=40):
    rng = random.Random(seed)
    return " ".join(rng.choice(words.split()) for _ in range(n)).capitalize() + "."


RU = "комитет опубликовал годовой отчёт бюро проверило данные станций никто не знает почему протоколу случаев было больше раньше жители попросили помощи центр план список"
NL = "de gemeente heeft het jaarverslag van de dienst gepubliceerd en het bureau controleerde de gegevens niemand weet waarom maar volgens de notulen waren er meer gevallen dan voorheen bewoners vroegen om hulp"


def test_wrong_labels_make_no_language_and_new_ones_do():
    texts = [("ru", strewn(RU, i)) for i in range(60)] + [("uk", strewn(RU, 100 + i)) for i in range(12)] + [("nl", strewn(NL, i)) for i in range(12)] + [("de", strewn(RU, 200 + i)) for i in range(3)]
    m = language.fit(texts)
    assert "uk" not in m.names and "nl" in m.names
    assert language._best(m, strewn(RU, 999)) == "ru" and language._best(m, strewn(NL, 999)) == "nl"
    assert 0 < m.heat <= 1


def test_texts_scored_together_equal_texts_scored_alone():
    m = language.fit([])
    texts = [ES * 3 + EN * 3, "", "x", EN, " \n", "zona\t1\t2\nzona\t3\t4", ES * 2000]
    together = language.passages_all(m, texts)
    assert together == [language.passages(m, t) for t in texts]
    assert together[0][0].lang == "es" and together[0][1].lang == "en" and together[5][0].lang is None and together[1] == []
    assert sum(p.words for p in together[6]) == len(ES.split()) * 2000


# --- 3 quality


def test_quality(spark):
    rng = random.Random(8)
    junk = "".join(rng.choice("□◇■▯?.a1e ") for _ in range(300))
    chunk = [(f"p{i}", prose(i)) for i in range(20)] + [("w", prose(50, 3).replace(" de ", "\n"))]
    chunk += [(f"l{i}", "\n".join(f"- cosa {j} de la lista de la oficina" for j in range(8 + i))) for i in range(6)]
    chunk += [(f"t{i}", "\n".join(f"zona: Norte | cupo: {rng.randrange(9999)} | lote: {j}" for j in range(8 + i))) for i in range(6)]
    chunk += [("b1", junk), ("b2", "/g12 /g99 /g104 /g7 " * 20), ("mix", prose(70, 9) + "\n- cosa\n- otra cosa"), ("mix2", "Una frase. \n" + "\n".join(f"a=1, b={j}, c=3" for j in range(20)))]
    chunk += [("n", None), ("e", ""), (None, "x"), ("l0", chunk[21][1]), ("long", prose(9) * 400)]
    d = spark.createDataFrame([(a, b, 1.0) for a, b in chunk], "chunk_id string, texto string, clase double")
    got = {r.chunk_id: r.clase for r in quality.found(d).collect()}
    assert got == {**{f"l{i}": "lista" for i in range(6)}, **{f"t{i}": "tabla" for i in range(6)}, "b1": "basura", "b2": "basura", "mix2": "tabla"}
    assert quality.chunk_quality(d).count() == len({a for a, _ in chunk if a})
    assert quality.found(d.limit(0)).count() == 0


def test_common_words_are_those_of_all_chunks(spark):
    texts = [prose(i) for i in range(40)] + [f"uno{i // 2} solo{i}" for i in range(40)]
    rows = [(f"c{i}", t) for i, t in enumerate(texts)] + [("c0", texts[0]), ("vacío", None)]
    d = spark.createDataFrame(rows, "chunk_id string, texto string")
    seen = {}
    for t in texts:
        for w in set(quality.TOKEN.findall(t.lower())):
            seen[w] = seen.get(w, 0) + 1
    want = frozenset(w for w, k in seen.items() if k > 1)
    got = {r.chunk_id: r.comunes for r in quality.chunk_quality(d, sample=5).collect()}
    at = quality.STATS.index("comunes")
    assert got == {f"c{i}": pytest.approx(quality.statistics(t, want)[at]) for i, t in enumerate(texts)} | {"vacío": 0.0}
    assert quality.common_words(d) == want


def test_mixture_and_its_words_are_of_all_chunks(spark):
    texts = [prose(i, 3) for i in range(60)] + [f"- uno{i % 7}\n- dos\n- tres solo{i} de la lista de la oficina" for i in range(40)]
    rows = [(f"c{i}", t) for i, t in enumerate(texts)] + [("otra", texts[0]), ("c1", texts[1]), ("vacío", " "), ("nulo", None)]
    d = spark.createDataFrame(rows, "chunk_id string, texto string")
    seen = {}
    for t in texts:
        for w in set(quality.TOKEN.findall(t.lower())):
            seen[w] = seen.get(w, 0) + 1
    # Two in 20 of 101 distinct texts are 10.1.
    common = quality._common(d, 20)[1]
    assert common == frozenset(w for w, k in seen.items() if k > 10) and "uno1" not in common
    assert quality._common(d, 1000)[1] == quality.common_words(d) == frozenset(w for w, k in seen.items() if k > 1)
    m, classes = quality.fit(quality._measured(d, common, None), common)
    own = {c: common | {w for t in ts for w in quality.TOKEN.findall(t.lower())} if c != "basura" else common for c, ts in quality.EXAMPLES.items()}
    x = np.array([quality.statistics(p, common) for t in texts for p in quality.parts(t)] + [quality.statistics(t, own[c]) for c, ts in quality.EXAMPLES.items() for t in ts])
    assert np.allclose(m.mean, x.mean(0), atol=1e-5) and np.allclose(m.weights @ m.centres, 0, atol=1e-3)
    again, same = quality.fit(quality._measured(d.repartition(7), common, None), common)
    assert (again.centres == m.centres).all() and (again.variances == m.variances).all() and (same == classes).all()


@pytest.mark.parametrize("size", [5, 500])
def test_classes_are_the_same_in_a_larger_table(spark, size):
    thai = ["สำนักงานท่าเรือทดสอบโครงการวิจัยต่อหน้ากรรมการ ", "มหาวิทยาลัยทบทวนรายงานประจำปีก่อนฤดูแล้ง ", "หอจดหมายเหตุแก้ไขสายเคเบิลใต้น้ำจากภาพกลางคืน "]
    rng = random.Random(4)
    chunk = [(f"p{i}", prose(i)) for i in range(size)] + [(f"t{i}", "".join(rng.choice(thai) for _ in range(6))) for i in range(size // 5)]
    chunk += [(f"l{i}", "\n".join(f"- cosa {j} de la lista" for j in range(9 + i))) for i in range(5)] + [("b", "/g12 /g99 /g104 /g7 " * 20)]
    d = spark.createDataFrame(chunk, "chunk_id string, texto string")
    assert {r.chunk_id: r.clase for r in quality.found(d).collect()} == {**{f"l{i}": "lista" for i in range(5)}, "b": "basura"}


def test_codes_and_pairs_by_their_plain_patterns():
    rng = random.Random(9)
    signs = "aeix019f/g(cid:)=;| \n.□ｶ中é\u0301_:"
    at = quality.STATS.index("codigos"), quality.STATS.index("pares")
    for _ in range(500):
        t = "".join(rng.choice(signs) for _ in range(90)) + rng.choice(["", " 0a1b2c3d4e5f6a", " 0a1b2c3d4e5f6a\u0301", "_0a1b2c3d4e5f"])
        got = quality.statistics(t, frozenset())
        lines = [x for x in map(str.strip, t.split("\n")) if x]
        assert got[at[0]] == sum(map(len, quality._CODES.findall(t.lower()))) / len("".join(t.split()))
        assert got[at[1]] == sum(len(x) for x in lines if len(quality._PAIR.findall(x)) > 1) / sum(map(len, lines))


@pytest.mark.parametrize("times", [10, 200])
def test_repeated_junk_counts_at_every_size(times):
    at = quality.STATS.index("sin_vocal")
    assert quality.statistics("xkcdq palabra brtzn " * times, frozenset())[at] == pytest.approx(10 / 17)


def test_no_step_for_each_word():
    t = "El plan 2024 de la ñandú brtzn 文字 ок. "
    calls = []
    for times in (50, 5000):
        n = 0

        def count(frame, event, arg):
            nonlocal n
            n += event in ("call", "c_call")

        sys.setprofile(count)
        try:
            quality.statistics(t * times, frozenset({"plan"}))
        finally:
            sys.setprofile(None)
        calls.append(n)
    assert calls[0] == calls[1] < 500


def test_words_by_their_plain_definitions(monkeypatch):
    monkeypatch.setattr(quality, "KEPT", 20)
    rng = random.Random(4)
    signs = "aeiobcdxñµ²½éйŒ19٣๑中ー \t\xa0\x85’._|\n"
    common, other = frozenset({"a", "ab", "й", "中"}), frozenset({"a", "e"})
    known = quality._Words(common, other)
    for _ in range(500):
        t = "".join(rng.choice(signs) * rng.choice([1, 1, 1, 1, 80]) for _ in range(60))
        words = quality.TOKEN.findall(t)
        assert chars.tokens(t) == words and chars.solid(t) == len("".join(t.split()))
        digits = sum(len(w) for w in words if w[0].isdigit())
        mute = sum(quality._mute(w) for w in words if len(w) > 3 and "a" <= w[0] <= "ÿ")
        assert known.sums(words) == [sum(map(len, words)), sum(w in common for w in words), sum(w in other for w in words), digits, mute, sum(map(chars.is_wide, words)), sum(len(w) > 11 and not w.isalpha() for w in words)]
        assert len(known) <= 20 and all(len(w) <= quality.LONGEST for w in known)


# --- 4 sentences

LEX = sentences.Lexicon(frozenset("el la los de en y que nada según the no a an of".split()), frozenset({"Dr", "Sra", "pág", "núm", "art"}))


@pytest.mark.parametrize(
    "text, want",
    [
        ("Uno va. Dos va! ¿Tres? Fin", ["Uno va.", "Dos va!", "¿Tres?", "Fin"]),
        ("El Dr. Olmo vino. La Sra. Rey no.", ["El Dr. Olmo vino.", "La Sra. Rey no."]),
        ("Dijo J. R. Olmo en la pág. 21. El resto sigue.", ["Dijo J. R. Olmo en la pág. 21.", "El resto sigue."]),
        ("Vale 2.5 y 3,4. La versión v3.2 está en https://a.b.example/c.html y sigue.", ["Vale 2.5 y 3,4.", "La versión v3.2 está en https://a.b.example/c.html y sigue."]),
        ("Preguntó: «¿Quién va? Nadie lo sabe.» El resto sigue.", ["Preguntó: «¿Quién va? Nadie lo sabe.»", "El resto sigue."]),
        ("Va (véase el anexo. Nada cambia) y sigue. Fin.", ["Va (véase el anexo. Nada cambia) y sigue.", "Fin."]),
        ("Nadie va… pero sigue. Nadie va… El resto.", ["Nadie va… pero sigue.", "Nadie va…", "El resto."]),
        ("Un punto pegado.El resto sigue.", ["Un punto pegado.", "El resto sigue."]),
        ("„Wer kommt? Niemand.“ Er ging am 9. März heim.", ["„Wer kommt? Niemand.“", "Er ging am 9. März heim."]),
        ("不要碰！他说：“谁来了？没人知道。”然后走了。", ["不要碰！", "他说：“谁来了？没人知道。”", "然后走了。"]),
        ("彼は「誰だ。知らない。」と尋ねた。終わり。", ["彼は「誰だ。知らない。」と尋ねた。", "終わり。"]),
        ("समिति ने कहा। डॉ. राम आए? हाँ।", ["समिति ने कहा।", "डॉ. राम आए?", "हाँ।"]),
        ("قال د. سالم نعم. لماذا؟ انتهى.", ["قال د. سالم نعم.", "لماذا؟", "انتهى."]),
        ("หน่วยงานประกาศแผน62.70 ดร.ซาร์กล่าว", ["หน่วยงานประกาศแผน62.70", "ดร.ซาร์กล่าว"]),
        ("Título del texto\nLa primera frase que es bastante larga sigue aquí hasta el final.", ["Título del texto", "La primera frase que es bastante larga sigue aquí hasta el final."]),
        ("La primera frase que es larga\ny sigue en otra línea más que\nacaba aquí mismo. Otra frase\nmás.", ["La primera frase que es larga\ny sigue en otra línea más que\nacaba aquí mismo.", "Otra frase\nmás."]),
        ("Frase uno que sigue.\n- un cosa\n- otra cosa\n1. más\nFin.", ["Frase uno que sigue.", "- un cosa", "- otra cosa", "1. más", "Fin."]),
        ("", []), (" \n ", []),
    ],
)
def test_boundaries(text, want):
    ends = sentences.boundaries(text, LEX)
    assert [text[a:b].strip() for a, b in zip([0, *ends], ends)] == want


def test_long_texts_take_time_in_proportion():
    import time

    for unit in ("La «frase (larga) dice. ", "a.b.", "uno (dos) \"tres\" y ", "...... x "):
        took = []
        for n in (5_000, 40_000):
            began = time.process_time()
            sentences.boundaries(unit * n, LEX)
            took.append(time.process_time() - began)
        assert took[1] < 40 * took[0] + 1, unit


def test_long_words_are_evidence():
    long = "Verwaltungsgerichtsbarkeitsentsch"
    assert long in sentences.evidence(f"Das {long}. 12 gilt, das {long}. und mehr.").short
    assert sentences._word_before("x " + "y" * 100, 0, 102) == "y" * 100


def test_sentences(spark):
    d = docs(spark, ODD)
    assert sentences.found(d, spark.createDataFrame([(6, 0), (1, 0), (99, 0), (5, 0)], "doc_id long, lote int")).where("doc_id = 6").count() == 1
    assert sentences.found(docs(spark, []), spark.createDataFrame([(6, 0)], "doc_id long, lote int")).count() == 0
    out = sentences.sentences(d, LEX).where("doc_id = 6").collect()
    assert {(r.n, r.fin, r.oracion) for r in out} == {(0, len(ES) - 1, ES.strip())}


# --- 5 scans


def test_scans(spark):
    rng = random.Random(3)
    words = sorted({w for i in range(40) for w in prose(i).lower().replace(".", "").split() if len(w) > 3})

    def page(k):
        body = [rng.choice(words) for _ in range(60)]
        for i in range(0, 12, 4):
            body[i] = scans.damaged(body[i], rng, 1)
        lines = [" ".join(body[i : i + 8]) for i in range(0, 60, 8)]
        lines = [x[:-2] + "-\n" + x[-2:] if i % 3 == 1 else x for i, x in enumerate(lines)]
        return "\n".join(["INFORME ANUAL DE PRUEBA", *lines, f"- {k} -"])

    scanned = "\n".join(page(k) for k in range(12, 18))
    rows = [(i, prose(i)) for i in range(100, 160)] + [(1, scanned), (2, prose(7) + "\nbien-\nestar"), (3, None), (4, ""), (5, "12\n\n13\n\n14\n" + prose(1)), (None, scanned)]
    d = docs(spark, rows)
    got = {(r.doc_id, r.ruido) for r in scans.found(d).collect()}
    assert {(1, "guion"), (1, "cabecera"), (1, "pagina")} <= got and {x for x, _ in got} == {1}
    out = {r.doc_id: r.texto for r in scans.repaired(d).collect()}
    assert "INFORME" not in out[1] and "- 12 -" not in out[1] and "-\n" not in out[1]
    assert scans.found(docs(spark, [])).count() == 0


@pytest.mark.parametrize("heads", [("9 Informe modal de cuentas rev", "10 Informe rnodal de cuentas rev", "100 Informe rnoclal de cuentas rev"), ("年度报告",) * 3, ("Informe anual de la oficina de datos " * 4,) * 3])
def test_headers_of_any_length(heads):
    lines = []
    for k, x in enumerate(heads):
        lines += [x, *[f"{w} y además sigue la frase {'muy ' * (7 * k + j)}larga que" for j, w in enumerate(prose(k).split()[:9])]]
    _, got = scans.furniture([x.strip() for x in lines], scans.fit_furniture())
    assert [0, 10, 20] in got.values()


def test_corrections_prefer_confusions():
    assert scans.misreading_cost("c0mité", "comité")[0] < scans.misreading_cost("cxmité", "comité")[0]
    assert scans.misreading_cost("inforrne", "informe") == (0.25, 1)
    counts = {a + b + c: 500 for a in ("inf", "zar", "vel", "tor", "oficin") for b in "aeiou" for c in ("rme", "rma", "lbo", "mond", "gran")} | {"informe": 500, "informa": 400}
    f = scans.fit_ranking(counts)
    rows = np.array([scans._rank_row("1nforme", "informe", 0.6, 1, 500), scans._rank_row("informa", "informe", 0.6, 480, 500)])
    p = f.score(rows)
    assert p[0] > 0.5 > p[1]


# --- 7 look-alikes


def test_lookalike(spark):
    a = "La comisión oficial 12 fin"
    same = [(1, a), (2, a), (3, "La comisión oﬁcial 12 fin"), (4, "Lа comisión oficial 12 fin​"), (5, "Ｌａ comisión oficial １２ fin"), (6, "La Comisión oficial 12 fin"), (7, "​"), (8, ""), (9, None), (None, a), (10, "  "), (4, "Lа comisión oficial 12 fin​"), (11, a + "²"), (12, a + "2")]
    got = {(r.doc_id_a, r.doc_id_b) for r in lookalike.lookalike_pairs(docs(spark, same)).collect()}
    ids = {1: "x", 2: "x", 3: "y", 4: "z", 5: "w"}
    assert got == {(i, j) for i in ids for j in ids if i < j and ids[i] != ids[j]}
    assert lookalike.lookalike_pairs(docs(spark, [])).count() == 0
    n = {r.doc_id: r.texto for r in lookalike.normalised(docs(spark, same)).collect()}
    assert n[9] is None and n[8] == "" and n[10] == "" and n[5] == a


def test_classes_and_hot_forms(spark):
    a = "La comisión oficial 12 fin"
    rows = [(i, a) for i in range(40)] + [(100 + i, "Lа comisión oficial 12 fin") for i in range(30)] + [(500, "otra"), (501, "otra"), (502, None)]
    d = docs(spark, rows)
    want = {(i, 100 + j) for i in range(40) for j in range(30)}
    for hot in (lookalike.HOT, 1):
        assert {tuple(r) for r in lookalike.lookalike_pairs(d, hot=hot).collect()} == want
    c = lookalike.lookalike_classes(d).collect()
    assert len(c) == 70 and {(r.representante, r.n) for r in c} == {(0, 40), (100, 30)} and len({r.forma for r in c}) == 1


def plain_form(text):
    """The form by the Unicode data of Python, character by character."""
    out = ""
    for ch in unicodedata.normalize("NFC", text):
        kind = unicodedata.decomposition(ch).split(" ")[0]
        name = unicodedata.name(ch, "")
        if kind in ("<wide>", "<narrow>", "<isolated>", "<initial>", "<medial>", "<final>") or "LIGATURE F" in name or "LIGATURE LONG S" in name or "LIGATURE ST" in name or "ROMAN NUMERAL" in name and kind == "<compat>":
            ch = unicodedata.normalize("NFKC", ch)
        out += "" if unicodedata.category(ch[:1] or " ") in ("Cf", "Cc") and ch not in "\t\n\r\x0b\x0c\x85" else ch
    return " ".join(unicodedata.normalize("NFC", out.translate(lookalike.LOOKS)).split())


def test_forms_equal_character_by_character(spark):
    texts = ["Ａｎｏ　２０２４", "ano\u0301 e\u0301l", "ﬁn ﬂor ﬃ ﬅ", "Ⅷ siglo ⅻ", "ﾊﾝｶｸ", "ﺍﻟﺳﻼﻡ", "a\u200bb\u00adc\ufeff", "a\u00a0b\u2003c", "Ꭺ օ Ѵ ɡ", "x² ① 𝐀", "Москва ρ", "𝒳", "ＡＢ\u0301"]
    d = docs(spark, list(enumerate(texts)))
    got = {r.doc_id: r.texto for r in lookalike.normalised(d).collect()}
    assert {i: got[i] for i in got if plain_form(texts[i]) != got[i]} == {}


# --- 8 encoding


@pytest.mark.parametrize("text", ["", " ", "a", "it's  \n\n x 12345 <|endoftext|> ñandú", "委员会公布了年度报告。" * 90, "a" * 3000, " " * 2500 + "x", (ES + "\n\n") * 40, "🚀👩‍🚀" * 300, "x1" * 900])
def test_overlapping_chunks_equal_whole_texts(spark, text):
    _, enc = encoding._load(encoding.TOKENIZERS, "byte_bpe_50k")
    got = encoding.encode(docs(spark, [(1, text)]), chunk=400, overlap=60).first().ids
    assert got == enc.encode_ordinary(text)


def test_encode(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{encoding.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    got = encoding.encode(docs(spark, ODD))
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r.ids)
    assert by[1] == [[]] and by[2] == [[]] and len(by[6]) == 2
    assert all(x == t.encode(text or "", add_special_tokens=False).ids for i, text in ODD for x in by[i])
    back = {r.doc_id: r.text for r in encoding.decode(got).collect()}
    assert all(back[i] == (x or "") for i, x in ODD)
    assert encoding.encode(docs(spark, [])).count() == 0


# --- 9 leakage


def test_leakage(spark):
    item = "En Norvik, la empresa amplió con Zarwen el plan de operadores y cita a Kubb sin costo para los usuarios en Phlex. El equipo de mapas defendió el protocolo."
    words = item.split()
    zh = "彧笙邈低轨道研究所修正了霁岚蘅事件清单翀笙鹜在监督小组面前经彧笙邈确认"
    items = spark.createDataFrame([(7, "q", "es", item), (8, "q", "zh", zh), (9, "q", "es", None), (10, "q", "es", "corto")], "item_id long, query_id string, lang string, pasaje string")
    rows = [(1, prose(1) + " " + item), (2, " ".join(words[:12]).upper()), (3, " ".join(words[:11])), (4, " ".join(words[3:16]).replace("operadores", "opera-\ndores").replace("amplió", "amplio")), (5, item.replace("Norvik", "Otrik").replace("Zarwen", "Lumen").replace("Kubb", "Dorr").replace("Phlex", "Ombra")), (6, "前" + zh[5:25] + "后"), (7, zh[5:24]), (8, None), (9, ""), (1, prose(1) + " " + item), (10, "、".join(zh[3:24]))]
    d = docs(spark, rows)
    want = {(1, 7), (2, 7), (4, 7), (6, 8), (10, 8)}
    for sent in (leakage.SENT_BYTES, -1):
        r = leakage.leaks(d, items, sent=sent).collect()
        assert {(x.doc_id, x.item_id) for x in r if x.ventanas} == want
        assert {x.doc_id for x in r if x.reparametrizadas and not x.ventanas} >= {5}
    assert leakage.leaked(docs(spark, []), items).count() == 0 and leakage.leaked(d, items.limit(0)).count() == 0


def test_breaks_are_read_each_on_its_own(spark):
    item = "el observatorio regional amplió con acierto el plan físico-químico de operadores y citó el anexo"
    items = spark.createDataFrame([(7, item)], "item_id long, pasaje string")
    text = item.replace("observatorio", "observa-\ntorio").replace("físico-químico", "físico-\nquímico")
    assert [(r.doc_id, r.item_id) for r in leakage.leaked(docs(spark, [(1, text), (2, "nada")]), items).collect()] == [(1, 7)]


def test_filter_lets_all_through_that_is_in_it(spark):
    words = [f"señal{i}" for i in range(500)]
    bits = filters.bit_filter(spark.createDataFrame([(w,) for w in words], "w string"), "w")
    hit = lambda b: bits[b >> 3] >> (b & 7) & 1
    assert all(hit(filters.bit_of_word(w)) for w in words) and sum(hit(filters.bit_of_word(f"otra{i}")) for i in range(500)) < 5
    n = np.array([-(1 << 63), -1, 0, 5, (1 << 63) - 1, 123456789012345], np.int64)
    bits = filters.bit_filter(spark.createDataFrame([(int(x),) for x in n], "n bigint"), "n")
    assert all(hit(int(b)) for b in filters.bit_of(n))


# --- 10 mojibake


def test_mojibake(spark):
    clean = "La comisión revisó la región según el acta y amplió la capacitación técnica del año según la dirección, así como la misión y la auditoría. "
    ru = "Комитет обновляет список происшествий по данным бюро. "
    wrong = lambda t, a, b: t.encode(a).decode(b)
    rows = [(i, clean) for i in range(100, 140)] + [(i, ru * 2) for i in range(140, 160)]
    bad = {1: wrong(clean, "utf-8", "latin-1"), 2: wrong(clean, "cp1252", "cp437"), 3: wrong(clean, "utf-8", "mac_roman"), 4: wrong(wrong(clean, "utf-8", "latin-1"), "utf-8", "latin-1"), 5: wrong(ru, "cp1251", "latin-1"), 6: clean.replace("ó", "�")}
    fine = [(50, "A REGIÃO DE ÂNGULO NÃO TERÁ INSTALAÇÃO; A IRMÃ “ÃNDEL” VIRÁ"), (51, "x²+y²≤4·π"), (52, "$¬°{}~·" * 9), (53, None), (54, ""), (None, bad[1])]
    d = docs(spark, rows + list(bad.items()) + fine)
    assert {r.doc_id for r in mojibake.found(d).collect()} == set(bad)
    back = {r.doc_id: r.texto for r in mojibake.restored(d).collect()}
    assert back[1] == back[2] == back[3] == back[4] == clean and back[5].lower() == ru.lower()
    assert mojibake.found(docs(spark, [])).count() == 0


def test_mojibake_of_any_length(spark):
    zh = "低成本技术圆桌会依靠自有资金否决了轨道交通模拟器，而高原大学协调了供应商v2.1审计报告。" * 6
    ja = "うち、信号研究室は公表した。また、監視委員会は当面のあいだ予備の事故を延期した。" * 6
    wrong = lambda t, a, b: t.encode(a).decode(b)
    one = wrong(zh, "utf-8", "latin-1")
    assert len(one) > 400 and len(mojibake.words_of(one)) == 1
    bad = {1: one, 2: wrong(ja, "utf-8", "latin-1"), 3: "报告" + wrong(zh[:9], "utf-8", "latin-1") + "报告"}
    clean = "La comisión revisó la región según el acta y amplió la capacitación técnica del año según la dirección. "
    rows = [(i, zh) for i in range(100, 120)] + [(i, ja) for i in range(120, 140)] + [(i, clean) for i in range(140, 160)] + [(4, wrong(clean, "utf-8", "latin-1"))]
    d = docs(spark, rows + list(bad.items()))
    assert {r.doc_id for r in mojibake.found(d).collect()} == {1, 2, 3, 4}
    back = {r.doc_id: r.texto for r in mojibake.restored(d).collect()}
    assert back[1] == zh and back[2] == ja and back[3] == "报告" + zh[:9] + "报告" and back[4] == clean


def test_chance_decodings_are_no_cases(spark):
    # Words of one alphabet decode to known Chinese characters by chance; letters that look alike to a known word; small letters to capitals.
    zh = "布平。低成本技术圆桌会否决了布料，平台协调了。Ｒ布平布"
    ru = "Со временем комитет обновляет список по данным временем. "
    wrong = lambda t, a, b: t.encode(a).decode(b)
    es = "Las varias comités y várias áreas del comité según la región técnica así, más allá del número y la razón última. "
    pt = "O comitê das várias áreas ampliou a técnica e a região conforme o número da razão. "
    rows = [(i, zh) for i in range(100, 130)] + [(i, ru) for i in range(130, 170)] + [(i, es) for i in range(170, 200)] + [(i, pt) for i in range(200, 210)]
    rows += [(1, wrong(es, "cp1252", "cp437")), (2, wrong(es, "cp1252", "mac_roman")), (3, es.replace("várias", "v\u0430rias")), (4, es.replace("más", "m\u0430s"))]
    assert {r.doc_id for r in mojibake.found(docs(spark, rows)).collect()} == {1, 2}


def test_long_words_teach_and_layers_have_no_limit(spark):
    long = "ó".join("interdepartamentalizadas") + "ción" * 3
    clean = [f"{long}{x} y región{x} según{x} acción{x}" for x in ("a", "e", "u", "i")]
    wrong = lambda t, a, b: t.encode(a).decode(b)
    assert len(long) > 40
    rows = [(i, " ".join(clean)) for i in range(100, 140)] + [(i, wrong(" ".join(clean), "cp1252", "mac_roman")) for i in (1, 2)]
    deep = "región según acción"
    for _ in range(6):
        deep = wrong(deep, "utf-8", "latin-1")
    assert [mojibake.undo_utf8(w) for w in deep.split(" ")] == ["región", "según", "acción"]
    assert {r.doc_id for r in mojibake.found(docs(spark, rows + [(3, deep)])).collect()} == {1, 2, 3}


def test_undo_is_exact():
    for a in ("utf-8", "cp1251", "koi8-r"):
        for b in ("latin-1", "mac_roman", "cp437"):
            t = "мост" if a != "utf-8" else "ñandú"
            assert mojibake.undo(t.encode(a).decode(b), a, b) == t
