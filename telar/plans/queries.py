"""Queries over the driver's tables, one per operator, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telar import config as C
from telar.functions import paths, text
from telar.operators import boilerplate, chunking, graph, ingest, keys, labels, quality, reports, retrieval, tiles
from telar.session import store
from telar.session import table as _t
from telar.sources import files

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under the name of its function."""

    def put(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


_DISTINCT_CHUNKS = "SELECT doc_id, chunk_id, max(num_words) AS v FROM chunks WHERE doc_id IS NOT NULL AND chunk_id IS NOT NULL GROUP BY ALL"


@query(f"""SELECT doc_id FROM ({_DISTINCT_CHUNKS}) GROUP BY doc_id HAVING count(*) >= 0.02 * (SELECT count(DISTINCT chunk_id) FROM chunks)""")
def p6_found(spark, sf):
    return keys.hot_keys(_t(spark, sf, "chunks"), "doc_id", "chunk_id", "num_words").select("doc_id")


@query(
    f"""SELECT doc_id, count(v) AS n, count(*) - count(v) AS n_null, min(v)::BIGINT AS v_min, max(v)::BIGINT AS v_max, quantile_disc(v, 0.5)::BIGINT AS q_00,
    quantile_disc(v, 0.9)::BIGINT AS q_01, quantile_disc(v, 0.99)::BIGINT AS q_02 FROM ({_DISTINCT_CHUNKS}) GROUP BY doc_id"""
)
def p6_quantiles(spark, sf):
    return keys.key_quantiles(_t(spark, sf, "chunks"), "doc_id", "num_words", distinct="chunk_id")


# --- paths, identity, coverage -----------------------------------------------------------------------------------

_POSIX = r"regexp_replace(fuente, '\\\\', '/', 'g')"
_FORMAT = "CASE lower(regexp_extract({0}, '\\.([^./]+)$', 1)) WHEN 'mvt' THEN 'pbf' WHEN 'jpeg' THEN 'jpg' WHEN 'xls' THEN 'xlsx' ELSE CASE WHEN lower(regexp_extract({0}, '\\.([^./]+)$', 1)) IN ('json','pdf','pbf','csv','jpg','xlsx','avif','txt') THEN lower(regexp_extract({0}, '\\.([^./]+)$', 1)) END END"


@query(
    f"""SELECT doc_id, TRY_CAST(regexp_extract(fuente, '^([1-3])_[^/]+/', 1) AS INT) AS fenomeno, {_FORMAT.format('fuente')} AS formato,
    regexp_matches(fuente, '(^|/)(?i:page|pagina)_[0-9]+(/|$)') AS pagina, regexp_matches(fuente, '(^|/)tiles/(.*/)?[0-9]+(/|$)') AS tesela,
    array_to_string(list_slice(string_split(fuente, '/'), 1, 2), '/') AS institucion FROM documents"""
)
def path_fields(spark, sf):
    f = F.col("fuente")
    return _t(spark, sf, "documents").select("doc_id", paths.topic(f).alias("fenomeno"), paths.format_of(f).alias("formato"), paths.is_page(f).alias("pagina"), paths.is_tile(f).alias("tesela"), paths.institution(f).alias("institucion"))


@query(
    """SELECT DISTINCT fuente, TRY_CAST(regexp_extract(fuente, '(?:^|/)tiles/([0-9]+)/([0-9]+)/(?:[^/]*_)?([0-9]+)\\.[^./]+$', 1) AS INT) AS zoom,
    TRY_CAST(regexp_extract(fuente, '(?:^|/)tiles/([0-9]+)/([0-9]+)/(?:[^/]*_)?([0-9]+)\\.[^./]+$', 2) AS INT) AS x,
    TRY_CAST(regexp_extract(fuente, '(?:^|/)tiles/([0-9]+)/([0-9]+)/(?:[^/]*_)?([0-9]+)\\.[^./]+$', 3) AS INT) AS y FROM tile_features"""
)
def tile_paths(spark, sf):
    d = _t(spark, sf, "tile_features").select("fuente").distinct()
    return d.select("fuente", paths.tile_place(F.col("fuente")).alias("p")).select("fuente", "p.zoom", "p.x", "p.y")


_INVENTORY = r"""SELECT fuente, min(id) AS doc_id_oficial, min(codigo) AS codigo, min(fen) AS fenomeno FROM (SELECT fuente, id, codigo,
    coalesce(TRY_CAST(regexp_extract(trim(fenomeno), '(?i)^(?:F|fen[oó]meno\s*)?\s*0*([0-9]+)', 1) AS INT), TRY_CAST(regexp_extract(fuente, '^(?:.*[/:])?([1-3])_[^/]+/', 1) AS INT)) AS fen
    FROM (SELECT regexp_replace(replace(carpeta, chr(92), '/'), '/+$', '') || '/' || nombre_estandarizado AS fuente, nullif(trim(doc_id_oficial), '') AS id, codigo_observatorio AS codigo, fenomeno FROM inventory)) GROUP BY fuente"""


@query(_INVENTORY)
def inventory_keys(spark, sf):
    return ingest.inventory_keys(_t(spark, sf, "inventory"))


@query(
    f"""WITH k AS ({_INVENTORY}) SELECT d.fuente, k.doc_id_oficial, CASE WHEN k.fuente IS NULL THEN 'fuera_del_indice' WHEN k.doc_id_oficial IS NULL THEN 'sin_id' ELSE 'ok' END AS estado
    FROM documents d LEFT JOIN k ON d.fuente = k.fuente"""
)
def inventory_join(spark, sf):
    return ingest.identified(_t(spark, sf, "documents"), _t(spark, sf, "inventory"))


@query(
    """WITH l AS (SELECT DISTINCT doc_id_oficial AS k FROM documents WHERE doc_id_oficial IS NOT NULL), r AS (SELECT DISTINCT doc_id AS k FROM chunks WHERE doc_id IS NOT NULL),
    j AS (SELECT l.k AS lk, r.k AS rk FROM l FULL JOIN r ON l.k = r.k) SELECT count(lk) AS n_left, count(rk) AS n_right, count(*) FILTER (WHERE lk IS NOT NULL AND rk IS NOT NULL) AS n_both,
    count(*) FILTER (WHERE rk IS NULL) AS n_left_only, count(*) FILTER (WHERE lk IS NULL) AS n_right_only FROM j"""
)
def coverage_compare(spark, sf):
    return ingest.coverage(_t(spark, sf, "documents").select(F.col("doc_id_oficial").alias("doc_id")), _t(spark, sf, "chunks").select("doc_id"), "doc_id")


@query("SELECT DISTINCT doc_id FROM chunks WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id_oficial FROM documents UNION SELECT doc_id FROM catalogos)")
def orphan_keys(spark, sf):
    known = _t(spark, sf, "documents").select(F.col("doc_id_oficial").alias("doc_id")).unionByName(_t(spark, sf, "catalogos").select("doc_id"))
    return ingest.missing(_t(spark, sf, "chunks"), known, "doc_id")


@query("SELECT DISTINCT doc_id_oficial FROM inventory WHERE doc_id_oficial IS NOT NULL AND doc_id_oficial NOT IN (SELECT doc_id_oficial FROM documents)")
def inventory_not_emitted(spark, sf):
    return ingest.missing(_t(spark, sf, "inventory"), _t(spark, sf, "documents"), "doc_id_oficial")


@query("SELECT chunk_id, count(*) AS n FROM chunks WHERE chunk_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_chunk_ids(spark, sf):
    return ingest.duplicate_keys(_t(spark, sf, "chunks"), "chunk_id")


_NORM = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(coalesce(text, '')), '\r\n|\r|\x{2028}|\x{2029}', chr(10), 'g'), '\p{Cf}', '', 'g'),
    '\p{Zs}', ' ', 'g'), '[\x{00}-\x{08}\x{0B}-\x{1F}\x{7F}-\x{9F}]', '', 'g'), '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')"""


@query(f"SELECT doc_id, sha1({_NORM}) AS h, CASE WHEN {_NORM} <> '' THEN left(sha1({_NORM}), 12) END AS content_sha1, length({_NORM})::INT AS largo FROM documents")
def normalised_text(spark, sf):
    n = text.normalise(F.col("text"))
    return _t(spark, sf, "documents").select("doc_id", n.alias("n")).select("doc_id", F.sha1("n").alias("h"), F.when(F.col("n") != "", F.left(F.sha1("n"), F.lit(12))).alias("content_sha1"), F.length("n").alias("largo"))


@query(f"SELECT content_sha1, count(*) AS n, min(doc_id) AS primero FROM (SELECT doc_id, CASE WHEN {_NORM} <> '' THEN left(sha1({_NORM}), 12) END AS content_sha1 FROM documents) WHERE content_sha1 IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_content(spark, sf):
    return ingest.duplicate_content(_t(spark, sf, "documents"))


@query(
    f"""WITH h AS (SELECT sha1({_NORM}) AS h, fuente, formato, array_to_string(list_slice(string_split(fuente, '/'), 1, 2), '/') AS inst FROM documents WHERE {_NORM} <> ''),
    g AS (SELECT h, count(*) AS n, arg_min(formato, fuente) AS formato, arg_min(inst, fuente) AS inst FROM h GROUP BY 1 HAVING count(*) > 1),
    k AS (SELECT 'todos' AS tipo, '' AS valor, n FROM g UNION ALL SELECT 'formato', formato, n FROM g UNION ALL SELECT 'institucion', inst, n FROM g) SELECT tipo, valor, count(*) AS grupos, sum(n - 1)::BIGINT AS sobrantes FROM k GROUP BY 1, 2"""
)
def duplicate_report(spark, sf):
    return reports.copies(_t(spark, sf, "documents"))


@query(
    r"""WITH r AS (SELECT DISTINCT regexp_replace(replace(carpeta, chr(92), '/'), '/+$', '') || '/' || nombre_estandarizado AS ruta, nullif(trim(doc_id_oficial, ' '), '') AS id FROM inventory)
    SELECT 'sin_id' AS problema, ruta AS clave, 1::BIGINT AS n FROM r WHERE id IS NULL UNION ALL SELECT 'id_repetido', id, count(*) FROM r WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
    UNION ALL SELECT 'ruta_repetida', ruta, count(*) FROM r GROUP BY ruta HAVING count(*) > 1"""
)
def inventory_errors(spark, sf):
    return ingest.inventory_errors(_t(spark, sf, "inventory"))


@query("SELECT doc_id, CASE WHEN lang IS NULL OR lang IN ('', 'und') THEN 'und' END AS motivo FROM documents WHERE lang IS NULL OR lang IN ('', 'und')")
def unlabelled_documents(spark, sf):
    return reports.unlabelled(_t(spark, sf, "documents"))


@query("SELECT doc_id, formato, count(DISTINCT chunk_id) AS n_chunks, count(DISTINCT chunk_id) FILTER (WHERE num_words > 250) AS n_largos, max(num_words)::INT AS mayor FROM chunks GROUP BY 1, 2 HAVING count(DISTINCT chunk_id) FILTER (WHERE num_words > 250) > 0")
def long_chunks(spark, sf):
    return reports.long_chunks(_t(spark, sf, "chunks"))


@query("SELECT doc_id, n_largos FROM (SELECT doc_id, count(DISTINCT chunk_id) FILTER (WHERE num_words > 250) AS n_largos FROM chunks WHERE doc_id IS NOT NULL GROUP BY 1, formato) WHERE n_largos > 0 ORDER BY n_largos DESC, doc_id LIMIT 10")
def worst_documents(spark, sf):
    return reports.top(reports.long_chunks(_t(spark, sf, "chunks").where("doc_id IS NOT NULL")).select("doc_id", "n_largos"), 10, "n_largos", "doc_id")


@query("SELECT (SELECT count(*) FROM embeddings) AS n_vectors, (SELECT count(*) FROM embeddings) AS n_metadata, 0::BIGINT AS n_alone, count(*) FILTER (WHERE len(embedding) <> 64) AS n_size, count(*) FILTER (WHERE abs(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) > 0.001) AS n_norm, count(*) > 0 AND count(*) FILTER (WHERE len(embedding) <> 64 OR abs(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) > 0.001) = 0 AS ok FROM embeddings")
def index_check(spark, sf):
    v = _t(spark, sf, "embeddings")
    return retrieval.index_check(v, v.select("vec_id", "label"), 64)


@query(
    f"""WITH k AS ({_INVENTORY}) SELECT count(*) AS n, count(*) = count(DISTINCT d.doc_id_oficial) AS unique_ids, count(*) = count(DISTINCT d.fuente) AS unique_paths,
    bool_and(coalesce(d.formato IN ('json','pdf','pbf','csv','jpg','xlsx','avif','txt'), false)) AS known_formats, bool_and(coalesce(d.fenomeno BETWEEN 1 AND 3, false)) AS known_topics,
    count(*) FILTER (WHERE k.fuente IS NULL) AS n_unlisted, count(*) FILTER (WHERE coalesce(trim(d.text, ' '), '') = '') AS n_empty FROM documents d LEFT JOIN k ON d.fuente = k.fuente"""
)
def acceptance_checks(spark, sf):
    return ingest.acceptance(_t(spark, sf, "documents"), _t(spark, sf, "inventory"))


@query("SELECT formato, fenomeno, grouping(formato, fenomeno)::INT AS nivel, count(*) AS n FROM documents GROUP BY GROUPING SETS ((formato, fenomeno), (formato), (fenomeno), ())")
def format_topic_counts(spark, sf):
    _t(spark, sf, "documents").select("formato", "fenomeno").createOrReplaceTempView("telar_documents")
    return spark.sql("SELECT formato, fenomeno, CAST(grouping_id(formato, fenomeno) AS INT) AS nivel, count(*) AS n FROM telar_documents GROUP BY GROUPING SETS ((formato, fenomeno), (formato), (fenomeno), ())")


@query("SELECT tipo, motivo, count(*) AS n, count(DISTINCT fuente) AS n_fuentes, max(lote)::INT AS ultimo FROM (SELECT DISTINCT fuente, tipo, coalesce(motivo, '') AS motivo, lote, registrado FROM ingest_log) GROUP BY 1, 2")
def log_summary(spark, sf):
    d = _t(spark, sf, "ingest_log").select("fuente", "tipo", F.coalesce("motivo", F.lit("")).alias("motivo"), "lote", "registrado").distinct()
    return d.groupBy("tipo", "motivo").agg(F.count("*").alias("n"), F.count_distinct("fuente").alias("n_fuentes"), F.max("lote").alias("ultimo"))


# --- text kernels ------------------------------------------------------------------------------------------------


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x{0B}\f\r]+'), lambda x: x <> ''))::INT AS palabras FROM documents")
def word_counts(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.word_count(F.col("text")).alias("palabras"))


@query(
    r"""SELECT forma, count(*) AS n FROM (SELECT regexp_replace(regexp_replace(trim(l, ' '), '[ \t\n\x{0B}\f\r]+', ' ', 'g'), '[0-9]+', '#', 'g') AS forma FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM documents) WHERE trim(l, ' ') <> '') GROUP BY 1 HAVING count(*) > 1"""
)
def canonical_lines(spark, sf):
    l = _t(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("l")).where("trim(l) <> ''")  # noqa: E741
    return l.groupBy(text.canonical_line(F.col("l")).alias("forma")).agg(F.count("*").alias("n")).where("n > 1")


@query(
    r"""SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE regexp_matches(l, '(?i)^[\s\-–—.|\[(]*(?:(?:page|p[aá]gina|p[aá]g\.?|p\.)\s*)?[0-9]{1,4}(?:\s*(?:/|de|of)\s*[0-9]{1,4})?[\s\-–—.|\])]*$') GROUP BY 1"""
)
def page_number_lines(spark, sf):
    l = _t(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("l"))  # noqa: E741
    return l.where(text.is_page_number(F.col("l"))).groupBy("doc_id").agg(F.count("*").alias("n"))


@query(r"SELECT doc_id, round(CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '\P{L}', '', 'g')) / length(text) ELSE 0 END, 6) AS alfa, round(CASE WHEN length(regexp_replace(lower(text), '[^a-záéíóúüñ]', '', 'g')) > 0 THEN length(regexp_replace(lower(text), '[^aeiouáéíóúü]', '', 'g')) / length(regexp_replace(lower(text), '[^a-záéíóúüñ]', '', 'g')) END, 6) AS vocales FROM documents WHERE text IS NOT NULL")
def letter_shares(spark, sf):
    d = _t(spark, sf, "documents").where("text IS NOT NULL")
    return d.select("doc_id", F.round(text.alpha_share(F.col("text")), 6).alias("alfa"), F.round(text.vowel_share(F.col("text")), 6).alias("vocales"))


@query(r"SELECT doc_id, regexp_matches(text, '\p{Latin}\p{Cyrillic}|\p{Cyrillic}\p{Latin}') AS mezcla FROM documents WHERE text IS NOT NULL")
def homoglyph_words(spark, sf):
    return _t(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", text.homoglyph(F.col("text")).alias("mezcla"))


@query(
    r"""SELECT printf('%08X', unicode(c)) AS codigo, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{Cf}\p{Zs}\x{2028}\x{2029}]')) AS c FROM documents) WHERE c <> ' ' GROUP BY 1"""
)
def invisible_characters(spark, sf):
    return quality.characters(_t(spark, sf, "documents"), r"[\p{Cf}[\p{Zs}&&[^ ]]\x{2028}\x{2029}]")


@query(
    r"""WITH a AS (SELECT doc_id, length(coalesce(text, '')) AS largo, length(regexp_replace(coalesce(text, ''), '\P{Latin}', '', 'g'))::INT AS latin, length(regexp_replace(coalesce(text, ''), '\P{Cyrillic}', '', 'g'))::INT AS cirilico,
    length(regexp_replace(coalesce(text, ''), '\P{Arabic}', '', 'g'))::INT AS arabe, length(regexp_replace(coalesce(text, ''), '\P{Han}', '', 'g'))::INT AS han FROM documents)
    SELECT doc_id, latin, cirilico, arabe, han, cirilico > 0 AND cirilico / greatest(latin + cirilico + arabe + han, 1) < 0.02 AND latin / greatest(latin + cirilico + arabe + han, 1) > 0.5 AND largo >= 200 AS portador FROM a"""
)
def alphabet_profile(spark, sf):
    return quality.alphabets(_t(spark, sf, "documents"))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_path(spark, sf):
    v = files.json_values(_t(spark, sf, "events").select("event_id", "props"), "props", "k", "v")
    return v.select("event_id", F.try_element_at("v", F.lit(1)).try_cast("bigint").alias("k"))


@query(
    """SELECT s_suppkey, concat_ws(' | ', 'nombre: ' || s_name, 'nación: ' || s_nationkey::VARCHAR, CASE WHEN s_acctbal IS NOT NULL THEN 'saldo: ' || CASE WHEN s_acctbal = floor(s_acctbal) THEN floor(s_acctbal)::BIGINT::VARCHAR ELSE s_acctbal::VARCHAR END END) AS linea FROM supplier"""
)
def record_lines(spark, sf):
    s = _t(spark, sf, "supplier")
    return s.select("s_suppkey", text.record_line({"nombre": (F.col("s_name"), "string"), "nación": (F.col("s_nationkey"), "int"), "saldo": (F.col("s_acctbal"), "double")}).alias("linea"))


# --- tiles -------------------------------------------------------------------------------------------------------

_RICH = "len(list_filter(map_values(props), lambda v: v IS NOT NULL AND trim(v, ' ') <> ''))"


@query("SELECT fid, fuente, zoom FROM (SELECT DISTINCT fid, fuente, zoom FROM tile_features WHERE fid IS NOT NULL) QUALIFY rank() OVER (PARTITION BY fid ORDER BY zoom DESC) = 1")
def max_zoom_assign(spark, sf):
    return tiles.max_zoom(_t(spark, sf, "tile_features"))


@query(f"SELECT fid, max({_RICH})::INT AS riqueza, arg_min(fuente, (-{_RICH}, fuente)) AS fuente FROM tile_features WHERE fid IS NOT NULL GROUP BY fid")
def richest_version(spark, sf):
    return tiles.richest(_t(spark, sf, "tile_features")).select("fid", "riqueza", "fuente")


@query("SELECT fid, count(DISTINCT v) AS n FROM (SELECT fid, trim(props['name'], ' ') AS v FROM tile_features WHERE fid IS NOT NULL) WHERE v <> '' GROUP BY 1 HAVING count(DISTINCT v) > 1")
def inconsistent_features(spark, sf):
    return tiles.inconsistent(_t(spark, sf, "tile_features"))


@query(
    r"""WITH r AS (SELECT DISTINCT fuente, e.key AS clave, trim(e.value, ' ') AS v FROM (SELECT fuente, unnest(map_entries(props)) AS e FROM tile_features) WHERE trim(e.value, ' ') <> '' AND NOT regexp_matches(trim(e.value, ' '), '^[-+]?[0-9]+([.,][0-9]+)?$'))
    SELECT fuente, clave, count(*) AS n, CASE WHEN count(*) <= 40 THEN string_agg(v, '; ' ORDER BY v) END AS valores FROM r GROUP BY 1, 2"""
)
def tile_summary(spark, sf):
    return tiles.summary(_t(spark, sf, "tile_features"))


@query("""WITH p AS (SELECT fid, count(*) AS k FROM tile_features WHERE fid IS NOT NULL GROUP BY 1) SELECT (SELECT count(DISTINCT fuente) FROM tile_features) AS tiles, (SELECT count(*) FROM tile_features) AS features, count(*) AS emitidas,
    round(100.0::DOUBLE * (sum(k) - count(*)) / sum(k), 4) AS redundancia, min(k) AS minimo, quantile_cont(k, 0.5)::DOUBLE AS mediana, max(k) AS maximo FROM p""")
def tile_redundancy(spark, sf):
    return reports.redundancy(_t(spark, sf, "tile_features"))


@query("SELECT zoom, count(DISTINCT fuente) AS tiles, count(*) AS features, count(DISTINCT fid) AS unicos FROM tile_features GROUP BY 1")
def tile_statistics(spark, sf):
    return tiles.statistics(_t(spark, sf, "tile_features"))


@query(
    f"""WITH m AS (SELECT fid, fuente FROM (SELECT DISTINCT fid, fuente, zoom FROM tile_features WHERE fid IS NOT NULL) QUALIFY rank() OVER (PARTITION BY fid ORDER BY zoom DESC) = 1),
    r AS (SELECT fid, max({_RICH}) AS riqueza FROM tile_features WHERE fid IS NOT NULL GROUP BY fid) SELECT fuente, count(*) AS n, sum(riqueza)::BIGINT AS valores FROM m JOIN r USING (fid) GROUP BY 1"""
)
def assigned_features(spark, sf):
    return tiles.assigned(_t(spark, sf, "tile_features")).groupBy("fuente").agg(F.count("*").alias("n"), F.sum(tiles.richness(F.col("props"))).alias("valores"))


# --- boilerplate -------------------------------------------------------------------------------------------------

_PARS = r"""SELECT source AS site, doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS ps FROM documents WHERE text IS NOT NULL"""
_SIGNED = rf"""SELECT site, doc_id, i - 1 AS par_no, i = len(ps) AS last, array_to_string(list_slice(w, 1, 6), ' ') || ' … ' || array_to_string(list_slice(w, greatest(1, len(w) - 5), len(w)), ' ') AS firma
    FROM (SELECT site, doc_id, ps, i, list_filter(regexp_split_to_array(lower(ps[i]), '[ \t\n\x{{0B}}\f\r]+'), lambda x: x <> '') AS w FROM (SELECT site, doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM ({_PARS})))"""


@query(f"SELECT site, firma, count(*) FILTER (WHERE last) AS n FROM ({_SIGNED}) GROUP BY 1, 2 HAVING count(*) FILTER (WHERE last) >= 3 AND count(*) FILTER (WHERE NOT last) = 0")
def footer_signatures(spark, sf):
    return boilerplate.footers(boilerplate.paragraphs(_t(spark, sf, "documents")))


@query(f"""WITH s AS ({_SIGNED}), f AS (SELECT site, firma FROM s GROUP BY 1, 2 HAVING count(*) FILTER (WHERE last) >= 3 AND count(*) FILTER (WHERE NOT last) = 0)
    SELECT doc_id, (max(par_no) - coalesce(max(par_no) FILTER (WHERE f.firma IS NULL), -1))::INT AS recortados FROM s LEFT JOIN f ON s.site IS NOT DISTINCT FROM f.site AND s.firma = f.firma AND s.site IS NOT NULL GROUP BY 1 HAVING max(par_no) > coalesce(max(par_no) FILTER (WHERE f.firma IS NULL), -1)""")
def footers_trimmed(spark, sf):
    return boilerplate.without_footers(boilerplate.paragraphs(_t(spark, sf, "documents")))


_WS = r"[ \t\n\x{0B}\f\r]"
_IS_NUMBER = r"regexp_matches(line, '(?i)^[\s\-–—.|\[(]*(?:(?:page|p[aá]gina|p[aá]g\.?|p\.)\s*)?[0-9]{1,4}(?:\s*(?:/|de|of)\s*[0-9]{1,4})?[\s\-–—.|\])]*$')"
_ENDS_CLOSED = """'[.!?…:;。！？।؟]["''”»)\\]]*$'"""
_PAGES = rf"""pg AS (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, regexp_split_to_array(text, '\f|\n[ \t]*\n') AS p FROM documents WHERE text IS NOT NULL)),
    ln AS (SELECT doc_id, i - 1 AS page_no, l, unnest(range(1, len(l) + 1)) AS j FROM (SELECT doc_id, i, string_split(p[i], chr(10)) AS l FROM pg)),
    lines AS (SELECT doc_id, page_no::INT AS page_no, (j - 1)::INT AS line_no, trim(l[j], ' ') AS line FROM ln WHERE trim(l[j], ' ') <> ''),
    marked AS (SELECT *, {_IS_NUMBER} AS num, regexp_replace(regexp_replace(line, '{_WS}+', ' ', 'g'), '[0-9]+', '#', 'g') AS forma FROM lines),
    body AS (SELECT * FROM marked WHERE NOT num QUALIFY row_number() OVER (PARTITION BY doc_id, page_no ORDER BY line_no) <= 8 OR row_number() OVER (PARTITION BY doc_id, page_no ORDER BY line_no DESC) <= 4),
    forms AS (SELECT doc_id, forma, count(DISTINCT page_no) AS n_pages FROM body GROUP BY 1, 2),
    rep AS (SELECT doc_id, forma, n_pages FROM forms JOIN (SELECT doc_id, count(DISTINCT page_no) AS pages FROM lines GROUP BY 1) USING (doc_id) WHERE pages >= 2 AND n_pages >= greatest(2, floor(pages * 0.30::DOUBLE)))"""


@query(f"WITH {_PAGES} SELECT doc_id, forma, n_pages FROM rep")
def repeated_page_lines(spark, sf):
    return boilerplate.repeated_lines(boilerplate.pages(_t(spark, sf, "documents")))


@query(f"""WITH {_PAGES}, ends AS (SELECT doc_id, page_no, line_no FROM marked QUALIFY row_number() OVER (PARTITION BY doc_id, page_no ORDER BY line_no) <= 8 OR row_number() OVER (PARTITION BY doc_id, page_no ORDER BY line_no DESC) <= 4),
    gone AS (SELECT b.doc_id, b.page_no, b.line_no FROM body b SEMI JOIN rep USING (doc_id, forma) UNION SELECT m.doc_id, m.page_no, m.line_no FROM marked m SEMI JOIN ends USING (doc_id, page_no, line_no) WHERE m.num),
    w AS (SELECT m.doc_id, m.page_no, m.line_no, m.line, g.doc_id IS NULL AS stays, len(list_filter(regexp_split_to_array(m.line, '{_WS}+'), lambda x: x <> '')) AS n FROM marked m LEFT JOIN gone g USING (doc_id, page_no, line_no)),
    d AS (SELECT doc_id, sum(n) AS antes, coalesce(sum(n) FILTER (WHERE stays), 0) AS despues, string_agg(line, chr(10) ORDER BY page_no, line_no) AS t0, coalesce(string_agg(line, chr(10) ORDER BY page_no, line_no) FILTER (WHERE stays), '') AS t1 FROM w GROUP BY 1)
    SELECT doc_id, antes::BIGINT AS antes, (CASE WHEN antes - despues > 0.40::DOUBLE * antes THEN antes ELSE despues END)::BIGINT AS despues, CASE WHEN antes - despues > 0.40::DOUBLE * antes THEN t0 ELSE t1 END AS texto FROM d""")
def boilerplate_clean(spark, sf):
    return boilerplate.clean(boilerplate.pages(_t(spark, sf, "documents")))


@query(f"WITH {_PAGES}, low AS (SELECT * FROM forms ANTI JOIN rep USING (doc_id, forma) WHERE n_pages >= 2) SELECT DISTINCT low.doc_id, low.forma, low.n_pages FROM low JOIN rep r ON low.doc_id = r.doc_id AND contains(r.forma, low.forma) AND r.forma <> low.forma")
def surviving_headers(spark, sf):
    return boilerplate.survivors(boilerplate.pages(_t(spark, sf, "documents")))


@query(f"""WITH {_PAGES}, pages AS (SELECT doc_id, page_no, arg_min(line, line_no) AS a, arg_max(line, line_no) AS z FROM lines GROUP BY 1, 2),
    g AS (SELECT doc_id, page_no, CASE WHEN coalesce(NOT regexp_matches(lag(z) OVER w, {_ENDS_CLOSED}) AND regexp_matches(a, '^\\p{{Ll}}'), false) THEN 0 ELSE 1 END AS new FROM pages WINDOW w AS (PARTITION BY doc_id ORDER BY page_no))
    SELECT doc_id, page_no, (sum(new) OVER (PARTITION BY doc_id ORDER BY page_no))::INT AS grupo FROM g""")
def joined_pages(spark, sf):
    return boilerplate.joined_pages(boilerplate.pages(_t(spark, sf, "documents")))


@query(f"""WITH {_PAGES}, n AS (SELECT *, lag(line) OVER w AS b, lead(line) OVER w AS a FROM lines WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY line_no))
    SELECT doc_id, page_no, line_no, line FROM n WHERE len(list_filter(regexp_split_to_array(line, '{_WS}+'), lambda x: x <> '')) <= 12 AND NOT regexp_matches(line, {_ENDS_CLOSED})
    AND (regexp_matches(line, '^\\s*(?:[0-9]+(?:\\.[0-9]+)*[.)]?\\s|[IVXLC]+\\.\\s|[A-Za-z]\\)\\s)') OR regexp_matches(line, '^[\\p{{L}} ]{{2,30}}:\\s*\\S*$') OR upper(line) = line AND regexp_matches(line, '\\p{{Lu}}{{2}}') OR regexp_matches(line, '^\\p{{Lu}}[^.!?]*$'))
    AND (b IS NULL OR regexp_matches(b, {_ENDS_CLOSED})) AND (a IS NULL OR NOT regexp_matches(a, '^\\p{{Ll}}'))""")
def isolated_lines(spark, sf):
    return boilerplate.isolated_lines(boilerplate.pages(_t(spark, sf, "documents")))


def language_rules(spark, sf):
    d = _t(spark, sf, "documents")
    return labels.labelled(d, labels.trained(d))


def mixed_languages(spark, sf):
    return labels.mixed_report(language_rules(spark, sf))


@query(
    r"""SELECT regexp_extract(fuente, '^(.*?)/tiles/', 1) AS serie, count(DISTINCT fuente) AS tiles, count(DISTINCT capa) AS capas, min(zoom)::INT AS zoom_min, max(zoom)::INT AS zoom_max, count(*) AS features FROM tile_features GROUP BY 1"""
)
def tile_manifest(spark, sf):
    return tiles.manifest(_t(spark, sf, "tile_features"))


_ATTR = "nullif(trim(coalesce(props['{0}'], ''), ' '), '')"
_POPUPS = "list_filter([" + ", ".join(_ATTR.format(k) for k in ("popup_es", "popup_pt", "popup_en")) + "], lambda x: x IS NOT NULL)"
_PLAIN = "concat_ws(' | ', " + ", ".join(f"'{k}: ' || " + _ATTR.format(k) for k in ("name", "class", "area")) + ")"


@query(
    f"""SELECT linea, count(*) AS n FROM (SELECT CASE WHEN len(p) > 0 THEN 'popup: ' || array_to_string(list_filter(p, lambda x, i: list_position(p, x) = i), '; ') ELSE plain END AS linea
    FROM (SELECT {_POPUPS} AS p, {_PLAIN} AS plain FROM tile_features)) WHERE linea <> '' GROUP BY 1"""
)
def feature_lines(spark, sf):
    return tiles.described(_t(spark, sf, "tile_features")).groupBy("linea").agg(F.count("*").alias("n"))


# --- chunks ------------------------------------------------------------------------------------------------------


def chunks_packed(spark, sf):
    return chunking.chunk_documents(_t(spark, sf, "documents").select(F.col("doc_id_oficial").alias("doc_id"), "fuente", "formato", "fenomeno", "lang", "text", F.col("title").alias("contexto")))


@query(
    """SELECT formato, count(*) AS n_chunks, count(DISTINCT doc_id) AS n_docs, sum(num_words)::BIGINT AS n_words, max(num_words)::INT AS max_words, count(*) FILTER (WHERE num_words > 250) AS n_long FROM chunks GROUP BY 1"""
)
def chunk_report(spark, sf):
    return chunking.chunk_report(_t(spark, sf, "chunks"))


@query("SELECT doc_id, posicion, chunk_id, round_even(num_words * 1.9::DOUBLE, 0)::INT AS estimado, lower(formato) IN ('pbf','xlsx','csv') AND num_words > 250 AS catalogo FROM chunks")
def token_estimates(spark, sf):
    c = _t(spark, sf, "chunks")
    return c.select("doc_id", "posicion", "chunk_id", text.tokens_estimate(F.col("num_words")).alias("estimado"), chunking.is_catalogue(F.col("formato"), F.col("num_words")).alias("catalogo"))


@query(
    r"""SELECT chunk_id, CASE WHEN coalesce(trim(contexto, ' '), '') <> '' AND fenomeno IS NOT NULL THEN contexto || ' — fenómeno ' || fenomeno WHEN coalesce(trim(contexto, ' '), '') <> '' THEN contexto WHEN fenomeno IS NOT NULL THEN 'fenómeno ' || fenomeno ELSE '' END AS h, md5(CASE WHEN coalesce(trim(contexto, ' '), '') <> '' AND fenomeno IS NOT NULL THEN contexto || ' — fenómeno ' || fenomeno || chr(10) || chr(10) || texto WHEN coalesce(trim(contexto, ' '), '') <> '' THEN contexto || chr(10) || chr(10) || texto WHEN fenomeno IS NOT NULL THEN 'fenómeno ' || fenomeno || chr(10) || chr(10) || texto ELSE texto END) AS m FROM chunks"""
)
def encoder_texts(spark, sf):
    c = _t(spark, sf, "chunks")
    head = F.concat_ws(" — ", F.when(F.trim("contexto") != "", F.col("contexto")), F.when(F.col("fenomeno").isNotNull(), F.concat(F.lit("fenómeno "), F.col("fenomeno").cast("string"))))
    return c.select("chunk_id", head.alias("h"), F.md5(chunking.encoder_text(F.col("texto"), F.col("contexto"), F.col("fenomeno"), True)).alias("m"))


@query(
    r"""SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?…。！？])[ \t\n\x{0B}\f\r]+', '\1' || chr(1), 'g'), chr(1))) AS s FROM documents) WHERE trim(s, ' ') <> '' GROUP BY 1"""
)
def sentence_counts(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.explode(text.sentences(F.col("text"))).alias("s")).groupBy("doc_id").agg(F.count("*").alias("n"))


_OPEN = r'''NOT regexp_matches(trim(texto, ' '), '[.!?…:;。！？।؟]["''”»)\]]*[ \t\n\x{0B}\f\r]*$')'''


@query(f"SELECT formato, count(*) AS n, count(*) FILTER (WHERE {_OPEN}) AS abiertos, round(100.0::DOUBLE * count(*) FILTER (WHERE {_OPEN}) / count(*), 4) AS pct FROM chunks GROUP BY 1")
def terminator_pct(spark, sf):
    return quality.terminators(_t(spark, sf, "chunks"))


@query(
    f"SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE {_OPEN}) AS abiertos FROM chunks WHERE lower(formato) NOT IN ('pbf','xlsx','csv') AND doc_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 3 AND count(*) FILTER (WHERE {_OPEN}) * 2 > count(*)"
)
def open_documents(spark, sf):
    return quality.open_documents(_t(spark, sf, "chunks"))


@query(
    f"""WITH t AS (SELECT trim(texto, ' ') AS t, NOT {_OPEN} AS closed FROM chunks), w AS (SELECT *, regexp_split_to_array(t, '{_WS}+') AS ws FROM t), l AS (SELECT *, list_slice(ws, greatest(1, len(ws) - 14), len(ws)) AS last FROM w)
    SELECT CASE WHEN closed THEN 'cerrado' WHEN regexp_matches(t, '[\\[(][0-9]{{1,3}}[\\])]$|[¹²³]$') THEN 'nota' WHEN regexp_matches(t, '(^|[^0-9A-Za-z_])(19|20)[0-9]{{2}}$') THEN 'anio'
    WHEN len(list_filter(last, lambda x: regexp_matches(x, '^[^A-Za-z]*[0-9][0-9.,;:%/-]*$'))) >= 0.4::DOUBLE * len(last) THEN 'numerico' ELSE 'corte' END AS clase, count(*) AS n FROM l GROUP BY 1"""
)
def residual_class(spark, sf):
    return quality.residual_classes(_t(spark, sf, "chunks"))


@query(
    r"""SELECT formato, count(DISTINCT doc_id) AS n_docs, count(*) AS n_lineas, count(*) FILTER (WHERE NOT regexp_matches(l, '^[A-Za-zÀ-ɏ0-9_.\- ]{1,40}:')) AS huerfanas
    FROM (SELECT formato, doc_id, unnest(string_split(texto, chr(10))) AS l FROM chunks WHERE lower(formato) IN ('pbf','xlsx','csv')) WHERE trim(l, ' ') <> '' GROUP BY 1"""
)
def orphan_lines(spark, sf):
    return quality.orphan_lines(_t(spark, sf, "chunks"))


_STATS = "count(*) AS n, min(v) AS minimo, list_sort(list(v))[(count(*) // 2 + 1)::BIGINT] AS mediana, list_sort(list(v))[(floor(count(*) * 0.95::DOUBLE) + 1)::BIGINT] AS p95, max(v) AS maximo, round(avg(v), 3) AS media"


@query(f"SELECT {_STATS} FROM (SELECT round(1000.0::DOUBLE * num_tokens / num_words)::BIGINT AS v FROM chunks WHERE num_tokens IS NOT NULL AND num_words > 0)")
def token_ratio_stats(spark, sf):
    return quality.token_ratio(_t(spark, sf, "chunks"))


@query(f"SELECT formato, {_STATS} FROM (SELECT formato, num_words AS v FROM chunks WHERE num_words IS NOT NULL) GROUP BY formato")
def word_stats(spark, sf):
    return quality.order_statistics(_t(spark, sf, "chunks"), "num_words", "formato")


@query(
    """WITH b AS (SELECT doc_id, count(*) AS n FROM chunks WHERE doc_id IS NOT NULL GROUP BY 1), v AS (SELECT doc_id, count(DISTINCT chunk_id) AS n FROM chunks WHERE doc_id IS NOT NULL GROUP BY 1)
    SELECT doc_id, b.n AS base, v.n AS variante, v.n - b.n AS delta, v.n < b.n AS mejor FROM b JOIN v USING (doc_id)"""
)
def ab_delta(spark, sf):
    c = _t(spark, sf, "chunks").where("doc_id IS NOT NULL")
    return quality.deltas(c.groupBy("doc_id").agg(F.count("*").alias("n")), c.groupBy("doc_id").agg(F.count_distinct("chunk_id").alias("n")), "doc_id", "n")


@query(
    """SELECT count(*) AS n, bit_xor(('0x' || substr(md5((i - 1)::VARCHAR || chr(31) || doc_id || chr(31) || posicion || chr(31) || chunk_id), 1, 15))::BIGINT) AS huella
    FROM (SELECT coalesce(doc_id, '') AS doc_id, posicion::VARCHAR AS posicion, chunk_id, row_number() OVER (ORDER BY doc_id NULLS FIRST, posicion, chunk_id) AS i FROM chunks)"""
)
def order_fingerprint(spark, sf):
    return quality.fingerprint(_t(spark, sf, "chunks"), "doc_id", "posicion", "chunk_id")


@query(
    """WITH d AS (SELECT doc_id, coalesce(fenomeno::VARCHAR, '') AS fenomeno, md5(doc_id::VARCHAR || '#7') AS h FROM documents), s AS (SELECT fenomeno, count(*) AS k FROM d GROUP BY 1),
    q AS (SELECT fenomeno, least(k, greatest(1, round_even(200.0::DOUBLE * k / (SELECT count(*) FROM d), 0)::BIGINT)) AS quota FROM s)
    SELECT doc_id, fenomeno FROM d JOIN q USING (fenomeno) QUALIFY row_number() OVER (PARTITION BY fenomeno ORDER BY h, doc_id) <= quota"""
)
def stratified_sample(spark, sf):
    return quality.stratified_sample(_t(spark, sf, "documents"), "doc_id", "fenomeno", 200)


@query("SELECT lang, count(*) AS n, count(*) FILTER (WHERE lang IN ('und', '') OR lang IS NULL) AS sin FROM documents GROUP BY 1")
def language_summary(spark, sf):
    return _t(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("lang").isin("und", "") | F.col("lang").isNull()).alias("sin"))


_VOTES = "SELECT doc_id, lang, sum(num_words)::BIGINT AS peso, min(posicion) AS primero FROM (SELECT DISTINCT doc_id, posicion, lang, num_words FROM chunks WHERE doc_id IS NOT NULL AND lang IS NOT NULL) GROUP BY 1, 2"


@query(f"WITH v AS ({_VOTES}) SELECT doc_id, arg_min(lang, (-peso, primero, lang)) AS lang, round(max(peso) / sum(peso), 6) AS parte FROM v GROUP BY 1")
def language_vote(spark, sf):
    c = _t(spark, sf, "chunks").where("doc_id IS NOT NULL AND lang IS NOT NULL").select("doc_id", F.col("posicion").alias("bloque"), "lang", F.col("num_words").alias("peso")).distinct()
    return quality.vote(c)


# --- vectors and retrieval ---------------------------------------------------------------------------------------

_HITS = """SELECT q.vec_id AS query_id, v.vec_id, v.label AS doc_id, list_inner_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS score FROM embeddings q JOIN embeddings v ON q.vec_id % 20 = 0"""
_TOP = f"SELECT * FROM ({_HITS}) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) <= {{0}}"


def _hits(spark, sf, k=C.TOP_K):
    v = _t(spark, sf, "embeddings")
    h = retrieval.knn(v, v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), k)
    return h.join(v.select("vec_id", F.col("label").alias("doc_id")), "vec_id")


@query(f"SELECT query_id, vec_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id)::INT AS rank FROM ({_TOP.format(10)})")
def knn_topk(spark, sf):
    return _hits(spark, sf, 10).select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


def _rank_sql(agg):
    return f"SELECT query_id, doc_id, round(s, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, doc_id)::INT AS rank FROM (SELECT query_id, doc_id, {agg}(score) AS s FROM ({_TOP.format(200)}) GROUP BY 1, 2)"


@query(_rank_sql("max"))
def doc_rank_max(spark, sf):
    return retrieval.document_ranking(_hits(spark, sf), "max").withColumn("score", F.round("score", 6))


@query(_rank_sql("sum"))
def doc_rank_sum(spark, sf):
    return retrieval.document_ranking(_hits(spark, sf), "sum").withColumn("score", F.round("score", 6))


@query(_rank_sql("avg"))
def doc_rank_mean(spark, sf):
    return retrieval.document_ranking(_hits(spark, sf), "mean").withColumn("score", F.round("score", 6))


@query(f"SELECT query_id, doc_id, rank FROM ({_rank_sql('max')}) WHERE rank <= 3")
def top_documents(spark, sf):
    return retrieval.document_ranking(_hits(spark, sf), "max").where(F.col("rank") <= C.DOCUMENTS_PER_QUERY).select("query_id", "doc_id", "rank")


@query("SELECT count(*) AS n, count(*) FILTER (WHERE abs(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) > 0.001) AS n_bad FROM embeddings WHERE embedding IS NOT NULL")
def norm_check(spark, sf):
    return retrieval.norm_check(_t(spark, sf, "embeddings"))


@query(f"SELECT query_id, vec_id, query_id = vec_id AS self FROM ({_TOP.format(1)})")
def self_search(spark, sf):
    return _hits(spark, sf, 1).select("query_id", "vec_id", (F.col("query_id") == F.col("vec_id")).alias("self"))


@query(
    f"""WITH a AS ({_rank_sql('max')}), b AS ({_rank_sql('sum')}), j AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.doc_id, b.doc_id) AS doc_id, a.rank AS v, b.rank AS g FROM a FULL JOIN b ON a.query_id = b.query_id AND a.doc_id = b.doc_id),
    s AS (SELECT *, coalesce(1.0::DOUBLE / (60 + v), 0) + coalesce(1.0::DOUBLE / (60 + g), 0) AS f FROM j) SELECT query_id, doc_id, round(f, 9) AS rrf, row_number() OVER (PARTITION BY query_id ORDER BY round(f, 12) DESC, coalesce(v, 2000000000), coalesce(g, 2000000000), doc_id)::INT AS rank FROM s"""
)
def rrf_fusion(spark, sf):
    h = store(_hits(spark, sf), "hits")
    f = retrieval.fuse(retrieval.document_ranking(h, "max"), retrieval.document_ranking(h, "sum"))
    return f.withColumn("rrf", F.round("rrf", 9))


# --- graph -------------------------------------------------------------------------------------------------------


def _chunks(spark, sf):
    return _t(spark, sf, "chunks").where("chunk_id IS NOT NULL").select("chunk_id", "doc_id", "texto")


def entities(spark, sf):
    return graph.once(graph.entities(_chunks(spark, sf)))


def triplets(spark, sf):
    return graph.once(graph.triplets(_chunks(spark, sf)))


def graph_edges(spark, sf):
    return graph.edges(store(triplets(spark, sf), "triplets"))


def graph_nodes(spark, sf):
    return graph.nodes(triplets(spark, sf))


def _query_entities(spark, sf):
    q = _t(spark, sf, "consultas").select(F.lit(None).cast("string").alias("doc_id"), F.col("query_id").alias("chunk_id"), F.trim("texto").alias("texto"))
    return graph.entities(q).select(F.col("chunk_id").alias("query_id"), "entity")


def graph_candidates(spark, sf):
    return graph.candidates(_query_entities(spark, sf), store(triplets(spark, sf), "triplets"))


def document_evidence(spark, sf):
    return retrieval.evidence(triplets(spark, sf).where("doc_id IS NOT NULL"))


def _ranked_chunks(spark, sf):
    """Chunks that share most distinct words with a query: a ranking for queries that come without a vector."""
    words = lambda t: F.array_distinct(text.words(F.lower(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))))
    q = _t(spark, sf, "consultas").select("query_id", F.explode(words("texto")).alias("w")).where("length(w) > 3")
    c = _chunks(spark, sf)
    # Words, not texts, are shuffled; the few chunks that stay fetch their texts last. 50 fixed queries.
    n = c.select("chunk_id", "doc_id", F.explode(words("texto")).alias("w")).join(F.broadcast(q), "w").groupBy("query_id", "chunk_id", "w").agg(F.max("doc_id").alias("doc_id"))
    n = n.groupBy("query_id", "chunk_id").agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("score"))
    r = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id"))
    top = store(n.withColumn("rank", r).where(F.col("rank") <= C.TOP_K), "ranked")
    texts = c.join(top.select("chunk_id").distinct(), "chunk_id", "left_semi").groupBy("chunk_id").agg(F.first("texto").alias("texto"))
    return top.join(texts, "chunk_id")


def retrieval_fragments(spark, sf):
    return retrieval.fragments(_ranked_chunks(spark, sf), document_evidence(spark, sf))


def evidence_sidecar(spark, sf):
    return retrieval.sidecar(retrieval_documents(spark, sf), triplets(spark, sf).where("doc_id IS NOT NULL"))


def retrieval_documents(spark, sf):
    t = store(triplets(spark, sf), "triplets")
    v = retrieval.document_ranking(_ranked_chunks(spark, sf))
    g = retrieval.ranked(graph.candidates(_query_entities(spark, sf), t))
    return retrieval.fuse(v, g).where(F.col("rank") <= C.DOCUMENTS_PER_QUERY)


def result_check(spark, sf):
    f = store(retrieval_fragments(spark, sf), "fragments")
    d = store(retrieval_documents(spark, sf), "results")
    return retrieval.check_result(d, f, _t(spark, sf, "consultas").count())


@query(
    """SELECT date_trunc('hour', ts) AS hora, event_type, count(*) AS n, count(DISTINCT user_id) AS usuarios, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"""
)
def hourly_events(spark, sf):
    from telar.streaming.incremental import hourly

    return hourly(_t(spark, sf, "events"))


for _f in (language_rules, mixed_languages, chunks_packed, entities, triplets, graph_edges, graph_nodes, graph_candidates, document_evidence, evidence_sidecar, retrieval_fragments, retrieval_documents, result_check):
    Q[_f.__name__] = _f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
