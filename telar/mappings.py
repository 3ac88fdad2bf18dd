"""Field mappings of JSON files by institution, and the fields of catalogues that say nothing."""

from __future__ import annotations

# Families of field mappings.
ARTICLE = {"texto": ["title", "body_paragraphs[]"], "titulo": ["title"], "extra": ["url", "date"]}
ALERT = {
    "texto": ["alerta_meta.tipo", "alerta_meta.municipios", "alerta_meta.tema_clave", "body_paragraphs[]"],
    "titulo": [],
    "extra": ["url", "alerta_meta.codigo", "alerta_meta.fecha_emision"],
}
JOURNAL = {"texto": ["title", "abstract"], "titulo": ["title"], "extra": ["url", "date", "doi", "issue"]}
SECTIONS = {"texto": ["title", "sections[].heading", "sections[].paragraphs[]", "lists[]"], "titulo": ["title"], "extra": ["url"]}
NEWS = {"texto": ["articulo.contenido", "contenido", "body", "texto", "article.body"], "titulo": ["articulo.titulo"], "extra": ["autor", "fecha", "seccion"]}

# The mapping of each institution, by the first two folders of its paths.
MAPPINGS = {
    "F1_IA_y_Capacidades_Estrategicas/Atlantic_Council": ARTICLE,
    "F2_Seguridad_Entorno_Espacial/CSIS_Aerospace": ARTICLE,
    "F2_Seguridad_Entorno_Espacial/SWF_Counterspace": ARTICLE,
    "F2_Seguridad_Entorno_Espacial/INPE": ARTICLE,
    "F2_Seguridad_Entorno_Espacial/ESA_Space_Debris": ARTICLE,
    "F3_Dinamicas_Territoriales/SIPRI": ARTICLE,
    "F3_Dinamicas_Territoriales/CEOBS": ARTICLE,
    "F3_Dinamicas_Territoriales/Alertas_Tempranas": ALERT,
    "F3_Dinamicas_Territoriales/CEEEP": JOURNAL,
    "F1_IA_y_Capacidades_Estrategicas/CENIA": SECTIONS,
    "F1_IA_y_Capacidades_Estrategicas/DAIO": ARTICLE,
    "F1_IA_y_Capacidades_Estrategicas/Defensa21_LatAm": NEWS,
    "F1_IA_y_Capacidades_Estrategicas/RutaN_GEIAL": ARTICLE,
    "F3_Dinamicas_Territoriales/MAPP_OEA": ARTICLE,
    "F3_Dinamicas_Territoriales/RESDAL": ARTICLE,
    "F3_Dinamicas_Territoriales/Amazon_Underworld": ARTICLE,
}

# Pieces of the names of catalogue files.
CATALOGUE_NAMES = ("catalog", "catalogo", "registro", "tiles-index", "indice")

# Fields of catalogues that are no content.
NOISE_FIELDS = frozenset((
    "url", "url_page", "url_pdf", "pdf_url", "page_url", "detail_url",
    "local_path", "path", "dest", "file", "filename", "pdf_local",
    "urls", "hashes", "src", "href", "link", "links",
    "status", "scraped_at", "from_cache", "content_type", "error",
    "desde", "page", "entries",
    "size_bytes", "size_mb", "pdf_size_kb", "fid", "detail_id",
    "study_id", "tile", "zoom", "x", "y", "pmid", "doi",
    "id", "_id", "uuid", "hash", "md5",
))
