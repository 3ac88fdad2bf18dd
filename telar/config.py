"""Fixed values of the data model, and lexicons as plain rows."""

from __future__ import annotations

# Vocabulary of formats, by extension.
FORMATS = {
    "json": "json", "pdf": "pdf", "pbf": "pbf", "mvt": "pbf", "csv": "csv", "jpg": "jpg", "jpeg": "jpg", "xlsx": "xlsx", "xls": "xlsx", "avif": "avif", "txt": "txt",
}
RECORD_FORMATS = ("pbf", "xlsx", "csv")

# Sizes of segments and chunks, in words, and rules of packing.
OBJECTIVE = 200
LONGEST = 250
CATALOGUE_UNITS = 2000
CATALOGUE_OBJECTIVE = 1800
TOKENS_PER_WORD = 1.9
DANGLING_WORDS = 12
DANGLING_TIMES = 2
CEILING = 1.2
CLOSED = ".!?…:;。！？।؟)]}»”\"'"

# Where a fragment may be cut, from the most to the least like a sentence.
EDGES = (
    r"(?<=[.!?…。！？])\s+",
    r"\n+",
    r"\s*;\s*",
    r"\s*\|\s*",
    r"\s+/\s+",
    r"(?<=\))/(?=[A-ZÁÉÍÓÚÑ])",
    r"\t+",
)

# Repeated lines of pages.
HEAD_LINES = 8
FOOT_LINES = 4
REPEATED_SHARE = 0.30
REMOVABLE_SHARE = 0.40
FOOTER_WORDS = 6
FOOTER_ARTICLES = 3

# Retrieval.
TOP_K = 200
DOCUMENTS_PER_QUERY = 3
FRAGMENTS_PER_QUERY = 10
FRAGMENT_WORDS = 250
RRF_K = 60

# Tiles and language rules.
SUMMARY_VALUES = 40
LANGUAGE_CHARS = 25
LANGUAGE_BLOCK = 800
LANGUAGE_ALPHA = 0.30
LANGUAGE_MIXED = 0.85
LANGUAGE_SHORT = 200
LANGUAGE_SHORT_SURE = 0.50

# Surface forms of relations and the relation each one states, in order of emission.
RELATIONS = (
    ("desarrolla", "desarrolla"), ("regula", "regula"), ("coordina", "coordina"), ("afecta", "afecta"), ("opera", "opera"),
    ("develops", "desarrolla"), ("develop", "desarrolla"), ("governs", "regula"), ("coordinates", "coordina"), ("affects", "afecta"), ("operates", "opera"),
)
# Entities by kind.
ENTITIES = {
    "lugar": (
        "estados unidos", "colombia", "china", "rusia", "ee.uu.", "onu", "nato", "unión europea", "union europea", "fuerza aérea", "fuerza aerea",
        "américa latina", "america latina", "latam", "alianza", "ministerio de defensa", "ministerio de relaciones exteriores",
    ),
    "tecnología": (
        "ia", "inteligencia artificial", "sistema autónomo", "sistema autonomo", "algoritmo", "algoritmos", "software", "tecnología", "tecnologia", "dron",
        "drones", "satélite", "satelite", "nube", "ciberseguridad", "seguridad espacial",
    ),
    "evento": (
        "cumbre", "conferencia", "acuerdo", "cumbre de seguridad", "incidente", "guerra", "conflicto", "proliferación", "proliferacion", "cooperación",
        "cooperacion", "colisión", "colision",
    ),
}

# Words that name no entity, and those that a short phrase may not hold.
ENTITY_STOPWORDS = frozenset((
    "la", "el", "los", "las", "de", "del", "y", "en", "para", "con",
    "por", "sobre", "como", "según", "segun", "una", "unos", "unas",
    "the", "and", "for", "with", "of", "in", "on", "to", "a", "an",
))
ENTITY_GLUE = ("por", "con", "para", "y")
#: What an edge says of itself comes from so many of its places; all of them are rows beside it.
EDGE_SOURCES = 20
