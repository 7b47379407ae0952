"""Schemas of every layer, and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for equal results).
# ---------------------------------------------------------------------------

# Portuguese month names and abbreviations -> month number.
PT_MONTHS = {
    "janeiro": 1, "fevereiro": 2, "marco": 3, "março": 3, "abril": 4, "maio": 5,
    "junho": 6, "julho": 7, "agosto": 8, "setembro": 9, "outubro": 10,
    "novembro": 11, "dezembro": 12,
    "jan": 1, "fev": 2, "mar": 3, "abr": 4, "mai": 5, "jun": 6, "jul": 7,
    "ago": 8, "set": 9, "out": 10, "nov": 11, "dez": 12,
}

# Fallback timestamp patterns tried after the Portuguese parser, in order.
FALLBACK_TS_PATTERNS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy HH:mm", "dd/MM/yyyy"]

# City values treated as missing (compared lower-cased).
NULL_LIKE_CITIES = ["null", "none", "n/a", "na"]

# Display zone of the presentation layer.
BRT_TZ = "America/Sao_Paulo"

# Header aliases of the document loader, per output field (first non-empty wins).
DOC_ALIASES = {
    "nome": ["nome do evento", "nome", "titulo", "title"],
    "local": ["local", "venue", "local do evento"],
    "cidade": ["cidade", "city"],
    "data": ["evento (formato dd/mm/yyyy)", "data do evento", "data", "evento"],
    "hora": ["hora do evento (horário do brasil)", "hora do evento (horario do brasil)", "hora"],
    "origem": ["origem", "source"],
}

# Required header set per feed and the feed's source tag.
FEED_REQUIRED = {
    "sympla": ["url", "title", "place", "date"],
    "ticket360": ["url", "title", "place", "city", "date"],
    "eventim": ["artist", "url", "location", "date"],
}

# Folder names of each feed under a Bronze root (two case variants of the root,
# one misspelt folder for the third feed).
FEED_FOLDERS = {
    "sympla": ["Bronze/database Sympla", "bronze/database Sympla"],
    "ticket360": ["Bronze/database Ticket360", "bronze/database Ticket360"],
    "eventim": ["Bronze/database Eventim", "bronze/database Eventim",
                "Bronze/database Evetim", "bronze/database Evetim"],
}

# Source label when a path names no known feed.
UNKNOWN_SOURCE = "desconhecida"

# Placeholder date of archive keys for undated inputs.
UNDATED = "0000-00-00"

# Presentation (gold) column -> exported display name.
GOLD_DISPLAY_NAMES = {
    "nome": "Nome do evento",
    "local": "local",
    "cidade": "cidade",
    "data": "evento (formato dd/mm/yyyy)",
    "hora": "hora do evento (horário do brasil)",
    "origem": "origem",
    "data_ingestao": "data de ingestão",
}

S = T.StringType()

# Canonical event table: column names, order and types.
STD_SCHEMA = T.StructType([
    T.StructField("event_url", S, True),
    T.StructField("title", S, True),
    T.StructField("venue", S, True),
    T.StructField("city", S, True),
    T.StructField("event_date_text", S, True),
    T.StructField("event_date", T.TimestampType(), True),
    T.StructField("source", S, True),
    T.StructField("ingest_date", S, True),
    T.StructField("src_file", S, True),
])

# ---------------------------------------------------------------------------
# Derived schemas
# ---------------------------------------------------------------------------

FEED_SCHEMAS = {feed: T.StructType([T.StructField(c, S, True) for c in columns]) for feed, columns in FEED_REQUIRED.items()}

#: Silver keeps all but the source file.
SILVER_COLUMNS = [name for name in STD_SCHEMA.names if name != "src_file"]

GOLD_COLUMNS = list(GOLD_DISPLAY_NAMES)

DOC_SCHEMA = T.StructType([
    T.StructField("_id", S, False),
    T.StructField("nome", S, True),
    T.StructField("data", S, True),
    T.StructField("hora_local", S, True),
    T.StructField("lugar", T.StructType([
        T.StructField("cidade", S, True),
        T.StructField("venue", S, True),
        T.StructField("estado", S, True),
    ]), True),
    T.StructField("origem", S, True),
    T.StructField("source_key", S, True),
])
