"""Column -> Column building blocks."""

from eventlake.functions.dates import (  # noqa: F401
    brt_display, compose_card_date, date_phrase, ingest_date_from_path,
    numeric_dmy_timestamp, pt_timestamp, to_brt, to_ts_any,
)
from eventlake.functions.text import (  # noqa: F401
    absolute_from_origin, absolute_from_root, alias_pick, archive_key, city_from_venue,
    decode_text, decoded_path, date_prefix, date_value, doc_id, drop_query, fill_city,
    is_usable_city, js_trim, normalize_columns, normalize_header, page_number, py_strip,
    source_from_path, split_first_comma, title_fallback, uri_bucket, uri_key, venue_local,
)
