"""Word lists, lookup tables and patterns that define the results."""

# The white space a Unicode-aware ``strip`` removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set as the inside of a regex character class (valid in Java and in RE2).
WHITE_SPACE_CLASS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# Genre vocabulary (raw label -> shelf label).
GENRES = {
    "POSTER": "POSTER", "POSTERS": "POSTER", "BROADSIDE": "POSTER",
    "PAMPHLET": "PAMPHLET", "PAMPHLETS": "PAMPHLET", "BROCHURE": "PAMPHLET", "LEAFLET": "PAMPHLET",
    "BOOK": "BOOKS", "BOOKS": "BOOKS", "MONOGRAPH": "BOOKS",
    "PERIODICAL": "PERIODICAL", "JOURNAL": "PERIODICAL", "MAGAZINE": "PERIODICAL", "SERIAL": "PERIODICAL",
    "PHOTOGRAPH": "PHOTOGRAPH", "PHOTO": "PHOTOGRAPH", "PHOTOGRAPHY": "PHOTOGRAPH",
    "NEGATIVE": "PHOTOGRAPH", "SLIDE": "PHOTOGRAPH",
    "DRAWING": "DRAWING", "DRAWINGS": "DRAWING", "SKETCH": "DRAWING",
    "PRINT": "PRINT", "PRINTS": "PRINT", "LITHOGRAPH": "PRINT", "ETCHING": "PRINT",
    "WOODCUT": "PRINT", "ENGRAVING": "PRINT",
    "POSTCARD": "POSTCARD", "POST CARD": "POSTCARD", "POSTCARDS": "POSTCARD",
    "EPHEMERA": "EPHEMERA", "EPHEMERAL": "EPHEMERA", "ADVERTISING EPHEMERA": "EPHEMERA",
    "MIXED MEDIA": "MIXED MEDIA", "MIXED-MEDIA": "MIXED MEDIA",
    "OBJECT": "OBJECT", "OBJECTS": "OBJECT", "MUSEUM OBJECT": "OBJECT",
    "PAINTING": "PAINTING", "PAINTINGS": "PAINTING",
    "SCULPTURE": "SCULPTURE", "STATUE": "SCULPTURE",
    "TEXTILE": "TEXTILE", "TEXTILES": "TEXTILE", "FABRIC": "TEXTILE", "CLOTHING": "TEXTILE",
    "MAP": "MAP", "MAPS": "MAP", "CARTOGRAPHIC": "MAP",
    "FURNITURE": "FURNITURE", "DECORATIVE ARTS": "FURNITURE",
    "EXHIBITION CATALOGS": "EXHIBITION CATALOG", "EXHIBITION CATALOG": "EXHIBITION CATALOG",
    "BIBLIOGRAPHY": "BOOKS", "CATALOGS": "CATALOG", "COLLECTION": "COLLECTION",
}

# Creator spelling variants (lower case) -> preferred name.
CREATOR_ALIASES = {
    "josef grof": "József Gróf",
    "josef gróf": "József Gróf",
    "wiener werkstaette": "Wiener Werkstätte",
    "wiener werkstatte": "Wiener Werkstätte",
    "wiener werkstätte": "Wiener Werkstätte",
}

# Shelf codes that mean the reference reading room.
REFERENCE_SHELVES = (
    "REF", "REFO", "REFDO",
    "Reference (REF)", "Reference Oversized (REFO)", "Reference Double Oversized (REFDO)",
)

# A year between 1500 and 2029.
YEAR_PATTERN = r"1[5-9][0-9]{2}|20[0-2][0-9]"

# Place texts that mean "unknown".
UNKNOWN_PLACES = ("place of publication not identified", "s.l", "s.i.", "n.l.")

# Column order of the unified catalogue.
CATALOG_COLUMNS = [
    "id", "field_resource_type", "field_collection_type", "field_model", "parent_id",
    "field_weight", "field_member_of", "file", "media_use_tid",
    "field_display_hints", "field_identifier", "alma_identifier", "title", "url_alias",
    "field_genre", "field_linked_agent", "field_credit_line",
    "field_edtf_date_created", "field_description_long", "field_extent",
    "field_physical_form", "field_collection_note", "field_note", "field_place_published",
    "field_geographic_subject", "field_subject_pictured", "field_language",
    "field_subject", "field_subjects_name", "field_temporal_subject", "three_letter_code",
    "country_code", "field_lvr", "source_system", "location", "storage_location", "alma_source_type",
]

# Columns that make up the search text, in order.
SEARCH_COLUMNS = [
    "title", "field_identifier", "field_collection_type", "field_collection_note", "field_credit_line",
    "field_extent", "field_physical_form", "field_genre", "field_description_long", "field_linked_agent",
    "field_subject", "field_place_published", "source_system", "Inscription",
]

# Columns the explorer reads.
EXPLORER_COLUMNS = [
    "id", "title", "field_identifier", "field_collection_type", "field_collection_note", "field_credit_line",
    "field_extent", "field_physical_form", "field_genre", "field_description_long", "field_linked_agent",
    "field_subject", "field_place_published", "field_edtf_date_created", "decade_created", "year_created",
    "source_system", "has_image", "image_count", "has_audio", "audio_count", "search_text", "location",
    "alma_identifier", "storage_location",
]

# Columns of the gap report, in order.
GAP_COLUMNS = [
    "id", "field_resource_type", "field_model", "parent_id", "field_weight", "field_member_of", "file",
    "media_use_tid", "field_display_hints", "field_identifier", "access_nbr", "url_alias", "title", "field_linked_agent",
    "field_genre", "field_edtf_date_created", "field_place_published", "field_subject",
    "field_description_long", "field_credit_line", "field_physical_form", "field_extent",
    "field_collection_type", "qa_pass", "location",
]

# Raw museum columns -> catalogue columns.
MUSEUM_RENAMES = {
    "cat_nbr": "field_identifier", "cat_nam": "title", "artist": "field_linked_agent", "name": "field_genre",
    "categ_16": "original_date", "maker": "field_place_published", "categ_9": "field_subject",
    "obj_mem": "field_description_long", "categ_4": "field_credit_line", "class": "field_physical_form",
    "weight": "field_extent", "sortable4": "location", "categ_8": "storage_location", "categ_6": "Inscription",
}

# Constants of a museum record.
MUSEUM_CONSTANTS = {
    "field_resource_type": "Collection", "field_model": "Paged Content", "parent_id": "", "field_weight": "",
    "field_member_of": "613", "file": "", "media_use_tid": "", "field_display_hints": "", "url_alias": "",
    "field_collection_type": "Objects",
}

# Flattened library columns -> catalogue columns.
LIBRARY_RENAMES = {
    "new_907_full": "field_identifier", "new_001_ctrl": "alma_identifier", "new_598_a": "field_credit_line",
    "new_655_a": "field_genre", "new_500_a": "field_description_long", "new_561_a": "field_collection_note",
    "new_260_a": "field_place_published", "new_546_a": "field_language", "new_610_a": "field_subjects_name",
    "new_008_ctrl": "country_code", "new_006_ctrl": "field_lvr", "new_650_z": "field_geographic_subject",
    "new_650_y": "field_temporal_subject",
}

# Constants of a library record.
LIBRARY_CONSTANTS = {"field_resource_type": "Collection", "field_model": "Paged Content"}

# Library columns merged into one, in order.
CREATOR_PARTS = [
    "new_260_b", "new_100_a", "new_100_q", "new_110_a", "new_111_a", "new_710_a", "new_700_a", "new_700_q",
]
PICTURED_PARTS = ["new_965_a", "new_965_x", "new_965_z", "new_965_y"]

# Literal text removed from library columns (text, replacement).
LIBRARY_STRIPS = {
    "field_identifier": [("Local", ""), ("local", ""), ("@", " ")],
    "title": [("/", ""), ("--", "")],
    "field_genre": [(".", "")],
    "field_place_published": [(":", "")],
    "field_physical_form": [(".", "")],
    "field_language": [(".", "")],
    "field_geographic_subject": [(".", "")],
}

# Subfield order of the joined note.
NOTE_CODES = [
    "n", "x", "p", "t", "4", "k", "5", "e", "r", "c", "l", "v", "o", "i", "m", "j", "6", "b", "0", "w", "1",
    "d", "s", "3", "f", "q",
]

# Ranking weights of a search term, by what it is found in.
RANK_WEIGHTS = {
    "exact_identifier": 1000.0, "field_identifier": 2.0, "title": 5.0, "field_genre": 4.5,
    "field_linked_agent": 4.0, "field_subject": 3.0, "search_text": 1.0, "field_place_published": 1.0,
    "field_physical_form": 1.0, "field_credit_line": 0.5, "image_boost": 10.0,
}

# Retrieval stop words and score weights.
STOP_WORDS = (
    "a", "an", "the", "in", "on", "at", "to", "for", "with", "about", "show", "me", "find", "search",
    "what", "is", "are", "do", "does",
)
RETRIEVAL_WEIGHTS = {"title": 2, "field_subject": 1, "field_description_long": 1, "field_genre": 1}

# Words that raise a log alert, and texts that silence it.
ALERT_WORDS = ("ERROR", "FATAL", "Exception", "Traceback")
ALERT_IGNORES = (
    "Suggested prompts generation failed", "qa_errors", "No such file or directory",
    "reset from ERROR state to: WAITING", "_error.yaml", "liquibase.changelog",
    "Request canceled before finishing",
)

# Record card, labels in display order and hidden columns.
CARD_ORDER = [
    "field_identifier", "field_collection_type", "field_extent", "field_genre", "field_description_long",
    "field_linked_agent", "field_subject", "field_place_published", "field_edtf_date_created",
    "decade_created", "field_physical_form", "field_collection_note", "field_credit_line",
]
CARD_LABELS = {
    "field_identifier": "Accession Number", "field_collection_type": "Collection",
    "field_extent": "Dimensions", "field_genre": "Genre", "field_description_long": "Description",
    "field_linked_agent": "Creator", "field_subject": "Subjects", "field_place_published": "Place Published",
    "field_edtf_date_created": "Date Created", "decade_created": "Decade Created",
    "field_credit_line": "Credit Line", "field_physical_form": "Material",
    "field_collection_note": "Collection Note", "location": "Location",
}
CARD_HIDDEN = [
    "has_image", "title", "year_created", "source_system", "id", "image_count", "has_audio", "audio_count",
    "search_text", "alma_identifier",
]

# Legacy lookup projection (column -> display name).
LEGACY_LOOKUP = {
    "field_identifier": "Accession Number", "field_collection_type": "Resource Type", "title": "Title",
    "id": "ID (Node ID)", "field_collection_note": "Collection", "field_linked_agent": "Creator",
    "field_genre": "Genre", "field_edtf_date_created": "Date", "field_place_published": "Geographic Origin",
    "field_subject": "Subject", "field_description_long": "Description", "field_credit_line": "Credit Line",
    "field_physical_form": "Material", "field_extent": "Extent", "image_count": "Media: Name",
    "alma_identifier": "Additional Accession Numbers",
}

# Column order of a collection export.
EXPORT_COLUMNS = [
    "field_identifier", "spreadsheet_thumbnail", "title", "field_collection_type", "field_genre",
    "field_description_long", "field_linked_agent", "field_subject", "field_place_published",
    "field_edtf_date_created", "decade_created", "field_extent", "field_collection_note", "source_system",
    "id", "image_url", "location", "storage_location",
]

# Media file extensions.
IMAGE_EXTENSIONS = (".tif", ".tiff", ".jpg", ".jpeg", ".png")
