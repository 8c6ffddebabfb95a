"""Building blocks of the oracle SQL: field rules written once more, in the oracle's dialect."""

from __future__ import annotations

from checks.views import VIEWS
from shelfmark.functions import fixed

ROLES = [("designer", "dsr"), ("maker", "mkr"), ("printmaker", "prm")]
CREDIT = "Museum Collection"
EXCLUDED = ["2022.37.37"]
LINK = "https://catalogue.example/full?doc={doc}&query=any,contains,{id}&offset=0"
IMAGE_ROOT = "https://images.example/"


# Columns of the unified and the explorer table, and those the views fill; the others are null.
UNIFIED_KNOWN = (
    "id record_id source_system field_identifier title field_genre field_linked_agent field_edtf_date_created original_date field_subject "
    "field_place_published field_credit_line field_extent field_collection_type field_geographic_subject field_description_long"
).split()
UNIFIED_COLUMNS = UNIFIED_KNOWN + (
    "field_resource_type field_model parent_id field_weight field_member_of file media_use_tid field_display_hints alma_identifier url_alias "
    "field_physical_form field_collection_note field_note field_subject_pictured field_language field_subjects_name field_temporal_subject "
    "three_letter_code country_code field_lvr location storage_location alma_source_type"
).split()
GOLD_KNOWN = UNIFIED_KNOWN + "year_created decade_created search_text image_count has_image".split()


def columns(names, known, text: bool = False) -> str:
    """A select list: known columns as they are, the others null; as text, null is empty."""
    plain = {n: n if n in known else "CAST(NULL AS VARCHAR)" for n in names}
    return ", ".join(f"coalesce(CAST({x} AS VARCHAR), '') AS {n}" if text else x if x == n else f"{x} AS {n}" for n, x in plain.items())


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {lit(fixed.WHITE_SPACE)})"


def clean(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def cases(key: str, table: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items()) + f" ELSE {key} END"


def norm_id(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({x}), '[()\[\]''_]', ' ', 'g'), '[.\s,-]+', '.', 'g'), '.')"


def media_name(x: str) -> str:
    return f"regexp_replace({strip(x)}, '[^a-zA-Z0-9.-]', '_', 'g')"


def primary(x: str) -> str:
    return strip(f"split_part({x}, ';', 1)")


def _usable(x: str, body: str) -> str:
    return f"CASE WHEN {strip(x)} <> '' AND lower({x}) <> 'none' THEN {body} END"


def genre(x: str) -> str:
    key = strip(f"regexp_replace(upper({strip(x)}), '[.,;:!]$', '')")
    return _usable(x, cases(key, fixed.GENRES))


def subject(x: str) -> str:
    part = strip(f"regexp_replace(rtrim({strip('p')}, '.'), '(?i)^subject:', '')")
    return _usable(x, f"array_to_string(list_filter(list_transform(string_split({x}, '|'), lambda p: {part}), lambda h: h <> ''), ' | ')")


def creator(x: str) -> str:
    a = strip("a")
    names = (
        f"list_transform(string_split(replace({x}, '||', '|'), '|'), lambda a: CASE WHEN regexp_matches({a}, '^relators:[^:]*:person:') "
        f"THEN {strip(f'''regexp_extract({a}, '(?s)^relators:[^:]*:person:(.*)$', 1)''')} ELSE {a} END)"
    )
    names = f"list_transform({names}, lambda b: rtrim(b, '.,;'))"
    alias = "CASE lower(d) " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in fixed.CREATOR_ALIASES.items()) + " ELSE d END"
    names = f"list_transform({names}, lambda d: {alias})"
    return f"CASE WHEN {strip(x)} <> '' THEN nullif(array_to_string(list_filter({names}, lambda e: e <> ''), ' | '), '') END"


def title(x: str) -> str:
    return f"CASE WHEN {strip(x)} <> '' THEN rtrim({strip(x)}, '.') END"


def place(x: str) -> str:
    bare = rf"""regexp_replace(regexp_replace({strip(x)}, '^\[?"?\[?', ''), '[\]"''.,;:!?\s]+$', '')"""
    unknown = " OR ".join(f"contains(lower({bare}), {lit(u)})" for u in fixed.UNKNOWN_PLACES)
    listed = f"trim(regexp_replace(replace(replace({bare}, ' |', ', '), '|', ', '), ',\\s*,', ',', 'g'), ' ,')"
    return f"CASE WHEN {strip(x)} <> '' THEN CASE WHEN {unknown} OR {bare} IN ('', '?', '-') THEN 'Unknown' ELSE {listed} END END"


def year(x: str) -> str:
    return rf"nullif(regexp_extract({x}, '\b(1[5-9]\d{{2}}|20[0-2]\d)\b', 1), '')::BIGINT"


def decade(y: str) -> str:
    return f"(floor({y} / 10.0) * 10)::BIGINT"


def extent(x: str) -> str:
    pieces = f"list_filter(list_transform(string_split(regexp_replace(m, 'dimensions,\\s*overall', '', 'g'), '__'), lambda p: {strip('p')}), lambda p: p <> '')"
    pieces = f"list_filter(list_transform({pieces}, lambda q: {strip('''regexp_replace(q, 'inches\\s*', '', 'g')''')}), lambda q: q <> '')"
    number = r"regexp_full_match(r, '[\d\s./-]+')"
    nums = f"list_filter({pieces}, lambda r: {number})"
    labels = f"list_transform(list_filter({pieces}, lambda r: NOT {number}), lambda t: upper(substr(t, 1, 1)) || substr(t, 2))"
    one = f"CASE WHEN len({nums}) > 0 THEN 'Inches ' || array_to_string({nums}, ' x ') || CASE WHEN len({labels}) > 0 THEN ' ' || array_to_string({labels}, ', ') ELSE '' END END"
    measures = f"list_filter(string_split(lower({x}), '||'), lambda m: contains(m, 'inches'))"
    return f"coalesce(array_to_string(list_filter(list_transform({measures}, lambda m: {one}), lambda o: o IS NOT NULL), ' | '), '')"


def edtf(x: str) -> str:
    parts = f"list_filter(list_transform(string_split({x}, '__'), lambda p: {strip('p')}), lambda p: p <> '')"
    dates = f"array_to_string(list_filter({parts}, lambda p: lower(p) <> 'circa'), '/')"
    circa = f"len(list_filter({parts}, lambda p: lower(p) = 'circa')) > 0"
    return f"CASE WHEN {x} IS NULL OR contains(upper({x}), 'UNKNOWN') THEN '' ELSE {dates} || CASE WHEN {circa} AND {dates} <> '' THEN '~' ELSE '' END END"


def edtf_display(x: str) -> str:
    t = strip(x)
    return (
        f"coalesce(CASE WHEN right({t}, 1) = '?' THEN replace(left({t}, length({t}) - 1), '/', ' to ') || ' (year uncertain)' "
        f"WHEN right({t}, 1) = '~' THEN replace(left({t}, length({t}) - 1), '/', ' to ') || ' (year approximate)' "
        f"ELSE replace({t}, '/', ' to ') END, '')"
    )


def agents(x: str) -> str:
    name = strip("string_split(a, '__')[1]")
    role = f"replace(lower(coalesce({strip('''string_split(a, '__')[2]''')}, 'other')), '.', '')"
    code = "CASE " + " ".join(f"WHEN contains({role}, {lit(k)}) THEN {lit(v)}" for k, v in ROLES) + " ELSE 'oth' END"
    coded = f"CASE WHEN {name} <> '' THEN 'relators:' || {code} || ':person:' || {name} END"
    return f"coalesce(array_to_string(list_filter(list_transform(string_split({x}, '||'), lambda a: {coded}), lambda c: c IS NOT NULL), '|'), '')"


def credit(x: str) -> str:
    return f"coalesce(replace(replace({x}, '_', ''), '–', '-'), {lit(CREDIT)})"


def marc_date(a: str, b: str) -> str:
    raw = f"coalesce({clean(a)}, {clean(b)})"
    return clean(rf"regexp_replace(regexp_replace({raw}, '[\[\]().,]', '', 'g'), '\bc([0-9])', '\1', 'g')")


def subject_tag(x: str) -> str:
    return f"CASE WHEN {strip(x)} <> '' THEN 'subject:' || replace({x}, '--', '|subject:') ELSE '' END"


def title_cut(x: str) -> str:
    return f"split_part({x}, ' __ __ __', 1)"


_SEARCH = [c for c in fixed.SEARCH_COLUMNS if c != "Inscription"]

# Derived tables of the oracle, in order of dependence.
DERIVED = {
    "mus_s": ["mus", f"""
SELECT record_id, record_id * 2 + 1 AS id, {clean('field_identifier')} AS field_identifier, {clean(title_cut('title'))} AS title,
       {clean('field_genre')} AS field_genre, {clean(agents('field_linked_agent'))} AS field_linked_agent,
       {clean(edtf('original_date'))} AS field_edtf_date_created, original_date, {clean('field_subject')} AS field_subject,
       {clean("replace(field_place_published, '__', '|')")} AS field_place_published, {clean(credit('field_credit_line'))} AS field_credit_line,
       {clean(extent('field_extent'))} AS field_extent, field_collection_type, CAST(NULL AS VARCHAR) AS field_geographic_subject,
       CAST(NULL AS VARCHAR) AS field_description_long, 'Museum' AS source_system
FROM mus
WHERE NOT coalesce(list_has_any(list_transform(string_split(field_identifier, ';'), lambda p: {strip('p')}), {EXCLUDED}), false)"""],
    "mus_keys": ["mus_s", f"""
SELECT DISTINCT lower({strip('p')}) AS k FROM (SELECT unnest(string_split(field_identifier, ';')) AS p FROM mus_s) WHERE {strip('p')} <> ''"""],
    "lib_parts": ["lib mus_keys", f"""
SELECT record_id, string_agg(CASE WHEN k IS NULL THEN {strip('p')} ELSE {strip('p')} || '_dup_' || record_id END, '; ' ORDER BY i) AS marked
FROM (SELECT record_id, unnest(string_split(field_identifier, ';')) AS p, unnest(range(len(string_split(field_identifier, ';')))) AS i FROM lib)
LEFT JOIN mus_keys ON lower({strip('p')}) = k GROUP BY record_id"""],
    "lib_s": ["lib lib_parts", f"""
SELECT record_id, record_id * 2 AS id, {clean('marked')} AS field_identifier, {clean('title')} AS title, {clean('field_genre')} AS field_genre,
       {clean('field_linked_agent')} AS field_linked_agent, {clean(marc_date('new_264_c', 'new_260_c'))} AS field_edtf_date_created,
       CAST(NULL AS VARCHAR) AS original_date, {clean('field_subject')} AS field_subject, {clean('field_place_published')} AS field_place_published,
       CAST(NULL AS VARCHAR) AS field_credit_line, CAST(NULL AS VARCHAR) AS field_extent, field_collection_type,
       {clean('field_geographic_subject')} AS field_geographic_subject, {clean('field_description_long')} AS field_description_long, 'Library' AS source_system
FROM lib LEFT JOIN lib_parts USING (record_id)
WHERE NOT coalesce(list_has_any(list_transform(string_split(field_identifier, ';'), lambda p: {strip('p')}), {EXCLUDED}), false)"""],
    "unified": ["lib_s mus_s", "SELECT * FROM lib_s UNION ALL BY NAME SELECT * FROM mus_s"],
    "gold_text": ["unified", f"""
SELECT record_id, id, source_system, field_identifier, field_collection_type, field_credit_line, field_extent, field_description_long,
       field_geographic_subject, field_edtf_date_created, original_date, {title('title')} AS title, {genre('field_genre')} AS field_genre,
       {subject('field_subject')} AS field_subject, {creator('field_linked_agent')} AS field_linked_agent, {place('field_place_published')} AS field_place_published,
       {year('field_edtf_date_created')} AS year_created, {decade(year('field_edtf_date_created'))} AS decade_created
FROM unified"""],
    "media_base": ["media", """
SELECT base, min(CASE WHEN nxt IS NULL THEN k + 1 END)::INTEGER AS files FROM (
  SELECT s.base, s.k, n.k AS nxt FROM (
    SELECT DISTINCT regexp_replace(file_name, '[.]jpg$', '') AS base, 0 AS k FROM media
    UNION SELECT DISTINCT regexp_extract(file_name, '^(.+)_([1-9][0-9]*)[.]jpg$', 1), regexp_extract(file_name, '^(.+)_([1-9][0-9]*)[.]jpg$', 2)::INT FROM media WHERE regexp_matches(file_name, '^.+_[1-9][0-9]*[.]jpg$')
  ) s LEFT JOIN (
    SELECT DISTINCT regexp_extract(file_name, '^(.+)_([1-9][0-9]*)[.]jpg$', 1) AS base, regexp_extract(file_name, '^(.+)_([1-9][0-9]*)[.]jpg$', 2)::INT AS k FROM media WHERE regexp_matches(file_name, '^.+_[1-9][0-9]*[.]jpg$')
  ) n ON s.base = n.base AND n.k = s.k + 1
) WHERE base || '.jpg' IN (SELECT file_name FROM media) GROUP BY base"""],
    "gold_media": ["gold_text media_base", f"""
SELECT id AS media_id, arg_min(files, i) AS files FROM (
  SELECT id, unnest(string_split(field_identifier, ';')) AS p, unnest(range(len(string_split(field_identifier, ';')))) AS i FROM gold_text)
JOIN media_base ON {media_name('p')} = base AND {strip('p')} <> '' GROUP BY id"""],
    "gold": ["gold_text gold_media", f"""
SELECT g.*, lower(strip_accents(concat_ws(' ', {', '.join(f"coalesce({c}, '')" if c in
    ('title', 'field_identifier', 'field_collection_type', 'field_credit_line', 'field_extent', 'field_genre', 'field_description_long', 'field_linked_agent', 'field_subject', 'field_place_published', 'source_system')
    else "''" for c in _SEARCH)}))) AS search_text,
    coalesce(files, 0)::INTEGER AS image_count, coalesce(files, 0) > 0 AS has_image
FROM gold_text g LEFT JOIN gold_media ON id = media_id"""],
}


def oracle(uses: str, body: str) -> str:
    """``body`` with the views and derived tables it uses as common table expressions."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name in ordered:
            return
        if name in DERIVED:
            for other in DERIVED[name][0].split():
                need(other)
        ordered.append(name)

    for name in uses.split():
        need(name)
    parts = [f"{n} AS ({DERIVED[n][1] if n in DERIVED else VIEWS[n]})" for n in ordered]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body
