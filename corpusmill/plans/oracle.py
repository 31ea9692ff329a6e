"""DuckDB SQL oracles for the registered queries.

Each oracle recomputes its query from the raw test tables with plain SQL
(DuckDB has ``nfc_normalize``, ``sha256`` and ``url_encode``), so it shares no
code with the Spark side.  The adapter (documents -> examples) is a common CTE.
"""

from __future__ import annotations

# Whitespace class equal to Python's str.isspace set, in RE2 syntax.
WS = r"[\s\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
XML_BASE = "https://raw.githubusercontent.com/corpus-org/corpus-org/main/Corpora/"
HUB_BASE = "https://huggingface.co/datasets/"
ORG = "corpus-org"
SEP = "chr(9247)"  # U+241F


def n(x: str) -> str:
    """norm(x): NULL -> '', NFC, drop U+200B, collapse whitespace, trim."""
    return f"trim(regexp_replace(replace(nfc_normalize(coalesce({x}, '')), chr(8203), ''), '{WS}+', ' ', 'g'))"


def rt(x: str) -> str:
    return n(f"CAST({x} AS VARCHAR)")


def bucket(k: str) -> str:
    return f"(('0x' || substr(sha256({k}), 1, 8))::UBIGINT::DOUBLE / 4294967295::DOUBLE)"


def split_case(k: str, train: float = 0.9, valid: float = 0.05) -> str:
    b = bucket(k)
    return (
        f"CASE WHEN {b} < CAST({train!r} AS DOUBLE) THEN 'train' "
        f"WHEN {b} < CAST({train!r} AS DOUBLE) + CAST({valid!r} AS DOUBLE) THEN 'valid' ELSE 'test' END"
    )


def _raw(x: str, k: str) -> str:
    return (
        f"CASE ({k}) % 17 WHEN 0 THEN replace({x}, ' ', chr(160) || ' ' || chr(12288)) "
        f"WHEN 1 THEN replace({x}, chr(233), 'e' || chr(769)) "
        f"WHEN 2 THEN replace({x}, chr(233), 'e' || chr(8203) || chr(769)) "
        f"WHEN 3 THEN chr(8203) || replace({x}, ' ', chr(28)) || chr(31) ELSE {x} END"
    )


def url_quote(x: str) -> str:
    return f"replace(url_encode({x}), '%2F', '/')"


DOCS = """docs AS (
  SELECT doc_id, text, lang, source, n_chars,
         CASE WHEN doc_id % 5 = 0 THEN 'ILRDF_Dicts' ELSE 'ePark' END AS grp,
         CASE WHEN doc_id % 5 = 0 THEN 'Puyuma' ELSE source END AS corpus_slug,
         lang AS dialect
  FROM (SELECT * REPLACE (coalesce(lang, 'unnamed') AS lang, coalesce(source, 'unnamed') AS source) FROM documents) n)"""

REG = f"""reg AS (
  SELECT CAST(row_number() OVER (ORDER BY blk, corpus_slug, dialect) - 1 AS INTEGER) AS source_ord,
         grp, corpus_slug, dialect, xml_relative_path, audio_repo, audio_mode
  FROM (SELECT DISTINCT CASE WHEN grp = 'ePark' THEN 0 ELSE 1 END AS blk, grp, corpus_slug, dialect,
          CASE WHEN grp = 'ePark' THEN 'ePark/XML/' || corpus_slug || '/Puyuma/' || dialect || '_Puyuma.xml'
               ELSE 'ILRDF_Dicts/XML/' || corpus_slug || '/' || dialect || '/' || corpus_slug || '.xml' END AS xml_relative_path,
          CASE WHEN grp = 'ePark' THEN '{ORG}/ePark_' || corpus_slug ELSE '{ORG}/ILRDF_Dict_' || corpus_slug END AS audio_repo,
          CASE WHEN grp = 'ePark' THEN 'diarized' ELSE 'segmented' END AS audio_mode
        FROM docs) x)"""

SENTS = """sents0 AS (
  SELECT *, unnest(range(1, (len(L) + 1) // 2 + 1)) AS sent_pos
  FROM (SELECT *, string_split(coalesce(text, ''), chr(10)) AS L FROM docs) d),
sents AS (
  SELECT doc_id, lang, source, n_chars, grp, corpus_slug, dialect, sent_pos, doc_id + sent_pos AS k,
         L[2 * sent_pos - 1] AS line1, coalesce(L[2 * sent_pos], '') AS line2
  FROM sents0)"""

RAW = f"""raw AS (
  SELECT doc_id, sent_pos, k, grp, corpus_slug, dialect, source, n_chars,
         CASE WHEN doc_id % 9 = 0 THEN '' ELSE lang END AS lang_attr,
         CASE WHEN doc_id % 6 = 0 THEN 'segmented' ELSE '' END AS audio_attr,
         'Corpus ' || source || ' document ' || CAST(doc_id AS VARCHAR) AS citation_attr,
         's' || CAST(sent_pos AS VARCHAR) AS id_attr,
         CASE WHEN k % 23 = 0 THEN '' ELSE {_raw('line1', 'k')} END AS form_raw,
         {_raw('line2', 'k')} AS transl_raw,
         CASE WHEN k % 7 = 0 THEN '' ELSE 'a ' || CAST((doc_id - doc_id % 3) * 4096 + sent_pos AS VARCHAR) || '.wav' END AS audio_file,
         CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(k % 10 AS DOUBLE) * CAST(0.5 AS DOUBLE) END AS audio_start,
         CASE WHEN k % 19 = 0 THEN CAST('nan' AS DOUBLE)
              ELSE CAST(n_chars % 7919 AS DOUBLE) / CAST(1000.0 AS DOUBLE) + CAST(sent_pos AS DOUBLE) * CAST(0.25 AS DOUBLE) END AS audio_end
  FROM sents)"""

EX = f"""ex0 AS (
  SELECT r.*, g.source_ord, g.xml_relative_path, g.audio_mode AS reg_audio_mode,
         r.grp || '/' || r.corpus_slug || '/' || r.dialect AS source_key,
         {n('form_raw')} AS original_form,
         CASE WHEN k % 13 = 0 THEN '' ELSE {n('transl_raw')} END AS translation_zh
  FROM raw r JOIN reg g ON r.grp = g.grp AND r.corpus_slug = g.corpus_slug AND r.dialect = g.dialect),
ex1 AS (
  SELECT *, CASE WHEN k % 3 = 0 THEN '' ELSE lower(original_form) END AS standard_form FROM ex0),
ex AS (
  SELECT source_key || ':' || id_attr AS record_id, source_key, grp AS "group", corpus_slug, dialect,
         CASE WHEN lang_attr = '' THEN 'pyu' ELSE lang_attr END AS language_code,
         CASE WHEN audio_attr = '' THEN reg_audio_mode ELSE audio_attr END AS audio_mode,
         '{XML_BASE}' || xml_relative_path AS xml_source_url,
         '/data/raw/xml/' || xml_relative_path AS xml_path,
         citation_attr AS citation, 'CC BY-NC 4.0' AS copyright, '' AS bibtex_citation,
         source AS root_source_label, 'puyu1239' AS root_glottocode, id_attr AS sentence_id,
         original_form, standard_form,
         CASE WHEN k % 4 = 0 THEN '' ELSE replace(original_form, 'o', chr(596)) END AS original_phonetic,
         CASE WHEN k % 2 = 0 THEN '' ELSE replace(standard_form, 'o', chr(596)) END AS standard_phonetic,
         translation_zh,
         audio_file,
         CASE WHEN audio_file = '' THEN '' ELSE 'https://audio.example.org/' || dialect || '/' || audio_file END AS audio_url,
         audio_start, audio_end,
         coalesce(nullif(standard_form, ''), original_form) AS source_text,
         coalesce(nullif(CASE WHEN k % 2 = 0 THEN '' ELSE replace(standard_form, 'o', chr(596)) END, ''),
                  CASE WHEN k % 4 = 0 THEN '' ELSE replace(original_form, 'o', chr(596)) END) AS source_phonetic,
         translation_zh AS target_text,
         CASE WHEN audio_start IS NULL OR audio_end IS NULL THEN NULL
              WHEN isnan(audio_end - audio_start) OR audio_end - audio_start <= 0 THEN CAST(0.0 AS DOUBLE)
              ELSE audio_end - audio_start END AS duration_seconds,
         CAST(source_ord AS BIGINT) AS source_ord, doc_id, sent_pos
  FROM ex1)"""

BASE = f"WITH {DOCS},\n{REG},\n{SENTS},\n{RAW},\n{EX}"

TKEY = f"{n('source_text')} || {SEP} || {n('target_text')}"
AKEY = f"coalesce(nullif({n('audio_file')}, ''), record_id)"
ORDER = "source_ord, doc_id, sent_pos"

TRANSLATION_COLS = (
    'record_id, source_key, "group", corpus_slug, dialect, language_code, source_text, source_phonetic, target_text, '
    "translation_zh, audio_file, audio_url, audio_start, audio_end, duration_seconds, xml_path, xml_source_url, "
    "citation, copyright, bibtex_citation"
)
TTS_COLS = (
    'record_id, source_key, "group", corpus_slug, dialect, language_code, source_text AS text, source_phonetic AS phonetic, '
    "source_text AS normalized_text, audio_file, audio_url, audio_start, audio_end, duration_seconds, xml_path, "
    "xml_source_url, citation, copyright, bibtex_citation"
)

MANIFESTS = f"""{BASE},
tdd AS (SELECT * FROM ex QUALIFY row_number() OVER (PARTITION BY {TKEY} ORDER BY {ORDER}) = 1),
tm AS (SELECT {TRANSLATION_COLS}, {ORDER} FROM tdd WHERE target_text <> '' AND source_text <> ''),
add AS (SELECT * FROM ex QUALIFY row_number() OVER (PARTITION BY {AKEY} ORDER BY {ORDER}) = 1),
am AS (SELECT {TTS_COLS}, {ORDER} FROM add WHERE audio_file <> '' AND source_text <> ''),
tms AS (SELECT *, {split_case(f"{rt('source_text')} || {SEP} || {rt('target_text')}")} AS split FROM tm),
ams AS (SELECT *, {split_case(f"coalesce(nullif({rt('audio_file')}, ''), {rt('record_id')})")} AS split FROM am)"""


def queries_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["examples_table"] = f"{BASE} SELECT * FROM ex"
    q["record_count"] = f"{BASE} SELECT count(*) AS record_count FROM ex"
    q["derived_columns"] = f"{BASE} SELECT doc_id, sent_pos, source_text, source_phonetic, target_text FROM ex"
    q["duration"] = f"{BASE} SELECT doc_id, sent_pos, duration_seconds FROM ex"
    q["default_fill"] = f"{BASE} SELECT doc_id, sent_pos, language_code, audio_mode FROM ex"
    q["record_key"] = (
        f"{BASE} SELECT record_id, count(*) AS n, min(doc_id) AS first_doc_id FROM ex GROUP BY record_id"
    )
    q["text_normalize"] = (
        f"{BASE} SELECT doc_id, sent_pos, {n('form_raw')} AS norm_form, {n('transl_raw')} AS norm_transl, "
        f"{n(n('form_raw'))} AS norm2_form FROM raw"
    )
    q["row_text"] = (
        f"{BASE} SELECT doc_id, sent_pos, {rt('form_raw')} AS rt_form, {rt('doc_id')} AS rt_doc, "
        f"{rt('sent_pos * 1000 + doc_id')} AS rt_num, {rt('NULL')} AS rt_null FROM raw"
    )
    q["dedupe_translation"] = (
        f"{BASE} SELECT doc_id, sent_pos, source_ord, {TKEY} AS dedupe_key FROM ex "
        f"QUALIFY row_number() OVER (PARTITION BY {TKEY} ORDER BY {ORDER}) = 1"
    )
    q["dedupe_tts"] = (
        f"{BASE} SELECT doc_id, sent_pos, source_ord, {AKEY} AS dedupe_key FROM ex "
        f"QUALIFY row_number() OVER (PARTITION BY {AKEY} ORDER BY {ORDER}) = 1"
    )
    q["dedupe_first"] = (
        f"{BASE} SELECT record_id, doc_id, sent_pos FROM ex "
        f"QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY {ORDER}) = 1"
    )
    q["dedupe_counts"] = (
        f"{BASE} SELECT 'translation' AS kind, count(*) AS total, count(DISTINCT {TKEY}) AS kept, "
        f"count(*) - count(DISTINCT {TKEY}) AS dropped FROM ex "
        f"UNION ALL SELECT 'tts', count(*), count(DISTINCT {AKEY}), count(*) - count(DISTINCT {AKEY}) FROM ex"
    )
    q["manifest_translation"] = f"{MANIFESTS} SELECT * FROM tm"
    q["manifest_tts"] = f"{MANIFESTS} SELECT * FROM am"
    q["split_bucket"] = f"{BASE} SELECT doc_id, sent_pos, {bucket(TKEY)} AS bucket FROM ex"
    q["split_rows"] = f"{BASE} SELECT doc_id, sent_pos, {split_case('record_id', 0.8, 0.1)} AS split FROM ex"
    q["split_translation"] = f"{MANIFESTS} SELECT record_id, doc_id, sent_pos, split FROM tms"
    q["split_tts"] = f"{MANIFESTS} SELECT record_id, doc_id, sent_pos, split FROM ams"
    q["split_counts"] = (
        f"{MANIFESTS}, names AS (SELECT * FROM (VALUES (0, 'train'), (1, 'valid'), (2, 'test')) v(split_ord, split)) "
        "SELECT 'translation' AS manifest, names.split_ord, names.split, CAST(count(tms.split) AS BIGINT) AS n "
        "FROM names LEFT JOIN tms ON names.split = tms.split GROUP BY ALL "
        "UNION ALL SELECT 'tts', names.split_ord, names.split, CAST(count(ams.split) AS BIGINT) "
        "FROM names LEFT JOIN ams ON names.split = ams.split GROUP BY ALL"
    )
    last = (
        f"lastrec AS (SELECT record_id, arg_max((doc_id, sent_pos), ({ORDER})) AS last_key, count(*) AS n_rows "
        "FROM ex GROUP BY record_id)"
    )
    q["split_lookup"] = (
        f"{BASE}, {last} SELECT record_id, last_key[1] AS last_doc_id, last_key[2] AS last_sent_pos, n_rows FROM lastrec"
    )
    q["split_records"] = (
        f"{BASE}, {last} SELECT {split_case(TKEY)} AS split, e.doc_id AS row_doc_id, e.sent_pos AS row_sent_pos, "
        "e.record_id, l.last_key[1] AS doc_id, l.last_key[2] AS sent_pos "
        "FROM ex e JOIN lastrec l ON e.record_id = l.record_id"
    )
    q["summary_totals"] = (
        f"{BASE} SELECT count(*) AS total_records, count_if(audio_file = '') AS missing_audio, "
        "count_if(translation_zh = '') AS missing_translation, "
        "round(coalesce(sum(coalesce(duration_seconds, CAST(0.0 AS DOUBLE))), 0.0), 2) AS total_duration_seconds FROM ex"
    )
    facets = (
        "facets AS (SELECT facet_ord, facet, key, count(*) AS n FROM ("
        "SELECT 0 AS facet_ord, 'by_group' AS facet, \"group\" AS key FROM ex "
        "UNION ALL SELECT 1, 'by_corpus', \"group\" || '/' || corpus_slug FROM ex "
        "UNION ALL SELECT 2, 'by_dialect', dialect FROM ex "
        "UNION ALL SELECT 3, 'by_audio_mode', audio_mode FROM ex) GROUP BY ALL)"
    )
    q["summary_facets"] = f"{BASE}, {facets} SELECT * FROM facets"
    q.update(more_sql())
    return q


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


FLOAT_GATE = (
    r"(?i)^[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+(_[0-9]+)*)?$"
    r"|^[+-]?(inf|infinity|nan)$"
)


def safe_float(x: str) -> str:
    z = strip(x)
    return (
        f"CASE WHEN regexp_matches({z}, '{FLOAT_GATE}') THEN "
        f"TRY_CAST(regexp_replace(replace({z}, '_', ''), '(?i)^[+-]nan$', 'nan') AS DOUBLE) END"
    )


def tok13a(x: str) -> str:
    y = x
    for old, new in (("<skipped>", ""), ("-' || chr(10) || '", ""), ("' || chr(10) || '", " ")):
        y = f"replace({y}, '{old}', '{new}')"
    for old, new in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        y = f"replace({y}, '{old}', '{new}')"
    y = f"(' ' || {y} || ' ')"
    y = rf"regexp_replace({y}, '([\{{-\~\[-\` -\&\(-\+\:-\@\/])', ' \1 ', 'g')"
    y = rf"regexp_replace({y}, '([^0-9])([\.,])', '\1 \2 ', 'g')"
    y = rf"regexp_replace({y}, '([\.,])([^0-9])', ' \1 \2', 'g')"
    y = rf"regexp_replace({y}, '([0-9])(-)', '\1 \2 ', 'g')"
    c = f"trim(regexp_replace({y}, '{WS}+', ' ', 'g'))"
    return f"CASE WHEN {c} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({c}, ' ') END"


def byte_ids(x: str, max_len: int = 256) -> str:
    h = f"hex(encode({x}))"
    return (
        f"list_transform(range(1, least(octet_length(encode({x})), {max_len - 1}) + 1), "
        f"lambda i: CAST(('0x' || substr({h}, 2 * i - 1, 2)) AS INTEGER) + 3) || [1]"
    )


def more_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    tot = (
        "tot AS (SELECT count(*) AS total_records, count_if(audio_file = '') AS missing_audio, "
        "count_if(translation_zh = '') AS missing_translation, "
        "round(coalesce(sum(coalesce(duration_seconds, CAST(0.0 AS DOUBLE))), 0.0), 2) AS total_duration_seconds FROM ex)"
    )
    facets = (
        "facets AS (SELECT facet_ord, facet, key, count(*) AS n FROM ("
        "SELECT 0 AS facet_ord, 'by_group' AS facet, \"group\" AS key FROM ex "
        "UNION ALL SELECT 1, 'by_corpus', \"group\" || '/' || corpus_slug FROM ex "
        "UNION ALL SELECT 2, 'by_dialect', dialect FROM ex "
        "UNION ALL SELECT 3, 'by_audio_mode', audio_mode FROM ex) GROUP BY ALL)"
    )
    sections = "sections AS (SELECT * FROM (VALUES (0, 'by_group'), (1, 'by_corpus'), (2, 'by_dialect'), (3, 'by_audio_mode')) v(sec, facet))"
    q["summary_markdown"] = f"""{BASE}, {tot}, {facets}, {sections},
lines AS (
  SELECT -1 AS sec, 0 AS pos, '# Puyuma Corpus Summary' AS line
  UNION ALL SELECT -1, 1, ''
  UNION ALL SELECT -1, 2, '- Total records: ' || CAST(total_records AS VARCHAR) FROM tot
  UNION ALL SELECT -1, 3, '- Missing audio: ' || CAST(missing_audio AS VARCHAR) FROM tot
  UNION ALL SELECT -1, 4, '- Missing translation: ' || CAST(missing_translation AS VARCHAR) FROM tot
  UNION ALL SELECT -1, 5, '- Total duration seconds: ' || regexp_replace(printf('%.2f', total_duration_seconds), '(\\.[0-9])0$', '\\1') FROM tot
  UNION ALL SELECT -1, 6, ''
  UNION ALL SELECT sec, 0, '## ' || facet FROM sections
  UNION ALL SELECT facet_ord, row_number() OVER (PARTITION BY facet_ord ORDER BY key) + 1, '- ' || key || ': ' || CAST(n AS VARCHAR) FROM facets
  UNION ALL SELECT sec, 2, '- none' FROM sections WHERE sec NOT IN (SELECT facet_ord FROM facets)
  UNION ALL SELECT s.sec, greatest(coalesce(c.k, 1), 1) + 2, '' FROM sections s
      LEFT JOIN (SELECT facet_ord, count(*) AS k FROM facets GROUP BY 1) c ON s.sec = c.facet_ord WHERE s.sec < 3)
SELECT row_number() OVER (ORDER BY sec, pos) AS line_no, line FROM lines"""
    ordk = "(source_ord, doc_id, sent_pos)"
    q["stats_manifest"] = (
        f"{MANIFESTS} SELECT count(*) AS total_records, count_if(audio_file IS NULL OR audio_file = '') AS missing_audio, "
        "count_if((translation_zh IS NULL OR translation_zh = '') AND (target_text IS NULL OR target_text = '')) AS missing_translation, "
        "round(coalesce(sum(duration_seconds), CAST(0.0 AS DOUBLE)), 6) AS total_duration_seconds FROM tm"
    )
    q["stats_manifest_facets"] = (
        f"{MANIFESTS}, st AS (SELECT {rt('\"group\"')} AS g, {rt('corpus_slug')} AS c, {rt('dialect')} AS d, '' AS m, {ordk} AS o FROM tm) "
        "SELECT facet_ord, facet, key, n, fo[1] AS first_source_ord, fo[2] AS first_doc_id, fo[3] AS first_sent_pos FROM ("
        "SELECT facet_ord, facet, key, count(*) AS n, min(o) AS fo FROM ("
        "SELECT 0 AS facet_ord, 'by_group' AS facet, g AS key, o FROM st "
        "UNION ALL SELECT 1, 'by_corpus', g || '/' || c, o FROM st "
        "UNION ALL SELECT 2, 'by_dialect', d, o FROM st "
        "UNION ALL SELECT 3, 'by_audio_mode', m, o FROM st) GROUP BY ALL)"
    )
    regp = (
        f"regp AS (SELECT source_ord, grp AS \"group\", corpus_slug, dialect, xml_relative_path, audio_repo, audio_mode, "
        "grp || '/' || corpus_slug || '/' || dialect AS source_key, "
        f"'{XML_BASE}' || xml_relative_path AS xml_url, "
        "regexp_extract(audio_repo, '^[^/]*/(.*)$', 1) AS audio_repo_slug, "
        f"'{HUB_BASE}' || audio_repo AS audio_base_url, "
        "regexp_replace(xml_relative_path, '/?[^/]*$', '') AS local_xml_relative_dir FROM reg)"
    )
    q["source_registry"] = f"{BASE}, {regp} SELECT * FROM regp"
    q["source_listing"] = (
        f"{BASE}, {regp} SELECT source_ord, source_key || chr(9) || xml_relative_path || chr(9) || audio_repo AS line FROM regp"
    )
    adir = (
        "'data/raw/audio/' || audio_repo_slug || CASE WHEN \"group\" = 'ePark' THEN '/Puyuma/' || dialect || '_Puyuma' ELSE '' END"
    )
    q["source_paths"] = (
        f"{BASE}, {regp} SELECT source_ord, source_key, xml_url, audio_base_url, audio_repo_slug, local_xml_relative_dir, "
        f"'data/raw/xml/' || xml_relative_path AS local_xml_path, {adir} AS local_audio_dir FROM regp"
    )
    aurl = (
        f"'{HUB_BASE}' || r.audio_repo || '/resolve/main/' || "
        "CASE WHEN e.\"group\" = 'ePark' THEN 'Puyuma/' || e.dialect || '_Puyuma/' ELSE '' END || "
        f"{url_quote('e.audio_file')}"
    )
    q["audio_url"] = (
        f"{BASE}, {regp} SELECT e.doc_id, e.sent_pos, {aurl} AS audio_url FROM ex e "
        "JOIN regp r ON e.source_key = r.source_key WHERE e.audio_file <> ''"
    )

    def resolve(t: str) -> str:
        g = f"split_part({t}.source_key, '/', 1)"
        c = f"split_part({t}.source_key, '/', 2)"
        slug = f"CASE WHEN {g} = 'ILRDF_Dicts' AND {c} = 'Puyuma' THEN 'ILRDF_Dict_Puyuma' ELSE 'ePark_' || {c} END"
        return (
            f"'data/raw/audio/' || {slug} || CASE WHEN {g} = 'ePark' THEN '/Puyuma/' || {t}.dialect || '_Puyuma' ELSE '' END "
            f"|| '/' || {t}.audio_file"
        )

    q["audio_path_resolve"] = (
        f"{MANIFESTS} SELECT doc_id, sent_pos, {resolve('am')} AS audio_path, CAST(NULL AS VARCHAR) AS problem FROM am"
    )
    inv = (
        f"inv AS (SELECT DISTINCT {resolve('ex')} AS path FROM ex WHERE audio_file <> ''), "
        f"present AS (SELECT path FROM inv WHERE {bucket('path')} < CAST(0.8 AS DOUBLE))"
    )
    q["audio_missing"] = (
        f"{MANIFESTS}, {inv} SELECT doc_id, sent_pos, {resolve('am')} AS audio_path, "
        f"'Missing audio file: ' || {resolve('am')} AS problem FROM am WHERE {resolve('am')} NOT IN (SELECT path FROM present)"
    )
    q["audio_materialize"] = (
        f"{MANIFESTS}, {inv}, refs AS (SELECT DISTINCT audio_file, {resolve('am')} AS audio_path FROM am) "
        "SELECT audio_file, audio_path, CAST(octet_length(encode('RIFF:' || audio_path)) AS BIGINT) AS n_bytes, "
        "sha256('RIFF:' || audio_path) AS content_sha256 FROM refs WHERE audio_path IN (SELECT path FROM present)"
    )
    q["audio_files"] = f"SELECT audio_file, n_bytes, content_sha256 FROM ({q['audio_materialize']})"
    want = (
        f"{regp}, want AS (SELECT DISTINCT * FROM ("
        "SELECT 'xml' AS kind, xml_url AS url, 'data/raw/xml/' || xml_relative_path AS dest FROM regp "
        f"UNION ALL SELECT 'audio', '{HUB_BASE}' || r.audio_repo || '/resolve/main/' || "
        "CASE WHEN r.\"group\" = 'ePark' THEN 'Puyuma/' || r.dialect || '_Puyuma/' ELSE '' END || "
        f"{url_quote('e.audio_file')}, "
        "'data/raw/audio/' || r.audio_repo_slug || CASE WHEN r.\"group\" = 'ePark' THEN '/Puyuma/' || r.dialect || '_Puyuma' ELSE '' END "
        "|| '/' || e.audio_file FROM (SELECT DISTINCT source_key, audio_file FROM ex WHERE audio_file <> '') e "
        "JOIN regp r ON e.source_key = r.source_key))"
    )
    q["download_plan"] = (
        f"{BASE}, {want} SELECT kind, url, dest FROM want "
        f"WHERE NOT ({bucket('dest')} < CAST(0.5 AS DOUBLE) AND {bucket('dest')} >= CAST(0.1 AS DOUBLE))"
    )
    q["ljspeech_metadata"] = (
        f"{MANIFESTS} SELECT audio_file, {rt('text')} AS text, {rt('normalized_text')} AS normalized_text, {ORDER} FROM am "
        f"WHERE coalesce(audio_file, '') <> '' QUALIFY row_number() OVER (PARTITION BY audio_file ORDER BY {ORDER}) = 1"
    )
    q["ljspeech_counts"] = (
        f"{MANIFESTS} SELECT (SELECT count(*) FROM am) AS input_rows, "
        "(SELECT count(DISTINCT audio_file) FROM am WHERE coalesce(audio_file, '') <> '') AS materialized_rows"
    )
    xcols = (
        "doc_id, sent_pos, sentence_id, language_code, root_source_label, citation, copyright, bibtex_citation, "
        "root_glottocode, original_form, standard_form, original_phonetic, standard_phonetic, translation_zh"
    )
    q["xml_extract"] = f"{BASE} SELECT {xcols} FROM ex"
    q["xml_corpus_load"] = f"{BASE} SELECT * FROM ex"
    q["xml_child_pick"] = (
        f"{BASE} SELECT doc_id, sent_pos, original_form, standard_form, original_phonetic, standard_phonetic, translation_zh FROM ex"
    )
    q["xml_audio_pick"] = f"{BASE} SELECT doc_id, sent_pos, audio_file, audio_url, audio_start, audio_end FROM ex"
    q["jsonl_roundtrip"] = f"{MANIFESTS} SELECT * FROM tm"
    q["jsonl_scan"] = f"{MANIFESTS} SELECT * FROM am"
    q["csv_roundtrip"] = f"{MANIFESTS} SELECT * FROM tm"
    q["xml_split_scan"] = (
        f"{BASE} SELECT sentence_id, original_form, standard_form, original_phonetic, standard_phonetic, translation_zh, audio_file, "
        "audio_start, audio_end, root_glottocode, 'mul' AS language_code FROM ex"
    )
    q["line_places"] = f"{MANIFESTS} SELECT record_id, doc_id, sent_pos, row_number() OVER (ORDER BY {ORDER}) - 1 AS line_no FROM tm"
    q["split_sink"] = f"{MANIFESTS} SELECT record_id, doc_id, sent_pos, split FROM tms"
    empty = ("audio_mode", "root_source_label", "root_glottocode", "sentence_id", "original_form", "standard_form",
             "original_phonetic", "standard_phonetic")
    q["record_coerce"] = (
        f"{MANIFESTS} SELECT record_id, source_key, \"group\", corpus_slug, dialect, language_code, "
        + "'' AS audio_mode, xml_source_url, xml_path, citation, copyright, bibtex_citation, "
        + ", ".join(f"'' AS {c}" for c in empty[1:])
        + ", translation_zh, audio_file, audio_url, audio_start, audio_end, "
        "coalesce(nullif('', ''), '') AS source_text, '' AS source_phonetic, translation_zh AS target_text, "
        f"duration_seconds, {ORDER} FROM tm"
    )
    variants = (
        "[CAST(sent_pos AS VARCHAR) || '_' || CAST(doc_id AS VARCHAR), "
        "chr(160) || CAST(k % 10 AS VARCHAR) || '.' || CAST(sent_pos AS VARCHAR) || 'e' || CAST(k % 5 AS VARCHAR) || ' ', "
        "CASE k % 4 WHEN 0 THEN '-nan' WHEN 1 THEN '+Infinity' WHEN 2 THEN '1d' ELSE '.5' END, form_raw, "
        "CASE WHEN k % 2 = 0 THEN '1__0' ELSE '0x1p3' END, "
        "CASE WHEN k % 3 = 0 THEN '' ELSE chr(12288) || CAST(doc_id AS VARCHAR) || '.' END]"
    )
    q["safe_float"] = (
        f"{BASE}, v AS (SELECT doc_id, sent_pos, unnest(range(0, 6)) AS variant, {variants} AS vs FROM raw), "
        f"p AS (SELECT doc_id, sent_pos, variant, {safe_float('vs[variant + 1]')} AS v FROM v) "
        "SELECT doc_id, sent_pos, variant, CASE WHEN isnan(v) THEN NULL ELSE v END AS value, coalesce(isnan(v), false) AS is_nan FROM p"
    )
    q["tokenize_pairs"] = (
        f"{MANIFESTS} SELECT doc_id, sent_pos, {byte_ids('source_text')} AS input_ids, {byte_ids('target_text')} AS labels FROM tm"
    )
    nchars = (
        "len(list_filter(range(1, least(length(target_text), 255) + 1), lambda i: strlen(left(target_text, i)) <= 255))"
    )
    q["label_restore"] = (
        f"{MANIFESTS} SELECT doc_id, sent_pos, CAST(256 - least(octet_length(encode(target_text)), 255) - 1 AS BIGINT) AS n_masked, "
        f"left(target_text, {nchars}) AS text FROM tm"
    )
    pred = "replace(replace(replace(target_text, ' de ', ' '), ' the ', ' '), ' le ', ' ')"
    pairs = f"pairs AS (SELECT (doc_id, sent_pos) AS pid, {pred} AS prediction, target_text AS reference FROM tm)"
    q["gen_len"] = (
        f"{MANIFESTS}, {pairs} SELECT round(coalesce(avg(CASE WHEN trim(regexp_replace({strip('prediction')}, '{WS}+', ' ', 'g')) = '' THEN 0 "
        f"ELSE len(string_split(trim(regexp_replace({strip('prediction')}, '{WS}+', ' ', 'g')), ' ')) END), 0.0), 4) AS gen_len FROM pairs"
    )
    q["corpus_bleu"] = f"""{MANIFESTS}, {pairs},
tok AS (SELECT pid, {tok13a(strip('prediction'))} AS h, {tok13a(strip('reference'))} AS r FROM pairs),
ng AS (SELECT pid, n, side, unnest(list_transform(range(1, len(toks) - n + 2), lambda i: array_to_string(toks[i:i + n - 1], ' '))) AS gram
       FROM (SELECT pid, 0 AS side, h AS toks FROM tok UNION ALL SELECT pid, 1, r FROM tok) x, (SELECT unnest(range(1, 5)) AS n) nn),
cnt AS (SELECT n, sum(least(hc, rc)) AS correct FROM (
          SELECT pid, n, gram, count_if(side = 0) AS hc, count_if(side = 1) AS rc FROM ng GROUP BY ALL) GROUP BY n),
st AS (SELECT sum(len(h)) AS sys_len, sum(len(r)) AS ref_len,
          sum(greatest(len(h), 0)) AS total_1, sum(greatest(len(h) - 1, 0)) AS total_2,
          sum(greatest(len(h) - 2, 0)) AS total_3, sum(greatest(len(h) - 3, 0)) AS total_4 FROM tok),
c AS (SELECT coalesce(sum(correct) FILTER (n = 1), 0) AS correct_1, coalesce(sum(correct) FILTER (n = 2), 0) AS correct_2,
             coalesce(sum(correct) FILTER (n = 3), 0) AS correct_3, coalesce(sum(correct) FILTER (n = 4), 0) AS correct_4 FROM cnt),
s AS (SELECT CAST(sys_len AS BIGINT) AS sys_len, CAST(ref_len AS BIGINT) AS ref_len,
             CAST(correct_1 AS BIGINT) AS correct_1, CAST(correct_2 AS BIGINT) AS correct_2,
             CAST(correct_3 AS BIGINT) AS correct_3, CAST(correct_4 AS BIGINT) AS correct_4,
             CAST(total_1 AS BIGINT) AS total_1, CAST(total_2 AS BIGINT) AS total_2,
             CAST(total_3 AS BIGINT) AS total_3, CAST(total_4 AS BIGINT) AS total_4 FROM st, c),
sm AS (SELECT *,
         CASE WHEN correct_1 = 0 AND total_1 > 0 THEN 2.0 ELSE 1.0 END::DOUBLE AS s1 FROM s),
sm2 AS (SELECT *, (s1 * CASE WHEN correct_2 = 0 AND total_2 > 0 THEN 2.0 ELSE 1.0 END)::DOUBLE AS s2 FROM sm),
sm3 AS (SELECT *, (s2 * CASE WHEN correct_3 = 0 AND total_3 > 0 THEN 2.0 ELSE 1.0 END)::DOUBLE AS s3 FROM sm2),
sm4 AS (SELECT *, (s3 * CASE WHEN correct_4 = 0 AND total_4 > 0 THEN 2.0 ELSE 1.0 END)::DOUBLE AS s4 FROM sm3),
p AS (SELECT *,
   CASE WHEN total_1 = 0 THEN 0.0::DOUBLE WHEN correct_1 = 0 THEN 100.0::DOUBLE / (s1 * total_1) ELSE 100.0::DOUBLE * correct_1 / total_1 END AS precision_1,
   CASE WHEN total_2 = 0 THEN 0.0::DOUBLE WHEN correct_2 = 0 THEN 100.0::DOUBLE / (s2 * total_2) ELSE 100.0::DOUBLE * correct_2 / total_2 END AS precision_2,
   CASE WHEN total_3 = 0 THEN 0.0::DOUBLE WHEN correct_3 = 0 THEN 100.0::DOUBLE / (s3 * total_3) ELSE 100.0::DOUBLE * correct_3 / total_3 END AS precision_3,
   CASE WHEN total_4 = 0 THEN 0.0::DOUBLE WHEN correct_4 = 0 THEN 100.0::DOUBLE / (s4 * total_4) ELSE 100.0::DOUBLE * correct_4 / total_4 END AS precision_4,
   CASE WHEN sys_len >= ref_len THEN 1.0::DOUBLE WHEN sys_len > 0 THEN exp(1.0::DOUBLE - ref_len::DOUBLE / sys_len::DOUBLE) ELSE 0.0::DOUBLE END AS bp0
   FROM sm4)
SELECT round(bp0 * exp((
   CASE WHEN precision_1 = 0 THEN -9999999999.0::DOUBLE ELSE ln(precision_1) END +
   CASE WHEN precision_2 = 0 THEN -9999999999.0::DOUBLE ELSE ln(precision_2) END +
   CASE WHEN precision_3 = 0 THEN -9999999999.0::DOUBLE ELSE ln(precision_3) END +
   CASE WHEN precision_4 = 0 THEN -9999999999.0::DOUBLE ELSE ln(precision_4) END) / 4.0::DOUBLE), 4) AS score,
   round(bp0, 4) AS bp, sys_len, ref_len, correct_1, correct_2, correct_3, correct_4, total_1, total_2, total_3, total_4,
   precision_1, precision_2, precision_3, precision_4 FROM p"""
    q["job_split"] = (
        f"{MANIFESTS}, names AS (SELECT * FROM (VALUES (0, 'train'), (1, 'valid'), (2, 'test')) v(split_ord, split)) "
        "SELECT names.split_ord, names.split, CAST(count(tms.split) AS BIGINT) AS n FROM names LEFT JOIN tms ON names.split = tms.split GROUP BY ALL"
    )
    q["job_stats"] = (
        f"{MANIFESTS}, st AS (SELECT {rt('\"group\"')} AS g, {rt('corpus_slug')} AS c, {rt('dialect')} AS d FROM tm) "
        "SELECT -1 AS facet_ord, 'missing_audio' AS facet, '' AS key, count_if(coalesce(audio_file, '') = '') AS n FROM tm "
        "UNION ALL SELECT 0, 'by_group', g, count(*) FROM st GROUP BY ALL "
        "UNION ALL SELECT 1, 'by_corpus', g || '/' || c, count(*) FROM st GROUP BY ALL "
        "UNION ALL SELECT 2, 'by_dialect', d, count(*) FROM st GROUP BY ALL "
        "UNION ALL SELECT 3, 'by_audio_mode', '', count(*) FROM st GROUP BY ALL"
    )
    q["audio_inventory"] = (
        f"{MANIFESTS} SELECT split, CAST(sum(octet_length(encode(record_id)) + 1) AS BIGINT) AS n_bytes FROM tms GROUP BY split"
    )
    q["training_pairs"] = (
        f"{MANIFESTS} SELECT split, record_id, doc_id, sent_pos, source_text, target_text FROM tms WHERE split IN ('train', 'valid')"
    )
    return q
