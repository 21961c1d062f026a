"""SQL fragments (DuckDB) that state what the column expressions compute, for checking."""

from __future__ import annotations

_BLANK = r"[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def collapse(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{_BLANK}', ' ', 'g'))"


def fold(x: str) -> str:
    return f"regexp_replace(lower({collapse(x)}), '\\.+$', '')"


def minute(t: str) -> str:
    return rf"CASE WHEN regexp_full_match({t}, '\d{{1,2}}/\d{{1,2}}/(\d{{4}}|\d{{2}}) \d{{1,2}}:\d{{1,2}}') THEN coalesce(try_strptime({t}, '%m/%d/%y %H:%M'), try_strptime({t}, '%m/%d/%Y %H:%M')) END"


def day(t: str) -> str:
    return rf"CASE WHEN regexp_full_match({t}, '\d{{1,2}}/\d{{1,2}}/(\d{{4}}|\d{{2}})') THEN coalesce(try_strptime({t}, '%m/%d/%y'), try_strptime({t}, '%m/%d/%Y')) END"


def canonical(t: str) -> str:
    """Of collapsed text."""
    return f"coalesce(strftime({minute(t)}, '%Y-%m-%dT%H:%M'), strftime({day(t)}, '%Y-%m-%d'), {t})"


def reported(x: str) -> str:
    return canonical(collapse(x))


def occurred(x: str) -> str:
    t = collapse(x)
    bare = f"regexp_replace({t}, '(?i)^since\\s+', '')"
    part = "trim(regexp_replace(p, '(?i)\\s*\\b(?:unk\\.?|unknown)\\s*$', ''))"
    return f"CASE WHEN regexp_matches({t}, '(?i)^since\\b') THEN 'since ' ELSE '' END || array_to_string([{canonical(part)} for p in string_split_regex({bare}, '(?i)\\s+to\\s+')], ' to ')"


def uid(case: str, rep: str) -> str:
    return f"substr(sha1(upper({collapse(case)}) || chr(31) || {reported(rep)}), 1, 16)"


def refs(x: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all(coalesce({x}, ''), '\\b(?:\\d{{2}}-\\d{{5,7}}|\\d{{4,6}})\\b')))"


def inline(old: str, new: str) -> str:
    marker = r"(?is)^(.*?)\b(?:nature|disposition)\s+updated\b"
    before = f"regexp_extract(coalesce({new}, ''), '{marker}', 1)"
    return f"(regexp_matches(coalesce({new}, ''), '{marker}') AND trim(trim(trim({before}, ' '), ',;'), ' ') = trim(coalesce({old}, ''), ' '))"


ARCHIVE = """arch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY incident_uid ORDER BY revision DESC NULLS LAST, row_id DESC) AS nth FROM incidents) WHERE nth = 1)"""


def partial(x: str, name: str) -> str:
    """Columns name_value, name_precision, name_ongoing of a partial date, as a chain over columns made in DERIVED."""
    t = f"{name}_start"
    return f"""CASE WHEN {name}_minute IS NOT NULL THEN strftime({name}_minute, '%Y-%m-%dT%H:%M:%S') WHEN {name}_day IS NOT NULL THEN strftime({name}_day, '%Y-%m-%d')
      WHEN regexp_full_match({t}, '\\d{{1,2}}/\\d{{4}}') THEN split_part({t}, '/', 2) || '-' || lpad(split_part({t}, '/', 1), 2, '0') WHEN regexp_full_match({t}, '\\d{{4}}') THEN {t} END AS {name}_value,
    CASE WHEN {name}_minute IS NOT NULL THEN CASE WHEN {name}_ongoing THEN 'range_start' ELSE 'minute' END WHEN {name}_day IS NOT NULL THEN CASE WHEN {name}_ongoing THEN 'range_start' ELSE 'day' END
      WHEN regexp_full_match({t}, '\\d{{1,2}}/\\d{{4}}') THEN 'month' WHEN regexp_full_match({t}, '\\d{{4}}') THEN 'year' WHEN regexp_matches({t}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{2,4}}') THEN 'invalid' ELSE 'unknown' END AS {name}_precision"""


def _starts(x: str, name: str) -> str:
    bare = f"trim(regexp_replace({collapse(x)}, '(?i)^since\\s+', ''))"
    first = f"CASE WHEN regexp_matches({bare}, '(?i)\\s+to\\s+') THEN trim(regexp_extract({bare}, '(?i)^(.*?)\\s+to\\s+', 1)) ELSE {bare} END"
    return f"""trim(regexp_replace({first}, '(?i)\\s*\\b(?:unk\\.?|unknown)\\s*$', '')) AS {name}_start,
    (regexp_matches({collapse(x)}, '(?i)^since\\b') OR regexp_matches({bare}, '(?i)\\s+to\\s+')) AS {name}_ongoing"""


def _tokens(x: str) -> str:
    return f"[t for t in string_split_regex(trim(coalesce({x}, ''), ' '), '\\s*;\\s*') if t <> '']"


def _marker(known: str, m: str) -> str:
    return f"coalesce(list_max(list_transform({known}, lambda t, i: CASE WHEN {m}[t].role = 'audit_marker' THEN i ELSE 0 END)), 0)"


SCHOOL_YEAR = "(CAST({k}[1:4] AS INT) - CASE WHEN CAST({k}[6:7] AS INT) < 8 THEN 1 ELSE 0 END)"


def school_year(k: str) -> str:
    y = SCHOOL_YEAR.format(k=k)
    return f"{y} || '-' || lpad(CAST(({y} + 1) % 100 AS VARCHAR), 2, '0')"


DERIVED = f"""{ARCHIVE},
cm AS (SELECT map_from_entries(list(({fold('raw_token')}, {{'role': token_role, 'v': [f for f in string_split(coalesce(categories, ''), '|') if f <> '']}}))) AS cm FROM category_map),
dm AS (SELECT map_from_entries(list(({fold('raw_token')}, {{'role': token_role, 'v': [f for f in string_split(coalesce(flags, ''), '|') if f <> '']}}))) AS dm FROM disposition_map),
pm AS (SELECT map_from_entries(list(({fold('raw_value')}, campus))) AS pm FROM campus_map),
s1 AS (SELECT *, {_starts('date_reported_raw', 'rep')}, {_starts('date_occurred_raw', 'occ')},
    [{{'raw': t, 'f': {fold('t')}}} for t in {_tokens('nature_raw')}] AS ntok, [f for f in [{fold('t')} for t in {_tokens('disposition_raw')}] if f <> ''] AS dtok FROM arch),
s2 AS (SELECT s1.*, cm, dm, pm, {minute('rep_start')} AS rep_minute, {day('rep_start')} AS rep_day, {minute('occ_start')} AS occ_minute, {day('occ_start')} AS occ_day,
    [t for t in ntok if cm[t.f] IS NOT NULL] AS nk, [t for t in dtok if dm[t] IS NOT NULL] AS dk FROM s1, cm, dm, pm),
s3 AS (SELECT *, {partial('date_reported_raw', 'rep')}, {partial('date_occurred_raw', 'occ')},
    coalesce(list_max(list_transform(nk, lambda t, i: CASE WHEN cm[t.f].role = 'audit_marker' THEN i ELSE 0 END)), 0) AS nat,
    coalesce(list_max(list_transform(dk, lambda t, i: CASE WHEN dm[t].role = 'audit_marker' THEN i ELSE 0 END)), 0) AS dat,
    CASE WHEN regexp_full_match(trim(source_month, ' '), '\\d{{4}}-(0[1-9]|1[0-2])') THEN trim(source_month, ' ')
      WHEN regexp_full_match(trim(source_month, ' '), '[A-Z][a-z]+ \\d{{4}}') THEN strftime(try_strptime('1 ' || trim(source_month, ' '), '%d %B %Y'), '%Y-%m') END AS month_key FROM s2),
s4 AS (SELECT *, CASE WHEN nat = 0 THEN nk ELSE nk[nat:] END AS ncur, CASE WHEN nat > 1 THEN nk[1:nat - 1] ELSE [] END AS nsup,
    CASE WHEN dat = 0 THEN dk ELSE dk[dat:] END AS dcur, CASE WHEN dat > 1 THEN dk[1:dat - 1] ELSE [] END AS dsup,
    CASE WHEN regexp_matches(occ_value, '^\\d{{4}}-\\d{{2}}') THEN occ_value[1:7] END AS ok FROM s3),
der AS (SELECT incident_uid AS uid, status, coalesce(revision, 1) AS revision, source_era AS era, source_month AS month, month_key, {school_year('month_key')} AS school_year,
    rep_value, rep_precision, occ_value, occ_precision, occ_ongoing, trim(coalesce(date_occurred_raw, ''), ' ') AS occ_raw, trim(coalesce(date_reported_raw, ''), ' ') AS rep_raw,
    CASE WHEN ok >= '2026-06' THEN ok END AS occ_key, CASE WHEN ok IS NULL THEN 'no_date' WHEN ok < '2026-06' THEN 'before_window' END AS occ_reason,
    CASE WHEN ok >= '2026-06' THEN {school_year('ok')} END AS occ_year,
    CASE WHEN rep_precision = 'minute' AND occ_precision = 'minute' THEN round((epoch(rep_minute) - epoch(occ_minute)) / 3600.0, 2) END AS lag,
    flatten([cm[t.f].v for t in ncur if cm[t.f].role IN ('offense', 'audit_marker')]) AS cats, flatten([cm[t.f].v for t in nsup if cm[t.f].role IN ('offense', 'audit_marker')]) AS supcats, len(nsup) AS n_sup,
    [t.raw for t in ncur if cm[t.f].role = 'object'] AS objects, [t.raw for t in ncur if cm[t.f].role = 'activity'] AS activity, [t.raw for t in ncur if cm[t.f].role = 'channel'] AS channels,
    [t.raw for t in ntok if cm[t.f] IS NULL] AS unclassified, [t for t in dtok if dm[t] IS NULL] AS unclassified_d,
    flatten([dm[t].v for t in dcur]) AS dflags, flatten([dm[t].v for t in dsup]) AS dsupflags, len(dsup) AS n_dsup,
    [a for a in ['NUPD', 'HTPD', 'MCSO', 'CSA', 'GEN'] if regexp_matches(coalesce(case_number_raw, ''), '(?i)\\b' || a || '\\b')] AS agencies,
    coalesce(pm[{fold('campus_raw')}], nullif(trim(coalesce(campus_raw, ''), ' '), ''), 'Unknown') AS campus, location_raw AS location,
    [f for f in string_split(coalesce(flags, ''), ';') if f <> ''] AS flags, case_number_raw, narrative_raw, nature_raw, disposition_raw FROM s4),
counted AS (SELECT * FROM der WHERE status <> 'superseded')"""
