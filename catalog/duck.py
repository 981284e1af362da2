"""DuckDB spellings used by the SQL checks."""

from __future__ import annotations

import re

from upswell import config as C

NOW = "DATE '2001-08-01'"


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


SPACE = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"


def squash(e: str) -> str:
    return f"trim(regexp_replace({e}, '{SPACE}+', ' ', 'g'))"


def whole_words(patterns) -> str:
    return f"(?:^|{NOT_WORD})(?:{'|'.join(patterns)})(?:{NOT_WORD}|$)"


def has_phrase(e: str, phrases) -> str:
    return f"regexp_matches({e}, {text(whole_words(re.escape(p) for p in phrases))})"


def has_pattern(e: str, patterns) -> str:
    return f"regexp_matches({e}, {text(whole_words(patterns))})"


def contains_any(e: str, terms) -> str:
    return "(" + " OR ".join(f"contains({e}, {text(t)})" for t in terms) + ")"


def normalize_name(e: str) -> str:
    """Word-by-word form of the name rule: names are split at what is not a letter,
    digit or underscore, suffix words dropped, the rest joined."""
    words = "|".join(C.NAME_SUFFIXES)
    spaced = f"regexp_replace(lower(coalesce({e}, '')), '[,.]', ' ', 'g')"
    tokens = f"regexp_extract_all({spaced}, '{WORD}+|{NOT_WORD}+')"
    kept = f"list_transform({tokens}, lambda w: CASE WHEN regexp_full_match(w, '{words}') THEN ' ' ELSE w END)"
    return f"trim(regexp_replace(array_to_string({kept}, ''), '[^a-z0-9]+', ' ', 'g'))"


def host(e: str) -> str:
    v = f"lower(trim({e}))"
    full = f"CASE WHEN contains({v}, '://') THEN {v} ELSE 'https://' || {v} END"
    return f"nullif(regexp_extract({full}, '^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?([^:/?#]*)', 1), '')"


def registrable(h: str) -> str:
    parts = f"string_split({h}, '.')"
    last = lambda k: f"array_to_string({parts}[-{k}:], '.')"
    return (
        f"CASE WHEN len({parts}) <= 2 THEN {h} WHEN {last(2)} IN ({quoted(C.TWO_PART_SUFFIXES)}) THEN {last(3)} ELSE {last(2)} END"
    )


def registrable_domain(e: str) -> str:
    return f"(CASE WHEN {host(e)} IS NULL THEN NULL ELSE {registrable(host(e))} END)"


def denylisted(e: str, names=None) -> str:
    listed = sorted(set(names)) if names is not None else sorted({d for ds in C.DENYLIST.values() for d in ds})
    return f"coalesce(regexp_matches({e}, {text('(?:^|[.])(?:' + '|'.join(re.escape(d) for d in listed) + ')$')}), false)"


def canonical_url(e: str) -> str:
    v = f"regexp_replace(coalesce({e}, ''), '^{SPACE}+|{SPACE}+$', '', 'g')"
    rx = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
    part = lambda i: f"regexp_extract({v}, '{rx}', {i})"
    dec = lambda x: f"url_decode(replace({x}, '+', ' '))"
    enc = lambda x: f"replace(url_encode({x}), '%20', '+')"
    pairs = f"list_filter(string_split({part(4)}, '&'), lambda p: regexp_matches(p, '^[^=]*=.'))"
    rows = (
        f"list_transform({pairs}, lambda p: {{'k': {dec('regexp_extract(p, chr(94) || chr(40) || chr(91) || chr(94) || chr(61) || chr(93) || chr(42) || chr(41) || chr(61), 1)')}, "
        f"'v': {dec('substr(p, strpos(p, chr(61)) + 1)')}}})"
    )
    kept = f"list_filter({rows}, lambda p: NOT lower(p.k) IN ({quoted(C.TRACKING_QUERY_KEYS)}))"
    query = f"array_to_string(list_transform(list_sort({kept}), lambda p: {enc('p.k')} || '=' || {enc('p.v')}), '&')"
    return (
        f"CASE WHEN coalesce({e}, '') = '' THEN '' ELSE "
        f"CASE WHEN {part(1)} <> '' THEN lower({part(1)}) || ':' ELSE '' END || CASE WHEN {part(2)} <> '' THEN '//' || lower({part(2)}) ELSE '' END"
        f" || coalesce(nullif(regexp_replace({part(3)}, '/+$', ''), ''), '/') || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END"
    )


def tokens(e: str) -> str:
    return f"list_distinct(regexp_extract_all(lower(coalesce({e}, '')), '[a-z0-9]+'))"


def overlap(a: str, b: str) -> str:
    return f"CASE WHEN len({tokens(a)}) = 0 THEN 0.0 ELSE len(list_intersect({tokens(a)}, {tokens(b)}))::DOUBLE / len({tokens(a)}) END"


def blank_tokens(e: str) -> str:
    return f"list_distinct(list_filter(string_split({squash('lower(coalesce(' + e + chr(44) + chr(39)*2 + '))')}, ' '), lambda w: w <> ''))"


def jaccard(a: str, b: str) -> str:
    ta, tb = blank_tokens(a), blank_tokens(b)
    return (
        f"CASE WHEN len({ta}) = 0 OR len({tb}) = 0 THEN 0.0 ELSE len(list_intersect({ta}, {tb}))::DOUBLE"
        f" / len(list_distinct(list_concat({ta}, {tb}))) END"
    )


def fingerprint(title: str, body: str) -> str:
    return f"sha256({squash(f'''lower(coalesce({title}, '') || ' ' || coalesce({body}, ''))''')})"


def populated(e: str) -> str:
    return f"({e} IS NOT NULL AND lower(trim(cast({e} AS string))) NOT IN ({quoted(C.UNKNOWN_WORDS)}))"


def clamp(e: str) -> str:
    return f"cast(greatest(0, least(100, round_even({e}, 0))) AS int)"


def case_map(e: str, pairs, default: str) -> str:
    return f"CASE {e} " + " ".join(f"WHEN {text(k)} THEN {v}" for k, v in pairs) + f" ELSE {default} END"


def event_base(e: str = "event_type") -> str:
    return case_map(e, [(t, b) for t, b, _ in C.EVENT_VALUES], "0")


def decayed(component: str) -> str:
    types = quoted(t for t, _, c in C.EVENT_VALUES if c == component)
    age = f"greatest(0, coalesce(date_diff('day', published_at::DATE, {NOW}), 9999))"
    return clamp(
        f"coalesce(sum(CASE WHEN verification_status = 'completed' AND event_type IN ({types}) THEN {event_base()} * exp(-{age} / 45.0) END), 0.0)"
    )


def strip_tags(e: str) -> str:
    a = f"regexp_replace(coalesce({e}, ''), '(?is)<script.*?</script>', ' ', 'g')"
    b = f"regexp_replace({a}, '(?is)<style.*?</style>', ' ', 'g')"
    return squash(f"regexp_replace({b}, '<[^>]+>', ' ', 'g')")


def statement_class(e: str) -> str:
    low = f"lower(coalesce({e}, ''))"
    return "CASE " + " ".join(f"WHEN {has_phrase(low, ms)} THEN '{n}'" for n, ms in C.STATEMENT_MARKERS) + " ELSE 'ambiguous' END"


def stage(e: str) -> str:
    s = f"replace(replace(lower(trim(coalesce({e}, ''))), 'pre seed', 'pre-seed'), 'preseed', 'pre-seed')"
    return (
        f"CASE WHEN contains({s}, 'pre-seed') THEN 'pre-seed' WHEN contains({s}, 'seed') THEN 'seed' WHEN contains({s}, 'series a') THEN 'series a'"
        f" WHEN contains({s}, 'series b') THEN 'series b' WHEN regexp_matches({s}, 'series [cdefg]') THEN 'series c'"
        f" WHEN regexp_matches({s}, 'growth|late[ -]stage') THEN 'growth' ELSE 'unknown' END"
    )


AMOUNT = (
    r"(?i)([$€£₹¥])?\s*(" + "|".join(C.RATES_PER_USD) + r"|Rs\.?)?\s*(\d[\d,]*(?:\.\d+)?)\s*"
    r"(thousand|million|mn|billion|bn|crore|cr|lakh|lac|k|m|b)?\b(?:\s*(" + "|".join(C.RATES_PER_USD) + "))?"
)


def amount(e: str) -> str:
    unit = f"lower(regexp_extract({e}, '{AMOUNT}', 4))"
    return (
        f"try_cast(replace(regexp_extract({e}, '{AMOUNT}', 3), ',', '') AS DOUBLE) * "
        + case_map(unit, [(k, repr(float(v))) for k, v in C.AMOUNT_UNITS.items()], "1.0") + "::DOUBLE"
    )


def currency(e: str) -> str:
    g = lambda i: f"nullif(regexp_extract({e}, '{AMOUNT}', {i}), '')"
    code = f"upper(coalesce({g(2)}, {g(5)}))"
    return (
        f"coalesce(CASE WHEN {code} IN ('RS', 'RS.') THEN 'INR' ELSE {code} END, "
        + case_map(g(1), [(k, text(v)) for k, v in C.CURRENCY_SYMBOLS.items()], "NULL") + ")"
    )


def rate(e: str) -> str:
    return case_map(e, [(k, repr(float(v)) + "::DOUBLE") for k, v in C.RATES_PER_USD.items()], "NULL")
