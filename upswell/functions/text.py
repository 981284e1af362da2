"""Text expressions: names, tokens, overlap, fingerprints, markup."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from upswell import config as C

# White space of any alphabet. The first form is one quick test per character and
# needs a regex of its own; the second can stand inside a larger pattern.
SPACES = r"(?U)[\s\x1C-\x1F]+"
SPACE = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
SPACE_CHARS = (
    " \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"[\p{L}\p{N}_]"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """White space of any kind off both ends."""
    return F.trim(c, F.lit(SPACE_CHARS))


def once(value: Column, test: Callable[[Column], Column]) -> Column:
    """A test that reads ``value`` many times, with the value computed one time.

    Filters evaluate each mention of an expression anew; bound as an array element,
    a lower-cased text is made once per row.
    """
    return F.exists(F.array(value), test)


def squash(c: Column) -> Column:
    """Runs of white space become one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def null_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` with NULL for no match or an empty group."""
    return null_if_blank(F.regexp_extract(c, pattern, group))


def whole_words(patterns: Iterable[str]) -> str:
    """One alternation that must start and end at a word edge, for any alphabet."""
    return f"(?<!{WORD})(?:{'|'.join(patterns)})(?!{WORD})"


def _stem(pattern: str) -> str:
    """The literal text a pattern must begin with."""
    return re.match(r"(?:[a-z0-9&' .-](?![?*+]))+", pattern).group(0)


def any_of(lowered: Column, terms: Iterable[str]) -> Column:
    """Plain substring tests; byte search is far cheaper than one big alternation."""
    return reduce(lambda a, b: a | b, [lowered.contains(t) for t in terms])


def has_pattern(lowered: Column, patterns: Iterable[str]) -> Column:
    """Whole-word match of any pattern. The regex runs only on texts that hold the
    literal beginning of one of them."""
    listed = list(patterns)
    stems = dict.fromkeys(_stem(p) for p in listed)
    return any_of(lowered, stems) & lowered.rlike(whole_words(listed))


def has_phrase(lowered: Column, phrases: Iterable[str]) -> Column:
    listed = list(phrases)
    return any_of(lowered, listed) & lowered.rlike(whole_words(re.escape(p) for p in listed))


def contains_any(lowered: Column, terms: Iterable[str]) -> Column:
    """Substring test against a short list."""
    return once(lowered, lambda x: any_of(x, terms))


def normalize_name(c: Column) -> Column:
    """Lower case, legal and generic suffix words out, only ``a-z0-9`` words kept."""
    spaced = F.regexp_replace(F.lower(text_or_empty(c)), "[,.]", " ")
    bare = F.regexp_replace(spaced, whole_words(C.NAME_SUFFIXES), " ")
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def name_key(c: Column) -> Column:
    """Grouping key of a name: its normal form, or the plain lower-cased name when
    nothing is left of it, so such names do not fall into one shared group."""
    return F.coalesce(null_if_blank(normalize_name(c)), null_if_blank(F.lower(squash(c))))


def strongest_token(name: Column) -> Column:
    """Longest word of at least three letters of a normalised name; first wins a tie."""
    words = F.filter(F.split(normalize_name(name), " "), lambda w: F.length(w) >= 3)
    longest = F.aggregate(
        words, F.lit(""), lambda best, w: F.when(F.length(w) > F.length(best), w).otherwise(best)
    )
    return null_if_blank(longest)


def word_tokens(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit("([a-z0-9]+)"), F.lit(1)))


def evidence_overlap(excerpt: Column, source: Column) -> Column:
    """Share of the excerpt's distinct words that also occur in the source; 0 when it has none.

    The source is cut at what is not in a word, which is quicker than to find each word, and is not made distinct: the intersection is.
    """
    quoted = F.array(word_tokens(excerpt))
    words = F.split(F.lower(text_or_empty(source)), "[^a-z0-9]+")
    share = lambda q: F.when(F.size(q) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(q, words)) / F.size(q))
    return F.transform(quoted, share).getItem(0)


def blank_tokens(c: Column) -> Column:
    words = F.split(squash(F.lower(text_or_empty(c))), " ")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    ta, tb = blank_tokens(a), blank_tokens(b)
    both = F.size(F.array_intersect(ta, tb))
    either = F.size(F.array_union(ta, tb))
    return F.when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0.0)).otherwise(both / either)


def fingerprint(title: Column, body: Column) -> Column:
    """SHA-256 of the lower-cased, blank-squashed whole text."""
    joined = F.concat(text_or_empty(title), F.lit(" "), text_or_empty(body))
    return F.sha2(squash(F.lower(joined)), 256)


def visible_text(html: Column) -> Column:
    bare = F.regexp_replace(text_or_empty(html), "(?is)<script.*?</script>", " ")
    bare = F.regexp_replace(bare, "(?is)<style.*?</style>", " ")
    return squash(F.regexp_replace(bare, "<[^>]+>", " "))


def profile_link(html: Column) -> Column:
    return extract(html, r"https?://(?:www\.)?linkedin\.com/in/[\p{L}\p{N}_\-/]+", 0)


def contact_email(html: Column) -> Column:
    """A ``mailto:`` address if there is one, else the first bare address."""
    linked = extract(html, r"(?i)mailto:([\p{L}\p{N}_.\-+]+@[\p{L}\p{N}_\-]+\.[\p{L}\p{N}_.\-]+)", 1)
    bare = extract(html, rf"(?i)(?<!{WORD})([\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_.\-+]*@[\p{{L}}\p{{N}}_\-]+\.[a-z]{{2,}})(?!{WORD})", 1)
    return F.coalesce(linked, bare)


def is_populated(c: Column) -> Column:
    """A real value: not NULL and not one of the words that stand for "unknown"."""
    return c.isNotNull() & ~F.lower(F.trim(c.cast("string"))).isin(C.UNKNOWN_WORDS)


def strip_fences(c: Column) -> Column:
    """JSON text out of an optional fenced block."""
    t = strip(text_or_empty(c))
    inner = F.regexp_replace(F.split(t, "```").getItem(1), "^json", "")
    return F.when(F.startswith(t, F.lit("```")), strip(inner)).otherwise(t)
