"""Text expressions: trimming, tidying, titles, URLs, tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. The whitespace that Unicode-aware trimming removes, the line
# breaks a text is cut at, both as regular-expression character classes that
# Java and RE2 read alike.
LINE_BREAKS = r"\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}"
WHITESPACE = (
    r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WORD_GAP = r"[^\p{L}\p{N}]+"
SENTENCE_END = r"[.!?]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(text: Column | str) -> Column:
    """Remove Unicode whitespace from both ends."""
    return F.btrim(_col(text), F.lit(WHITESPACE_CHARS))


def is_blank(text: Column | str) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(F.length(strip(text)), F.lit(0)) == 0


def tidy_lines(text: Column | str) -> Column:
    """Trim line ends, keep one blank line per run, trim the whole text."""
    unified = F.regexp_replace(_col(text), rf"\r\n|[{LINE_BREAKS}]", "\n")
    # A match begins where its run of blanks does, so a long run is looked at once.
    start = rf"(?<![{WHITESPACE}])"
    trimmed = F.regexp_replace(unified, rf"{start}[{WHITESPACE}]*\n[{WHITESPACE}]*\n", "\n\n")
    inner = WHITESPACE.replace(r"\n", "")
    return strip(F.regexp_replace(trimmed, rf"(?<![{inner}])[{inner}]++\n", "\n"))


def title_of(text: Column | str, fallback: Column | str) -> Column:
    """First line without its heading marks; the fallback for an empty text."""
    body = _col(text)
    first = F.regexp_extract(body, rf"\A[^{LINE_BREAKS}]*", 0)
    title = strip(F.regexp_replace(first, r"\A[# ]+", ""))
    return F.when(F.length(body) > 0, title).otherwise(_col(fallback))


def has_page_extension(name: Column | str) -> Column:
    """File names that hold a page; the match is case-sensitive."""
    return _col(name).rlike(r"\.(html|htm|md)\z")


def url_from_file_name(name: Column | str, host: str) -> Column:
    """Rebuild a page URL: last extension dropped, ``__`` read as ``/``."""
    stem = F.regexp_replace(_col(name), r"\.[^.]*\z", "")
    return F.concat(F.lit(host), F.replace(stem, F.lit("__"), F.lit("/")))


def canonical_url(url: Column | str, drop_segments: Sequence[str] = ()) -> Column:
    """Host and path only, so that two spellings of one page compare equal.

    Scheme, ``www.``/``m.``, query, fragment, a trailing slash and ``.html``
    go. ``drop_segments`` names leading path segments (a locale, say) that do
    not tell pages apart.
    """
    out = F.regexp_replace(_col(url), r"\A[A-Za-z][A-Za-z0-9+.-]*://", "")
    out = F.regexp_replace(out, r"[?#].*\z", "")
    out = F.regexp_replace(out, r"\A(www|m)\.", "")
    out = F.regexp_replace(out, r"/+\z", "")
    out = F.regexp_replace(out, r"\.html?\z", "")
    if drop_segments:
        names = "|".join(drop_segments)
        out = F.regexp_replace(out, rf"\A([^/]+)/({names})(/|\z)", "$1$3")
    return out


def page_slug(url: Column | str, host_too: bool = True) -> Column:
    """File stem for a URL: the canonical form with ``/`` written as ``__``."""
    path = canonical_url(url)
    if not host_too:
        path = F.regexp_replace(path, r"\A[^/]+/?", "")
    return F.replace(path, F.lit("/"), F.lit("__"))


def snippet(text: Column | str, size: int = 100) -> Column:
    """The first ``size`` characters on one line."""
    return F.translate(F.substring(_col(text), 1, size), "\n", " ")


def tokens(text: Column | str) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(_col(text)), WORD_GAP), "")


def is_injection(text: Column | str, patterns: Sequence[str]) -> Column:
    """True where any pattern (case-insensitive) occurs; null text is clean."""
    joined = "|".join(f"(?:{p})" for p in patterns)
    return F.coalesce(_col(text).rlike(rf"(?i){joined}"), F.lit(False))


# Phrases that try to give orders to a model reading the text.
INJECTION_PATTERNS = (
    r"ignore (?:all |any )?(?:the )?(?:previous|prior|above) instructions",
    r"disregard (?:all |any )?(?:the )?(?:previous|prior|above)",
    r"you are now (?:a|an|the) ",
    r"system prompt",
    r"do not (?:tell|reveal|mention)",
    r"<\|[a-z_]+\|>",
)
