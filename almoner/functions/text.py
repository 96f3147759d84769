"""Text normalisation as Spark column expressions (no Python per row)."""

from __future__ import annotations

import re
import unicodedata
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as part of a word when a match must be "whole word".
WORD = r"[\p{L}\p{M}\p{N}_]"
NON_WORD = r"[^\p{L}\p{M}\p{N}_]"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, which may use it several times."""
    return F.transform(F.array(value), body)[0]


def scrub(col: Column, pattern: str = r"[\n\r\t]+", to: str = " ") -> Column:
    """Replace delimiter and layout characters so a field can be written unquoted."""
    return F.regexp_replace(col, pattern, to)


def squeeze(col: Column) -> Column:
    """Runs of white space become one space; none is left at either end."""
    return F.trim(F.regexp_replace(col, r"\s+", " "))


def separators_to_space(col: Column) -> Column:
    return F.translate(col, "-/'_", "    ")


def drop_punct(col: Column) -> Column:
    """Delete ASCII punctuation; the neighbours of a deleted mark are joined."""
    return F.regexp_replace(col, r"\p{Punct}", "")


def drop_non_ascii(col: Column) -> Column:
    return F.regexp_replace(col, r"[^\x00-\x7f]", "")


def alpha_tokens(col: Column) -> Column:
    """Array of maximal runs of ASCII letters."""
    return F.regexp_extract_all(col, F.lit("([A-Za-z]+)"), 1)


def join_fields(cols: list[Column], sep: str = "|") -> Column:
    """Fields in one line; a missing field leaves its place empty."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def _accent_table() -> tuple[str, str]:
    """Letters that decompose into one ASCII letter plus marks, and that letter."""
    pairs = []
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base, *marks = unicodedata.normalize("NFKD", chr(point))
        if marks and base.isascii() and base.isalpha() and all(map(unicodedata.combining, marks)):
            pairs.append((chr(point), base))
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


# Letters and marks without a decomposition, one ASCII character each.
PLAIN_FROM = "øØđĐłŁıðÐħĦ‘’‚‛“”„‟‐‑‒–—―•· "
PLAIN_TO = "oOdDlLidDhH''''\"\"\"\"------o. "
# Characters that become several ASCII characters.
WIDE = {
    "ß": "ss",
    "æ": "ae",
    "Æ": "AE",
    "œ": "oe",
    "Œ": "OE",
    "þ": "th",
    "Þ": "TH",
    "€": "EUR",
    "…": "...",
    "«": "<<",
    "»": ">>",
    "ﬁ": "fi",
    "ﬂ": "fl",
    "™": "(TM)",
    "©": "(C)",
    "®": "(R)",
}


def to_ascii(col: Column) -> Column:
    """Transliterate to ASCII; characters without a counterpart are dropped."""
    source, target = _accent_table()
    out = F.translate(col, source + PLAIN_FROM, target + PLAIN_TO)
    for wide, plain in WIDE.items():
        out = F.replace(out, F.lit(wide), F.lit(plain))
    # pure ASCII text, the common case, skips the replacement chain
    return F.when(col.rlike(r"[^\x00-\x7f]"), drop_non_ascii(out)).otherwise(col)


def _code_point(number: Column) -> Column:
    """The character for a code point; numbers outside Unicode give null."""
    valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    hexed = F.lpad(F.hex(F.when(valid, number)), 8, "0")
    return F.decode(F.unhex(hexed), "UTF-32")


def _decode_once(text: Column) -> Column:
    names = F.str_to_map(
        F.lit("\u0001".join(f"{n}\u0002{chr(p)}" for n, p in name2codepoint.items())),
        F.lit("\u0001"),
        F.lit("\u0002"),
    )

    def piece(part: Column) -> Column:
        # what follows one "&": a number, or a name; Latin-1 names may lack the semicolon
        decimal = F.regexp_extract(part, r"^#([0-9]{1,8});?", 1)
        hexed = F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]{1,7});?", 1)
        name = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]*)", 1)
        found = F.element_at(names, name)
        closed = F.substring(part, F.length(name) + 1, 1) == ";"
        named = F.when((name != "") & (closed | (F.ascii(found) < 256)), found)
        char = (
            F.when(decimal != "", _code_point(decimal.try_cast("bigint")))
            .when(hexed != "", _code_point(F.conv(hexed, 16, 10).try_cast("bigint")))
            .otherwise(named)
        )
        rest = F.regexp_replace(part, r"^(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]*);?", "")
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), part))

    def whole(t: Column) -> Column:
        parts = F.split(t, "&")
        tail = F.transform(F.slice(parts, F.lit(2), F.size(parts)), piece)
        return F.concat(parts[0], F.array_join(tail, ""))

    return let(text, lambda t: F.when(t.contains("&"), whole(t)).otherwise(t))


def decode_entities(col: Column, times: int = 2) -> Column:
    """Decode HTML entities, twice by default because exports often escape twice."""
    for _ in range(times):
        col = _decode_once(col)
    return col


# Tags that format characters inside a word; every other tag separates words.
INLINE = "a|abbr|b|big|code|em|font|i|s|small|span|strong|sub|sup|tt|u"


def html_to_text(col: Column) -> Column:
    """Visible text: no comments, scripts, styles or tags."""
    out = F.regexp_replace(col, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?is)<script\b.*?</script\s*>", " ")
    out = F.regexp_replace(out, r"(?is)<style\b.*?</style\s*>", " ")
    out = F.regexp_replace(out, rf"(?i)</?(?:{INLINE})(?:\s[^>]*)?/?>", "")
    return F.regexp_replace(out, r"<[^>]*>", " ")


def body_between(col: Column, marker: str) -> Column:
    """Text from the first to the last ``marker`` tag; the last one's own content is outside."""
    quoted = re.escape(marker)
    body = F.regexp_extract(col, rf"(?s){quoted}.*{quoted}", 0)
    return F.regexp_replace(F.regexp_replace(body, r"<[^>]*", ""), ">", "")


def sentences(col: Column) -> Column:
    """Sentences end after a letter or digit followed by a full stop, which they keep."""
    marked = F.regexp_replace(F.translate(col, "\n", " "), r"([A-Za-z0-9]\.)", "$1\n")
    parts = F.transform(F.split(marked, "\n"), lambda s: F.regexp_replace(s, r"^[ \t]+|[ \t]+$", ""))
    return F.filter(parts, lambda s: s != "")


def drop_blank(df, column: str):
    """Rows whose text is more than white space."""
    return df.filter(F.col(column).rlike(r"\S"))


def longer_than(col: Column, limit: int) -> Column:
    """Strictly longer than ``limit`` characters."""
    return F.length(col) > limit


def project_codes(col: Column, pattern: str = r"P[0-9]{6}") -> Column:
    """All project codes named in a text."""
    return F.regexp_extract_all(col, F.lit(f"({pattern})"), 1)
