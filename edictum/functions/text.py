"""Text expressions: HTML to text, entities, scrubbing, document numbers, search predicates."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in scraped text (Unicode, not just ASCII).
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
_WS = r"[\s\x1c-\x1f]"

# Unicode noncharacters stand for markup while a page is turned into text.
_BLOCK, _INLINE, _LT, _AMP = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"

# The tags that break a line.
BLOCK_TAGS = ("p", "div", "li", "br", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "table", "ul", "ol")

# A '>' inside a quoted attribute value does not end the tag.
_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
RAW_TEXT_ELEMENT = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>"
_COMMENT = r"(?s)<!--.*?-->"
_BLOCK_TAG = rf"(?i)</?(?:{'|'.join(BLOCK_TAGS)})(?=[\s/>]){_ATTRS}"
# The last case is a tag cut off by the end of the text.
_OTHER_TAG = rf"</?[a-zA-Z]{_ATTRS}|</[^>]*>|<[!?][^>]*>|<[a-zA-Z/!?][^>]*\z"
_BLANK_RUN = rf"(?U)([{_BLOCK}{_INLINE}]){_WS}+(?=[{_BLOCK}{_INLINE}])"

# Patterns for personal data, with their replacements, in order of use.
# What comes before is looked at behind the first character, so most places cost one comparison.
ID_CARD = r"(?U)\d(?<!\d\d)\d{16}[\dXx](?!\d)"
ID_CARD_MASK = "[身份证号已脱敏]"
MOBILE = r"(?U)1(?<!\d1)[3-9]\d{9}(?!\d)"
MOBILE_MASK = "[手机号已脱敏]"

# Fixed value: a document number such as 国药监药管〔2026〕18号: up to 30 characters, then a
# bracketed year and what follows it.
_NUMBER_LEAD = 30
_YEAR_ON = r"[〔(]\s*\d{4}\s*[〕)][^\s，。；、]{0,20}?号"
_LEAD_END = r"(?U)[^\s，。；、]*\z"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_u(c: Column) -> Column:
    """Strip Unicode white space from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def nonblank(c: Column) -> Column:
    """NULL for text that is empty once stripped, the text itself otherwise."""
    return F.when(trim_u(c) != "", c)


def first_nonblank(*cols: Column) -> Column:
    """The first column that is neither NULL nor empty; ``''`` if there is none."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


# ---------------------------------------------------------------- entities

# The names met most come first: a lookup walks the table in order.
_FREQUENT = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "middot;", "copy;")
_NAMES = [*_FREQUENT, *(name for name in html5 if name not in _FREQUENT)]
_REFERENCE = r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]{0,31};)"
# Names that also count without a semicolon; the longest is taken.
_LEGACY = "^(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)) + ")"


def _cp1252(byte: int) -> str:
    try:
        return bytes([byte]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(byte)


# Codes that stand for nothing: controls and the noncharacters of each plane.
_NOTHING = (
    r"[\x01-\x08\x0b\x0e-\x1f\x7f\ufdd0-\ufdef"
    + "".join(rf"\x{{{plane << 16 | low:x}}}" for plane in range(17) for low in (0xFFFE, 0xFFFF))
    + "]"
)
_C1 = range(0x80, 0xA0)  # read as windows-1252, the five it leaves open as themselves


def _code_point(token: Column) -> Column:
    """Character of a numeric reference, with the HTML rules for codes that are not characters."""
    digits = F.regexp_extract(token, "^#[xX]?0*([0-9a-fA-F]{1,9});?$", 1)
    code = F.conv(digits, 10, 10).cast("bigint")
    code = F.when(token.rlike("^#[xX]"), F.conv(digits, 16, 10).cast("bigint")).otherwise(code)

    def char(code: Column) -> Column:
        raw = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        char = F.translate(F.regexp_replace(raw, _NOTHING, ""), "".join(map(chr, _C1)), "".join(map(_cp1252, _C1)))
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(valid, char).otherwise(F.lit("\ufffd"))

    return let(code, char)


def _decode_reference(piece: Column) -> Column:
    """Text that followed an ``&``, with the reference at its start decoded."""
    table = F.map_from_arrays(
        F.split(F.lit(" ".join(_NAMES)), " "),
        F.split(F.lit("\ufdd4".join(html5[n] for n in _NAMES)), "\ufdd4"),
    )
    rest = lambda token: F.substr(piece, F.length(token) + 1)

    def decode(token: Column) -> Column:
        legacy = F.regexp_extract(piece, _LEGACY, 0)
        named = F.coalesce(
            F.concat(F.try_element_at(table, token), rest(token)),
            F.concat(F.try_element_at(table, legacy), rest(legacy)),
            F.concat(F.lit("&"), piece),
        )
        number = F.concat(_code_point(token), rest(token))
        return F.when(F.startswith(token, F.lit("#")), number).otherwise(named)

    possible = piece.rlike("^[#a-zA-Z]")
    return F.when(possible, let(F.regexp_extract(piece, _REFERENCE, 0), decode)).otherwise(
        F.concat(F.lit("&"), piece)
    )


def unescape(c: Column) -> Column:
    """Decode HTML character references in one pass; text without any is returned as it is."""

    def decode(text: Column) -> Column:
        pieces = F.transform(
            F.split(text, "&", -1), lambda p, i: F.when(i == 0, p).otherwise(_decode_reference(p))
        )
        return F.array_join(pieces, "")

    return let(c, lambda v: F.when(F.contains(v, F.lit("&")), decode(v)).otherwise(v))


# ---------------------------------------------------------------- HTML to text


def _protect_raw_text(html: Column) -> Column:
    """Script and style bodies are data, not markup: hide what would be read as markup."""
    between = F.split(html, RAW_TEXT_ELEMENT, -1)
    blocks = F.regexp_extract_all(html, F.lit(RAW_TEXT_ELEMENT), F.lit(0))

    def shield(block):
        body = F.regexp_replace(block, r"(?is)\A<(?:script|style)\b[^>]*>|</(?:script|style)\s*>\z", "")
        return F.concat(F.lit(_INLINE), F.translate(body, "<&", _LT + _AMP), F.lit(_INLINE))

    return F.array_join(
        F.transform(between, lambda p, i: F.concat(p, F.coalesce(shield(F.get(blocks, i)), F.lit("")))), ""
    )


def clean_html_text(html: Column, drop_script: bool = True) -> Column:
    """Plain text of an HTML fragment.

    Block tags become line breaks, all other markup goes, runs of white space that stand alone
    between two tags are dropped, entities are decoded twice, blanks and line breaks are
    collapsed. ``drop_script=False`` keeps the text of script and style elements.
    """
    if drop_script:
        text = F.regexp_replace(html, f"{RAW_TEXT_ELEMENT}|{_COMMENT}", _INLINE)
    else:
        text = F.regexp_replace(_protect_raw_text(html), _COMMENT, _INLINE)
    text = F.regexp_replace(text, _BLOCK_TAG, _BLOCK)
    text = F.regexp_replace(text, _OTHER_TAG, _INLINE)
    text = unescape(text)
    text = F.regexp_replace(text, _BLANK_RUN, "$1")
    text = F.replace(F.replace(text, F.lit(_BLOCK), F.lit("\n")), F.lit(_INLINE), F.lit(""))
    if not drop_script:
        text = F.replace(F.replace(text, F.lit(_LT), F.lit("<")), F.lit(_AMP), F.lit("&"))
    text = unescape(text)
    # A blank that stands alone stays as it is: only what changes is replaced.
    text = F.regexp_replace(text, "[ \\t\u3000]{2,}|[\\t\u3000]", " ")
    text = F.regexp_replace(text, "\\n{2,}", "\n")
    return F.coalesce(trim_u(text), F.lit(""))


# ---------------------------------------------------------------- scrubbing, numbers, previews


def scrub_pii(c: Column) -> Column:
    """Mask identity numbers, then mobile numbers; landlines stay."""
    return F.regexp_replace(F.regexp_replace(c, ID_CARD, ID_CARD_MASK), MOBILE, MOBILE_MASK)


def doc_number(c: Column) -> Column:
    """First document number in a text, ``''`` if none.

    The first bracketed year is found first and the lead is cut from the characters before it;
    trying a lead from every position of a text takes thirty times as long. What was found stands
    nowhere earlier, so the text is scanned by pattern once and then cut at its first occurrence.
    """

    def with_lead(year_on: Column) -> Column:
        before = F.call_function("substring_index", c, year_on, F.lit(1))
        lead = F.regexp_extract(F.right(before, F.lit(_NUMBER_LEAD)), _LEAD_END, 0)
        return F.when(year_on != "", trim_u(F.concat(lead, year_on))).otherwise(F.lit(""))

    return let(F.regexp_extract(c, f"(?U){_YEAR_ON}", 0), with_lead)


def preview(c: Column, n: int = 200) -> Column:
    return F.substring(F.coalesce(c, F.lit("")), 1, n)


# ---------------------------------------------------------------- search predicates


def like_contains(c: Column, needle: str) -> Column:
    """Case-insensitive ``LIKE %needle%``; ``%`` and ``_`` are wildcards, there is no escape."""
    return F.ilike(c, F.lit("%" + needle.replace("\\", "\\\\") + "%"))


def contains_ci(c: Column, needle: str) -> Column:
    """Plain case-insensitive containment."""
    return F.contains(F.lower(c), F.lit(needle.lower()))


# ---------------------------------------------------------------- JSON held in strings


def json_list(c: Column, element: str = "struct<url:string,file:string>") -> Column:
    """Array held as JSON text; anything that is not a JSON array is an empty array."""
    empty = F.from_json(F.lit("[]"), f"array<{element}>")
    is_list = F.json_array_length(c).isNotNull()
    return F.coalesce(F.when(is_list, F.from_json(c, f"array<{element}>")), empty)
