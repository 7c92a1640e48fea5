"""SQL fragments for DuckDB that say in its own terms what the text expressions do."""

from __future__ import annotations

WS = " " + "".join(chr(c) for c in (9, 10, 11, 12, 13, 0x85, 0xA0, 0x2028, 0x2029, 0x3000))


def replace_all(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


def unescape(x: str) -> str:
    """The references that occur in the given tables and views, &amp; last."""
    for name, char in (("lt;", "<"), ("gt;", ">"), ("quot;", '"'), ("nbsp;", "\xa0"), ("middot;", "·"), ("copy;", "©")):
        x = f"replace({x}, '&{name}', '{char}')"
    return replace_all(x, "&amp;?", "&")


def clean(x: str, drop_script: bool = True) -> str:
    """HTML to text; chr 1 and 2 stand for block and other markup."""
    if drop_script:
        x = replace_all(x, "(?is)<script[^>]*>.*?</script>", "\2")
        x = replace_all(x, "(?is)<style[^>]*>.*?</style>", "\2")
    x = replace_all(x, "(?s)<!--.*?-->", "\2")
    x = replace_all(x, r"(?i)</?(p|div|li|br|tr|h[1-6]|table|ul|ol)(\s[^>]*|/)?>", "\1")
    x = replace_all(x, "<[a-zA-Z/!?][^>]*>", "\2")
    x = replace_all(x, r"<[a-zA-Z/!?][^>]*\z", "")
    x = unescape(x)
    for _ in range(2):
        x = replace_all(x, "([\1\2])[\\s\xa0]+([\1\2])", r"\1\2")
    x = f"replace(replace({x}, '\1', chr(10)), '\2', '')"
    x = unescape(x)
    x = replace_all(x, "[ \\t\u3000]+", " ")
    x = replace_all(x, r"\n{2,}", "\n")
    return f"coalesce({strip(x)}, '')"
