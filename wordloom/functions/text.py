"""Column expressions that turn stored content into clean, lower-cased search text."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace that counts when trimming stored values.
WHITESPACE = " \t\n\r\0\x0b"

# The character classes and the passes of the punctuation cleaner.
URL_BRACKETS = r"\[\]\(\)"
URL_BEFORE_SPACE = r":;'_\*%@&?!" + URL_BRACKETS
URL_AFTER_SPACE = r"\.,:;'\-_\*@&/\\\?!#" + URL_BRACKETS
URL_ANY = r"\.,:;'\-_\*%@&/\\\?!#" + URL_BRACKETS
SPECIAL_QUOTES = r"'\"\*<>"
NUMBER_SEPARATORS = r"\x{002E}\x{FE52}\x{FF0E}\x{002C}\x{FE50}\x{FF0C}\x{066B}\x{066C}"
NUMBER_MODIFIERS = (
    r"\x{0023}\x{FE5F}\x{FF03}\x{066A}\x{0025}\x{FE6A}\x{FF05}"
    r"\x{2030}\x{2031}\x{2032}\x{2033}\x{2034}\x{2057}"
)
# Signs that become spaces wherever they stand. The ranges in front leave letters, digits and most
# signs out at once.
SPACE_LIKE = (
    r"[\x00-\x1F{}\x7F-\x{10FFFF}&&"
    rf"[\p{{Z}}\p{{Cc}}\p{{Cf}}\p{{Cs}}\p{{Pi}}\p{{Pf}}\p{{Ps}}\p{{Pe}}[\p{{Po}}&&[^{NUMBER_SEPARATORS}{NUMBER_MODIFIERS}]]]]"
)
# No letter below is one of these signs.
NO_LETTER = r"\x21-\x5F\x80-\x{10FFFF}"
AT_END = rf"[{NO_LETTER}&&[{SPECIAL_QUOTES}{NUMBER_SEPARATORS}{URL_AFTER_SPACE}\p{{Pd}}\p{{Pc}}]]"
AT_START = rf"[{SPECIAL_QUOTES}{URL_BEFORE_SPACE}\p{{Pc}}]"
DASHES = r"\p{Pd}+(?![\p{N}\p{Sc}])"
# Signs anywhere, at the end of a word, and at its beginning with the dashes behind them. A sign is
# looked for first and what stands before it second, since few places of a text hold a sign.
PUNCTUATION_PASSES = (
    SPACE_LIKE,
    rf"{AT_END}++(?: |\z)",
    rf"(?=[{NO_LETTER}&&[{SPECIAL_QUOTES}{URL_BEFORE_SPACE}\p{{Pc}}\p{{Pd}}]])(?<![^ ])(?:{AT_START}++(?:{DASHES})?|{DASHES})",
    r"  +",
)

# Tokens that look like code are not keywords.
CODE_STARTS = ("lt;", "$", "/")
CODE_ENDS = ("&gt",)
CODE_PARTS = ("&lt;", "&gt;", "=", "->", "::")

# A comment, an empty tag, or a tag whose quoted attributes may hold ">"; an unclosed one
# runs to the end. Possessive throughout, so long tags need no deep recursion.
MARKUP = (
    r"(?s)<!--.*?(?:-->|\z)|<>|"
    r"<[^\s>\"'](?:[^\"'>]++|\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z))*+(?:>|\z)"
)


def trimmed(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def strip_tags(col: Column, replacement: str = "") -> Column:
    has_markup = F.contains(col, F.lit("<"))
    return F.when(has_markup, F.regexp_replace(col, MARKUP, replacement)).otherwise(col)


def character(code: Column) -> Column:
    """The character of a code point (``char`` only covers single bytes)."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


# The digits of a numeric character reference, as they stand between "&#" and ";".
DIGITS = "x0*[0-9a-f]{1,8}|0*[0-9]{1,9}"
# Texts with up to so many different references have them replaced one after another.
FEW_REFERENCES = 64


def referenced(digits: Column) -> Column:
    """The character that the digits stand for; null for impossible ones."""
    is_hex = F.lower(F.left(digits, F.lit(1))) == "x"
    code = F.when(is_hex, F.conv(F.substr(digits, F.lit(2)), 16, 10)).otherwise(digits).try_cast("long")
    valid = lambda c: c.between(1, 0x10FFFF) & ~c.between(0xD800, 0xDFFF)
    # An array of one is computed once, however often the lambda names it.
    return F.transform(F.array(code), lambda c: F.when(valid(c), character(c)))[0]


def decoded_pieces(text: Column) -> Column:
    """A text decoded piece by piece, each beginning behind a "&#"."""
    digits = lambda p: F.regexp_extract(p, f"(?i)^({DIGITS});", 1)
    pieces = F.transform(
        F.split(text, "&#", -1),
        lambda p, i: F.struct(p.alias("piece"), i.alias("at"), F.when(i > 0, digits(p)).alias("digits")),
    )
    known = F.transform(
        pieces,
        lambda p: F.struct(
            p["piece"].alias("piece"),
            p["at"].alias("at"),
            F.char_length(p["digits"]).alias("size"),
            F.when(p["digits"] != "", referenced(p["digits"])).alias("character"),
        ),
    )
    written = lambda p: (
        F.when(p["at"] == 0, p["piece"])
        .when(p["character"].isNotNull(), F.concat(p["character"], F.substr(p["piece"], p["size"] + 2)))
        .otherwise(F.concat(F.lit("&#"), p["piece"]))
    )
    return F.array_join(F.transform(known, written), "")


def decode_entities(col: Column) -> Column:
    """Numeric character references to characters; impossible ones stay as written.

    Where every "&#" of a text begins a reference, and none stands for a sign of which "&#" is made,
    no replacement can make another reference: the few different ones are replaced in the whole text.
    """
    found = F.struct(
        col.alias("text"), F.regexp_extract_all(col, F.lit(f"(?i)&#({DIGITS});"), F.lit(1)).alias("all")
    )
    listed = F.transform(
        F.array(found),
        lambda f: F.struct(
            f["text"].alias("text"),
            F.size(f["all"]).alias("size"),
            F.transform(
                F.array_distinct(f["all"]),
                lambda d: F.struct(F.concat(F.lit("&#"), d, F.lit(";")).alias("written"), referenced(d).alias("character")),
            ).alias("different"),
        ),
    )
    plain = lambda r: F.coalesce(~r["character"].isin("&", "#"), F.lit(False))
    decoded = F.transform(
        listed,
        lambda f: F.when(
            (F.size(f["different"]) <= FEW_REFERENCES)
            & (f["size"] == count_substring(f["text"], F.lit("&#")))
            & F.forall(f["different"], plain),
            F.aggregate(f["different"], f["text"], lambda t, r: F.replace(t, r["written"], r["character"])),
        ).otherwise(decoded_pieces(f["text"])),
    )
    return F.when(~F.contains(col, F.lit("&#")), col).otherwise(decoded[0])


def repair_utf8(col: Column) -> Column:
    """Bytes to text: UTF-8 where they are valid UTF-8, else read as Latin-1."""
    as_text = col.cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(F.decode(col, "ISO-8859-1"))


def strip_punctuation(col: Column) -> Column:
    """Punctuation to spaces, keeping marks inside URLs, numbers and words."""
    for pattern in PUNCTUATION_PASSES:
        col = F.regexp_replace(col, pattern, " ")
    return col


def clean_text(col: Column) -> Column:
    """Markup and punctuation removed, lower case, single spaces."""
    return F.trim(strip_punctuation(F.lower(decode_entities(strip_tags(col)))))


def flatten_text(name: str | Column, data_type: T.DataType) -> Column:
    """All text inside a value in document order, a space after every element."""
    col = F.col(name) if isinstance(name, str) else name
    if isinstance(data_type, T.StructType):
        parts = [flatten_text(col.getField(f.name), f.dataType) for f in data_type.fields]
        inner = F.concat(*parts)
    elif isinstance(data_type, T.ArrayType):
        items = F.transform(col, lambda item: flatten_text(item, data_type.elementType))
        inner = F.array_join(items, "")
    elif isinstance(data_type, T.MapType):
        values = F.transform(
            F.map_values(col), lambda value: flatten_text(value, data_type.valueType)
        )
        inner = F.array_join(values, "")
    else:
        inner = col.cast("string")
    return F.coalesce(F.concat(inner, F.lit(" ")), F.lit(""))


def count_substring(text: Column, word: Column) -> Column:
    """How often ``word`` occurs in ``text`` without overlaps (0 for an empty word)."""
    removed = F.octet_length(text) - F.octet_length(F.replace(text, word, F.lit("")))
    return F.when(F.octet_length(word) > 0, (removed / F.octet_length(word)).cast("int")).otherwise(0)


def literal_pattern(word: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(word, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def has_whole_word(text: Column, word: Column) -> Column:
    """Whether ``word`` occurs in ``text`` with no word character on either side."""
    pattern = F.concat(F.lit(r"(?<!\w)"), literal_pattern(word), F.lit(r"(?!\w)"))
    return F.rlike(text, pattern)


# Letters with accents up to the end of the Latin blocks, and the letters they stand on.
ACCENTED = [chr(c) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)) if unicodedata.decomposition(chr(c))]
PLAIN = [unicodedata.normalize("NFD", c)[0] for c in ACCENTED]


def without_accents(col: Column) -> Column:
    """Letters without their accents, for comparisons that don't tell them apart."""
    pairs = [(a, p) for a, p in zip(ACCENTED, PLAIN) if a != p]
    plain = F.translate(col, "".join(a for a, _ in pairs), "".join(p for _, p in pairs))
    return F.regexp_replace(plain, r"\p{Mn}+", "")


# The Soundex digit of the letters A to Z.
SOUND_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SOUND_DIGITS = "01230120022455012623010202"


def long_soundex(word: Column) -> Column:
    """Soundex without a limit of length: vowels go first, repeated digits second.

    Letters beyond A-Z count as vowels and stand as they are in first place; a word without
    letters has an empty code. Codes are filled with zeros to four characters.
    """
    letters = F.regexp_replace(word, r"[^A-Za-z\x{C0}-\x{10FFFF}]", "")
    upper = F.translate(letters, SOUND_LETTERS.lower(), SOUND_LETTERS)
    digits = F.regexp_replace(F.translate(upper, SOUND_LETTERS, SOUND_DIGITS), "[^0-9]", "0")
    spoken = F.concat(F.left(digits, F.lit(1)), F.replace(F.substr(digits, F.lit(2)), F.lit("0"), F.lit("")))
    single = F.regexp_replace(spoken, r"([0-9])\1+", "$1")
    code = F.concat(F.left(upper, F.lit(1)), F.substr(single, F.lit(2)))
    return F.when(letters == "", "").otherwise(F.rpad(code, F.greatest(F.lit(4), F.char_length(code)), F.lit("0")))


def slug(col: Column) -> Column:
    dashed = F.regexp_replace(F.lower(col), "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-|-$", "")


def escape_html(col: Column) -> Column:
    # Characters that HTML output escapes.
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        col = F.replace(col, F.lit(raw), F.lit(escaped))
    return col
