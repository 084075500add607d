"""Problem 2: one consistent form for texts that look the same.

Plain form: composed Unicode, compatibility forms resolved where they only
change the look (full-width, ligatures, second codes of a sign), ordinary
space and line feed, no default-ignorable characters, and look-alike letters
of another script inside Latin words replaced by their Latin twins.
Characters with a meaning of their own (raised and lowered digits, fractions,
ellipsis, dashes, quotes, mathematical letters) stay.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import java_class, keep_rows

# Look-alike letters and their Latin twins.
LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТУХЅІЈҮӀԌԚԜѴаеорсухѕіјүӏһԁԛԝѵ"  # Cyrillic
        "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲϳ"  # Greek
        "ՕՍօոսց"  # Armenian
        "ᎪᏴᏟᎬᎻᎫᏦᏞᎷΝᏢᎡᏚᎢᏙᎳᏃ",  # Cherokee
        "ABEKMHOPCTYXSIJYIGQWVaeopcyxsijylhdqwv" "ABEZHIKMNOPTYXovcj" "OUonug" "ABCEHJKLMNPRSTVWZ",
        strict=True,
    )
)
# Letters of the Latin script itself that look like plainer ones.
LATIN_TWINS = {"ɑ": "a", "ɡ": "g", "Ɖ": "Đ", "Ð": "Đ", "ꞁ": "l", "ꓲ": "I", "ꓳ": "O", "‐": "-", "‑": "-", "⁃": "-", "ǃ": "!"}
# Default_Ignorable_Code_Point ranges of the Unicode character database.
IGNORABLE = [
    (0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F),
    (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0),
    (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
]
# Ranges whose compatibility form would lose a meaning of its own.
KEPT = [(0xA8, 0xA8), (0xAF, 0xAF), (0xB4, 0xB4), (0xB8, 0xB8), (0x2017, 0x2017), (0x2024, 0x2026), (0x2033, 0x2037), (0x203C, 0x203E), (0x2047, 0x2049), (0x2057, 0x2057), (0x222C, 0x2230), (0x2474, 0x24B5), (0x2A74, 0x2A76)]


def _in(cp: int, ranges: list[tuple[int, int]]) -> bool:
    return any(a <= cp <= b for a, b in ranges)


@lru_cache(1)
def single_map() -> dict[int, str]:
    """What each single character becomes, by rule from the character database; look-alikes of other scripts excluded."""
    out: dict[int, str] = {}
    for cp in [*range(0x80, 0xD800), *range(0xE000, 0x10000), *range(0x1F100, 0x1F200)]:
        ch = chr(cp)
        if _in(cp, IGNORABLE):
            continue
        if unicodedata.category(ch) == "Zs":
            out[cp] = " "
            continue
        d = unicodedata.decomposition(ch)
        tag = d[1 : d.index(">")] if d.startswith("<") else ""
        if tag in ("wide", "narrow", "compat", "square", "isolated", "initial", "medial", "final", "vertical") and not _in(cp, KEPT):
            out[cp] = unicodedata.normalize("NFKC", ch)
    out |= {ord(k): v for k, v in LATIN_TWINS.items()}
    out |= {0x2103: "°C", 0x2109: "°F", 0xB5: "μ", 0x85: "\n", 0x2028: "\n", 0x2029: "\n", 0x0B: "\n", 0x0C: "\n", 0x0D: "\n", 0x09: " "}
    for a, b in IGNORABLE:
        if b - a < 0x100:
            out |= dict.fromkeys(range(a, b + 1), "")
    out |= dict.fromkeys(range(0xE0000, 0xE0200), "")
    return out


def _plain(cp: int) -> bool:
    """Whether the character alone can never make a text differ from its plain form."""
    ch = chr(cp)
    return cp not in single_map() and ch not in LOOKALIKES and not unicodedata.combining(ch) and unicodedata.normalize("NFC", ch) == ch and not 0x1100 <= cp < 0x1200


@lru_cache(1)
def suspicious_pattern() -> str:
    """Java regex of characters that call for a closer look, a superset in few ranges (many ranges are slow there)."""
    usual = [*range(0x20, 0x7F), 0x0A, *range(0xA1, 0x180), *range(0x1EA0, 0x1EFA), *map(ord, "ơƠưƯΔΩαβγδθλμπρφ₂ℝ−–—“”‘’…")]
    return f"[^{java_class(lambda c: c in usual and _plain(c))}]"


@lru_cache(1)
def _suspicious() -> re.Pattern:
    return re.compile("[" + re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: re.escape(chr(int(m[1], 16))), java_class(lambda c: not _plain(c))) + "\U00010000-\U0010ffff]")


_RUN = re.compile(r"[^\W_]+")
_TWIN = re.compile("[" + "".join(LOOKALIKES) + "]")
_TABLE = str.maketrans(LOOKALIKES)


def _cyrillic(ch: str) -> bool:
    return "Ѐ" <= ch <= "ӿ" or "Ԁ" <= ch <= "ԯ"


def _scripts(text: str) -> str:
    """Look-alikes replaced in words that aren't wholly of another script; lone Greek letters stay."""
    if not _TWIN.search(text):
        return text
    genuine = [m.span() for m in _RUN.finditer(text) if any(_cyrillic(c) and c not in LOOKALIKES for c in m[0]) and not re.search("[A-Za-z]", m[0])]

    def word(m: re.Match) -> str:
        w = m[0]
        if not _TWIN.search(w):
            return w
        if any("a" <= c.lower() <= "z" or "\xc0" <= c <= "ɏ" or "Ḁ" <= c <= "ỿ" for c in w):
            return w.translate(_TABLE)
        # wholly of another script: only letters that all look Latin, outside a passage of that script
        if all(c in LOOKALIKES and _cyrillic(c) or c.isdigit() for c in w) and not any(abs(a - m.end()) < 3 or abs(m.start() - b) < 3 for a, b in genuine):
            return w.translate(_TABLE)
        return w

    return _RUN.sub(word, text)


def plain_form(text: str | None) -> str | None:
    """The plain form of ``text``; null stays null, an empty text stays empty."""
    if not text or not _suspicious().search(text):
        return text
    t = unicodedata.normalize("NFC", text.replace("\r\n", "\n").translate(single_map()))
    return unicodedata.normalize("NFC", _scripts(t))


def differs(text: str | None) -> bool:
    """Whether ``text`` isn't in its plain form already."""
    return bool(text) and plain_form(text) != text


def fold(text: str | None) -> str | None:
    """Plain form in full case folding: equal-looking texts that differ only in case become equal too."""
    return None if text is None else unicodedata.normalize("NFC", plain_form(text).casefold())


def to_plain(c: Column) -> Column:
    """Plain form of a string column: untouched in the JVM unless a suspicious character occurs."""

    @F.pandas_udf(T.StringType())
    def slow(s):
        return s.map({v: plain_form(v) for v in s.dropna().unique()}).where(s.notna(), None)

    return F.when(c.rlike(suspicious_pattern()), slow(c)).otherwise(c)


def to_folded(c: Column) -> Column:
    """Plain form in full case folding of a string column; printable ASCII stays in the JVM."""

    @F.pandas_udf(T.StringType())
    def slow(s):
        return s.map({v: fold(v) for v in s.dropna().unique()}).where(s.notna(), None)

    return F.when(c.rlike(r"[^\n\x20-\x7E]"), slow(c)).otherwise(F.lower(c))


def odd_records(df: DataFrame, text: str, ids: list[str]) -> DataFrame:
    """``ids`` of rows whose ``text`` isn't in plain form, one row each.

    Nulls and empty texts are never odd; repeated rows give one row; other
    columns, whatever their names, are ignored; an empty table gives no rows.
    """
    return keep_rows(df.select(*ids, text).where(F.col(text).rlike(suspicious_pattern())), differs, text, ids).distinct()
