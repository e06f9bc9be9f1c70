"""One comparable character form of text, in the JVM.

``skeleton`` maps what a reader can't tell apart to one spelling: width of letters and blanks, composed and separate
accents, invisible characters, ligatures, hyphen variants and look-alike letters of other scripts. Letter case, raised
or circled digits, and accents stay. Null gives null, an empty text an empty one. All steps are column expressions, so
texts of any length are processed whole; pure ASCII texts skip them.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of other scripts drawn like a Latin one, and that Latin letter.
CYRILLIC = "АВЕЅІЈКМНОРСТХУҮаеорсухѕіјһԁԛԝӏ"
CYRILLIC_AS = "ABESIJKMHOPCTXYYaeopcyxsijhdqwl"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧον"
GREEK_AS = "ABEZHIKMNOPTYXov"
HYPHENS = "‐‑‒⁃−﹣"
# Ranges of the Unicode property Default_Ignorable_Code_Point.
INVISIBLE = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0x1D173, 0x1D17A), (0xE0001, 0xE0001), (0xE0020, 0xE007F), (0xE0100, 0xE01EF)]

NON_ASCII = r"[^\x00-\x7F]"
WORD_BREAK = r"[ \t\n\r\f\x0B\x1C-\x1F\x85\u2028\u2029]+"


def _widths() -> dict[str, str]:
    """Wide and narrow forms, and all blanks, with their normal form."""
    out = {}
    for c in range(0x80, 0x10000):
        kind, _, rest = unicodedata.decomposition(chr(c)).partition(" ")
        if unicodedata.category(chr(c)) == "Zs":
            out[chr(c)] = " "
        elif kind in ("<wide>", "<narrow>"):
            out[chr(c)] = chr(int(rest, 16))
    return out


def _tables() -> tuple[str, str, dict[str, str]]:
    """Characters replaced, their one-character replacements (characters beyond these are removed), and ligatures with their letters."""
    one: dict[str, str] = dict(zip(CYRILLIC + GREEK, CYRILLIC_AS + GREEK_AS)) | dict.fromkeys(HYPHENS, "-")
    gone = {chr(c) for a, b in INVISIBLE for c in range(a, b + 1)}
    ligatures, widths = {}, _widths()
    for c in range(0x80, 0x10000):
        ch = chr(c)
        kind = unicodedata.decomposition(ch).partition(" ")[0]
        if ch in widths and ch not in gone:
            one[ch] = one.get(widths[ch], widths[ch])
        elif kind == "<compat>" and "LATIN" in unicodedata.name(ch, "") and "LIGATURE" in unicodedata.name(ch, ""):
            ligatures[ch] = unicodedata.normalize("NFKC", ch)
    return "".join(one) + "".join(sorted(gone)), "".join(one.values()), ligatures


FROM, TO, LIGATURES = _tables()
WIDTH_FROM, WIDTH_TO = "".join(_widths()), "".join(_widths().values())


def _icu(form: str, c: Column, compat: bool) -> Column:
    """ICU's normaliser, part of Spark's own class path: no trip to Python."""
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit(form), c, F.lit(compat))


def nfc(c: Column) -> Column:
    return F.when(c.rlike(NON_ASCII), _icu("compose", c, False)).otherwise(c)


def nfkc(c: Column) -> Column:
    return F.when(c.rlike(NON_ASCII), _icu("compose", c, True)).otherwise(c)


def ligatures(c: Column) -> Column:
    """``c`` with ligatures spelled out."""
    expanded = c
    for ligature, letters in LIGATURES.items():
        expanded = F.replace(expanded, F.lit(ligature), F.lit(letters))
    return F.when(c.rlike("[" + "".join(LIGATURES) + "]"), expanded).otherwise(c)


def lookalikes(c: Column) -> Column:
    """``c`` in decomposed form with look-alikes, widths, blanks, hyphens and ligatures mapped and invisible characters removed."""
    return ligatures(F.translate(_icu("decompose", c, False), FROM, TO))


def skeleton(c: Column) -> Column:
    return F.when(c.rlike(NON_ASCII), _icu("compose", lookalikes(c), False)).otherwise(c)


def words(c: Column) -> Column:
    """The distinct words of ``c``, cut at white space, with case and character form put aside. Null gives an empty array."""
    return F.array_distinct(F.filter(F.split(F.lower(skeleton(F.coalesce(c, F.lit("")))), WORD_BREAK), lambda w: w != ""))
