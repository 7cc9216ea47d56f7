"""Text in other scripts and with accents to Latin letters: tables built from the Unicode names of the characters."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

INDIC = ("DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM")
#: Sounds whose spelling differs from the last word of the character's name. Consonants stand without the
#: inherent vowel; aspirated ones keep their h.
SOUNDS = {
    "AA": "a", "II": "i", "UU": "u", "EE": "e", "OO": "o", "CANDRA E": "e", "CANDRA O": "o", "SHORT E": "e", "SHORT O": "o", "VOCALIC R": "r", "VOCALIC RR": "r", "VOCALIC L": "l",
    "NGA": "n", "NYA": "n", "NNA": "n", "NNNA": "n", "TTA": "t", "TTHA": "th", "DDA": "d", "DDDHA": "d", "DDHA": "dh", "RRA": "r", "LLA": "l", "LLLA": "l", "CA": "c", "CHA": "ch",
    "SHA": "s", "SSA": "s", "FA": "f", "YYA": "y", "QA": "q", "KHHA": "kh", "GHHA": "g", "ZA": "z", "RHA": "r",
}
#: Letters of Cyrillic and Greek whose sound differs from the letter's name.
CYRILLIC = {
    "A": "a", "BE": "b", "VE": "v", "GHE": "g", "DE": "d", "IE": "e", "ZHE": "zh", "ZE": "z", "I": "i", "SHORT I": "i", "KA": "k", "EL": "l", "EM": "m", "EN": "n", "O": "o", "PE": "p", "ER": "r",
    "ES": "s", "TE": "t", "U": "u", "EF": "f", "HA": "kh", "TSE": "ts", "CHE": "ch", "SHA": "sh", "SHCHA": "shch", "HARD SIGN": "", "YERU": "y", "SOFT SIGN": "", "E": "e", "YU": "yu", "YA": "ya",
    "IO": "e", "UKRAINIAN IE": "e", "BYELORUSSIAN-UKRAINIAN I": "i", "YI": "i", "JE": "j",
}
GREEK = {
    "ALPHA": "a", "BETA": "b", "GAMMA": "g", "DELTA": "d", "EPSILON": "e", "ZETA": "z", "ETA": "i", "THETA": "th", "IOTA": "i", "KAPPA": "k", "LAMDA": "l", "MU": "m", "NU": "n", "XI": "x",
    "OMICRON": "o", "PI": "p", "RHO": "r", "SIGMA": "s", "FINAL SIGMA": "s", "TAU": "t", "UPSILON": "u", "PHI": "f", "CHI": "ch", "PSI": "ps", "OMEGA": "o",
}


def _sound(name: str) -> str | None:
    script, _, rest = name.partition(" ")
    if script in INDIC:
        if rest.endswith("ANUSVARA"):
            return "m"
        if rest.endswith(("VIRAMA", "NUKTA", "VISARGA", "AVAGRAHA")):
            return ""
        if rest.endswith("CANDRABINDU"):
            return "m"
        if m := re.fullmatch(r"(?:LETTER|VOWEL SIGN) (.+)", rest):
            s = m[1]
            return SOUNDS.get(s, s.lower() if len(s) < 3 and s[-1:] != "A" or s in ("A", "AI", "AU") else s[:-1].lower() if s.endswith("A") else None)
        if m := re.fullmatch(r"DIGIT (.+)", rest):
            return None
    for table, script_ in ((CYRILLIC, "CYRILLIC"), (GREEK, "GREEK")):
        if m := re.fullmatch(rf"{script_} (?:SMALL|CAPITAL) LETTER (.+?)(?: WITH .+)?", name):
            return table.get(m[1])
    return None


@lru_cache(maxsize=1)
def tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(from, to, longer): characters with one Latin letter each, and characters with none or several."""
    single: dict[str, str] = {}
    longer: list[tuple[str, str]] = []
    for cp in (*range(0x80, 0x530), *range(0x900, 0xD80), *range(0x1E00, 0x2070), *range(0x3000, 0x3001), *range(0xFB00, 0xFB07), *range(0xFE00, 0xFE10), *range(0xFEFF, 0xFF5F)):
        c = chr(cp)
        name = unicodedata.name(c, "")
        digit = unicodedata.digit(c, None)
        category = unicodedata.category(c)
        if digit is not None and category == "Nd":
            to = str(digit)
        elif (sound := _sound(name)) is not None:
            to = sound
        elif category in ("Zs", "Pd"):
            to = " " if category == "Zs" else "-"
        elif category in ("Cf", "Mn", "Cc"):
            to = ""
        elif c in "‘’ʼ´":
            to = "'"
        elif c in "“”«»":
            to = '"'
        else:
            to = "".join(x for x in unicodedata.normalize("NFKD", c) if x.isascii())
            if not to:
                to = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "þ": "th", "ı": "i"}.get(c, "")
        if len(to) == 1:
            single[c] = to
        elif to:
            longer.append((c, to))
        else:
            single[c] = ""
    keep = [c for c in single if single[c]]
    gone = [c for c in single if not single[c]]
    return "".join(keep + gone), "".join(single[c] for c in keep), tuple(longer)


def to_latin(text: Column) -> Column:
    """text in ASCII letters; characters of scripts outside the tables are left out. Case of Latin letters is kept."""
    old, new, longer = tables()
    out = text
    groups: dict[str, list[str]] = {}
    for c, to in longer:
        groups.setdefault(to, []).append(c)
    for to, cs in groups.items():
        out = F.regexp_replace(out, "[" + "".join(cs) + "]", to)
    out = F.regexp_replace(F.translate(out, old, new), "[^\\x00-\\x7F]", "")
    return F.when(text.rlike("[^\\x00-\\x7F]"), out).otherwise(text)


def to_latin_sql(text: str) -> str:
    """The same in SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    old, new, longer = tables()
    groups: dict[str, list[str]] = {}
    for c, to in longer:
        groups.setdefault(to, []).append(c)
    out = text
    for to, cs in groups.items():
        out = f"regexp_replace({out}, '[{''.join(cs)}]', '{to}', 'g')"
    return f"regexp_replace(translate({out}, {quote(old)}, {quote(new)}), '[^\\x00-\\x7F]', '', 'g')"
