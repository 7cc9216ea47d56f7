"""Visually identical text with different characters: skeletons, one consistent form, and the altered texts."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts that look like Latin ones, each with its Latin prototype.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХЬаеіјорсухѕԁһԛԝ", "ABESIJKMHOPCTYXbaeijopcyxsdhqw"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανοϲρυικ", "ABEZHIKMNOPTYXavocpuik"))
ARMENIAN = dict(zip("ՏՕՍոսցօ", "SOUnuqo"))
#: Letters that look alike only by convention of the tables, not to a reader; used in skeletons alone.
LOOSE = dict(zip("З0О1Ӏ|", "3OOlll"))

TO_LATIN = CYRILLIC | GREEK | ARMENIAN
#: Character to its prototype, from the published table of look-alikes; empty until use_prototypes is called.
PROTOTYPES: dict[str, str] = {}
#: Letters that are ordinary in some Latin alphabet although a plainer letter looks like them.
ORDINARY = set("ıƒǃəɔɛɖɣɩʋŋǀǁœæøðþßſ")
TO_CYRILLIC = {v: k for k, v in reversed(CYRILLIC.items())} | {k: {v: c for c, v in CYRILLIC.items()}.get(v) for k, v in GREEK.items()}
TO_GREEK = {v: k for k, v in reversed(GREEK.items())}
HYPHENS = dict.fromkeys("‐‑", "-")
#: Joiners that some scripts need inside words, after a virama or between letters.
JOINERS = "‌‍"
JOINER_SCRIPTS = ("DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA", "ARABIC", "KHMER", "MONGOLIAN", "MYANMAR")


@lru_cache(maxsize=100_000)
def _script(ch: str) -> str:
    """Script of a letter, from its character name; empty for other characters."""
    if not ch.isalpha():
        return ""
    name = unicodedata.name(ch, "")
    first = name.split(" ", 1)[0]
    return "LATIN" if first in ("FULLWIDTH", "MODIFIER", "FEMININE", "MASCULINE", "MICRO") else first


def published_prototypes(spark: SparkSession) -> dict[str, str]:
    """The table of look-alikes as published with Unicode, read from the library that Spark ships for collations.

    About seven thousand characters; its size does not depend on data. An error where that library is absent or gives
    another number of skeletons: with the letters listed above alone most altered texts would pass for ordinary ones.
    """
    chars = [chr(c) for c in range(0x21, 0x20000) if unicodedata.category(chr(c)) not in ("Cn", "Co", "Cs", "Cc", "Zl", "Zp")]
    try:
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        found = checker.getSkeleton("\n".join(chars)).split("\n")
    except Exception as e:
        raise RuntimeError("the table of look-alikes can't be read: com.ibm.icu.text.SpoofChecker, which Spark ships, is not on the driver's class path or failed") from e
    if len(found) != len(chars):
        raise RuntimeError(f"the table of look-alikes is broken: {len(found)} skeletons for {len(chars)} characters")
    return {c: p for c, p in zip(chars, found) if c != p}


def use_prototypes(table: tuple[tuple[str, str], ...]) -> None:
    """Makes the published table known to this process: letters of any script with a Latin look-alike, and prototypes."""
    if PROTOTYPES or not table:
        return
    PROTOTYPES.update(table)
    for c, p in table:
        if len(p) == 1 and p.isascii() and p.isalpha() and c.isalpha() and ord(c) > 0x2AF and _script(c) != "LATIN" and len(unicodedata.normalize("NFKC", c)) == 1 and not unicodedata.normalize("NFKC", c).isascii():
            TO_LATIN.setdefault(c, p)
    for f in (_plain, consistent):
        f.cache_clear()


def _variant(ch: str) -> str | None:
    """The plain letters of a phonetic, small capital or sign-like variant of Latin letters; None for others."""
    if ch in ORDINARY or ch < "ɐ":
        return None
    name = unicodedata.name(ch, "")
    if "SMALL CAPITAL" in name and (last := name.rsplit(" ", 1)[-1]) and len(last) == 1:
        return last.lower()
    p = PROTOTYPES.get(ch, "")
    if p.isascii() and p.isalpha() and (_script(ch) == "LATIN" or unicodedata.category(ch) == "So"):
        return p
    return None


@lru_cache(maxsize=100_000)
def _plain(ch: str) -> str:
    """A character's ordinary form where it is a wide, narrow, font or ligature variant, an odd blank or a hyphen."""
    if ch in HYPHENS:
        return HYPHENS[ch]
    if ord(ch) < 128:
        return ch
    if unicodedata.category(ch) == "Zs":
        return " "
    kind = unicodedata.decomposition(ch).split(" ", 1)[0]
    if kind in ("<wide>", "<narrow>", "<font>") or kind == "<compat>" and unicodedata.category(ch) in ("Ll", "Lu", "Nl") or ch == "ﬅ":
        return unicodedata.normalize("NFKC", ch)
    if (v := _variant(ch)) is not None:
        return v
    if kind == "<circle>" and ch.isalpha():
        return unicodedata.normalize("NFKC", ch)
    return ch


@lru_cache(maxsize=100_000)
def _ignorable(ch: str) -> bool:
    """Characters without a shape of their own: zero width, soft hyphen, direction marks, variation selectors."""
    if ord(ch) < 128:
        return False
    c = unicodedata.category(ch)
    return c == "Cf" or ch in "͏ᅟᅠ឴឵᠋᠌᠍᠎⠀ㅤﾠ" or "︀" <= ch <= "️"


def _joiner_needed(text: str, i: int) -> bool:
    """Whether the joiner at i is part of a script's own spelling: after a virama or between letters that join."""
    if i == 0 or i + 1 >= len(text):
        return False
    before, after = text[i - 1], text[i + 1]
    nb, na = unicodedata.name(before, "").split(" ", 1)[0], unicodedata.name(after, "").split(" ", 1)[0]
    if nb not in JOINER_SCRIPTS or na != nb:
        return False
    return unicodedata.combining(before) == 9 or nb in ("ARABIC", "MONGOLIAN", "SINHALA", "MALAYALAM")


def skeleton(text: str) -> str:
    """Decompose, replace every character by its look-alike prototype, decompose again.

    Characters without a shape are left out, blanks become one kind. Two texts that look the same have one skeleton.
    """
    d = unicodedata.normalize("NFD", text)
    out = []
    for ch in d:
        if _ignorable(ch):
            continue
        for p in unicodedata.normalize("NFD", _plain(ch)):
            p = PROTOTYPES.get(p) or TO_LATIN.get(p, p)
            out.append("".join(LOOSE.get(x, PROTOTYPES.get(x, x)) for x in p))
    return unicodedata.normalize("NFD", "".join(out))


def _word(word: str, text_scripts: set[str]) -> str:
    """A run of letters in one script: letters of another script that look like its own are put into it."""
    base = [c for c in word if c.isalpha()]
    scripts = {_script(c) for c in base} - {""}
    if len(scripts) == 1:
        s = next(iter(scripts))
        # wholly in look-alikes, in a text whose other letters are all Latin
        if s in ("CYRILLIC", "GREEK", "ARMENIAN") and all(c in TO_LATIN for c in base) and "LATIN" in text_scripts and f"{s}!" not in text_scripts:
            return "".join(TO_LATIN.get(c, c) for c in word)
        return word
    if not scripts:
        return word
    count = {s: sum(_script(c) == s for c in base) for s in scripts}
    for s, table in sorted((("LATIN", TO_LATIN), ("CYRILLIC", TO_CYRILLIC), ("GREEK", TO_GREEK)), key=lambda x: -count.get(x[0], 0)):
        if s in scripts and all(_script(c) == s or table.get(c) for c in base):
            return "".join(table.get(c) or c if _script(c) not in ("", s) else c for c in word)
    if "LATIN" in scripts or all(c in TO_LATIN for c in base):
        return "".join(TO_LATIN.get(c, c) for c in word)
    return word


@lru_cache(maxsize=200_000)
def consistent(text: str) -> str:
    """The one consistent form: no shapeless characters, ordinary blanks and letters, one script a word, composed (NFC).

    Joiners that a script's spelling requires stay. Case, spelling and words wholly in another script are untouched.
    """
    if text.isascii():
        return text
    kept = "".join("" if _ignorable(c) and not (c in JOINERS and _joiner_needed(text, i)) else _plain(c) for i, c in enumerate(text))
    kept = unicodedata.normalize("NFC", kept)
    scripts: set[str] = set()
    for c in kept:
        if s := _script(c):
            scripts.add(s)
            if s != "LATIN" and c not in TO_LATIN:
                scripts.add(f"{s}!")  # a letter that only this script has
    out, word = [], []
    for c in kept + "\0":
        if c.isalpha() or unicodedata.combining(c) and word:
            word.append(c)
        else:
            if word:
                out.append(_word("".join(word), scripts))
                word = []
            out.append(c)
    return unicodedata.normalize("NFC", "".join(out[:-1]))


def is_altered(text: str) -> bool:
    """Whether the text holds characters other than those of the ordinary writing of its words.

    A text is altered if it differs from its consistent form and looks the same, that is, has the same skeleton.
    """
    return not text.isascii() and text != (form := consistent(text)) and skeleton(text) == skeleton(form)


RESULT = T.StructType([T.StructField("skeleton", T.StringType()), T.StructField("form", T.StringType()), T.StructField("altered", T.BooleanType())])


def forms(text: Column, table: dict[str, str]) -> Column:
    """struct(skeleton, form, altered) of a text; null for a null. table: published_prototypes."""
    pairs = tuple(table.items())

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        use_prototypes(pairs)
        codes, unique = pd.factorize(texts, use_na_sentinel=True)
        done = pd.DataFrame({"skeleton": [skeleton(t) for t in unique], "form": [consistent(t) for t in unique], "altered": [is_altered(t) for t in unique]}, columns=["skeleton", "form", "altered"])
        out = done.reindex(codes).reset_index(drop=True)
        return out.astype({"skeleton": object, "form": object}).where(out.notna(), None)

    return run(text)


def _ascii_skeleton(text: Column, table: dict[str, str]) -> Column:
    """skeleton of an ASCII text in built-in expressions."""
    ascii_ = {chr(i): table.get(chr(i), chr(i)) for i in range(0x21, 0x7F)}
    ascii_ = {c: LOOSE.get(c) or "".join(LOOSE.get(x, x) for x in p) for c, p in ascii_.items()}
    one = {c: p for c, p in ascii_.items() if p != c and len(p) == 1}
    out = F.translate(text, "".join(one), "".join(one.values())) if one else text
    for c, p in ascii_.items():
        if len(p) > 1:
            out = F.replace(out, F.lit(c), F.lit(p))
    return out


def confusable_forms(df: DataFrame, ids: list[str], fields: list[str]) -> DataFrame:
    """(ids, field_name, text, skeleton, form, altered), one row per row and field; nulls are left out.

    ASCII texts need no Python: their form is the text. Empty texts are unaltered. Other columns are ignored.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"`{f}`").alias("text")) for f in fields])).alias("c")
    long = df.select(*[F.col(f"`{i}`") for i in ids], cells).select(*ids, "c.field_name", "c.text").where(F.col("text").isNotNull())
    plain = F.col("text").rlike("^[\\x00-\\x7F]*$")
    table = published_prototypes(df.sparkSession)
    ascii_ = long.where(plain).select("*", _ascii_skeleton(F.col("text"), table).alias("skeleton"), F.col("text").alias("form"), F.lit(False).alias("altered"))
    other = long.where(~plain).withColumn("f", forms(F.col("text"), table)).select(*ids, "field_name", "text", "f.skeleton", "f.form", "f.altered")
    return ascii_.unionByName(other)


def skeleton_groups(cells: DataFrame) -> DataFrame:
    """Groups of texts of equal skeleton: (field_name, skeleton, n_rows, n_writings, n_altered_rows, form).

    form is the consistent form that most rows of the group have, ties to the smaller. Counts are combined per writing
    first, so a text that fills a third of the rows is one row when groups are formed; no list of a group is collected.
    """
    per = cells.groupBy("field_name", "skeleton", "form", "text", "altered").agg(F.count(F.lit(1)).alias("n"))
    by_form = per.groupBy("field_name", "skeleton", "form").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("w"), F.sum(F.when(F.col("altered"), F.col("n")).otherwise(0)).alias("a"))
    return by_form.groupBy("field_name", "skeleton").agg(
        F.sum("n").alias("n_rows"), F.sum("w").alias("n_writings"), F.sum("a").alias("n_altered_rows"),
        F.min(F.struct((-F.col("n")).alias("n"), "form"))["form"].alias("form"),
    )


def altered_cells(cells: DataFrame, ids: list[str]) -> DataFrame:
    """(ids, field_name, against) of the rows of confusable_forms whose text is altered, each once.

    A candidate shares its skeleton with an ordinary writing of the same field, which is another text (against:
    "writing"), or, where no row holds one, with the prototype, its own consistent form ("prototype"). The script rule
    is the check after it. Ordinary writings are one row a skeleton, so a writing of many rows multiplies nothing.
    """
    other = cells.where(F.col("text").rlike("[^\\x00-\\x7F]"))
    ordinary = cells.where(~F.col("altered")).select("field_name", "skeleton").join(other.select("field_name", "skeleton").distinct(), ["field_name", "skeleton"], "left_semi").distinct()
    marked = other.join(ordinary.withColumn("known", F.lit(True)), ["field_name", "skeleton"], "left")
    return marked.where("altered").select(*ids, "field_name", F.when(F.col("known"), "writing").otherwise("prototype").alias("against")).distinct()
