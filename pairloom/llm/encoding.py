"""Texts garbled by a wrong encoding: found and repaired by the round trip back through the encoding they were read in."""

from __future__ import annotations

import math
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Single-byte encodings in which UTF-8 is read by mistake.
READ_AS = ("cp1252", "latin-1", "cp1251", "mac_roman", "cp437", "cp850", "koi8_r", "cp1250", "iso8859_15", "cp1253", "cp1254", "cp866")
#: Cyrillic text in one encoding read as another: (read as, meant).
CROSSED = [(r, m) for m in ("cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic") for r in ("cp1251", "koi8_r", "cp1252", "latin-1", "cp866", "mac_roman", "cp437", "iso8859_5") if r != m]
#: Latin text of western Europe read as another encoding.
WEST = [(r, m) for m in ("cp1252", "cp850", "mac_roman") for r in ("cp1251", "mac_roman", "cp437", "cp850", "cp1252", "koi8_r", "cp1250", "cp1253") if r != m]
ACCENTS = set("äöüßéèêëàâáãåçñóòôõíìîïúùûøæœÄÖÜÉÈÊÀÂÁÃÇÑÓÔÕÍÎÚÛ")
#: Share of letters in Russian text, in thousandths.
RUSSIAN = dict(zip("оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё", (110, 85, 80, 74, 67, 63, 55, 47, 45, 44, 35, 32, 30, 28, 26, 20, 19, 17, 17, 16, 16, 14, 12, 10, 9, 7, 6, 5, 4, 3, 3, 1, 2)))
SEQUENCE = re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+")
RUN = re.compile(r"[^\x00-\x7f]+")
WORDS = re.compile(r"[^\x00-\x7f]{2,}(?:[ \-,][^\x00-\x7f]+)*")


@lru_cache(maxsize=100_000)
def _byte(ch: str, enc: str) -> int:
    """The byte of a character in enc; the C1 controls that cp1252 and its like leave open stand for themselves."""
    try:
        return ch.encode(enc)[0]
    except UnicodeEncodeError:
        return ord(ch) if enc[:2] == "cp" and enc[2:4] == "12" and 0x80 <= ord(ch) <= 0x9F else 0xFF


def _plausible(text: str) -> bool:
    return all(unicodedata.category(c)[0] in "LMNPS" or c in "\xa0\xad‍‌" for c in text)


def _common(c: str) -> bool:
    return c <= "ɏ" or "Ѐ" <= c <= "ԯ" or "ऀ" <= c <= "ॿ" or "‐" <= c <= "≥" or "─" <= c <= "╿"


@lru_cache(maxsize=64)
def _leads(enc: str) -> frozenset:
    """Characters that the first byte of a UTF-8 sequence becomes in enc."""
    return frozenset(bytes([b]).decode(enc, "ignore") for b in range(0xC2, 0xF5)) - {""}


@lru_cache(maxsize=200_000)
def _sequences(run: str, enc: str) -> tuple:
    """(start, end, original) of the UTF-8 sequences that a run of non-ASCII characters becomes in enc."""
    if not _leads(enc) & set(run):
        return ()
    out = []
    for m in SEQUENCE.finditer(bytes(_byte(c, enc) for c in run)):
        try:
            was = m[0].decode()
        except UnicodeDecodeError:
            continue
        if not _plausible(was) or enc not in ("cp1252", "latin-1", "mac_roman") and not all(_common(c) for c in was):
            continue
        out.append((m.start(), m.end(), was))
    return tuple(out)


def _utf8_pieces(text: str, start: int, end: int, enc: str):
    """(start, end, original) of the garbled pieces in a run of non-ASCII characters."""
    for s, e, was in _sequences(text[start:end], enc):
        a, b = start + s, start + e
        near_letter = a > 0 and text[a - 1].isalpha() or b < len(text) and text[b].isalpha()
        if enc == "cp866" and text[a].isalpha():  # its letters are bytes of a sequence too; its UTF-8 leads are box signs
            continue
        if len(was) == 1:
            if enc in ("cp1252", "latin-1"):
                if not (was.isalpha() or ord(was) > 0x2000 or was in "°±µ²³©®«»¿¡§·×ºª£¥\xa0"):
                    continue
                if was == "\xa0" and not text[a].isalpha():
                    continue
            elif not ((was in ACCENTS or ord(was) > 0x2000 and e - s == 3) and (near_letter or e - s == 3)):
                continue
            elif enc == "cp1251" and text[b - 1] in "ёЁ№«»–—…":
                continue
            elif enc in ("cp437", "cp850") and all("─" <= c <= "╿" for c in text[a:b]) and not near_letter:
                continue
        elif enc in ("cp437", "cp850", "cp866", "koi8_r") and all("─" <= c <= "▟" for c in text[a:b]):
            continue
        yield a, b, was


@lru_cache(maxsize=50_000)
def _weight(c: str) -> float:
    """How odd a character is in a sound text, without its neighbours."""
    if c < "\x80":
        return 0.0
    if c == "�" or c <= "\x9f":
        return 6.0
    if c.lower() in RUSSIAN:
        return 0.2 + math.log(110 / RUSSIAN[c.lower()])
    if unicodedata.category(c)[0] in "LM":
        return 1.0 if c in ACCENTS else 2.0
    return 2.0 if c in LAWFUL else 3.0


def garbling_cost(text: str) -> float:
    """How garbled a piece looks: odd characters, runs of accented letters, signs and capitals inside words."""
    cost, before = 0.0, " "
    for c in text:
        w = _weight(c)
        if w:
            if before >= "\x80" and c.isalpha() and before.isalpha() and c < "ɐ":
                w += 2.0
            if not c.isalnum() and before.isalpha():
                w += 1.0
            if c.isupper() and before.islower():
                w += 2.0
        cost += w
        before = c
    return cost


def _score(word: str) -> float:
    """Mean log share of the Russian letters of a text; other letters count as very rare."""
    letters = [c for c in word.lower() if c.isalpha()]
    return sum(math.log(RUSSIAN.get(c, 0.05)) for c in letters) / max(1, len(letters))


@lru_cache(maxsize=100_000)
def _crossed(piece: str) -> str | None:
    if sum(c.isalpha() for c in piece) < 5 or all(a < b for a, b in zip(piece, piece[1:])):
        return None
    here, best = _score(piece), None
    if here + 0.4 >= math.log(110):  # no text scores higher
        return None
    mixed = [w for w in piece.split() if len(w) > 1 and w[0].islower() and w[1:].isupper()]
    for read, meant in CROSSED:
        try:
            was = piece.encode(read).decode(meant)
        except UnicodeError:
            continue
        letters = [c for c in was if c.isalpha()]
        if not letters or not all("Ѐ" <= c <= "ӿ" for c in letters) or len(letters) < 0.8 * len(was.replace(" ", "")):
            continue
        if all(a <= b for a, b in zip(letters, letters[1:])) or sum(c.islower() for c in letters[1:]) < 0.6 * len(letters[1:]):
            continue
        s = _score(was)
        if s > max(here + (0.4 if mixed else 0.7), 3.0) and (best is None or s > best[0]):
            best = (s, was)
    return best[1] if best else None


def _crossed_pieces(text: str):
    """Pieces of Cyrillic text read in another single-byte encoding: letters far from Russian before, near after."""
    for m in WORDS.finditer(text):
        if was := _crossed(m[0]):
            yield m.start(), m.end(), was


MIXED = re.compile(r"(?<=[A-Za-z])[^\x00-\x7f]{1,2}(?=[A-Za-z])|\b[^\x00-\x7f](?=[a-z]{2})|(?<=[a-z]{2})[^\x00-\x7f]\b")
UNIT = re.compile(r"(?<=\d )[^\x00-\x7f°µμº](?=[CFsm]\b)")
#: Letters of western languages and what stands in words lawfully; not taken for garbled.
LAWFUL = ACCENTS | set("ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœŒšžŠŽ’‘“”„–—…·ªº°µ«»¿¡\xa0\xad€§²³±≈≤≥×−•→✓≠√∑")


@lru_cache(maxsize=100_000)
def _west(run: str) -> tuple:
    """((read as, meant), original) for every pair of western encodings that the run passes through."""
    out = []
    for read, meant in WEST:
        try:
            out.append(((read, meant), run.encode(read).decode(meant)))
        except UnicodeError:
            continue
    return tuple(out)


def _west_pieces(text: str):
    """Single letters inside Latin words that are accented letters in another encoding; look-alikes are left alone."""
    hits: dict[tuple, list] = {}
    for m in MIXED.finditer(text):
        c, a, b = m[0], m.start(), m.end()
        inside = a > 0 and text[a - 1].islower() and b < len(text) and text[b].islower()
        if any(x == "�" or "ऀ" <= x for x in c) and not all(unicodedata.category(x)[0] == "S" for x in c):
            continue
        if any(x in LAWFUL and not (inside and x.isupper()) for x in c):
            continue
        for pair, was in _west(c):
            if all(x in ACCENTS for x in was):
                hits.setdefault(pair, []).append((m.start(), m.end(), was))
    pair = max(hits, key=lambda k: len(hits[k]), default=None)
    best = hits.get(pair, [])
    sure = [h for h in best if not text[h[0] : h[1]].isalpha()]  # a sign inside a word
    if len(best) >= 2 or sure:
        for m in re.finditer(r"[^\x00-\x7f]", text):
            was = dict(_west(m[0])).get(pair)
            if was is None:
                continue
            beside = text[max(0, m.start() - 1) : m.start()].isalpha() or text[m.end() : m.end() + 1].isalpha()
            if was in ACCENTS and beside:
                yield m.start(), m.end(), was
        return
    for m in UNIT.finditer(text):
        for _, was in _west(m[0]):
            if was in ("°", "µ"):
                yield m.start(), m.end(), was
                return
    for m in RUN.finditer(text):  # a list of accented letters in the order of their codes
        if len(m[0]) < 6 or list(m[0]) == sorted(m[0]):
            continue
        for _, was in _west(m[0]):
            if len(was) >= 6 and len(set(was)) == len(was) and all("À" <= x <= "ÿ" and x <= y for x, y in zip(was, was[1:])):
                yield m.start(), m.end(), was
                return


def _drop(text: str, a: int, b: int, was: str) -> float:
    """By how much the garbling cost drops, the neighbours included."""
    left, right = text[max(0, a - 1) : a], text[b : b + 1]
    return garbling_cost(left + text[a:b] + right) - garbling_cost(left + was + right)


def _cheaper(text: str, a: int, b: int, was: str) -> bool:
    return _drop(text, a, b, was) > 0


@lru_cache(maxsize=1024)
def repaired(text: str) -> tuple[str, bool]:
    """(text with its garbled pieces repaired, whether any piece is garbled).

    Each layer: the text is put back into the encodings it may have been read in, strictly decoded as what it was, and
    a piece is replaced where the garbling cost drops. Up to four layers are undone.
    """
    if text.isascii():
        return text, False
    garbled = False
    for _ in range(4):
        pieces: list = []
        best: dict[str, list] = {}
        chars = set(text)
        runs = [(m.start(), m.end()) for m in RUN.finditer(text)]
        for enc in READ_AS:
            best[enc] = [] if not _leads(enc) & chars else [p for a, b in runs for p in _utf8_pieces(text, a, b, enc) if _cheaper(text, *p)]
        taken = [False] * len(text)
        for enc in sorted(READ_AS, key=lambda e: -sum(_drop(text, *p) for p in best[e])):
            for a, b, was in best[enc]:
                if not any(taken[a:b]):
                    taken[a:b] = [True] * (b - a)
                    pieces.append((a, b, was))
        if not pieces:
            pieces = [p for p in _crossed_pieces(text) if _cheaper(text, *p)]
        if not pieces:  # single letters tell little by themselves: their costs are summed over the text
            pieces = list(_west_pieces(text))
            pieces = pieces if sum(_drop(text, *p) for p in pieces) > 0 or any(b - a >= 6 for a, b, _ in pieces) else []
        if not pieces:
            break
        garbled = True
        out, at = [], 0
        for a, b, was in sorted(pieces):
            if a >= at:
                out += [text[at:a], was]
                at = b
        text = "".join([*out, text[at:]])
    return text, garbled or bool(LOST.search(text))


#: Marks of bytes that were lost: the replacement character beside a letter or another one, C1 controls in words.
LOST = re.compile(r"(?<=\w)�|�(?=\w)|�\s*�|ï¿½|(?<=[^\W\d_])[\x80-\x84\x86-\x9f]|[\x80-\x84\x86-\x9f](?=[^\W\d_])")
RESULT = T.StructType([T.StructField("garbled", T.BooleanType()), T.StructField("original", T.StringType())])


@F.pandas_udf(RESULT)
def _repair(texts: pd.Series) -> pd.DataFrame:
    out = [repaired(t) if isinstance(t, str) else (None, False) for t in texts]
    return pd.DataFrame({"garbled": [g for _, g in out], "original": pd.Series([t for t, _ in out], dtype=object)})


def repair(text: Column) -> Column:
    """struct(garbled, original): original is the text with its garbled pieces repaired where that is possible.

    A null gives (false, null), an empty or sound text (false, the text). A piece whose bytes are lost is garbled and
    stays as it is.
    """
    return _repair(text)
