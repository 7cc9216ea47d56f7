"""Addresses that name one building: parsing, expansion into hashes, shared-hash join, house-number rejection."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.confusables import consistent

# Words of street kinds in their writings, of units, landmarks and placeholders.
_KINDS = {
    "street": "street str st satarit ulitsa ul", "road": "road rd rod", "cross road": "crossroad", "lane": "lane ln len gali", "marg": "marg mrg marag",
    "nagar": "nagar ngr", "avenue": "avenue av ave", "boulevard": "boulevard blvd boul bd bulevard bul", "bazaar": "bazaar bazar bzr bajar",
    "layout": "layout lyt leaut", "highway": "highway hwy hway", "parkway": "parkway pky pkwy", "court": "court ct crt", "drive": "drive dr drv",
    "colony": "colony kaloni col cly", "allee": "allee all", "rue": "rue r", "quai": "quai q", "place": "place pl ploshtad", "impasse": "impasse imp",
    "chemin": "chemin ch che", "shosse": "shosse",
}
AFTER = {"rue", "allee", "quai", "chemin", "impasse", "place", "shosse"}
UNIT = re.compile(
    r"\b(?:shop|flat|gala|unit|ste|suite|apt|appt|app|apartment|etage|bat|batiment|floor|fl|room|office|ap|et|vh)\b[ .]*(?:no\b[ .]*|n°[ ]*|#[ ]*)?\d+ ?[a-z]?\b"
    r"|\b\d+ ?(?:st|nd|rd|th|e|er|eme)? ?(?:floor|etage)\b|\b(?:ground|first|second|third|top) floor\b"
)
LANDMARK = re.compile(r"\b(?:near|opp|opposite|behind|beside|next to)\b[^,;]*")
PLACEHOLDER = {"none", "null", "na", "nil", "unknown", "notavailable", "nan", "notapplicable", "tbd"}
NUMBER_MARK = re.compile(r"\b(?:h|house|plot|door|d)\b[. ]*(?:no\b[. ]*)?(?=\d)|\b(?:no|nr|num|n)\b[. ]*°?[ ]*(?=\d)|[#°№]")
_DEVA = dict(zip("अआइईउऊएऐओऔऑकखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसह", "a a i i u u e ai o au o k kh g gh n ch chh j jh n t th d dh n t th d dh n p ph b bh m y r l v sh sh s h".split()))
_SIGN = dict(zip("ािीुूृेैोौॉंँः", "a i i u u ri e ai o au o n n h".split()))
_CYR = dict(zip("абвгдежзийклмнопрстуфхцчшщъьюя", "a b v g d e zh z i y k l m n o p r s t u f h ts ch sh sht a y yu ya".split()))


def _deva(word: str) -> str:
    out = []
    for i, c in enumerate(word):
        if c in _DEVA:
            out.append(_DEVA[c])
            after = word[i + 1] if i + 1 < len(word) else ""
            if "क" <= c <= "ह" and after and after not in _SIGN and after not in "़्":
                out.append("a")
        elif c in _SIGN:
            out.append(_SIGN[c])
        elif c not in "़्":
            out.append(c)
    return "".join(out)


@lru_cache(maxsize=200_000)
def plain_text(text: str) -> str:
    """Consistent form, then lower case, without accents, in Latin letters and ASCII digits."""
    t = unicodedata.normalize("NFKC", consistent(text)).casefold()
    t = re.sub(r"[ऀ-ॣ॰-ॿ‌‍]+", lambda m: _deva(m[0].replace("‌", "").replace("‍", "")), t)
    t = "".join(c for c in unicodedata.normalize("NFD", "".join(_CYR.get(c, c) for c in t)) if not unicodedata.combining(c))
    return "".join(str(unicodedata.digit(c)) if c.isdigit() and not c.isascii() and unicodedata.digit(c, None) is not None else c for c in t)


def phonetic(word: str) -> str:
    """Writings of one sound made one: long vowels short, doubled letters single."""
    w = word.replace("ee", "i").replace("oo", "u").replace("w", "v")
    return re.sub(r"(.)\1+", r"\1", w)


def near(a: str, b: str, most: int) -> bool:
    """Whether a becomes b by at most `most` insertions, deletions, substitutions or swaps of neighbours."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    p0, p1 = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(p1[j] + 1, row[j - 1] + 1, p1[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], p0[j - 2] + 1)
        p0, p1 = p1, row
    return p1[-1] <= most


def _shortened(word: str) -> set:
    """The word and its writings with one letter left out; words one step apart share one of them."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


def _index(words) -> dict[str, list]:
    out: dict[str, list] = {}
    for w in words:
        for x in _shortened(w):
            out.setdefault(x, []).append(w)
    return out


def _one_step(index: dict[str, list], word: str) -> list:
    """Words of an index that are at most one step from word."""
    found = {w for x in _shortened(word) for w in index.get(x, ())}
    return [w for w in found if near(w, word, 1)]


class Parser:
    """Address to number, street, kind, places, postcode. Places come from place_names (older names included)."""

    def __init__(self, places: list):
        self.names: dict[str, set] = {}
        self.regions: set = set()
        self.codes: set = set()
        self.prefix: dict[str, set] = {}
        self.country: dict[int, str] = {}
        for p in places:
            for n in (p["place_name"], p["alt_name"]):
                if n:
                    self.names.setdefault(self._key(n), set()).add(p["place_id"])
            self.regions.add(self._key(p["region_name"] or ""))
            self.codes.add((p["region_code"] or "").lower())
            self.prefix.setdefault(p["postal_prefix"], set()).add(p["place_id"])
            self.country[p["place_id"]] = (p["country"] or "").strip().casefold()
        self.kinds = {w: k for k, ws in _KINDS.items() for w in ws.split()} | {k: k for k in _KINDS if " " not in k}
        self.by_sound = {phonetic(w): k for w, k in self.kinds.items() if len(w) > 3}
        self.cache: dict[str, set] = {}
        self.near_names = _index(n for n in self.names if len(n) >= 6)
        self.near_kinds = _index(k for k in self.kinds if len(k) > 4)
        self.place = {k: i for i, k in enumerate(self.kinds)}

    def _kind(self, word: str) -> str | None:
        """A kind of street one step from word, the first listed."""
        return min(_one_step(self.near_kinds, word), key=self.place.get, default=None)

    @staticmethod
    def _key(name: str) -> str:
        return phonetic(re.sub(r"[^a-z0-9]", "", plain_text(name)))

    def _town(self, key: str) -> set:
        """Place ids of a name, one misspelling allowed in names of six letters or more."""
        if key in self.names:
            return self.names[key]
        if len(key) < 6 or key in self.regions:
            return set()
        if key not in self.cache:
            self.cache[key] = set().union(*[self.names[n] for n in _one_step(self.near_names, key)])
        return self.cache[key]

    def parse(self, text: str, country: str | None):
        t = plain_text(text)
        if re.sub(r"[^a-z]", "", t) in PLACEHOLDER and not re.search(r"\d", t):
            return None, None, None, [], None, False
        t = UNIT.sub(" , ", LANDMARK.sub(" ", t))
        t = NUMBER_MARK.sub(" ", t)
        t = re.sub(r"\b(?:cross|x|ka?ros)[ .]+(?:road|rd|rod)\b", "crossroad", t)
        t = re.sub(r"\blay[ -]out\b", "layout", t)
        t = re.sub(r"['’`]", "", t)
        toks = re.findall(r"\d+[a-z]?\b|[^\W\d_]+|[,;]| - ", t.replace(" - ", " , "))
        used: list = [None] * len(toks)
        kind_at = [i for i, w in enumerate(toks) if w in self.kinds]
        named: set = set()
        for exact in (True, False):  # a town is up to four words; the longest and exact writings count first
            for n in (4, 3, 2, 1):
                for i in range(len(toks) - n, -1, -1):
                    part = toks[i : i + n]
                    if named or any(used[i : i + n]) or not all(w.isalpha() for w in part):
                        continue
                    if n == 1 and i in kind_at:
                        continue
                    key = phonetic("".join(part))
                    ids = self.names.get(key, set()) if exact else self._town(key)
                    if ids:
                        named = set(ids)
                        used[i : i + n] = ["town"] * n
        digits = [i for i, w in enumerate(toks) if w[0].isdigit() and not used[i]]
        codes = [i for i in digits if toks[i].isdigit() and len(toks[i]) >= 5]
        small = [i for i in digits if i not in codes and len(toks[i].rstrip("abcdefghijklmnopqrstuvwxyz")) <= 4]
        if not codes and (four := [i for i in small if toks[i].isdigit() and len(toks[i]) == 4]):
            pick = [i for i in four if toks[i][:2] in self.prefix and (not named or self.prefix[toks[i][:2]] & named)] or [i for i in four if toks[i][0] != "0"]
            if len(small) > 1 and pick or not named and pick and toks[pick[0]][0] != "0":
                codes = pick[:1]
                small = [i for i in small if i != codes[0]]
        postcode = toks[codes[0]] if codes else None
        home = (country or "").strip().casefold()
        coded: set = set()
        if postcode:
            for k in (3, 2):
                ids = self.prefix.get(postcode[:k], set())
                coded |= {i for i in ids if self.country[i] == home} if any(self.country[i] == home for i in ids) else set()
            if not coded:
                coded = set().union(*[self.prefix.get(postcode[:k], set()) for k in (3, 2)])
        if len(named) > 1:  # a misspelling that fits several towns
            named = named & coded or {i for i in named if self.country[i] == home} or named
        places = sorted(named or coded)
        for i, w in enumerate(toks):
            if not used[i] and w.isalpha() and i not in kind_at and (phonetic(w) in self.regions or w in self.codes):
                used[i] = "region"
        kind = core = None
        if not kind_at:
            kind_at = [i for i, w in enumerate(toks) if w.isalpha() and not used[i] and (phonetic(w) in self.by_sound or len(w) > 4 and self._kind(w))]
        free = lambda i: 0 <= i < len(toks) and toks[i].isalpha() and not used[i] and i not in kind_at and len(toks[i]) > 1
        for i in kind_at:
            if used[i]:
                continue
            w = toks[i]
            k = self.kinds.get(w) or self.by_sound.get(phonetic(w)) or self.kinds[self._kind(w)]
            for j in (i + 1, i - 1) if k in AFTER else (i - 1, i + 1):
                if free(j):
                    kind, core = k, phonetic(toks[j])
                    break
            if core:
                break
        if core is None:
            words = [phonetic(w) for i, w in enumerate(toks) if free(i)]
            core = "".join(words) if len(words) == 1 else None
        number = toks[small[0]].lstrip("0") if small else None
        return (number or None), core, kind, places, postcode, bool(named)


SCHEMA = "number string, street string, kind string, places array<int>, postcode string, named boolean"


@lru_cache(maxsize=4)
def _parser(rows: tuple) -> Parser:
    cols = ("place_id", "country", "place_name", "alt_name", "region_name", "region_code", "postal_prefix")
    return Parser([dict(zip(cols, r)) for r in rows])


def parsed_addresses(df: DataFrame, text: str, country: str, places: DataFrame) -> DataFrame:
    """df with a struct column `addr` of SCHEMA. places is the clean table of towns, whose size does not follow the data.

    A null, empty or placeholder address gives a struct of nulls and no places. A column addr of df is replaced.
    """
    cols = ("place_id", "country", "place_name", "alt_name", "region_name", "region_code", "postal_prefix")
    rows = tuple(tuple(r) for r in places.select(*cols).collect())

    @F.pandas_udf(SCHEMA)
    def parse(texts: pd.Series, countries: pd.Series) -> pd.DataFrame:
        parser = _parser(rows)
        out = [parser.parse(t, c) if isinstance(t, str) else (None, None, None, [], None, False) for t, c in zip(texts, countries)]
        return pd.DataFrame(out, columns=["number", "street", "kind", "places", "postcode", "named"])

    return df.withColumn("addr", parse(F.col(text), F.col(country)))


def _hashes():
    """Expansion: number, place and the street as it is, with one letter left out, and its two ends."""
    s, n = F.col("addr.street"), F.length("addr.street")
    less = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, n)))
    ends = F.array(F.concat(F.lit("<"), F.substring(s, 1, 5)), F.concat(F.lit(">"), F.substring(s, -5, 5)))
    streets = F.array_union(F.concat(F.array(s), less), ends)
    where = F.when(F.size("addr.places") > 0, F.transform("addr.places", lambda p: F.concat(F.lit("t"), p.cast("string")))).otherwise(F.array(F.concat(F.lit("p"), F.col("addr.postcode"))))
    return F.array_distinct(F.flatten(F.transform(where, lambda p: F.transform(streets, lambda x: F.xxhash64(F.col("addr.number"), p, x)))))


@F.pandas_udf(T.BooleanType())
def near_streets(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([x is not None and y is not None and near(x, y, 2 if min(len(x), len(y)) >= 9 else 1) for x, y in zip(a, b)])


def same_building(parsed: DataFrame, entity: str) -> DataFrame:
    """(entity_id_a, entity_id_b), smaller first: entities with an address of the same building, each pair once.

    parsed has `entity` and addr. Equal addresses are one row while hashes are joined, so that a building's many
    records meet only at the end. Rejected after the join: other house numbers, other kinds of street, other towns
    where both name one, other postcodes, and streets that are too far apart.
    Rows without an entity and addresses that do not name a building are left out; repeated rows count once; an entity
    is never paired with itself; other columns are ignored; an empty table gives an empty result.
    """
    whole = parsed.where(F.col(f"`{entity}`").isNotNull()).where("addr.number is not null and addr.street is not null and (size(addr.places) > 0 or addr.postcode is not null)").select(F.col(f"`{entity}`").alias("id"), "addr").distinct()
    key = F.xxhash64("addr.number", "addr.street", "addr.kind", "addr.places", "addr.postcode", "addr.named")
    members = whole.select("id", key.alias("k")).distinct()
    forms = whole.select(key.alias("k"), "addr").dropDuplicates(["k"])
    h = forms.select("k", "addr", F.explode(_hashes()).alias("h"))
    a, b = h.select(F.col("k").alias("ka"), F.col("addr").alias("x"), "h"), h.select(F.col("k").alias("kb"), F.col("addr").alias("y"), "h")
    pairs = a.join(b, "h").where("ka < kb and x.number = y.number").drop("h").dropDuplicates(["ka", "kb"])
    pairs = pairs.where("(x.kind is null or y.kind is null or x.kind = y.kind) and (size(x.places) = 0 or size(y.places) = 0 or arrays_overlap(x.places, y.places))")
    pairs = pairs.where("x.postcode is null or y.postcode is null or x.postcode = y.postcode")
    forms2 = pairs.where(near_streets(F.col("x.street"), F.col("y.street"))).select("ka", "kb")
    forms2 = forms2.unionByName(forms.select(F.col("k").alias("ka"), F.col("k").alias("kb")))
    ma, mb = members.select(F.col("k").alias("ka"), F.col("id").alias("a")), members.select(F.col("k").alias("kb"), F.col("id").alias("b"))
    out = forms2.join(ma, "ka").join(mb, "kb").where("a <> b")
    return out.select(F.least("a", "b").alias("entity_id_a"), F.greatest("a", "b").alias("entity_id_b")).distinct()
