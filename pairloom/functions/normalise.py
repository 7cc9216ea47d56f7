"""Views of a business record: names and addresses cleaned, abbreviations expanded, cores, sounds, numbers and codes.

All of it is built-in expressions; `*_sql` functions give the same rules as DuckDB SQL for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import vocabulary as V
from pairloom.functions.latin import to_latin, to_latin_sql

VIEWS = ("name_norm", "name_core", "name_phon", "addr_norm", "nums", "postal", "codes", "translit", "addr_missing")
_FOREIGN = "[^\\x{0000}-\\x{02FF}]"


def _map(table: dict[str, str]) -> Column:
    quoted = ["'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for kv in table.items() for x in kv]
    return F.expr(f"map({', '.join(quoted)})")


def _words(text: Column) -> Column:
    """Words of a cleaned text; none for an empty one."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def _plain(text: Column) -> Column:
    """Lower case Latin letters without blanks at the ends."""
    return F.regexp_replace(F.lower(to_latin(F.coalesce(text.cast("string"), F.lit("")))), "^\\s+|\\s+$", "")


def _separated(s: Column) -> Column:
    """Separators made one: [a-z0-9 ] only."""
    t = F.replace(F.replace(F.replace(F.replace(s, F.lit("&"), F.lit(" and ")), F.lit("@"), F.lit(" at ")), F.lit("+"), F.lit(" and ")), F.lit("'"), F.lit(""))
    t = F.regexp_replace(t, f"\\b({'|'.join(V.MARKERS)})[.\\-/:#]+(?=[0-9])", "$1 ")
    t = F.regexp_replace(t, "(?<=[a-z])[\\-/.](?=[0-9])|(?<=[0-9])[\\-/.](?=[a-z])", "")
    return F.trim(F.regexp_replace(t, "[^a-z0-9]+", " "))


def _present(plain: Column, separated: Column) -> Column:
    absent = [F.lit(x) for x in V.MISSING]
    return F.when(plain.isin(*absent) | separated.isin(*absent), "").otherwise(separated)


def clean(text: Column) -> Column:
    """Lower case, Latin letters, separators made one: [a-z0-9 ] only. "" for null and for writings of an absent value."""
    return _present(_plain(text), _separated(_plain(text)))


def translit_flag(text: Column) -> Column:
    """Whether any character lies above U+02FF."""
    return F.coalesce(text.rlike(_FOREIGN), F.lit(False))


def join_initials(text: Column) -> Column:
    """Runs of single letters become one word: "m g road" gives "mg road"."""
    return F.regexp_replace(text, "(?<=\\b[a-z]) (?=[a-z]\\b)", "")


def expand(words: Column, table: dict[str, str]) -> Column:
    """Words replaced by a table, once; a value of several words gives several, an empty one none."""
    m = _map(table)
    return F.filter(F.flatten(F.transform(words, lambda t: F.split(F.coalesce(F.try_element_at(m, t), t), " "))), lambda t: t != "")


def phonetic(word: Column) -> Column:
    """Skeleton of a word by sound: folds in order, vowels and h left out after the first letter, repeats single."""
    s = word
    for a, b in V.PHONETIC:
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.concat(F.substring(s, 1, 1), F.regexp_replace(F.substring(s, 2, 1 << 30), "[aeiouh]", ""))
    return F.when(word.rlike("^[0-9]*$"), word).otherwise(F.regexp_replace(s, "(.)\\1+", "$1"))


def _phonetic_text(word: str) -> str:
    """phonetic of a fixed word."""
    for a, b in V.PHONETIC:
        word = word.replace(a, b)
    kept = word[0] + "".join(c for c in word[1:] if c not in "aeiouh")
    return "".join(c for i, c in enumerate(kept) if i == 0 or c != kept[i - 1])


_LEGAL_SOUNDS = tuple(sorted({_phonetic_text(w) for w in V.LEGAL_BY_SOUND}))


def skeleton(text: Column) -> Column:
    """Every vowel of every word left out; a word of vowels alone stays."""
    bare = lambda t: F.regexp_replace(t, "[aeiou]", "")
    return F.array_join(F.transform(_words(text), lambda t: F.when(bare(t) == "", t).otherwise(bare(t))), " ")


def core_words(words: Column) -> Column:
    """Words without legal forms, also those that sound like one among the last two; all words where none is left."""
    legal = [F.lit(x) for x in V.LEGAL]
    last = F.size(words) - 1
    by_sound = lambda t, i: (i > 0) & (i >= last - 1) & (F.length(t) >= 5) & phonetic(t).isin(*_LEGAL_SOUNDS)
    kept = F.filter(words, lambda t, i: ~t.isin(*legal) & ~by_sound(t, i))
    return F.when(F.size(kept) == 0, words).otherwise(kept)


def region_codes(text: Column) -> Column:
    """Names of regions of several words replaced by their codes, longest first."""
    out = text
    for k in sorted(V.STATE_MULTI, key=len, reverse=True):
        out = F.regexp_replace(out, f"\\b{k}\\b", V.STATE_MULTI[k])
    return F.when(text.rlike(f"\\b({'|'.join(V.STATE_MULTI)})\\b"), out).otherwise(text)


def address_words(cleaned: Column) -> Column:
    """Words of an address: ordinals to digits, then regions to codes, then abbreviations. The order is part of the result."""
    states = _map(V.STATE_SINGLE)
    single = F.transform(
        F.transform(_words(join_initials(region_codes(cleaned))), lambda t: F.regexp_replace(t, "^([0-9]+)(?:st|nd|rd|th)$", "$1")),
        lambda t: F.coalesce(F.try_element_at(states, t), t),
    )
    return expand(single, V.ADDR_ABBREV)


def digit_runs(words: Column) -> Column:
    """Runs of digits in order, without leading zeros."""
    return F.transform(F.regexp_extract_all(F.array_join(words, " "), F.lit("([0-9]+)"), 1), lambda d: F.regexp_replace(d, "^0+(?=.)", ""))


def normalise(df: DataFrame, name: str = "business_name", addr: str = "business_address") -> DataFrame:
    """df with the columns of VIEWS: name_norm, name_core, name_phon, addr_norm, nums, postal and codes (words parted by
    blanks, the last three sorted and distinct), translit and addr_missing (0 or 1).

    Null and absent names and addresses give empty views; columns of df with the name of a view are replaced.
    """
    helpers = ["__np", "__ap", "__ns", "__as", "__n", "__a", "__nw", "__aw", "__cw", "__nums"]
    # step by step, so that no step is computed again for each of its uses
    out = df.withColumns({"__np": _plain(F.col(f"`{name}`")), "__ap": _plain(F.col(f"`{addr}`"))})
    out = out.withColumns({"__ns": _separated(F.col("__np")), "__as": _separated(F.col("__ap"))})
    out = out.withColumns({"__n": _present(F.col("__np"), F.col("__ns")), "__a": _present(F.col("__ap"), F.col("__as")), "translit": (translit_flag(F.col(f"`{name}`")) | translit_flag(F.col(f"`{addr}`"))).cast("tinyint")})
    out = out.withColumns({"__nw": expand(_words(join_initials(F.col("__n"))), V.NAME_ABBREV), "__aw": address_words(F.col("__a"))})
    out = out.withColumns({"__cw": core_words(F.col("__nw")), "__nums": digit_runs(F.concat("__aw", "__nw"))})
    filler = [F.lit(x) for x in V.ADDR_FILLER]
    text = lambda words: F.array_join(words, " ")
    distinct = lambda words: text(F.array_sort(F.array_distinct(words)))
    out = out.withColumns({
        "name_norm": text(F.col("__nw")), "name_core": text(F.col("__cw")), "name_phon": text(F.transform("__cw", phonetic)),
        "addr_norm": text(F.filter("__aw", lambda t: ~t.isin(*filler))), "nums": distinct(F.col("__nums")),
        "postal": distinct(F.filter("__nums", lambda d: F.length(d).between(5, 6))),
        "codes": distinct(F.filter(F.concat("__aw", "__nw"), lambda t: t.rlike("[0-9]") & ~t.rlike("^[0-9]+$"))),
    })
    return out.withColumn("addr_missing", (F.col("addr_norm") == "").cast("tinyint")).drop(*helpers)


# the same rules in SQL

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(map(_q, values)) + ")"


def _case(word: str, table: dict[str, str]) -> str:
    return f"case {word} " + " ".join(f"when {_q(k)} then {_q(v)}" for k, v in table.items()) + f" else {word} end"


def phonetic_sql(word: str) -> str:
    s = word
    for a, b in V.PHONETIC:
        s = f"replace({s}, {_q(a)}, {_q(b)})"
    return f"case when regexp_matches({word}, '^[0-9]*$') then {word} else list_reduce(list_prepend('', string_split(left({s}, 1) || regexp_replace(substr({s}, 2), '[aeiouh]', '', 'g'), '')), lambda x, y: case when right(x, 1) = y then x else x || y end) end"


def clean_sql(text: str) -> str:
    s = f"regexp_replace(lower({to_latin_sql(f'coalesce({text}, {_q('')})')}), '^\\s+|\\s+$', '', 'g')"
    t = f"replace(replace(replace(replace({s}, '&', ' and '), '@', ' at '), '+', ' and '), '''', '')"
    t = f"regexp_replace({t}, '\\b({'|'.join(V.MARKERS)})[.\\-/:#]+([0-9])', '\\1 \\2', 'g')"
    t = f"regexp_replace(regexp_replace({t}, '([a-z])[\\-/.]([0-9])', '\\1\\2', 'g'), '([0-9])[\\-/.]([a-z])', '\\1\\2', 'g')"
    t = f"trim(regexp_replace({t}, '[^a-z0-9]+', ' ', 'g'))"
    return f"case when {s} in {_list(V.MISSING)} or {t} in {_list(V.MISSING)} then '' else {t} end"


def _initials_sql(text: str) -> str:
    return f"replace(replace(replace(regexp_replace({text}, '\\b([a-z])\\b', '<\\1>', 'g'), '> <', ''), '<', ''), '>', '')"


def _split_sql(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda t: t <> '')"


def _expand_sql(words: str, table: dict[str, str]) -> str:
    return f"list_filter(flatten(list_transform({words}, lambda t: string_split({_case('t', table)}, ' '))), lambda t: t <> '')"


def normalise_sql(source: str, name: str = "business_name", addr: str = "business_address") -> str:
    """CTEs that end in `norm`: the rows of relation `source` with the columns of VIEWS."""
    regions = "a"
    for k in sorted(V.STATE_MULTI, key=len, reverse=True):
        regions = f"regexp_replace({regions}, '\\b{k}\\b', {_q(V.STATE_MULTI[k])}, 'g')"
    ordinal = "regexp_replace(t, '^([0-9]+)(st|nd|rd|th)$', '\\1')"
    single = f"list_transform(list_transform({_split_sql(_initials_sql(regions))}, lambda t: {ordinal}), lambda t: {_case('t', V.STATE_SINGLE)})"
    sound = f"(i > 1 and i >= len(nw) - 1 and length(t) >= 5 and {phonetic_sql('t')} in {_list(_LEGAL_SOUNDS)})"
    distinct = lambda x: f"array_to_string(list_sort(list_distinct({x})), ' ')"
    return f"""n0 as (select *, {clean_sql(name)} n, {clean_sql(addr)} a, regexp_matches(coalesce({name}, ''), '[^\\x{{0000}}-\\x{{02FF}}]') or regexp_matches(coalesce({addr}, ''), '[^\\x{{0000}}-\\x{{02FF}}]') tr from {source}),
 n1 as (select *, {_expand_sql(_split_sql(_initials_sql('n')), V.NAME_ABBREV)} nw, {_expand_sql(single, V.ADDR_ABBREV)} aw from n0),
 n2 as (select *, list_filter(nw, lambda t, i: t not in {_list(V.LEGAL)} and not {sound}) kept, list_transform(regexp_extract_all(array_to_string(list_concat(aw, nw), ' '), '[0-9]+'), lambda d: regexp_replace(d, '^0+([0-9])', '\\1')) ns from n1),
 n3 as (select *, case when len(kept) = 0 then nw else kept end cw from n2),
 norm as (select * exclude (n, a, tr, nw, aw, kept, ns, cw), array_to_string(nw, ' ') name_norm, array_to_string(cw, ' ') name_core, array_to_string(list_transform(cw, lambda t: {phonetic_sql('t')}), ' ') name_phon,
  array_to_string(list_filter(aw, lambda t: t not in {_list(V.ADDR_FILLER)}), ' ') addr_norm, {distinct('ns')} nums, {distinct('list_filter(ns, lambda d: length(d) between 5 and 6)')} postal,
  {distinct("list_filter(list_concat(aw, nw), lambda t: regexp_matches(t, '[0-9]') and not regexp_matches(t, '^[0-9]+$'))")} codes, cast(tr as tinyint) translit,
  cast(len(list_filter(aw, lambda t: t not in {_list(V.ADDR_FILLER)})) = 0 as tinyint) addr_missing from n3)"""


def skeleton_sql(text: str) -> str:
    return f"array_to_string(list_transform({_split_sql(text)}, lambda t: case when regexp_replace(t, '[aeiou]', '', 'g') = '' then t else regexp_replace(t, '[aeiou]', '', 'g') end), ' ')"
