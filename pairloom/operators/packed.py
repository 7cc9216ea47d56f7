"""Several values packed in one field: one row per value with its position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Placeholder marks, from the private use area: OPEN index CLOSE. Marks that a text itself holds are escaped first, so
#: that no text can be taken for a placeholder.
OPEN, CLOSE, ESC = "\ue000", "\ue001", "\ue002"

#: Characters that part values outside quotes.
DELIMITERS = ",;|/&+\\s ，；、｜"
#: Brackets that may stand around a whole list or a value; they are no part of it.
BRACKETS = "\\[\\]{}()<>"

#: An innermost quoted span: an opening quote, no quote of any kind inside, a closing quote of the same kind. Runs of
#: doubled quotes (quoted fields inside a quoted field) count as one quote.
QUOTED = "(\"+[^\"'“”‘’«»]*[^\"'“”‘’«»\\s,;|/][^\"'“”‘’«»]*\"+" \
         "|(?<![\\p{L}\\p{N}])'+[^\"'“”‘’«»]*[^\"'“”‘’«»\\s,;|/][^\"'“”‘’«»]*'+(?![\\p{L}\\p{N}])" \
         "|“[^“”]+”|‘[^‘’]+’|«[^«»]+»)"
QUOTE_MARKS = "\"'“”‘’«»\\\\"


def split_packed(cell: Column, delimiters: str = DELIMITERS, brackets: str = BRACKETS) -> Column:
    """array<string> of the values of a cell, in their order as written.

    Quoted spans are replaced by indexed placeholders, the rest is split at any run of delimiters, and the spans come
    back by array lookup; so a delimiter inside quotes splits nothing. Of nested quotes the innermost count. An apostrophe
    between letters is no quote. Empty values are left out. A null or empty cell gives an empty array. delimiters and brackets are the insides of regex
    character classes.
    """
    text = F.coalesce(cell.cast("string"), F.lit(""))
    safe = F.regexp_replace(text, f"[{OPEN}{CLOSE}{ESC}]", "")
    # marks of the text itself are rewritten as ESC + a letter; placeholders are OPEN digits CLOSE, so none collide
    safe = F.when(text == safe, text).otherwise(
        F.replace(F.replace(F.replace(text, F.lit(ESC), F.lit(ESC + "c")), F.lit(OPEN), F.lit(ESC + "a")), F.lit(CLOSE), F.lit(ESC + "b"))
    )
    spans = F.regexp_extract_all(safe, F.lit(QUOTED), F.lit(1))
    around = F.split(safe, QUOTED, -1)
    marked = F.array_join(
        F.transform(around, lambda p, i: F.when(i < F.size(spans), F.concat(p, F.lit(" " + OPEN), i.cast("string"), F.lit(CLOSE + " "))).otherwise(p)), ""
    )
    # marks that quote nothing part values, but for an apostrophe between letters
    bare = F.regexp_replace(F.regexp_replace(marked, f"[{brackets}]", " "), "[\"“”«»\\\\]|(?<!\\p{L})['‘’]|['‘’](?!\\p{L})", " ")
    tokens = F.filter(F.transform(F.split(bare, f"[{delimiters}]+", -1), lambda t: F.trim(t)), lambda t: t != "")
    strip = lambda s: F.regexp_replace(s, f"^[{QUOTE_MARKS}\\s ]+|[{QUOTE_MARKS}\\s ]+$", "")
    mark = lambda i: F.concat(F.lit(OPEN), i.cast("string"), F.lit(CLOSE))
    restored = F.transform(
        tokens,
        lambda t: F.when(
            t.contains(OPEN), F.trim(F.aggregate(F.sequence(F.lit(0), F.size(spans) - 1), t, lambda s, i: F.replace(s, mark(i), strip(F.get(spans, i)))))
        ).otherwise(t),
    )
    unescape = lambda s: F.replace(F.replace(F.replace(s, F.lit(ESC + "a"), F.lit(OPEN)), F.lit(ESC + "b"), F.lit(CLOSE)), F.lit(ESC + "c"), F.lit(ESC))
    return F.filter(F.transform(restored, unescape), lambda t: t != "")


def explode_packed(df: DataFrame, cell: str, value: str, pos: str = "pos", keep: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """One row per value of column `cell`: the columns `carry` (default: all but `cell`), `pos` from 1, `value`.

    keep: a regex; values that do not match it (placeholders such as "none") are skipped and not counted in `pos`.
    A value listed twice gives two rows; rows without a value give none. A clash of `pos` or `value` with a carried
    column is an error.
    """
    carry = [c for c in df.columns if c != cell] if carry is None else carry
    if {value, pos} & set(carry) or value == pos:
        raise ValueError(f"output columns {value}, {pos} clash with {carry}")
    values = split_packed(F.col(f"`{cell}`"))
    if keep:
        values = F.filter(values, lambda v: v.rlike(keep))
    out = df.select(*[F.col(f"`{c}`") for c in carry], F.posexplode(values).alias("__p", "__v"))
    return out.select(*[F.col(f"`{c}`") for c in carry], (F.col("__p") + 1).alias(pos), F.col("__v").alias(value))
