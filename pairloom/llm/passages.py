"""Passages of known items inside long texts: a positional inverted index of the texts, probed from the rarest terms."""

from __future__ import annotations

import html
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.session import Workspace

ESCAPED = re.compile(r"\\+(?:u([0-9a-fA-F]{4})|[nrtbf])?")
TAG = re.compile(r"</?[A-Za-z][^<>]{0,300}>|<!--.*?-->", re.S)
CELL = re.compile(r"^(?:# ?%%.*|#? ?(?:In|Out) ?\[[ \d*]*\]:?|```\w*|~~~\w*)[ \t]*$", re.M)
COMMENT = re.compile(r"^[ \t]*(?:rem|REM|dnl)[ \t]+", re.M)
HYPHEN = re.compile(r"[-‐]\r?\n[ \t#>*/%;]*(?=[^\W\d_])")
EMPHASIS = re.compile(r"[*`~]+(?<=[^\W\d_][*`~])(?=[^\W\d_])|[*`~]{2,}(?=[^\W\d_])")
#: Characters of words: letters and digits of ASCII in lower case; everything else of ASCII becomes a blank.
_ASCII = {i: chr(i).lower() if chr(i).isalnum() else " " for i in range(128)}
_OTHER = re.compile(r"[^\w\x00-\x7f]+")
_SHAPELESS = re.compile("[­؀-؅؜۝܏᠎​-‏‪-‮⁠-⁯﻿￹-￻]+")
_STRINGS = ("source", "outputs", "text", "data", "evalue", "traceback", "attachments")

POSTINGS = "doc_id {id_type}, view int, term string, positions array<int>"


def _words(text: str) -> list[str]:
    """Runs of letters and digits, case folded; characters without a shape part nothing."""
    if text.isascii():
        return text.translate(_ASCII).split()
    t = _SHAPELESS.sub("", text)
    if not unicodedata.is_normalized("NFKC", t):
        t = unicodedata.normalize("NFKC", t)
    t = _OTHER.sub(" ", t.casefold())
    raw = t.encode("utf-8", "surrogatepass").translate(_BYTES)
    return raw.decode("utf-8", "surrogatepass").split()


_BYTES = bytes(ord(_ASCII[i]) if i < 128 else i for i in range(256))


def _strings(value: object) -> Iterator[str]:
    if isinstance(value, str):
        yield value
    elif isinstance(value, list):
        if value and all(isinstance(v, str) for v in value):
            yield "".join(value)
        else:
            for v in value:
                yield from _strings(v)
    elif isinstance(value, dict):
        for k, v in value.items():
            if k in _STRINGS or isinstance(v, str | list) and "/" in k:
                yield from _strings(v)


def _sources(text: str) -> str | None:
    """The cells' text of a notebook in JSON, outputs included; None for other texts."""
    if not text.lstrip()[:1] == "{":
        return None
    try:
        cells = json.loads(text).get("cells")
    except (ValueError, AttributeError, RecursionError):
        return None
    return "\n".join(s for c in cells for s in _strings(c)) if isinstance(cells, list) else None


def views(text: str) -> list[list[str]]:
    """The words of a text as written and as a reader sees them: without escapes, tags, cell marks and line hyphens.

    A passage counts if any view holds it, so that a sign that is mark-up in one notebook and text in another loses
    nothing. Views that come to the same words are given once.
    """
    base = _sources(text)
    out = [_words(text if base is None else base)]
    base = text if base is None else base
    seen = base
    if "\\" in seen:
        seen = ESCAPED.sub(lambda m: chr(int(m[1], 16)) if m[1] else " " if m[0][-1] in "nrtbf" else "", seen)
    if "&" in seen:
        seen = html.unescape(seen)
    if "[" in seen or "%%" in seen or "```" in seen or "~~~" in seen:
        seen = CELL.sub("", seen)
    if "rem" in seen or "REM" in seen or "dnl" in seen:
        seen = COMMENT.sub("", seen)
    spaced = TAG.sub(" ", seen) if "<" in seen else seen
    tight = TAG.sub("", seen) if "<" in seen else seen
    if "-\n" in tight or "-\r\n" in tight or "‐" in tight:
        tight = HYPHEN.sub("", tight)
    if "*" in tight or "`" in tight or "~" in tight:
        tight = EMPHASIS.sub("", tight)
    for t in dict.fromkeys((spaced, tight)):
        if t != base and (w := _words(t)) not in out:
            out.append(w)
    return out


def token_postings(texts: DataFrame, doc_id: str, text: str, vocabulary: frozenset[str] | None = None) -> DataFrame:
    """(doc_id, view, term, positions): where each term stands in each view of each text, positions in order from 0.

    vocabulary: the terms that will be looked up; others are counted in positions but not stored. None stores all.
    Null texts and texts without words give no rows; other columns are ignored.
    """
    docs = texts.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, where, offsets, at = [], [], [], [0], []
            for d, t in zip(batch.column(0), batch.column(1).to_pylist()):
                for v, words in enumerate(views(t)):
                    found: dict[str, list[int]] = {}
                    for p, w in enumerate(words):
                        if vocabulary is None or w in vocabulary:
                            if w in found:
                                found[w].append(p)
                            else:
                                found[w] = [p]
                    for w, ps in found.items():
                        ids.append(d.as_py())
                        where.append(v)
                        rows.append(w)
                        at += ps
                        offsets.append(len(at))
            positions = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(where, pa.int32()), pa.array(rows, pa.string()), positions], ["doc_id", "view", "term", "positions"])

    return docs.mapInArrow(run, POSTINGS.format(id_type=docs.schema["doc_id"].dataType.simpleString()))


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, k, term): the words of each item, k from 0."""

    @F.pandas_udf("array<string>")
    def words(col):
        return col.map(lambda t: _words(t) if isinstance(t, str) else [])

    return items.select(F.col(f"`{item_id}`").alias("item_id"), F.posexplode(words(F.col(f"`{text}`"))).alias("k", "term"))


def probes(terms: DataFrame, frequency: DataFrame, least: int) -> DataFrame:
    """(item_id, term, k, term2, k2): for every window of `least` words of an item its two rarest terms and their places.

    frequency: (term, df) of the texts. A window with a word that no text has is dropped: it cannot occur. Windows
    that share their rarest terms share a row.
    """
    t = terms.join(frequency, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    w = Window.partitionBy("item_id").orderBy("k").rowsBetween(0, least - 1)
    rare = t.withColumn("w", F.array_sort(F.collect_list(F.struct("df", "k", "term")).over(w)))
    rare = rare.where((F.size("w") == least) & (F.col("w")[0]["df"] > 0))
    second = F.col("w")[1] if least > 1 else F.col("w")[0]
    return rare.select("item_id", F.col("w")[0]["term"].alias("term"), F.col("w")[0]["k"].alias("k"), second["term"].alias("term2"), second["k"].alias("k2")).distinct()


def _spans(ks: Column, least: int, most: int) -> Column:
    """Whether some `least` of the sorted places lie within a span of `most` places."""
    return F.exists(F.sequence(F.lit(0), F.size(ks) - least), lambda i: F.element_at(ks, i + least) - F.element_at(ks, i + 1) < most)


def passages(
    spark: SparkSession, texts: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, least: int = 12, slop: int = 4, most_terms: int = 1_000_000,
) -> DataFrame:
    """(doc_id, item_id, kind, words): texts that hold a passage of an item; each pair once, with its best passage.

    kind "exact": at least `least` consecutive words of the item stand in the text one after another. "proximity": at
    least that many words of a stretch of `least` + `slop` item words stand at their places, others differ. words:
    words of the item at their places.

    The texts' postings are written once. Each window of an item is looked up by its rarest term, the list is
    intersected with that of its second rarest, shifted by their distance, and what is left with the lists of all the
    item's terms. Postings are one row a text and term, so no list of a frequent term comes into one task. Up to
    most_terms distinct terms of the items, only their postings are written and probes are broadcast; beyond that all
    terms are stored and every join is a shuffle. Null or short items and texts give no rows; repeated rows count once.
    """
    ws = Workspace(spark, "passages")
    terms = ws.write(item_terms(items, item_id, item_text).distinct(), "terms")
    known = terms.select("term").distinct()
    n = known.limit(most_terms + 1).count()
    small = n <= most_terms
    vocabulary = frozenset(r["term"] for r in known.collect()) if small else None  # at most most_terms rows
    post = ws.write(token_postings(texts, doc_id, text, vocabulary), "postings")
    df = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    probe = ws.write(probes(terms, df, least), "probes")
    bound = F.broadcast if small else (lambda x: x)
    # the rarest term of each window
    seeds = post.join(bound(probe), "term").select("doc_id", "view", "item_id", F.explode("positions").alias("p"), "k", "term2", "k2")
    seeds = seeds.select("doc_id", "view", "item_id", F.col("term2").alias("term"), (F.col("p") - F.col("k")).alias("shift"), F.col("k2").alias("k")).distinct()
    # the second rarest, shifted
    both = ws.write(_at_place(post.join(bound(probe.select(F.col("term2").alias("term")).distinct()), "term", "left_semi"), seeds).select("doc_id", "view", "item_id", "shift").distinct(), "both")
    # all terms of the items that are left, shifted
    full = both.join(bound(terms), "item_id")
    held = _at_place(post, full).groupBy("doc_id", "view", "item_id", "shift").agg(F.array_sort(F.collect_set("k")).alias("ks")).where(F.size("ks") >= least)
    kind = F.when(_spans(F.col("ks"), least, least), 2).when(_spans(F.col("ks"), least, least + slop), 1)
    best = held.select("doc_id", "item_id", kind.alias("kind"), F.size("ks").alias("words")).where("kind is not null")
    best = best.groupBy("doc_id", "item_id").agg(F.max(F.struct("kind", "words")).alias("b"))
    return best.select("doc_id", "item_id", F.when(F.col("b.kind") == 2, "exact").otherwise("proximity").alias("kind"), F.col("b.words").alias("words"))


def _at_place(post: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of wanted (doc_id, view, term, shift, k) whose term stands at shift + k."""
    return wanted.join(post, ["doc_id", "view", "term"]).where(F.array_contains("positions", F.col("shift") + F.col("k"))).drop("positions")
