"""Similarities of strings in pairs of records.

Lengths of longest common subsequences are computed on whole machine words of bits in Arrow batches (one pass of the
second string over bit masks of the first); all scores of a pair come from one call, so a batch crosses to Python once.
Scores are 0 to 100 unless said otherwise. Null counts as empty; a score with one empty side is 0, with two empty sides
100 for ratio and token_sort_ratio, 0 for the set and partial scores.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    if a == b:
        return len(a)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        hit = free & where.get(c, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


@lru_cache(maxsize=100_000)
def ratio(a: str, b: str) -> float:
    """Twice the common subsequence by the sum of lengths."""
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


@lru_cache(maxsize=100_000)
def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among the words in common and the words in common with the others of either side."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    left, right = (" ".join(filter(None, (both, " ".join(sorted(z))))) for z in (x - y, y - x))
    return max(ratio(left, right), *((ratio(both, left), ratio(both, right)) if both else (0.0,)))


@lru_cache(maxsize=100_000)
def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with a stretch of the longer one, stretches cut short at both ends included."""
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    if a in b:
        return 100.0
    n, letters, best = len(a), set(a), 0.0
    for start in range(1 - n, len(b)):
        part = b[max(0, start) : start + n]
        if (part[-1] in letters if start <= 0 else part[0] in letters) or len(part) == n and part[-1] in letters:
            best = max(best, ratio(a, part))
    if len(a) == len(b):
        for start in range(1 - n, n):
            best = max(best, ratio(b, a[max(0, start) : start + n]))
    return best


def partial_token_set_ratio(a: str, b: str) -> float:
    """100 where the sides share a word; else the partial ratio of their words in order of the alphabet."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    return 100.0 if x & y else partial_ratio(" ".join(sorted(x)), " ".join(sorted(y)))


@lru_cache(maxsize=100_000)
def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity from 0 to 1, raised by up to four equal first letters where it is above 0.7."""
    if not a or not b:
        return 1.0 if a == b else 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(left, (c for c, u in zip(b, used) if u))) // 2
    s = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return s + 0.1 * same * (1 - s) if s > 0.7 else s


@lru_cache(maxsize=100_000)
def _trigrams(text: str) -> tuple[Counter, float]:
    """Trigrams of every word with a blank on both sides, and the length of their vector."""
    n = Counter(f" {w} "[i : i + 3] for w in text.split() for i in range(len(w)))
    return n, math.sqrt(sum(x * x for x in n.values()))


def trigram_cosine(a: str, b: str) -> float:
    """Cosine of the trigram counts, from 0 to 1; 0 where one side is empty."""
    (x, p), (y, q) = _trigrams(a), _trigrams(b)
    return sum(n * y[g] for g, n in x.items() if g in y) / (p * q) if p and q else 0.0


SCORES = {
    "ratio": ratio, "token_set": token_set_ratio, "token_sort": token_sort_ratio, "partial": partial_ratio, "partial_token_set": partial_token_set_ratio, "jaro_winkler": jaro_winkler,
    "trigram_cosine": trigram_cosine,
}


def scores(wanted: dict[str, tuple[str, Column, Column]]) -> Column:
    """struct of doubles by name: name to (score of SCORES, left text, right text). One call for all."""
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in wanted])
    names, kinds = list(wanted), [SCORES[k] for k, _, _ in wanted.values()]

    @F.pandas_udf(schema)
    def run(*cols: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({n: [f(a, b) for a, b in zip(cols[2 * i], cols[2 * i + 1])] for i, (n, f) in enumerate(zip(names, kinds))}, dtype=float)

    texts = [F.coalesce(c, F.lit("")) for _, a, b in wanted.values() for c in (a, b)]
    return run(*texts)


def cheap_similarity(pairs: DataFrame, out: str = "similarity") -> DataFrame:
    """pairs (views q_* and t_*: name_core, name_phon, addr_norm, nums) with a similarity from 0 to 1.

    The stronger of two ways: name, address and sound together (name and sound where an address is absent), or the
    address with its numbers, for records whose name is of no use.
    """
    c = F.col
    s = pairs.withColumn("__s", scores({
        "n": ("token_set", c("q_name_core"), c("t_name_core")), "a": ("token_set", c("q_addr_norm"), c("t_addr_norm")),
        "p": ("ratio", c("q_name_phon"), c("t_name_phon")), "d": ("token_set", c("q_nums"), c("t_nums")),
    }))
    n, a, p, d = (c(f"__s.{x}") / 100 for x in "napd")
    absent = (c("q_addr_norm") == "") | (c("t_addr_norm") == "")
    by_name = F.when(absent, 0.75 * n + 0.25 * p).otherwise(0.55 * n + 0.30 * a + 0.15 * p)
    by_addr = F.when(absent, 0.0).otherwise(0.95 * F.when((c("q_nums") != "") & (c("t_nums") != ""), 0.6 * a + 0.4 * d).otherwise(0.85 * a))
    return s.withColumn(out, F.greatest(by_name, by_addr)).drop("__s")


# in built-in expressions

def overlap(a: Column, b: Column) -> dict[str, Column]:
    """shared, q, t, jac and conflict (both given, nothing shared) of two arrays of distinct words."""
    shared, both = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return {
        "shared": shared, "q": F.size(a), "t": F.size(b), "jac": F.when(both > 0, shared / both).otherwise(F.lit(0.0)),
        "conflict": ((F.size(a) > 0) & (F.size(b) > 0) & (shared == 0)).cast("int"),
    }


def left_over(words: Column, others: Column) -> Column:
    """Words beyond their number in others, in order (a difference of multisets)."""
    nth = lambda i: F.size(F.filter(F.slice(words, 1, i + 1), lambda x: x == F.get(words, i)))
    return F.filter(words, lambda w, i: nth(i) > F.size(F.filter(others, lambda x: x == w)))
