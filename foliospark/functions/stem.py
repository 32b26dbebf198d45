"""The Porter stemmer (M. F. Porter, "An algorithm for suffix stripping", 1980), for distinct words."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the published algorithm: suffixes and what they become in steps 2 and 3, and those that step 4 drops.
STEP_2 = dict(
    ational="ate", tional="tion", enci="ence", anci="ance", izer="ize", abli="able", alli="al", entli="ent", eli="e", ousli="ous",
    ization="ize", ation="ate", ator="ate", alism="al", iveness="ive", fulness="ful", ousness="ous", aliti="al", iviti="ive", biliti="ble",
)
STEP_3 = dict(icate="ic", ative="", alize="al", iciti="ic", ical="ic", ful="", ness="")
STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def _shape(stem: str) -> str:
    """v for each vowel, c for each consonant; y is a vowel after a consonant."""
    out = ""
    for i, c in enumerate(stem):
        out += "v" if c in "aeiou" or (c == "y" and i and out[-1] == "c") else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _short_end(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def porter(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters stay."""
    if len(word) < 3:
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    cut = None
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    elif word.endswith("ed") and "v" in _shape(word[:-2]):
        cut = word[:-2]
    elif word.endswith("ing") and "v" in _shape(word[:-3]):
        cut = word[:-3]
    if cut is not None:
        word = cut
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
            word = word[:-1]
        elif _measure(word) == 1 and _short_end(word):
            word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for table in (STEP_2, STEP_3):
        s = _longest(word, table)
        if s and _measure(word[: -len(s)]) > 0:
            word = word[: -len(s)] + table[s]
    s = _longest(word, STEP_4)
    if s and _measure(word[: -len(s)]) > 1 and (s != "ion" or word[: -len(s)].endswith(("s", "t"))):
        word = word[: -len(s)]
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


def _stems(words: pd.Series) -> pd.Series:
    return words.map(lambda w: porter(w) if w is not None else None)


def stemmed(words: Column) -> Column:
    """The stems of a column of words; for tables of distinct words."""
    return F.pandas_udf(_stems, "string")(words)
