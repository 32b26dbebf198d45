"""Places of normalised characters in the raw text."""

from __future__ import annotations

import re
import sys
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from foliospark.functions.text import CONFUSABLES, JUNK, LIGATURES

_PIECES = re.compile(r"(?P<joined>(?<=[a-z])-\s+(?=[a-z]))|(?P<space>\s)|(?P<other>.)", re.DOTALL)
_JOINED = re.compile(r"(?<=[a-z])-\s+(?=[a-z])")
_PLAIN = CONFUSABLES | LIGATURES | dict.fromkeys(JUNK, "")


def normalised_offsets(raw: str) -> tuple[str, list[int]]:
    """The text that functions.text.normalise gives, and the place in raw of each of its characters: both letters of a ligature have the ligature's."""
    out, places = [], []
    for m in _PIECES.finditer(raw):
        if m["joined"]:
            continue
        for c in _PLAIN.get(m[0], " " if m["space"] else m[0].lower()):
            c = " " if c.isspace() else c.lower()
            if c != " " or (out and out[-1] != " "):
                out.append(c)
                places.append(m.start())
    n = len(out) - 1 if out and out[-1] == " " else len(out)
    return "".join(out[:n]), places[:n]


@cache
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """For each code point how many letters the normalised text has of it, and whether that is a space."""
    plain = lambda: (_PLAIN.get(c, c.lower()) for c in map(chr, range(sys.maxunicode + 1)))
    return np.fromiter(map(len, plain()), np.uint8), np.fromiter(map(str.isspace, plain()), bool)


def normalised_places(raw: str) -> np.ndarray:
    """The places of normalised_offsets, for a whole text at once."""
    counts, spaces = _kinds()
    code = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = counts[code]
    for m in _JOINED.finditer(raw):
        n[m.start() : m.end()] = 0
    at = np.flatnonzero(n)
    blank = spaces[code[at]]
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # of spaces in a row the first stays, and none at the beginning
    at, blank = at[keep], blank[keep]
    at = at[:-1] if len(at) and blank[-1] else at
    return np.repeat(at, n[at]).astype(np.int32)


@F.pandas_udf(ArrayType(IntegerType()))
def _offsets(raw: pd.Series) -> pd.Series:
    return raw.map(lambda x: normalised_places(x) if x is not None else None)


def offset_map(raw: Column) -> Column:
    """The place in raw (from 0) of each character of its normalised text; null stays null."""
    return _offsets(raw)
