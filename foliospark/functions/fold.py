"""Letters without their accents, and where they stand in the accented text."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_MARK, LAST_MARK = 0x300, 0x36F  # combining marks


@cache
def accents() -> tuple[str, str, str]:
    """(accented Latin letters, their plain letters, combining marks): every letter whose canonical decomposition is a-z and marks."""
    letters = [(chr(c), unicodedata.normalize("NFD", chr(c))) for c in range(0xC0, 0x2000)]
    pairs = [(c, d[0]) for c, d in letters if len(d) > 1 and d[0].isascii() and d[0].isalpha() and all(unicodedata.category(m) == "Mn" for m in d[1:])]
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs), "".join(map(chr, range(FIRST_MARK, LAST_MARK + 1)))


def folded(text: Column) -> Column:
    """The text with accented Latin letters made plain and combining marks dropped, so a mark never parts a word."""
    olds, news, marks = accents()
    return F.translate(text, olds + marks, news)


def folded_word(word: str) -> str:
    """folded() of one text."""
    olds, news, marks = accents()
    return word.translate(str.maketrans(olds, news, marks))


def fold_places(text: Column) -> Column:
    """The place (from 0) in text of each character of its folded text; null where every character keeps its place, as in all texts without combining marks."""
    mark = f"[\\x{{{FIRST_MARK:x}}}-\\x{{{LAST_MARK:x}}}]"
    kept = F.filter(F.transform(F.split(text, ""), lambda c, i: F.struct(c.alias("c"), i.alias("i"))), lambda x: ~x["c"].rlike(mark))
    return F.when(text.rlike(mark), F.transform(kept, lambda x: x["i"]))
