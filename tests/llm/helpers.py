"""Brute-force forms of what the operators compute, in plain Python."""

import unicodedata

from tidemark.llm import charform

_MAP = {ord(f): (charform.TO[i] if i < len(charform.TO) else None) for i, f in enumerate(charform.FROM)}


def skeleton(text):
    out = unicodedata.normalize("NFD", text).translate(_MAP)
    for ligature, letters in charform.LIGATURES.items():
        out = out.replace(ligature, letters)
    return unicodedata.normalize("NFC", out)


def words(text):
    return frozenset(skeleton(text).lower().split())


def alike(a, b, num=7, den=10):
    x, y = words(a), words(b)
    return bool(x) and bool(y) and len(x & y) * den >= num * len(x | y)


def rows(df):
    return sorted(tuple(r) for r in df.collect())
