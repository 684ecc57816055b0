"""Devanagari to Latin letters, by syllables.

A word is read as syllables (consonant cluster and vowel). The inherent vowel is
written inside a word and dropped at its end after a lone consonant; a nasal
mark becomes m before labials and n elsewhere. Latin text, digits and
punctuation pass through.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import fold_lookalikes, fold_stress

# The letters, after the published ITRANS scheme without its case distinctions.
VOWELS = dict(zip("अ आ इ ई उ ऊ ऋ ए ऐ ओ औ ऑ".split(), "a a i i u u ri e ai o au o".split()))
SIGNS = dict(zip("ा ि ी ु ू ृ े ै ो ौ ॉ".split(), "a i i u u ri e ai o au o".split()))
CONSONANTS = dict(zip(
    "क ख ग घ ङ च छ ज झ ञ ट ठ ड ढ ण त थ द ध न प फ ब भ म य र ल व श ष स ह ळ".split(),
    "k kh g gh n ch chh j jh n t th d dh n t th d dh n p ph b bh m y r l v sh sh s h l".split(),
))
NUKTA = {"क": "q", "ख": "kh", "ग": "g", "ज": "z", "ड": "d", "ढ": "dh", "फ": "f"}
# Names whose spelling is settled.
WORDS = {"पाल": "Pal", "राम": "Ram", "सक्सेना": "Saxena", "गर्ग": "Garg", "ओमवीर": "Omvir", "राज": "Raj", "राजपाल": "Rajpal", "वर्मा": "Verma", "चन्द": "Chand",
         "जगदीश": "Jagdish", "तेजपाल": "Tejpal", "दत्त": "Dutt", "पवार": "Pawar", "ममता": "Mamta", "मेहता": "Mehta", "मोहम्मद": "Mohammed", "रणबीर": "Ranbir",
         "राजबाला": "Rajbala", "लखपत": "Lakhpat", "वीरपाल": "Veerpal", "सुखपाल": "Sukhpal"}
_VIRAMA, _NUKTA, _NASAL, _VISARGA = "्", "़", "ंँ", "ः"
_LABIAL = "पफबभम"
_PIECE = re.compile("[ऀ-ॿ]+|[^ऀ-ॿ]+")


def _word(word: str) -> str:
    if word in WORDS:
        return WORDS[word]
    out: list[str] = []
    i, n, cluster = 0, len(word), 0
    while i < n:
        c = word[i]
        if c in CONSONANTS:
            letter, i = CONSONANTS[c], i + 1
            if i < n and word[i] == _NUKTA:
                letter, i = NUKTA.get(c, letter), i + 1
            if out and out[-1] == "j" and c == "ञ":
                out[-1], letter = "g", "y"
            out.append(letter)
            cluster += 1
            if i < n and word[i] == _VIRAMA:
                i += 1
            elif i < n and word[i] in SIGNS:
                out.append(SIGNS[word[i]])
                i, cluster = i + 1, 0
            else:
                last = i == n
                if not last or cluster > 1 or n == 1:
                    out.append("a")
                cluster = 0
        elif c in VOWELS:
            out.append(VOWELS[c])
            i, cluster = i + 1, 0
        elif c in _NASAL:
            after = word[i + 1] if i + 1 < n else ""
            out.append("m" if after and after in _LABIAL else "ng" if after == "ह" else "n")
            i, cluster = i + 1, 0
        elif "०" <= c <= "९":
            out.append(str(ord(c) - ord("०")))
            i += 1
        else:
            if c == _VISARGA:
                out.append("h")
            i += 1
    text = "".join(out)
    return text[:1].upper() + text[1:]


def transliterated(text: str | None) -> str | None:
    """Latin spelling of a text, null for blank ones."""
    if text is None or not text.strip():
        return None
    return " ".join("".join(_word(p) if "ऀ" <= p[0] <= "ॿ" else p for p in _PIECE.findall(w)) for w in text.split())


@F.pandas_udf(T.StringType())
def _udf(values: pd.Series) -> pd.Series:
    return values.map(transliterated)


def transliterate(value: Column) -> Column:
    """Only rows with Devanagari reach Python."""
    value = fold_stress(fold_lookalikes(value))
    latin = F.nullif(F.trim(value), F.lit(""))
    return F.when(value.rlike("[ऀ-ॿ]"), _udf(F.when(value.rlike("[ऀ-ॿ]"), value))).otherwise(latin)


def source_hash(*fields: Column) -> Column:
    """Changes when a text that English was derived from changes; null counts as empty."""
    return F.sha2(F.concat_ws("␟", *[F.coalesce(f, F.lit("")) for f in fields]), 256)
