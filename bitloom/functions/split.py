"""Sentence splitting for many scripts, as an Arrow function."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Titles by script, and English letter names in Devanagari ---------
TITLES = (
    "Dr Mr Mrs Ms Smt Shri Sh Kum Prof Sr St Lt Col Gen Maj Capt Brig Cdr Adm Hon Rs No Nos "
    "डॉ प्रो श्री श्रीमती सुश्री कु रु क्र ড ডা ਡਾ ਪ੍ਰੋ ਨੰ ਸ੍ਰੀ ਸ਼੍ਰੀ ડૉ ડો પ્રો શ્રી રૂ ଡ ଡ଼ ପ୍ରୋ ଶ୍ରୀ ଟ திரு திருமதி செல்வி ரூ డా రూ శ్రీ ప్రొ "
    "ಡಾ ಪ್ರೊ ರೂ ಶೇ ಶ್ರೀ ಪ್ರೈ ಲಿ ഡോ പ്രൊ രൂ ശ്രീ"
).split()
LETTERS = (
    "ए बी सी डी ई एफ जी एच आई जे के एल एम एन ओ पी क्यू आर एस टी यू वी डब्ल्यू एक्स वाई जेड ज़ेड एफ् एच् एल् एम् एन् आर् एस् एक्स् जेड् "
    "ऎफ् ऎच् ऎल् ऎम् ऎन् ऎस् ऎक्स् ऎफ ऎच ऎल ऎम ऎन ऎस"
).split()
OWN_LETTERS = (
    "ਐੱਲ ਐੱਮ ਐੱਨ ਐੱਸ ਐੱਫ ਐੱਚ ਐੱਕਸ ஏ பி சி டி ஜி ஹெச் எச் ஐ ஜே கே க்யூ ஆர் யு யூ வி ஒய் இசட் ஜெட் எஃப் "
    "എൽ എം എൻ എസ് എഫ് എച്ച് ആർ കെ പി ജി ബി സി ഡി ടി വി"
).split()
DEVANAGARI, LAST_BLOCK = 0x0900, 0x0D00  # scripts of one order, 128 code points each
ROWS = 16
MARKS, OPENERS = ".?!।॥۔؟", "([\"'“‘"
# --------------------------------------------------------------------------------


_HELD = frozenset([*TITLES, *LETTERS, *OWN_LETTERS])


def _is_held(word: str) -> bool:
    """Whether a period after the word ends no sentence: a title, or a letter's name, which sister scripts write at the same places of their own block."""
    if word in _HELD:
        return True
    blocks = {ord(c) & ~0x7F for c in word}
    if len(blocks) != 1 or not DEVANAGARI < min(blocks) <= LAST_BLOCK or not all(unicodedata.name(c, "") for c in word):
        return False
    back = min(blocks) - DEVANAGARI
    return "".join(chr(ord(c) - back) for c in word) in _LETTER_NAMES


_LETTER_NAMES = frozenset(LETTERS)
_SHORT = re.compile(r"[A-Z]|[^\s.\d]+(?:\.[^\s.\d]+)+")
_RUN = re.compile(rf"[{re.escape(MARKS)}]+\Z")


def _breaks(word: str, before: str, gap: str, after: str) -> bool:
    """Whether the gap after a word ends a sentence; before: the word ahead of it in the sentence, if any.

    Any run of marks does, and a line end after a word without marks.  A single
    period does not after a title, an initial or an abbreviation, nor ahead of a
    lower-case letter; it then holds even a line end.
    """
    run = _RUN.search(word)
    if run is None:
        return "\n" in gap
    if run.group() != ".":
        return True
    stem = (word[:-1] or before).lstrip(OPENERS)
    return not (_is_held(stem) or _SHORT.fullmatch(stem) or after[:1].islower())


def sentences_of(text: str | None) -> list[str]:
    """Sentences of more than one character with a word in them; a null text has none."""
    text, spans, begin, at, before = text or "", [], 0, 0, ""
    for gap in re.finditer(r"\s+", text):
        word = text[at : gap.start()]
        if _breaks(word, before, gap.group(), text[gap.end() : gap.end() + 1]):
            spans.append(text[begin : gap.start()].strip())
            begin, word = gap.end(), ""
        at, before = gap.end(), word
    spans.append(text[begin:].strip())
    return [s for s in spans if len(s) > 1 and re.search(r"\w", s)]


@F.arrow_udf(ArrayType(StringType()))
def sentences(texts: pa.Array) -> pa.Array:
    """Sentences of each text; a null text has none. Of a batch only ROWS texts at a time are Python strings."""
    kind = pa.list_(pa.string())
    split = [pa.array(map(sentences_of, texts.slice(k, ROWS).to_pylist()), kind) for k in range(0, len(texts), ROWS)]
    return pa.concat_arrays(split) if split else pa.array([], kind)
