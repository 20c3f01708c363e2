"""Language dimension: labels, scripts, shared scripts, names and cuts."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

# Fixed values -----------------------------------------------------------------

LABELS = {
    "English": "en", "Hindi": "hi", "हिन्दी": "hi", "Urdu": "ur", "Marathi": "mr", "Bengali": "bn", "Assamese": "as", "Manipuri": "mni", "Punjabi": "pa",
    "Gujarati": "gu", "Odia": "or", "Oriya": "or", "Tamil": "ta", "Telugu": "te", "Kannada": "kn", "Malayalam": "ml", "Konkani": "gom", "Dogri": "doi",
    "Bodo": "brx", "Sanskrit": "sa", "Maithili": "mai", "Nepali": "ne", "Sindhi": "sd", "Mizo": "lus", "Khasi": "kha", "Tenyidei": "njm",
}

# Page detection: script by script, the first wins ties. The danda (U+0964-5) belongs to no language.
PAGE_SCRIPTS = [
    ("hi", "ऀ-ॣ०-ॿ"), ("ur", "؀-ۿ"), ("bn", "ঀ-৿"), ("pa", "਀-੿"), ("gu", "઀-૿"),
    ("or", "଀-୿"), ("ta", "஀-௿"), ("te", "ఀ-౿"), ("kn", "ಀ-೿"), ("ml", "ഀ-ൿ"), ("mni", "ꯀ-꯿"), ("en", "A-Za-z"),
]
SHARED_SCRIPT = {"mr": "hi", "ne": "hi", "sa": "hi", "gom": "hi", "as": "bn", "mni": "bn", "sd": "ur", "lus": "en", "kha": "en", "njm": "en"}

LATIN, DEVANAGARI, BENGALI = "A-Za-zÀ-ɏ", "ऀ-ॣ०-ॿ", "ঀ-৿"
SCRIPT = {
    "en": LATIN, "hi": DEVANAGARI, "mr": DEVANAGARI, "ne": DEVANAGARI, "gom": DEVANAGARI, "ur": "؀-ۿ", "bn": BENGALI, "as": BENGALI, "mni": BENGALI,
    "pa": "਀-੿", "gu": "઀-૿", "or": "଀-୿", "ta": "஀-௿", "te": "ఀ-౿", "kn": "ಀ-೿", "ml": "ഀ-ൿ",
    "lus": LATIN, "kha": LATIN, "njm": LATIN,
}
# Our extension: Latin-script languages of other corpora.
SCRIPT |= dict.fromkeys(("fr", "de", "es"), LATIN)

NAMES = {
    "hi": "Hindi", "ur": "Urdu", "gu": "Gujarati", "mr": "Marathi", "ml": "Malayalam", "kn": "Kannada", "pa": "Punjabi", "te": "Telugu", "bn": "Bengali",
    "or": "Odia", "as": "Assamese", "ta": "Tamil", "gom": "Konkani", "ne": "Nepali", "kha": "Khasi", "mni": "Manipuri", "lus": "Mizo", "njm": "Tenyidei",
}
LOW_CONFIDENCE = ("mni", "lus", "kha", "njm", "gom")
DEFAULT_CUT = 0.70
# Languages with an encoder of their own: (English encoder, own encoder, cut).
ROUTED = {"mni": ("LASER2:eng_Latn", "LASER3:mni_Beng", 0.80)}

MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]

# ------------------------------------------------------------------------------


@lru_cache(1)
def digit_tables() -> tuple[str, str]:
    """All decimal digits but ASCII's, and the ASCII digit of each, for translate()."""
    digits = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.decimal(c)) for c in digits)
