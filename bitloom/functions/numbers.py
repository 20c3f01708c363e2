"""Numbers of a sentence as plain values, in any script's digits and with scale words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import PY_SPACE, ascii_digits, let

# Scale words, matched as the beginning of the word after a number; the first scale that matches counts
SCALES = [
    (10**5, "lakh lac लाख লাখ লক্ষ ਲੱਖ લાખ ଲକ୍ଷ லட்ச లక్ష ಲಕ್ಷ ലക്ഷ لاکھ".split()),
    (10**7, "crore करोड़ करोड कोटी কোটি ਕਰੋੜ કરોડ କୋଟି கோடி కోట కోటి ಕೋಟಿ കോടി کروڑ".split()),
    (10**6, "million ದಶಲಕ್ಷ मिलियन মিলিয়ন ਮਿਲੀਅਨ મિલિયન ମିଲିୟନ மில்லியன் మిలియన్ ಮಿಲಿಯನ್ മില്യ ملین".split()),
    (10**9, "billion बिलियन বিলিয়ন ਬਿਲੀਅਨ બિલિયન ବିଲିୟନ பில்லியன் బిలియన్ ಬಿಲಿಯನ್ ബില്യ بلین".split()),
    (10**12, ["trillion"]),
]
_FORM = rf"([0-9]+(?:,[0-9]+)*(?:\.[0-9]+)?)(?=[{PY_SPACE}]*([^{PY_SPACE}]*))"


def _plain(v: Column) -> Column:
    """A double as Python writes it: whole numbers without a point, others to six places."""
    trimmed = F.regexp_replace(F.regexp_replace(F.format_string("%.6f", v), "0+$", ""), r"\.$", ".0")
    micro = F.round(v * 1e6).cast("long")
    digits = F.concat(F.floor(micro / 10).cast("string"), F.when(micro % 10 != 0, F.concat(F.lit("."), (micro % 10).cast("string"))).otherwise(""))
    tiny = F.when(micro == 0, "0.0").when(micro < 10, F.concat(micro.cast("string"), F.lit("e-06"))).otherwise(F.concat(digits, F.lit("e-05")))
    return F.when(v == F.rint(v), _whole(v)).when(v < 1e-4, tiny).otherwise(trimmed)


def _whole(v: Column) -> Column:
    """A whole double to the last digit; from 1e37 on its first 17 digits at most, then zeros."""
    part = float(2**60)
    high = F.rint(v / part - 0.5)
    high = F.when(high * part > v, high - 1).when((high + 1) * part <= v, high + 1).otherwise(high)
    exact = let(F.when(v < 1e37, high), lambda h: h.cast("long").cast("decimal(19,0)") * F.lit(2**60).cast("decimal(19,0)") + (v - h * part).cast("long").cast("decimal(19,0)"))
    return F.when(v < part, v.cast("long").cast("string")).otherwise(F.coalesce(exact.cast("string"), F.format_string("%.0f", v)))


def fixed(v: Column) -> Column:
    """A double as SQL's printf writes it, from all its digits: whole numbers without a point, others to six places, without zeros at the end."""
    head = F.floor((v - F.floor(v)) * 2.0**26) / 2.0**26  # both parts times a million are exact
    millionths = let(head * 1e6, lambda p: let(F.struct(F.floor(p).alias("n"), (0.5 - (p - F.floor(p))).alias("lacks"), ((v - F.floor(v) - head) * 1e6).alias("tail")), _nearest))
    text = let(millionths, lambda m: F.concat((F.floor(v) + F.floor(m / 1e6)).cast("string"), F.lit("."), F.lpad((m % 1000000).cast("string"), 6, "0")))
    return F.when(v == F.rint(v), _whole(v)).otherwise(F.regexp_replace(text, "0+$", ""))


def _nearest(p: Column) -> Column:
    up = (p["tail"] > p["lacks"]) | ((p["tail"] == p["lacks"]) & (p["n"] % 2 == 1))
    return p["n"] + up.cast("long")


def numbers(text: Column, scales: list = SCALES, form=_plain) -> Column:
    """Values in the order of their strings. Doubles, as '1.1 lakh' shows: 110000.00000000001 is '110000.0'. Null has none."""

    def value(digits: Column, after: Column) -> Column:
        number = F.replace(digits, F.lit(","), F.lit("")).cast("double")
        scale = F.lit(1.0)
        for k, words in reversed(scales):
            scale = F.when(after.rlike("^(?:" + "|".join(words) + ")"), float(k)).otherwise(scale)
        return let(number * scale, form)

    def all_of(s: Column) -> Column:
        found = F.zip_with(F.regexp_extract_all(s, F.lit(_FORM), F.lit(1)), F.regexp_extract_all(s, F.lit(_FORM), F.lit(2)), lambda d, a: value(d, F.lower(a)))
        return F.array_sort(found)

    return let(ascii_digits(F.coalesce(text, F.lit(""))), all_of)


def numbers_agree(a: Column, b: Column) -> Column:
    """Whether both arrays hold the same numbers; null where neither holds any."""
    same = (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
    return F.when((F.size(a) > 0) | (F.size(b) > 0), same)
