"""Every table's schema, declared: nothing is inferred, so an empty table keeps its columns."""

from pyspark.sql import types as T


_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "long": T.LongType()}


def _struct(spec: str, **other: T.DataType) -> T.StructType:
    """Columns as 'name kind, …', then those of other kinds; no session is needed."""
    plain = [T.StructField(*(name, _KINDS[kind])) for name, kind in (x.split() for x in spec.split(", "))]
    return T.StructType(plain + [T.StructField(name, kind) for name, kind in other.items()])


PAGE = _struct("prid string, html string")
RELEASE = _struct("prid string, lang string, title string, subtitle string, ministry string, date string, body string", translations=T.MapType(T.StringType(), T.StringType()))
GROUP = _struct("prid string, date string, ministry string", byLang=T.MapType(T.StringType(), _struct("prid string, title string, body string")))
VECTOR = _struct("k string, model string, text string", v=T.ArrayType(T.FloatType()))
SENTENCE_PAIR = _struct(
    "lang string, en string, text string, sim double, numbers boolean, confidence string, prid string, en_prid string, text_prid string, date string, office string"
)
COPY_SAMPLE = _struct("prid string, office string, lang string, en string, text string, chrf double, google_copy boolean")
TRANSLATION = _struct("from string, to string, text string, translated string")
SENTENCES = _struct(
    "lang string, en string, text string, similarity double, numbers_agree boolean, confidence string, google_copy boolean, occurrences long, "
    "en_prid string, text_prid string, office string, date string, posted_by string"
)
DOCUMENTS = _struct(
    "lang string, en_prid string, text_prid string, en_title string, en_body string, title string, body string, ministry string, office string, date string, posted_by string"
)
PASSES = _struct("name string, reg int, lang int, cols string")
OFFICES = _struct("reg int, office string, langs string")
PLAN = _struct("lang string, office string, month string")
