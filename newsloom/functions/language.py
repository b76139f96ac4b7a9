"""Language detection by function words, and the map from ISO codes to model codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as X

#: Frequent words of each language, enough for text of a sentence or more.
PROFILES = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "was", "with", "on", "as", "by", "it", "has", "from", "are", "which"),
    "fr": ("le", "la", "les", "des", "et", "une", "est", "dans", "du", "que", "pour", "au", "qui", "par", "sur", "ont", "pas", "aux"),
    "es": ("el", "los", "las", "que", "del", "una", "por", "con", "se", "para", "en", "la", "al", "su", "sin", "más", "pero", "como"),
    "de": ("der", "die", "das", "und", "den", "von", "mit", "ist", "im", "dem", "zu", "auf", "für", "ein", "eine", "nicht", "des", "sich"),
    "it": ("il", "di", "che", "gli", "per", "una", "della", "non", "in", "la", "del", "è", "ha", "nel", "alla", "dei", "con", "sono"),
    "pt": ("os", "que", "do", "da", "uma", "não", "com", "em", "de", "um", "no", "na", "para", "ao", "por", "mais", "dos", "são"),
}
#: Letters and endings that one of these languages has far more often than the others; the second look counts them.
MARKS = {
    "en": "th|wh|ing\\b|sh|ght|'s\\b", "fr": "[èêçœùâî]|eau|oux\\b|qu'|l'|d'", "es": "ñ|¿|¡|ción\\b|dad\\b|ll", "de": "[äöüß]|sch|ung\\b|ei|cht",
    "it": "zz|zion[ei]\\b|gli|à\\b|ò\\b|cc|tt", "pt": "[ãõ]|ção\\b|ções\\b|nh|lh|ém\\b",
}
#: Confidence below which the second look decides, and the characters both looks read.
SURE, CHUNK = 0.99, 500
#: ISO code to model code for the corpus languages; anything else maps to itself.
MODEL_CODES = {"en": "eng_Latn", "fr": "fra_Latn", "de": "deu_Latn", "es": "spa_Latn", "it": "ita_Latn", "pt": "por_Latn", "ru": "rus_Cyrl", "zh": "zho_Hans"}


def by_words(c: Column) -> Column:
    """(code, confidence) by frequent words: the language with the most, and how far the next one is behind; no word gives null and 0."""
    def best_of(w: Column) -> Column:
        def hits(own: tuple[str, ...]) -> Column:
            return F.size(F.filter(w, lambda x: x.isin(*own)))

        scores = [F.struct(hits(own).alias("n"), F.lit(-i).alias("i"), F.lit(code).alias("code")) for i, (code, own) in enumerate(PROFILES.items())]
        return X.let(F.reverse(F.array_sort(F.array(*scores))), lambda s: F.struct(
            F.when(s[0]["n"] > 0, s[0]["code"]).alias("code"), F.when(s[0]["n"] > 0, 1 - s[1]["n"] / s[0]["n"]).otherwise(0.0).alias("confidence")))

    return X.let(X.words(c), best_of)


def by_letters(c: Column) -> Column:
    """(code, confidence) by marks of spelling, counted for each letter of the text."""
    def best_of(low: Column) -> Column:
        scores = [F.struct(F.regexp_count(low, F.lit(marks)).alias("n"), F.lit(-i).alias("i"), F.lit(code).alias("code")) for i, (code, marks) in enumerate(MARKS.items())]
        return X.let(F.reverse(F.array_sort(F.array(*scores))), lambda s: F.struct(
            F.when(s[0]["n"] > 0, s[0]["code"]).alias("code"), F.when(s[0]["n"] > 0, 1 - s[1]["n"] / s[0]["n"]).otherwise(0.0).alias("confidence")))

    return X.let(F.lower(c), best_of)


def detected(c: Column) -> Column:
    """(code, confidence, stage) of a text from its first chunk: by script, by words, and where these are not sure by letters as well.

    The second look weighs both by their confidence, words twice. Text that nothing speaks for is 'en' at stage 0.
    """
    none = F.struct(F.lit("en").alias("code"), F.lit(0.0).alias("confidence"), F.lit(0).alias("stage"))

    def looked(x: Column) -> Column:
        def second(w: Column) -> Column:
            def both(m: Column) -> Column:
                by = F.when((w["code"].isNotNull()) & ((2 * w["confidence"] >= m["confidence"]) | m["code"].isNull() | (m["code"] == w["code"])), w["code"]).otherwise(m["code"])
                return F.when(by.isNotNull(), F.struct(by.alias("code"), F.greatest(w["confidence"], m["confidence"]).alias("confidence"), F.lit(2).alias("stage"))).otherwise(none)

            first = F.struct(w["code"].alias("code"), w["confidence"].alias("confidence"), F.lit(1).alias("stage"))
            return F.when(w["confidence"] >= SURE, first).otherwise(X.let(by_letters(x), both))

        script = lambda code: F.struct(F.lit(code).alias("code"), F.lit(1.0).alias("confidence"), F.lit(1).alias("stage"))
        letters = F.regexp_count(x, F.lit("\\p{L}"))
        return (
            F.when(5 * F.regexp_count(x, F.lit("[\\x{3400}-\\x{9FFF}]")) >= F.greatest(letters, F.lit(1)), script("zh"))
            .when(2 * F.regexp_count(x, F.lit("[\\x{0400}-\\x{04FF}]")) >= F.greatest(letters, F.lit(1)), script("ru"))
            .otherwise(X.let(by_words(x), second))
        )

    return F.coalesce(X.let(F.substring(X.squeeze(c), 1, CHUNK), looked), none)


def detect(c: Column) -> Column:
    """Code of the language of a text; 'en' for null and blank ones and where nothing speaks for any."""
    return detected(c)["code"]


def model_code(c: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in MODEL_CODES.items() for x in kv])
    return F.coalesce(m[c], c)


def supported(spark: SparkSession) -> DataFrame:
    """(code, model_code) of the languages that the model knows."""
    return spark.createDataFrame(sorted(MODEL_CODES.items()), "code string, model_code string")
