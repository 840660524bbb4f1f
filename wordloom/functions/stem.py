"""Porter stems for a vocabulary table, as staged projections over distinct words.

A ``y`` that acts as a consonant is written ``Y`` while stemming, so every test below is one
plain character-class pattern. The measure of a word is its number of vowel-to-consonant
steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOWEL = "[aeiouy]"
CONSONANT = "[bcdfghjklmnpqrstvwxzY]"
HAS_VOWEL = "[aeiouy]|^Y"

# Suffix -> replacement for each suffix step.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "logi": "log", "entli": "ent", "ousli": "ous", "alli": "al", "bli": "ble", "eli": "e",
    "ization": "ize", "ation": "ate", "ator": "ate", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "alism": "al", "biliti": "ble", "aliti": "al", "iviti": "ive",
}
STEP_3 = {
    "ical": "ic", "ness": "", "icate": "ic", "iciti": "ic", "ful": "", "ative": "",
    "alize": "al",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def measure(col: Column) -> Column:
    return F.regexp_count(col, F.lit(VOWEL + CONSONANT))


def ends_short(col: Column) -> Column:
    """Consonant, vowel, consonant at the end, the last one not w, x or y."""
    return F.rlike(col, F.lit(f"{CONSONANT}{VOWEL}[bcdfghjklmnpqrstvz]$"))


def ends_double(col: Column) -> Column:
    return F.rlike(col, F.lit(r"([bcdfghjklmnpqrstvwxzY])\1$"))


def without(col: Column, chars: Column | int) -> Column:
    chars = F.lit(chars) if isinstance(chars, int) else chars
    return F.left(col, F.length(col) - chars)


def suffix_step(df: DataFrame, rules: dict[str, str], least: int, extra: str = "") -> DataFrame:
    """Replace the longest listed suffix where the part before it measures above ``least``."""
    choice = "|".join(sorted(rules, key=len, reverse=True))
    pattern = f"({choice}{extra})$"
    table = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    df = df.withColumn("suffix", F.regexp_extract("w", pattern, 1))
    df = df.withColumn("base", without(F.col("w"), F.length("suffix")))
    swap = F.concat(F.col("base"), F.coalesce(F.try_element_at(table, F.col("suffix")), F.lit("")))
    keep = (F.col("suffix") == "") | (measure(F.col("base")) <= least)
    return df.withColumn("w", F.when(keep, F.col("w")).otherwise(swap))


def stem_vocabulary(words: DataFrame, column: str = "keyword") -> DataFrame:
    """Add ``stem`` to a table of distinct lower-case words."""
    w = F.col("w")
    marked = F.regexp_replace(
        F.regexp_replace(F.col(column), "^y", "Y"), "([aeiou])y", "$1Y"
    )
    df = words.withColumn("w", marked)

    # Plurals.
    df = df.withColumn(
        "w",
        F.when(F.endswith(w, F.lit("sses")) | F.endswith(w, F.lit("ies")), without(w, 2))
        .when(F.endswith(w, F.lit("ss")), w)
        .when(F.endswith(w, F.lit("s")), without(w, 1))
        .otherwise(w),
    )

    # Past and continuous forms; `cut` marks the words whose ending went away.
    is_eed = F.endswith(w, F.lit("eed"))
    is_ing = F.endswith(w, F.lit("ing")) & F.rlike(without(w, 3), F.lit(HAS_VOWEL))
    is_ed = F.endswith(w, F.lit("ed")) & F.rlike(without(w, 2), F.lit(HAS_VOWEL))
    df = df.withColumn("cut", ~is_eed & (is_ing | is_ed)).withColumn(
        "w",
        F.when(is_eed & (measure(without(w, 3)) > 0), without(w, 1))
        .when(is_eed, w)
        .when(is_ing, without(w, 3))
        .when(is_ed, without(w, 2))
        .otherwise(w),
    )
    df = df.withColumn(
        "w",
        F.when(~F.col("cut"), w)
        .when(F.rlike(w, F.lit("(at|bl|iz)$")), F.concat(w, F.lit("e")))
        .when(ends_double(w) & ~F.rlike(w, F.lit("(ll|ss|zz)$")), without(w, 1))
        .when((measure(w) == 1) & ends_short(w), F.concat(w, F.lit("e")))
        .otherwise(w),
    )

    # A final y after a vowel somewhere.
    df = df.withColumn(
        "w",
        F.when(
            F.rlike(w, F.lit("[yY]$")) & F.rlike(without(w, 1), F.lit(HAS_VOWEL)),
            F.concat(without(w, 1), F.lit("i")),
        ).otherwise(w),
    )

    df = suffix_step(df, STEP_2, 0)
    df = suffix_step(df, STEP_3, 0)
    df = suffix_step(df, dict.fromkeys(STEP_4, ""), 1, extra="|(?<=[st])ion")

    # A final e, then a final double l.
    stump = without(w, 1)
    drop_e = F.endswith(w, F.lit("e")) & (
        (measure(stump) > 1) | ((measure(stump) == 1) & ~ends_short(stump))
    )
    df = df.withColumn("w", F.when(drop_e, stump).otherwise(w))
    df = df.withColumn(
        "w", F.when(F.endswith(w, F.lit("ll")) & (measure(w) > 1), without(w, 1)).otherwise(w)
    )
    stem = F.when(F.octet_length(column) <= 2, F.col(column)).otherwise(F.lower("w"))
    # A generated column: conditions on the stem stay above it, where pushing them down
    # would write the whole chain of steps into them.
    return df.select(*words.columns, F.explode(F.array(stem)).alias("stem"))
