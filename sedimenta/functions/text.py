"""Keyword labels on text, as native expressions over the whole text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Categories in order of precedence with their keywords.
CATEGORY_WORDS = {
    "Electronics": ["phone", "tv", "television", "headphones", "smartphone", "laptop"],
    "Clothing": ["shoes", "jeans", "shirt", "pants", "clothing"],
    "Home & Garden": ["mixer", "kitchen", "home", "furniture"],
    "Sports & Outdoors": ["yoga", "fitness", "sports", "exercise"],
    "Books": ["book", "novel", "reading"],
}
OTHER = "Other"
# Words that count for and against.
POSITIVE_WORDS = ["amazing", "great", "excellent", "love", "best", "recommend"]
NEGATIVE_WORDS = ["terrible", "disappointed", "bad", "worst", "awful"]

# Attributes with a closed list of values; sizes are a pattern.
COLOURS = ["black", "white", "red", "blue", "green", "yellow", "brown", "grey", "pink", "purple"]
MATERIALS = ["cotton", "denim", "leather", "steel", "wood", "plastic", "titanium", "glass", "wool"]
SIZE_PATTERN = r"\b(\d+(?:\.\d+)?(?:-| )?(?:inch|mm|cm|quart|gb)|\d+x\d+|size \d+)\b"


def has_any(lower: Column, words: list[str]) -> Column:
    """One of the words occurs anywhere in the (lower-case) text."""
    return reduce(lambda a, b: a | b, [F.contains(lower, F.lit(w)) for w in words])


def category(lower: Column, words: dict[str, list[str]] = CATEGORY_WORDS, other: str = OTHER) -> Column:
    """The first category of which a keyword occurs in lower-case text."""
    out = None
    for name, keywords in words.items():
        found = has_any(lower, keywords)
        out = F.when(found, name) if out is None else out.when(found, name)
    return F.when(lower.isNotNull(), out.otherwise(other))


def word_hits(lower: Column, words: list[str]) -> Column:
    """How many of the words occur in the text, each counted once."""
    return reduce(lambda a, b: a + b, [F.contains(lower, F.lit(w)).cast("int") for w in words])


def mood(lower: Column, rating: Column) -> Column:
    """From the rating and the balance of good and bad words."""
    good, bad = word_hits(lower, POSITIVE_WORDS), word_hits(lower, NEGATIVE_WORDS)
    return (
        F.when((rating >= 4) | (good > bad), "Positive")
        .when((rating <= 2) | (bad > good), "Negative")
        .otherwise("Neutral")
    )


def classify(df: DataFrame, text: str, name: str = "ai_category") -> DataFrame:
    """Add the category of a text.  The text is lowered once, in a projection
    of its own, and searched as bytes; nothing is cut off."""
    return df.withColumn("_lower", F.lower(text)).withColumn(name, category(F.col("_lower"))).drop("_lower")


def sentiment(df: DataFrame, text: str, rating: str, name: str = "sentiment") -> DataFrame:
    """Add the mood of a review."""
    lowered = df.withColumn("_lower", F.lower(text))
    return lowered.withColumn(name, mood(F.col("_lower"), F.col(rating))).drop("_lower")


def extract_attributes(text: Column) -> list[Column]:
    """Colour, material and size named first in the text, NULL if none is."""
    lower = F.lower(text)

    def first(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(lower, pattern, 1), F.lit(""))

    return [
        first(rf"\b({'|'.join(COLOURS)})\b").alias("color"),
        first(rf"\b({'|'.join(MATERIALS)})\b").alias("material"),
        first(SIZE_PATTERN).alias("size"),
    ]
