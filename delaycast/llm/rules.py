"""Quality rules by distribution divergence. DataFrame functions only.

The counts of a document's character classes and of its language's commonest
words are compared with those of all documents of its language by the
Jensen-Shannon distance. Short texts, whose counts say little, are not compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kit import SPACES, stored

#: Common words of a language, most frequent first.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del"],
}
#: Character classes; all other characters are the last class.
CLASSES = ["[a-z]+", "[A-Z]+", "[0-9]+", SPACES, r"[!-/:-@\[-`{-~]+"]
SYMBOLS = r"[#*$%&|<>]+"
BINS = 1 + max(map(len, COMMON_WORDS.values()))


def let(value: Column, body) -> Column:
    """`body` of `value`, which is computed once."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str) -> Column:
    """How many characters (code points) of `text` the runs of `pattern` hold."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def repeated_words(words: Column, size: int = 5) -> Column:
    """Words that lie in a window of `size` words which the array has twice or more (by 64-bit hashes of the windows)."""
    at = F.sequence(F.lit(0), F.size(words) - size)
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))

    def covered(h: Column) -> Column:
        # windows sorted by hash; those equal to a neighbour, as sorted starts; the length of their union
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s, j, x: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        starts = let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, j: F.when(j > 0, same(s, j - 1, x)).otherwise(F.lit(False)) | same(s, j + 1, x)), lambda x: x["i"])))
        gaps = let(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(size)), F.lit(size))), F.lit(0), lambda a, x: a + x))
        return gaps

    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(F.size(words) >= size, some).otherwise(F.lit(0)).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the rule counts and both histograms (arrays char_counts, word_counts) of every row's whole text."""
    text = F.col("_text")
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("_text"))
    rows = rows.withColumns({"_words": F.array_remove(F.split(text, SPACES), ""),
                             "_lines": F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))})
    lists = F.create_map(*[F.lit(x) for k, v in COMMON_WORDS.items() for x in (k, v)])
    listed = F.coalesce(F.try_element_at(lists, F.col("lang")), F.array().cast("array<string>"))
    hits = let(listed, lambda ls: F.filter(F.transform(F.col("_words"), F.lower), lambda w: F.array_contains(ls, w)))
    rows = rows.withColumn("_hits", hits)
    counts = let(F.col("_hits"), lambda h: F.transform(listed, lambda w: F.size(F.filter(h, lambda x: x == w)).cast("long")))
    padded = lambda c: F.transform(F.sequence(F.lit(0), F.lit(BINS - 2)), lambda i: F.coalesce(F.get(c, i), F.lit(0).cast("long")))
    n = F.size("_words").cast("long")
    classes = [matches(text, c) for c in CLASSES]
    rows = rows.withColumn("_classes", F.array(*classes))
    return rows.select(
        "doc_id", "lang", n.alias("n_words"),
        (F.length(text).cast("long") - F.get("_classes", F.lit(CLASSES.index(SPACES)))).alias("word_chars"),
        matches(text, SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.array_append("_classes", F.length(text).cast("long") - F.aggregate("_classes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("char_counts"),
        F.array_append(let(counts, padded), n - F.size("_hits")).alias("word_counts"))


def references(rows: DataFrame) -> DataFrame:
    """Of each language, the histograms over all its documents."""
    total = lambda c, m: F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(m)])
    return rows.groupBy("lang").agg(total("char_counts", len(CLASSES) + 1).alias("char_reference"), total("word_counts", BINS).alias("word_reference"))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms; 0 if either is empty."""
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    half = lambda p, q: let((p + q) / 2, lambda m: (part(p, m) + part(q, m)) / 2)
    shares = lambda c: let(add(F.transform(c, lambda x: x.cast("double"))), lambda s: F.transform(c, lambda x: F.when(s > 0, x / s)))
    js = add(F.zip_with(shares(counts), shares(reference), half))
    return F.sqrt(F.greatest(F.coalesce(js, F.lit(0.0)), F.lit(0.0)))


def judged(docs: DataFrame, char_limit: tuple[float, float] = (0.12, 2.5), word_limit: tuple[float, float] = (0.12, 1.6),
           least_chars: int = 200, least_words: int = 50) -> DataFrame:
    """One row per row of `docs`: the rule counts, both distances, base_failed and kept.

    A limit (a, b) is a + b / sqrt(n) for a histogram of n counts, as the distance
    of a sample from its own distribution falls with the square root of its size.
    Texts of fewer than `least_chars` characters in words, or `least_words` words,
    aren't held to that limit.

    A null text is empty: no words, base_failed. Null and unlisted languages are
    languages of their own, without common words. Null ids stay, repeated rows
    each get a row, other columns are ignored.
    """
    rows = stored(measured(docs), "rules")
    rows = rows.join(references(rows), "lang", "left")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.select("*", distance(F.col("char_counts"), F.col("char_reference")).alias("char_distance"),
                       distance(F.col("word_counts"), F.col("word_reference")).alias("word_distance"), failed.alias("base_failed"))
    limit = lambda n, ab: ab[0] + ab[1] / F.sqrt(n)
    fits = ((F.col("word_chars") < least_chars) | (F.col("char_distance") <= limit(F.col("word_chars"), char_limit))) & (
        (F.col("n_words") < least_words) | (F.col("word_distance") <= limit(F.col("n_words"), word_limit)))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~failed & fits).alias("kept"), "char_distance", "word_distance")
