"""Quality rules by distribution divergence.

A document is compared with its language: the share of each character class and of
the language's most common words against the same shares over all documents of that
language, as Jensen-Shannon distance (base 2, 0 to 1). Junk keeps the words of a
language but not its proportions. Distances of short texts are noise, so texts below a
minimum length, and languages with too few words to refer to, are not judged by them.

Everything is built-in expressions. The language references are counted over all
documents with map-side combination: a few rows a language remain.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.text import let, narrow, once, stored, text_of, whole, words_of


@dataclass(frozen=True)
class Limits:
    common_words: int = 16  # words of a reference histogram
    least_words: int = 60  # shorter texts are not judged by distance
    least_reference: int = 5000  # words a language needs before it is a reference
    class_distance: float = 0.27
    word_distance: float = 0.32
    base_words: int = 10
    repeat_percent: int = 20
    window: int = 5


# Removing these from a text leaves what a class does not hold.
LETTERS_AND_SPACE = r"[a-zA-Z\x20\x09-\x0D\p{L}]++"
NUMBERS, MARKS, SYMBOLS = r"\p{N}+", r"[.,;:!?'\"()-]+", r"[#*$%&|<>]+"


def space_in(text: Column, words: Column) -> Column:
    """White space of a text, in code points: what its words lack of it."""
    return F.length(text) - F.length(F.array_join(words, ""))


def character_counts(text: Column, space: Column) -> Column:
    """Struct of classes (letters, numbers, white space, punctuation, other) and symbols, in code points."""

    def gone(value: Column, pattern: str) -> Column:
        return F.length(value) - F.length(F.regexp_replace(value, pattern, ""))

    def counted(rest: Column) -> Column:
        # Letters and white space are most of a text; the other classes are counted in what is left.
        numbers, marks = gone(rest, NUMBERS), gone(rest, MARKS)
        other = F.length(rest) - numbers - marks
        classes = F.array(F.length(text) - F.length(rest) - space, numbers, space, marks, other)
        return F.struct(classes.alias("classes"), gone(rest, SYMBOLS).alias("symbols"))

    return let(F.regexp_replace(text, LETTERS_AND_SPACE, ""), counted)


def hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def repeat_steps(window: int) -> list[Callable[[Column], Column]]:
    """From the hashes of a text's words to `repeated_words`, each step from the one before.

    Steps with a function of elements and those without take turns, so that the latter can
    run as compiled code.
    """

    def neighbours(words: Column) -> Column:
        n = F.greatest(F.size(words) - (window - 1), F.lit(0))
        return F.arrays_zip(*[F.slice(words, F.lit(i + 1), n).alias(f"w{i}") for i in range(window)])

    def keys(windows: Column) -> Column:
        return F.transform(windows, lambda w: F.xxhash64(w))

    def ordered(keys: Column) -> Column:
        # Equal sequences stand next to each other once sorted.
        places = F.arrays_zip(keys.alias("k"), F.sequence(F.lit(0), F.size(keys) - 1).alias("i"))
        return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.sort_array(places))

    def starts(order: Column) -> Column:
        twice = F.filter(
            order, lambda e, i: F.get(order, i - 1)["k"].eqNullSafe(e["k"]) | F.get(order, i + 1)["k"].eqNullSafe(e["k"])
        )
        return F.transform(twice, lambda e: e["i"])

    def covered(starts: Column) -> Column:
        reach = F.transform(
            starts, lambda s, i: F.coalesce(F.least(F.get(starts, i + 1) - s, F.lit(window)), F.lit(window))
        )
        return F.coalesce(F.aggregate(reach, F.lit(0), lambda a, x: a + x), F.lit(0))

    return [neighbours, keys, ordered, starts, lambda unsorted: F.sort_array(unsorted), covered]


def repeated_words(words: Column, window: int) -> Column:
    """Words that lie in a `window`-word sequence which the text holds more than once."""
    value = hashes(words)
    for step in repeat_steps(window):
        value = let(value, step)
    return value


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of a histogram to a reference distribution; 1 if it is empty."""

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    def divergence(total: Column) -> Column:
        terms = F.zip_with(
            counts, reference, lambda n, q: part(n / total, q) + part(q, n / total)
        )
        return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2

    summed = F.aggregate(counts, F.lit(0.0), lambda a, n: a + n)
    return let(
        summed,
        lambda total: F.when(total > 0, F.sqrt(F.greatest(divergence(total), F.lit(0.0)))).otherwise(1.0),
    )


def references(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per language: class shares, the common words and their shares.

    Null languages form a language of their own. Ties of common words go by the word.
    """
    texts = docs.select(F.col("lang").cast("string").alias("lang"), text_of(F.col("text")).alias("text"))
    split = once(texts, words=words_of(F.col("text")))
    split = once(split.withColumn("n", F.size("words")), space=space_in(F.col("text"), F.col("words")))
    counts = split.select("lang", "n", character_counts(F.col("text"), F.col("space"))["classes"].alias("c"))
    classes = counts.groupBy("lang").agg(F.sum("n").alias("ref_words"), *[F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(5)])
    classes = classes.withColumn("total", sum(F.col(f"c{i}") for i in range(5))).select(
        F.col("lang").alias("ref_lang"), "ref_words",
        F.array(*[F.when(F.col("total") > 0, F.col(f"c{i}") / F.col("total")).otherwise(0.0) for i in range(5)]).alias("class_share"),
    )
    words = texts.select("lang", F.explode(words_of(F.lower(F.col("text")))).alias("word"))
    counted = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    by_rank = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (
        counted.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= limits.common_words)
        .groupBy(F.col("lang").alias("word_lang")).agg(F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    )
    named = F.aggregate("top", F.lit(0).cast("bigint"), lambda a, t: a + t["n"])
    shares = F.concat(
        F.transform("top", lambda t: t["n"] / F.col("ref_words")),
        F.array((F.col("ref_words") - named) / F.col("ref_words")),
    )
    # A language without a word has no common ones.
    return classes.join(top, F.col("ref_lang").eqNullSafe(F.col("word_lang")), "left").select(
        "ref_lang", "class_share", "ref_words", F.col("top.word").alias("common"),
        F.when(F.col("top").isNotNull(), shares).alias("word_share"),
    )


def word_counts(words: Column, common: Column) -> Column:
    """Occurrences of each common word, then of all other words."""

    def counted(found: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(1), F.size(common)),
            lambda i: F.size(found) - F.size(F.array_remove(found, i.cast("bigint"))),
        )
        return F.concat(each, F.array(F.size(words) - F.size(found)))

    def found(longest: Column) -> Column:
        short = F.filter(words, lambda w: F.octet_length(w) <= longest)
        return F.filter(F.transform(short, lambda w: F.array_position(common, w)), lambda i: i > 0)

    longest = F.array_max(F.transform(common, lambda w: F.octet_length(w)))
    return let(let(longest, found), counted)


def judged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """`doc` (the whole input row) with its counts, distances and verdict.

    Columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance,
    word_distance (null where not judged), base_failed, kept. A null text counts as empty;
    an empty text fails the base rules. Repeated rows are judged alike, an empty table
    gives no rows, other columns stay inside `doc`.
    """
    text = text_of(F.col("doc.text"))

    def base(words: Column, space: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            (F.length(text) - space).cast("bigint").alias("word_chars"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            character_counts(text, space).alias("characters"),
            hashes(words).alias("repeats"),
        )

    joined = whole(docs).join(
        stored(narrow(references(docs, limits)), "references"), F.col("doc.lang").cast("string").eqNullSafe(F.col("ref_lang")), "left"
    )
    reference = [c for c in joined.columns if c != "doc"]
    split = once(once(joined, words=words_of(text)), space=space_in(text, F.col("words")))
    measured = once(split, m=base(F.col("words"), F.col("space"))).select("doc", *reference, "m.*")
    for step in repeat_steps(limits.window):
        measured = once(measured, repeats=step(F.col("repeats")))
    n = F.col("n_words")
    compared = (n >= limits.least_words) & (F.col("ref_words") >= limits.least_reference)
    measured = once(measured, low=F.when(compared, words_of(F.lower(text))))
    measured = once(measured, found=F.when(F.col("low").isNotNull(), word_counts(F.col("low"), F.col("common"))))
    long = F.col("found").isNotNull()
    failed = (n < limits.base_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * n)
    far = (F.col("class_distance") > limits.class_distance) | (F.col("word_distance") > limits.word_distance)
    return (
        measured.withColumn("n_repeat_words", F.col("repeats").cast("bigint"))
        .withColumn("class_distance", F.when(long, distance(F.col("characters.classes"), F.col("class_share"))))
        .withColumn("word_distance", F.when(long, distance(F.col("found"), F.col("word_share"))))
        .select(
            "doc", "n_words", "word_chars", F.col("characters.symbols").cast("bigint").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
            "class_distance", "word_distance", failed.alias("base_failed"),
            (~failed & ~F.coalesce(far, F.lit(False))).alias("kept"),
        )
    )


def accepted(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of `docs` that the rules keep, unchanged."""
    return judged(docs, limits).where("kept").select("doc.*")
