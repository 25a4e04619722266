"""Quality rules: surface counts, repetition, and divergence from language references. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tianguis.llm.staging import staged

#: Frequent words of the languages that have a reference (fixed values; one row of the reference table each).
COMMON_WORDS: dict[str, list[str]] = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "are", "as", "with", "be", "by"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "au"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"],
}

#: Character classes of the histogram; characters of none of them make up one class more.
CHARACTER_CLASSES = ["[a-z]+", "[A-Z]+", "[0-9]+", r"[\x20\x09-\x0D]+", r"""[.,;:!?'"()-]+""", r"[#*$%&|<>=+@~^_{}\[\]\\/]+"]

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"

MIN_WORDS = 50
#: A document with more of its words than this percentage in repeated 3-word windows fails.
MAX_REPEATED_PERCENT = 50
#: Fewer words than this are too few for a histogram; such a document has no divergence verdict.
MIN_WORDS_FOR_DIVERGENCE = 100
#: A reference needs at least as many words in all.
MIN_REFERENCE_WORDS = 2000
MAX_CHARACTER_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.30
#: At most this share of the distance that a text without any common word has, so that each reference's limit can be passed.
MAX_WORD_SHARE = 0.97


def _removed(text: Column, pattern: str) -> Column:
    """How many characters of `text` the pattern takes away."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeated_words(words: str, windows: str, by_hash: str) -> Column:
    """Words covered by the windows whose hash has an equal neighbour in `by_hash`, the sorted (hash, place) pairs."""
    same = lambda e, j: F.get(F.col(by_hash), j)["h"] == e["h"]
    repeated = F.filter(
        F.col(by_hash), lambda e, i: F.coalesce(same(e, i - 1), F.lit(False)) | F.coalesce(same(e, i + 1), F.lit(False))
    )
    return F.sort_array(F.transform(repeated, lambda e: e["i"]))


def surface_counts(df: DataFrame, text: Column, lang: Column, common_words: Mapping[str, Sequence[str]]) -> DataFrame:
    """`df` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, classes and commons (arrays of counts)."""
    languages = F.lit(None).cast("array<long>")
    for code, listed in common_words.items():
        counts = [F.size("_words") - F.size(F.array_remove("_words", w)) for w in listed]
        languages = F.when(lang == code, F.array(*counts).cast("array<long>")).otherwise(languages)
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.transform("_words", lambda w, i: F.xxhash64(w, F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2)))
    counted = (
        df.withColumn("_text", F.coalesce(text, F.lit("")))
        .withColumn("_words", F.array_remove(F.split("_text", BLANKS), ""))
        .withColumn("_lines", lines)
        .withColumn("_windows", F.slice(windows, 1, F.greatest(F.size("_words") - 2, F.lit(0))))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace("_text", BLANKS, "")).cast("long"))
        .withColumn("n_symbols", _removed(F.col("_text"), SYMBOLS).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("classes", F.array(*[_removed(F.col("_text"), c).cast("long") for c in CHARACTER_CLASSES]))
        .withColumn(
            "classes",
            F.concat("classes", F.array(F.length("_text") - F.aggregate("classes", F.lit(0).cast("long"), lambda s, x: s + x))),
        )
        .withColumn("commons", languages)
        .withColumn(
            "commons",
            F.concat("commons", F.array(F.col("n_words") - F.aggregate("commons", F.lit(0).cast("long"), lambda s, x: s + x))),
        )
    )
    # Most documents repeat no window, which one hash set tells; only the others are sorted.
    some_repeat = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    covered = F.aggregate(
        F.transform("_places", lambda p, j: F.least(F.lit(3), F.coalesce(F.get(F.col("_places"), j + 1) - p, F.lit(3)))),
        F.lit(0),
        lambda s, x: s + x,
    )
    return (
        counted.withColumn("_pairs", F.when(some_repeat, pairs))
        .withColumn("_places", F.when(F.col("_pairs").isNotNull(), _repeated_words("_words", "_windows", "_pairs")))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .drop("_text", "_words", "_lines", "_windows", "_pairs", "_places")
    )


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance (0 to 1, base 2) between two arrays of counts; null where one of them is empty or null."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda a, b: F.when(a > 0, a * F.log2(a * 2 / (a + b))).otherwise(0.0)
    share = lambda a: F.transform(a, lambda x: x / F.nullif(total(a), F.lit(0.0)))
    both = F.zip_with(share(p), share(q), lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(total(both) / 2, F.lit(0.0)))


def quality_rules(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    carry: bool = False,
    common_words: Mapping[str, Sequence[str]] = COMMON_WORDS,
    min_words: int = MIN_WORDS,
    max_repeated_percent: int = MAX_REPEATED_PERCENT,
    min_divergence_words: int = MIN_WORDS_FOR_DIVERGENCE,
    min_reference_words: int = MIN_REFERENCE_WORDS,
    max_character_distance: float = MAX_CHARACTER_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    max_word_share: float = MAX_WORD_SHARE,
) -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, both distances and kept (and `row`, if asked).

    The reference of a language is the sum of the histograms of all its documents that pass the base rules; a document
    is rejected if it fails the base rules or if a histogram of its own is further from its language's reference than
    allowed. How far words can be from a reference depends on how many common words it has, so their limit is at most a
    share of the distance that a text without any has. Distances are null, and reject nothing, for short documents, for languages without a word list (null too)
    and for references over too few words. Null text counts as empty. Repeated rows are judged each for itself.

    One pass reads the texts and stages the counts; references are sums with map-side combining, at most one row for
    each language of `common_words`, which bounds what is broadcast. No row is shuffled by language.
    """
    carried = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []
    source = df.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("_in"), F.col(f"`{lang_col}`").alias("_lang"), *carried
    )
    counts = surface_counts(source, F.col("_in"), F.col("_lang"), common_words).drop("_in")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeated_percent)
    counts = staged(counts.withColumn("base_failed", failed), "quality")
    size = {"classes": len(CHARACTER_CLASSES) + 1, "commons": max(map(len, common_words.values())) + 1}
    reference = (
        counts.filter(F.col("commons").isNotNull() & ~F.col("base_failed"))
        .groupBy("_lang")
        .agg(
            F.sum("n_words").alias("reference_words"),
            *[F.sum(F.get("classes", F.lit(i))).alias(f"classes{i}") for i in range(size["classes"])],
            *[F.sum(F.get("commons", F.lit(i))).alias(f"commons{i}") for i in range(size["commons"])],
        )
        .filter(F.col("reference_words") >= min_reference_words)
        .select(
            "_lang",
            *[
                F.filter(F.array(*[F.col(f"{name}{i}") for i in range(size[name])]), lambda x: x.isNotNull())
                .cast("array<double>")
                .alias(f"ref_{name}")
                for name in size
            ],
        )
    )
    other = F.size("ref_commons") - 1
    without_commons = F.transform("ref_commons", lambda _, i: F.when(i == other, 1.0).otherwise(0.0))
    reach = jensen_shannon(without_commons, F.col("ref_commons"))
    reference = reference.withColumn("_word_limit", F.least(F.lit(max_word_distance), reach * max_word_share))
    distances = counts.join(F.broadcast(reference), "_lang", "left")
    for name in size:
        distance = F.when(
            F.col("n_words") >= min_divergence_words, jensen_shannon(F.col(name).cast("array<double>"), F.col(f"ref_{name}"))
        )
        distances = distances.withColumn(f"{name}_distance", distance)
    diverges = F.coalesce(F.col("classes_distance") > max_character_distance, F.lit(False)) | F.coalesce(
        F.col("commons_distance") > F.col("_word_limit"), F.lit(False)
    )
    return distances.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~diverges).alias("kept"),
        F.col("classes_distance").alias("character_distance"),
        F.col("commons_distance").alias("word_distance"),
        *(["row"] if carry else []),
    )
