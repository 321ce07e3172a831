"""Quality rules: counts that fail a text, and its divergence from references of its language.

Everything is a built-in expression. A text diverges when the Jensen-Shannon distance between its histogram of
character classes and that of its language, or between its histogram of common words and that of its language,
passes a threshold; texts below a minimum length are not judged by a histogram too small to be one.
References are sums over all documents of a language with enough words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterlake.functions.barrier import computed

from .common import column, whole_row, words
from .graphs import stored

# Fixed values of the contract.
SYMBOLS = r"[#*$%&|<>]+"
LEAST_WORDS = 50

# Character classes: what is no running text (lower case and white space), and within it, patterns of everything
# outside a class. The last class is what remains.
RUNNING = r"[\p{Ll}\x20\x09-\x0D]+"
CLASSES = {"upper": r"[^\p{Lu}]+", "digit": r"[^0-9]+", "stop": r"[^.,;:?]+"}


@dataclass(frozen=True)
class Divergence:
    """Parameters of the verdict."""

    common_words: int = 32          # words of a language's reference
    char_distance: float = 0.25     # most distance between character classes
    word_distance: float = 0.45     # most distance between common words
    least_chars: int = 200          # shorter texts are not judged by character classes
    least_words: int = 100          # shorter texts are not judged by common words
    reference_words: int = 2000     # a language with fewer words is judged by the pool of all languages


def _kept_length(text: Column, outside: str) -> Column:
    return F.length(F.regexp_replace(text, outside, "")).cast("long")


def counts(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the text's word list.

    Repeated 3-word windows are found by sorting hashes of windows together with their places: the low bits of a
    hash make room for the place, so one sort of longs does it, in n log n at any length. Texts whose windows are all
    different are not sorted, and only texts with a symbol are searched for all of them.
    """
    full = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(full, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = computed(rows, words(F.col(text)).alias("_words"), lines.alias("_lines"))
    sized = computed(
        split,
        F.size("_words").alias("_n"),
        F.expr("length(bin(size(_words)))").alias("_bits"),
        F.expr("transform(sequence(0, greatest(size(_words) - 3, 0)), "
               "i -> xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2)))").alias("_hashes"))
    ordered = computed(
        sized, F.expr("if(_n < 3 or size(array_distinct(_hashes)) = size(_hashes), array(), sort_array(transform(_hashes, "
                      "(h, i) -> shiftleft(shiftright(h, _bits), _bits) | cast(i as bigint))))").alias("_keys"))
    places = computed(ordered, F.expr(
        "sort_array(transform(filter(_keys, (k, i) -> "
        "shiftright(k, _bits) = shiftright(get(_keys, i - 1), _bits) "
        "or shiftright(k, _bits) = shiftright(get(_keys, i + 1), _bits)), "
        "k -> cast(k & (shiftleft(1L, _bits) - 1) as int)))").alias("_places"))
    return places.select(
        *rows.columns, F.col("_words"),
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.when(full.rlike(SYMBOLS), F.length(full) - F.length(F.regexp_replace(full, SYMBOLS, ""))).otherwise(0)
        .cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("aggregate(transform(_places, (p, i) -> least(3, coalesce(get(_places, i + 1) - p, 3))), "
               "0L, (a, x) -> a + x)").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def class_counts(rows: DataFrame, text: Column, name: str, keep: list[str]) -> DataFrame:
    """``rows`` with the characters of a text per class and, last, all of them, as an array of counts; null for null.

    The classes besides running text are counted in what is left of the text without it, which is short.
    """
    marked = computed(rows, F.struct(F.length(text).cast("long").alias("all"), F.regexp_replace(text, RUNNING, "").alias("rest"))
                      .alias("_marked"), keep=keep)
    rest, full = F.col("_marked.rest"), F.col("_marked.all")
    counted = F.array(full - F.length(rest), *[_kept_length(rest, outside) for outside in CLASSES.values()], full)
    return computed(marked, F.when(full.isNotNull(), counted).alias(name), keep=keep)


def class_shares(counted: Column) -> Column:
    """Shares of the classes and of the remaining characters; ``counted`` is a column, for it is named often."""
    n = len(CLASSES) + 1
    rest = counted[n]
    for i in range(n):
        rest = rest - counted[i]
    return F.array(*[F.when(counted[n] > 0, c / counted[n]).otherwise(F.lit(0.0))
                     for c in [counted[i] for i in range(n)] + [rest]])


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of shares."""

    def part(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def references(docs: DataFrame, settings: Divergence) -> DataFrame:
    """One row per language and one for all (all_languages): class shares, common words and their shares.

    ``docs`` has lang, text, n_words and the lower-cased words of the documents references are drawn from.
    """
    n = len(CLASSES) + 2
    classes = class_counts(docs.select("lang", "n_words", "text"), F.col("text"), "h", ["lang", "n_words"])
    sums = [F.sum(F.col("h")[i]).alias(f"c{i}") for i in range(n)]
    by_class = (classes.rollup("lang").agg(F.grouping("lang").alias("pool"), F.sum("n_words").alias("of_words"), *sums)
                .select("lang", "pool", "of_words", F.array(*[F.col(f"c{i}") for i in range(n)]).alias("h")))
    by_class = computed(by_class, class_shares(F.col("h")).alias("class_ref"), keep=["lang", "pool", "of_words"])
    # Written once: ranked by language and in the pool.
    per_word = stored(docs.select("lang", F.explode("_lowered").alias("word"))
                      .groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    pooled = per_word.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), F.lit(1).alias("pool"), "word", "n")
    ranked = per_word.select("lang", F.lit(0).alias("pool"), "word", "n").unionByName(pooled)
    first = Window.partitionBy("lang", "pool").orderBy(F.desc("n"), "word")
    common = (ranked.withColumn("at", F.row_number().over(first)).where(F.col("at") <= settings.common_words)
              .groupBy("lang", "pool")
              .agg(F.sort_array(F.collect_list(F.struct("at", "word", "n"))).alias("top")))
    joined = by_class.alias("c").join(
        common.alias("w"), F.expr("c.lang <=> w.lang and cast(c.pool as int) = w.pool"))
    known = F.transform("top", lambda t: t["n"].cast("double") / F.col("of_words"))
    return joined.select(
        F.col("c.lang").alias("lang"), (F.col("c.pool") == 1).alias("all_languages"), "of_words", "class_ref",
        F.col("top.word").alias("word_ref"),
        F.concat(known, F.array(1 - F.aggregate(known, F.lit(0.0), lambda s, x: s + x))).alias("share_ref"))


def word_histogram(word_list: Column, common: Column, longest: Column) -> Column:
    """How often each common word, ``longest`` characters at most, occurs in a list, and how many other words there are."""
    short = F.filter(word_list, lambda w: F.length(w) <= longest)
    hits = F.array_remove(F.transform(short, lambda w: F.array_position(common, F.lower(w)).cast("int")), 0)
    return F.struct(F.size(word_list).alias("n"), hits.alias("hits"))


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
          settings: Divergence = Divergence(), carried: Column | None = None) -> DataFrame:
    """``row`` (all columns, or ``carried``), the counts, base_failed, char_distance, word_distance and kept: one row per input row.

    A null text counts as empty and fails. A language that is null or has too little text is judged by the pool
    of all languages. Distances are null where the text is too short to be judged by them; such a text is kept
    when it passes the counts. Without a text of enough words there is no reference and nothing diverges.
    Repeated rows get equal verdicts.
    """
    bare = docs.select((whole_row(docs) if carried is None else carried).alias("row"), column(id_column).alias("doc_id"),
                       column(text_column).alias("text"), column(lang_column).alias("lang"))
    counted = counts(bare).withColumn("base_failed", base_failed())
    texts = docs.select(column(text_column).cast("string").alias("text"), column(lang_column).alias("lang"))
    long_ones = computed(texts, words(F.lower("text")).alias("_lowered")).where(F.size("_lowered") >= LEAST_WORDS).withColumn(
        "n_words", F.size("_lowered").cast("long"))
    # Written once: a few rows, whose known size lets the join below send them to all tasks.
    refs = stored(references(long_ones, settings), "references")
    pool = refs.where("all_languages").select("class_ref", "word_ref", "share_ref").first()
    fallback = [F.lit(None)] * 3 if pool is None else [
        F.array(*[F.lit(x) for x in pool[0]]), F.array(*[F.lit(x) for x in pool[1]]), F.array(*[F.lit(x) for x in pool[2]])]
    own = (refs.where(~F.col("all_languages") & F.col("lang").isNotNull()
                      & (F.col("of_words") >= settings.reference_words))
           .select(F.col("lang").alias("of_lang"), "class_ref", "word_ref", "share_ref"))
    kinds = ("array<double>", "array<string>", "array<double>")
    matched = counted.join(own, F.col("lang") == F.col("of_lang"), "left").select(
        "row", "doc_id", "text", "_words", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", *[F.coalesce(F.col(c), f.cast(k)).alias(c)
                         for c, f, k in zip(("class_ref", "word_ref", "share_ref"), fallback, kinds)])
    # Lower-casing makes no word shorter, so longer words than these are none of the common ones.
    matched = matched.withColumn("_longest", F.coalesce(F.array_max(F.transform("word_ref", F.length)), F.lit(0)))
    carried_on = [c for c in matched.columns if c != "text"]
    judged = F.when(~F.col("base_failed") & (F.length("text") >= settings.least_chars), F.col("text"))
    histograms = computed(
        class_counts(matched, judged, "_counted", carried_on),
        F.when(~F.col("base_failed") & (F.col("n_words") >= settings.least_words),
               word_histogram(F.col("_words"), F.col("word_ref"), F.col("_longest"))).alias("_common"))
    per_word = F.expr("transform(sequence(1, size(word_ref)), "
                      "j -> cast(size(_common.hits) - size(array_remove(_common.hits, j)) as double) / _common.n)")
    other = F.expr("cast(_common.n - size(_common.hits) as double) / _common.n")
    measured = computed(
        computed(histograms,
                 F.when(F.col("_counted").isNotNull(), class_shares(F.col("_counted"))).alias("_classes"),
                 F.when(F.col("_common").isNotNull(), F.concat(per_word, F.array(other))).alias("_share")),
        js_distance(F.col("_classes"), F.col("class_ref")).alias("char_distance"),
        js_distance(F.col("_share"), F.col("share_ref")).alias("word_distance"))
    close = (F.coalesce(F.col("char_distance") <= settings.char_distance, F.lit(True))
             & F.coalesce(F.col("word_distance") <= settings.word_distance, F.lit(True)))
    return measured.select(
        "row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "char_distance", "word_distance", (~F.col("base_failed") & close).alias("kept"))


def keep(docs: DataFrame, **names) -> DataFrame:
    """The documents that pass, with all their columns."""
    return judge(docs, **names).where("kept").select("row.*")
