"""Personal data by bootstrapped contextual extraction, in built-in expressions only.

Base entities (e-mail, ip, card, phone) are found by patterns in whole texts and checked. They are the seeds: the
words before and after them are lexical patterns. Words with digits that no base entity covers are the other
instances. Spark scores the graph of patterns and instances in rounds: a pattern's confidence is the share of all
its occurrences in the corpus that are filled by seeds or by instances believed so far; an instance is believed by
the noisy-or of its patterns. Instances inside patterns of high confidence induce patterns as seeds do, and all is
scored again, until no pattern and no instance is added and no confidence rises. Occurrences inside patterns of high confidence are reported
as further spans, with the kind of the seeds or instances that the pattern came from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterlake.functions.barrier import computed

from .common import column, whole_row, words
from .graphs import stored

# Kinds in the order of the contract. Each pattern starts only where a match can begin and never gives
# back what it took, which leaves the matches the same and keeps the search linear in the text.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "word": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+",
}
# What a text must contain for a pattern to be tried.
HINTS = {"email": "@", "phone": "+"}
CONTEXT = 256


@dataclass(frozen=True)
class Settings:
    rounds: int = 2            # rounds of scoring after each step of induction
    seeds: int = 3             # distinct seeds or believed instances that a pattern needs
    rise: float = 0.01         # rise of a confidence up to which scoring has settled
    floor: float = 0.05        # confidence below which a pattern believes nothing
    confidence: float = 0.4    # confidence from which a pattern discovers
    smoothing: float = 2.0     # occurrences added to every pattern
    digits: int = 4            # digits that a further instance needs


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> tuple[Column, Column]:
    key = F.coalesce(column(id_column).cast("string"), F.lit("")), column(id_column).isNull(), column(text_column).cast("string")
    return F.xxhash64(*key).alias("k1"), F.hash(*key).alias("k2")


def _hits(text: Column, kind: str) -> Column:
    """Matches of a pattern with the text before, between and after them."""
    pattern = PATTERNS[kind]
    tried = text.contains(HINTS[kind]) if kind in HINTS else text.rlike("[0-9]")
    return F.when(tried, F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")))


def _occurrences(rows: DataFrame) -> DataFrame:
    """k1, k2, kind, start, end, hit, before, after: all matches of all patterns; rows has k1, k2 and text."""
    names = list(PATTERNS)
    found = computed(rows, *[_hits(F.col("text"), k).alias(f"_{k}") for k in names], keep=["k1", "k2"])

    def listed(kind: str) -> str:
        return (f"transform(sequence(0, coalesce(size(_{kind}.hits), 0)), i -> named_struct('kind', '{kind}', 'pos', i, "
                f"'lead', length(get(_{kind}.gaps, i)), 'hit', get(_{kind}.hits, i), "
                f"'before', coalesce(nullif(regexp_extract(right(get(_{kind}.gaps, i), {CONTEXT}), '([^\\\\x20\\\\x09-\\\\x0D]+)[\\\\x20\\\\x09-\\\\x0D]*\\\\z', 1), ''), get(_{kind}.hits, i - 1)), "
                f"'after', coalesce(nullif(regexp_extract(left(get(_{kind}.gaps, i + 1), {CONTEXT}), '\\\\A[\\\\x20\\\\x09-\\\\x0D]*([^\\\\x20\\\\x09-\\\\x0D]+)', 1), ''), get(_{kind}.hits, i + 1))))")

    some = " or ".join(f"size(_{k}.hits) > 0" for k in names)
    each = found.where(some).select("k1", "k2", F.inline(F.expr(f"concat({', '.join(listed(k) for k in names)})"))).where("hit is not null")
    # Repeated rows have the same keys and the same matches.
    each = each.groupBy("k1", "k2", "kind", "pos").agg(*[F.first(c).alias(c) for c in ("lead", "hit", "before", "after")])
    so_far = Window.partitionBy("k1", "k2", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("hit")
    end = F.sum(F.col("lead") + size).over(so_far)
    return each.select("k1", "k2", "kind", (end - size).alias("start"), end.alias("end"), "hit",
                       F.lower("before").alias("before"), F.lower("after").alias("after"))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether digits pass the Luhn check."""
    places = F.sequence(F.lit(1), F.length(digits))

    def weighed(i):
        value = F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(value > 9, value - 9).otherwise(value)

    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid() -> Column:
    """Checks of the base kinds; matches that fail are dropped."""
    size = F.length(_digits(F.col("hit")))
    short = F.transform(F.split("hit", r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    small = F.forall(short, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    return (F.when(F.col("kind") == "email", True)
            .when(F.col("kind") == "ip", small)
            .when(F.col("kind") == "card", size.between(16, 19) & _luhn(F.when(size <= 19, _digits(F.col("hit"))).otherwise("0")))
            .when(F.col("kind") == "phone", size.between(8, 15)))


def _patterns(occurrences: DataFrame) -> DataFrame:
    """side, word, kind, instance: the lexical patterns of every occurrence."""
    return occurrences.select(
        "kind", F.lower("hit").alias("instance"),
        F.explode(F.array(F.struct(F.lit("before").alias("side"), F.col("before").alias("word")),
                          F.struct(F.lit("after").alias("side"), F.col("after").alias("word")))).alias("p")
    ).select("p.side", "p.word", "kind", "instance").where("word is not null")


def _further(words_with_digits: DataFrame, base: DataFrame, settings: Settings) -> DataFrame:
    """Words with enough digits that touch no base span, cut to their core."""
    core = F.regexp_extract("hit", r"[A-Za-z0-9].*[A-Za-z0-9]", 0)
    lead = F.length(F.regexp_extract("hit", r"\A[^A-Za-z0-9]*", 0))
    cut = words_with_digits.where(F.length(_digits(F.col("hit"))) >= settings.digits).select(
        "k1", "k2", (F.col("start") + lead).alias("start"), (F.col("start") + lead + F.length(core)).alias("end"),
        core.alias("hit"), "before", "after")
    b = base.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("start").alias("from"), F.col("end").alias("to"))
    touch = (F.col("k1") == F.col("b1")) & (F.col("k2") == F.col("b2")) & (F.col("start") < F.col("to")) & (F.col("from") < F.col("end"))
    return cut.join(b, touch, "left_anti")


def confident_patterns(base: DataFrame, further: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """side, word, kind, confidence of the patterns that discover."""
    of_seeds = _patterns(base).groupBy("side", "word", "kind").agg(
        F.count("*").alias("seeded"), F.count_distinct("instance").alias("distinct"))
    edges = stored(_patterns(further.withColumn("kind", F.lit("further"))).groupBy("side", "word", "instance")
                   .agg(F.count("*").alias("n")), "edges")
    # Below so many instances of either sort nothing is induced, in no round.
    met = of_seeds.select("side", "word", "distinct").union(
        edges.groupBy("side", "word").agg(F.count("*").alias("distinct"))).groupBy("side", "word").agg(F.sum("distinct").alias("distinct"))
    able = met.where(F.col("distinct") >= settings.seeds).select("side", "word")
    # How often a pattern's word occurs at all; a word with digits is not counted apart from the others.
    total = texts.select(F.explode(words(F.lower("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("total"))
    able = stored(able.join(total, "word"), "able")
    of_seeds = stored(of_seeds.join(able.select("side", "word"), ["side", "word"], "left_semi"), "seeds")
    edges = stored(edges.join(able.select("side", "word"), ["side", "word"], "left_semi"), "edges")

    def confidence(believed: Column) -> Column:
        return F.least((F.col("seeded") + believed) / (F.col("total") + settings.smoothing), F.lit(0.999))

    support, before, size = of_seeds, None, -1
    while True:
        by_pattern = support.groupBy("side", "word").agg(
            F.sum("seeded").alias("seeded"), F.sum("distinct").alias("distinct"),
            F.max_by("kind", F.struct("seeded", "distinct", "kind")).alias("kind")).where(F.col("distinct") >= settings.seeds)
        known = stored(by_pattern.join(able, ["side", "word"]), "patterns")
        scored = known.withColumn("confidence", confidence(F.lit(0.0)))
        if before is not None:
            scored = scored.join(before, ["side", "word"], "left").withColumn("confidence", F.greatest("confidence", "was")).drop("was")
        for _ in range(settings.rounds - 1):
            useful = scored.where(F.col("confidence") >= settings.floor).select("side", "word", "confidence")
            belief = edges.join(useful, ["side", "word"]).groupBy("instance").agg(
                (1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("belief"))
            gained = edges.join(belief, "instance").groupBy("side", "word").agg(F.sum(F.col("n") * F.col("belief")).alias("gained"))
            scored = known.join(gained, ["side", "word"], "left").withColumn("confidence", confidence(F.coalesce("gained", F.lit(0.0))))
        scored = stored(scored, "scored")
        if before is None:
            risen = not scored.isEmpty()
        else:
            risen = not scored.join(before, ["side", "word"], "left").where(
                F.col("confidence") > F.coalesce("was", F.lit(-1.0)) + settings.rise).isEmpty()
        before = scored.select("side", "word", F.col("confidence").alias("was"))
        sure = scored.where(F.col("confidence") >= settings.confidence).select("side", "word", "kind", "confidence")
        # What stands in a pattern that discovers is believed and induces patterns as seeds do; the sets only grow.
        believed = stored(edges.join(sure, ["side", "word"]).groupBy("instance").agg(
            F.max_by("kind", F.struct("confidence", "kind")).alias("kind")), "believed")
        last, size = size, believed.count()
        if size == last and not risen:
            return sure
        # Occurrences of believed instances count by belief, in the scoring above, and not as seeds.
        induced = edges.join(believed, "instance").groupBy("side", "word", "kind").agg(
            F.lit(0).cast("long").alias("seeded"), F.count("*").alias("distinct"))
        support = of_seeds.unionByName(induced)


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         settings: Settings = Settings()) -> DataFrame:
    """k1, k2, base, all: the spans of every text that has any, one row per distinct id and text.

    Spans are structs of place (of the kind in KINDS), start and end in code points, sorted. A null or empty text has
    none. Spans that the method adds overlap no base span. Ids may be null or repeated: a row is known by hashes of
    its id and text (k1, k2), and repeated rows have one entry.
    """
    k1, k2 = _keyed(docs, id_column, text_column)
    rows = docs.select(k1, k2, column(text_column).cast("string").alias("text")).where("text is not null")
    occurrences = stored(_occurrences(rows), "occurrences")
    base = occurrences.where(F.col("kind") != "word").where(_valid())
    further = _further(occurrences.where("kind = 'word'"), base, settings)
    chosen = confident_patterns(base, further, rows.select("text"), settings)

    def inside(side: str) -> DataFrame:
        of_side = chosen.where(F.col("side") == side).select(F.col("word").alias(side), F.col("kind").alias("found"), "confidence")
        return further.join(of_side, side).select("k1", "k2", "start", "end", "found", "confidence")

    added = inside("before").union(inside("after")).groupBy("k1", "k2", "start", "end").agg(
        F.max_by("found", F.struct("confidence", "found")).alias("kind")).select("k1", "k2", "kind", "start", "end", F.lit(False).alias("seed"))
    everything = base.select("k1", "k2", "kind", "start", "end", F.lit(True).alias("seed")).union(added)
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct(place.alias("place"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    return everything.groupBy("k1", "k2").agg(
        F.sort_array(F.collect_list(F.when(F.col("seed"), span))).alias("base"), F.sort_array(F.collect_list(span)).alias("all"))


def shown(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["place"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def attach(docs: DataFrame, spans: DataFrame, carried: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """row (``carried`` of every input row), base and all spans; empty lists where there are none."""
    k1, k2 = _keyed(docs, id_column, text_column)
    none = F.array().cast("array<struct<place: int, start: bigint, end: bigint>>")
    return docs.select(carried.alias("row"), k1, k2).join(spans, ["k1", "k2"], "left").select(
        "row", F.coalesce("base", none).alias("base"), F.coalesce("all", none).alias("all"))


def mask(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents with every span of their text replaced by its kind in brackets, all other columns kept.

    Where spans of different kinds overlap, the one that starts first (then the longer) is replaced and those that
    begin inside it are only cut off. n_chars, where a column of that name exists, is counted anew.
    """
    found = attach(docs, find(docs, id_column, text_column, settings), whole_row(docs), id_column, text_column)
    kinds = ", ".join(f"'[{k}]'" for k in KINDS)
    ordered = found.withColumn("_s", F.array_sort("all", lambda a, b: F.when(a["start"] != b["start"], (a["start"] - b["start"]).cast("int"))
                                                  .otherwise((b["end"] - a["end"]).cast("int"))))
    text = "row.`" + text_column.replace("`", "``") + "`"
    masked = F.expr(
        f"case when size(_s) = 0 then {text} else aggregate(_s, named_struct('at', 0L, 'out', array('')), "
        f"(a, s) -> if(s.end <= a.at, a, named_struct('at', s.end, 'out', concat(a.out, array("
        f"substring({text}, cast(a.at + 1 as int), cast(greatest(s.start - a.at, 0) as int)), "
        f"element_at(array({kinds}), s.place))))), "
        f"a -> concat(array_join(a.out, ''), substring({text}, cast(a.at + 1 as int)))) end")
    kept = computed(ordered, masked.alias("_masked"), keep=["row"])

    def output(name: str) -> Column:
        if name == text_column:
            return F.col("_masked").alias(name)
        if name == "n_chars":
            return F.length("_masked").cast(dict(docs.dtypes)[name]).alias(name)
        return F.col("row")[name].alias(name)

    return kept.select(*[output(c) for c in docs.columns])
