"""Quality rules with adaptive thresholds: fences from mergeable quantile sketches per language and source.

Measures are taken once per document and stored narrow; the sketches are merged from small to large groups, the
fences are joined back, and a document is kept if no measure lies beyond its group's fences. Most documents have none of
what the shares measure, so a sketch holds the part of a group that has some: there lie quartiles that tell a usual
share from an odd one. No measure has a fixed cutoff. Built-in functions only.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.session import stage

# --- Fixed values: the characters that the base rules name -----------------------------
BLANKS = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"

MEASURES = ("symbol_share", "dup_line_share", "repeat_share", "word_length")


@dataclass(frozen=True)
class Fences:
    """A fence lies `reach` interquartile ranges beyond the quartile.

    The quartiles of a group with n values below `least` count n / `least`, and those of its language the rest; so do
    the quartiles of a language beside those of all documents.
    """

    reach: float = 4.0
    least: int = 50
    k: int = 200


def word_list(text: Column) -> Column:
    """Words of the whole text: runs without blank, tab and line ends."""
    inner = F.trim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{BLANKS}]+"))


def measures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, source, the base counts and the measures.

    A 3-word window becomes one long: 44 bits of its hash above 20 bits of its place. Sorted, equal windows are
    neighbours. Texts of more than 2**20 words, and the rare texts in which neighbours agree in 44 bits but not in
    the whole hash, are counted by the whole hashes instead.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    # Each step is its own projection, so that word and line lists are built once per text.
    rows = docs.select("doc_id", "lang", "source", text)
    rows = rows.select(
        "doc_id", "lang", "source",
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        word_list(F.col("text")).alias("_words"),
        F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "").alias("_lines"),
    )
    rows = rows.select(
        "doc_id", "lang", "source", "n_symbols",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_words").alias("_n"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").alias("_n_lines"),
        F.expr(
            "CASE WHEN size(_words) < 3 THEN cast(array() AS array<bigint>) "
            "ELSE transform(sequence(0, size(_words) - 3), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])) END"
        ).alias("_hashes"),
    )
    rows = rows.withColumn(
        "_sorted",
        F.expr("sort_array(transform(_hashes, (h, i) -> shiftleft(h, 20) | cast(i & 1048575 AS bigint)))"),
    )
    # Sorted entries that agree with the one before them, and the places of both.
    rows = rows.withColumn(
        "_again",
        F.expr(
            "CASE WHEN size(_sorted) < 2 THEN cast(array() AS array<int>) ELSE filter(sequence(1, size(_sorted) - 1), "
            "j -> shiftright(_sorted[j], 20) = shiftright(_sorted[j - 1], 20)) END"
        ),
    )
    rows = rows.withColumn(
        "_pairs",
        F.expr(
            "transform(_again, j -> array(cast(_sorted[j - 1] & 1048575 AS int), cast(_sorted[j] & 1048575 AS int)))"
        ),
    )
    unsure = "size(_hashes) > 1048576 OR exists(_pairs, p -> _hashes[p[0]] != _hashes[p[1]])"
    ranked = "sort_array(transform(_hashes, (h, i) -> struct(h AS h, i AS i)))"
    exact = (
        f"flatten(filter(transform(array({ranked}), s -> transform(s, (v, j) -> "
        "CASE WHEN j > 0 AND s[j - 1].h = v.h THEN array(s[j - 1].i, v.i) ELSE cast(array() AS array<int>) END))[0], "
        "p -> size(p) > 0))"
    )
    places = f"array_sort(array_distinct(CASE WHEN {unsure} THEN {exact} ELSE flatten(_pairs) END))"
    rows = rows.withColumn("_places", F.expr(places))
    covered = (
        "aggregate(_places, named_struct('n', 0L, 'last', -3), (a, p) -> named_struct("
        "'n', a.n + least(3, p - a.last), 'last', p), a -> a.n)"
    )
    n = F.col("_n").cast("double")
    some = lambda c, of: F.when(of > 0, c / of).otherwise(0.0)
    rows = rows.withColumn("n_repeat_words", F.expr(covered))
    return rows.select(
        "doc_id", "lang", "source", F.col("_n").cast("long").alias("n_words"),
        "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        some(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        some(F.col("n_dup_lines"), F.col("_n_lines")).alias("dup_line_share"),
        some(F.col("n_repeat_words"), n).alias("repeat_share"),
        some(F.col("word_chars"), n).alias("word_length"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fences(measured: DataFrame, rule: Fences = Fences()) -> DataFrame:
    """Fences per (lang, source): columns lang, source, low_<measure> and high_<measure>; null where no document has any
    of the measure.

    Sketches are built over the values above 0 of rows that pass the base rules, merged from (lang, source) to languages
    and to all.
    """
    part = {m: F.when(F.col(m) > 0, F.col(m)) for m in MEASURES}
    kinds = [F.kll_sketch_agg_double(v, F.lit(rule.k)).alias(m) for m, v in part.items()]
    numbers = [F.count(v).alias(f"n_{m}") for m, v in part.items()]
    groups = measured.filter(~base_failed()).groupBy("lang", "source").agg(*numbers, *kinds)
    merged = [
        c for m in MEASURES for c in (F.sum(f"n_{m}").alias(f"n_{m}"), F.kll_merge_agg_double(m, F.lit(rule.k)).alias(m))
    ]

    def bounds(name: str) -> list[Column]:
        out = [F.col(f"n_{m}").alias(f"{name}_n_{m}") for m in MEASURES]
        for m in MEASURES:
            for at, q in (("q1", 0.25), ("q3", 0.75)):
                value = F.when(F.col(f"n_{m}") > 0, F.kll_sketch_get_quantile_double(F.col(m), F.lit(q)))
                out.append(value.alias(f"{name}_{m}_{at}"))
        return out

    groups = stage(groups, "quality-sketches")
    by_lang = groups.groupBy(F.col("lang").alias("_lang")).agg(*merged)
    overall = groups.agg(*merged)
    own = groups.select("lang", "source", *bounds("own"))
    wide = by_lang.select("_lang", *bounds("lang"))
    every = overall.select(*bounds("all"))  # one row
    rows = own.join(wide, F.col("lang").eqNullSafe(F.col("_lang"))).join(every, F.lit(True), "left")

    def blend(name: str, m: str, at: str, outer: Column) -> Column:
        """The group's quartile by its number of values, the outer group's for the rest; a side without any has no say."""
        share, inner = F.least(F.lit(1.0), F.col(f"{name}_n_{m}") / F.lit(rule.least)), F.col(f"{name}_{m}_{at}")
        return F.coalesce(share * inner + (1 - share) * outer, inner, outer)

    out = [F.col("lang"), F.col("source")]
    for m in MEASURES:
        q1, q3 = (blend("own", m, at, blend("lang", m, at, F.col(f"all_{m}_{at}"))) for at in ("q1", "q3"))
        width = rule.reach * (q3 - q1)
        out += [(q1 - width).alias(f"low_{m}"), (q3 + width).alias(f"high_{m}")]
    return rows.select(*out)


def quality(docs: DataFrame, rule: Fences = Fences()) -> DataFrame:
    """Per row of `docs`: doc_id, the base counts, base_failed, the measures, and kept.

    Null and empty texts have no word and fail the base rules. Null languages and sources are groups of their own.
    A group without any passing row has no fences: all its rows fail the base rules anyway. Repeated rows are judged
    alike. An empty table gives an empty result. Other columns are not looked at.
    """
    measured = stage(measures(docs), "quality-measures")
    limits = fences(measured, rule).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = measured.join(
        limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    within = F.lit(True)
    for m in MEASURES:
        # Only a dearth of length is a fault on the low side; shares have no lower fence.
        high = F.coalesce(F.col(m) <= F.col(f"high_{m}"), F.lit(True))
        within = within & high
        if m == "word_length":
            within = within & F.coalesce(F.col(m) >= F.col(f"low_{m}"), F.lit(True))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & within).alias("kept"), *MEASURES,
    )
