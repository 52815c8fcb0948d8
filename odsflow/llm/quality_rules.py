"""Quality rules whose cutoffs follow the data of each language and source.

Figures of every text are summed up per (language, source) in a mergeable sketch: counts per
bucket of a log-linear scale, so that adding two sketches is adding their counts and any quantile
is known within 1/32 of its value. Only texts that pass the base rule are summed up, so cutoffs tell
what is unusual among them. A cutoff stands a little outside a high (and for some figures a low)
quantile of the source, whose sketch is merged with that of its language, which weighs as much as
``PRIOR`` rows: a source with few rows leans on its language, one with many goes its own way, and nothing
switches in between. Cutoffs are then joined to the figures. Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odsflow.llm.common import table, written

WINDOW = 5
#: Rows of a source that its language is worth.
PRIOR = 10
#: Figure: (percent of the high quantile, percent of the low one or None, distance of the cutoff from it). Figures
#: are thousandths per word. The base rule cuts ``repeated`` at 200.
FIGURES = {
    "word_length": (95, 5, 1000),
    "symbols": (90, None, 50),
    "dup_lines": (95, None, 5),
    "repeated": (95, None, 80),
}
SPACE = " \t\n\x0b\x0c\r"


def _window_hashes(words: Column) -> Column:
    """A hash for every window of five words, in text order."""
    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def figures(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: the columns given and what the rules look at.

    A null text has no words, like an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    base = docs.withColumns(
        {
            "_words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t\n\x0B\f\r]+")),
            "_lines": F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != ""),
            "word_chars": F.length(F.translate(text, SPACE, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        }
    )
    base = base.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": _window_hashes(F.col("_words")),
        }
    ).drop("_words", "_lines", "text")
    # Most texts repeat nothing; only the others are sorted.
    base = base.withColumn("_repeats", F.size(F.array_distinct("_hashes")) < F.size("_hashes")).withColumn(
        "_pairs",
        F.when(
            F.col("_repeats"),
            F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    same = lambda pair, j: F.get(F.col("_pairs"), j)["h"] == pair["h"]
    base = base.withColumn(
        "_starts",
        F.array_sort(
            F.transform(
                F.filter("_pairs", lambda p, j: F.coalesce(same(p, j + 1), F.lit(False)) | ((j > 0) & same(p, F.greatest(j - 1, F.lit(0))))),
                lambda p: p["i"],
            )
        ),
    )
    gaps = F.transform(
        "_starts", lambda s, j: F.least(F.coalesce(F.get(F.col("_starts"), j + 1) - s, F.lit(WINDOW)), F.lit(WINDOW))
    )
    repeated = F.coalesce(F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap), F.lit(0)).cast("long")
    return base.withColumn("n_repeat_words", repeated).drop("_hashes", "_repeats", "_pairs", "_starts")


def rates(df: DataFrame) -> DataFrame:
    """The figures as whole thousandths per word; 0 for a text without words."""
    def per_word(column: str) -> Column:
        return F.when(F.col("n_words") == 0, F.lit(0)).otherwise(F.expr(f"(1000 * {column}) div n_words")).cast("long")

    return df.withColumns(
        {
            "word_length": per_word("word_chars"),
            "symbols": per_word("n_symbols"),
            "dup_lines": per_word("n_dup_lines"),
            "repeated": per_word("n_repeat_words"),
        }
    )


def bucket(value: Column) -> Column:
    """Bucket of a whole number that is not negative: itself under 32, then 16 for each doubling."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return 16 * shift + F.call_function("shiftright", value, shift).cast("int")


def bucket_value(number: Column) -> Column:
    """Middle of a bucket, as a whole number."""
    shift = F.greatest(F.floor(number / 16).cast("int") - 1, F.lit(0))
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
    return (number - 16 * shift) * width + F.floor(width / 2)


def sketch(df: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """Rows (groups, figure, bucket, n): one mergeable sketch per group and figure."""
    long = df.select(
        *groups,
        F.inline(F.array(*[F.struct(F.lit(c).alias("figure"), bucket(F.col(c)).alias("bucket")) for c in columns])),
    )
    return long.groupBy(*groups, "figure", "bucket").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches added up to the coarser ``groups``."""
    return sketches.groupBy(*groups, "figure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, groups: list[str], percents: list[int]) -> DataFrame:
    """Per group and figure: for each percentage ``p`` as ``q<p>`` the smallest bucket that holds this share of the
    rows at or below it."""
    by = Window.partitionBy(*groups, "figure")
    counted = sketches.withColumns(
        {
            "upto": F.sum("n").over(by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)),
            "rows": F.sum("n").over(by),
        }
    )
    first = lambda p: F.min(F.when(100 * F.col("upto") >= p * F.col("rows"), F.col("bucket")))
    return counted.groupBy(*groups, "figure").agg(*[bucket_value(first(p)).alias(f"q{p}") for p in percents])


def with_prior(fine: DataFrame) -> DataFrame:
    """Sketches per (lang, source), each merged with its language's, which weighs as much as ``PRIOR`` rows.

    Counts become weights: own ones times the rows of the language, plus ``PRIOR`` times the language's.
    """
    number = lambda column: F.col(column).cast("decimal(38,0)")
    wide = merge(fine, ["lang"]).select(F.col("lang").alias("l"), F.col("figure").alias("f"), F.col("bucket").alias("b"), number("n").alias("m"))
    size = wide.groupBy("l", "f").agg(F.sum("m").alias("size"))
    same = F.col("lang").eqNullSafe(F.col("l")) & (F.col("figure") == F.col("f"))
    weight = lambda w: w.cast("decimal(38,0)").alias("n")
    own = fine.join(size, same).select("lang", "source", "figure", "bucket", weight(number("n") * F.col("size").cast("decimal(19,0)")))
    groups = fine.select("lang", "source", "figure").distinct()
    prior = groups.join(wide, same).select("lang", "source", "figure", F.col("b").alias("bucket"), weight(F.col("m") * PRIOR))
    return merge(own.unionByName(prior), ["lang", "source"])


def fences(df: DataFrame) -> DataFrame:
    """Rows (lang, source, low_..., high_...): cutoffs of every language and source of ``df``."""
    mixed = with_prior(sketch(df, ["lang", "source"], list(FIGURES)))
    percents = sorted({p for high, low, _ in FIGURES.values() for p in (high, low) if p is not None})
    found = quantiles(mixed, ["lang", "source"], percents)
    columns = []
    for figure, (high, low, slack) in FIGURES.items():
        mine = F.col("figure") == figure
        columns.append(F.max(F.when(mine, F.col(f"q{high}") + slack)).alias(f"high_{figure}"))
        if low is not None:
            columns.append(F.max(F.when(mine, F.col(f"q{low}") - slack)).alias(f"low_{figure}"))
    return found.groupBy("lang", "source").agg(*columns)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def adaptive_rules(docs: DataFrame, ids: list[str]) -> DataFrame:
    """Rows (ids, figures, ``base_failed``, ``kept``) for every row of ``docs``.

    ``docs`` needs ``text``, ``lang`` and ``source``; null is a language or source of its own.
    A text that fails the base rule is dropped; any other is kept when all its figures are inside
    the cutoffs of its language and source. Repeated rows count as often as they occur.
    """
    slim = docs.select(*ids, "lang", "source", "text")
    known = written(rates(figures(slim)), "quality-figures")
    cut = fences(known.where(~base_failed())).withColumnsRenamed({"lang": "cut_lang", "source": "cut_source"})
    joined = known.join(
        cut, known["lang"].eqNullSafe(cut["cut_lang"]) & known["source"].eqNullSafe(cut["cut_source"]), "left"
    )
    inside = F.lit(True)
    for figure, (_, low, _) in FIGURES.items():
        inside = inside & (F.col(figure) <= F.col(f"high_{figure}"))
        if low is not None:
            inside = inside & (F.col(figure) >= F.col(f"low_{figure}"))
    return joined.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & inside}).drop("cut_lang", "cut_source")


def op6_adaptive_thresholds(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` under the base rule and the cutoffs of its language and source."""
    return adaptive_rules(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql() -> str:
    shift = "greatest(length(bin({0})) - 5, 0)"
    exponent = "greatest({0} // 16 - 1, 0)"
    value = f"(({{0}} - 16 * {exponent}) * (1::BIGINT << {exponent}) + (1::BIGINT << {exponent}) // 2)"
    passed = "NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
    unpivot = " UNION ALL ".join(f"SELECT lang, source, '{f}' AS figure, {f} AS v FROM rated WHERE {passed}" for f in FIGURES)
    percents = sorted({p for high, low, _ in FIGURES.values() for p in (high, low) if p is not None})
    return f"""
WITH split AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS lines
    FROM documents),
numbered AS (SELECT doc_id, row_number() OVER () AS row, lang, source, text, words, lines FROM split),
windows AS (
    SELECT row, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w
    FROM (SELECT row, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM numbered)),
repeats AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, w) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + {WINDOW})) AS place FROM repeats) GROUP BY row),
counted AS (
    SELECT numbered.row, doc_id, lang, source, len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM numbered LEFT JOIN covered ON covered.row = numbered.row),
rated AS (
    SELECT *, CASE WHEN n_words = 0 THEN 0 ELSE 1000 * word_chars // n_words END AS word_length,
        CASE WHEN n_words = 0 THEN 0 ELSE 1000 * n_symbols // n_words END AS symbols,
        CASE WHEN n_words = 0 THEN 0 ELSE 1000 * n_dup_lines // n_words END AS dup_lines,
        CASE WHEN n_words = 0 THEN 0 ELSE 1000 * n_repeat_words // n_words END AS repeated
    FROM counted),
long AS ({unpivot}),
own AS (
    SELECT lang, source, figure, 16 * {shift.format("v")} + (v >> {shift.format("v")}) AS b, count(*)::HUGEINT AS n
    FROM long GROUP BY ALL),
wide AS (SELECT lang, figure, b, sum(n)::HUGEINT AS n FROM own GROUP BY ALL),
size AS (SELECT lang, figure, sum(n)::HUGEINT AS n FROM wide GROUP BY ALL),
mixed AS (
    SELECT o.lang, o.source, o.figure, o.b, o.n * s.n AS w FROM own o JOIN size s ON o.lang IS NOT DISTINCT FROM s.lang AND o.figure = s.figure
    UNION ALL
    SELECT g.lang, g.source, g.figure, w.b, {PRIOR} * w.n FROM (SELECT DISTINCT lang, source, figure FROM own) g
    JOIN wide w ON g.lang IS NOT DISTINCT FROM w.lang AND g.figure = w.figure),
summed AS (SELECT lang, source, figure, b, sum(w)::HUGEINT AS w FROM mixed GROUP BY ALL),
running AS (
    SELECT *, sum(w) OVER (PARTITION BY lang, source, figure ORDER BY b) AS upto, sum(w) OVER (PARTITION BY lang, source, figure) AS total
    FROM summed),
ranked AS (
    SELECT lang, source, figure, {", ".join(f"min(b) FILTER (100 * upto >= {p} * total) AS b{p}" for p in percents)}
    FROM running GROUP BY ALL),
cut AS (SELECT lang, source, figure, {", ".join(value.format(f"b{p}") + f" AS q{p}" for p in percents)} FROM ranked),
judged AS (
    SELECT r.row, bool_and(CASE figure {" ".join(
        f"WHEN '{f}' THEN r.{f} <= q{high} + {slack}" + (f" AND r.{f} >= q{low} - {slack}" if low is not None else "")
        for f, (high, low, slack) in FIGURES.items())} END) AS inside
    FROM rated AS r LEFT JOIN cut ON r.lang IS NOT DISTINCT FROM cut.lang AND r.source IS NOT DISTINCT FROM cut.source
    GROUP BY r.row)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND inside AS kept
FROM rated JOIN judged ON judged.row = rated.row
"""


SQL = _sql()
