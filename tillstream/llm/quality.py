"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every document gets counts (words, symbols, repeated lines and words) and from them whole-number rates. Per language
and source each rate is summarised by a mergeable quantile sketch: counts in log-linear buckets of a relative
width of at most 1/16, so that sketches of tasks, sources or days merge by adding counts, and the result never
depends on order. Documents that fail the base rule are left out. A rate is too high beyond the group's QUANTILE
plus a margin: MARGIN widths of that quantile's bucket, which about doubles it, or the rule's allowance if that is
more. No threshold has a ceiling: a group that is uneven or unusual by nature sets its own. Groups of
fewer than LEAST_DOCS documents say little about rare values, so they take the greater of their own threshold and
that of their language, small languages also that of all documents. The thresholds, one row per group, are then
joined to the documents.

The base rule does not adapt: fewer than 10 words, or over a fifth of the words in repeated five-word windows.
Null and empty texts have no words and fail it. Null and empty lang or source are one group. Rows are judged
one by one, so repeated rows get the same verdict. Windows are compared by a hash: a text of n words keeps
64 - log2(n) bits of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.arrays import shared_folder
from tillstream.llm.components import written

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEAT = 20  # per cent
QUANTILE = 90  # per cent
MARGIN = 16
LEAST_DOCS = 100
# Rate -> allowance above the group's quantile: symbols per 1000 letters, repeated lines and words per 1000, tenths of
# letters per word. Documents at the threshold stay.
ALLOWANCES = {"symbol_rate": 50, "line_rate": 300, "repeat_rate": 100, "letter_rate": 0}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACE = " \\t\\n\\x0B\\f\\r"


def with_counts(docs: DataFrame, prefix: str = "") -> DataFrame:
    """All columns and the counts of each text; columns of these names are replaced."""
    text = F.coalesce("text", F.lit(""))
    words, lines, hashes, windows, at = (f"_{n}" for n in ("words", "lines", "hashes", "windows", "at"))
    out = docs.withColumns({
        words: F.array_remove(F.split(text, f"[{_SPACE}]+"), ""),
        lines: F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{_SPACE}]")),
        prefix + "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
    })
    out = out.withColumns({
        prefix + "n_words": F.size(words).cast("long"),
        prefix + "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
        prefix + "n_lines": F.size(lines).cast("long"),
        prefix + "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        hashes: F.transform(words, lambda w: F.xxhash64(w)),
    })
    starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
    out = out.withColumn(
        windows, F.transform(starts, lambda _, i: F.xxhash64(*(F.get(F.col(hashes), i + k) for k in range(WINDOW))))
    )
    # Hash in the high bits, place in the low ones: sorted numbers put equal windows side by side.
    bits = F.length(F.bin(F.size(windows).cast("long")))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    out = out.withColumn("_mask", mask)
    packed = F.sort_array(
        F.transform(windows, lambda h, i: h.bitwiseAND(F.bitwise_not("_mask")).bitwiseOR(i.cast("long")))
    )
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    none = F.array().cast("array<bigint>")
    out = out.withColumn(at, F.when(repeated, packed).otherwise(none))
    window = F.bitwise_not("_mask")

    def twice(value: Column, i: Column) -> Column:
        before, after = (F.get(F.col(at), i + step).bitwiseAND(window) for step in (-1, 1))
        own = value.bitwiseAND(window)
        return F.coalesce(before == own, F.lit(False)) | F.coalesce(after == own, F.lit(False))

    places = F.sort_array(F.transform(F.filter(at, twice), lambda value: value.bitwiseAND(F.col("_mask"))))
    out = out.withColumn(at, places)
    covered = F.transform(
        at, lambda p, i: F.least(F.lit(WINDOW).cast("long"), F.coalesce(F.get(F.col(at), i + 1) - p, F.lit(WINDOW)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumn(prefix + "n_repeat_words", total).drop(words, lines, hashes, windows, at, "_mask")


def rates(prefix: str = "") -> dict[str, Column]:
    def part(share: str, of: str, times: int) -> Column:
        return F.expr(f"{times} * {prefix}{share} div greatest({prefix}{of}, 1)")

    return {
        "symbol_rate": part("n_symbols", "word_chars", 1000),
        "line_rate": part("n_dup_lines", "n_lines", 1000),
        "repeat_rate": part("n_repeat_words", "n_words", 1000),
        "letter_rate": part("word_chars", "n_words", 10),
    }


def base_failed(prefix: str = "") -> Column:
    words, repeat = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeat > MOST_REPEAT * words)


def sketches(rated: DataFrame) -> DataFrame:
    """(lang, source, rule, bucket, n); sketches merge by adding n."""
    long = rated.select(
        "_lang", "_source", F.explode(F.create_map(*(x for r in ALLOWANCES for x in (F.lit(r), F.col("_" + r))))).alias("rule", "v")
    )
    # Only the five highest binary digits count: a bucket is named by its greatest value.
    cut = "greatest(length(bin(v)) - 5, 0)"
    most = F.expr(f"shiftleft(shiftright(v, {cut}) + 1, {cut}) - 1")
    return long.groupBy("_lang", "_source", "rule", most.alias("bucket")).agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source) -> one threshold per rule."""
    own, total = "sum(n) over (partition by {0}, rule order by bucket)", "sum(n) over (partition by {0}, rule)"
    found = sketch.select("_lang", "_source").distinct()
    for level, keys in (("source", ["_lang", "_source"]), ("lang", ["_lang"]), ("all", ["_every"])):
        merged = sketch.withColumn("_every", F.lit(0)).groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
        by = ", ".join(keys)
        cut = merged.select(
            *keys, "rule", "bucket", F.expr(total.format(by)).alias("docs"), F.expr(own.format(by)).alias("upto")
        )
        high = F.min(F.when(100 * F.col("upto") >= QUANTILE * F.col("docs"), F.col("bucket"))).alias("high")
        limits = cut.groupBy(*keys, "rule").agg(F.max("docs").alias("docs"), high)
        width = F.expr("shiftleft(1L, greatest(length(bin(high)) - 5, 0))")
        limits = limits.groupBy(*keys).agg(
            F.max("docs").alias(f"{level}_docs"),
            *(
                F.max(F.when(F.col("rule") == r, F.col("high") + F.greatest(MARGIN * width, F.lit(a)))).alias(f"{level}_{r}")
                for r, a in ALLOWANCES.items()
            ),
        )
        found = found.withColumn("_every", F.lit(0)).join(limits, keys)
    enough, language = F.col("source_docs") >= LEAST_DOCS, F.col("lang_docs") >= LEAST_DOCS

    def threshold(rule: str) -> Column:
        by_source, by_lang, by_all = (F.col(f"{level}_{rule}") for level in ("source", "lang", "all"))
        return (
            F.when(enough, by_source).when(language, F.greatest(by_source, by_lang))
            .otherwise(F.greatest(by_source, by_lang, by_all)).alias(f"_most_{rule}")
        )

    return found.select("_lang", "_source", *map(threshold, ALLOWANCES))


def judge(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The columns to carry (all), the counts, base_failed and kept, which replace columns of that name."""
    new = [*COUNTS, "base_failed", "kept"]
    carry = [c for c in carry or docs.columns if c not in new]
    keys = {"_lang": F.coalesce("lang", F.lit("")), "_source": F.coalesce("source", F.lit(""))}
    # Carried columns travel in one struct, out of the way of the working columns.
    packed = docs.select(F.struct(*(F.col(c) for c in carry)).alias("_row"), "text", "lang", "source")
    rated = with_counts(packed, "_c_").withColumns(keys)
    rated = rated.withColumns({"_" + name: rate for name, rate in rates("_c_").items()})
    # Counting is the costly part: it is done once, both the sketches and the verdicts read the table.
    rated = rated.select("_row", *keys, *("_c_" + c for c in (*COUNTS, "n_lines")), *("_" + r for r in ALLOWANCES))
    folder = shared_folder(docs.sparkSession, "quality")
    rated = written(rated, f"{folder}/rated")
    # As a table the thresholds have a known size: few groups are broadcast, many are joined by a shuffle.
    limits = written(thresholds(sketches(rated.where(~base_failed("_c_")))), f"{folder}/thresholds")
    # A group whose documents all fail the base rule has no thresholds and needs none.
    joined = rated.join(limits, ["_lang", "_source"], "left")
    fine = ~base_failed("_c_")
    for rule in ALLOWANCES:
        fine = fine & (F.col("_" + rule) <= F.col("_most_" + rule))
    return joined.select(
        "_row.*", *(F.col("_c_" + c).alias(c) for c in COUNTS),
        base_failed("_c_").alias("base_failed"), fine.alias("kept"),
    )


def op2_quality_rules(docs: DataFrame) -> DataFrame:
    return judge(docs, ["doc_id"])
