"""Quality rules as a bitmask ledger: each rule is evaluated once, its failure is a bit, and policies are masks.

ledger() gives each row its measurements and failed_bits; apply_policy() compares the bits with the mask of a named,
versioned set of rules, so that a new policy needs no second look at the texts; ablation() counts from the few
distinct bit patterns what each rule alone removes. Everything is built-in DataFrame functions, without a shuffle
but for the ablation's pre-aggregated counts.

Edge cases: a null or empty text has no words, zero measurements and fails few_words; rows are judged each on their
own, so repeated rows get equal results and an empty table an empty ledger. Columns other than id and text are ignored
unless kept by name. Repeated 3-word windows are found by 64-bit hashes within one text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
#: Rule -> failure as SQL over the measurements; the position is its bit and never changes, new rules go to the end.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 5 * word_chars",
    "shouting": "100 * n_upper > 50 * word_chars",
    "exclamations": "100 * n_exclaim > 5 * word_chars",
    "duplicate_lines": "n_lines >= 4 and 100 * n_dup_lines > 60 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 25 * n_words)",
    "many_words": "n_words > 100000",
    "digits": "100 * n_digits > 40 * word_chars",
    "odd_words": "100 * n_odd_words > 50 * n_words",
    "long_words": "100 * n_long_words > 10 * n_words",
    "bullets": "n_lines >= 4 and 100 * n_bullets > 90 * n_lines",
    "ellipses": "n_lines >= 4 and 100 * n_ellipses > 30 * n_lines",
    "few_ends": "n_lines >= 4 and 100 * n_ends < 10 * n_lines",
    "few_distinct": "n_words >= 100 and 100 * n_distinct < 10 * n_words",
    "braces": "100 * n_braces > 2 * word_chars",
    "links": "100 * n_links > 20 * n_words",
    "control": "100 * n_control > word_chars",
    "broken": "1000 * n_broken > word_chars",
    "placeholder": "n_placeholders > 0",
}
#: Policy version -> rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(RULES)[:7],
    "v2": tuple(r for r in RULES if r not in ("many_words", "few_ends")),
    "strict": tuple(RULES),
}
#: Measurement -> pattern whose matches in the text, or characters in it, or lines that have it, are counted.
CHARS = {"n_symbols": r"[#*$%&|<>]", "n_upper": "[A-Z]", "n_exclaim": "!", "n_digits": "[0-9]", "n_braces": r"[{}]", "n_control": r"[\x00-\x08\x0E-\x1F\x7F]", "n_broken": "\uFFFD"}
PLACES = {
    "n_odd_words": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0DA-Za-z\x{80}-\x{10FFFF}]++(?![^\x20\x09-\x0D])",
    "n_long_words": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{31,}+",
    "n_links": r"(?<![^\x20\x09-\x0D])(?:https?://|www\.)",
    "n_placeholders": r"[Ll]orem [Ii]psum",
}
#: What a text must hold for a pattern to be tried at all.
GATES = {"n_links": ("http", "www."), "n_placeholders": ("orem ",)}
LINES = {"n_bullets": r"^[ \t]*[-*•]", "n_ellipses": r"(?:\.\.\.|…)[ \t\r]*\z", "n_ends": r'[.!?"”»)][ \t\r]*\z'}


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _count(text: Column, chars: str) -> Column:
    """Characters of a class, taken as runs: most texts have few."""
    return F.length(F.array_join(F.regexp_extract_all(text, F.lit(chars + "+"), F.lit(0)), "")).cast("long")


def _places(text: Column, name: str) -> Column:
    n = F.regexp_count(text, F.lit(PLACES[name])).cast("long")
    return F.when(reduce(lambda a, b: a | b, [F.contains(text, F.lit(g)) for g in GATES[name]]), n).otherwise(F.lit(0).cast("long")) if name in GATES else n


def _has(pattern: str):
    return lambda x: x.rlike(pattern)


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measurements of each row."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    cut = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("_w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
        *[_count(text, c).alias(k) for k, c in CHARS.items()],
        *[_places(text, k).alias(k) for k in PLACES],
    ).withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
    # Windows in the order of their hashes: equal ones are neighbours.
    window = lambda w, i: F.struct(F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i"))
    sorted_ = cut.select("*", F.sort_array(F.transform(F.slice("_w", F.lit(1), F.greatest(F.size("_w") - 2, F.lit(0))), window)).alias("_s"))
    twice = lambda s, i: s["h"].eqNullSafe(F.get("_s", i - 1)["h"]) | s["h"].eqNullSafe(F.get("_s", i + 1)["h"])
    places = sorted_.select("*", F.sort_array(F.transform(F.filter("_s", twice), lambda s: s["i"])).alias("_p"))
    covered = F.aggregate(F.transform("_p", lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get("_p", i - 1), F.lit(-3)))), F.lit(0), lambda a, x: a + x)
    facts = F.struct(
        F.size("_w").cast("long").alias("n_words"),
        "word_chars", *CHARS, *PLACES,
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        *[F.size(F.filter("_l", _has(x))).cast("long").alias(k) for k, x in LINES.items()],
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct"),
    )
    # The generator keeps later filters above it: pushed below, they would repeat the expressions for each use.
    return places.select("doc_id", F.explode(F.array(facts)).alias("_m")).select("doc_id", "_m.*")


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and failed_bits of each row."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())]
    return measured(df, id_col, text_col).withColumn("failed_bits", sum(bits[1:], bits[0]).cast("long"))


def write_ledger(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger of df, stored; what it returns, and spark.read.parquet(path) at any later time, serves every policy without the texts."""
    made = ledger(df, id_col, text_col)
    made.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(made.schema).parquet(path)


def apply_policy(of: DataFrame, policy: str = "v2") -> DataFrame:
    """Adds base_failed and kept; a row that fails the base is never kept."""
    failed = lambda name: F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[name])).cast("long")) != 0
    return of.withColumn("base_failed", failed("base")).withColumn("kept", ~failed("base") & ~failed(policy))


def ablation(of: DataFrame, policy: str = "v2") -> DataFrame:
    """For each rule of a policy: rows that fail it, rows that only it rejects, and rows kept without it."""
    counts = of.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    names = list(RULES)
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[policy]]))
    within = F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long"))
    x = counts.select("n", within.alias("b"), rules.alias("r")).select("n", "b", "r.rule", "r.bit")
    return x.groupBy("rule").agg(
        F.sum(F.when(F.col("b").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("b") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("b").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )


def keep_good(df: DataFrame, policy: str = "v2", text_col: str = "text") -> DataFrame:
    """The rows of df that a policy keeps, with their columns and order of columns as they were."""
    names = [f"_row.`{c}`" for c in df.columns]
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{text_col}`").alias("text"))
    return apply_policy(ledger(packed, "_row", "text"), policy).where("kept").select(F.col("doc_id").alias("_row")).select(*names)
