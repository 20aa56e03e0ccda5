"""Rules on words and lines, and a hashed n-gram likelihood ratio, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bloomline.session import materialize

BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: N-gram symbols: runs of letters, of digits, and of anything else but white space.
SYMBOL_RUNS = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\x20\x09-\x0D]+"


def repeated_words(docs: DataFrame) -> DataFrame:
    """``words`` become n_repeat_words: words inside 3-word windows that occur twice or more in the text, all occurrences included.

    Windows are compared by XXH64. Counting their distinct hashes tells texts without any
    repetition apart cheaply; the others sort (hash, place) pairs. Each step is a column of
    its own: a column that is used twice is evaluated once, and sorts and sets outside of lambdas run as generated code.
    """
    others = [c for c in docs.columns if c != "words"]
    n = F.size("words") - 2
    hashes = F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
        F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    out = docs.select(*others, hashes.alias("hashes"))
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    at = F.sequence(F.lit(0), F.size("hashes") - 1)
    out = out.select(*others, F.when(some, F.sort_array(F.arrays_zip(F.col("hashes").alias("h"), at.alias("i")))).alias("pairs"))
    out = out.select(*others, F.transform("pairs", lambda p: p["h"]).alias("h"), F.transform("pairs", lambda p: p["i"]).alias("i"))
    # A neighbour beyond the ends is null, and so is a comparison with it.
    twice = F.filter("i", lambda i, k: (F.get("h", k) == F.get("h", k - 1)) | (F.get("h", k) == F.get("h", k + 1)))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2))))
    return out.select(*others, F.when(F.col("i").isNull(), 0).otherwise(F.size(covered)).cast("long").alias("n_repeat_words"))


def base_rules(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, text, and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of every text."""
    body = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda s: F.trim(s, F.lit(BLANKS)) != "")
    out = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    out = out.withColumn("parts", F.split(body, BLANK)).withColumn("words", F.array_remove("parts", "")).withColumn("lines", lines)
    bare = body
    for s in SYMBOLS:
        bare = F.replace(bare, F.lit(s), F.lit(""))
    out = repeated_words(out.select(
        "key", "text", F.size("words").cast("long").alias("n_words"),
        # Between neighbouring parts lies one blank.
        (F.length(body) - F.size("parts") + 1).cast("long").alias("word_chars"),
        (F.length(body) - F.length(bare)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "words"))
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def symbol_runs(text: str | Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SYMBOL_RUNS), F.lit(0))


def buckets(before: Column, symbol: Column, bits: int) -> tuple[Column, Column]:
    """Buckets of a symbol and of its pair with the one before it; pairs of equal symbols are one pair, whatever the symbol."""
    bucket = lambda *parts: F.xxhash64(*parts).bitwiseAND((1 << bits) - 1).cast("int")
    return bucket(symbol), F.when(symbol == before, bucket(F.lit("="), F.lit("="))).otherwise(bucket(before, symbol))


def hashed_ngrams(text: str | Column, bits: int) -> Column:
    """Buckets of a text's symbols and of their neighbouring pairs, as one array; ``ngram_rows`` gives the same as rows."""
    before = lambda found, i: F.coalesce(F.get(found, i - 1), F.lit("^"))
    part = lambda found, k: F.transform(found, lambda w, i: buckets(before(found, i), w, bits)[k])
    return F.get(F.transform(F.array(symbol_runs(text)), lambda found: F.concat(part(found, 0), part(found, 1))), 0)


def ngram_rows(docs: DataFrame, text: str, bits: int, *columns: str) -> DataFrame:
    """``columns`` and bucket: a row for each n-gram of each text, or two of null bucket for a text without any.

    Symbols become rows before they are hashed: lambdas over arrays are interpreted, functions of rows run as generated code.
    """
    found = docs.select(*columns, symbol_runs(F.col(text)).alias("runs"))
    before = F.slice(F.concat(F.array(F.lit("^")), "runs"), 1, F.size("runs"))
    rows = found.select(*columns, F.inline_outer(F.arrays_zip(before.alias("before"), F.col("runs").alias("symbol"))))
    both = [F.when(F.col("symbol").isNotNull(), b) for b in buckets(F.col("before"), F.col("symbol"), bits)]
    return rows.select(*columns, F.explode(F.array(*both)).alias("bucket"))


def ratio_weights(docs: DataFrame, trusted: Column, text: str, bits: int, smoothing: float = 1.0) -> DataFrame:
    """Per bucket, the log ratio of its smoothed shares in trusted texts and in all texts: at most 2^bits rows."""
    grams = ngram_rows(docs.withColumn("trusted", trusted.cast("int")), text, bits, "trusted").where(F.col("bucket").isNotNull())
    counts = materialize(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target")), "buckets")
    totals = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    size = float(1 << bits)
    share = lambda c, total: (F.col(c) + smoothing) / F.lit((total or 0) + smoothing * size)
    return counts.select("bucket", F.log(share("target", totals["target"]) / share("raw", totals["raw"])).alias("weight"))


def judge_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = 16, threshold: float = -0.25,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rules and likelihood ratio of every text: ``key``, the base columns, ratio, kept.

    The trusted target is the texts of all ids labelled 1, the raw corpus is
    all texts. Both are multinomials
    over hashed symbols and symbol pairs. ``ratio`` is the mean log ratio over the text's n-grams (0 without
    any); a text is kept if the base rules pass and ``ratio`` reaches
    ``threshold``. Null counts as empty and fails; repeated rows are judged
    each; an empty table gives no rows; without labels the ratio only smooths.
    Other columns are ignored, whatever their names.
    """
    good = (labels.where((F.col(label) == 1) & F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
            .withColumn("trusted", F.lit(1)))
    plain = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    # Trusted ids grow with the corpus: texts and ids meet by id at every size, and counts combine before their shuffle.
    marked = plain.join(good.hint("merge"), "key", "left")
    weights = ratio_weights(marked, F.coalesce("trusted", F.lit(0)), "text", bits)
    based = base_rules(docs, key, text).withColumn("row", F.monotonically_increasing_id())
    columns = ["row", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    grams = ngram_rows(based, "text", bits, *columns)
    # At most 2^bits rows of two numbers: a fixed bound.
    joined = grams.join(F.broadcast(weights), "bucket", "left")
    out = joined.groupBy(*columns).agg(F.coalesce(F.sum("weight") / F.count("bucket"), F.lit(0.0)).alias("ratio"))
    return out.select(F.col("key").alias(key), *columns[2:], "ratio", (~F.col("base_failed") & (F.col("ratio") >= threshold)).alias("kept"))
