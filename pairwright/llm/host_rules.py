"""Quality rules of documents, and verdicts on the hosts they come from. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.llm.common import join_small, materialize

# Fixed values of the rules.
WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# A host is rejected if more than this share of its documents fails, after shrinking.
HOST_FAIL_RATE = 0.5


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, whatever ``body`` does with it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text: runs of characters other than the six ASCII white-space ones."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def repeated_window_words(words: Column, width: int = WINDOW_WORDS) -> Column:
    """Words that lie in a window of ``width`` words found twice or more.

    Windows are compared by 64-bit hashes of their words. Only a text with a
    repeated window is sorted: places of equal windows then stand together,
    and the words covered from one flagged place to the next are added up.
    """
    def windows(w):
        return F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.xxhash64(F.slice(w, i, width)))

    def covered(places):
        step = F.transform(places, lambda p, k: F.when(k + 1 < F.size(places), F.least(F.lit(width), F.get(places, k + 1) - p)).otherwise(F.lit(width)))
        return F.aggregate(step, F.lit(0).cast("long"), lambda total, x: total + x)

    def flagged(pairs):
        same = lambda k, at: F.coalesce(F.get(pairs, k + at)["h"] == F.get(pairs, k)["h"], F.lit(False))
        return F.filter(pairs, lambda p, k: ((k > 0) & same(k, -1)) | same(k, 1))

    def count(hashes):
        pairs = F.array_sort(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
        places = _let(pairs, lambda p: F.array_sort(F.transform(flagged(p), lambda x: x["k"])))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(_let(places, covered))

    return _let(words, lambda w: F.when(F.size(w) < width, F.lit(0).cast("long")).otherwise(_let(windows(w), count)))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def rule_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, the counts the rules need, and base_failed. A null text has no words."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(host).alias("host"), whole.alias("_text"))
    counts = rows.select(
        "doc_id", "host",
        _let(words_of(F.col("_text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_window_words(w).alias("r"))).alias("_w"),
        F.length(F.translate("_text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("_text")).alias("n_dup_lines"))
    flat = counts.select("doc_id", "host", F.col("_w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("_w.r").alias("n_repeat_words"))
    return flat.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_verdicts(judged: DataFrame, max_rate: float = HOST_FAIL_RATE) -> DataFrame:
    """host, docs, failed, host_rate, host_failed: failure rates shrunk by an empirical beta prior.

    The prior's mean is the share of all documents that fail, its strength
    comes from the hosts' spread (method of moments, a host weighs by its
    documents): strength = m (1 - m) / v - 1, where v is the spread
    beyond what binomial chance gives, but at least 1e-6 of m (1 - m); it is one
    document at least. A host with few documents is so drawn to the common
    rate. A null host is a host of its own.
    """
    hosts = materialize(judged.groupBy("host").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "hosts")
    totals = hosts.agg(F.sum("docs").alias("_n"), F.sum("failed").alias("_f"), F.count(F.lit(1)).alias("_hosts"),
                       F.sum(F.col("failed") * F.col("failed") / F.col("docs")).alias("_ff"),
                       F.sum(F.col("docs") * F.col("docs")).cast("double").alias("_nn"))
    mean = F.col("_f") / F.col("_n")
    # Weighted between-host sum of squares, its binomial part taken away (as in a one-way layout).
    between = F.col("_ff") - F.col("_f") * mean
    spread = (between - (F.col("_hosts") - 1) * mean * (1 - mean)) / F.greatest(F.col("_n") - F.col("_nn") / F.col("_n"), F.lit(1.0))
    chance = mean * (1 - mean)
    strength = F.when(chance > 0, chance / F.greatest(spread, chance * 1e-6) - 1).otherwise(F.lit(1.0))
    prior = totals.select(mean.alias("mean"), F.greatest(strength, F.lit(1.0)).alias("strength")).first()  # two numbers
    weight = prior["strength"] or 1.0
    rate = (F.col("failed") + F.lit((prior["mean"] or 0.0) * weight)) / (F.col("docs") + F.lit(weight))
    return hosts.select("host", "docs", "failed", rate.alias("host_rate"), (rate > max_rate).alias("host_failed"))


def judge(docs: DataFrame, max_rate: float = HOST_FAIL_RATE, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Counts, base_failed and kept for each row of ``docs``; kept needs a document and a host that pass.

    Texts are read once: the counts are written, hosts are summed from them
    (merged before the shuffle), and the verdicts joined back; the hosts'
    table is broadcast only if a count shows it small. Rows with equal ids
    are separate. An empty table gives no rows.
    """
    judged = materialize(rule_counts(docs, key, text, host), "rule-counts")
    verdicts = materialize(host_verdicts(judged, max_rate), "host-verdicts")
    joined = join_small(judged, verdicts, ["host"])
    kept = ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))
    return joined.select(*judged.columns, F.round("host_rate", 9).alias("host_rate"), kept.alias("kept"))
