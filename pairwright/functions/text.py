"""Tokens, term bags and cosine similarity as row-local expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Weight of a term that only one of two texts has, when TF-IDF with smoothed
# idf = ln((1+n)/(1+df)) + 1 is fitted on exactly these two texts; a term that
# both have gets weight 1.
LONE_TERM_WEIGHT = 1.4054651081081644


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A lambda parameter is bound to its value, whereas repeating a Column
    repeats its whole expression.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def tokens(text: Column) -> Column:
    """Lower-cased words of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def uni_and_bigrams(words: Column) -> Column:
    """The words followed by each pair of neighbouring words."""
    def build(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n),
                           lambda x, y: F.concat(x, F.lit(" "), y))
        return F.concat(w, pairs)
    return let(words, build)


def terms(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Words without stop words, plus bigrams of what remains."""
    words = tokens(text)
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(*stop_words))
    return uni_and_bigrams(words)


def bag(term_array: Column) -> Column:
    """Term array -> map(term, frequency): sort, then measure each run."""
    def runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(1), n),
            lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)))

        def entries(p: Column) -> Column:
            return F.transform(p, lambda at, k: F.struct(
                F.get(s, at - 1).alias("term"),
                (F.coalesce(F.get(p, k + 1), n + 1) - at).alias("tf")))
        return F.when(n > 0, let(starts, entries))

    empty = F.array().cast("array<struct<term:string,tf:int>>")
    return F.map_from_entries(let(F.sort_array(term_array), lambda s: F.coalesce(runs(s), empty)))


def square_sum(term_bag: Column) -> Column:
    """Sum of squared frequencies of a term bag."""
    return F.aggregate(F.map_values(term_bag), F.lit(0.0),
                       lambda acc, tf: acc + tf.cast("double") * tf)


def fitted_cosine(dot: Column, shared_a: Column, total_a: Column,
                  shared_b: Column, total_b: Column) -> Column:
    """Cosine of two texts under TF-IDF fitted on just these two.

    ``dot``: sum of tf_a*tf_b over shared terms; ``shared_x``: sum of tf_x^2
    over shared terms; ``total_x``: over all terms. Nothing shared gives 0.
    """
    c2 = F.lit(LONE_TERM_WEIGHT * LONE_TERM_WEIGHT)
    norm_a = F.sqrt(shared_a + c2 * (total_a - shared_a))
    norm_b = F.sqrt(shared_b + c2 * (total_b - shared_b))
    return F.when(dot > 0, dot / (norm_a * norm_b)).otherwise(0.0)


def pair_cosine(a: Column, b: Column) -> Column:
    """Cosine of the words of two short texts, TF-IDF fitted on the pair.

    Null or word-free texts give 0.
    """
    def from_tokens(both: Column) -> Column:
        ta, tb = both["a"], both["b"]

        def count(words: Column, word: Column) -> Column:
            return F.size(F.filter(words, lambda w: w == word)).cast("double")

        def sum_over(words: Column, value: Callable[[Column], Column]) -> Column:
            return F.aggregate(words, F.lit(0.0), lambda acc, w: acc + value(w))

        def from_shared(shared: Column) -> Column:
            return fitted_cosine(
                sum_over(shared, lambda w: count(ta, w) * count(tb, w)),
                sum_over(shared, lambda w: count(ta, w) * count(ta, w)),
                sum_over(ta, lambda w: count(ta, w)),
                sum_over(shared, lambda w: count(tb, w) * count(tb, w)),
                sum_over(tb, lambda w: count(tb, w)))
        return let(F.array_intersect(ta, tb), from_shared)

    empty = F.array().cast("array<string>")
    both = F.struct(F.coalesce(tokens(a), empty).alias("a"), F.coalesce(tokens(b), empty).alias("b"))
    return let(both, from_tokens)


def bag_cosine(bag_a: Column, total_a: Column, bag_b: Column, total_b: Column,
               max_features: int | None = None) -> Column:
    """Cosine of two term bags, TF-IDF fitted on the pair.

    ``total_x`` is the bag's :func:`square_sum`. With ``max_features`` only
    that many terms are kept when the two bags have more between them: the
    most frequent in both together, ties by term.
    """
    both = F.map_values(F.map_zip_with(bag_a, bag_b, lambda term, x, y: F.when(
        x.isNotNull() & y.isNotNull(),
        F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))))

    def whole(z: Column) -> Column:
        zero = F.struct(*[F.lit(0.0).alias(n) for n in ("d", "sa", "sb")])
        return F.aggregate(F.filter(z, lambda t: t.isNotNull()), zero, lambda acc, t: F.struct(
            (acc["d"] + t["x"] * t["y"]).alias("d"),
            (acc["sa"] + t["x"] * t["x"]).alias("sa"),
            (acc["sb"] + t["y"] * t["y"]).alias("sb")),
            lambda r: fitted_cosine(r["d"], r["sa"], total_a, r["sb"], total_b))

    if max_features is None:
        return let(both, whole)
    capped = _capped_cosine(bag_a, bag_b, max_features)
    return let(both, lambda z: F.when(F.size(z) <= max_features, whole(z)).otherwise(capped))


def _capped_cosine(bag_a: Column, bag_b: Column, max_features: int) -> Column:
    terms_by_rank = F.map_values(F.map_zip_with(bag_a, bag_b, lambda term, x, y: F.struct(
        (-(F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))).alias("rank"),
        term.alias("term"),
        F.coalesce(x, F.lit(0)).cast("double").alias("x"),
        F.coalesce(y, F.lit(0)).cast("double").alias("y"))))
    kept = F.slice(F.sort_array(terms_by_rank), 1, max_features)
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("d", "sa", "ta", "sb", "tb")])

    def add(acc: Column, t: Column) -> Column:
        x2, y2 = t["x"] * t["x"], t["y"] * t["y"]
        return F.struct(
            (acc["d"] + t["x"] * t["y"]).alias("d"),
            (acc["sa"] + F.when(t["y"] > 0, x2).otherwise(0.0)).alias("sa"),
            (acc["ta"] + x2).alias("ta"),
            (acc["sb"] + F.when(t["x"] > 0, y2).otherwise(0.0)).alias("sb"),
            (acc["tb"] + y2).alias("tb"))
    return F.aggregate(kept, zero, add, lambda r: fitted_cosine(r["d"], r["sa"], r["ta"], r["sb"], r["tb"]))
