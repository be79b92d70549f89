"""One entry per operator: the Spark query and, where it exists, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.data import Data, pair_rid
from pairwright.functions import comparators, normalize, scoring, values, vin
from pairwright.functions.affine import affine_gap
from pairwright.functions.serialize import record_text, row_fingerprint
from pairwright.functions.text import pair_cosine
from pairwright.operators import blocking, candidates, dedup, evaluate, labels, learned, linkage, predicates, profile, schema, similarity, validate
from pairwright.operators.schema import FIELDS, LISTING_COLUMNS, PAIR_KEY, side
from pairwright.plans.rank import exact_rank, md5_order
from pairwright.plans.storage import materialize, new_path
from pairwright.sources import models, readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Data(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return build
    return register


def column_query(name: str, source: str, result: Callable[[], Column], sql_result: str, with_sql: str, sql_source: str,
                 key: str = "rid") -> None:
    """A query that shows a row key and one computed column ``value``."""
    query(name, f"{with_sql} SELECT {key}, {sql_result} AS value FROM {sql_source}")(
        lambda d: getattr(d, source).select(key, result().alias("value")))


# --- sources and sinks ----------------------------------------------------

def _csv_round_trip(d: Data, df: DataFrame, header: bool = True) -> DataFrame:
    path = new_path(d.spark, "csv")
    writers.write_csv(df, path, header=header)
    if not header:
        return readers.read_csv_headerless(d.spark, path, df.columns)
    return readers.read_csv_strings(d.spark, path, df.columns)


query("scan_csv_string", f"{Q.BASE} SELECT * REPLACE (CAST(id AS VARCHAR) AS id) FROM va")(
    lambda d: _csv_round_trip(d, d.raw_a))
query("scan_csv_headerless", f"{Q.BASE} SELECT * REPLACE (CAST(id AS VARCHAR) AS id) FROM vb")(
    lambda d: _csv_round_trip(d, d.raw_b, header=False))


@query("scan_csv_subset", f"{Q.BASE} SELECT year, CAST(id AS VARCHAR) AS id, make_name FROM vb")
def _(d: Data):
    path = new_path(d.spark, "csv")
    writers.write_csv(d.raw_b, path)
    return readers.read_csv_strings(d.spark, path, ["year", "id", "make_name"])


query("sink_csv", f"{Q.PREPARED} SELECT * REPLACE (CAST(rid AS VARCHAR) AS rid, CAST(invalid AS VARCHAR) AS invalid) FROM pb")(
    lambda d: _csv_round_trip(d, d.b))


@query("scan_csv_inferred", f"""{Q.BASE} SELECT * REPLACE (TRY_CAST(year AS INT) AS year,
    TRY_CAST(mileage AS DOUBLE) AS mileage) FROM vb""")
def _(d: Data):
    path = new_path(d.spark, "csv")
    writers.write_csv(d.raw_b, path)
    return readers.read_csv_typed(d.spark, path, d.raw_b.columns, {"id": "bigint", "year": "int", "mileage": "double"})


@query("sink_csv_quoted", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, lang, source FROM documents")
def _(d: Data):
    docs, path = d.documents.select("doc_id", "text", "lang", "source"), new_path(d.spark, "csv")
    writers.write_csv_quoted(docs, path)
    return readers.read_csv_strings(d.spark, path, docs.columns, multi_line=True, escape="\\")


@query("null_tokens", f"""{Q.BASE} SELECT id, nullif(CASE WHEN id % 7 = 0 THEN 'NA' WHEN id % 7 = 1 THEN 'null' ELSE model END,
    CASE WHEN id % 7 = 0 THEN 'NA' ELSE 'null' END) AS model, nullif(coalesce(fuel, 'n/a'), 'n/a') AS fuel FROM va""")
def _(d: Data):
    spoiled = d.raw_a.select("id", F.when(F.col("id") % 7 == 0, "NA").when(F.col("id") % 7 == 1, "null")
                             .otherwise(F.col("model")).alias("model"), F.coalesce("fuel", F.lit("n/a")).alias("fuel"))
    return readers.null_tokens(spoiled)


def _split_sql(side_sql: str) -> str:
    return " UNION ALL ".join(side_sql.format(s=s, S=s.upper()) for s in "ab")


query("scan_pairs_prefixed", f"{Q.LABELLED} " + _split_sql(
    "SELECT '{S}' AS side, rid, " + ", ".join(
        f"TRY_CAST({{s}}_{f} AS DOUBLE) AS {f}" if f == "mileage" else
        f"CAST({{s}}_{f} AS BIGINT) AS {f}" if f == "id" else f"nullif({{s}}_{f}, '') AS {f}" for f in FIELDS)
    + ", match AS is_match FROM lp"))(
    lambda d: readers.split_prefixed_pairs(d.labelled.select("rid", *PAIR_KEY, "match")))


def _in_test(d: Data) -> DataFrame:
    return candidates.candidates_in_test(d.a, d.b, d.labelled)


IN_TEST = f"""{Q.LINKAGE}, ci AS MATERIALIZED (SELECT b1.* FROM b1 SEMI JOIN tk ON {' AND '.join(
    f"tk.{s}_{f} = coalesce(b1.{f if f in schema.BLOCK_KEY else f'{f}_{s}'}, '')" for s in 'ab' for f in FIELDS)})"""
_SUFFIXED = [c for c in ("vin", *FIELDS, "invalid") if c not in schema.BLOCK_KEY]
query("scan_pairs_suffixed", f"{IN_TEST} " + _split_sql(
    f"SELECT '{{S}}' AS side, CAST(rid_a AS VARCHAR) || '-' || CAST(rid_b AS VARCHAR) AS rid, lower({Q.strip("nullif(manufacturer, '')")}) AS manufacturer, "
    "TRY_CAST(year AS DOUBLE) AS year, " + ", ".join(f"lower({Q.strip(f"nullif(CAST({c}_{{s}} AS VARCHAR), '')")}) AS {c}" for c in _SUFFIXED)
    + " FROM ci"))(
    lambda d: readers.split_suffixed_pairs(_in_test(d).withColumn("rid", pair_rid("rid_a", "rid_b")).drop("rid_a", "rid_b")))


@query("sink_pair_text", f"{Q.LABELLED} SELECT {Q.PAIR_TEXT} AS line FROM lp")
def _(d: Data):
    path = new_path(d.spark, "pair-text")
    writers.write_pair_text(candidates.serialize_pairs(d.labelled), path)
    return d.spark.read.text(path).withColumnRenamed("value", "line")


LOG_COLUMNS = [*PAIR_KEY, "candidate_rows", "predicted", "match"]


@query("prediction_log", f"{Q.LINKAGE} SELECT {', '.join(LOG_COLUMNS)} FROM lt")
def _(d: Data):
    """The rows of a run, written twice: the log holds them once."""
    path = new_path(d.spark, "predictions")
    table = materialize(candidates.linkage_table(d.a, d.b, d.labelled).select(*LOG_COLUMNS), "linkage")
    for _ in range(2):
        writers.append_predictions(table.filter("candidate_rows > 0"), path, "evaluated")
        writers.append_predictions(candidates.missing_pairs(table), path, "missing")
    return writers.read_predictions(d.spark, path)


query("head_rows", f"{Q.ALIGNED} SELECT * FROM aa ORDER BY rid LIMIT 10")(lambda d: readers.head_rows(d.aligned_a))


def _linker(d: Data):
    return learned.train_linker(d.labelled, sample_size=None)


@query("model_store", f"{Q.LABELLED} SELECT count(*) AS n_rows, count(*) AS equal_scores FROM lp")
def _(d: Data):
    """A stored linker scores every pair as the one in memory does."""
    path, model = new_path(d.spark, "linker"), _linker(d)
    models.save_linker(model, path)
    features = materialize(learned.comparison_vector(d.labelled, ["rid"]), "features")
    both = learned.score_pairs(model, features).join(learned.score_pairs(models.load_linker(path), features).withColumnRenamed("score", "again"), "rid")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("score") == F.col("again"), 1)).alias("equal_scores"))


# --- projections and column rules -----------------------------------------

query("align_schema_a", f"{Q.ALIGNED} SELECT * FROM aa")(lambda d: d.aligned_a)
query("align_schema_b", f"{Q.ALIGNED} SELECT * FROM ab")(lambda d: d.aligned_b)
query("drop_vin", f"{Q.MARKED} SELECT * EXCLUDE (vin) FROM ma")(lambda d: schema.drop_vin(d.marked_a))
query("extract_valid", f"{Q.MARKED} SELECT * FROM ma WHERE invalid = 0")(lambda d: schema.extract_valid(d.marked_a))

for _field, _source, _sql_source in (
        ("manufacturer", "aligned_a", "aa"), ("fuel_type", "aligned_a", "aa"), ("model", "aligned_a", "aa"),
        ("transmission", "aligned_b", "ab"), ("body_type", "aligned_b", "ab"), ("cylinders", "aligned_b", "ab"),
        ("drive", "aligned_b", "ab"), ("color", "aligned_b", "ab")):
    column_query(f"norm_{_field}", _source, lambda f=_field: normalize.NORMALIZERS[f](F.col(f)),
                 Q.NORMALIZERS[_field](_field), Q.ALIGNED, _sql_source)

query("norm_all", f"{Q.MARKED} SELECT {Q.normalized()} FROM ma")(lambda d: schema.normalize_all(d.marked_a))
query("norm_numeric", f"{Q.PREPARED} SELECT * FROM pa")(lambda d: schema.normalize_numeric(schema.normalize_all(d.marked_a)))
query("norm_numeric_pairs", f"{Q.LABELLED_RAW} SELECT * REPLACE (" + ", ".join(
    f"{Q.whole_text(f'{s}_{c}')} AS {s}_{c}" for s in "ab" for c in ("year", "mileage", "cylinders")) + ") FROM lp")(
    lambda d: schema.normalize_numeric_pairs(d.labelled_raw))
column_query("block_fuel_key", "b", lambda: F.coalesce(normalize.block_fuel(F.col("fuel_type")), F.lit("nan")),
             f"coalesce({Q.block_fuel('fuel_type')}, 'nan')", Q.PREPARED, "pb")
column_query("clean_str", "b", lambda: values.blank_if_null(F.col("color")), "coalesce(color, '')", Q.PREPARED, "pb")
column_query("parse_float", "aligned_b", lambda: values.number_with_commas(F.concat(F.lit(" 1,0"), F.col("mileage"))),
             "TRY_CAST(replace(' 1,0' || mileage, ',', '') AS DOUBLE)", Q.ALIGNED, "ab")
query("clean_numeric", f"{Q.ALIGNED} SELECT * REPLACE ({Q.number('year')} AS year, {Q.number('mileage')} AS mileage) FROM aa")(
    lambda d: schema.clean_numeric(d.aligned_a))
column_query("vin_length_bad", "aligned_a", lambda: vin.length_bad(F.col("vin")).cast("int"), f"CAST({Q.LENGTH_BAD} AS INT)", Q.ALIGNED, "aa")
column_query("vin_charset_bad", "aligned_a", lambda: vin.charset_bad(F.col("vin")).cast("int"), f"CAST({Q.CHARSET_BAD} AS INT)", Q.ALIGNED, "aa")
column_query("vin_year_code_bad", "aligned_a", lambda: vin.year_code_bad(F.col("vin"), F.col("year")).cast("int"),
             f"CAST({Q.YEAR_BAD} AS INT)", Q.ALIGNED, "aa")
_COMPARED = ("manufacturer", "model", "year", "fuel", "transmission", "cylinders", "drive", "paint_color")
query("row_fingerprint", f"{Q.BASE} SELECT id, md5(" + " || '|' || ".join(f"coalesce({c}, '__NULL__')" for c in _COMPARED) + ") AS value FROM va")(
    lambda d: d.raw_a.select("id", row_fingerprint([F.col(c) for c in dedup.compare_columns(d.raw_a)]).alias("value")))
column_query("serialize_record", "labelled", lambda: record_text(side("a_"), FIELDS), Q.record_text("a"), Q.LABELLED, "lp")
query("serialize_pairs", f"{Q.LABELLED} SELECT {Q.PAIR_TEXT} AS line FROM lp")(lambda d: candidates.serialize_pairs(d.labelled))
query("pairs_to_prefixed", f"{IN_TEST} SELECT rid_a AS a_rid, rid_b AS b_rid, " + ", ".join(
    f"{f if f in schema.BLOCK_KEY else f'{f}_{s}'} AS {s}_{f}" for s in "ab" for f in FIELDS) + " FROM ci")(
    lambda d: schema.pairs_to_prefixed(_in_test(d)))


# --- profiles and validation ----------------------------------------------

_RAW_A = ("id", "VIN", "manufacturer", "model", "year", "odometer", "fuel", "transmission", "type", "cylinders", "drive", "paint_color")
query("profile_nulls_uniques", f"{Q.BASE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS total_rows, count(*) - count({c}) AS null_count,
    round((count(*) - count({c})) / count(*)::DOUBLE * 100, 2) AS null_pct, count(DISTINCT {c}) AS unique_values FROM va""" for c in _RAW_A))(
    lambda d: profile.profile_nulls_uniques(d.raw_a))
_MEASURES = ", ".join(f"min({e}) AS {n}_min, max({e}) AS {n}_max, round(sum({e}) / count({e}), 2) AS {n}_mean"
                      for n, e in (("price", "o_totalprice"), ("mileage", Q.number("odometer"))))
query("representativity", f"""{Q.BASE} SELECT count(*) AS total_rows, count(VIN) AS vin_present,
    round(count(VIN) / count(*)::DOUBLE * 100, 2) AS vin_pct, count(DISTINCT year) AS distinct_years, min(year) AS min_year, max(year) AS max_year,
    count(DISTINCT manufacturer) AS distinct_manufacturers, count(DISTINCT model) AS distinct_models, {_MEASURES} FROM va JOIN orders ON o_orderkey = id""")(
    lambda d: profile.representativity(d.aligned_a.join(d.table("orders").select(F.col("o_orderkey").alias("rid"), F.col("o_totalprice").cast("string").alias("price")), "rid")))
query("unique_vins", f"{Q.ALIGNED} SELECT vin FROM aa WHERE {Q.strip('vin')} <> '' GROUP BY vin HAVING count(*) = 1")(
    lambda d: profile.unique_vins(d.aligned_a))
query("unique_vin_summary", f"""{Q.ALIGNED} SELECT count(*) AS distinct_vins, count(*) FILTER (n = 1) AS unique_vins
    FROM (SELECT count(*) AS n FROM aa WHERE {Q.strip('vin')} <> '' GROUP BY vin)""")(lambda d: profile.unique_vin_summary(d.aligned_a))
query("value_counts", f"{Q.PREPARED} SELECT cylinders, count(*) AS n FROM pa WHERE cylinders IS NOT NULL GROUP BY cylinders")(
    lambda d: profile.value_counts(d.a, "cylinders"))
query("mark_invalid_vin", f"{Q.MARKED} SELECT * FROM mi")(lambda d: validate.mark_invalid_vin(d.aligned_a))
query("vin_error_summary", f"""{Q.ALIGNED} SELECT count(*) FILTER (NOT ({Q.LENGTH_BAD} OR {Q.CHARSET_BAD} OR {Q.YEAR_BAD})) AS valid,
    count(*) FILTER ({Q.LENGTH_BAD}) AS length_errors, count(*) FILTER ({Q.CHARSET_BAD}) AS charset_errors,
    count(*) FILTER ({Q.YEAR_BAD}) AS year_code_errors FROM aa""")(lambda d: validate.vin_error_summary(d.aligned_a))
query("write_counted", f"""{Q.ALIGNED} SELECT measure, n FROM (SELECT count(*) AS total_rows, count(*) FILTER (NOT ({Q.LENGTH_BAD} OR {Q.CHARSET_BAD} OR {Q.YEAR_BAD})) AS valid,
    count(*) FILTER ({Q.LENGTH_BAD}) AS length_errors, count(*) FILTER ({Q.CHARSET_BAD}) AS charset_errors, count(*) FILTER ({Q.YEAR_BAD}) AS year_code_errors FROM aa)
    UNPIVOT (n FOR measure IN (total_rows, valid, length_errors, charset_errors, year_code_errors))""")(
    lambda d: d.spark.createDataFrame(sorted(writers.write_counted(
        validate.mark_invalid_vin(d.aligned_a), new_path(d.spark, "marked"), {"total_rows": F.count(F.lit(1)), **validate.error_counts()}).items()), "measure string, n long"))
_SKETCHED = ["manufacturer", "model", "year", "odometer"]
query("merged_profile", f"{Q.BASE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS total_rows, count(*) - count({c}) AS null_count, round((count(*) - count({c})) / count(*)::DOUBLE * 100, 2) AS null_pct,
    min({Q.number(c)}) AS low, max({Q.number(c)}) AS high, round(sum({Q.number(c)}) / count({Q.number(c)}), 2) AS mean, true AS unique_within_5_pct, true AS median_within_1_pct_of_ranks FROM va""" for c in _SKETCHED))(
    lambda d: _merged_profile(d))


def _merged_profile(d: Data) -> DataFrame:
    """Profiles of eight parts, stored and merged; how near the estimates are to the exact values."""
    parts = materialize(profile.sketch_profile(d.raw_a, _SKETCHED, F.pmod(F.col("id"), F.lit(8))), "profile-parts")
    merged = profile.merge_profiles(parts)
    exact = profile.value_table(d.raw_a.select(*_SKETCHED), _SKETCHED).withColumn("x", values.number(F.col("value")))
    median = merged.select("column", F.get("quantiles", F.lit(0)).alias("median"))
    ranks = exact.join(median, "column").groupBy("column").agg(
        F.count("value").alias("distinct"), F.sum(F.when(F.col("x").isNotNull(), F.col("n"))).alias("all"),
        F.sum(F.when(F.col("x") < F.col("median"), F.col("n"))).alias("below"), F.sum(F.when(F.col("x") <= F.col("median"), F.col("n"))).alias("upto"))
    near = F.when(F.col("all").isNull(), True).otherwise((F.coalesce(F.col("below"), F.lit(0)) <= F.col("all") * 0.51) & (F.col("upto") >= F.col("all") * 0.49))
    return merged.join(ranks, "column").select("column", "total_rows", "null_count", "null_pct", "low", "high", F.round("mean", 2).alias("mean"),
        (F.abs(F.col("unique_estimate") - F.col("distinct")) <= F.col("distinct") * 0.05).alias("unique_within_5_pct"), near.alias("median_within_1_pct_of_ranks"))


_REPEATED = "vin IN (SELECT vin FROM aa WHERE vin <> '' GROUP BY vin HAVING count(*) > 1)"
query("mark_duplicate_vins", f"{Q.ALIGNED} SELECT * REPLACE (CASE WHEN {_REPEATED} THEN 1 ELSE invalid END AS invalid) FROM aa")(
    lambda d: validate.mark_duplicate_vins(d.aligned_a))
query("duplicate_vin_summary", f"""{Q.MARKED} SELECT count(*) FILTER (d) AS rows_modified, count(*) FILTER (NOT d AND invalid = 0) AS rows_left_valid
    FROM (SELECT coalesce(vin IN (SELECT vin FROM mi WHERE vin <> '' GROUP BY vin HAVING count(*) > 1), false) AS d, invalid FROM mi)""")(
    lambda d: validate.duplicate_vin_summary(validate.mark_invalid_vin(d.aligned_a)))


# --- similarity and duplicates --------------------------------------------

# The English stop words that Spark ships, as the SQL needs them.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its "
    "itself they them their theirs themselves what which who whom this that these those am is are was were be been being have "
    "has had having do does did doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again further then once here there "
    "when where why how all any both each few more most other some such no nor not only own same so than too very s t can will "
    "just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's "
    "we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't "
    "wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's "
    "where's who's why's would").split()



def _texts_sql() -> str:
    return "WITH RECURSIVE " + Q.texts(STOP_WORDS)


column_query("model_similarity", "labelled", lambda: F.round(pair_cosine(F.col("a_model"), F.col("b_model")), 6),
             f"round({Q.pair_cosine('a_model', 'b_model')}, 6)", Q.LABELLED, "lp")
_EDGES = """SELECT i, j, round(sim, 6) AS sim, 'similar' AS kind FROM se
    UNION ALL SELECT i, j, 1e0, 'copy' FROM cp{where}"""
query("description_similarity", f"{_texts_sql()}, {Q.similar()} {_EDGES.format(where='')}")(
    lambda d: similarity.description_similarity(d.documents, "doc_id", d.document_block, "text").withColumn("sim", F.round("sim", 6)))
_CORPUS = """
bn AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL),
tf AS (SELECT lang, source, term, sum(copies) AS df FROM tb GROUP BY ALL),
wt AS MATERIALIZED (SELECT id, lang, source, term, tb.tf * (ln((1e0 + n) / (1e0 + df)) + 1) AS w FROM tb JOIN tf USING (lang, source, term) JOIN bn USING (lang, source)),
nm AS (SELECT id, sqrt(sum(w * w)) AS l FROM wt GROUP BY id),
se AS (SELECT i, j, d / (a.l * b.l) AS sim FROM (SELECT a.id AS i, b.id AS j, sum(a.w * b.w) AS d FROM wt a JOIN wt b
  ON a.lang = b.lang AND a.source = b.source AND a.term = b.term AND a.id < b.id GROUP BY ALL) JOIN nm a ON a.id = i JOIN nm b ON b.id = j
  WHERE d / (a.l * b.l) >= 0.7e0)"""
query("corpus_similarity", f"{_texts_sql()}, {_CORPUS} {_EDGES.format(where=' WHERE n_words > 0')}")(
    lambda d: similarity.corpus_similarity(d.documents, "doc_id", d.document_block, "text").withColumn("sim", F.round("sim", 6)))


def _near(d: Data) -> dedup.NearDuplicates:
    return dedup.near_duplicates(d.documents, "doc_id", d.document_block, "text")


_DEDUP = f"{_texts_sql()}, {Q.similar()}, {Q.LEADERS}"
_SHOWN = ["doc_id", "lang", "source", "n_chars"]
query("near_dup_listings", f"{_DEDUP} SELECT {', '.join(_SHOWN)} FROM documents WHERE doc_id NOT IN (SELECT id FROM dropped)")(
    lambda d: dedup.without_duplicates(d.documents.select(*_SHOWN), _near(d), "doc_id"))
query("near_dup_vehicle_listings", f"{_DEDUP} SELECT doc_id AS id, source AS VIN, lang AS manufacturer, n_chars AS price FROM documents WHERE doc_id NOT IN (SELECT id FROM dropped)")(
    lambda d: _listing_dedup(d))


def _listing_dedup(d: Data) -> DataFrame:
    """The documents in the shape of listings: rows are compared where VIN and all compared columns agree; the price is none of them."""
    listings = d.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("VIN"), F.col("lang").alias("manufacturer"), F.col("n_chars").alias("price"), F.col("text").alias("description"))
    return dedup.without_duplicates(listings.drop("description"), dedup.find_near_dup_listings(listings))


query("near_dup_inspection", f"{_DEDUP} SELECT {', '.join(_SHOWN)} FROM documents WHERE doc_id IN (SELECT id FROM involved)")(
    lambda d: dedup.inspection(d.documents.select(*_SHOWN), _near(d), "doc_id"))
query("near_dup_summary", f"""{_DEDUP} SELECT n AS initial_rows, k AS removed_rows, n - k AS final_rows
    FROM (SELECT count(*) AS n FROM documents), (SELECT count(*) AS k FROM dropped)""")(
    lambda d: dedup.near_dup_summary(d.documents, _near(d)))
query("exact_dedup", "SELECT min(doc_id) AS doc_id, text, lang, source, n_chars FROM documents GROUP BY text, lang, source, n_chars")(
    lambda d: dedup.exact_dedup(d.documents, rid="doc_id"))
query("dup_block_sizes", f"SELECT {Q.length_prefixed_md5('lang', 'source')} AS block, count(*) AS n FROM documents GROUP BY lang, source HAVING count(*) > 1")(
    lambda d: similarity.block_sizes(d.documents.select(d.document_block.alias("block"))))


# --- blocking and candidates ----------------------------------------------

query("block_manufacturer_year", f"{Q.PREPARED} SELECT {Q.B1_COLUMNS} FROM {Q.B1_JOIN}")(
    lambda d: blocking.block_manufacturer_year(d.a, d.b))
_B2 = ", ".join(f"{s}.{c} AS {s}_{c}" for s in "ab" for c in ("rid", *LISTING_COLUMNS))
query("block_trans_fuel_year", f"""{Q.PREPARED}, fa AS (SELECT * REPLACE ({Q.block_fuel('fuel_type')} AS fuel_type) FROM pa),
    fb AS (SELECT * REPLACE ({Q.block_fuel('fuel_type')} AS fuel_type) FROM pb) SELECT {_B2} FROM fa a JOIN fb b
    ON a.transmission = b.transmission AND a.year = b.year AND a.fuel_type IS NOT DISTINCT FROM b.fuel_type""")(
    lambda d: blocking.block_transmission_fuel_year(d.a, d.b))
_COUNTS = "SELECT manufacturer, year, count(*) AS n FROM {} GROUP BY ALL"
query("block_stats", f"""{Q.PREPARED} SELECT a.manufacturer, a.year, a.n AS n_a, b.n AS n_b, a.n * b.n AS n_pairs
    FROM ({_COUNTS.format('pa')}) a JOIN ({_COUNTS.format('pb')}) b ON a.manufacturer IS NOT DISTINCT FROM b.manufacturer AND a.year IS NOT DISTINCT FROM b.year""")(
    lambda d: blocking.block_stats(d.a, d.b))
INDEX = f"""{Q.LABELLED}, ax AS (SELECT 'A' AS side, rid, manufacturer, year FROM pa UNION ALL SELECT 'B', rid, manufacturer, year FROM pb),
bi AS MATERIALIZED (SELECT manufacturer, year, row_number() OVER (ORDER BY min((side, rid))) - 1 AS block_index FROM ax
  WHERE manufacturer IS NOT NULL AND year IS NOT NULL GROUP BY manufacturer, year),
ix AS MATERIALIZED (SELECT side, rid, manufacturer, year, block_index FROM ax LEFT JOIN bi USING (manufacturer, year))"""
query("dense_block_index", f"{INDEX} SELECT * FROM ix")(lambda d: blocking.dense_block_index(d.a, d.b))
query("candidates_in_test", f"{IN_TEST} SELECT * FROM ci")(_in_test)
query("test_lookup", f"{Q.LINKAGE} SELECT * FROM tk")(lambda d: candidates.test_lookup(d.labelled))
query("missing_pairs", f"{Q.LINKAGE} SELECT {Q.KEYS}, match, predicted FROM lt WHERE candidate_rows = 0")(
    lambda d: candidates.missing_pairs(candidates.linkage_table(d.a, d.b, d.labelled)).select(*PAIR_KEY, "match", "predicted"))
_CANDIDATE_OF = " AND ".join(
    f"c.{f if f in schema.BLOCK_KEY else f'{f}_{s}'} IS NOT DISTINCT FROM lp.{s}_{f}" for s in "ab" for f in FIELDS)
query("test_right_join", f"""{IN_TEST}, c AS (SELECT DISTINCT * EXCLUDE (rid_a, rid_b) FROM ci)
    SELECT {Q.PAIR_TEXT} AS line FROM lp LEFT JOIN c ON {_CANDIDATE_OF}""")(
    lambda d: candidates.serialize_pairs(candidates.test_right_join(d.a, d.b, d.labelled)))
query("candidates_right_join", f"""{IN_TEST}, c AS (SELECT DISTINCT * EXCLUDE (rid_a, rid_b) FROM ci)
    SELECT {Q.PAIR_TEXT} AS line FROM lp LEFT JOIN c ON {_CANDIDATE_OF}""")(
    lambda d: candidates.serialize_pairs(candidates.candidates_right_join(
        dedup.exact_dedup(_in_test(d).drop("rid_a", "rid_b")), d.labelled)))
_MATCHES = """av AS MATERIALIZED (SELECT * EXCLUDE (invalid) FROM pa WHERE invalid = 0),
bv AS MATERIALIZED (SELECT * EXCLUDE (invalid) FROM pb WHERE invalid = 0),
vm AS MATERIALIZED (SELECT a.rid AS anchor, min(b.rid) AS b_rid, a.vin FROM av a JOIN bv b USING (vin) GROUP BY a.rid, a.vin)"""
_BOTH = ", ".join(f"{s}.{c} AS {s}_{c}" for s in "ab" for c in ("rid", "vin", *FIELDS))
query("vin_match_join", f"{Q.PREPARED}, {_MATCHES} SELECT {_BOTH} FROM vm JOIN av a ON a.rid = anchor JOIN bv b ON b.rid = b_rid")(
    lambda d: labels.vin_match_join(schema.extract_valid(d.a).drop("invalid"), schema.extract_valid(d.b).drop("invalid")))


# --- labelled pairs -------------------------------------------------------

BUILT = f"""{Q.PREPARED}, {_MATCHES}, {Q.pool('pool_a', 'av')}, {Q.pool('pool_b', 'bv')},
bp AS (SELECT anchor AS x, b_rid AS y, 1 AS match FROM vm UNION ALL SELECT anchor, rid, 0 FROM ({Q.negatives('pool_b', 'vm', 1, 'b')})
 UNION ALL SELECT s.rid, vm.b_rid, 0 FROM ({Q.negatives('pool_a', 'vm', 1, 'a')}) s JOIN vm USING (anchor)),
bl AS MATERIALIZED (SELECT {_BOTH}, match FROM bp JOIN av a ON a.rid = x JOIN bv b ON b.rid = y)"""
query("build_labelled_pairs", f"{BUILT} SELECT * FROM bl")(lambda d: labels.build_labelled_pairs(d.a, d.b))
query("drop_pair_vins", f"{BUILT} SELECT * EXCLUDE (a_vin, b_vin) FROM bl")(
    lambda d: schema.drop_pair_vins(labels.build_labelled_pairs(d.a, d.b)))
query("label_counts", f"{BUILT} SELECT match, count(*) AS n FROM bl GROUP BY match")(
    lambda d: labels.label_counts(labels.build_labelled_pairs(d.a, d.b)))


@query("negative_samples", f"{Q.PREPARED}, {_MATCHES}, {Q.pool('pool_b', 'bv')} {Q.negatives('pool_b', 'vm', 3, 'b')}")
def _(d: Data):
    a, b = schema.extract_valid(d.a), schema.extract_valid(d.b)
    anchors = labels.vin_match_join(a, b).select(F.col("a_rid").alias("anchor"), F.col("a_vin").alias("vin"))
    return labels.negative_samples(anchors, b, 3, 42, "b")


SPLIT = f"""{Q.LABELLED}, rk AS (SELECT rid, row_number() OVER (ORDER BY md5('42|' || rid), rid) AS r, count(*) OVER () AS n FROM lp),
sl AS (SELECT rid, CASE WHEN r <= floor(n * 0.7e0) THEN 'train' WHEN r <= floor(n * 0.7e0) + floor(n * 0.2e0) THEN 'validation' ELSE 'test' END AS split FROM rk)"""
query("split_labelled", f"{SPLIT} SELECT rid, split FROM sl")(lambda d: labels.split_labelled(d.labelled).select("rid", "split"))
query("split_summary", f"{SPLIT} SELECT split, count(*) AS n, round(count(*) / (SELECT count(*) FROM sl)::DOUBLE * 100, 1) AS pct FROM sl GROUP BY split")(
    lambda d: labels.split_summary(labels.split_labelled(d.labelled)))
query("sample_rows", f"{Q.LABELLED} SELECT * FROM lp ORDER BY md5('42|' || rid), rid LIMIT 1000")(lambda d: labels.sample_rows(d.labelled, 1000))
query("exact_rank", f"{SPLIT} SELECT rid, r AS rank FROM rk")(
    lambda d: exact_rank(d.labelled.select("rid"), md5_order(42, F.col("rid")), ["rid"]))


# --- comparison and scoring -----------------------------------------------

def _scorer(name: str, field: str, score: Callable[[Column, Column], Column], sql_score: Callable[[str, str], str]) -> None:
    a, b = f"a_{field}", f"b_{field}"
    column_query(name, "labelled", lambda: F.round(score(F.col(a), F.col(b)), 6), f"round({sql_score(a, b)}, 6)", Q.LABELLED, "lp")


_scorer("score_model", "model", scoring.model_score, Q.model_score)
_scorer("score_mileage", "mileage", scoring.mileage_score, Q.mileage_score)
_scorer("score_fuel", "fuel_type", scoring.fuel_score, Q.fuel_score)
_scorer("score_body", "body_type", scoring.body_score, Q.body_score)
_scorer("score_cylinders", "cylinders", scoring.cylinders_score, Q.cylinders_score)
_scorer("score_drive", "drive", scoring.drive_score, Q.drive_score)
_scorer("score_color", "color", scoring.color_score, Q.color_score)
_scorer("score_exact", "manufacturer", lambda a, b: scoring.exact_score(a, b, 0.2), lambda a, b: Q.exact_score(a, b, "0.2"))


def _scored_labels(d: Data) -> DataFrame:
    """Labelled pairs with their rule score, score computed once per row."""
    return d.labelled.withColumn("score", scoring.pair_score(side("a_"), side("b_")))


query("pair_score", f"{Q.LABELLED} SELECT rid, round({Q.PAIR_SCORE}, 6) AS score FROM lp")(
    lambda d: _scored_labels(d).select("rid", F.round("score", 6).alias("score")))
query("match_flag", f"{Q.LABELLED} SELECT rid, CAST({Q.PAIR_SCORE} >= 0.7e0 AS INT) AS predicted FROM lp")(
    lambda d: _scored_labels(d).select("rid", scoring.match_flag(F.col("score")).alias("predicted")))


def _cmp_sql(field: str, same: str) -> str:
    return f"CASE WHEN {same.format(x=f'a_{field}', y=f'b_{field}')} THEN 0 ELSE 1 END"


_SAME_BODY = Q.OTHER + " OR " + Q._pairs("{x}", "{y}", Q.BODIES)
_SAME_DRIVE = Q._pairs("{x}", "{y}", Q.DRIVES)
for _name, _field, _compare, _same in (("cmp_other", "fuel_type", comparators.other_distance, Q.OTHER),
                                       ("cmp_body", "body_type", comparators.body_distance, _SAME_BODY),
                                       ("cmp_drive", "drive", comparators.drive_distance, _SAME_DRIVE)):
    column_query(_name, "labelled", lambda c=_compare, f=_field: c(F.col(f"a_{f}"), F.col(f"b_{f}")), _cmp_sql(_field, _same), Q.LABELLED, "lp")


def _features_sql(distances: dict[str, str], rounded: bool = True) -> str:
    out = []
    for f, e in distances.items():
        missing = f"(a_{f} IS NULL OR b_{f} IS NULL)"
        value = f"round(CAST({e} AS DOUBLE), 6)" if rounded else f"CAST({e} AS DOUBLE)"
        out += [f"coalesce(CASE WHEN NOT {missing} THEN {value} END, 0e0) AS d_{f}", f"CAST({missing} AS INT) AS m_{f}"]
    return ", ".join(out)


_STRINGS = ("manufacturer", "transmission")


_PRICE = f"""CASE WHEN {Q.number('a_mileage')} > 0 AND {Q.number('b_mileage')} > 0
    THEN abs(log10({Q.number('a_mileage')}) - log10({Q.number('b_mileage')})) END"""
_DISTANCES = {
    "manufacturer": Q.string_distance("manufacturer"), "model": f"1 - ({Q.pair_cosine('a_model', 'b_model')})",
    "year": "CASE WHEN a_year = b_year THEN 0 ELSE 1 END", "mileage": _PRICE, "fuel_type": _cmp_sql("fuel_type", Q.OTHER),
    "transmission": Q.string_distance("transmission"), "body_type": _cmp_sql("body_type", _SAME_BODY),
    "cylinders": _cmp_sql("cylinders", Q.OTHER), "drive": _cmp_sql("drive", _SAME_DRIVE),
    "color": f"1 - ({Q.pair_cosine('a_color', 'b_color')})"}


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c.startswith("d_") else c for c in df.columns])


_COMPARED = f"{Q.LABELLED}, {Q.affine(Q.string_pairs('lp', *_STRINGS))}"
query("affine_gap", f"{_COMPARED} SELECT rid, round({Q.string_distance('manufacturer')}, 6) AS value FROM lp")(
    lambda d: d.labelled.select("rid", F.round(affine_gap(F.col("a_manufacturer"), F.col("b_manufacturer")), 6).alias("value")))
query("comparison_vector", f"{_COMPARED} SELECT rid, {_features_sql(_DISTANCES)} FROM lp")(
    lambda d: _rounded(learned.comparison_vector(d.labelled, ["rid"])))
query("custom_comparator", f"""{Q.LABELLED} SELECT rid, {_features_sql({
    'model': 'abs(length(a_model) - length(b_model))',
    'fuel_type': "CASE WHEN a_fuel_type = 'other' OR b_fuel_type = 'other' OR a_fuel_type = b_fuel_type THEN 0 ELSE 1 END"})} FROM lp""")(
    lambda d: _rounded(learned.comparison_vector(d.labelled, ["rid"], {
        "model": lambda a, b: F.abs(F.length(a) - F.length(b)),
        "fuel_type": lambda a, b: comparators.other_distance(a, b, equal_is_match=True)})))


# --- evaluation -----------------------------------------------------------

query("rule_linkage_eval", f"{Q.LINKAGE} {Q.prf('lt WHERE candidate_rows > 0', 'candidate_rows')}")(
    lambda d: evaluate.rule_linkage_eval(d.a, d.b, d.labelled, digits=6))
query("rule_linkage_eval_full", f"{Q.LINKAGE} {Q.prf('lt', 'greatest(candidate_rows, 1)')}")(
    lambda d: evaluate.rule_linkage_eval_full(d.a, d.b, d.labelled, digits=6))
query("prf_metrics", f"{Q.LABELLED} {Q.prf(f'(SELECT match, CAST({Q.PAIR_SCORE} >= 0.7e0 AS INT) AS predicted FROM lp)')}")(
    lambda d: evaluate.prf_metrics(_scored_labels(d).withColumn("predicted", scoring.match_flag(F.col("score"))), digits=6))
query("coverage", f"""{Q.LINKAGE} SELECT 'pairs_evaluated' AS measure, count(*) AS n FROM lt WHERE candidate_rows > 0
    UNION ALL SELECT 'test_pairs', count(*) FROM lt UNION ALL SELECT 'test_rows', count(*) FROM lp
    UNION ALL SELECT 'candidate_rows', count(*) FROM {Q.B1_JOIN}""")(lambda d: evaluate.coverage(d.a, d.b, d.labelled))
query("prediction_table", f"{Q.LINKAGE} SELECT {Q.KEYS}, match, candidate_rows, round(score, 6) AS score, predicted FROM lt")(
    lambda d: candidates.linkage_table(d.a, d.b, d.labelled).withColumn("score", F.round("score", 6)))
query("labelled_pair_ids", f"""{Q.LABELLED} SELECT DISTINCT a_id, b_id FROM lp WHERE match = 1
    AND a_id IN (SELECT rid FROM ma WHERE invalid = 0) AND b_id IN (SELECT rid FROM ab)""")(
    lambda d: evaluate.labelled_pair_ids(d.labelled, schema.extract_valid(d.marked_a), d.aligned_b))
query("positional_pair_ids", f"""{IN_TEST}, nr AS (SELECT row_number() OVER (ORDER BY rid) - 1 AS i FROM lp)
    SELECT 'A_' || i AS a_id, 'B_' || i AS b_id FROM nr WHERE i < (SELECT count(*) FROM ci)""")(
    lambda d: evaluate.positional_pair_ids(d.labelled, materialize(
        _in_test(d).select(pair_rid("rid_a", "rid_b").alias("rid")), "record-pairs")))
query("scored_pair_eval", "WITH s AS (SELECT CAST(n_chars % 1000 / 1000e0 >= 0.7e0 AS INT) AS predicted, quality AS match FROM documents JOIN labels USING (doc_id)) " + Q.prf("s"))(
    lambda d: evaluate.scored_pair_eval(d.scored, digits=6))


def _predicted(d: Data) -> DataFrame:
    return _scored_labels(d).filter(F.col("score") >= F.lit(scoring.MATCH_THRESHOLD)).select("a_id", "b_id")


def _truth(d: Data) -> DataFrame:
    return d.labelled.filter("match = 1").select("a_id", "b_id")


SETS = f"""{INDEX}, pp AS MATERIALIZED (SELECT DISTINCT a_id, b_id FROM lp WHERE {Q.PAIR_SCORE} >= 0.7e0),
tp AS MATERIALIZED (SELECT DISTINCT a_id, b_id FROM lp WHERE match = 1)"""
for _name, _op, _sql in (("pair_intersect", evaluate.pair_intersect, "INTERSECT"), ("pair_except", evaluate.pair_except, "EXCEPT"),
                         ("pair_union", evaluate.pair_union, "UNION")):
    query(_name, f"{SETS} SELECT * FROM pp {_sql} SELECT * FROM tp")(lambda d, op=_op: op(_predicted(d), _truth(d)))
query("cluster_pairs", f"""{Q.BASE}, cl AS (SELECT VIN AS cluster_id, 'A_' || id AS member FROM va WHERE VIN IS NOT NULL
    UNION ALL SELECT vin, 'B_' || id FROM vb) SELECT x.cluster_id, x.member AS member_1, y.member AS member_2
    FROM cl x JOIN cl y ON x.cluster_id = y.cluster_id AND x.member < y.member""")(
    lambda d: evaluate.cluster_pairs(
        d.raw_a.select(F.col("VIN").alias("cluster_id"), F.concat(F.lit("A_"), F.col("id").cast("string")).alias("member"))
        .unionByName(d.raw_b.select(F.col("vin").alias("cluster_id"), F.concat(F.lit("B_"), F.col("id").cast("string")).alias("member")))))
query("block_eval", f"""{SETS}, fl AS (SELECT a_id, b_id, max(p) AS p, max(t) AS t FROM (SELECT *, 1 AS p, 0 AS t FROM pp UNION ALL SELECT *, 0, 1 FROM tp) GROUP BY ALL),
    bs AS (SELECT block_index, sum(p) AS predicted, sum(t) AS actual, sum(p * t) AS tp FROM fl JOIN ix ON side = 'A' AND rid = a_id WHERE block_index IS NOT NULL GROUP BY block_index),
    ex AS (SELECT block_index, arg_min(manufacturer, (side, rid)) AS m, arg_min(year, (side, rid)) AS y, arg_min(manufacturer IS NULL, (side, rid)) AS mn, arg_min(year IS NULL, (side, rid)) AS yn FROM ix GROUP BY block_index)
    SELECT ex.block_index, CASE WHEN NOT mn THEN m END AS manufacturer, CASE WHEN NOT yn THEN y END AS year, CAST(coalesce(predicted, 0) AS BIGINT) AS predicted, CAST(coalesce(actual, 0) AS BIGINT) AS actual, CAST(coalesce(tp, 0) AS BIGINT) AS tp
    FROM ex LEFT JOIN bs ON ex.block_index = bs.block_index""")(lambda d: evaluate.block_eval(d.a, d.b, _predicted(d), _truth(d)))


# --- block predicates -----------------------------------------------------

_RULES = predicates.rules_of(predicates.LISTING_PREDICATES)


@query("predicate_costs", f"{Q.PREDICATE_KEYS} SELECT name AS rule, pairs, blocks FROM rc")
def _(d: Data):
    names = d.spark.createDataFrame([(n, r.name) for n, r in enumerate(_RULES)], "rule int, name string")
    return predicates.rule_costs(d.a, d.b, predicates.LISTING_PREDICATES, _RULES).join(names, "rule").select(F.col("name").alias("rule"), "pairs", "blocks")


@query("predicate_cover", f"""{Q.PREDICATE_KEYS} SELECT covers, count(*) AS n FROM (SELECT coalesce(string_agg(CAST(p AS VARCHAR), ',' ORDER BY p), '') AS covers
    FROM ms LEFT JOIN mp USING (a_id, b_id) GROUP BY a_id, b_id) GROUP BY covers""")
def _(d: Data):
    patterns = predicates.cover_patterns(d.labelled.filter("match = 1"), predicates.LISTING_PREDICATES)
    return patterns.select(F.concat_ws(",", F.transform("covers", lambda i: i.cast("string"))).alias("covers"), "n")


@query("learned_predicates", f"""{Q.COVER} SELECT CAST(step AS INT) AS step, chosen[-1] AS rule, CAST(added AS BIGINT) AS added, pairs, round(covered / total::DOUBLE, 6) AS recall FROM gr, tt WHERE step > 0""")
def _(d: Data):
    chosen = predicates.learn_rules(d.a, d.b, d.labelled.filter("match = 1"), beam=0)
    rows = [(k + 1, c.rule.name, c.added, c.pairs, round(c.recall, 6)) for k, c in enumerate(chosen)]
    return d.spark.createDataFrame(rows, "step int, rule string, added long, pairs long, recall double")


# A set of rules that is given, not learned.
GIVEN_RULES = [predicates.rule(predicates.LISTING_PREDICATES, *names) for names in (("whole(model)", "whole(year)"), ("whole(manufacturer)", "near20000(mileage)"))]


# --- learned linkage ------------------------------------------------------

_FEATURES = [f"{p}_{f}" for f in _DISTANCES for p in ("d", "m")]


@query("train_linker", f"""{_COMPARED}, fv AS MATERIALIZED (SELECT match, {_features_sql(_DISTANCES)} FROM lp)
    {' UNION ALL '.join(f"SELECT '{c}' AS measure, round(sum({c}), 3) AS value FROM fv" for c in _FEATURES)}
    UNION ALL SELECT 'f1 is 0.9 or more', 1e0""")
def _(d: Data):
    """Totals of the features that the linker is trained on, and whether it tells the labels apart."""
    features = materialize(learned.comparison_vector(d.labelled, ["rid", "match"]), "features")
    scored = learned.score_pairs(_linker(d), features)
    f1 = evaluate.prf_metrics(scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))).select(F.lit("f1 is 0.9 or more").alias("measure"), (F.col("f1") >= 0.9).cast("double").alias("value"))
    totals = _rounded(features).agg(*[F.round(F.sum(c).cast("double"), 3).alias(c) for c in _FEATURES])
    shown = totals.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in _FEATURES])).alias("x")).select("x.*")
    return shown.unionByName(f1)


# Weights that are given, not learned, so that the linkage can be compared row by row.
GIVEN_WEIGHTS = {"d_manufacturer": -0.5, "d_model": -6.0, "d_year": -2.0, "d_mileage": -8.0, "d_fuel_type": -0.25, "d_transmission": -0.25, "d_body_type": -0.25,
                 "m_model": -1.0, "m_mileage": -1.0}
GIVEN_SCORER = learned.weighted_scorer(GIVEN_WEIGHTS, 4.0)
_GIVEN_SCORE = "round(1 / (1 + exp(-(4e0 " + " ".join(f"+ {w}e0 * {c}" for c, w in GIVEN_WEIGHTS.items()) + "))), 6)"


def _scored_sql(pairs: str, a: str, b: str) -> str:
    """CTE sc: score of each pair of ids, from the records of the two tables."""
    fields = ", ".join(f"{s}.{f} AS {s}_{f}" for s in "ab" for f in FIELDS)
    return f"""
wide AS MATERIALIZED (SELECT a_id, b_id, {fields} FROM ({pairs}) JOIN {a} a ON a.rid = a_id JOIN {b} b ON b.rid = b_id),
{Q.affine(Q.string_pairs('wide', *_STRINGS))},
sc AS MATERIALIZED (SELECT a_id, b_id, {_GIVEN_SCORE} AS score FROM (SELECT a_id, b_id, {_features_sql(_DISTANCES, rounded=False)} FROM wide))"""


_GIVEN_PAIRS = f"""SELECT DISTINCT x.rid AS a_id, y.rid AS b_id FROM rk x JOIN rk y ON x.side = 'a' AND y.side = 'b' AND x.name = y.name AND x.key = y.key
    WHERE x.name IN ({', '.join("'" + r.name + "'" for r in GIVEN_RULES)})"""
query("predicate_pairs", f"{Q.PREDICATE_KEYS} {_GIVEN_PAIRS}")(lambda d: predicates.rule_pairs(d.a, d.b, GIVEN_RULES))
query("link_records", f"""{Q.PREDICATE_KEYS}, {_scored_sql(_GIVEN_PAIRS, 'pa', 'pb')}, {Q.greedy('(SELECT * FROM sc WHERE score >= 0.9e0)')} SELECT * FROM go""")(
    lambda d: learned.link_records(GIVEN_SCORER, d.a, d.b, GIVEN_RULES))


def _split(d: Data) -> DataFrame:
    return materialize(labels.split_labelled(d.labelled), "split")


# Candidates of the test part without repeats (dp), and the two tables of records made of them (ra, rb).
_SHOWN_PAIR = ["manufacturer", "year", *[f"{c}_{s}" for s in "ab" for c in LISTING_COLUMNS if c not in ("vin", "manufacturer", "year")]]


def _record_sql(s: str) -> str:
    def value(f: str) -> str:
        own = f if f in schema.BLOCK_KEY else f"{f}_{s}"
        text = f"CASE WHEN {Q.strip(own)} <> '' THEN lower({Q.strip(own)}) END"
        number = Q.number(f"replace(({text}), ',', '')")
        return f"CAST({number} AS VARCHAR) AS {f}" if f in ("year", "mileage") else f"{text} AS {f}"
    return f"SELECT '{s.upper()}_' || i AS rid, {', '.join(map(value, FIELDS))} FROM dp"


def _rule_sql(r: predicates.Rule) -> str:
    x, y = r.parts
    return f"SELECT '{r.name}' AS name, x.side, x.rid, length(x.key) || ':' || x.key || y.key AS key FROM kt x JOIN kt y USING (side, rid) WHERE x.p = {x} AND y.p = {y}"


TEST_RECORDS = f"""{SPLIT}, te AS MATERIALIZED (SELECT lp.* FROM lp JOIN sl USING (rid) WHERE split = 'test'),
kt0 AS (SELECT DISTINCT {', '.join(f"coalesce({k}, '') AS {k}" for k in PAIR_KEY)} FROM te),
c0 AS (SELECT {Q.B1_COLUMNS} FROM {Q.B1_JOIN}),
c1 AS (SELECT * FROM c0 WHERE EXISTS (SELECT 1 FROM kt0 WHERE {' AND '.join(f"{s}_{f} = coalesce({f if f in schema.BLOCK_KEY else f'{f}_{s}'}, '')" for s in 'ab' for f in FIELDS)})),
dp AS MATERIALIZED (SELECT *, CAST(row_number() OVER (ORDER BY first) - 1 AS VARCHAR) AS i FROM (
  SELECT {', '.join(_SHOWN_PAIR)}, min(rid_a || '-' || rid_b) AS first FROM c1 GROUP BY ALL)),
lb AS MATERIALIZED (SELECT {', '.join(f"coalesce({k}, '') AS {k}" for k in PAIR_KEY)}, arg_max(match, rid) AS match FROM te GROUP BY ALL),
tru AS MATERIALIZED (SELECT 'labels' AS truth, 'A_' || i AS a_id, 'B_' || i AS b_id FROM dp JOIN lb ON {' AND '.join(f"{s}_{f} = coalesce({f if f in schema.BLOCK_KEY else f'dp.{f}_{s}'}, '')" for s in 'ab' for f in FIELDS)} WHERE match = 1
  UNION ALL SELECT 'positions', 'A_' || i, 'B_' || i FROM dp WHERE CAST(i AS BIGINT) < (SELECT count(*) FROM sl WHERE split = 'validation')),
ra AS MATERIALIZED ({_record_sql('a')}), rb AS MATERIALIZED ({_record_sql('b')}),
kt AS MATERIALIZED ({' UNION ALL '.join(f"SELECT '{s}' AS side, rid, {i} AS p, unnest({Q.PREDICATES[i][1]}) AS key FROM r{s}" for s in 'ab' for i in sorted({i for r in GIVEN_RULES for i in r.parts}))}),
rr AS MATERIALIZED ({' UNION ALL '.join(map(_rule_sql, GIVEN_RULES))}),
{_scored_sql("SELECT DISTINCT x.rid AS a_id, y.rid AS b_id FROM rr x JOIN rr y ON x.side = 'a' AND y.side = 'b' AND x.name = y.name AND x.key = y.key", 'ra', 'rb')}"""
# The score of the best expected F-measure, recall counted twice as much.
_BEST_LOW = """(SELECT score FROM (SELECT score, (e / te) * (e / n) / (e / te + 4 * (e / n)) AS v FROM (SELECT score, sum(n) OVER w AS n, sum(e) OVER w AS e, sum(e) OVER () AS te
    FROM (SELECT score, count(*) AS n, sum(score) AS e FROM sc GROUP BY score) WINDOW w AS (ORDER BY score DESC))) ORDER BY v DESC, score DESC LIMIT 1)"""


def _linked_records(d: Data) -> tuple[linkage.Records, linkage.Linked, DataFrame]:
    split = _split(d)
    records = linkage.test_records(d.a, d.b, split.filter("split = 'test'"))
    return records, linkage.link_test_records(records, GIVEN_SCORER, GIVEN_RULES), split


def _greedy_sql(low: str, mode: str) -> str:
    return Q.greedy(f"(SELECT * FROM sc WHERE score >= {low})", f"_{mode}")


def _prf_row(truth: str, mode: str, low: str) -> str:
    flags = f"(SELECT coalesce(p, 0) AS predicted, coalesce(t, 0) AS match FROM (SELECT a_id, b_id, 1 AS p FROM go_{mode}) FULL JOIN (SELECT a_id, b_id, 1 AS t FROM tru WHERE truth = '{truth}') USING (a_id, b_id))"
    return f"SELECT '{truth}' AS truth, '{mode}' AS mode, CAST({low} AS DOUBLE) AS threshold, * FROM ({Q.prf(flags)})"


@query("linker_eval", f"""{TEST_RECORDS}, {_greedy_sql('0.9e0', 'fixed')}, {_greedy_sql(_BEST_LOW, 'expected')}
    {' UNION ALL '.join(_prf_row(t, m, low) for t in ('labels', 'positions') for m, low in (('fixed', '0.9e0'), ('expected', _BEST_LOW)))}""")
def _(d: Data):
    records, linked, split = _linked_records(d)
    truths = {"labels": linkage.labelled_truth(records), "positions": linkage.positional_truth(records, split.filter("split = 'validation'"))}
    return linkage.evaluation_table(linked, truths, digits=6)


query("linker_block_report", f"""{TEST_RECORDS}, {_greedy_sql('0.9e0', '')},
    fl AS (SELECT a_id, b_id, max(p) AS p, max(t) AS t FROM (SELECT a_id, b_id, 1 AS p, 0 AS t FROM go UNION ALL SELECT a_id, b_id, 0, 1 FROM tru WHERE truth = 'labels') GROUP BY ALL),
    ax AS (SELECT 'A' AS side, rid, manufacturer, year FROM ra UNION ALL SELECT 'B', rid, manufacturer, year FROM rb),
    bi AS (SELECT manufacturer, year, row_number() OVER (ORDER BY min((side, rid))) - 1 AS block_index FROM ax WHERE manufacturer IS NOT NULL AND year IS NOT NULL GROUP BY manufacturer, year),
    ix AS (SELECT side, rid, block_index FROM ax LEFT JOIN bi USING (manufacturer, year)),
    bs AS (SELECT block_index, sum(p) AS predicted, sum(t) AS actual, sum(p * t) AS tp FROM fl JOIN ix ON rid = a_id WHERE block_index IS NOT NULL GROUP BY block_index)
    SELECT bi.block_index, manufacturer, CAST(year AS DOUBLE) AS year, CAST(coalesce(predicted, 0) AS BIGINT) AS predicted, CAST(coalesce(actual, 0) AS BIGINT) AS actual, CAST(coalesce(tp, 0) AS BIGINT) AS tp
    FROM bi LEFT JOIN bs USING (block_index)""")
def _(d: Data):
    records, linked, _ = _linked_records(d)
    return linkage.block_report(records, linked.links["fixed"], linkage.labelled_truth(records)).filter("block_index IS NOT NULL")


@query("learned_linkage", f"""{TEST_RECORDS} SELECT measure, CAST(value AS BIGINT) AS value FROM (VALUES ('test pairs', (SELECT count(*) FROM dp)), ('true pairs', (SELECT count(*) FROM tru WHERE truth = 'labels')),
    ('rules cover 0.95 of what they can', 1), ('fewer candidates than the block key gives', 1), ('f1 at the expected threshold is 0.75 or more', 1), ('recall there is not below the fixed one', 1)) v(measure, value)""")
def _(d: Data):
    """Train on the train part, store, load, learn rules, link the records of the test part; sizes, and whether the goals are met."""
    split = _split(d)
    parts = {name: split.filter(F.col("split") == name) for name in ("train", "test")}
    trained = linkage.train_and_store(d.a, d.b, parts["train"], new_path(d.spark, "linker"))
    records = linkage.test_records(d.a, d.b, parts["test"])
    linked = linkage.link_test_records(records, trained.scorer, [c.rule for c in trained.rules])
    truth = linkage.labelled_truth(records)
    table = {r["mode"]: r for r in linkage.evaluation_table(linked, {"labels": truth}).collect()}
    block_pairs = blocking.candidate_count(records.a, records.b).first()[0]
    rows = [("test pairs", records.pairs.count()), ("true pairs", truth.count()), ("rules cover 0.95 of what they can", int(trained.rules[-1].recall >= 0.93)),
            ("fewer candidates than the block key gives", int(linked.scored.count() < block_pairs)),
            ("f1 at the expected threshold is 0.75 or more", int(table["expected"]["f1"] >= 0.75)), ("recall there is not below the fixed one", int(table["expected"]["recall"] >= table["fixed"]["recall"]))]
    return d.spark.createDataFrame(rows, "measure string, value long")


query("one_to_one", f"{Q.LABELLED}, {Q.greedy(f'(SELECT a_id, b_id, round({Q.PAIR_SCORE}, 6) AS score FROM lp)')} SELECT * FROM go")(
    lambda d: learned.one_to_one(_scored_labels(d).select("a_id", "b_id", F.round("score", 6).alias("score"))))
_CUM = """WITH s AS (SELECT n_chars % 1000 / 1000e0 AS score, quality AS label FROM documents JOIN labels USING (doc_id)),
    g AS (SELECT score, count(*) AS n, sum(score) AS e, sum(label) AS t FROM s GROUP BY score),
    c AS (SELECT score, sum(n) OVER w AS n, sum(e) OVER w AS e, sum(t) OVER w AS t, sum(e) OVER () AS te, sum(t) OVER () AS tt FROM g WINDOW w AS (ORDER BY score DESC))"""
query("pick_threshold", f"""{_CUM}, v AS (SELECT score AS threshold, (e / te) * (e / n) / (e / te + 4 * (e / n)) AS value FROM c WHERE e > 0)
    SELECT threshold, round(value, 6) AS value FROM v ORDER BY v.value DESC, threshold DESC LIMIT 1""")(
    lambda d: learned.pick_threshold(d.scored).withColumn("value", F.round("value", 6)))
query("best_f1_threshold", f"""{_CUM}, v AS (SELECT score AS threshold, 2 * t::DOUBLE / (n + tt)::DOUBLE AS f1 FROM c)
    SELECT threshold, round(f1, 6) AS f1 FROM v ORDER BY v.f1 DESC, threshold DESC LIMIT 1""")(
    lambda d: learned.best_f1_threshold(d.scored).withColumn("f1", F.round("f1", 6)))
