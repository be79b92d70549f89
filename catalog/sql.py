"""SQL texts of the derived tables and of column rules, for the other engine."""

from __future__ import annotations

from catalog.data import LISTINGS
from pairwright.operators.schema import FIELDS, LISTING_COLUMNS, PAIR_KEY

# Fixed values, stated here again so that a wrong one in the library shows.
TRANSMISSION_RENAMES = {"a": "automatic", "m": "manual", "cvt": "other", "dual clutch": "other"}
BODY_RENAMES = {"suv / crossover": "suv", "pickup truck": "pickup"}
BLOCK_FUEL_RENAMES = {"flex fuel vehicle": "gasoline", "biodiesel": "diesel", "compressed natural gas": "other", "propane": "other"}
COLORS = ("white", "black", "silver", "blue", "grey", "red", "green", "custom", "brown", "yellow", "orange", "purple")
YEAR_CODES = "ABCDEFGHJKLMNPRSTVWXY123456789"
SOURCE_NAMES = {
    "vehicles": {"VIN": "vin", "manufacturer": "manufacturer", "model": "model", "year": "year", "odometer": "mileage", "fuel": "fuel_type",
                 "transmission": "transmission", "type": "body_type", "cylinders": "cylinders", "drive": "drive", "paint_color": "color"},
    "used_cars": {"vin": "vin", "make_name": "manufacturer", "model_name": "model", "year": "year", "mileage": "mileage", "fuel_type": "fuel_type",
                  "transmission": "transmission", "body_type": "body_type", "engine_cylinders": "cylinders", "wheel_system": "drive",
                  "exterior_color": "color"},
}


def strip(c): return f"regexp_replace({c}, '^[\\s\\x0b\\x1c-\\x1f\\x85\\pZ]+|[\\s\\x0b\\x1c-\\x1f\\x85\\pZ]+$', '', 'g')"


def _case(value: str, renames: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in renames.items())
    return f"CASE {value} {whens} ELSE {value} END"


def manufacturer(c): return f"replace(replace(lower({c}), '-', ''), ' ', '')"
def fuel_type(c): return _case(f"lower({strip(c)})", {"gas": "gasoline"})
def lower(c): return f"lower({c})"
def transmission(c): return _case(f"lower({c})", TRANSMISSION_RENAMES)
def body_type(c): return f"replace(replace({_case(f'lower({c})', BODY_RENAMES)}, ' ', ''), '-', '')"
def block_fuel(c): return _case(f"lower({strip(c)})", BLOCK_FUEL_RENAMES)


def cylinders(c):
    d = f"regexp_extract({c}, '[0-9]+')"
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {d} IN ('', '2') THEN 'other' "
            f"ELSE CAST(CAST({d} AS BIGINT) AS VARCHAR) END")


def color(c):
    x = f"replace(lower({c}), 'gray', 'grey')"
    return "CASE " + " ".join(f"WHEN contains({x}, '{n}') THEN '{n}'" for n in COLORS) + f" ELSE {x} END"


NORMALIZERS = {"manufacturer": manufacturer, "fuel_type": fuel_type, "color": color, "drive": lower,
               "transmission": transmission, "body_type": body_type, "cylinders": cylinders, "model": lower}


def number(c): return f"CASE WHEN regexp_full_match({strip(c)}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST({strip(c)} AS DOUBLE) END"
def whole(c): return f"TRY_CAST(trunc({number(c)}) AS BIGINT)"
def whole_text(c): return f"coalesce(CAST({whole(c)} AS VARCHAR), {strip(c)})"


V = "coalesce(vin, '')"
LENGTH_BAD = f"length({V}) <> 17"
CHARSET_BAD = (f"(NOT regexp_full_match({V}, '(?i)[A-HJ-NPR-Z0-9]{{17}}') OR regexp_full_match({V}, '[0-9]{{17}}') "
               f"OR regexp_full_match({V}, '[A-Za-z]{{17}}'))")
_Y = f"TRY_CAST({whole('year')} AS INT)"
YEAR_BAD = (f"coalesce(length({V}) >= 10 AND {_Y} BETWEEN 1980 AND 2039 AND "
            f"substr({V}, 10, 1) <> substr('{YEAR_CODES}', ({_Y} - 1980) % 30 + 1, 1), false)")


def _align(source: str, kind: str) -> str:
    cols = ", ".join(f"{s} AS {d}" for s, d in SOURCE_NAMES[kind].items())
    return f"SELECT id AS rid, {cols}, 0 AS invalid FROM {source}"


def normalized(exprs: dict[str, str] | None = None) -> str:
    """Select list of a listing table with normalised fields."""
    rules = {c: f(c) for c, f in NORMALIZERS.items()} if exprs is None else exprs
    return ", ".join(["rid"] + [f"{rules[c]} AS {c}" if c in rules else c for c in LISTING_COLUMNS])


_NUMERIC = {c: whole_text(c) for c in ("mileage", "year", "cylinders")}

BASE = "WITH RECURSIVE " + LISTINGS.format(orders="orders", part="part")
ALIGNED = BASE + f""",
aa AS ({_align('va', 'vehicles')}),
ab AS ({_align('vb', 'used_cars')})"""
MARKED = ALIGNED + f""",
mi AS (SELECT * REPLACE (CAST({LENGTH_BAD} OR {CHARSET_BAD} OR {YEAR_BAD} AS INT) AS invalid) FROM aa),
ma AS (SELECT * REPLACE (CASE WHEN vin IN (SELECT vin FROM mi WHERE vin <> '' GROUP BY vin HAVING count(*) > 1) THEN 1 ELSE invalid END AS invalid) FROM mi)"""
PREPARED = MARKED + f""",
pa AS MATERIALIZED (SELECT {normalized(_NUMERIC)} FROM (SELECT {normalized()} FROM ma)),
pb AS MATERIALIZED (SELECT {normalized(_NUMERIC)} FROM (SELECT {normalized()} FROM ab))"""


def _labelled(name: str, a: str, b: str) -> str:
    cols = ", ".join(f"{s}.{f} AS {s}_{f}" for s in "ab" for f in FIELDS)
    return (f"{name} AS MATERIALIZED (SELECT CAST(a_id AS VARCHAR) || '-' || CAST(b_id AS VARCHAR) AS rid, a_id, b_id, {cols}, match "
            f"FROM vt JOIN {a} a ON a.rid = a_id JOIN {b} b ON b.rid = b_id)")


LABELLED = PREPARED + ",\n" + _labelled("lp", "pa", "pb")
LABELLED_RAW = ALIGNED + f""",
na AS (SELECT {normalized()} FROM aa), nb AS (SELECT {normalized()} FROM ab),
{_labelled('lp', 'na', 'nb')}"""

KEYS = ", ".join(PAIR_KEY)
B1_COLUMNS = ", ".join(["a.manufacturer", "a.year"] + [
    f"{s}.{c} AS {c}_{s}" for s in "ab" for c in ("rid", *LISTING_COLUMNS) if c not in ("manufacturer", "year")])
B1_JOIN = "pa a JOIN pb b ON a.manufacturer IS NOT DISTINCT FROM b.manufacturer AND a.year IS NOT DISTINCT FROM b.year"


# --- scores ---------------------------------------------------------------

TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]{{2,}}')"
C2 = "(1.4054651081081644::DOUBLE * 1.4054651081081644::DOUBLE)"


def fitted(d, sa, ta, sb, tb):
    return (f"CASE WHEN {d} > 0 THEN {d} / (sqrt({sa} + {C2} * ({ta} - {sa})) * sqrt({sb} + {C2} * ({tb} - {sb}))) "
            f"ELSE 0e0 END")


def pair_cosine(a: str, b: str) -> str:
    """Cosine of two short texts, as one expression."""
    ta, tb = (f"coalesce({TOKENS.format(x)}, []::VARCHAR[])" for x in (a, b))
    n = lambda t: f"len(list_filter({t}, lambda x: x = w))"
    both = f"list_intersect({ta}, {tb})"
    total = lambda lst, e: f"coalesce(list_sum(list_transform({lst}, lambda w: {e})), 0)::DOUBLE"
    return fitted(total(both, f"{n(ta)} * {n(tb)}"), total(both, f"{n(ta)} * {n(ta)}"), total(ta, n(ta)),
                  total(both, f"{n(tb)} * {n(tb)}"), total(tb, n(tb)))


def _missing(a, b): return f"coalesce({a}, '') = '' OR coalesce({b}, '') = ''"


def _pairs(a, b, pairs):
    return " OR ".join(f"({a} = '{x}' AND {b} = '{y}') OR ({a} = '{y}' AND {b} = '{x}')" for x, y in pairs)


def category_score(a, b, top, near=(), vague=None):
    x, y = f"lower({a})", f"lower({b})"
    parts = [f"CASE WHEN {_missing(a, b)} THEN 0e0 WHEN {x} = {y} THEN {top}e0"]
    if near:
        parts.append(f"WHEN {_pairs(x, y, near)} THEN {top}e0 * 0.8e0")
    if vague:
        parts.append(f"WHEN {vague.format(x=x, y=y)} THEN {top}e0 * 0.3e0")
    return " ".join(parts) + " ELSE 0e0 END"


OTHER = "({x} = 'other' OR {y} = 'other')"
PLAIN_OTHER = OTHER + " AND {x} NOT IN ('truck', 'offroad') AND {y} NOT IN ('truck', 'offroad')"
FUELS = (("flex fuel vehicle", "gasoline"), ("biodiesel", "diesel"))
BODIES = (("truck", "pickup"), ("offroad", "suv"), ("offroad", "pickup"))
DRIVES = (("4wd", "awd"), ("fwd", "4x2"), ("rwd", "4x2"))


def model_score(a, b): return f"({pair_cosine(a, b)}) * 0.5e0"
def fuel_score(a, b): return category_score(a, b, "0.05", FUELS, OTHER)
def body_score(a, b): return category_score(a, b, "0.05", BODIES, PLAIN_OTHER)
def cylinders_score(a, b): return category_score(a, b, "0.03", (), OTHER)
def drive_score(a, b): return category_score(a, b, "0.02", DRIVES)
def color_score(a, b): return category_score(a, b, "0.02")


def exact_score(a, b, top):
    return f"CASE WHEN {_missing(a, b)} THEN 0e0 WHEN {a} = {b} THEN {top}e0 ELSE 0e0 END"


def mileage_score(a, b):
    d = f"abs({whole(a)} - {whole(b)})"
    return f"CASE WHEN {d} <= 50000 THEN 0.1e0 * (1 - {d} / 50000e0) ELSE 0e0 END"


TERMS = [model_score("a_model", "b_model"), exact_score("a_manufacturer", "b_manufacturer", "0.2"),
         exact_score("a_year", "b_year", "0.1"), mileage_score("a_mileage", "b_mileage"),
         fuel_score("a_fuel_type", "b_fuel_type"), exact_score("a_transmission", "b_transmission", "0.05"),
         body_score("a_body_type", "b_body_type"), cylinders_score("a_cylinders", "b_cylinders"),
         drive_score("a_drive", "b_drive"), color_score("a_color", "b_color")]
PAIR_SCORE = " + ".join(f"({t})" for t in TERMS)

# Test pairs with the number of block pairs that have their key.
LINKAGE = LABELLED + f""",
tk AS MATERIALIZED (SELECT {', '.join(f"coalesce({k}, '') AS {k}" for k in PAIR_KEY)}, arg_max(match, rid) AS match FROM lp GROUP BY ALL),
b1 AS (SELECT {B1_COLUMNS} FROM {B1_JOIN}),
bk AS (SELECT {', '.join(f"coalesce({f if f in ('manufacturer', 'year') else f'{f}_{s}'}, '') AS {s}_{f}" for s in 'ab' for f in FIELDS)} FROM b1),
seen AS (SELECT {KEYS}, count(*) AS candidate_rows FROM bk SEMI JOIN tk USING ({KEYS}) GROUP BY ALL),
lt AS MATERIALIZED (SELECT *, CASE WHEN score >= 0.7e0 THEN 1 ELSE 0 END AS predicted FROM (
  SELECT {KEYS}, match, coalesce(candidate_rows, 0) AS candidate_rows,
  CASE WHEN candidate_rows > 0 THEN {PAIR_SCORE} END AS score FROM tk LEFT JOIN seen USING ({KEYS})))"""


def prf(source: str, weight: str = "1", predicted: str = "predicted", actual: str = "match") -> str:
    """Select of tp, fp, fn and the rounded metrics of a 0/1 table."""
    def s(c): return f"CAST(coalesce(sum(CASE WHEN {c} THEN {weight} END), 0) AS BIGINT)"
    return f"""SELECT tp, fp, fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0e0 END, 6) AS "precision",
 round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0e0 END, 6) AS recall,
 round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0e0 END, 6) AS f1
 FROM (SELECT {s(f'{predicted} = 1 AND {actual} = 1')} AS tp, {s(f'{predicted} = 1 AND {actual} = 0')} AS fp,
 {s(f'{predicted} = 0 AND {actual} = 1')} AS fn FROM {source})"""


def record_text(s: str) -> str:
    part = lambda f: f"'COL {f} VAL ' || translate({strip(f"coalesce({s}_{f}, '')")}, chr(9) || chr(10), '  ')"
    return " || ' ' || ".join(part(f) for f in FIELDS)


PAIR_TEXT = f"{record_text('a')} || chr(9) || {record_text('b')} || chr(9) || {strip("coalesce(CAST(match AS VARCHAR), '')")}"


def length_prefixed_md5(*cols: str) -> str:
    parts = " || ".join(f"coalesce(CAST(length({c}) AS VARCHAR) || ':' || {c}, '-')" for c in cols)
    return f"md5({parts})"


# --- texts ----------------------------------------------------------------

def texts(stop_words: list[str]) -> str:
    """CTEs: firsts of equal texts (tx), of equal bags (dd), copies, term rows (tb)."""
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in stop_words)
    return f"""
tx AS MATERIALIZED (SELECT min(doc_id) AS id, lang, source, text, count(*) AS n FROM documents GROUP BY lang, source, text),
tw AS (SELECT *, list_filter({TOKENS.format('text')}, lambda w: NOT list_contains([{stop}], w)) AS u FROM tx),
tt AS MATERIALIZED (SELECT id, lang, source, n, text, list_concat(u, list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1])) AS t FROM tw),
tg AS MATERIALIZED (SELECT id, lang, source, n, t, CASE WHEN len(t) > 0 THEN md5(array_to_string(list_sort(t), chr(10))) ELSE 't' || md5(text) END AS g FROM tt),
gm AS MATERIALIZED (SELECT lang, source, g, min(id) AS first, sum(n) AS copies FROM tg GROUP BY ALL),
dd AS MATERIALIZED (SELECT id, tg.lang, tg.source, t, copies FROM tg JOIN gm ON id = first),
cp AS MATERIALIZED (SELECT first AS i, d.doc_id AS j, len(tg.t) AS n_words FROM documents d JOIN tx USING (lang, source, text) JOIN tg ON tg.id = tx.id
  JOIN gm ON gm.lang = tg.lang AND gm.source = tg.source AND gm.g = tg.g WHERE first <> d.doc_id),
tb AS MATERIALIZED (SELECT id, lang, source, copies, term, count(*) AS tf FROM (SELECT id, lang, source, copies, unnest(t) AS term FROM dd) GROUP BY ALL)"""


def similar(cap: int = 5000, threshold: float = 0.7) -> str:
    """CTE se: pairs of firsts at or above the threshold, fitted per pair."""
    return f"""
ts AS MATERIALIZED (SELECT id, count(*) AS n, sum(tf * tf)::DOUBLE AS t FROM tb GROUP BY id),
sp AS MATERIALIZED (SELECT a.id AS i, b.id AS j, sum(a.tf * b.tf)::DOUBLE AS d, sum(a.tf * a.tf)::DOUBLE AS sa, sum(b.tf * b.tf)::DOUBLE AS sb, count(*) AS m
  FROM tb a JOIN tb b ON a.lang = b.lang AND a.source = b.source AND a.term = b.term AND a.id < b.id GROUP BY ALL),
st AS MATERIALIZED (SELECT sp.*, a.t AS ta, b.t AS tb, a.n + b.n - m AS vocabulary FROM sp JOIN ts a ON a.id = i JOIN ts b ON b.id = j),
ct AS (SELECT i, j, term, sum(x) AS x, sum(y) AS y FROM (
  SELECT i, j, term, tf AS x, 0 AS y FROM st JOIN tb ON tb.id = i WHERE vocabulary > {cap}
  UNION ALL SELECT i, j, term, 0, tf FROM st JOIN tb ON tb.id = j WHERE vocabulary > {cap}) GROUP BY ALL),
ck AS (SELECT * FROM ct QUALIFY row_number() OVER (PARTITION BY i, j ORDER BY x + y DESC, term) <= {cap}),
cs AS (SELECT i, j, sum(x * y)::DOUBLE AS d, sum(CASE WHEN y > 0 THEN x * x ELSE 0 END)::DOUBLE AS sa, sum(x * x)::DOUBLE AS ta,
  sum(CASE WHEN x > 0 THEN y * y ELSE 0 END)::DOUBLE AS sb, sum(y * y)::DOUBLE AS tb FROM ck GROUP BY i, j),
se AS MATERIALIZED (SELECT * FROM (
  SELECT i, j, {fitted('d', 'sa', 'ta', 'sb', 'tb')} AS sim FROM st WHERE vocabulary <= {cap}
  UNION ALL SELECT i, j, {fitted('d', 'sa', 'ta', 'sb', 'tb')} FROM cs) WHERE sim >= {threshold}e0)"""


# Greedy selection in row order over the documents that have an edge.
LEADERS = """
ln AS MATERIALIZED (SELECT v, row_number() OVER (ORDER BY v) AS pos, (SELECT coalesce(list(i), []) FROM se WHERE j = v) AS earlier
  FROM (SELECT i AS v FROM se UNION SELECT j FROM se)),
gr(pos, masters) AS (SELECT CAST(0 AS BIGINT), []::BIGINT[] UNION ALL
  SELECT ln.pos, CASE WHEN list_has_any(masters, earlier) THEN masters ELSE list_append(masters, v) END FROM gr JOIN ln ON ln.pos = gr.pos + 1),
ms AS MATERIALIZED (SELECT unnest(arg_max(masters, pos)) AS id FROM gr),
ds AS MATERIALIZED (SELECT j AS id, min(i) AS master FROM se WHERE i IN (SELECT id FROM ms) AND j NOT IN (SELECT id FROM ms) GROUP BY j),
dropped AS MATERIALIZED (SELECT j AS id FROM cp UNION SELECT id FROM ds),
involved AS MATERIALIZED (SELECT id FROM dropped UNION SELECT master FROM ds UNION SELECT i FROM cp WHERE i NOT IN (SELECT id FROM ds))"""


# --- labels ---------------------------------------------------------------

def pool(name: str, source: str) -> str:
    """CTE: rows of a source with a dense index in which a VIN is an interval."""
    return f"""
{name}_i AS MATERIALIZED (SELECT vin, rid, row_number() OVER (ORDER BY substr(md5(coalesce(vin, '')), 1, 4), vin NULLS FIRST, rid) - 1 AS idx FROM {source}),
{name}_s AS MATERIALIZED (SELECT vin, min(idx) AS lo, count(*) AS cnt FROM {name}_i GROUP BY vin),
{name}_n AS (SELECT count(*) AS n FROM {name}_i)"""


def negatives(name: str, anchors: str, slots: int, tag: str) -> str:
    draw = f"('0x' || substr(md5('42|' || anchor || '|{tag}' || slot), 1, 15))::BIGINT"
    return f"""SELECT anchor, slot, rid FROM (
  SELECT anchor, slot, CASE WHEN r < lo THEN r ELSE r + cnt END AS idx FROM (
    SELECT anchor, slot, lo, cnt, {draw} % (n - cnt) AS r FROM (
      SELECT anchor, coalesce(lo, 0) AS lo, coalesce(cnt, 0) AS cnt FROM {anchors} x LEFT JOIN {name}_s s ON x.vin IS NOT DISTINCT FROM s.vin),
      range(1, {slots + 1}) g(slot), {name}_n WHERE slot <= n - cnt)) JOIN {name}_i USING (idx)"""


# --- block predicates -----------------------------------------------------

def _listed(condition: str, keys: str) -> str:
    return f"CASE WHEN {condition} THEN {keys} ELSE []::VARCHAR[] END"


def _value(f): return f"lower({strip(f)})"
def whole_keys(f): return _listed(f"{_value(f)} <> ''", f"[{_value(f)}]")
def start_keys(f, n=3): return _listed(f"{_value(f)} <> ''", f"[left({_value(f)}, {n})]")
def word_keys(f): return f"list_distinct(coalesce({TOKENS.format(f)}, []::VARCHAR[]))"
def first_word_keys(f): return f"coalesce({TOKENS.format(f)}, []::VARCHAR[])[1:1]"
def magnitude_keys(f): return _listed(f"{number(f)} >= 1", f"[CAST(CAST(floor(log10({number(f)})) AS BIGINT) AS VARCHAR)]")


def near_keys(f, width):
    low, high = (f"CAST(CAST(floor({number(f)} / {width}e0 {more}) AS BIGINT) AS VARCHAR)" for more in ("", "+ 0.5e0"))
    return _listed(f"{number(f)} IS NOT NULL", f"['a' || {low}, 'b' || {high}]")


# In the library's order: name, keys, whether they are many.
PREDICATES = (
    ("whole(manufacturer)", whole_keys("manufacturer"), False), ("start3(manufacturer)", start_keys("manufacturer"), False), ("whole(model)", whole_keys("model"), False),
    ("first_word(model)", first_word_keys("model"), False), ("words(model)", word_keys("model"), True), ("whole(year)", whole_keys("year"), False),
    ("near4(year)", near_keys("year", 4), True), ("near20000(mileage)", near_keys("mileage", 20000), True), ("magnitude(mileage)", magnitude_keys("mileage"), False),
    *[(f"whole({f})", whole_keys(f), False) for f in ("fuel_type", "transmission", "body_type", "cylinders", "drive", "color")])

# Keys of both tables' records (kt), rules (rl), their keys (rk), and which labelled matches each covers (mc).
PREDICATE_KEYS = LABELLED + """,
kt AS MATERIALIZED (""" + " UNION ALL ".join(f"SELECT '{s}' AS side, rid, {i} AS p, unnest({keys}) AS key FROM p{s}" for s in "ab" for i, (_, keys, _) in enumerate(PREDICATES)) + """),
pn AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, '{name}', {many})" for i, (name, _, many) in enumerate(PREDICATES)) + """) v(p, name, many)),
rl AS MATERIALIZED (SELECT p, CAST(NULL AS INT) AS q, name FROM pn UNION ALL SELECT x.p, y.p, x.name || ' & ' || y.name FROM pn x JOIN pn y ON x.p < y.p AND NOT (x.many AND y.many)),
rk AS (SELECT name, side, rid, key FROM kt JOIN rl USING (p) WHERE q IS NULL
  UNION ALL SELECT name, x.side, x.rid, length(x.key) || ':' || x.key || y.key FROM rl JOIN kt x ON x.p = rl.p JOIN kt y ON y.p = rl.q AND y.side = x.side AND y.rid = x.rid),
rc AS MATERIALIZED (SELECT name, CAST(sum(n_a * n_b) AS BIGINT) AS pairs, count(*) AS blocks FROM (
  SELECT name, key, count(*) FILTER (side = 'a') AS n_a, count(*) FILTER (side = 'b') AS n_b FROM rk GROUP BY ALL) WHERE n_a > 0 AND n_b > 0 GROUP BY name),
ms AS (SELECT a_id, b_id FROM lp WHERE match = 1),
mp AS MATERIALIZED (SELECT DISTINCT a_id, b_id, x.p FROM ms JOIN kt x ON x.side = 'a' AND x.rid = a_id JOIN kt y ON y.side = 'b' AND y.rid = b_id AND y.p = x.p AND y.key = x.key),
mc AS MATERIALIZED (SELECT a_id, b_id, name FROM mp JOIN rl USING (p) WHERE q IS NULL
  UNION ALL SELECT x.a_id, x.b_id, name FROM rl JOIN mp x ON x.p = rl.p JOIN mp y ON y.p = rl.q AND y.a_id = x.a_id AND y.b_id = x.b_id)"""

# The greedy cover, a rule a step: the one that adds most for a pair among the matches that no chosen rule covers.
COVER = PREDICATE_KEYS + """,
cv AS MATERIALIZED (SELECT rules, count(*) AS n FROM (SELECT list_sort(list(name)) AS rules FROM mc GROUP BY a_id, b_id) GROUP BY rules),
ro AS MATERIALIZED (SELECT name, row_number() OVER (ORDER BY q IS NOT NULL, p, q) AS place, coalesce(pairs, 0) AS pairs FROM rl LEFT JOIN rc USING (name)),
tt AS (SELECT (SELECT count(*) FROM ms) AS total, (SELECT sum(n) FROM cv) AS coverable),
gr(step, chosen, added, pairs, covered) AS (SELECT 0, []::VARCHAR[], 0::HUGEINT, 0::BIGINT, 0::HUGEINT
  UNION ALL SELECT step + 1, list_append(chosen, name), gain, b.pairs, covered + gain FROM gr, tt, LATERAL (
    SELECT g.name, gain, ro.pairs FROM (SELECT name, sum(n) AS gain FROM (SELECT unnest(rules) AS name, n FROM cv WHERE NOT list_has_any(rules, chosen)) GROUP BY name) g JOIN ro USING (name)
    ORDER BY gain / (1 + ro.pairs)::DOUBLE DESC, gain DESC, place LIMIT 1) b WHERE covered < 0.99e0 * coverable AND step < 20)"""


# --- learned linkage ------------------------------------------------------

def affine(source: str) -> str:
    """CTE af (a, b, d): affine-gap distance of distinct pairs of different texts; a step of the recursion is a letter of the shorter one."""
    cost = lambda j: f"(7 * least({j}, m) + 0.875e0 * greatest({j} - m, 0))"
    return f"""
vp AS MATERIALIZED (SELECT DISTINCT a, b, CASE WHEN length(a) < length(b) THEN b ELSE a END AS l, CASE WHEN length(a) < length(b) THEN a ELSE b END AS s
  FROM ({source}) WHERE a <> b),
ag AS (SELECT a, b, l, s, length(l) AS n, length(s) AS m, 0 AS i, list_transform(range(0, length(l) + 1), lambda j: CASE WHEN j = 0 THEN 0e0 ELSE 10e0 + 7 * j END) AS best,
  list_transform(range(0, length(l) + 1), lambda j: 1e15::DOUBLE) AS down FROM vp
 UNION ALL SELECT a, b, l, s, n, m, i, list_transform(range(0, n + 1), lambda j: least(t[j + 1],
   coalesce(list_min(list_transform(range(0, j), lambda k: t[k + 1] + CASE WHEN k + 1 <= m THEN 10e0 ELSE 1.25e0 END + {cost('j')} - {cost('k')})), 1e15::DOUBLE))), down
 FROM (SELECT a, b, l, s, n, m, i, down, list_transform(range(0, n + 1), lambda j: CASE WHEN j = 0 THEN 10e0 + 7 * i
     ELSE least(down[j + 1], best[j] + CASE WHEN substr(l, j, 1) = substr(s, i, 1) THEN 1 ELSE 11 END) END) AS t
  FROM (SELECT a, b, l, s, n, m, CAST(i + 1 AS INT) AS i, best, list_transform(range(0, n + 1), lambda j: least(down[j + 1], best[j + 1] + 10) + 7) AS down FROM ag WHERE i < m))),
af AS MATERIALIZED (SELECT a, b, best[-1] / (n + m)::DOUBLE AS d FROM ag WHERE i = m)"""


def string_distance(f: str) -> str:
    return (f"CASE WHEN a_{f} = b_{f} THEN CASE WHEN a_{f} <> '' THEN 0.5e0 END "
            f"ELSE (SELECT d FROM af WHERE af.a = a_{f} AND af.b = b_{f}) END")


def string_pairs(source: str, *fields: str) -> str:
    return " UNION ".join(f"SELECT a_{f} AS a, b_{f} AS b FROM {source}" for f in fields)


def greedy(source: str, tag: str = "") -> str:
    """CTE go (a_id, b_id, score): greedy one-to-one assignment of source (a_id, b_id, score); a step takes all pairs best for both ids.

    ``tag`` is added to the names of the CTEs.
    """
    return f"""
rp{tag} AS (SELECT a_id, b_id, max(score) AS score FROM {source} GROUP BY a_id, b_id),
rd{tag} AS (SELECT a_id, b_id, score, row_number() OVER (ORDER BY score DESC, md5(a_id || '|' || b_id), a_id, b_id) AS rk FROM rp{tag}),
gs{tag} AS (SELECT a_id, b_id, score, rk, false AS taken FROM rd{tag}
  UNION ALL SELECT a_id, b_id, score, rk, mutual FROM (SELECT *, bool_or(mutual) OVER (PARTITION BY a_id) AS of_a, bool_or(mutual) OVER (PARTITION BY b_id) AS of_b FROM (
    SELECT *, rk = min(rk) OVER (PARTITION BY a_id) AND rk = min(rk) OVER (PARTITION BY b_id) AS mutual FROM gs{tag} WHERE NOT taken)) WHERE mutual OR NOT (of_a OR of_b)),
go{tag} AS MATERIALIZED (SELECT a_id, b_id, score FROM gs{tag} WHERE taken)"""
