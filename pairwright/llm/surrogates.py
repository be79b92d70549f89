"""PII: detected entities are replaced by keyed surrogates of the same type and format. Column expressions only.

* **Keyed**: every character is drawn from SHA-256 of key, type, entity and attempt.
* **Type-consistent**: an e-mail address becomes one of a reserved domain, a
  card number keeps its length, its first digit and a valid check digit, an IBAN its
  country and valid check digits, an
  IPv4 address stays in private and reserved ranges (285 million addresses), a telephone
  number keeps its country and area form, a key its prefix and alphabet, a
  person's name its title, gender, script and number of words.
* **Coreference**: an entity has one surrogate everywhere, whatever its letter case or spacing.
  A person is known by the words of the name, whatever the title; the gender is
  that of the titles of all mentions. Where these are of both genders, there are two persons of the name, and a third one
  for mentions whose title has no gender.
* **Distinctness**: surrogates are checked against each other and against all
  entities of the corpus; those that collide are drawn again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.llm.common import materialize

# Fixed value: what stands before a secret; it belongs to the match, and stays as it is.
ASSIGNED = r"(?i:password|passwd|pwd|secret|token|api_key|apikey|api-key) {0,3}[=:] {0,3}[\"']?"
TITLE = r"Mrs?|Ms|Miss|Mme|Mlle|M\.|Herr|Frau|Sra?|Señora?|Doña|Don|Dr|Prof"
# What each type looks like, in the order in which they are tried.
PATTERNS = (
    # Possessive: a repeated group that may give back is a recursion for each of its turns.
    ("email", r"(?<![\p{L}\p{N}._%+'-])[\p{L}\p{N}._%+'-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++"),
    ("secret", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[0-9A-Za-z]{36,}\b|\bsk-[0-9A-Za-z]{20,}\b|\bxox[abprs]-[0-9A-Za-z-]{10,}\b"
               rf"|(?<!\p{{L}}){ASSIGNED}[^\s\"',;]{{6,}}"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?\b"),
    ("ip", r"(?<![\d.])(?<!(?i:version|release|ver|v)\.? ?)(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]*\d)"),
    ("card", r"(?<![\d-])[3-6]\d{12,18}(?![\d-])|(?<![\d-])[3-6]\d{3}(?:-\d{4}){2}-\d{1,7}(?![\d-])|(?<!\d)[3-6]\d{3}(?: \d{4}){2} \d{1,7}(?!\d)"
             r"|(?<!\d)3\d{3}[ -]\d{6}[ -]\d{5}(?!\d)"),
    ("phone", r"(?<![\p{N}\p{L}+.-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\d{2,4}[ .-]\d{2,4}[ .-]\d{3,4}(?:[ .-]\d{2,4})?)(?![\p{N}.-]*\p{N})"
              r"|\+\d{8,15}(?!\d)"
              # +CC and groups of any length, eight digits at least; France; Spain; Germany; ten digits in a row that do not start with 0 or 1.
              r"|(?<![\p{N}\p{L}+.-])(?:\+(?=\d(?:[ .()/-]{0,2}\d){7})\d{1,3}+(?:[ .-]?\(\d{1,4}\))?(?:[ ./-]?\d{1,8}+){1,6}|0[1-9](?: \d\d){4}|0[1-9](?:\.\d\d){4}|0[1-9](?:-\d\d){4}|0[1-9]\d{8}"
              r"|[6-9]\d\d(?: \d\d){3}|0[1-9]\d{1,3}[ /-]\d{5,8}|[2-9]\d{9})(?![\p{N}\p{L}]|[.-]\p{N})"),
    ("person", rf"\b(?:{TITLE})\.?[ ]\p{{Lu}}[\p{{L}}'-]+(?:[ ]\p{{Lu}}[\p{{L}}'-]+){{0,2}}|(?:госпожа|господин)[ ]\p{{Lu}}[\p{{L}}-]+"),
)
FEMALE_TITLES = r"(?i)^(?:Mrs|Ms|Miss|Mme|Mlle|Frau|Sra|Señora|Doña|госпожа)\b"
MALE_TITLES = r"(?i)^(?:Mr|M\.|Herr|Sr|Señor|Don|господин)\b"
ENDINGS = {"female": ("ia", "ina", "elle", "ara"), "male": ("o", "er", "ian", "ard"), "neutral": ("is", "e", "en", "y")}
CYRILLIC_ENDINGS = {"female": ("ова", "ина"), "male": ("ов", "ин"), "neutral": ("ко", "ич")}
SYLLABLES = ("ba", "co", "da", "fe", "ga", "hi", "jo", "ka", "lu", "ma", "ne", "po", "ra", "si", "to", "ve")
CYRILLIC_SYLLABLES = ("ба", "во", "гу", "де", "за", "ки", "ло", "му", "не", "по", "ра", "си", "то", "фе", "ха", "шу")
# Networks whose addresses name nobody (private use, benchmarking), and those that are tried when these collide often (reserved).
NETWORKS = ("10.%.%.%", "198.18.%.%", "198.19.%.%")
RESERVED = tuple(f"{n}.%.%.%" for n in range(240, 256))
# A surrogate is drawn again at most so often; the space of each type is far larger than what a corpus uses of it.
MAX_ATTEMPTS, RESERVED_FROM = 20, 4

# One pattern with a group for each type: the group that matched names it.
ANY = "|".join(f"({p})" for _, p in PATTERNS)
TYPES = [t for t, _ in PATTERNS]
# A text without any of these signs holds no entity; most texts are spared the full pattern.
TITLES = rf"\b(?:{TITLE})\.?[ ]\p{{Lu}}|госпо"
# A day, month and year with the same sign between them, and a year first: no telephone number.
DATE = r"^(?:[0-3]\d([ .-])[0-3]\d\1(?:19|20)\d\d|(?:19|20)\d\d([ .-])[0-3]\d\2[0-3]\d\d?)$"
HINT = rf"[0-9@]|AKIA|ASIA|gh[pousr]_|sk-|xox|{TITLES}|{ASSIGNED}"


def entity_type(entity: Column) -> Column:
    """Type of a matched entity, by the first pattern that takes the whole of it; a secret is known by what is left."""
    kind = F.lit("secret")
    for name, pattern in reversed(PATTERNS):
        if name != "secret":
            kind = F.when(entity.rlike(rf"^(?:{pattern})$"), name).otherwise(kind)
    return F.when(entity.rlike(r"^(?:AKIA|ASIA)[0-9A-Z]{16}$"), "secret").otherwise(kind)


def name_words(mention: Column) -> Column:
    """A person's name without the title, in small letters, with single spaces."""
    bare = F.regexp_replace(mention, rf"^(?:(?:{TITLE})\.?|госпожа|господин)[ ]+", "")
    return F.lower(F.regexp_replace(bare, r"\s+", " "))


def title_gender(mention: Column) -> Column:
    """f, m, or null for a title of either."""
    return F.when(mention.rlike(FEMALE_TITLES), "f").when(mention.rlike(MALE_TITLES), "m")


def normal_form(kind: Column, entity: Column) -> Column:
    """What mentions of one entity have in common: digits of numbers, lower case of addresses and of names without titles."""
    digits = F.regexp_replace(entity, r"[^0-9+]", "")
    return (F.when(kind == "secret", F.regexp_replace(entity, f"^{ASSIGNED}", "")).when(kind.isin("card", "ssn", "phone"), digits).when(kind == "iban", F.upper(F.regexp_replace(entity, " ", "")))
            .when(kind == "email", F.lower(entity)).when(kind == "person", name_words(entity)).otherwise(entity))


def _draw(seed: Column, k: Column, n: Column | int) -> Column:
    """Number k of a keyed stream, below n. Seven hex digits of a digest for each number."""
    digest = F.sha2(F.concat(seed, F.lit("#"), F.floor(k / 8).cast("string")), 256)
    return F.pmod(F.conv(F.substr(digest, (k % 8) * 7 + 1, F.lit(7)), 16, 10).cast("long"), n if isinstance(n, Column) else F.lit(n)).cast("int")


def _pick(options: tuple[str, ...], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), at + 1)


def _redrawn(text: Column, seed: Column) -> Column:
    """Every digit becomes a digit, every letter one of its case and script; all else stays."""
    def change(ch, k):
        up, low = F.lit("ABCDEFGHJKLMNPQRSTUVWXYZ"), F.lit("abcdefghijkmnopqrstuvwxyz")
        cyr = F.lit("абвгдезиклмнопрстуфхш")
        one = lambda letters, n: F.substr(letters, _draw(seed, k, n) + 1, F.lit(1))
        return (F.when(ch.rlike("[0-9]"), _draw(seed, k, 10).cast("string")).when(ch.rlike("[A-Z]"), one(up, 24)).when(ch.rlike("[a-z]"), one(low, 25))
                .when(ch.rlike(r"\p{IsCyrillic}"), F.when(ch.rlike(r"\p{Lu}"), F.upper(one(cyr, 21))).otherwise(one(cyr, 21)))
                .when(ch.rlike(r"\p{Lu}"), one(up, 24)).when(ch.rlike(r"\p{L}"), one(low, 25)).otherwise(ch))
    return F.array_join(F.transform(F.split(text, ""), change), "")


def _hex_redrawn(text: Column, seed: Column) -> Column:
    return F.array_join(F.transform(F.split(text, ""), lambda ch, k: F.when(ch.rlike("[0-9a-f]"), F.substr(F.lit("0123456789abcdef"), _draw(seed, k, 16) + 1, F.lit(1))).otherwise(ch)), "")


def _luhn(body: Column) -> Column:
    """Check digit of the digits before it."""
    values = F.transform(F.reverse(F.filter(F.split(body, ""), lambda x: x != "")), lambda x, k: F.when(k % 2 == 0, F.lit(2)).otherwise(F.lit(1)) * x.cast("int"))
    total = F.aggregate(values, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x))
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def _body(digits: Column) -> Column:
    return F.substr(digits, F.lit(1), F.length(digits) - 1)


def _mod97(text: Column) -> Column:
    """The remainder of digits and capital letters (A is 10, Z is 35) read as one number."""
    signs = F.filter(F.split(text, ""), lambda ch: ch != "")
    value = lambda ch: F.ascii(ch) - F.when(ch.rlike("[0-9]"), 48).otherwise(55)
    return F.aggregate(signs, F.lit(0), lambda r, ch: ((r * F.when(ch.rlike("[0-9]"), 10).otherwise(100) + value(ch)) % 97).cast("int"))


def _iban(entity: Column, seed: Column) -> Column:
    """Country kept, the rest drawn anew, check digits such that the whole, turned round, leaves 1."""
    bare = F.regexp_replace(entity, " ", "")
    country, body = F.substr(bare, F.lit(1), F.lit(2)), _redrawn(F.substr(bare, F.lit(5)), seed)
    check = F.lpad((F.lit(98) - _mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
    return F.concat(country, check, body)


def is_entity(kind: Column, form: Column, mention: Column) -> Column:
    """Numbers that look like cards are cards only if their check digit is right; dates are no telephone numbers."""
    return F.when(kind == "card", F.substr(form, F.length(form), F.lit(1)) == _luhn(_body(form))).when(kind == "phone", ~mention.rlike(DATE)).otherwise(True)


def _word(seed: Column, offset: int, syllables: tuple[str, ...], endings: tuple[str, ...] = ("",)) -> Column:
    parts = [_pick(syllables, _draw(seed, F.lit(offset + i), 16)) for i in range(3)]
    return F.initcap(F.concat(*parts, _pick(endings, _draw(seed, F.lit(offset + 3), len(endings)))))


def _person(form: Column, seed: Column) -> Column:
    """Given and family names for ``form`` (name words, a bar, the gender), with endings of the gender, in the name's script."""
    names = F.size(F.split(F.substring_index(form, "|", 1), " "))

    def named(gender: str) -> Column:
        latin = [_word(seed, 0, SYLLABLES, ENDINGS[gender]), _word(seed, 8, SYLLABLES), _word(seed, 16, SYLLABLES)]
        cyrillic = [_word(seed, 0, CYRILLIC_SYLLABLES, CYRILLIC_ENDINGS[gender])] * 3
        choose = lambda own: F.array_join(F.slice(F.array(*own), 1, F.greatest(names, F.lit(1))), " ")
        return F.when(form.rlike(r"\p{IsCyrillic}"), choose(cyrillic)).otherwise(choose(latin))
    return F.when(form.endswith("|f"), named("female")).when(form.endswith("|m"), named("male")).otherwise(named("neutral"))


def surrogate(kind: Column, form: Column, entity: Column, seed: Column, networks: tuple[str, ...] = NETWORKS) -> Column:
    """A surrogate in the normal form of its entity (``entity`` is one mention of it); of a person the names only."""
    mail = F.concat(F.lower(_word(seed, 0, SYLLABLES)), F.lit("."), F.lower(_word(seed, 8, SYLLABLES)), _draw(seed, F.lit(20), 10_000).cast("string"), F.lit("@example.org"))
    network = _pick(networks, _draw(seed, F.lit(0), len(networks)))
    ip = network
    for k in range(1, 4):
        ip = F.regexp_replace(ip, r"^([^%]*)%", F.concat(F.lit("$1"), (_draw(seed, F.lit(k), 254) + 1).cast("string")))
    digits = F.regexp_replace(entity, r"[^0-9]", "")
    card = _body(F.concat(F.substr(digits, F.lit(1), F.lit(1)), _redrawn(F.substr(digits, F.lit(2)), seed)))
    card = F.concat(card, _luhn(card))
    bare = F.regexp_replace(entity, f"^{ASSIGNED}", "")
    kept = F.regexp_extract(bare, r"^(AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-)", 1)
    rest = F.substr(bare, F.length(kept) + 1)
    secret = F.concat(kept, F.when(rest.rlike("^[0-9a-f]+$"), _hex_redrawn(rest, seed)).otherwise(_redrawn(rest, seed)))
    country = F.regexp_extract(entity, r"^(\+\d{1,3}?(?=[ .(-])|\+\d|0[1-9]|[2-9](?=\d{9}$)|[6-9](?=\d\d(?: \d\d){3}$))", 1)
    phone = F.concat(country, _redrawn(F.regexp_replace(F.substr(entity, F.length(country) + 1), r"[^0-9]", ""), seed))
    return (F.when(kind == "email", mail).when(kind == "ip", ip).when(kind == "card", card).when(kind == "secret", secret).when(kind == "phone", phone)
            .when(kind == "iban", _iban(entity, seed)).when(kind == "person", _person(form, seed)).otherwise(_redrawn(digits, seed)))


def in_format_of(kind: Column, mention: Column, made: Column) -> Column:
    """The surrogate as this mention writes it: the same separators, the same letter case of a name's title."""
    plain = F.regexp_replace(made, r"[^0-9+]", "")
    laid = F.aggregate(
        F.split(mention, ""), F.struct(F.lit("").alias("s"), F.lit(1).alias("i")),
        lambda st, ch: F.when(ch.rlike("[0-9+]"), F.struct(F.concat(st["s"], F.substr(plain, st["i"], F.lit(1))).alias("s"), (st["i"] + 1).alias("i")))
        .otherwise(F.struct(F.concat(st["s"], ch).alias("s"), st["i"].alias("i"))), lambda st: st["s"])
    grouped = F.aggregate(
        F.split(mention, ""), F.struct(F.lit("").alias("s"), F.lit(1).alias("i")),
        lambda st, ch: F.when(ch == " ", F.struct(F.concat(st["s"], ch).alias("s"), st["i"].alias("i")))
        .otherwise(F.struct(F.concat(st["s"], F.substr(made, st["i"], F.lit(1))).alias("s"), (st["i"] + 1).alias("i"))), lambda st: st["s"])
    title, names = F.regexp_extract(mention, r"^(\S+ +)", 1), F.regexp_extract(mention, r"^\S+ +(.*)$", 1)
    titled = F.concat(title, F.when((names == F.upper(names)) & (F.length(names) > 1), F.upper(made)).otherwise(made))
    assigned = F.concat(F.regexp_extract(mention, f"^{ASSIGNED}", 0), made)
    return F.when(kind == "secret", assigned).when(kind.isin("card", "ssn", "phone"), laid).when(kind == "iban", grouped).when(kind == "person", titled).otherwise(made)


def _drawn(entities: DataFrame, key: str, attempt: int) -> DataFrame:
    seed = F.sha2(F.concat_ws("|", F.lit(key), "kind", "form", F.lit(str(attempt))), 256)
    return entities.withColumn("made", surrogate(F.col("kind"), F.col("form"), F.col("mention"), seed, NETWORKS if attempt < RESERVED_FROM else RESERVED))


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, form, made) for distinct entities (kind, form, mention), all surrogates distinct and none an entity.

    A surrogate is taken if no entity has its form, none was taken before
    with it, and its entity has the smallest form of those that drew it now; the
    others draw again. Rounds shrink to the few that collide.
    """
    taken, todo = None, materialize(entities, "pii-entities")
    # A person's form holds the gender after a bar; a name of either gender is no surrogate.
    own = todo.select("kind", F.when(F.col("kind") == "person", F.substring_index("form", "|", 1)).otherwise(F.col("form")).alias("made_form")).distinct()
    for attempt in range(MAX_ATTEMPTS):
        # Written first: the surrogate is a long expression, and its form refers to it often.
        drawn = materialize(_drawn(todo, key, attempt), "pii-drawn").withColumn("made_form", normal_form(F.col("kind"), F.col("made")))
        free = drawn.join(own, ["kind", "made_form"], "left_anti")
        if taken is not None:
            free = free.join(taken.select("kind", "made_form"), ["kind", "made_form"], "left_anti")
        winners = free.groupBy("kind", "made_form").agg(F.min(F.struct("form", "made")).alias("w")).select("kind", F.col("w.form").alias("form"), "made_form", F.col("w.made").alias("made"))
        new = materialize(winners, "pii-surrogates")
        taken = new if taken is None else taken.unionByName(new)
        todo = materialize(todo.join(new, ["kind", "form"], "left_anti"), "pii-open")
        if todo.isEmpty():
            return taken.select("kind", "form", "made")
    raise RuntimeError("surrogates still collide: the entities use up their format")


def _with_gender(listed: DataFrame) -> DataFrame:
    """Add the gender to the forms of persons: that of a mention's own title, else that of all other mentions of the name."""
    own = title_gender(F.col("mention"))
    persons = listed.filter(F.col("kind") == "person").withColumn("own", own)
    of_name = materialize(persons.groupBy("form").agg(F.min("own").alias("low"), F.max("own").alias("high")), "pii-names")
    single = F.when(F.col("low") == F.col("high"), F.col("low"))
    gendered = persons.join(of_name, "form").withColumn("form", F.concat("form", F.lit("|"), F.coalesce("own", single, F.lit("n"))))
    return materialize(listed.filter(F.col("kind") != "person").unionByName(gendered.select(*listed.columns)), "pii-forms")


def replace_entities(docs: DataFrame, key: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (with surrogates), n_entities, types (sorted, distinct), a row for each row of ``docs``.

    Whole texts are scanned once; distinct entities of the whole corpus are
    given surrogates; each row's own entities are looked up by a join, which
    adaptive execution splits where an entity is very frequent, and put back in
    place. A null text stays null, an empty one empty; both have no entities. A
    null or repeated id is no problem: rows are told apart by a number of their own.
    ``key`` is the secret; without it surrogates cannot be traced back.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = F.when(whole.rlike(HINT), F.regexp_extract_all(whole, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    every = materialize(docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), found.alias("_found"))
                        .withColumn("_row", F.monotonically_increasing_id()), "pii-rows")  # so that texts are scanned once
    rows = every.filter(F.size("_found") > 0)
    listed = rows.select("_row", F.explode(F.array_distinct("_found")).alias("mention")).withColumn("kind", entity_type(F.col("mention")))
    listed = listed.withColumn("form", normal_form(F.col("kind"), F.col("mention"))).filter(is_entity(F.col("kind"), F.col("form"), F.col("mention")))
    listed = _with_gender(materialize(listed, "pii-mentions"))
    entities = listed.groupBy("kind", "form").agg(F.min("mention").alias("mention"))
    made = materialize(assign_surrogates(entities, key), "pii-map")
    pairs = listed.join(made, ["kind", "form"]).select("_row", "kind", "mention", in_format_of(F.col("kind"), F.col("mention"), F.col("made")).alias("made"))
    maps = pairs.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("mention", "made"))).alias("_map"), F.array_sort(F.collect_set("kind")).alias("types"))
    pieces = F.split("text", ANY, -1)
    put = F.zip_with(pieces, "_found", lambda piece, mention: F.concat(piece, F.coalesce(F.element_at("_map", mention), mention, F.lit(""))))
    known = F.size(F.filter("_found", lambda m: F.map_contains_key("_map", m))).cast("long")
    none = F.array().cast("array<string>")
    # A row all of whose finds were no entities has no map, and keeps its text.
    changed = rows.join(maps, "_row", "left").select(
        "doc_id", F.when(F.col("_map").isNull(), F.col("text")).otherwise(F.array_join(put, "")).alias("text"),
        F.when(F.col("_map").isNull(), F.lit(0).cast("long")).otherwise(known).alias("n_entities"), F.coalesce("types", none).alias("types"))
    plain = every.filter(F.size("_found") == 0).select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_entities"), none.alias("types"))
    return changed.unionByName(plain)
