"""Personal data by patterns and by what the corpus discloses about it, with DataFrame functions only.

Patterns find the protected entities: e-mail and IP addresses, card and phone numbers. A word of a text that holds an
entity then counts as disclosing it when the corpus ties the two together: with N documents, of which n(e) hold the
entity, n(t) the word and n(t, e) both, the word's information about it is log2(N n(t, e) / (n(t) n(e))), and all that
can be known is log2(N / n(e)). Words whose share of that is at least ``DISCLOSURE`` are spans as well, wherever they
stand in a text with that entity, if at least ``SUPPORT`` different texts say so. Words are runs of letters, marks and
digits that do not overlap an entity.

The texts are read twice: for entities, and for the counts n(t). Words are paired only with entities that ``SUPPORT``
different texts hold, as no other can be disclosed. The second reading counts only words whose hash is marked by a
candidate, in a mask of ``MASK_BITS`` bits whatever the size of the corpus; a mark that several words share costs time,
not correctness. Counts are summed in the map task before they are moved, so no entity or word is too frequent.

Defined results: a null text is empty, an empty text has no spans, repeated rows are counted and answered each for
itself, null ids are kept, an empty table gives none. Offsets are code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.tables import snapshot

DISCLOSURE, SUPPORT, MASK_BITS = 0.9, 2, 1 << 20
KINDS = ("email", "ip", "card", "phone", "term")
_LETTER = r"[\p{L}\p{M}\p{N}]"
_TERM = _LETTER + "++"
# The patterns accept what the plain ones do, but start only where a match can start, so long runs cost linear time.
_LOCAL = r"A-Za-z0-9._%+-"
_PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    digits = F.reverse(F.split(_digits(s), ""))
    worth = F.transform(digits, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(worth, F.lit(0), lambda a, b: a + b) % 10 == 0


_VALID = {
    "email": lambda s: F.lit(True),
    "ip": lambda s: s.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"),
    "card": _luhn,
    "phone": lambda s: F.length(_digits(s)).between(8, 15),
}
_LOOKS = {"email": lambda t: F.contains(t, F.lit("@")), "ip": lambda t: t.rlike("[0-9]\\.[0-9]"), "card": lambda t: t.rlike("[0-9][\\x20-]?[0-9]"),
          "phone": lambda t: F.contains(t, F.lit("+"))}


def located(text: Column, pattern: str | Column) -> Column:
    """All matches of a pattern from left to right as an array of (start, end, value): what lies between the matches
    and the matches themselves give the places."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("spans"))

    def add(state, pair):
        first = state["at"] + F.length(pair["gap"])
        last = first + F.length(pair["value"])
        span = F.struct(first.alias("start"), last.alias("end"), pair["value"].alias("value"))
        return F.struct(last.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    pairs = F.transform(found, lambda value, i: F.struct(F.get(between, i).alias("gap"), value.alias("value")))
    return F.aggregate(pairs, start, add, lambda state: state["spans"])


def _entities(text: Column) -> Column:
    """Array of (kind, start, end, value) of the pattern matches that hold, by kind and place."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def of(number: int, kind: str) -> Column:
        spans = F.when(_LOOKS[kind](text), located(text, _PATTERNS[kind])).otherwise(none)
        held = F.filter(spans, lambda s: _VALID[kind](s["value"]))
        return F.transform(held, lambda s: F.struct(F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))

    return F.concat(*[of(number, kind) for number, kind in enumerate(KINDS[:4])])


def _name(e: Column) -> Column:
    """An entity's kind and value, as equal ones have them."""
    value = F.when(e["kind"] == 0, F.lower(e["value"])).when(e["kind"] == 1, e["value"]).otherwise(_digits(e["value"]))
    return F.concat_ws(":", e["kind"], value)


def _words(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_TERM), 0), F.lower))


def _outside(text: Column, entities: Column) -> Column:
    """The text with each entity, and the rest of a word that it cuts, blanked."""
    ordered = F.array_sort(F.transform(entities, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"))))
    blank = lambda t, e: F.concat(
        F.regexp_replace(F.substring(t, F.lit(1), e["start"]), rf"{_LETTER}+$", ""),
        F.repeat(F.lit(" "), F.length(t) - F.length(F.regexp_replace(F.substring(t, F.lit(1), e["start"]), rf"{_LETTER}+$", "")) - F.length(F.regexp_replace(F.substring(t, e["end"] + 1, F.length(t)), rf"^{_LETTER}+", ""))),
        F.regexp_replace(F.substring(t, e["end"] + 1, F.length(t)), rf"^{_LETTER}+", ""),
    )
    return F.aggregate(ordered, text, blank)


def _cell(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(MASK_BITS))


def _mask(terms: DataFrame) -> Column:
    """One array of 64-bit words with a bit for each marked cell, as a scalar subquery; its size is fixed."""
    spark = terms.sparkSession
    cells = terms.select(_cell(F.col("term")).alias("cell")).select(F.floor(F.col("cell") / 64).alias("word"), (F.col("cell") % 64).cast("int").alias("bit"))
    words = cells.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    every = spark.range(MASK_BITS // 64).withColumnRenamed("id", "word").join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return every.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("mask")).scalar()


def disclosing(found: DataFrame, docs: DataFrame, text_col: str, disclosure: float, support: int) -> DataFrame:
    """entity, term: the words that disclose an entity."""
    held = found.select("row", "digest", F.explode("names").alias("entity"))
    holders = held.groupBy("entity", "digest").agg(F.count(F.lit(1)).alias("n")).groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("n_texts"))
    holders = snapshot(holders.filter(F.col("n_texts") >= support).drop("n_texts"), "holders")
    named = held.join(holders, "entity").groupBy("row").agg(F.collect_set("entity").alias("names"))
    pairs = found.select("row", "digest", "rest").join(named, "row").select("digest", "names", F.explode(_words(F.col("rest"))).alias("term"))
    by_text = pairs.select("digest", "term", F.explode("names").alias("entity")).groupBy("entity", "term", "digest").agg(F.count(F.lit(1)).alias("n"))
    tied = by_text.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("n_texts"))
    tied = snapshot(tied.filter(F.col("n_texts") >= support), "tied-words")
    mask = _mask(tied.select("term").distinct())
    cell = _cell(F.col("term"))
    marked = F.getbit(F.get(mask, F.floor(cell / 64).cast("int")), (cell % 64).cast("int")) == 1
    n_term = docs.select(F.explode(_words(F.col(text_col))).alias("term")).filter(marked).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    known = tied.join(holders, "entity").join(n_term, "term").withColumn("every", F.lit(docs.count()))
    told = F.log2(F.col("every") * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    return known.filter((F.col("every") > F.col("n_entity")) & (told >= disclosure * F.log2(F.col("every") / F.col("n_entity")))).select("entity", "term")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: doc_id, row, digest (of a text with entities, else null), base and terms, arrays of
    (kind, start, end); kind is a place in KINDS."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text")).withColumn("found", _entities(F.col("text")))
    some = F.size("found") > 0
    found = whole.select("doc_id", "row", F.when(some, F.xxhash64("text")).alias("digest"), "found", F.when(some, _outside(F.col("text"), F.col("found"))).alias("rest"))
    found = snapshot(found.withColumn("names", F.array_distinct(F.transform("found", _name))), "entities")
    holding = found.filter(some)
    words = snapshot(disclosing(holding, docs, text_col, disclosure, support), "disclosing")
    told = holding.select("row", F.explode("names").alias("entity")).join(words, "entity").groupBy("row").agg(F.collect_set("term").alias("told"))
    forms = F.filter(F.array_distinct(F.regexp_extract_all("rest", F.lit(_TERM), 0)), lambda w: F.array_contains("told", F.lower(w)))
    pattern = F.concat(F.lit(f"(?<!{_LETTER})(?:"), F.array_join(forms, "|"), F.lit(f")(?!{_LETTER})"))
    told = holding.select("row", "rest").join(told, "row").withColumn("pattern", pattern)
    spans = F.transform(located(F.col("rest"), F.col("pattern")), lambda s: F.struct(F.lit(4).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    terms = told.select("row", spans.alias("terms"))
    base = F.transform("found", lambda e: F.struct(e["kind"].alias("kind"), e["start"].alias("start"), e["end"].alias("end")))
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return found.select("doc_id", "row", "digest", base.alias("base")).join(terms, "row", "left").withColumn("terms", F.coalesce("terms", none))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id and text with every span replaced by its kind; a word that overlaps an entity goes with it. One row per
    different id and text."""
    found = personal_data(docs, id_col, text_col, **options).filter(F.size("base") > 0)
    found = found.select(F.col("doc_id").alias("id"), F.col("digest").alias("of"), F.concat("base", "terms").alias("spans")).dropDuplicates(["id", "of"])
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    free = F.filter("spans", lambda s: ~F.exists("spans", lambda o: ((o["kind"] < s["kind"]) | ((o["kind"] == s["kind"]) & (o["start"] < s["start"]))) & (o["start"] < s["end"]) & (s["start"] < o["end"])))
    last_first = F.reverse(F.array_sort(F.transform(free, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))))
    put = lambda t, s: F.concat(F.substring(t, F.lit(1), s["start"]), F.get(names, s["kind"]), F.substring(t, s["end"] + 1, F.length(t)))
    text = F.coalesce(F.aggregate(last_first, F.col("text"), put), F.col("text"))
    one = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).dropDuplicates(["doc_id", "text"])
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("of"))
    return one.join(found, same, "left").select("doc_id", text.alias("text"))


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])))


def op10_disclosure(spark, d: str) -> DataFrame:
    found = personal_data(spark.read.parquet(f"{d}/documents.parquet"))
    count = lambda n: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")
    return found.select(
        "doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(KINDS[:4])],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", "terms")).alias("spans"),
    )


QUERIES = {"op10_disclosure": op10_disclosure}
ORACLES: dict[str, str] = {}
