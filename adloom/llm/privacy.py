"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Protected entities are e-mail addresses, IP addresses, card numbers and phone numbers found by pattern. The words of the
documents that hold an entity may give it away elsewhere: for each entity and word the corpus tells how many documents hold both, n(e, t), out of
n(t) documents with the word, n(e) with the entity, and N in all. The disclosure of a word is p(e | t) = n(e, t) / n(t), its
strength in bits log2(n(e, t) N / (n(e) n(t))). A word seen with the entity in ``SUPPORT`` documents at least, of ``BITS`` or more,
is generalised from a disclosure of ``GENERALISE`` on and removed from ``REMOVE`` on, by its highest disclosure and wherever it
stands: in all documents, beside an entity or not.

Words are runs of two letters or more outside entities. Counts are taken over all documents: words of documents with entities first,
then, of these, only words that can still disclose one everywhere else, picked out inside the texts by a Bloom filter before anything
is exploded. The filter grows with the number of words up to a fixed size; beyond it more words are exploded and fall out at the
exact join. All bounds are exact: they drop no word that would have been generalised or removed. Null texts are empty texts; repeated rows are documents of their own.

Base patterns run without retries: what a pattern matches and then fails its check is passed over. They are written with
possessive repeats and look-behinds, which change no match but keep long runs of digits or letters linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.operators.joins import fits_broadcast
from adloom.session import materialize

SUPPORT = 2
BITS = 8.0
GENERALISE = 0.5
REMOVE = 0.9
# The filter of words: bits for each word, their largest number, and the bits that one word sets.
FILTER_BITS, MOST_BITS, HASHES = 64, 1 << 27, 3
# Occurrences gathered at a time within a text, which keeps its cost linear.
RUN = 256
# Parts of a hot word where the disclosing words are too many to broadcast.
SALTS = 16

LOCAL = "[A-Za-z0-9._%+-]"
# In order of kind. Each: pattern, and a character without which a text holds none.
PATTERNS = {
    "email": (rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9]++(?:[\x20-][0-9]++)*+", ""),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
KINDS = [*PATTERNS, "term"]
MARKS = {k: f"[{k.upper()}]" for k in KINDS}


def _hits(text: Column, kind: str) -> Column:
    """Matches of one pattern with the length of the text between them; the pieces are bound once, not once a match."""
    pattern, needs = PATTERNS[kind]
    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))

    def of(s: Column) -> Column:
        return F.transform(s["m"], lambda m, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(s["p"][i]).alias("gap"), F.length(m).alias("size"), m.alias("value"),
            _plausible(m, kind).alias("ok"),
        ))

    hits = F.flatten(F.transform(F.array(both), of))
    present = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]")
    return F.when(present, hits)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    at = F.sequence(F.lit(1), F.length(digits))
    def term(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)
    return F.aggregate(F.transform(at, term), F.lit(0), lambda a, x: a + x) % 10 == 0


def _plausible(value: Column, kind: str) -> Column:
    """The check of a match."""
    if kind == "ip":
        part = lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3
        small = lambda p: part(p) & (F.coalesce(F.when(part(p), F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).cast("int")), F.lit(999)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _masked(text: Column) -> Column:
    """The text with blanks in place of e-mail addresses, the only entities that hold letters; no place moves."""
    pattern, needs = PATTERNS["email"]
    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))

    def of(s: Column) -> Column:
        return F.array_join(F.transform(s["p"], lambda p, i: F.concat(p, F.coalesce(F.repeat(F.lit(" "), F.length(F.get(s["m"], i))), F.lit("")))), "")

    return F.when(F.contains(text, F.lit(needs)), F.transform(F.array(both), of)[0]).otherwise(text)


def find(docs: DataFrame, keys: list[str], text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows (``_row``, ``keys``, and ``_t``: the text without e-mail addresses) and spans (``_row, kind, start, end, entity``); all stored."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(F.monotonically_increasing_id().alias("_row"), *keys, body.alias("_t"))
    hits = F.flatten(F.filter(F.array(*[_hits(F.col("_t"), k) for k in PATTERNS]), lambda h: h.isNotNull()))
    rows = materialize(narrow.select("_row", *keys, _masked(F.col("_t")).alias("_t"), hits.alias("_hits")), "pii-rows")
    flat = rows.where(F.size("_hits") > 0).select("_row", F.inline("_hits"))
    upto = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = flat.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
    spans = placed.where("ok").select(
        "_row", "kind", (F.col("end") - F.col("size")).alias("start"), "end",
        F.xxhash64("kind", F.when(F.col("kind") == 0, F.lower("value")).otherwise(_digits(F.col("value")))).alias("entity"),
    )
    return rows.drop("_hits"), materialize(spans, "pii-spans")


def _places_of(term: Column, size: Column) -> list[Column]:
    """The bits of a word in a filter of ``size`` bits, a power of two, from the two halves of one hash."""
    h = F.xxhash64(term)
    low, high = h.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(h, 32)
    return [F.pmod(low + high * F.lit(k) if k else low, size) for k in range(HASHES)]


def _bitmap(terms: DataFrame) -> Column:
    """A filter that holds the words of ``terms`` (a column ``term`` without repeats), as a constant of the plan.

    At most ``MOST_BITS`` / 64 numbers go through the driver's broadcast of the constant.
    """
    size = 64
    wanted = terms.count() * FILTER_BITS
    while size < min(wanted, MOST_BITS):
        size *= 2
    bit = F.explode(F.array(*_places_of(F.col("term"), F.lit(size)))).alias("bit")
    bits = terms.select(bit).groupBy(F.shiftright("bit", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("b"))
    # Words of 64 bits in order, absent ones zero.
    whole = bits.unionByName(terms.sparkSession.range(size // 64).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("b")))
    filled = whole.groupBy("w").agg(F.bit_or("b").alias("b"))
    return materialize(filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("bits")), "pii-filter").scalar()


def _wanted(t: Column) -> Column:
    """Whether the filter in ``_bits`` may hold a word."""
    size = F.size("_bits").cast("long") * 64
    hit = lambda at: F.getbit(F.get(F.col("_bits"), F.shiftright(at, 6).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1
    first, *others = [hit(at) for at in _places_of(t, size)]
    for o in others:
        first = first & o
    return first


def _words(text: Column) -> Column:
    """Distinct words of a masked text, lower-cased."""
    long = F.filter(F.split(text, r"\P{L}+"), lambda w: F.length(w) >= 2)
    return F.array_distinct(F.transform(F.array_distinct(long), F.lower))


def _of_terms(found: DataFrame, terms: DataFrame) -> DataFrame:
    """``found`` (``_row``, ``term`` and more) joined with ``terms`` by the word."""
    if fits_broadcast(terms):
        return found.join(F.broadcast(terms), "term")
    # A frequent word whose bit is another's goes to many tasks before it falls out.
    part = F.pmod(F.xxhash64(*found.columns), F.lit(SALTS)).cast("int")
    parts = terms.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return found.withColumn("_part", part).join(parts, ["term", "_part"]).drop("_part")


def term_counts(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Number of ``rows`` that hold each of ``terms`` (a column ``term`` without repeats)."""
    held = rows.select(_words(F.col("_t")).alias("_tokens"), _bitmap(terms).alias("_bits")).select(F.explode(F.filter("_tokens", _wanted)).alias("term"))
    return held.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).join(terms, "term", "left_semi")


def _places(text: Column) -> Column:
    """Places of the marked words of a text: ``term, start, size``. The pieces are bound once, not once a word."""
    both = F.struct(F.split(text, r"\P{L}+", -1).alias("w"), F.regexp_extract_all(text, F.lit(r"\P{L}+"), F.lit(0)).alias("g"))
    kind = "array<struct<term:string,start:int,size:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("run"), F.array().cast(f"array<{kind}>").alias("runs"))

    def word(s: Column, w: Column, i: Column) -> Column:
        return F.struct(F.lower(w).alias("term"), F.length(w).alias("size"), F.coalesce(F.length(F.get(s["g"], i)), F.lit(0)).alias("gap"), _wanted(F.lower(w)).alias("hit"))

    def step(a: Column, x: Column) -> Column:
        one = F.array(F.struct(x["term"].alias("term"), a["at"].alias("start"), x["size"].alias("size")))
        full = F.size(a["run"]) >= RUN
        run = F.when(x["hit"], F.when(full, one).otherwise(F.concat(a["run"], one))).otherwise(a["run"])
        runs = F.when(x["hit"] & full, F.concat(a["runs"], F.array(a["run"]))).otherwise(a["runs"])
        return F.struct((a["at"] + x["size"] + x["gap"]).alias("at"), run.alias("run"), runs.alias("runs"))

    def of(s: Column) -> Column:
        return F.aggregate(F.transform(s["w"], lambda w, i: word(s, w, i)), zero, step, lambda a: F.concat(F.flatten(a["runs"]), a["run"]))

    return F.transform(F.array(both), of)[0]


def occurrences(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Every place in ``rows`` (``_row``, ``_t``) of the words of ``terms`` (``term``, ``p``): ``_row, start, end, p``."""
    held = rows.select("_row", "_t", _bitmap(terms).alias("_bits")).where(F.exists(_words(F.col("_t")), _wanted))
    rated = _of_terms(held.select("_row", F.inline(_places(F.col("_t")))), terms)
    start = F.col("start").cast("long")
    return rated.select("_row", start.alias("start"), (start + F.col("size")).alias("end"), "p")


def disclosing(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Of the entities and words of the same documents those (entity, term) that disclose: with ``p`` and ``bits``."""
    total = rows.count()
    # n(e, t) is n(e) and n(t) at most, so neither may be above this share of all documents; room for rounding.
    most = total / 2**BITS * (1 + 1e-9)
    held = spans.select("_row", "entity").distinct()
    n_e = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e").between(SUPPORT, most))
    held = materialize(held.join(n_e, "entity"), "pii-held")
    top = held.groupBy("_row").agg(F.max("n_e").alias("_top"))
    texts = rows.join(top, "_row").select("_row", "_top", _words(F.col("_t")).alias("_tokens"))
    # Documents with the word and any entity: a lower bound of n(t), an upper bound of n(e, t).
    beside = texts.select("_top", F.explode("_tokens").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("_least"), F.max("_top").alias("_top"))
    beside = beside.where(F.col("_least").between(SUPPORT, most) & (F.col("_top") >= GENERALISE * F.col("_least")))
    beside = materialize(beside, "pii-beside")
    able = (F.col("n_t") <= most) & (F.least("_least", "_top") >= GENERALISE * F.col("n_t"))
    n_t = materialize(term_counts(rows, beside.select("term")).join(beside, "term").where(able).select("term", "n_t"), "pii-able")
    found = texts.withColumn("_bits", _bitmap(n_t.select("term"))).select("_row", F.explode(F.filter("_tokens", _wanted)).alias("term"))
    pairs = _of_terms(found, n_t).join(held, "_row").where(F.col("n_e") >= GENERALISE * F.col("n_t"))
    joint = pairs.groupBy("entity", "term", "n_e", "n_t").agg(F.count(F.lit(1)).alias("n_et")).where(F.col("n_et") >= SUPPORT)
    rated = joint.select(
        "entity", "term", (F.col("n_et") / F.col("n_t")).alias("p"),
        F.log2(F.col("n_et") * F.lit(float(total)) / (F.col("n_e") * F.col("n_t"))).alias("bits"),
    )
    return materialize(rated.where((F.col("p") >= GENERALISE) & (F.col("bits") >= BITS)), "pii-disclosing")


def all_spans(docs: DataFrame, keys: list[str], text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows as in ``find``, and every span: ``_row, kind, start, end, p`` (the disclosure of a term, null for an entity)."""
    rows, spans = find(docs, keys, text)
    rated = disclosing(rows, spans)
    terms = occurrences(rows, materialize(rated.groupBy("term").agg(F.max("p").alias("p")), "pii-terms"))
    base = spans.select("_row", "kind", "start", "end", F.lit(None).cast("double").alias("p"))
    return rows.drop("_t"), base.unionByName(terms.withColumn("kind", F.lit(KINDS.index("term"))))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: numbers of base spans, a digest of them, and all spans."""
    rows, spans = all_spans(docs, [id_col], text)
    grouped = spans.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
    base = F.filter("s", lambda x: x["kind"] < KINDS.index("term"))
    of_kind = lambda k: F.filter("s", lambda x: x["kind"] == k)
    counts = [F.size(of_kind(i)).cast("long").alias(f"n_{k}") for i, k in enumerate(PATTERNS)]
    empty = F.coalesce(F.col("s"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("s")
    out = rows.join(grouped, "_row", "left").select(id_col, empty)
    return out.select(id_col, *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("s")).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with its text sanitised: entities and generalised terms give way to marks, removed terms to nothing.

    Spans that overlap an earlier one begin where that ends. Rows of one id and text are sanitised alike.
    """
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    keyed = docs.withColumns({"_id": F.coalesce(F.col(id_col).cast("string"), F.lit("")), "_digest": digest})
    rows, spans = all_spans(keyed, ["_id", "_digest"], text)
    one = rows.groupBy("_id", "_digest").agg(F.min("_row").alias("_row"))
    before = Window.partitionBy("_row").orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, -1)
    cut = spans.withColumn("_done", F.coalesce(F.max("end").over(before), F.lit(0))).where(F.col("end") > F.col("_done"))
    marks = F.when(F.col("p") >= REMOVE, F.lit("")).otherwise(F.array(*[F.lit(MARKS[k]) for k in KINDS])[F.col("kind")])
    cut = cut.select("_row", "_done", F.greatest("start", "_done").alias("start"), "end", marks.alias("mark"))
    grouped = cut.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "_done", "end", "mark"))).alias("_cuts"))
    joined = keyed.join(one.join(grouped, "_row").drop("_row"), ["_id", "_digest"], "left")
    pieces = F.transform("_cuts", lambda c: F.concat(F.substring(F.col(text), (c["_done"] + 1).cast("int"), (c["start"] - c["_done"]).cast("int")), c["mark"]))
    tail = F.substring(F.col(text), (F.element_at("_cuts", -1)["end"] + 1).cast("int"), F.length(text))
    clean = F.when(F.col("_cuts").isNull(), F.col(text)).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return joined.select(*[clean.alias(c) if c == text else F.col(c) for c in docs.columns])
