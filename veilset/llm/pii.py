"""Personal data: pattern spans, and information-theoretic sanitisation of what
gives them away.  DataFrame functions only.

*Base spans* are the matches of four patterns (e-mail, IP address, payment
card, phone), checked for form (address parts, digit counts, Luhn).

*Terms* are words near a base span that reveal whose it is although the span
itself is masked.  The corpus tells how strongly: with ``N`` distinct texts,
an entity (a span's normalised value) in ``n(e)`` of them and a term in
``n(t)``, the information a term gives of the entity is

    PMI(t; e) = log2(N * n(t, e) / (n(t) * n(e))),

at most the entity's own information ``IC(e) = log2(N / n(e))``.  The share
``PMI / IC`` is the disclosure: 1 means that the term occurs only with the
entity.  Terms at ``generalise_at`` or more become a placeholder, at
``remove_at`` or more they go.  A pair counts only from ``min_contexts``
different surroundings in as many texts on, so neither copies of a text nor
lines repeated in it prove anything; ``n(t, e)`` is the smaller of both.

:func:`find` reports the terms beside base spans.  :func:`sanitise` also takes
every word of a text that holds the entity as a candidate, however far from the
span, and masks each occurrence of a disclosing term in all texts with its entity.

Scale: patterns run once, in the scan; only rows with a span are exploded.
Term frequencies are counted over every text, but only for the candidate
terms, after map-side aggregation.  No value of any entity reaches the driver.

Defined cases: NULL text is empty (no spans); a text of any length is read
whole; rows repeated under one id and text have equal results and all stay; a
NULL ``doc_id`` is an id like any other; an empty table gives no rows; extra
columns are ignored by :func:`find` and carried by :func:`sanitise`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, unpack_row, whole_row

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns in a form that Java's regex matches in linear time:
# possessive repeats where no backtracking can help, and a start only where a
# run of the leading class starts (or the last match ended).  A card pattern
# asks for its 16 digits at once, as shorter runs are dropped anyway.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for its pattern to be tried.
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_MASK = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]",
         "term": "[TERM]", "removed": ""}


_ALL = 1 << 30          # to the end of an array


@dataclass(frozen=True)
class Params:
    context_chars: int = 120      # characters beside a span that hold its terms
    context_words: int = 8        # words on either side
    min_contexts: int = 3
    generalise_at: float = 0.75
    remove_at: float = 0.95


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's check of a string of digits."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    doubled = F.transform(figures, lambda d, i: F.when(
        i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    n = F.length(_digits(value))
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
            .when(kind == "card", n.between(16, 19) & _luhn(_digits(value)))
            .otherwise(n.between(8, 15)))


def _normal(kind: Column, value: Column) -> Column:
    """One form per entity."""
    return F.when(kind == "email", F.lower(value)).when(kind == "ip", value).otherwise(
        _digits(value))


def _matches(text: Column, kind: str, p: Params) -> Column:
    """Matches of a kind: value, characters and bytes before it since the
    last match, and what stands beside it."""
    pattern, gaps = F.lit(PATTERNS[kind]), F.split(text, PATTERNS[kind], -1)
    found = F.filter(
        F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(0)), gaps,
                     F.slice(gaps, 2, _ALL)),
        lambda x: x["0"].isNotNull())
    spans = F.transform(found, lambda x: F.struct(
        F.lit(kind).alias("kind"), x["0"].alias("value"), F.length(x["1"]).alias("gap"),
        F.octet_length(x["1"]).alias("gap_bytes"),
        F.right(x["1"], F.lit(p.context_chars)).alias("before"),
        F.left(x["2"], F.lit(p.context_chars)).alias("after")))
    return F.when(_may_match(text, kind), spans).otherwise(F.array().cast(
        "array<struct<kind:string,value:string,gap:int,gap_bytes:int,before:string,"
        "after:string>>"))


def _may_match(text: Column, kind: str) -> Column:
    """Cheap test that every text with a match of the kind passes."""
    need = _NEEDS[kind]
    may = F.contains(text, F.lit(need)) if need else text.rlike(PATTERNS[kind])
    return may & text.rlike(r"[0-9]\.[0-9]") if kind == "ip" else may


def _scan(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, text hash and the raw matches of every row (staged)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    return staged(rows.select(
        "doc_id", F.xxhash64("text").alias("h"),
        *[_matches(F.col("text"), k, p).alias(k) for k in KINDS]), "pii-scan")


def _base(scan: DataFrame) -> DataFrame:
    """A row per valid base span of each distinct (doc_id, text)."""
    has = sum((F.size(k) for k in KINDS), F.lit(0)) > 0
    rows = scan.where(has).dropDuplicates(["doc_id", "h"])
    each = rows.select("doc_id", "h", F.explode(F.array(*KINDS)).alias("of_kind")).select(
        "doc_id", "h", F.posexplode("of_kind").alias("i", "m")).select("doc_id", "h", "i", "m.*")
    upto = Window.partitionBy("doc_id", "h", "kind").orderBy("i").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = (each
              .withColumn("end", F.sum(F.col("gap").cast("long") + F.length("value")).over(upto))
              .withColumn("end_byte", F.sum(F.col("gap_bytes").cast("long")
                                            + F.octet_length("value")).over(upto)))
    return placed.where(_valid(F.col("kind"), F.col("value"))).select(
        "doc_id", "h", "kind", _normal(F.col("kind"), F.col("value")).alias("entity"),
        (F.col("end") - F.length("value")).alias("start"), "end",
        (F.col("end_byte") - F.octet_length("value")).alias("start_byte"), "end_byte",
        "before", "after")


def _words(text: Column) -> Column:
    """Words of a short text: with the characters and bytes before each."""
    word = r"[^\x20\x09-\x0D]+"
    zipped = F.filter(F.arrays_zip(F.regexp_extract_all(text, F.lit(word), F.lit(0)),
                                   F.split(text, word, -1)), lambda x: x["0"].isNotNull())

    def place(z: Column, i: Column, measure) -> Column:
        """What stands before the i-th word, by ``measure``."""
        return F.aggregate(F.slice(z, F.lit(1), i), F.lit(0),
                           lambda a, x: a + measure(x["1"]) + measure(x["0"])) \
            + measure(F.element_at(z, i + 1)["1"])

    def words(z: Column) -> Column:
        return F.transform(z, lambda x, i: F.struct(
            x["0"].alias("w"), place(z, i, F.length).alias("at"),
            place(z, i, F.octet_length).alias("at_byte")))

    # bound to a lambda variable, so that the text is taken apart once
    return F.element_at(F.transform(F.array(zipped), words), 1)


def _term_spans(base: DataFrame, p: Params) -> DataFrame:
    """Words beside each base span: term, its place, the entity and a hash of
    the surroundings.  A word that holds ``@`` or a digit is none, so a term
    never overlaps a base span; nor is one that touches the span or is cut."""
    c = F.lit(p.context_chars)
    sides = base.select(
        "doc_id", "h", "kind", "entity", "start", "start_byte", "end", "end_byte", "before",
        "after", F.xxhash64("before", "after").alias("ctx"),
        _words(F.col("before")).alias("left"), _words(F.col("after")).alias("right"))
    # the word cut by the context's far edge, the one that touches the span
    left = F.when(F.length("before") >= c, F.slice("left", 2, _ALL)).otherwise(F.col("left"))
    left = F.when(F.col("before").rlike(r"[^\x20\x09-\x0D]$"),
                  F.slice(left, 1, F.greatest(F.size(left) - 1, F.lit(0)))).otherwise(left)
    right = F.when(F.col("after").rlike(r"^[^\x20\x09-\x0D]"),
                   F.slice("right", 2, _ALL)).otherwise(F.col("right"))
    right = F.when(F.length("after") >= c,
                   F.slice(right, 1, F.greatest(F.size(right) - 1, F.lit(0)))).otherwise(right)
    n = p.context_words
    near_left = F.slice(left, F.greatest(F.size(left) - n, F.lit(0)) + 1, n)
    near_right = F.slice(right, 1, n)
    rows = sides.select(
        "doc_id", "h", "kind", "entity", "ctx",
        F.explode(F.concat(
            F.transform(near_left, lambda x: F.struct(
                x["w"].alias("w"), (F.col("start") - F.length("before") + x["at"]).alias("at"),
                (F.col("start_byte") - F.octet_length("before") + x["at_byte"]).alias("at_byte"))),
            F.transform(near_right, lambda x: F.struct(
                x["w"].alias("w"), (F.col("end") + x["at"]).alias("at"),
                (F.col("end_byte") + x["at_byte"]).alias("at_byte"))))).alias("x"))
    lead = F.regexp_extract("x.w", r"^[^\p{L}\p{M}]*", 0)
    core = F.regexp_extract("x.w", r"^[^\p{L}\p{M}]*([\p{L}\p{M}]{3,})[^\p{L}\p{M}]*$", 1)
    return rows.where(~F.col("x.w").rlike("[@0-9]")).select(
        "doc_id", "h", "kind", "entity", "ctx", F.lower(core).alias("term"),
        (F.col("x.at") + F.length(lead)).alias("start"),
        (F.col("x.at") + F.length(lead) + F.length(core)).alias("end"),
        (F.col("x.at_byte") + F.octet_length(lead)).alias("start_byte"),
        (F.col("x.at_byte") + F.octet_length(lead) + F.octet_length(core)).alias("end_byte"),
    ).where("term != ''")


def _words_with(docs: DataFrame, base: DataFrame, p: Params) -> DataFrame:
    """kind, entity, term, h, ctx: the words of each distinct text that holds an
    entity of at least ``min_contexts`` texts (others can have no term)."""
    holds = base.select("kind", "entity", "h").distinct()
    several = holds.join(holds.groupBy("kind", "entity").agg(F.count("*").alias("n")).where(
        F.col("n") >= p.min_contexts), ["kind", "entity"], "left_semi")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    may = reduce(lambda a, b: a | b, [_may_match(text, k) for k in KINDS])
    core = F.transform(
        F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: ~w.rlike("[@0-9]")),
        lambda w: F.lower(F.regexp_extract(
            w, r"^[^\p{L}\p{M}]*([\p{L}\p{M}]{3,})[^\p{L}\p{M}]*$", 1)))
    words = docs.where(may).select(F.xxhash64(text).alias("h"), core.alias("w"))
    known = several.select("h").distinct()
    each = words.join(known, "h", "left_semi").select(
        "h", F.explode(F.array_distinct("w")).alias("term")).where("term != ''").distinct()
    return each.join(several, "h").select("kind", "entity", "term", "h", F.col("h").alias("ctx"))


_WORDS_OF_BITS = 1 << 18      # 64 bits each


def _maybe_among(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """``rows`` with ``maybe`` (for the column ``h``; else ``maybe_<column>``): false
    only where the column's value is surely not among ``wanted``, found out without
    a shuffle.  A value's hash names one of 2**24 bits, set if a wanted value has
    it; the words that hold a bit (at most 2**18 rows of two numbers, however many
    values there are) are broadcast."""
    mark = "maybe" if column == "h" else f"maybe_{column}"

    def place() -> Column:
        return F.pmod(F.xxhash64(column), F.lit(64 * _WORDS_OF_BITS))

    bits = wanted.select(place().alias("at")).groupBy(
        F.shiftright("at", 6).alias("of_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                 (F.col("at") % 64).cast("int"))).alias("bits"))
    rows = rows.withColumn("at", place())
    hit = rows.join(F.broadcast(bits), F.shiftright("at", 6) == F.col("of_word"), "left")
    bit = F.call_function("shiftright", F.col("bits"), (F.col("at") % 64).cast("int"))
    return hit.withColumn(mark, F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False))) \
        .drop("at", "of_word", "bits")


def disclosures(docs: DataFrame, scan: DataFrame, base: DataFrame, terms: DataFrame,
                p: Params = Params()) -> DataFrame:
    """kind, entity, term, disclosure: the pairs at ``generalise_at`` or more.

    To disclose that much a term may stand in ``n(t, e) * (N / n(e)) ** (1 -
    generalise_at)`` texts at most.  The texts where it stands beside any
    entity are known before the corpus is counted, and a term of more than
    that many goes at once; so no common word is counted over the corpus."""
    total = float(scan.agg(F.count_distinct("h")).first()[0])
    n_e = base.select("kind", "entity", "h").distinct().groupBy("kind", "entity").agg(
        F.count("*").alias("n_e"))
    near = terms.select("term", "h").distinct().groupBy("term").agg(F.count("*").alias("n_near"))
    seen = terms.groupBy("kind", "entity", "term").agg(
        F.least(F.count_distinct("ctx"), F.count_distinct("h")).alias("n_te")).where(
        F.col("n_te") >= p.min_contexts)
    most = F.col("n_te") * F.pow(F.lit(total) / F.col("n_e"), F.lit(1 - p.generalise_at))
    pairs = staged(seen.join(n_e, ["kind", "entity"]).join(near, "term").where(
        F.col("n_near") <= most * (1 + 1e-9)), "pii-pairs")
    wanted = pairs.select("term").distinct()
    letters = F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))),
                      r"[^\p{L}\p{M}]+", -1)
    hashed = docs.select(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
                         .alias("h"), letters.alias("w"))
    again = scan.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    texts = _maybe_among(hashed, "h", again).select(
        "h", "maybe", F.explode(F.array_distinct("w")).alias("term"))
    texts = _maybe_among(texts, "term", wanted).where("maybe_term").drop("maybe_term")
    # a text that is there once adds one to each of its words, summed up where it is
    # read; only for texts that may be there more often do (text, word) pairs travel
    once = texts.where("NOT maybe").groupBy("term").agg(F.count("*").alias("n"))
    more = texts.where("maybe").select("h", "term").distinct().groupBy("term").agg(
        F.count("*").alias("n"))
    n_t = once.unionAll(more).join(wanted, "term", "left_semi").groupBy("term").agg(
        F.sum("n").alias("n_t"))
    both = F.least("n_te", "n_t", "n_e").cast("double")
    known = F.log2(F.lit(total) / F.col("n_e"))
    share = F.when(known > 0, F.log2(F.lit(total) * both / (F.col("n_t") * F.col("n_e"))) / known)
    return (pairs.join(n_t, "term")
            .select("kind", "entity", "term", share.alias("disclosure"))
            .where(F.col("disclosure") >= p.generalise_at))


def spans(docs: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """The scan (doc_id, h per row) and all spans: doc_id, h, kind, start, end,
    start_byte, end_byte, disclosure (NULL for base spans)."""
    scan, found, _ = _spans(docs, p)
    return scan.select("doc_id", "h"), found


def _spans(docs: DataFrame, p: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The scan, all spans and the base spans."""
    scan = _scan(docs, p)
    base = staged(_base(scan), "pii-base")
    terms = staged(_term_spans(base, p), "pii-terms")
    told = disclosures(docs, scan, base, terms, p)
    place = ["doc_id", "h", "start", "end", "start_byte", "end_byte"]
    extra = terms.join(told, ["kind", "entity", "term"]).groupBy(*place).agg(
        F.max("disclosure").alias("disclosure"))
    found = base.select(*place, "kind", F.lit(None).cast("double").alias("disclosure")).unionAll(
        extra.select(*place, F.lit("term").alias("kind"), "disclosure"))
    return scan, staged(found, "pii-spans"), base


def find(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, a count per kind, base_sha256, spans, n_term: a row per row."""
    scan, found = spans(docs, p)
    order = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "term")]), F.col("kind"))
    told = F.concat_ws(":", "kind", "start", "end")
    listed = found.groupBy("doc_id", "h").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in (*KINDS, "term")],
        F.array_sort(F.collect_list(F.struct(order.alias("o"), "start", "end",
                                             told.alias("s")))).alias("all"))
    per_text = listed.select(
        F.col("doc_id").alias("id"), F.col("h").alias("of"),
        *[f"n_{k}" for k in (*KINDS, "term")],
        F.array_join(F.transform("all", lambda x: x["s"]), ",").alias("spans"),
        F.array_join(F.transform(F.filter("all", lambda x: x["o"] <= len(KINDS)),
                                 lambda x: x["s"]), ",").alias("base"))
    out = scan.join(per_text, F.col("doc_id").eqNullSafe(F.col("id"))
                    & (F.col("h") == F.col("of")), "left")
    zero = lambda k: F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[zero(k) for k in KINDS],
                      F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), zero("term"))


def sanitise(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with every span masked in ``text``; other columns untouched,
    but for ``n_chars`` (if there), which follows the text."""
    scan, found, base = _spans(docs, p)
    wide = staged(_words_with(docs, base, p), "pii-words")
    told = disclosures(docs, scan, base, wide, p)
    # terms of each text with their entity, the strongest disclosure of each
    each = base.select("doc_id", "h", "kind", "entity").distinct().join(
        told, ["kind", "entity"]).groupBy("doc_id", "h", "term").agg(
        F.max("disclosure").alias("d"))
    which = lambda c: F.array_join(F.array_sort(F.collect_list(
        F.when(c, F.col("term")))), "|")
    in_text = each.groupBy("doc_id", "h").agg(
        which(F.col("d") >= p.remove_at).alias("gone"),
        which(F.col("d") < p.remove_at).alias("general"))
    kind = F.when(F.col("kind") != "term", F.col("kind")).when(
        F.col("disclosure") >= p.remove_at, F.lit("removed")).otherwise(F.lit("term"))
    labels = F.create_map(*[F.lit(x) for kv in _MASK.items() for x in kv])
    # overlapping spans of different kinds become one, under the first's label
    row = Window.partitionBy("doc_id", "h").orderBy("start_byte", "end_byte", "kind")
    reach = F.max("end_byte").over(row.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("start_byte") >= reach).cast("int"), F.lit(1))
    islands = (found.withColumn("fresh", fresh).withColumn("label", labels[kind])
               .withColumn("island", F.sum("fresh").over(row))
               .groupBy("doc_id", "h", "island")
               .agg(F.min("start_byte").alias("a"), F.max("end_byte").alias("b"),
                    F.min_by("label", F.struct("start_byte", "end_byte", "kind")).alias("label")))
    listed = islands.groupBy("doc_id", "h").agg(
        F.array_sort(F.collect_list(F.struct("a", "b", "label"))).alias("m")).select(
        F.col("doc_id").alias("mask_id"), F.col("h").alias("mask_h"), "m")
    masks = listed.join(in_text, F.col("mask_id").eqNullSafe(F.col("doc_id"))
                        & (F.col("mask_h") == F.col("h")), "left").drop("doc_id", "h")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    packed = docs.select(F.col("doc_id").alias("own_id"), F.xxhash64(text).alias("own_h"),
                         whole_row(docs),
                         reduce(lambda a, b: a | b, [_may_match(text, k) for k in KINDS])
                         .alias("may"))
    # texts without a span stay where they are; only the others meet their masks
    plain = packed.where("NOT may").select("row")
    joined = packed.where("may").join(masks, F.col("own_id").eqNullSafe(F.col("mask_id"))
                         & (F.col("own_h") == F.col("mask_h")), "left")
    raw = F.col("row.text").cast("binary")
    # text between the masks: zip each mask with the end of the one before it
    pairs = F.arrays_zip(F.col("m"), F.concat(F.array(F.lit(0).cast("long")),
                                              F.transform("m", lambda x: x["b"])))

    def without(piece: Column) -> Column:
        for name, label in (("gone", "removed"), ("general", "term")):
            words = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{M}])(?:"), F.col(name),
                             F.lit(r")(?![\p{L}\p{M}])"))
            piece = F.when(F.coalesce(F.col(name), F.lit("")) == "", piece).otherwise(
                F.regexp_replace(piece, words, F.lit(_MASK[label])))
        return piece

    pieces = F.transform(pairs, lambda x: F.concat(
        without(F.substring(
            raw, (x["1"] + 1).cast("int"),
            F.coalesce(x["m"]["a"] - x["1"], F.lit(2**31 - 1)).cast("int")).cast("string")),
        F.coalesce(x["m"]["label"], F.lit(""))))
    text = F.when(F.col("m").isNull(), F.col("row.text")).otherwise(F.array_join(pieces, ""))
    out = joined.select("row", text.alias("new_text"))
    new = {"text": F.col("new_text"),
           "n_chars": F.when(F.col("row.n_chars").isNotNull(), F.length("new_text"))
           .cast("long") if "n_chars" in docs.columns else None}
    masked = out.select(F.struct(*[
        (new[c] if new.get(c) is not None else F.col(f"row.`{c}`")).alias(c)
        for c in docs.columns]).alias("row"))
    return unpack_row(masked.unionAll(plain))
