"""Personal data and the terms that give it away.

Base rules find e-mail addresses, IP addresses, card and phone numbers. The
values found are the protected entities. How much a term reveals of an entity is
estimated from the whole corpus: with N documents, of which n(e) hold the
entity, n(t) the term and n(t,e) the term close to the entity, the pointwise
mutual information log2(N n(t,e) / (n(t) n(e))) is compared with the entity's
own information log2(N / n(e)). A term that gives ``max_disclosure`` of it or
more would undo the masking, so it is generalised or removed in every document
that holds the entity. ``min_support`` documents are needed for an estimate.

Everything is a DataFrame expression; no text is shuffled unless the flagged
terms are too many for Spark to broadcast.

Defined results: null or empty text has no spans; equal rows get equal spans;
matches of one kind never overlap, kinds may; an empty table gives an empty
result; other columns pass through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import col, cut, fresh, small_side

# The rules' patterns in a form without backtracking: possessive, and started
# only where a run of characters starts or the last match ended, which is where
# the leftmost match has to start. So the time is linear, however long a run is.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"

#: Documents with flagged terms to broadcast at most; each row has the terms that
#: are near one document's entities, about 1 kB.
FLAGGED_ROWS = 20_000


@dataclass(frozen=True)
class Disclosure:
    context_chars: int = 60
    min_support: int = 3
    max_disclosure: float = 0.8
    remove: bool = False  # else generalised to a label


def _ip_ok(m: Column) -> Column:
    def part(x: Column) -> Column:
        bare = F.regexp_replace(x, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))
    return F.forall(F.split(m, r"\."), part)


def _card_ok(m: Column) -> Column:
    digits = F.translate(m, " -", "")
    bare = F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0))
    def value(c: Column, i: Column) -> Column:
        twice = c.cast("int") * (i % 2 + 1)
        return F.when(twice > 9, twice - 9).otherwise(twice)
    luhn = F.aggregate(F.transform(bare, value), F.lit(0), lambda s, x: s + x) % 10 == 0
    return F.length(digits).between(13, 19) & luhn


def _phone_ok(m: Column) -> Column:
    return F.length(F.translate(m, "+ ().-", "")).between(9, 15)


#: Items that one fold takes. Folds copy what they have built at each step, so a
#: text's matches are folded in chunks, whose places come from the chunks' sums.
CHUNK = 64


def _let(value: Column, then) -> Column:
    """``then`` of a value that is made once, however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def _chunks(items: Column) -> Column:
    """``items`` is a bound value: each chunk looks it up."""
    last = F.call_function("div", F.greatest(F.size(items) - 1, F.lit(0)), F.lit(CHUNK)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * CHUNK + 1, F.lit(CHUNK)))


def _running(values: Column, join) -> Column:
    """What ``join`` makes of 0 and the values before each, and of all of them at last."""
    return F.aggregate(values, F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(join(F.element_at(s, -1), x))))


def find(text: Column, pattern: Column, kind: str, ok=None) -> Column:
    """Spans of the pattern's matches, in code points, failing ones dropped.

    The text between the matches gives their places; only kept matches are
    added to the result.
    """
    between = F.split(text, pattern, -1)
    pairs = F.arrays_zip(between.alias("a"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"))
    size = lambda p: F.length(p["a"]) + F.coalesce(F.length(p["m"]), F.lit(0))

    def step(s: Column, p: Column) -> Column:
        a, m = p["a"], p["m"]
        begin = s["at"] + F.length(a)
        end = begin + F.coalesce(F.length(m), F.lit(0))
        one = F.array(F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), m.alias("value")))
        good = m.isNotNull() if ok is None else (m.isNotNull() & ok(m))
        return F.struct(end.alias("at"), F.when(good, F.concat(s["out"], one)).otherwise(s["out"]).alias("out"))

    def spans(parts: Column) -> Column:
        sizes = F.transform(parts, lambda c: F.aggregate(c, F.lit(0), lambda s, p: s + size(p)))
        starts = F.slice(_running(sizes, lambda s, x: s + x), 1, F.size(parts))
        return F.flatten(F.transform(F.arrays_zip(parts.alias("c"), starts.alias("at")), lambda x: F.aggregate(
            x["c"], F.struct(x["at"].alias("at"), F.array().cast(SPAN).alias("out")), step, lambda s: s["out"])))

    return _let(pairs, lambda p: _let(_chunks(p), spans))


def base_spans(text: Column) -> Column:
    """All base spans of a text (not null), by kind and start."""
    none = F.array().cast(SPAN)
    rules = (("email", EMAIL, text.contains("@"), None), ("ip", IP, text.rlike(r"[0-9]\.[0-9]"), _ip_ok),
             ("card", CARD, text.rlike(r"[0-9][\x20-]?[0-9]"), _card_ok), ("phone", PHONE, text.contains("+"), _phone_ok))
    return F.concat(*(F.when(may, find(text, F.lit(p), k, ok)).otherwise(none) for k, p, may, ok in rules))


def contexts(text: Column, spans: Column, chars: int) -> Column:
    """Kind and value of each span and the text beside it. A chunk of spans takes
    its stretch of the text first, so no span searches the text from its head."""

    def chunk(c: Column) -> Column:
        low = F.greatest(F.array_min(F.transform(c, lambda s: s["start"])) - chars, F.lit(0))
        high = F.array_max(F.transform(c, lambda s: s["end"])) + chars

        def beside(x: Column) -> Column:
            def one(s: Column) -> Column:
                return F.struct(
                    s["kind"].alias("kind"), s["value"].alias("value"),
                    F.substring(x["own"], F.greatest(s["start"] - chars - x["low"], F.lit(0)) + 1,
                                F.least(s["start"], F.lit(chars))).alias("left"),
                    F.substring(x["own"], s["end"] - x["low"] + 1, F.lit(chars)).alias("right"))
            return F.transform(c, one)

        return _let(low, lambda at: _let(F.struct(
            at.alias("low"), F.substring(text, at + 1, high - at).alias("own")), beside))

    return F.flatten(_let(spans, lambda s: F.transform(_chunks(s), chunk)))


def _key(text: Column, doc_id: Column) -> Column:
    """What tells documents apart: id and text, so that neither has to be unique."""
    return F.struct(doc_id.cast("string").alias("id"), F.xxhash64(text).alias("h"), F.length(text).alias("n"))


def revealing_terms(docs: DataFrame, text: str, doc_id: str, rule: Disclosure) -> DataFrame:
    """(key, entity, term): the terms to mask in a document that holds the entity."""
    t = F.coalesce(col(text).cast("string"), F.lit(""))
    base = docs.select(t.alias("t"), _key(t, col(doc_id)).alias("key"))
    near_spans = contexts(F.col("t"), base_spans(F.col("t")), rule.context_chars)
    held = base.where(F.col("t").rlike("[0-9@]")).select("key", F.explode(near_spans).alias("s"))
    s = F.col("s")
    # a word that the window cuts through is left out
    near = F.concat_ws(" ", F.regexp_replace(s["left"], r"^\p{L}+", ""), F.regexp_replace(s["right"], r"\p{L}+$", ""))
    terms = F.array_distinct(F.regexp_extract_all(F.lower(near), F.lit(r"\p{L}{3,}"), F.lit(0)))
    entity = F.struct(s["kind"].alias("kind"), F.lower(s["value"]).alias("value"))
    pairs = cut(held.select("key", entity.alias("entity"), terms.alias("terms")))

    entities = pairs.select("key", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    shared = pairs.join(entities.where(F.col("n_e") >= rule.min_support), "entity")
    near_by = shared.select("key", "entity", "n_e", F.explode("terms").alias("term")).distinct()
    often = near_by.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te"), F.max("n_e").alias("n_e")).where(
        F.col("n_te") >= rule.min_support)
    # at most this many documents may hold a term that reveals so much; those
    # that hold it near any entity are a first, cheap count of them
    n = F.lit(float(max(docs.count(), 1)))
    bound = F.col("n_te") / F.col("n_e") * n * F.pow(F.col("n_e") / n, F.lit(rule.max_disclosure))
    near_any = pairs.select("key", F.explode("terms").alias("term")).distinct().groupBy("term").agg(
        F.count(F.lit(1)).alias("n_near"))
    often = cut(often.join(near_any, "term").where(F.col("n_near") <= bound * 1.000001).drop("n_near"))
    wanted = small_side(cut(often.select("term").distinct()))
    all_words = base.select(F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("t"), F.lit(r"\p{L}{3,}"), F.lit(0)))).alias("term"))
    n_t = all_words.join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    shown = F.log2(n * F.col("n_te") / (F.col("n_t").cast("double") * F.col("n_e")))
    flagged = often.join(n_t, "term").where(
        (shown > 0) & (shown >= F.lit(rule.max_disclosure) * F.log2(n / F.col("n_e")))).select("entity", "term")
    return pairs.select("key", "entity").distinct().join(flagged, "entity").select("key", "term").distinct()


def with_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Disclosure = Disclosure(),
               out: str = "spans") -> DataFrame:
    """``docs`` and an array column ``out`` of all spans, base kinds first, then
    ``term`` spans that no base span touches; by kind and start."""
    t = F.coalesce(col(text).cast("string"), F.lit(""))
    key, terms = fresh(docs, "__key"), fresh(docs, "__terms")
    flagged = revealing_terms(docs, text, doc_id, rule).groupBy("key").agg(
        F.array_sort(F.collect_set("term")).alias(terms)).withColumnRenamed("key", key)
    flagged = small_side(cut(flagged), FLAGGED_ROWS)
    spotted = docs.withColumn(out, base_spans(t)).withColumn(key, _key(t, col(doc_id))).join(flagged, key, "left")
    # a document's flagged terms as one pattern of whole words
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.concat_ws("|", F.col(terms)), F.lit(r")(?!\p{L})"))
    clear = F.filter(find(t, pattern, "term"), lambda x: ~F.exists(
        F.col(out), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    both = F.when(F.col(terms).isNull(), F.col(out)).otherwise(F.concat(F.col(out), clear))
    return spotted.withColumn(out, both).select(*(col(c) for c in docs.columns), F.col(out))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """Counts and digests of the spans of each row of (doc_id, text)."""
    base = F.filter("spans", lambda s: s["kind"] != "term")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return with_spans(docs, rule=rule).select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), count("term").alias("n_term"))


def sanitise(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with its spans replaced by labels (terms removed, if so ruled)."""
    out = fresh(docs, "spans")
    t = col(text).cast("string")
    label = F.lit("[DATA]")
    for kind, value in LABELS.items():
        label_of = F.lit("" if kind == "term" and rule.remove else value)
        label = (lambda k, v, rest: lambda s: F.when(s["kind"] == k, v).otherwise(rest(s) if callable(rest) else rest))(
            kind, label_of, label)
    ordered = F.array_sort(F.transform(F.col(out), lambda s: F.struct(s["start"], s["end"], s["kind"].alias("kind"))))

    def piece(x: Column) -> Column:
        """A chunk's masked text, from where the chunk before ends."""
        own = F.substring(t, x["at"] + 1, x["to"] - x["at"])

        def step(a: Column, s: Column) -> Column:
            more = F.concat(a["out"], F.substring(own, a["at"] - x["at"] + 1, s["start"] - a["at"]), label(s))
            return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                            F.when(s["start"] >= a["at"], more).otherwise(a["out"]).alias("out"))

        return F.aggregate(x["c"], F.struct(x["at"].alias("at"), F.lit("").alias("out")), step, lambda a: a["out"])

    def joined_up(parts: Column) -> Column:
        ends = _running(F.transform(parts, lambda c: F.array_max(F.transform(c, lambda s: s["end"]))), F.greatest)
        n = F.size(parts)
        pieces = F.transform(F.arrays_zip(parts.alias("c"), F.slice(ends, 1, n).alias("at"), F.slice(ends, 2, n).alias("to")), piece)
        return F.concat(F.array_join(pieces, ""), F.substring(t, F.element_at(ends, -1) + 1, F.length(t)))

    masked = _let(ordered, lambda o: _let(_chunks(o), joined_up))
    return with_spans(docs, text, doc_id, rule, out).withColumn(
        text, F.when(F.size(out) > 0, masked).otherwise(t)).select(*(col(c) for c in docs.columns))
