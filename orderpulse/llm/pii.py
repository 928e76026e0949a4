"""Personal data by base rules and bootstrapped contextual extraction, in built-in functions.

The base rules find e-mail addresses, IP addresses, card and phone numbers by form. What they
find are the seed entities. Every identifier-like string of the corpus is an instance; the word
before it and the kind of its form are its context. Contexts that hold seeds are patterns. In
rounds, a pattern of a kind is as trustworthy as the instances it holds, counted once each, and
an instance as the best pattern that holds it; instances that have become trustworthy count as
seeds of their other contexts, which so become patterns of the next round. Instances that no base rule accepts but trustworthy
patterns do (a card number with a slip in a digit, a number without its country code, an
address written with "[at]") are added as spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderpulse.llm.common import saved

KINDS = ("email", "ip", "card", "phone")
#: The base forms. Possessive repeats match what greedy ones match here, without recursion; a
#: match of an address begins where a run of its characters does, or where the last one ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a base form to be looked for at all.
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Identifier-like strings: numbers with separators, and names with an at sign or a stand-in.
NUMBER = r"(?<![A-Za-z0-9+(.])\+?\(?[0-9][0-9().\x20-]{5,}[0-9](?![A-Za-z0-9])"
HANDLE = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,}+(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9.-]{3,}+"
#: White space around the word before an instance.
SPACES = " \t\n\x0b\x0c\r"
#: Seeds that a pattern needs, trust that adds a span, and rise of all trust that ends the rounds.
SUPPORT, TRUST, SETTLED = 5, 0.9, 1e-3
#: In the order that spans are sorted by.
SPAN = "struct<start:int,kind:int,end:int>"
FOUND = "struct<start:int,end:int,value:string,before:string>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True if the weighted digit sum is a multiple of ten."""
    size = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), size), F.lit(0),
        lambda acc, i: acc + F.when((size - i) % 2 == 0, F.substring(digits, i, 1).cast("int"))
        .otherwise(F.when(F.substring(digits, i, 1).cast("int") > 4,
                          F.substring(digits, i, 1).cast("int") * 2 - 9)
                   .otherwise(F.substring(digits, i, 1).cast("int") * 2)))
    return total % 10 == 0


def _accepted(kind: str, match: Column) -> Column:
    """True if a match of the base form is one of the kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.coalesce(
            (F.length(F.ltrim(part, F.lit("0"))) <= 3)
            & (F.coalesce(F.right(part, F.lit(3)).try_cast("int"), F.lit(999)) <= 255), F.lit(False)))
    digits = _digits(match)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))


def _walk(text: Column, form: str, empty: str, made, wanted) -> Column:
    """Fold over the matches of a form and the gaps before them, with the place in code points.

    ``made`` gives the element of a match from (start, end, match, gap), ``wanted`` tells
    whether it is kept.
    """
    gaps, found = F.split(text, form, -1), F.regexp_extract_all(text, F.lit(form), F.lit(0))
    state = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{empty}>)").alias("out"))

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        return F.struct(end.alias("at"), F.when(
            wanted(x["match"]), F.concat(acc["out"], F.array(made(start, end, x["match"], x["gap"]))))
            .otherwise(acc["out"]).alias("out"))

    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("match"))
    return F.aggregate(pairs, state, step, lambda acc: acc["out"])


def base_spans(text: Column) -> Column:
    """array of (start, kind, end) of the base rules, by start and then kind."""
    parts = []
    for number, kind in enumerate(KINDS):
        spans = _walk(
            text, BASE[kind], SPAN,
            lambda start, end, match, gap, n=number: F.struct(
                start.alias("start"), F.lit(n).alias("kind"), end.alias("end")),
            lambda match, k=kind: _accepted(k, match))
        some = (text.contains(NEEDED[kind]) if NEEDED[kind] else text.rlike("[0-9]"))
        if kind in ("ip", "phone"):
            some = some & text.rlike("[0-9]")
        parts.append(F.when(some, spans).otherwise(F.expr(f"cast(array() as array<{SPAN}>)")))
    return F.array_sort(F.concat(*parts))


def _instances(text: Column) -> Column:
    """array of (start, end, value, word before) of the identifier-like strings of a text."""
    def made(start, end, match, gap):
        word = F.lower(F.element_at(F.split(F.rtrim(gap, F.lit(SPACES)), r"[ \t\n\x0b\f\r]"), -1))
        return F.struct(start.alias("start"), end.alias("end"),
                        F.lower(match).alias("value"), word.alias("before"))

    parts = []
    for form, some in ((NUMBER, text.rlike("[0-9]")),
                       (HANDLE, text.contains("@") | text.rlike(r"[\[(]at[\])]"))):
        parts.append(F.when(some, _walk(text, form, FOUND, made, lambda match: F.lit(True)))
                     .otherwise(F.expr(f"cast(array() as array<{FOUND}>)")))
    return F.concat(*parts)


def _fits(kind: Column, value: Column) -> Column:
    """True if an instance has the rough form of a kind."""
    n = F.length(_digits(value))
    return (F.when(kind == 0, value.rlike(r"@|[\[(]at[\])]"))
            .when(kind == 1, value.rlike(r"^[0-9]{1,3}([ .-]+[0-9]{1,3}){3}$"))
            .when(kind == 2, n.between(12, 19) & ~value.contains("+") & ~value.contains("("))
            .otherwise(n.between(7, 15)))


def scored_instances(edges: DataFrame, support: int = SUPPORT,
                     bound: float = TRUST) -> DataFrame:
    """(value, kind, trust) of the instances of the graph that are no seeds.

    ``edges`` are distinct (before, value, seed): the context, the instance, and the kind that
    the base rules gave it or null. In each round the patterns are built anew: contexts that
    hold at least ``support`` seeds of a kind, instances whose trust has reached ``bound``
    included. The trust of a pattern is the mean trust of its instances, those of other kinds
    counting as zero. The trust of an instance is that of its best pattern, so contexts that
    are no patterns take nothing from it. Trust only rises, and the rounds end when no instance
    has reached the bound and all trust together has risen by less than SETTLED.
    """
    contexts = edges.groupBy("before").agg(
        F.count("*").alias("all"),
        *(F.sum((F.col("seed") == k).cast("long")).alias(f"k{k}") for k in range(len(KINDS))))
    seeds = saved(contexts.select("before", "all", F.explode(F.array(*(
        F.struct(F.lit(k).alias("kind"), F.coalesce(F.col(f"k{k}"), F.lit(0)).alias("seeds"))
        for k in range(len(KINDS))))).alias("s")).select("before", "all", "s.*"), "pii-contexts")
    kinds = F.explode(F.array(*map(F.lit, range(len(KINDS)))))
    links = saved(edges.filter("seed is null").select("before", "value", kinds.alias("kind"))
                  .filter(_fits(F.col("kind"), F.col("value"))), "pii-links")
    trust = links.select("value", "kind").distinct().withColumn("trust", F.lit(0.0))
    known, total = -1, 0.0
    while True:
        held = links.join(trust, ["value", "kind"]).groupBy("before", "kind").agg(
            F.sum("trust").alias("given"), F.count_if(F.col("trust") >= bound).alias("known"))
        patterns = held.join(seeds, ["before", "kind"]).filter(
            F.col("seeds") + F.col("known") >= support).select(
            "before", "kind", ((F.col("seeds") + F.col("given")) / F.col("all")).alias("p"))
        # Of what the context holds besides seeds, each instance gets the benefit of the seeds.
        trust = saved(links.join(patterns, ["before", "kind"]).groupBy("value", "kind").agg(
            F.max("p").alias("trust")), "pii-trust")
        now = trust.agg(F.count_if(F.col("trust") >= bound).alias("known"),
                        F.coalesce(F.sum("trust"), F.lit(0.0)).alias("total")).first()
        if now.known == known and now.total - total < SETTLED:
            return trust
        known, total = now.known, now.total


def find(docs: DataFrame, trust: float = TRUST) -> DataFrame:
    """(doc_id, text_hash, base, spans) of every row: spans of the base rules, and all spans.

    Spans are (start, kind number, end) in code points, end exclusive, sorted by start and
    kind. Null text counts as empty. Added spans never overlap those of the base. Rows are told
    by doc_id and text hash, so null and repeated ids are served too; repeated rows give
    repeated results. Other columns are not looked at.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text.alias("text"))
    read = saved(rows.select("doc_id", "text_hash", base_spans(F.col("text")).alias("base"),
                             _instances(F.col("text")).alias("found")), "pii")
    seen = read.filter(F.size("found") > 0).select("doc_id", "text_hash", "base",
                                                   F.explode("found").alias("f"))
    over = F.filter("base", lambda b: (b["start"] < F.col("f.end")) & (b["end"] > F.col("f.start")))
    seen = seen.select("doc_id", "text_hash", "f.start", "f.end", "f.before",
                       F.regexp_replace("f.value", r"[\s().-]", "").alias("plain"),
                       F.col("f.value").alias("value"), F.get(over, F.lit(0))["kind"].alias("seed"))
    edges = saved(seen.groupBy("before", "value").agg(F.max("seed").alias("seed")), "pii-edges")
    chosen = scored_instances(edges, bound=trust).filter(F.col("trust") >= trust).groupBy("value").agg(
        F.max_by("kind", F.struct("trust", -F.col("kind"))).alias("kind"))
    added = (seen.filter("seed is null").join(chosen, "value")
             .groupBy("doc_id", "text_hash")
             .agg(F.collect_set(F.struct("start", "kind", "end")).alias("added")))
    joined = read.alias("r").join(added.alias("a"), F.col("r.doc_id").eqNullSafe(F.col("a.doc_id"))
                                  & (F.col("r.text_hash") == F.col("a.text_hash")), "left")
    return joined.select("r.doc_id", "r.text_hash", "base", F.when(
        F.col("added").isNull(), F.col("base")).otherwise(
        F.array_sort(F.concat("base", "added"))).alias("spans"))


def count_of(spans: Column, kind: str) -> Column:
    """How many of the spans are of a kind."""
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda span: span["kind"] == number)).cast("long")


def kind_name(kind: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", kind_name(s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind in capitals and angle brackets.

    Overlapping spans become one mark, that of the first. Other columns stay; n_chars, where
    there is one, is not counted anew. Null text stays null.
    """
    spans = (found.filter(F.size("spans") > 0).select("doc_id", "text_hash", "spans")
             .dropDuplicates(["doc_id", "text_hash"]))
    mark = docs.alias("d").join(
        spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
        & (F.xxhash64("d.text") == F.col("s.text_hash")), "left")
    text = F.col("d.text")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        free = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(free, F.concat(acc["out"], F.substring(
                text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"),
                F.upper(kind_name(s["kind"])), F.lit(">"))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(F.col("s.spans"), state, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return mark.select(*(F.when(F.col("s.spans").isNull(), text).otherwise(clean).alias("text")
                         if c == "text" else F.col(f"d.`{c}`") for c in docs.columns))
