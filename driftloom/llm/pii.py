"""Personal data: base patterns, and bootstrapped contextual extraction.

Spark SQL functions only. A match list does not tell positions, so each
text is also split by the same pattern: the lengths of pieces and matches add up
to the offsets, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import cut

KINDS = ("email", "ip", "card", "phone")

# A match begins where its characters begin or where the last match ended; groups are possessive. That leaves the
# matches of the plain patterns as they are, and keeps the time linear for texts of any kind.
_LOCAL = r"A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9])++",
}
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_GATE = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9]", "phone": r"[+][0-9]"}
#: what may be an identifier, though no base pattern has it
CANDIDATE = (
    r"\+[0-9]{1,3}+[ .-]?\(?[0-9]{2,4}+\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z.+-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z.])[0-9]{8,19}+(?![0-9A-Za-z])"
    r"|[A-Za-z0-9][A-Za-z0-9._-]{0,63}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}+)++"
)
CONTEXT = 40
ROUNDS = 2
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.75
MIN_SCORE = 0.8
SMOOTHING = 0.5
_FOUND = "array<struct<start:long,end:long,surface:string>>"


def located(text: Column, pattern: str) -> Column:
    """array of (start, end, surface) of the pattern's matches; offsets in code points, end exclusive."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    pairs = F.zip_with(pieces, matches, lambda p, m: F.struct(F.length(p).cast("long").alias("gap"), m.alias("m")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_FOUND).alias("found"))

    def add(s: Column, x: Column) -> Column:
        begin = s["at"] + x["gap"]
        end = begin + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(s["found"], F.array(F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("surface")))).alias("found"))

    return F.aggregate(pairs, start, add, lambda s: s["found"])


def digits_of(surface: Column) -> Column:
    return F.regexp_replace(surface, "[^0-9]", "")


def valid(kind: str, surface: Column) -> Column:
    """The check of a kind: octets up to 255, 16 to 19 digits that pass Luhn, 8 to 15 digits."""
    n = F.length(digits_of(surface))
    if kind == "ip":
        return surface.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return n.between(16, 19) & F.call_function("luhn_check", digits_of(surface))
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def _plausible(kind: Column, surface: Column) -> Column:
    """What the method adds must pass the check of its kind, and an address must have an at."""
    return (
        F.when(kind == 0, surface.rlike(r"[\[(]at[\])]"))
        .when(kind == 1, valid("ip", surface))
        .when(kind == 2, valid("card", surface))
        .otherwise(valid("phone", surface) & ~surface.rlike(r"[A-Za-z]|^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"))
    )


def shape_of(surface: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(surface, "[A-Za-z]+", "a"), "[0-9]", "9")


def _patterns(text: Column, span: Column) -> Column:
    """The word before, the word after, and the shape of a mention."""
    before = F.substring(text, F.greatest(span["start"] - CONTEXT, F.lit(0)).cast("int") + 1, F.least(span["start"], F.lit(CONTEXT)).cast("int"))
    after = F.substring(text, span["end"].cast("int") + 1, F.lit(CONTEXT))
    return F.array(
        F.concat(F.lit("before "), F.lower(F.regexp_extract(before, r"(\S+)\s*$", 1))),
        F.concat(F.lit("after "), F.lower(F.regexp_extract(after, r"^\s*(\S+)", 1))),
        F.concat(F.lit("shape "), shape_of(span["surface"])),
    )


def _checked(number: int, kind: str) -> Column:
    """The matches of a kind that pass its check, with the kind."""
    good = F.filter(kind, lambda s: valid(kind, s["surface"]))
    return F.transform(
        good, lambda s: F.struct(F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["surface"].alias("surface"))
    )


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, base, seeds, others): spans of the base patterns, and mentions with their patterns.

    ``base`` is an array of (kind, start, end), kind as a place in ``KINDS``; ``seeds``
    holds the same spans with surface and patterns, ``others`` the candidates that touch no base span. Texts without digits and at signs are
    passed over by a cheap test.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select("id", text.alias("text"), F.xxhash64(text).alias("text_hash"))
    none = F.array().cast(_FOUND)
    for kind in KINDS:
        rows = rows.withColumn(kind, F.when(F.col("text").rlike(_GATE[kind]), located(F.col("text"), BASE[kind])).otherwise(none))
    rows = rows.withColumn("others", F.when(F.col("text").rlike(r"[0-9]{3}|[\[(]at[\])]"), located(F.col("text"), CANDIDATE)).otherwise(none))
    parts = [_checked(number, kind) for number, kind in enumerate(KINDS)]
    rows = rows.select("id", "text", "text_hash", "others", F.concat(*parts).alias("found"))
    apart = F.filter("others", lambda o: ~F.exists("found", lambda s: (s["start"] < o["end"]) & (o["start"] < s["end"])))
    rows = rows.select("id", "text", "text_hash", "found", apart.alias("others"))
    return rows.select(
        "id",
        "text_hash",
        F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("base"),
        F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["surface"].alias("surface"), _patterns(F.col("text"), s).alias("patterns"))).alias("seeds"),
        F.transform(
            "others",
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["surface"].alias("surface"), _patterns(F.col("text"), s).alias("patterns")),
        ).alias("others"),
    )


def discover(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(surface, kind) of candidates that high-confidence patterns vouch for.

    A bipartite graph ties patterns to the surfaces they occur with, each pair once however
    often it occurs. Base matches score 1. In each round a pattern's confidence in a kind is the score that its surfaces
    have in that kind, over their number (smoothed); patterns of enough support and confidence then give their
    candidates a score, combined as independent evidence. Candidates over ``MIN_SCORE`` that pass the check of the kind
    are taken up and count as entities in the next round.
    """
    seeds = found.select(F.explode("seeds").alias("m")).select("m.kind", "m.surface", F.explode("m.patterns").alias("pattern")).distinct()
    others = found.select(F.explode("others").alias("m")).select("m.surface", F.explode("m.patterns").alias("pattern")).distinct()
    seeds, others = cut(seeds, "seeds"), cut(others, "candidates")
    edges = cut(seeds.select("surface", "pattern").union(others.select("surface", "pattern")).distinct(), "graph")
    degree = edges.groupBy("pattern").agg(F.count("*").alias("degree"))
    entities = seeds.select("surface", "kind").distinct().withColumn("score", F.lit(1.0))
    added = None
    for _ in range(rounds):
        held = edges.join(entities, "surface").groupBy("pattern", "kind").agg(F.sum("score").alias("held"), F.count("*").alias("support"))
        sure = held.join(degree, "pattern").select("pattern", "kind", "support", (F.col("held") / (F.col("degree") + SMOOTHING)).alias("confidence"))
        sure = sure.where((F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE))
        scored = others.join(sure, "pattern").groupBy("surface", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.999)))))).alias("score"))
        added = cut(scored.where((F.col("score") >= MIN_SCORE) & _plausible(F.col("kind"), F.col("surface"))), "discovered")
        entities = seeds.select("surface", "kind").distinct().withColumn("score", F.lit(1.0)).union(
            added.join(seeds.select("surface", "kind"), ["surface", "kind"], "left_anti").select("surface", "kind", "score")
        )
    best = added.groupBy("surface").agg(F.max(F.struct("score", (-F.col("kind")).alias("rank"))).alias("b"))
    return best.select("surface", (-F.col("b.rank")).cast("int").alias("kind"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(id, text_hash, base, spans) of each row: arrays of (kind, start, end), sorted.

    ``base`` has the matches of the base patterns, leftmost and non-overlapping
    per kind; ``spans`` also those that the method adds. Offsets are code points, end exclusive; kind is a place in
    ``KINDS``.

    One scan of the texts; the shuffles carry mentions, patterns and ids. The graph is aggregated with partial sums, so a
    frequent pattern is no single task.

    Null text counts as empty. Rows with a null id are searched like others. Repeated rows each get the same result. An
    empty table gives an empty result; further columns are ignored.
    """
    found = cut(mentions(docs, id_col, text_col), "mentions")
    known = discover(found, rounds)
    spots = found.where(F.size("others") > 0).select("id", "text_hash", F.explode("others").alias("m")).select("id", "text_hash", "m.start", "m.end", "m.surface")
    extra = spots.join(known, "surface").groupBy("id", "text_hash").agg(F.collect_set(F.struct("kind", "start", "end")).alias("extra"))
    extra = extra.select(F.col("id").alias("x_id"), F.col("text_hash").alias("x_hash"), "extra")
    joined = found.join(extra, F.col("id").eqNullSafe(F.col("x_id")) & (F.col("text_hash") == F.col("x_hash")), "left")
    every = F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast("array<struct<kind:int,start:long,end:long>>"))))
    return joined.select(F.col("id").alias(id_col), "text_hash", F.array_sort("base").alias("base"), every.alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, such as <EMAIL>.

    Of overlapping spans the first one names the kind, and the union is replaced. Other columns and null texts stay as
    they are.
    """
    marked = find_pii(docs, id_col, text_col, rounds).where(F.size("spans") > 0)
    places = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    marks = F.struct(F.col(id_col).alias("id"), F.col("text_hash").alias("hash"), F.array_sort(places).alias("places"))
    marked = marked.dropDuplicates([id_col, "text_hash"]).select(marks.alias("m")).alias("x")
    # the names of ``docs`` are out of reach behind one struct, so none can clash
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")).alias("y")
    text, mark = F.col("y.d")[text_col], F.col("x.m")
    hashed = F.xxhash64(F.coalesce(text, F.lit("")))
    joined = whole.join(marked, F.col("y.d")[id_col].eqNullSafe(mark["id"]) & (hashed == mark["hash"]), "left")
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(s: Column, x: Column) -> Column:
        fresh = F.concat(s["out"], F.substring(text, s["at"].cast("int") + 1, (x["start"] - s["at"]).cast("int")), F.element_at(tags, x["kind"] + 1))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(x["start"] < s["at"], s["out"]).otherwise(fresh).alias("out"))

    masked = F.aggregate(mark["places"], start, add, lambda s: F.concat(s["out"], F.substring(text, s["at"].cast("int") + 1, F.length(text))))
    clean = F.when(mark.isNull(), text).otherwise(masked)
    return joined.select(*[(clean if c == text_col else F.col("y.d")[c]).alias(c) for c in docs.columns])
