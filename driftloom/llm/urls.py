"""URL filters: host rules, and a weighted vocabulary counted by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import in_arrow

#: (host, path) -> verdict
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# Stems in English, German, French and Spanish; each stands for itself and with the endings below.
#: One of these as a whole word rejects a url.
STRICT = (
    "adult-x", "adultx", "blowjob", "camgirl", "camsex", "cracked", "escort", "erotik", "fetisch", "fetish", "gangbang", "hardcore", "hentai",
    "hure", "keygen", "livesex", "malware", "milf", "nsfw", "nudist", "phishing", "porn", "porno", "pornografia", "pornographie", "prostituta",
    "puta", "pute", "ransomware", "serialz", "sexcam", "sexo", "sexshop", "spyware", "stripper", "swinger", "viagra", "cialis", "warez",
    "x-rated", "xxx",
)
#: So many different ones of these reject it.
SOFT = (
    "ad", "adult", "affiliate", "apuesta", "barato", "bet", "betting", "billig", "bingo", "blackjack", "bonus", "buy", "casino", "cheap", "click",
    "comprar", "coupon", "crack", "credit", "crypto", "cupon", "dating", "descarga", "diet", "download", "earn", "erotic", "erotique", "flirt",
    "free", "gambling", "gamble", "geld", "generic", "gewinn", "gewinnspiel", "girl", "gluecksspiel", "gratis", "gratuit", "hack", "hot", "jackpot",
    "kasino", "kaufen", "kostenlos", "kredit", "loan", "lotterie", "lottery", "loteria", "loterie", "lotto", "mature", "nackt", "nude", "offer",
    "pari", "payday", "pharmacy", "pill", "pillen", "pilule", "pirate", "poker", "popup", "prestamo", "pret", "prize", "promo", "rabatt",
    "replica", "roulette", "sale", "serial", "sex", "sexy", "singles", "slot", "soldes", "spam", "spiel", "steroid", "stream", "teen", "torrent",
    "track", "tracker", "tracking", "tragamonedas", "weightloss", "wette", "win", "winner",
)
ENDINGS = ("", "s", "es", "e", "n", "en")
SOFT_LIMIT = 2


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null.

    A rule fits its host and the hosts below it, if the path begins with its path. Among rules of
    equal length the first one stands.
    """
    found = F.lit(None)
    order = sorted(range(len(rules)), key=lambda i: (len(rules[i][0] + rules[i][1]), -i))
    for i in order:  # the last branch put on is the first one tried
        name, start, verdict = rules[i]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def automaton(strict=STRICT, soft=SOFT, endings=ENDINGS) -> ahocorasick.Automaton:
    """Every stem with every ending; a form that two stems share belongs to the strict one, else to the shorter one."""
    machine = ahocorasick.Automaton()
    for stems, is_strict in ((soft, False), (strict, True)):
        for stem in sorted(stems, key=len, reverse=True):
            for ending in sorted(endings, key=len, reverse=True):
                machine.add_word(stem + ending, (len(stem + ending), stem, is_strict))
    if len(machine):
        machine.make_automaton()
    return machine


def _ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)


def _bare(text: str, at: int) -> bool:
    """No ASCII letter or digit stands at that place."""
    return not (0 <= at < len(text) and text[at].isascii() and text[at].isalnum())


def term_hits(machine: ahocorasick.Automaton, url: str) -> tuple[int, int]:
    """Different strict and different soft stems, a form of which stands as a word of its own."""
    if not len(machine):
        return 0, 0
    text, strict, soft = _ascii_lower(url), set(), set()
    for last, (length, stem, is_strict) in machine.iter(text):
        if _bare(text, last + 1) and _bare(text, last - length):
            (strict if is_strict else soft).add(stem)
    return len(strict), len(soft)


def _counter(url_at: int, strict, soft):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(strict, soft)
        for batch in batches:
            hits = [term_hits(machine, u or "") for u in batch.column(url_at).to_pylist()]
            new = [pa.array([h[k] for h in hits], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [f"c{i}" for i in range(batch.num_columns + 2)])

    return count


def judge_urls(
    pages: DataFrame,
    url_col: str = "url",
    rules=RULES,
    strict=STRICT,
    soft=SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """All columns of ``pages``, then host, path, rule, n_strict, n_soft and verdict (allow or block).

    The longest fitting rule decides. Without one, a url is blocked if it holds one strict term or
    ``soft_limit`` different soft terms; a term counts, bare or with one of ``ENDINGS``, where neither side
    has an ASCII letter or digit. One scan, no shuffle; vocabulary and rules are parameters
    and travel with the tasks.

    A null url, or one without ://, has an empty host and path; terms of the latter still
    count, a null url is allowed. Columns of ``pages`` with the name of a new one are
    dropped. Repeated rows are each judged; an empty table gives an empty result.
    """
    new = ("host", "path", "rule", "n_strict", "n_soft", "verdict")
    rows = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in new])
    types = [f.dataType.simpleString() for f in rows.schema.fields]
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate([*types, "long", "long"]))
    counted = in_arrow(rows, _counter(rows.columns.index(url_col), strict, soft), schema).toDF(*rows.columns, "n_strict", "n_soft")
    split = counted.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    ruled = split.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules)) if rules else split.withColumn("found", F.lit(None).cast("struct<rule:string,verdict:string>"))
    by_terms = F.when((F.col("n_strict") > 0) | (F.col("n_soft") >= soft_limit), "block").otherwise("allow")
    return ruled.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        "host", "path", F.col("found.rule").alias("rule"), "n_strict", "n_soft",
        F.coalesce("found.verdict", by_terms).alias("verdict"),
    )
