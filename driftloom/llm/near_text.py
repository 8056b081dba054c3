"""Near-duplicate documents: MinHash signatures, banding, verification, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import cut, in_arrow
from .words import Texts, mix, sliced, windows

WIDTH = 5
BAND_ROWS = 5
MISS = 1e-6  # odds that no band of a pair at the threshold agrees
SPREADS = 5.0  # standard deviations that a signature may fall short of the threshold
MEMBERS_PER_SALT = 256
_CHUNK = 2048


def shingle_set(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the word windows; of the whole sequence if it is shorter; empty without words."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return mix(windows(words, len(words)) + np.uint64(len(words)))
    return np.unique(windows(words, width))


def shingle_sets(texts: Texts, width: int = WIDTH) -> Iterator[np.ndarray]:
    hashes = texts.word_hashes()
    for i in range(len(texts)):
        yield shingle_set(hashes[texts.words[i] : texts.words[i + 1]], width)


class Minima:
    """``n`` universal hash functions x -> a * x + b modulo 2 ** 64, of which the upper 32 bits count."""

    def __init__(self, n: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2**63, (n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, (n, 1), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, (n, 1), dtype=np.uint64)

    def of(self, members: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(members), _CHUNK):
            np.minimum(least, (self.a * members[at : at + _CHUNK] + self.b).min(axis=1), out=least)
        return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def band_count(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold**BAND_ROWS))


def _signer(id_type: pa.DataType, n: int, width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = Minima(n)
        for batch in batches:
            sizes, one, two, sig = [], [], [], []
            for _, texts in sliced(batch.column(1), lower=True):
                for members in shingle_sets(texts, width):
                    sizes.append(len(members))
                    one.append(members.sum(dtype=np.uint64))
                    two.append(mix(members ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                    sig.append(minima.of(members) if len(members) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(one, np.uint64).view(np.int64)),
                    pa.array(np.array(two, np.uint64).view(np.int64)),
                    pa.array(sig, pa.list_(pa.int32())),
                ],
                ["id", "n", "h1", "h2", "sig"],
            )

    return sign


def _comparer(over: int, under: int, width: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by hub, salt and role: a hub's own text, then the texts to hold against it."""
        hub, hub_set = None, None
        for batch in batches:
            hubs, roles = batch.column(0).to_pylist(), batch.column(2).to_numpy()
            ids, found = batch.column(3).to_pylist(), []
            for at, texts in sliced(batch.column(4), lower=True):
                for i, members in enumerate(shingle_sets(texts, width), at):
                    if roles[i] == 0:
                        hub, hub_set = hubs[i], members
                    elif hub == hubs[i]:
                        both = len(np.intersect1d(hub_set, members, assume_unique=True))
                        if under * both >= over * (len(hub_set) + len(members) - both):
                            found.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(found, pa.int64())), batch.column(3).take(pa.array(found, pa.int64()))], ["a", "b"])

    return compare


def _block_comparer(over: int, under: int, width: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket, block and role: a block of strays, then all members to hold against them.

        Strays stand in one inverted index, so a member meets all of them in one
        look-up. Parts found to be linked are not compared again.
        """
        block, strays, index = None, [], None
        joined: dict = {}

        def top(part):
            while part in joined:
                part = joined[part]
            return part

        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            roles, ids, parts = batch.column(2).to_numpy(), batch.column(3).to_pylist(), batch.column(4).to_pylist()
            found: tuple[list, list] = ([], [])
            for at, texts in sliced(batch.column(5), lower=True):
                for i, members in enumerate(shingle_sets(texts, width), at):
                    if keys[i] != block:
                        block, strays, index, joined = keys[i], [], None, {}
                    if roles[i] == 0:
                        strays.append((ids[i], parts[i], members))
                        continue
                    if index is None:
                        sizes = np.array([len(m) for _, _, m in strays])
                        owner = np.repeat(np.arange(len(strays)), sizes)
                        flat = np.concatenate([m for _, _, m in strays]) if strays else np.zeros(0, np.uint64)
                        order = np.argsort(flat, kind="stable")
                        index = flat[order], owner[order], sizes
                    flat, owner, sizes = index
                    low, high = np.searchsorted(flat, members), np.searchsorted(flat, members, side="right")
                    many = high - low
                    spots = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                    both = np.bincount(owner[spots], minlength=len(strays)) if len(spots) else np.zeros(len(strays), np.int64)
                    for k in np.flatnonzero(under * both >= over * (sizes + len(members) - both)):
                        other, part = top(strays[k][1]), top(parts[i])
                        if other != part:
                            joined[other] = part
                            found[0].append(strays[k][0])
                            found[1].append(ids[i])
            kind = batch.schema.field(3).type
            yield pa.RecordBatch.from_arrays([pa.array(found[0], kind), pa.array(found[1], kind)], ["a", "b"])

    return compare


class _Verifier:
    """Holds documents against each other: by signature, then by their full sets of shingles."""

    def __init__(self, texts: DataFrame, signed: DataFrame, over: int, under: int, width: int, n: int):
        self.texts, self.signed = texts, signed
        self.over, self.under, self.width = over, under, width
        t = over / under
        self.agree = max(1, math.floor(n * t - SPREADS * math.sqrt(n * t * (1 - t))))
        self.kind = dict(texts.dtypes)["id"]

    def signed_alike(self, pairs: DataFrame) -> DataFrame:
        """The pairs with enough equal minima for the threshold, give or take ``SPREADS`` standard deviations."""
        side = lambda k: self.signed.select(F.col("rep").alias(k), F.col("sig").alias(f"sig_{k}"))
        same = F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int"))
        alike = F.aggregate(same, F.lit(0), lambda s, x: s + x) >= self.agree
        return pairs.join(side("a"), "a").join(side("b"), "b").where(alike).select("a", "b")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets reach the threshold.

        A hub's text is sent once per ``MEMBERS_PER_SALT`` partners, partners
        stream past it one by one.
        """
        pairs = cut(pairs, "pairs")
        many = pairs.groupBy("a").agg(F.count("*").alias("many"))
        salted = pairs.join(many, "a").select(
            "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("many") / MEMBERS_PER_SALT)).cast("int").alias("salt")
        )
        roles = salted.select("a", "salt", F.lit(1).alias("role"), F.col("b").alias("id")).union(
            salted.select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("id")).distinct()
        )
        rows = roles.join(self.texts, "id").select("a", "salt", "role", "id", "text")
        rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
        return in_arrow(rows, _comparer(self.over, self.under, self.width), f"a {self.kind}, b {self.kind}")

    def linked_across(self, placed: DataFrame) -> DataFrame:
        """Links between parts of the same bucket, from (key, id, part).

        Members outside a bucket's largest part are its strays, dealt to blocks of about ``MEMBERS_PER_SALT``. All members
        of the bucket stream past each block, so every pair of members from different parts is
        compared, while rows grow with members times blocks, not with pairs.
        """
        counts = placed.groupBy("key", "part").agg(F.count("*").alias("n"))
        largest = counts.groupBy("key").agg(
            F.max(F.struct("n", "part")).alias("main"), F.sum("n").alias("all"), F.count("*").alias("parts")
        ).where("parts > 1")
        blocks = F.ceil((F.col("all") - F.col("main.n")) / MEMBERS_PER_SALT).cast("int")
        mixed = cut(placed.join(largest.select("key", "main", blocks.alias("blocks")), "key"), "mixed")
        strays = mixed.where(F.col("part") != F.col("main.part")).select(
            "key", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role"), "id", "part"
        )
        stream = mixed.select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "id", "part")
        rows = strays.union(stream).join(self.texts, "id").select("key", "block", "role", "id", "part", "text")
        rows = rows.repartition("key", "block").sortWithinPartitions("key", "block", "role")
        return in_arrow(rows, _block_comparer(self.over, self.under, self.width), f"a {self.kind}, b {self.kind}")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    over: int = 80,
    under: int = 100,
    width: int = WIDTH,
) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of at least ``over / under`` of their shingles.

    Returns, for each row of ``docs``: the id, n_shingles, component_id
    (smallest id reachable over links, itself included) and kept (id equals
    component_id).

    Plan: one pass hashes each whole text to its distinct shingles, a checksum
    of that set and MinHash signature. Equal sets fall together by checksum
    first, so copies cost nothing more. Signatures of the different sets are
    cut in bands; in each bucket all members are held against the smallest
    id, by signature and then by full sets. Where that leaves a bucket in several
    components, all pairs across them are compared by full sets as well, so the buckets are
    searched in full. Components come from large-star and small-star.

    A null or empty text, or one without words, has no shingle and is linked
    with nothing. Fewer words than ``width`` form one shingle. Rows with a null id are
    linked with nothing, have a null component and are kept. An id is meant to
    name one text: repeated rows get equal results, and rows that share an id but
    not a text each get the component of their own text. An empty table gives an
    empty result. Other columns, whatever their names, are ignored.
    """
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    t = over / under
    bands = band_count(t)
    n = bands * BAND_ROWS
    signed = cut(in_arrow(texts, _signer(pa.int64(), n, width), f"id {kind}, n long, h1 long, h2 long, sig array<int>"), "signed")
    classes = cut(
        signed.where("n > 0 and id is not null").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.first("sig").alias("sig")),
        "classes",
    )
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.slice("sig", i * BAND_ROWS + 1, F.lit(BAND_ROWS))))
    banded = classes.select("rep", F.explode(keys).alias("key"))
    hubs = banded.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = cut(banded.join(hubs, "key"), "members")
    # The side of ids grows with the data, so the texts are joined the same way at any size; only
    # those of bucket members go on.
    wanted = members.select(F.col("rep").alias("id")).distinct()
    own = texts.where("id is not null and text is not null").join(wanted.hint("merge"), "id")
    check = _Verifier(cut(own, "texts"), classes.select("rep", "sig"), over, under, width, n)
    first = members.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    edges = cut(check.linked(check.signed_alike(first)), "links")
    found = components(edges)

    placed = members.where("size > 2").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", F.col("rep").alias("id"), F.coalesce("component", "rep").alias("part")
    )
    more = cut(check.linked_across(placed), "links")
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more.select("a", "b")))

    final = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("component")
    )
    grouped = F.col("n") > 0
    keyed = grouped & F.col("id").isNotNull()
    out = signed.select(  # rows without a class are spread over all tasks
        "id", "n", F.when(keyed, F.col("h1")).alias("h1"), F.when(keyed, F.col("h2")).otherwise(F.xxhash64("id")).alias("h2")
    ).join(final, ["h1", "h2"], "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
