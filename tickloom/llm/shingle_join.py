"""N-gram Jaccard join by PartEnum signatures, and the groups that its links make.

A document's set is its distinct five-word shingles. Sets are put in bands by size: a
band is for pairs whose smaller set has between ``low`` and ``high`` shingles, so it
also takes sets up to high / 0.8. Linked sets of a band differ in at most
k = high / 4 shingles. The domain is cut into n parts, in pairs (second level of two,
of which one may differ): two sets that differ in k shingles differ in at most k parts,
so they agree in n - k of them, and each part of a set is one signature. A part without
shingles says nothing and has no signature; a set with n - k empty parts or more, which
might agree with another in those alone, gets one signature that says so.

Links without all pairs of a bucket:

1. Signatures are counted; documents are read again for those that recur, told by a
   Bloom filter where that is small and by a join where it is not. Parts that agree are
   at least those with shingles less k, so a set with fewer recurring signatures links
   with nothing, and of the others the most frequent ones are left out. Of the
   sets in buckets of several the shingles are counted: what no other of them has is
   shared with none, so two sets share at most the smaller number of common shingles.
   Those that can link with nothing leave.
2. A bucket's members are compared with its head, once per pair: the set with the most
   room for differences, as it has many common shingles for its size. A member whose
   common shingles the head all has, and that links with a head of no more shingles,
   leaves: whatever links with it links with the head too. So of the edited copies of a
   text those stay that the head says nothing about. A bucket whose members are in one
   group by then is done, as its other links would join nothing. In those that stay open
   the shingles are counted again; more of them are common to none by now.
3. Buckets with few pairs of members of different groups, in proportion to their
   members, are compared whole, the pairs within the bound. In others the members with
   the most common shingles are compared with those of other groups. What is still open
   is dealt anew, by the signatures of another partition of the domain, under which
   linked sets agree somewhere too; after ``LEVELS`` partitions buckets stay as they are
   and lose the members compared in each round, four times as many as before, until none is open.

Sets travel for compared pairs only. Documents of equal sets are one class, named by
its smallest id, and are compared once. Groups are found by passing the smallest id
along links, on written tables.

Rows: a document without words or text has an empty set and links with nothing; with
fewer than five words its whole sequence is its one shingle. Rows with equal doc_id
count as one document, in one group; rows without doc_id link with nothing and have no
component. An empty table gives no rows. Memory: a slice of texts; pairs of sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import map_batches, mix, texts_of, written
from tickloom.llm.words import joined, lower_ascii, slices, words_of

SHINGLE, SHARED, OF = 5, 80, 100  # words; linked when OF * intersection >= SHARED * union
BAND = 1.6
# Buckets of up to half so many open pairs a member are compared whole; heads of others; partitions.
SMALL_BUCKET, HEADS, LEVELS = 64, 16, 2
# A broadcast is made below these sizes; beyond them there is a shuffle instead.
BROADCAST_IDS, BROADCAST_SIGNATURES = 2_000_000, 12_000_000
SALTS = 16  # places of the rows of a set that recurs
_SALT = np.uint64(0x9E3779B97F4A7C15)


def salt(n: int) -> np.uint64:
    return np.uint64((n * int(_SALT)) & (2**64 - 1))


class Sets:
    """Distinct shingle hashes of many texts: sorted within each, with offsets."""

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray):
        self.hashes, self.sizes = hashes, sizes
        self.first = np.concatenate([[0], np.cumsum(sizes)])

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of some sets and, for each hash, which of these rows it is of."""
        sizes = self.sizes[rows]
        owner = np.repeat(np.arange(len(rows)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.first[rows][owner]
        return self.hashes[place], owner


def sets_of(texts: list[bytes]) -> Sets:
    words = words_of([lower_ascii(t) for t in texts])
    counts = np.diff(words.first)
    owner = np.repeat(np.arange(len(texts)), counts)
    shingles = joined(words.hashes, SHINGLE)
    whole = np.flatnonzero(owner[:len(shingles)] == owner[SHINGLE - 1:]) if len(shingles) else np.zeros(0, dtype=np.int64)
    values, texts_at = [shingles[whole]], [owner[whole]]
    for n in range(1, SHINGLE):
        few = np.flatnonzero(counts == n)
        if len(few):
            values.append(joined(words.hashes, n)[words.first[few]] + np.uint64(n))
            texts_at.append(few)
    value, at = mix(np.concatenate(values)), np.concatenate(texts_at)
    order = np.lexsort((value, at))
    value, at = value[order], at[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1])
    return Sets(value[new], np.bincount(at[new], minlength=len(texts)))


def bands(largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowest and highest smaller size of each band, its k and number of parts."""
    low, high = [1], []
    while True:
        high.append(max(low[-1], int(BAND * low[-1])))
        if high[-1] >= largest:
            break
        low.append(high[-1] + 1)
    top = np.array(high, dtype=np.int64)
    k = top * (OF - SHARED) // SHARED
    # More parts than k, so that empty ones rarely matter; an even number.
    parts = np.maximum(k + 4, (3 * top + 7) // 8)
    return np.array(low, dtype=np.int64), top, k, parts + parts % 2


def signatures(sets: Sets, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and signature of every part that has shingles, in every band of its set;
    then per row how many of its signatures a linked set has too, at least.

    Of the parts of a set that have shingles at most k differ in a linked one.
    """
    least = np.full(len(sets.sizes), np.iinfo(np.int64).max)
    if not len(sets.hashes):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), least
    low, high, k, parts = bands(int(sets.sizes.max()))
    own = np.searchsorted(low, sets.sizes, side="right") - 1
    rows_out, out = [], []
    for back in range(3):
        band = own - back
        rows = np.flatnonzero((sets.sizes > 0) & (band >= 0))
        # Linked sets of a band with k = 0 are equal: one class already.
        rows = rows[(sets.sizes[rows] <= high[band[rows]] * OF // SHARED) & (k[band[rows]] > 0)]
        if not len(rows):
            continue
        hashes, owner = sets.take(rows)
        if seed:
            hashes = mix(hashes ^ salt(seed))
            order = np.lexsort((hashes, owner))
            hashes, owner = hashes[order], owner[order]
        of_band = band[rows]
        # Parts are ranges of the hash, so the sorted set lies part by part.
        part = ((hashes >> np.uint64(32)) * parts[of_band][owner].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(part), dtype=bool)
        new[1:] = (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(mix(hashes + _SALT), starts)
        name = mix(part[starts] + (of_band[owner[starts]].astype(np.uint64) << np.uint64(40)) + np.uint64(seed << 56))
        rows_out.append(rows[owner[starts]])
        out.append(mix(sums ^ name))
        filled = np.bincount(owner[starts], minlength=len(rows))
        least[rows] = np.minimum(least[rows], np.maximum(filled - k[of_band], 1))
        empty = parts[of_band] - filled
        risky = np.flatnonzero(empty >= parts[of_band] - k[of_band])
        rows_out.append(rows[risky])
        out.append(mix(of_band[risky].astype(np.uint64) + _SALT + np.uint64(seed << 56)))
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), least
    return np.concatenate(rows_out), np.concatenate(out), least


def packed(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u8")


def unpacked_sets(column: pa.Array) -> Sets:
    parts = [unpacked(x) for x in column.to_pylist()]
    return Sets(np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64), np.array([len(x) for x in parts], dtype=np.int64))


# --- Passes over the texts ------------------------------------------------------------

def over_sets(docs: DataFrame, schema: str, rows: Callable[[np.ndarray, Sets], list[pa.Array]]) -> DataFrame:
    """A map over the documents that have an id, slice by slice."""
    names = [x.split()[0] for x in schema.split(", ")]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = [t.encode() for t in texts_of(batch)], batch.column("doc_id").to_numpy()
            for a, b in slices(texts):
                yield pa.RecordBatch.from_arrays(rows(ids[a:b], sets_of(texts[a:b])), names)

    return map_batches(docs.select("doc_id", "text"), step, schema)


def sizes_and_keys(docs: DataFrame) -> DataFrame:
    """Per document the size of its set and two sums that name the set."""

    def rows(ids: np.ndarray, sets: Sets) -> list[pa.Array]:
        keys = []
        for salt in (np.uint64(1), np.uint64(2)):
            sums = np.zeros(len(ids), dtype=np.uint64)
            full = np.flatnonzero(sets.sizes)
            if len(full):
                sums[full] = np.add.reduceat(mix(sets.hashes + salt), sets.first[full])
            keys.append(pa.array(sums.view(np.int64)))
        return [pa.array(ids), pa.array(sets.sizes.astype(np.int64)), *keys]

    return over_sets(docs, "doc_id bigint, n_shingles bigint, c1 bigint, c2 bigint", rows)


class Bloom:
    """Whether a signature may recur: three bits in one of many blocks of 2 ** 16 bits."""

    BLOCK = 1 << 16

    def __init__(self, blocks: int):
        self.blocks = blocks
        self.bits = np.zeros((blocks, self.BLOCK // 8), dtype=np.uint8)

    @staticmethod
    def blocks_for(signatures: int) -> int:
        return max(1, -(-10 * signatures // Bloom.BLOCK))

    @staticmethod
    def block_of(values: np.ndarray, blocks: int) -> np.ndarray:
        return (mix(values) % np.uint64(blocks)).astype(np.int64)

    @staticmethod
    def places(values: np.ndarray) -> list[np.ndarray]:
        far = mix(values + _SALT)
        return [((far >> np.uint64(16 * n)) & np.uint64(0xFFFF)).astype(np.int64) for n in range(3)]

    def test(self, values: np.ndarray) -> np.ndarray:
        block, found = self.block_of(values, self.blocks), np.ones(len(values), dtype=bool)
        for place in self.places(values):
            found &= (self.bits[block, place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
        return found


def bloom_of(signatures_: DataFrame, n: int) -> Bloom:
    """Blocks are filled by the executors; the driver gets their bits, of checked size."""
    blocks = Bloom.blocks_for(n)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("bucket").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(Bloom.block_of(values, blocks), type=pa.int32())], ["bucket", "block"])

    def filled(key: tuple, table: pa.Table) -> pa.Table:
        bits = np.zeros(Bloom.BLOCK, dtype=bool)
        for place in Bloom.places(table.column("bucket").to_numpy().view(np.uint64)):
            bits[place] = True
        return pa.table({"block": pa.array([key[0].as_py()], type=pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], type=pa.binary())})

    out = Bloom(blocks)
    rows = map_batches(signatures_, dealt, "bucket bigint, block int").groupBy("block").applyInArrow(filled, "block int, bits binary")
    for row in rows.collect():  # one job; an iterator runs one for each partition
        out.bits[row["block"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def repeated(values: DataFrame) -> DataFrame:
    """The values of column bucket that occur more than once."""
    return written(values.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"), "shingle-repeated")


MEMBERS = "bucket bigint, member bigint, least bigint, size bigint"


def recurring_signatures(docs: DataFrame) -> DataFrame:
    def rows(ids: np.ndarray, sets: Sets) -> list[pa.Array]:
        return [pa.array(signatures(sets)[1].view(np.int64))]

    return repeated(over_sets(docs, "bucket bigint", rows))


def members(docs: DataFrame, recurring: DataFrame) -> DataFrame:
    """bucket, member and the size of its set, of the buckets of two members and more."""
    spark = docs.sparkSession
    n = recurring.count()
    bloom = spark.sparkContext.broadcast(bloom_of(recurring, n)) if n <= BROADCAST_SIGNATURES else None

    def rows(ids: np.ndarray, sets: Sets) -> list[pa.Array]:
        at, found, least = signatures(sets)
        if bloom is not None:
            # A set with fewer recurring signatures than any link takes has no link.
            kept = bloom.value.test(found)
            kept &= (np.bincount(at[kept], minlength=len(ids)) >= least)[at]
            at, found = at[kept], found[kept]
        return [pa.array(found.view(np.int64)), pa.array(ids[at]), pa.array(least[at]), pa.array(sets.sizes[at].astype(np.int64))]

    rows_ = over_sets(docs, MEMBERS, rows)
    if bloom is None:
        rows_ = rows_.join(recurring, "bucket", "left_semi")
    return rarest(written(rows_, "shingle-members"))


def members_again(sets: DataFrame, seed: int) -> DataFrame:
    """The same of some sets, by the signatures of another partition."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = unpacked_sets(batch.column("shingles"))
            at, found, least = signatures(sets, seed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(batch.column("doc_id").to_numpy()[at]), pa.array(least[at]),
                 pa.array(sets.sizes[at].astype(np.int64))], ["bucket", "member", "least", "size"])

    return rarest(written(map_batches(sets.select("doc_id", "shingles"), step, MEMBERS), "shingle-members"))


def rarest(rows: DataFrame) -> DataFrame:
    """Of each document's recurring signatures all but the most frequent ``least`` - 1.

    Linked documents share ``least`` of either's signatures or more, so, in one order
    for all, they share one that both keep. Signatures that many documents have by a
    common passage go first.
    """
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    of_doc = Window.partitionBy("member")
    ranked = rows.join(counts, "bucket").select(
        "bucket", "member", "size", F.row_number().over(of_doc.orderBy("n", "bucket")).alias("place"),
        (F.count("*").over(of_doc) - F.min("least").over(of_doc) + 1).alias("kept"))
    kept = written(ranked.filter("place <= kept").select("bucket", "member", "size").distinct(), "shingle-rarest")
    several = kept.groupBy("bucket").agg(F.min("member").alias("first"), F.max("member").alias("last")).filter("first < last")
    return written(kept.join(several.select("bucket"), "bucket", "left_semi"), "shingle-buckets")


def without_copies(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The documents but for those whose set a smaller id has too."""
    copies = written(classes.filter("n = 1 AND rep < doc_id").select("doc_id"), "shingle-copies")
    return docs.join(F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies, "doc_id", "left_anti")


def sets_for(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets of some documents, packed."""

    def rows(ids: np.ndarray, sets: Sets) -> list[pa.Array]:
        raw = [packed(sets.hashes[a:b]) for a, b in zip(sets.first[:-1], sets.first[1:])]
        return [pa.array(ids), pa.array(raw, type=pa.binary())]

    small = ids.count() <= BROADCAST_IDS
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
    return written(over_sets(chosen, "doc_id bigint, shingles binary", rows), "shingle-sets")


# --- Pairs, groups ----------------------------------------------------------------------

def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose sets are similar enough, and whether a covers b: whatever links with b links with a.

    For that a column common has the shingles that b may share with others (null: not looked at).
    If a has all of them and is no larger, it shares as much with any set and is at least as near.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, covers = [], []
            for raw_a, raw_b, common in zip(*(batch.column(x).to_pylist() for x in ("set_a", "set_b", "common"))):
                set_a, set_b = unpacked(raw_a), unpacked(raw_b)
                both = len(np.intersect1d(set_a, set_b, assume_unique=True))
                linked.append(both * OF >= (len(set_a) + len(set_b) - both) * SHARED)
                covers.append(both == common and len(set_a) <= len(set_b))
            found = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(covers, type=pa.bool_())], ["a", "b", "covers"])
            yield found.filter(pa.array(linked, type=pa.bool_()))

    with_b = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
    both = with_b.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
    return written(map_batches(both.select("a", "b", "set_a", "set_b", "common"), step, "a bigint, b bigint, covers boolean"), "shingle-links")


def components(links: DataFrame) -> DataFrame:
    """id and the smallest id that its links reach, for every id with a link."""
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = written(both, "group-links")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("label")), "group-labels")
    while True:
        told = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("told"))
        nearer = labels.join(told, labels["id"] == told["a"]).select("id", F.least("label", "told").alias("label"), F.col("label").alias("old"))
        jump = nearer.select(F.col("id").alias("at"), F.col("label").alias("beyond"))
        new = written(nearer.join(jump, F.col("label") == F.col("at")).select("id", F.least("label", "beyond").alias("label"), "old"), "group-labels")
        labels = new.select("id", "label")
        if new.filter("label < old").isEmpty():
            return labels


def commons(sets: DataFrame) -> DataFrame:
    """Per set of the table how many shingles another of them may have too, at most."""
    spark = sets.sparkSession

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = unpacked_sets(batch.column("shingles"))
            owner = np.repeat(batch.column("doc_id").to_numpy(), held.sizes)
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(held.hashes.view(np.int64))], ["member", "bucket"])

    shingles = map_batches(sets.select("doc_id", "shingles"), each, "member bigint, bucket bigint")
    recurring = repeated(shingles.select("bucket"))
    n = recurring.count()
    if n > BROADCAST_SIGNATURES:
        return written(shingles.join(recurring, "bucket").groupBy("member").agg(F.count("*").alias("common")), "shingle-commons")
    bloom = spark.sparkContext.broadcast(bloom_of(recurring, n))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [int(bloom.value.test(unpacked(x)).sum()) for x in batch.column("shingles").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, type=pa.int64())], ["member", "common"])

    # Rows of one id with several sets: what one has is no less than any of them.
    counted = map_batches(sets.select("doc_id", "shingles"), told, "member bigint, common bigint")
    return written(counted.groupBy("member").agg(F.sum("common").alias("common")), "shingle-commons")


def labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Each member with its group: the smallest id its links reach, or its own."""
    labels = components(links).withColumnRenamed("id", "member")
    return rows.join(labels, "member", "left").withColumn("label", F.coalesce("label", "member"))


def still_open(rows: DataFrame) -> DataFrame:
    """Rows of buckets with members of several groups, and whether these make few pairs."""
    rows = written(rows, "shingle-labelled")
    of_label = rows.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    of_bucket = of_label.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"))
    of_bucket = of_bucket.filter("n * n > within").select("bucket", (F.col("n") * F.col("n") - F.col("within") <= F.col("n") * SMALL_BUCKET).alias("small"))
    return written(rows.join(of_bucket, "bucket"), "shingle-open")


def with_commons(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of sets that may link, by the shingles that another set of the table has too."""
    return rows.join(commons(sets), "member").filter(F.col("common") * OF >= F.col("size") * SHARED)


def linkable(size_a: Column, common_a: Column, size_b: Column, common_b: Column) -> Column:
    """Whether two sets share enough at best."""
    most = F.least(common_a, common_b, size_a, size_b)
    return most * OF >= (size_a + size_b - most) * SHARED


def head_pairs(rows: DataFrame) -> DataFrame:
    """Of each bucket its head, a, with the members, b, that it may link with.

    The head has the most shingles left to differ in: size / 9 less those that are common to none.
    A head may cover members with fewer common shingles, or as many and a larger id: never two each other.
    """
    order = F.struct((2 * SHARED * F.col("size") - (OF + SHARED) * F.col("common")).alias("used"), "member", "size", "common")
    heads = rows.groupBy("bucket").agg(F.min(order).alias("head"))
    met = rows.join(heads, "bucket").filter(
        (F.col("member") != F.col("head.member")) & linkable(F.col("size"), F.col("common"), F.col("head.size"), F.col("head.common")))
    may_cover = (F.col("head.common") > F.col("common")) | ((F.col("head.common") == F.col("common")) & (F.col("head.member") < F.col("member")))
    return met.select(F.col("head.member").alias("a"), F.col("member").alias("b"), F.when(may_cover, F.col("common")).alias("common")).distinct()


def open_pairs(first: DataFrame, second: DataFrame, ordered: bool = False) -> DataFrame:
    """Pairs of members of one bucket and different groups that share enough at best; ordered: both tables are one."""
    a = first.select("bucket", F.col("member").alias("a"), F.col("label").alias("label_a"), F.col("size").alias("size_a"), F.col("common").alias("common_a"))
    b = second.select("bucket", F.col("member").alias("b"), F.col("label").alias("label_b"), F.col("size").alias("size_b"), F.col("common").alias("common_b"))
    may = linkable(F.col("size_a"), F.col("common_a"), F.col("size_b"), F.col("common_b")) & (F.col("label_a") != F.col("label_b"))
    met = a.join(b, (a["bucket"] == b["bucket"]) & (F.col("a") < F.col("b") if ordered else F.lit(True)) & may)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().withColumn("common", F.lit(None).cast("bigint"))


def links_of(docs: DataFrame) -> DataFrame:
    """Links between documents: enough of them to connect every group."""
    rows = members(docs, recurring_signatures(docs))
    sets = sets_for(docs, rows.select(F.col("member").alias("doc_id")).distinct())
    links, level = None, 0
    while True:
        # Also members of one group: under another partition another head may cover them.
        open_ = written(with_commons(rows, sets), "shingle-likely")
        of_heads = compared(head_pairs(open_), sets)
        links = of_heads.select("a", "b") if links is None else written(links.union(of_heads.select("a", "b")), "shingle-links")
        covered = of_heads.filter("covers").select(F.col("b").alias("member")).distinct()
        open_ = still_open(labelled(open_.select("bucket", "member", "size").join(covered, "member", "left_anti"), links))
        if open_.isEmpty():
            return links
        sets = written(sets.join(open_.select(F.col("member").alias("doc_id")).distinct(), "doc_id", "left_semi"), "shingle-sets")
        open_ = still_open(with_commons(open_.drop("small"), sets))
        small, large = open_.filter("small"), open_.filter("NOT small")
        links = written(links.union(compared(open_pairs(small, small, True), sets).select("a", "b")), "shingle-links")
        if large.isEmpty():
            return links
        ranked = large.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("common"), "member")))
        most = HEADS << 2 * max(0, level - LEVELS)  # so that rounds on the last partition are few
        heads = written(ranked.filter(F.col("place") <= most).drop("place"), "shingle-heads")
        links = written(links.union(compared(open_pairs(heads, large), sets).select("a", "b")), "shingle-links")
        level += 1
        if level <= LEVELS:
            alive = large.select(F.col("member").alias("doc_id")).distinct()
            sets = written(sets.join(alive, "doc_id", "left_semi"), "shingle-sets")
            rows = members_again(sets, level)
        else:
            # The heads have met all they may link with in this bucket.
            rows = written(large.join(heads.select("bucket", "member"), ["bucket", "member"], "left_anti").select("bucket", "member", "size"), "shingle-rest")


def sets_and_classes(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the smallest id of their set (of an empty one: null), and per id the least of these.

    Ids of sets that recur are dealt to SALTS places, so that a set of very many rows is
    not joined in one task.
    """
    keyed = written(sizes_and_keys(known).withColumn("salt", F.floor(F.rand(7) * SALTS).cast("int")), "shingle-keys")
    key = ["n_shingles", "c1", "c2"]
    reps = keyed.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1")
    reps = reps.select(*key, "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    named = keyed.join(reps, [*key, "salt"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("least", "doc_id")).alias("rep"))
    named = written(named, "shingle-named")
    return named, written(named.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.count("*").alias("n")), "shingle-classes")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id per row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = rows.filter("doc_id IS NOT NULL")
    keyed, classes = sets_and_classes(known)
    # An id of several rows is one document: it links with the sets of all of them.
    repeated_ids = keyed.join(classes.filter("n > 1").select("doc_id"), "doc_id", "left_semi")
    own = repeated_ids.filter("rep < doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    labels = components(links_of(without_copies(known, classes)).union(own))
    named = classes.filter("rep IS NOT NULL").join(labels, F.col("rep") == F.col("id"), "left").select(
        "doc_id", F.coalesce("label", "rep").alias("component_id"))
    out = keyed.select("doc_id", "n_shingles").join(named, "doc_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id"))
    unnamed = rows.filter("doc_id IS NULL").select(F.lit(0).cast("bigint").alias("doc_id"), "text")
    alone = sizes_and_keys(unnamed).select(F.lit(None).cast("bigint").alias("doc_id"), "n_shingles", F.lit(None).cast("bigint").alias("component_id"))
    return out.union(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each group the row of the smallest id; rows without id stay. Of rows with one id the least text stays."""
    groups_ = groups(docs).filter("doc_id = component_id").select("doc_id").distinct()
    firsts = docs.join(groups_, "doc_id", "left_semi")
    repeated = firsts.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    single = firsts.join(repeated, "doc_id", "left_anti")
    whole = F.struct("text", *[c for c in docs.columns if c != "text"])
    several = firsts.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(whole).alias("row")).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
    return single.select(*docs.columns).unionByName(several).unionByName(docs.filter("doc_id IS NULL"))
