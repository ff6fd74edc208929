"""N-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct word n-grams. Two sets link at a Jaccard similarity of ``percent`` / 100 or more,
which bounds the number of n-grams that only one of them has. Sets are banded by size, and each also joins the band of
its largest possible partner. In a band the domain of n-grams is dealt by hash to more partitions than a linked pair
can differ in, so at least one partition holds the same n-grams of both. A signature is the content of one partition;
a set enumerates its first non-empty ones, one more than the differences it can have, which is enough for any two
linked sets to share a signature (the smaller prefix of the two decides). Sets with too few non-empty partitions are
rare (under one in ten million); they are held against all documents in blocks instead.

Equal sets are one class, found by a 64-bit key of the set before anything is paired. Sets that share a signature are
candidates: the most connected one of each signature's sets is paired with the others first; then only sets that are
still in different components are paired with each other, and pairs whose parity vectors (as long as the sets ask for)
prove them too different are left out. Sizes and vectors are stored with the set keys, so only the texts of remaining
pairs are fetched, and every one of these is verified on the texts themselves. Components come from the links by passing
smallest labels on, over tables; later links only merge components found before.

Defined results: texts that are null or have no word have the empty set and link with nothing (each its own
component); repeated rows link like any equal texts, and each keeps its row, but a class of them is paired once; a null
id never is a component's smallest id unless all are null; an empty table gives no row; a text of any length is one set,
so a task holds some forty times the longest text; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.llm.components import merged
from popscan.llm.sketch import screened, sent
from popscan.llm.storage import stored
from popscan.llm.textual import mix, raw, sliced_words, words_of

BAND_RATIO, SPARE, PARITY = 1.6, 14, 16  # width of a band, partitions beyond the least, longs of the shortest parity vector


class Sets:
    """The n-gram sets of some texts: sorted distinct hashes, one text after the other."""

    def __init__(self, w, n: int):
        at, key = w.grams(n)
        doc = w.doc[at] if len(at) else at
        counts, first = w.counts, w.first()
        short = np.flatnonzero((counts > 0) & (counts < n))
        if len(short):  # fewer words than n: the whole sequence is the one element
            lone = np.zeros(len(short), np.uint64)
            for k in range(n - 1):
                has = counts[short] > k
                word = np.where(has, w.hash[np.minimum(first[short] + k, len(w.hash) - 1)], np.uint64(k + 1))
                lone = mix(lone * np.uint64(0xD1342543DE82EF95) + word)
            key, doc = np.concatenate((key, lone)), np.concatenate((doc, short))
        order = np.lexsort((key, doc))
        key, doc = key[order], doc[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        self.key, self.doc = key[fresh], doc[fresh]
        self.size = np.bincount(self.doc, minlength=len(w.bounds) - 1)
        self.first = np.concatenate(([0], np.cumsum(self.size)))

    def totals(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.size), np.uint64)
        full = np.flatnonzero(self.size)
        if len(full):
            out[full] = np.add.reduceat(x, self.first[full])
        return out

    def set_keys(self) -> np.ndarray:
        """A key for each whole set; sets agree in it if they are equal."""
        return mix(self.totals(mix(self.key ^ np.uint64(0x5851F42D4C957F2D))) + self.size.astype(np.uint64)).astype(np.int64)

    def parities(self, percent: int) -> pa.ListArray:
        """For each set, whether an odd number of its n-grams falls into each of some buckets, as longs.

        There are three buckets or more for each difference that linked sets of its size can have, as otherwise those of
        any two large sets prove nothing. Lengths are powers of two, so that a longer vector folds to a shorter one's.
        """
        most = 2 * (100 - percent) * self.size // (100 + percent)
        length = np.full(len(self.size), PARITY, np.int64)
        while (few := 64 * length < 3 * most).any():
            length[few] *= 2
        first = np.concatenate(([0], np.cumsum(length)))
        longs = np.empty(first[-1], np.int64)
        for lo in range(0, len(length), 1024):  # sets at a time, as a bucket is a byte at first
            hi = min(lo + 1024, len(length))
            own = slice(self.first[lo], self.first[hi])
            doc = self.doc[own]
            bucket = (self.key[own] >> np.uint64(24)).astype(np.int64) % (64 * length[doc])
            odd = np.zeros(64 * (first[hi] - first[lo]), np.uint8)
            np.add.at(odd, 64 * (first[doc] - first[lo]) + bucket, 1)
            longs[first[lo] : first[hi]] = np.packbits(odd & 1).view("<i8")
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(longs, pa.int64()))


class Parities:
    """The parity vectors of some sets, to count the buckets in which two differ: never more than their n-grams apart."""

    def __init__(self, vectors: pa.ListArray):
        self.length = np.asarray(vectors.value_lengths()).astype(np.int64)
        first = np.cumsum(self.length) - self.length
        longs = np.asarray(vectors.flatten()).view(np.uint64)
        self.folded = {}  # by length: the vectors of that length or more, folded to it
        for size in np.unique(self.length).tolist():
            out = np.zeros((len(self.length), size), np.uint64)
            for long in np.unique(self.length[self.length >= size]).tolist():
                at = np.flatnonzero(self.length == long)
                whole = longs[first[at][:, None] + np.arange(long)]
                out[at] = np.bitwise_xor.reduce(whole.reshape(len(at), long // size, size), axis=1)
            self.folded[size] = out

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Left sets by right sets."""
        out = np.zeros((len(left), len(right)), np.int64)
        a, b = self.length[left], self.length[right]
        for size, odd in self.folded.items():
            for x, y in ((np.flatnonzero(a == size), np.flatnonzero(b >= size)), (np.flatnonzero(a > size), np.flatnonzero(b == size))):
                if len(x) and len(y):
                    total = np.zeros((len(x), len(y)), np.int64)
                    for k in range(size):
                        total += np.bitwise_count(odd[left[x], k][:, None] ^ odd[right[y], k][None, :])
                    out[np.ix_(x, y)] = total
        return out


def _apart(a: str, b: str) -> F.Column:
    """The buckets in which two parity vectors differ, the longer one folded."""
    least = F.least(F.size(a), F.size(b))

    def folded(v: str) -> F.Column:
        fold = lambda i: F.aggregate(
            F.sequence(i, F.size(v) - 1, least), F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.get(v, j))
        )
        return F.when(F.size(v) == least, F.col(v)).otherwise(F.transform(F.sequence(F.lit(0), least - 1), fold))

    return F.aggregate(
        F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x
    )


class Bands:
    def __init__(self, percent: int, largest: int = 1 << 40):
        self.percent = percent
        edges = [1]
        while edges[-1] <= largest:
            edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_RATIO)))
        self.edges = np.array(edges)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, size, "right") - 1

    def differences(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The most n-grams that linked sets of these sizes can have apart."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def instances(self, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each set and band it signs in: index, band, partitions, signatures needed."""
        band = self.of(size)
        most = 100 * size // self.percent
        index = np.flatnonzero(size > 0)
        again = index[most[index] >= self.edges[band[index] + 1]]
        index = np.concatenate((index, again))
        band = np.concatenate((band[size > 0], band[again] + 1))
        top = self.edges[band + 1] - 1
        parts = self.differences(top, top) + 1
        parts = np.where(parts > 1, parts + SPARE, 1)
        return index, band, parts, self.differences(size[index], np.minimum(top, most[index])) + 1


def signatures(sets: Sets, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set index and signature of every row, and the sets that lack non-empty partitions."""
    index, band, parts, need = bands.instances(sets.size)
    size = sets.size[index]
    if not len(index):
        return index, np.empty(0, np.uint64), index
    at = np.repeat(sets.first[index] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    key = sets.key[at]
    part = ((key >> np.uint64(32)) * np.repeat(parts, size).astype(np.uint64)) >> np.uint64(32)
    base = np.concatenate(([0], np.cumsum(parts)))
    slot = np.repeat(base[:-1], size) + part.astype(np.int64)
    content = mix(key + np.uint64(0x2545F4914F6CDD1D))
    order = np.argsort(slot, kind="stable")
    slot = slot[order]
    edge = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
    total, slot = np.add.reduceat(content[order], edge), slot[edge]
    owner = np.searchsorted(base, slot, "right") - 1
    start = np.searchsorted(owner, np.arange(len(index)))
    rank = np.arange(len(slot)) - start[owner]
    wanted = rank < need[owner]
    have = np.bincount(owner, minlength=len(index))
    short = np.unique(index[have < need])
    slot, owner, total = slot[wanted], owner[wanted], total[wanted]
    sig = mix(total ^ mix((band[owner].astype(np.uint64) << np.uint64(32)) + (slot - base[owner]).astype(np.uint64)))
    return index[owner], sig, short


def _ident() -> F.Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def _members(n: int, percent: int):
    """Each document's set: its key, size and parity vector, and whether it lacks non-empty partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            for lo, hi, w in sliced_words(batch.column("text"), fold=True):
                sets = Sets(w, n)
                short = np.zeros(len(sets.size), bool)
                short[signatures(sets, bands)[2]] = True
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[lo:hi], batch.column("id")[lo:hi], pa.array(sets.set_keys()),
                        pa.array(sets.size.astype(np.int64)), pa.array(short), sets.parities(percent),
                    ],
                    names=["doc_id", "id", "set_key", "n_shingles", "short", "parity"],
                )

    return run


def _sign(n: int, percent: int, known: Broadcast | None = None):
    """Signatures of the sets that are new to the task; with ``known``, those that may be in it, with their sets' keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, met = Bands(percent), np.empty(0, np.int64)
        for batch in batches:
            for _, _, w in sliced_words(batch.column("text"), fold=True):
                sets = Sets(w, n)
                keys = sets.set_keys()
                _, first = np.unique(keys, return_index=True)
                fresh = np.zeros(len(keys), bool)
                fresh[first] = True
                fresh &= ~np.isin(keys, met)
                met = np.concatenate((met, keys[fresh]))
                index, sig, _ = signatures(sets, bands)
                keep = fresh[index]
                if known is None:
                    yield pa.RecordBatch.from_arrays([pa.array(sig[keep].astype(np.int64))], names=["sig"])
                    continue
                keep[keep] = known.value.holds(sig[keep])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[keep].astype(np.int64)), pa.array(keys[index[keep]])], names=["sig", "set_key"]
                )

    return run


def _texts(n: int, known: Broadcast):
    """Key and text of the sets of rows whose ``id_key`` may be ``known``, each set once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.empty(0, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):  # so that no second copy of a batch is held
                batch = whole.slice(at, 1024)
                text = batch.column("text").filter(pa.array(known.value.holds(np.asarray(batch.column("id_key")).view(np.uint64))))
                for lo, _, w in sliced_words(text, fold=True):
                    keys, first = np.unique(Sets(w, n).set_keys(), return_index=True)
                    new = ~np.isin(keys, met)
                    keys, first = keys[new], first[new]
                    met = np.concatenate((met, keys))
                    yield pa.RecordBatch.from_arrays([pa.array(keys), text.take(pa.array(lo + first))], names=["set_key", "text"])

    return run


GROUP_BLOCK = 4096  # members of one signature that meet in a task


def _propose(percent: int, everything: bool):
    """Pairs of a signature's sets, in different components, that parity does not rule out.

    All of them, or for each set the nearest one and the signature's most central one.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("set_key")
        key, n = np.asarray(table.column("set_key")), np.asarray(table.column("n"))
        label = np.asarray(table.column("label"))
        part = np.asarray(table.column("part"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        odd = Parities(pa.concat_arrays(table.column("parity").chunks))
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        rows = np.flatnonzero(part == i)
        others = np.flatnonzero(part == j)
        total = np.zeros(len(others), np.int64)
        near_a, near_b = [], []
        for lo in range(0, len(rows), 256):
            r = rows[lo : lo + 256]
            apart = odd.apart(r, others)
            total += apart.sum(0)
            size, other = n[r][:, None], n[others][None, :]
            may = apart <= (100 - percent) * (size + other) // (100 + percent)
            may &= (label[r][:, None] != label[others][None, :]) & (key[r][:, None] != key[others][None, :])
            if everything:
                x, y = np.nonzero(may)
                a.append(key[r[x]])
                b.append(key[others[y]])
            else:
                far = np.where(may, apart, 1 << 30)
                y = far.argmin(1)
                x = np.flatnonzero(may.any(1))
                near_a.append(key[r[x]])
                near_b.append(key[others[y[x]]])
        if not everything and len(others):
            hub = others[total.argmin()]
            apart = odd.apart(rows, np.array([hub]))[:, 0]
            may = apart <= (100 - percent) * (n[rows] + n[hub]) // (100 + percent)
            may &= (label[rows] != label[hub]) & (key[rows] != key[hub])
            a, b = [*near_a, key[rows[may]]], [*near_b, np.full(int(may.sum()), key[hub])]
        x, y = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (a, b))
        pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return run


def _linked(n: int, percent: int):
    """Pairs of texts whose sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                left, right = (
                    Sets(words_of(*raw(part.column(c)), fold=True), n) for c in ("text_a", "text_b")
                )
                keep = []
                for i in range(part.num_rows):
                    x = left.key[left.first[i] : left.first[i + 1]]
                    y = right.key[right.first[i] : right.first[i + 1]]
                    both = np.intersect1d(x, y, assume_unique=True).size
                    keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _against(sets: list[tuple[int, np.ndarray]], n: int, percent: int):
    """Links of a few given sets with every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, w in sliced_words(batch.column("text"), fold=True):
                here = Sets(w, n)
                keys, a, b = here.set_keys(), [], []
                for own, elements in sets:
                    both = np.bincount(here.doc[np.isin(here.key, elements)], minlength=len(here.size))
                    hit = np.flatnonzero((both > 0) & (100 * both >= percent * (here.size + len(elements) - both)))
                    a += [own] * len(hit)
                    b += keys[hit].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _short_links(docs: DataFrame, member: DataFrame, n: int, percent: int, block: int = 256) -> list[DataFrame]:
    short = member.filter("short").groupBy("set_key").agg(F.min("id").alias("id"))
    count = short.count()
    out, blocks = [], -(-count // block)
    for k in range(blocks):
        part = short.filter(F.pmod(F.xxhash64("set_key"), F.lit(blocks)) == k)
        wanted = screened(docs.select("id", "text"), F.xxhash64("id"), sent(part, F.xxhash64("id")))
        texts = wanted.join(part, "id").select("text").distinct().toPandas()["text"]
        sets = Sets(words_of(*raw(pa.array(texts, pa.string())), fold=True), n)
        given = [(int(key), sets.key[sets.first[i] : sets.first[i + 1]]) for i, key in enumerate(sets.set_keys())]
        out.append(docs.select("text").mapInArrow(_against(given, n, percent), "a long, b long"))
    return out


def link(documents: DataFrame, n: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """``doc_id, id, set_key, n_shingles, short, parity`` of every document; ``node, component`` of every linked set key."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _ident().alias("id"), "text")
    member = stored(
        docs.mapInArrow(
            _members(n, percent), "doc_id long, id long, set_key long, n_shingles long, short boolean, parity array<long>"
        ),
        "sets",
    )
    # signatures are counted first, and only those of several sets are sent with their sets: most stand once
    signed = docs.select("text").mapInArrow(_sign(n, percent), "sig long")
    several = sent(signed.groupBy("sig").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "sig")
    shared = docs.select("text").mapInArrow(_sign(n, percent, several), "sig long, set_key long")
    keyed = stored(shared.distinct(), "shared")
    groups = stored(
        keyed.groupBy("sig")
        .agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("set_key")).alias("_h"))
        .filter("_n > 1")
        .groupBy("_n", "_h")  # signatures of the same sets need one look
        .agg(F.min("sig").alias("sig"))
        .select("sig", F.col("_n").alias("members"), F.ceil(F.col("_n") / GROUP_BLOCK).cast("int").alias("parts")),
        "signatures",
    )
    groups = stored(screened(keyed, "sig", sent(groups, "sig")).join(groups, "sig"), "groups")
    classes = stored(groups.select("set_key").distinct(), "classes")
    first = stored(member.groupBy("set_key").agg(F.min("id").alias("id")).join(classes, "set_key"), "first")
    vectors = member.select("set_key", F.col("n_shingles").alias("n"), "parity")
    vectors = stored(screened(vectors, "set_key", sent(classes, "set_key")).dropDuplicates(["set_key"]), "vectors")
    two = groups.filter("members = 2").groupBy("sig").agg(F.min("set_key").alias("a"), F.max("set_key").alias("b"))
    for side in ("a", "b"):
        two = two.join(vectors.select(F.col("set_key").alias(side), F.col("n").alias(f"n_{side}"), F.col("parity").alias(f"p_{side}")), side)
    two = two.filter((100 + percent) * _apart("p_a", "p_b") <= (100 - percent) * (F.col("n_a") + F.col("n_b"))).select("a", "b")
    part = F.pmod(F.xxhash64("set_key"), F.col("parts")).cast("int")
    laid = groups.filter("members > 2").withColumn("part", part).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    laid = laid.select("sig", "set_key", "part", F.least("part", "_o").alias("i"), F.greatest("part", "_o").alias("j"))
    laid = laid.join(vectors, "set_key")
    labels = None
    for everything in (False, False, True):
        if labels is None:
            labelled = laid.withColumn("label", F.col("set_key"))
        else:
            known = labels.withColumnsRenamed({"node": "set_key", "component": "label"})
            labelled = laid.join(known, "set_key", "left").withColumn("label", F.coalesce("label", "set_key"))
            open_ = labelled.groupBy("sig").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_a < _b")
            labelled = labelled.join(open_.select("sig"), "sig")
        pairs = labelled.groupBy("sig", "i", "j").applyInArrow(_propose(percent, everything), "a long, b long")
        pairs = stored((pairs.union(two) if labels is None else pairs).distinct(), "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("set_key")).distinct()
        known = sent(first.join(ends, "set_key"), F.xxhash64("id"))
        texts = docs.select(F.xxhash64("id").alias("id_key"), "text").mapInArrow(_texts(n, known), "set_key long, text string")
        texts = stored(texts, "texts")
        # rows that share the smallest id (null ids of one text, repeated rows) are one in each task, then one at all
        if not texts.groupBy("set_key").count().filter("count > 1").isEmpty():
            texts = stored(texts.dropDuplicates(["set_key"]), "texts")
        left, right = (texts.toDF(side, f"text_{side}") for side in ("a", "b"))
        both = pairs.join(left, "a").join(right, "b").repartition("a", "b")
        found = stored(both.mapInArrow(_linked(n, percent), "a long, b long"), "links")
        labels = merged(labels, found)
    for found in _short_links(docs, member, n, percent):
        labels = merged(labels, stored(found, "links"))
    return member, labels


def near_duplicates(documents: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, id, n_shingles, component_id, first_id`` of every document.

    ``id`` is the document's id, or a hash of its text where that is null; ``first_id`` the one of the component's
    smallest document.
    """
    member, labels = link(documents, n, percent)
    labels = labels.withColumnsRenamed({"node": "set_key", "component": "label"})
    full = member.filter("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("lost"), F.col("doc_id").alias("doc_id"), F.col("id").alias("id"))
    classes = full.groupBy("set_key").agg(F.min(order).alias("_o")).join(labels, "set_key", "left")
    classes = classes.withColumn("label", F.coalesce("label", "set_key"))
    smallest = classes.groupBy("label").agg(F.min("_o").alias("_s"))
    named = classes.join(smallest, "label").select(
        "set_key", F.col("_s.doc_id").alias("component_id"), F.col("_s.id").alias("first_id")
    )
    joined = full.join(named, "set_key").select("doc_id", "id", "n_shingles", "component_id", "first_id")
    alone = member.filter("n_shingles = 0").select(
        "doc_id", "id", "n_shingles", F.col("doc_id").alias("component_id"), F.col("id").alias("first_id")
    )
    return joined.unionByName(alone)


def representatives(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` without all but the first of each group: the smallest id; rows that repeat stay once."""
    groups = stored(near_duplicates(documents, n, percent).select("id", "first_id"), "grouped")
    first = groups.filter("id = first_id").select("id").distinct()
    # the input's columns travel in one of their own, so none of ours can clash with them
    held = documents.select(F.struct("*").alias("_in"), _ident().alias("id"), F.xxhash64("text").alias("_text"))
    # rows of ids that may go or repeat are looked at; all others stay where they are
    open_ = groups.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("first_id").alias("first_id"))
    doubtful = sent(open_.filter("n > 1 OR first_id <> id OR first_id IS NULL"), F.xxhash64("id"))
    clear = screened(held, F.xxhash64("id"), doubtful, inside=False).select("_in.*")
    kept = screened(held, F.xxhash64("id"), doubtful).join(first, "id", "left_semi").dropDuplicates(["id", "_text"])
    return clear.unionByName(kept.select("_in.*"))
