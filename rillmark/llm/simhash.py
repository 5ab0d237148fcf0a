"""SimHash near duplicates: fingerprints, blocks that close pairs share, Hamming distance, connected classes."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.common import begin_task, discard, fields, plain, set_aside, stored, text_key

#: Seed of the shingles' hash (fixed value of the contract).
SEED = 42
#: Blocks a fingerprint is split into for exact links within 2 bits, and the largest bucket whose pairs are compared one by one.
BLOCKS, PAIRWISE = 8, 64
#: Bits of the fingerprint for links by similarity; the first 64 meet in blocks, all of them are compared.
WIDE_BITS = 256
#: Shingles from which the distance of fingerprints follows its normal law.
LARGE = 64
#: Places of the filter that keeps texts without need of an exact comparison from being shuffled.
SLOTS = 1 << 20
#: Shingles handled at a time.
PART = 1 << 15
#: One in so many texts tells which shingles are common, and the common ones that are kept: both order the work and leave results as they are.
COMMON_SHARE, MOST_COMMON = 16, 1 << 20


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th further 64 bits made of a hash (SplitMix64's finaliser; fixed values)."""
    if k:
        h = h + np.uint64((0x9E3779B97F4A7C15 * k) & (2**64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return h


def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """The hashes of the shingles of a text, repeats included, PART at a time; a text of fewer words is one shingle."""
    # split() and lower() of bytes know just the white space and the letters of the contract
    w = text.lower().split()
    if w:
        rows = (w[i:] for i in range(words)) if len(w) >= words else ([x] for x in w)
        shingles = map(b" ".join, zip(*rows))
        while len(h := np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in itertools.islice(shingles, PART)), np.uint64)):
            yield h


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The different hashes of a text's shingles in order."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_hashes(text, words)]))


def fingerprint(text: bytes, words: int, lanes: int, distinct: bool = False) -> tuple[int, ...]:
    """``lanes`` signed 64-bit numbers. A bit is 1 if it is set in over half of the hashes of the shingles (``distinct``: of different ones)."""
    total, votes = 0, np.zeros((lanes, 64), np.int64)
    parts = shingle_hashes(text, words)
    if distinct:
        every = shingle_set(text, words)
        parts = (every[i : i + PART] for i in range(0, len(every), PART))
    for h in parts:
        total += len(h)
        for k in range(lanes):
            bits = np.unpackbits(_mixed(h, k).astype(">u8").view(np.uint8)).reshape(-1, 64)
            votes[k] += bits.sum(axis=0, dtype=np.int32)
    return tuple(int(x) for x in np.packbits(2 * votes > total, axis=1).view(">i8").ravel())


def fingerprints(docs: DataFrame, words: int = 3, bits: int = 64, distinct: bool = False) -> DataFrame:
    """doc_id, key (of the text) and f0, f1, ...: 64 bits each. Texts without words, missing ones too, have all bits 0."""
    rows = fields(docs, "doc_id", "text").select("doc_id", text_key(plain("text")).alias("key"), plain("text").cast("binary").alias("text"))
    lanes = bits // 64
    names = [f"f{k}" for k in range(lanes)]

    def run(batches):
        begin_task(__name__)
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), words, lanes, distinct) for t in batch.column("text")], np.int64).reshape(-1, lanes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *(pa.array(made[:, k]) for k in range(lanes))], ["doc_id", "key", *names])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, key {rows.schema['key'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names)
    return rows.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of undirected edges (a, b): root is the smallest node of the class.

    Alternates the large and the small star: every node hands its larger (then its smaller) neighbours to the smallest one it knows, until
    nothing changes. The number of rounds grows with the logarithm of the classes; every round is a table in the shared folder.
    """
    def stars(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        return small.filter("a <> b").distinct()

    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    mark = _mark(now)
    while True:
        before, now = now, stored(stars(now))
        new = _mark(now)
        discard(before)
        if new == mark:
            break
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1_000_003)))).first())


def _masks(bits: int) -> list[int]:
    """Masks over 64 bits, as signed numbers: all of them but two blocks of BLOCKS (any two changed bits leave one mask untouched)."""
    width = bits // BLOCKS
    block = [((1 << width) - 1) << (width * i) for i in range(BLOCKS)]
    return [_signed((1 << bits) - 1 - x - y) for x, y in itertools.combinations(block, 2)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def close_pairs(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect all 64-bit fingerprints (f, distinct) within 2 bits of each other.

    Fingerprints are split into 8 blocks; two that differ in 2 bits share at least 6, so they meet in a bucket of one of 28 tables. A bucket
    cannot hold over 2^16 fingerprints, as they share 48 bits. The pairs of a bucket of PAIRWISE or fewer are compared. The fingerprints of
    larger ones are looked up by every way to blank two bits instead: those that agree then, four at most, are within 2 bits of the smallest.
    """
    f = F.col("f")
    keys = fps.select("f", F.explode(F.array(*map(F.lit, _masks(64)))).alias("mask")).withColumn("key", f.bitwiseAND(F.col("mask")))
    buckets = keys.groupBy("mask", "key").agg(F.collect_list("f").alias("all")).filter(F.size("all") > 1)
    buckets = stored(buckets.select("all", F.size("all").alias("n")))
    pair = buckets.filter(F.col("n") <= PAIRWISE).select("all", F.explode("all").alias("a"))
    near = F.filter("all", lambda b: (b > F.col("a")) & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= 2))
    pairs = pair.select("a", F.explode(near).alias("b"))
    crowded = buckets.filter(F.col("n") > PAIRWISE).select(F.explode("all").alias("f")).distinct()
    blanks = [_signed(2**64 - 1 - (1 << x) - (1 << y)) for x, y in itertools.combinations(range(64), 2)]
    looked = crowded.select("f", F.explode(F.array(*map(F.lit, blanks))).alias("mask")).withColumn("key", f.bitwiseAND(F.col("mask")))
    groups = looked.groupBy("mask", "key").agg(F.min("f").alias("a"), F.collect_list("f").alias("all")).filter(F.size("all") > 1)
    stars = groups.select("a", F.explode("all").alias("b")).filter("a <> b")
    return pairs.unionByName(stars).distinct()


def near_classes(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id for every document (doc_id, text): links at 2 or fewer differing bits.

    component_id is the smallest doc_id reachable over links. Texts without words have fingerprint 0 and link like others; rows without
    doc_id take part and count last (a class of such rows alone has no component_id); repeated rows come back repeated.
    """
    rows = stored(fingerprints(docs, words, 64).select("doc_id", F.col("f0").alias("f")))
    nodes = rows.groupBy("f").agg(F.min("doc_id").alias("least"))
    classes = components(close_pairs(nodes.select("f")))
    linked = nodes.join(classes, nodes.f == classes.node, "left").select("f", "least", F.coalesce("root", "f").alias("root"))
    linked = stored(linked)
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(ids, "root").select(F.col("f").alias("_f"), "component_id")
    out = rows.join(named, rows.f == named["_f"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def _distance(lanes: list[str], left, right) -> Column:
    return reduce(lambda x, y: x + y, (F.bit_count(left(x).bitwiseXOR(right(x))) for x in lanes))


def sure_distance(similarity: float) -> int:
    """The number of WIDE_BITS bits up to which a pair that differs has the similarity for sure (3 deviations).

    Sets of Jaccard similarity s have angle arccos(2s / (1 + s)) at most, and that share of their fingerprints' bits differs.
    """
    p = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(WIDE_BITS * p - 3 * np.sqrt(WIDE_BITS * p * (1 - p)))


def block_links(prints: DataFrame, lanes: list[str], most: int) -> DataFrame:
    """Links (a, b) of ids of prints (id, lanes) whose first 64 bits meet in ``close_pairs`` and that differ in ``most`` bits at most in all."""
    firsts = stored(prints.groupBy(F.col(lanes[0]).alias("f")).agg(F.min(F.struct("id", *lanes)).alias("o")))
    pairs = close_pairs(firsts.select("f"))
    near = pairs.join(firsts.toDF("a", "x"), "a").join(firsts.toDF("b", "y"), "b").select("x", "y")
    same = prints.select(F.struct("id", *lanes).alias("x"), F.col(lanes[0]).alias("f")).join(firsts.toDF("f", "y"), "f").filter("x.id <> y.id").select("x", "y")
    verified = near.unionByName(same).filter(_distance(lanes, lambda f: F.col(f"x.{f}"), lambda f: F.col(f"y.{f}")) <= most)
    return verified.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def surely_far(similarity: float) -> int:
    """The number of WIDE_BITS bits from which a pair has less than the similarity: 10 deviations, rarer than equal hashes of different shingles."""
    p = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(WIDE_BITS * p + 10 * np.sqrt(WIDE_BITS * p * (1 - p))) + 1


def alike(docs: DataFrame, prints: DataFrame, links: DataFrame, words: int, similarity: float) -> DataFrame:
    """The links (a, b, n, ...) whose texts' sets of shingles have the Jaccard similarity, compared exactly.

    ``n`` is the smaller set's size; larger ones whose fingerprints are ``surely_far`` apart are left out first, so their texts stay where
    they are. Of equal texts only the document that prints (id, key, least, lanes) names is read.
    """
    lanes = [c for c in prints.columns if c not in ("id", "key", "least")]
    both = links.join(prints.select(F.col("id").alias("a"), F.struct(*lanes).alias("_x")), "a").join(prints.select(F.col("id").alias("b"), F.struct(*lanes).alias("_y")), "b")
    far = _distance(lanes, lambda f: F.col(f"_x.{f}"), lambda f: F.col(f"_y.{f}")) >= surely_far(similarity)
    near = stored(both.filter(~far | (F.col("n") < LARGE)).drop("_x", "_y"))
    ids = stored(near.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(prints.select("id", "key", "least"), "id"))
    slot = F.pmod(F.xxhash64("key.h1", "least"), F.lit(SLOTS)).alias("slot")
    rows = fields(docs, "doc_id", "text").select(text_key(plain("text")).alias("key"), F.col("doc_id").alias("least"), plain("text").cast("binary").alias("text"))
    rows = rows.withColumn("slot", slot).join(F.broadcast(ids.select(slot).distinct()), "slot", "left_semi")  # SLOTS rows at most
    ours = ids.select(F.col("key.h1").alias("h1"), F.col("key.h2").alias("h2"), F.col("key.n").alias("size"), F.col("least").alias("first"), "id")
    same = (F.col("key.h1") == F.col("h1")) & (F.col("key.h2") == F.col("h2")) & (F.col("key.n") == F.col("size")) & F.col("least").eqNullSafe(F.col("first"))
    rows = rows.join(ours, same).select("id", "text")

    def run(batches):
        begin_task(__name__)
        for batch in batches:
            for k, t in zip(batch.column("id"), batch.column("text")):
                sets = pa.array([shingle_set(t.as_py(), words).view(np.int64)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([k.as_py()], pa.int64()), sets], ["id", "shingles"])

    sets = stored(rows.mapInArrow(run, "id long, shingles array<long>"))
    both = near.join(sets.toDF("a", "_sa"), "a").join(sets.toDF("b", "_sb"), "b")
    common = F.size(F.array_intersect("_sa", "_sb"))
    found = both.filter(common >= similarity * (F.size("_sa") + F.size("_sb") - common) - 1e-9).drop("_sa", "_sb")
    found = stored(found.distinct())  # repeated rows of a document have their sets repeatedly
    discard(near, ids, sets)
    return found


def common_shingles(rows: DataFrame, words: int) -> DataFrame:
    """(token, n): shingles of the texts (h1, text) that two or more of a sample have, MOST_COMMON of them at most."""

    def run(batches):
        begin_task(__name__)
        for batch in batches:
            for begin in range(0, len(batch), 256):
                sets = [shingle_set(t.as_py(), words) for t in batch.column("text")[begin : begin + 256]]
                found, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["token", "n"])

    drawn = rows.filter(F.pmod(F.xxhash64("h1"), F.lit(COMMON_SHARE)) == 0)
    counts = drawn.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter("n > 1")
    return counts.orderBy(F.desc("n"), "token").limit(MOST_COMMON)


def prefixes(docs: DataFrame, ids: DataFrame, words: int, similarity: float) -> DataFrame:
    """(token, id, place): the first shingles of each text of ids (h1, id), as far as another id has them among its first ones.

    In any one order of all shingles, two texts of the Jaccard similarity share one of their first n - ceil(similarity * n) + 1 of n shingles.
    The order is rare before common, as far as a sample tells, so unrelated texts hardly meet. ``place`` holds n and the shingle's place.
    """
    rows = fields(docs, "doc_id", "text").select(text_key(plain("text"))["h1"].alias("h1"), plain("text").cast("binary").alias("text"))
    common = common_shingles(rows, words).toPandas().sort_values("token")  # MOST_COMMON rows at most
    sent = docs.sparkSession.sparkContext.broadcast((common["token"].to_numpy(np.int64), common["n"].to_numpy(np.int64)))

    def run(batches):
        known, often = sent.value
        for batch in batches:
            for h, t in zip(batch.column("h1").to_pylist(), batch.column("text")):
                every = shingle_set(t.as_py(), words).view(np.int64)
                size = len(every)
                if not size:
                    continue
                n = np.zeros(size, np.int64)
                if len(known):
                    at = np.searchsorted(known, every).clip(max=len(known) - 1)
                    n = np.where(known[at] == every, often[at], 0)
                first = every[np.lexsort((every, n))[: size - int(np.ceil(similarity * size - 1e-6)) + 1]]
                place = (size << 32) + np.arange(len(first), dtype=np.int64)
                for begin in range(0, len(first), PART):
                    part = slice(begin, begin + PART)
                    yield pa.RecordBatch.from_arrays([pa.array(first[part]), pa.array(np.full(len(first[part]), h, np.int64)), pa.array(place[part])], ["token", "h1", "place"])

    tokens = rows.mapInArrow(run, "token long, h1 long, place long").repartition("token").dropDuplicates(["token", "h1"])
    shared = tokens.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("n > 1").drop("n")
    return shared.join(ids, "h1").groupBy("token", "id").agg(F.min("place").alias("place"))


def _met(places: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``prefixes`` whose token several classes of labels (id, root) have, with the token's largest class (``main``) and the
    first text of it (``pivot``: id and place)."""
    rows = places.join(labels, "id")
    sizes = rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "place")).alias("first"))
    largest = F.min(F.struct(-F.col("n"), F.col("first.id"), "root", "first"))
    tops = sizes.groupBy("token").agg(F.count(F.lit(1)).alias("kinds"), largest.alias("t")).filter("kinds > 1")
    return rows.join(tops.select("token", F.col("t.root").alias("main"), F.col("t.first").alias("pivot")), "token")


def _enough(x: Column, y: Column, similarity: float) -> Column:
    """Whether texts that share a shingle at these places can share enough of those that follow."""
    size, at = (lambda p: F.shiftright(p, 32)), (lambda p: p.bitwiseAND(F.lit(2**32 - 1)))
    shared = F.least(at(x), at(y)) + F.least(size(x) - at(x), size(y) - at(y))
    return shared * (1 + similarity) >= similarity * (size(x) + size(y)) - 1e-6


def _pairs_of(x: str, y: str) -> list[Column]:
    """a, b (ids in order) and n, the smaller set's size."""
    n = F.shiftright(F.least(F.col(f"{x}place"), F.col(f"{y}place")), 32)
    return [F.least(F.col(f"{x}id"), F.col(f"{y}id")).alias("a"), F.greatest(F.col(f"{x}id"), F.col(f"{y}id")).alias("b"), n.alias("n")]


def pivot_pairs(met: DataFrame, similarity: float) -> DataFrame:
    """Of every token, the pairs (a, b) of its pivot with the texts of other classes that can have the similarity."""
    rows = met.filter((F.col("root") != F.col("main")) & _enough(F.col("place"), F.col("pivot.place"), similarity))
    return rows.select(*_pairs_of("", "pivot.")).distinct()


def every_pair(met: DataFrame, similarity: float) -> DataFrame:
    """Of every token, all pairs (a, b) of texts of different classes that can have the similarity."""
    rows = met.select("token", "id", "root", "main", "place")
    x, y = rows.filter("root <> main").alias("x"), rows.alias("y")
    # of two texts outside the main class, one order will do
    once = (F.col("y.root") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))
    enough = _enough(F.col("x.place"), F.col("y.place"), similarity)
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & once & enough)
    return pairs.select(*_pairs_of("x.", "y.")).distinct()


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links (a, b, ...) between different classes of labels (id, root), with the classes as ra and rb."""
    return links.join(labels.toDF("a", "ra"), "a").join(labels.toDF("b", "rb"), "b").filter("ra <> rb")


def _joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels (id, root) with the classes joined that edges (a, b) of roots connect."""
    classes = components(edges).toDF("node", "_root")
    return stored(labels.join(classes, labels.root == classes.node, "left").select("id", F.coalesce("_root", "root").alias("root")))


def similar_classes(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(key, least, root) for every distinct text of documents: its key, smallest doc_id and class, linking texts of this similarity or more.

    Fingerprints of the different shingles meet in pigeonhole blocks of their first 64 bits and are linked where all bits' Hamming distance
    leaves no doubt. Pairs that differ more are found by their rarest shingles (``prefixes``), which no pair of the similarity fails to
    share, and are compared exactly where they would join two classes: first, as long as that joins any, each token's texts with one of its
    largest class, so that a large group of near copies becomes one class without its pairs; then all pairs of a token that still are of
    different classes. So no pair is missed. Texts without words are one class; of texts with equal fingerprints one stands for all. Missing
    texts count as empty; tables without rows give none.
    """
    rows = fingerprints(docs, words, WIDE_BITS, distinct=True)
    lanes = [f"f{k}" for k in range(WIDE_BITS // 64)]
    texts = stored(rows.groupBy("key").agg(F.min("doc_id").alias("least"), *(F.first(x).alias(x) for x in lanes)))
    prints = texts.groupBy(*lanes).agg(F.min(F.struct("key", "least")).alias("t"))
    prints = stored(prints.select(F.xxhash64(*lanes).alias("id"), "t.key", "t.least", *lanes))
    labels = _joined(prints.select("id", F.col("id").alias("root")), block_links(prints, lanes, sure_distance(similarity)))
    named = texts.select("key", "least", F.xxhash64(*lanes).alias("id"))
    places = stored(prefixes(docs, named.select(F.col("key.h1").alias("h1"), "id").distinct(), words, similarity))
    done, every = None, False
    while True:
        met = stored(_met(places, labels))
        discard(places)
        places = met.select("token", "id", "place")
        pairs = every_pair(met, similarity) if every else pivot_pairs(met, similarity)
        new = pairs if done is None else pairs.join(done, ["a", "b"], "left_anti")
        open_ = stored(_between(new, labels))
        if not open_.isEmpty():
            good = alike(docs, prints, open_, words, similarity)
            before, labels = labels, _joined(labels, good.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
            every_next = good.isEmpty()
            discard(before, good)
            done = open_.select("a", "b") if done is None else done.unionByName(open_.select("a", "b"))
        else:
            every_next = True
        if every:
            break
        every = every_next
    return named.join(labels, "id").select("key", "least", "root")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents with one row of each class of ``similar_classes``: that of the smallest doc_id (ties: by the text's key)."""
    classes = stored(similar_classes(docs, words, similarity))
    first = classes.groupBy("root").agg(F.min(F.struct(F.coalesce("least", F.lit(2**63 - 1)).alias("i"), F.col("least").alias("least"), "key")).alias("s"))
    keep = first.select(F.struct(F.col("s.least").alias("i"), F.col("s.key").alias("key")).alias("_keep"))
    rows, own = set_aside(docs, "doc_id", "text")
    # one column of the same type on both sides, so that the join's partitions serve the removal of repeated rows too
    key = F.struct(F.col("doc_id").alias("i"), text_key(plain("text")).alias("key"))
    rows = rows.withColumn("_k", key.cast(keep.schema["_keep"].dataType))
    return rows.join(keep, F.col("_k") == F.col("_keep"), "left_semi").dropDuplicates(["_k"]).select(*own)
