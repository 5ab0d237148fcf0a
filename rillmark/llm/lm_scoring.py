"""Cross-entropy difference of two matched n-gram models: counts of words, which lean on trigrams of bytes for their spelling."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import fields, plain, stored

#: Spelling: trigrams over the 256 byte values, 2^24 at most whatever the corpus, and the weight of the shorter context in each longer one.
ORDER, SYMBOLS = 3, 256
GRAMS = SYMBOLS**ORDER
BACKOFF = 8.0
#: Bytes of text of a block on average, and the blocks over which the texts of one id are spread.
BLOCK, SPREAD = 16 << 20, 8
#: Words that one batch takes, and different words after which a block hands on what it has counted so far.
BATCH, HELD = 1 << 16, 1 << 20


def spelled(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all bytes' trigrams, word after word, and where each word's begin. A word starts after two zeros and ends with a space."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    sizes = np.diff(offsets)
    starts = np.concatenate([[0], np.cumsum(sizes + 3)])
    b = np.zeros(starts[-1], np.int32)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    b[np.arange(len(data)) + np.repeat(3 * np.arange(len(words)) + 2, sizes)] = data
    b[starts[1:] - 1] = ord(" ")
    whole = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    inside = np.ones(len(whole), bool)  # but for those that reach into the next word
    for k in (1, 2):
        inside[starts[1:-1] - k] = False
    return whole[inside], np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, target, background): how often each trigram of bytes occurs in words (word, target, background)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            gram, starts = spelled(batch.column("word"))
            times = np.diff(np.append(starts, len(gram)))
            found, place = np.unique(gram, return_inverse=True)
            sums = [pa.array(np.bincount(place, np.repeat(batch.column(c).to_numpy(), times)).astype(np.int64)) for c in ("target", "background")]
            yield pa.RecordBatch.from_arrays([pa.array(found), *sums], ["gram", "target", "background"])

    parts = words.mapInArrow(run, "gram int, target long, background long")
    return parts.groupBy("gram").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def losses(gram: np.ndarray, count: np.ndarray) -> np.ndarray:
    """-ln p of every trigram: each order's estimate leans on the next shorter one with weight BACKOFF, the shortest on equal chances."""
    c2 = np.bincount(gram & 0xFFFF, weights=count, minlength=SYMBOLS**2).reshape(SYMBOLS, SYMBOLS)
    c1 = c2.sum(axis=0)
    p1 = (c1 + BACKOFF / SYMBOLS) / (c1.sum() + BACKOFF)
    p2 = (c2 + BACKOFF * p1) / (c2.sum(axis=1, keepdims=True) + BACKOFF)
    before = np.bincount(gram >> 8, weights=count, minlength=SYMBOLS**2).reshape(SYMBOLS, SYMBOLS, 1)
    p3 = np.zeros(GRAMS, np.float32)
    p3[gram] = count
    p3 = p3.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    p3 += (BACKOFF * p2).astype(np.float32)
    p3 /= (before + BACKOFF).astype(np.float32)
    np.log(p3, out=p3)
    return np.negative(p3, out=p3).reshape(-1)


def word_losses(words: DataFrame) -> DataFrame:
    """(word, lt, lb): -ln p of every word under both models.

    p(w) = (c(w) + V s(w)) / (N + V) with N words, V different ones, and s the spelling's chance, which sums to 1 over all words there can be: the
    models have one open vocabulary. A model without words has V = 1.
    """
    spark = words.sparkSession
    counts = gram_counts(words).toPandas()  # 2^24 rows at most
    sums = [F.sum(c).alias(f"n_{c}") for c in ("target", "background")] + [F.count_if(F.col(c) > 0).alias(f"v_{c}") for c in ("target", "background")]
    total = words.agg(*sums).first()
    sent = spark.sparkContext.broadcast([counts[c].to_numpy(np.int64) for c in ("gram", "target", "background")])
    names = [("target", "lt"), ("background", "lb")]
    size = {c: (total[f"n_{c}"] or 0, max(1, total[f"v_{c}"])) for c, _ in names}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, *both = sent.value
        models = None
        for batch in batches:
            if not len(batch):
                continue
            models = models or [losses(gram, c) for c in both]
            at, starts = spelled(batch.column("word"))
            out = [batch.column("word")]
            for (c, _), model in zip(names, models):
                n, v = size[c]
                spelling = np.add.reduceat(model[at].astype(np.float64), starts)
                with np.errstate(divide="ignore"):  # words that the target lacks
                    seen = np.log(batch.column(c).to_numpy())
                out.append(pa.array((np.log(n + v) - np.logaddexp(seen, np.log(v) - spelling)).astype(np.float32)))
            yield pa.RecordBatch.from_arrays(out, ["word", *(x for _, x in names)])

    return words.mapInArrow(run, "word binary, lt float, lb float")


def _dealt(rows: DataFrame, others: DataFrame, blocks: int) -> DataFrame:
    """Both tables dealt out by block; in each block the rows of ``others`` come first."""
    both = others.select("*", F.lit(0).alias("kind")).unionByName(rows.select("*", F.lit(1).alias("kind")), allowMissingColumns=True)
    return both.repartition(blocks, "block").sortWithinPartitions("block", "kind")


def _runs(block: np.ndarray, kind: np.ndarray) -> Iterator[tuple[int, int]]:
    """(begin, end) of the runs of one block and kind."""
    if len(block):
        cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)])


def block_words(rows: DataFrame, chosen: DataFrame, blocks: int) -> DataFrame:
    """(block, word, target, background): the words of each block of texts and how often they occur, in chosen documents and in all."""

    def out(block, both) -> Iterator[pa.RecordBatch]:
        own, every = both
        names = list(every)
        for i in range(0, len(names), BATCH):
            part = names[i : i + BATCH]
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int32()), pa.array(part, pa.binary()), pa.array([own[w] for w in part], pa.int64()), pa.array([every[w] for w in part], pa.int64())],
                                             ["block", "word", "target", "background"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, both = None, set(), (Counter(), Counter())
        for batch in batches:
            block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            for begin, end in _runs(block, kind):
                if block[begin] != now:
                    yield from out(now, both)
                    now, ids, both = int(block[begin]), set(), (Counter(), Counter())
                if kind[begin] == 0:
                    ids.update(batch.column("doc_id")[begin:end].to_pylist())
                    continue
                own, every = both
                for doc, text in zip(batch.column("doc_id")[begin:end].to_pylist(), batch.column("text")[begin:end]):
                    # split() of bytes knows just the white space of the contract
                    found = text.as_py().split()
                    every.update(found)
                    if doc is not None and doc in ids:
                        own.update(found)
                    if len(every) > HELD:
                        yield from out(now, both)
                        both = own, every = Counter(), Counter()
        yield from out(now, both)

    marks = chosen.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"))
    marks = marks.select("doc_id", _block("doc_id", F.col("part"), blocks).alias("block"))
    dealt = _dealt(rows, marks, blocks).select("block", "kind", "doc_id", "text")
    return dealt.mapInArrow(run, "block int, word binary, target long, background long")


def _block(doc_id: str, part: Column, blocks: int) -> Column:
    """A block for an id's texts: one of SPREAD ones, by ``part``."""
    return (F.pmod(F.xxhash64(doc_id), F.lit(blocks // SPREAD)) * SPREAD + part).cast("int")


def score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_tokens, loss_target, loss_background, score for documents (doc_id, text): per-token losses under two models, and their
    difference (low: more like the target).

    ``target`` (doc_id) names the documents of the target model; the background model is made of all documents. Tokens are words, as they
    are written; both models have the same vocabulary, order and smoothing. Counts cover every word of every document, so the tables grow with
    the corpus and stay distributed: texts are dealt out in blocks, each block asks for the losses of its different words, and gets them back
    by a join. Only the spelling's trigrams, at most 2^24, go through the driver. Texts without words have losses and score 0; missing ids match
    no target; repeated ids in ``target`` count once; without target documents its model knows nothing and gives every byte the same chance.
    """
    spark = docs.sparkSession
    rows = fields(docs, "doc_id", "text").select("doc_id", plain("text").cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = SPREAD * (1 + size // (SPREAD * BLOCK))
    by_id = _block("doc_id", F.pmod(F.xxhash64("text"), F.lit(SPREAD)), blocks)
    # missing ids match nothing, so their texts go anywhere
    rows = rows.withColumn("block", F.when(F.col("doc_id").isNotNull(), by_id).otherwise(F.pmod(F.xxhash64("text"), F.lit(blocks)).cast("int")))
    chosen = fields(target, "doc_id").select(F.col("doc_id").cast(rows.schema["doc_id"].dataType)).filter("doc_id is not null").distinct()
    asked = stored(block_words(rows, chosen, blocks))
    words = stored(asked.groupBy("word").agg(F.sum("target").alias("target"), F.sum("background").alias("background")))
    told = word_losses(words).withColumnRenamed("word", "_word")
    answers = asked.select("block", "word").join(told.hint("merge"), F.col("word") == F.col("_word")).select("block", "word", "lt", "lb")
    dealt = _dealt(rows, answers, blocks).select("block", "kind", "doc_id", "text", "word", "lt", "lb")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place, held = None, {}, []
        for batch in batches:
            block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            for begin, end in _runs(block, kind):
                if block[begin] != now:
                    now, place, held, loss = int(block[begin]), {}, [], None
                if kind[begin] == 0:
                    # a word may come twice, with the same losses
                    place.update(zip(batch.column("word")[begin:end].to_pylist(), range(n := sum(map(len, held)), n + end - begin)))
                    held.append(np.stack([batch.column(x)[begin:end].to_numpy() for x in ("lt", "lb")], axis=1).astype(np.float64))
                    continue
                if loss is None:
                    loss = np.concatenate(held) if held else np.zeros((0, 2))
                    held = [loss]
                sizes, sums = [], []
                for text in batch.column("text")[begin:end]:
                    at = np.fromiter(map(place.__getitem__, text.as_py().split()), np.int64)
                    sizes.append(len(at))
                    sums.append(loss[at].sum(axis=0) / max(1, len(at)))
                t, b = np.array(sums).T
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[begin:end], pa.array(sizes, pa.int64()), pa.array(t), pa.array(b), pa.array(t - b)], ["doc_id", "n_tokens", "loss_target", "loss_background", "score"])

    return dealt.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, loss_target double, loss_background double, score double")
