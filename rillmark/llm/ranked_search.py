"""Ranked lexical search: integer impacts in lists by falling impact, read by the Best Position Algorithm shard by shard."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rillmark.llm.common import fields, plain, stored

#: What separates terms, as spaces, and A-Z as a-z; terms are runs of the other bytes of the UTF-8 text (fixed by the contract).
TERMS = bytes(b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
#: Bytes of a text whose terms are listed at a time; bytes of items that one pass over the documents answers.
PART, WAVE_BYTES = 1 << 22, 16 << 20
#: Documents and postings of a shard at most (one document more may come in), and bytes of position tables that it keeps.
SHARD_DOCS, SHARD_POSTINGS, TABLE_BYTES = 8192, 1 << 21, 64 << 20
#: Positions of each list that the first step reads; each further step reads twice as many as the one before.
FIRST_STEP = 8


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, some at a time."""
    low, begin = text.translate(TERMS), 0
    while begin < len(low):
        end = low.find(b" ", begin + PART) if len(low) - begin > PART else -1
        end = end if end >= 0 else len(low)
        yield low[begin:end].split()
        begin = end


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms of the text), ids (of the terms of ``vocabulary`` in it) and counts, for all documents (doc_id, text)."""
    rows = fields(docs, "doc_id", "text", doc_id="long").select("doc_id", plain("text").cast("binary").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary)}
        for batch in batches:
            sizes, ids, counts = [], [], []
            for text in batch.column("text"):
                n, found = 0, Counter()
                for part in terms_of(text.as_py()):
                    n += len(part)
                    found.update(filter(number.__contains__, part))
                sizes.append(n)
                ids.append([number[t] for t in found])
                counts.append(list(found.values()))
            arrays = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "ids", "counts"])

    return rows.mapInArrow(run, "doc_id long, n long, ids array<int>, counts array<long>")


class Shard:
    """Impact lists of some documents: for each term its documents by falling impact."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, size: int):
        order = np.lexsort((docs, -impacts, terms))
        self.docs, self.impacts, self.size = docs[order], impacts[order], size
        names, begins = np.unique(terms[order], return_index=True)
        self.lists = dict(zip(names.tolist(), zip(begins.tolist(), np.append(begins[1:], len(order)).tolist())))
        self.tables: dict[int, np.ndarray] = {}
        self.read = self.scored = 0  # positions read in order, documents looked up

    def _table(self, term: int) -> np.ndarray:
        """The place of each document's posting of the term; -1 where it has none."""
        if term not in self.tables:
            if (len(self.tables) + 1) * 4 * self.size > TABLE_BYTES:
                self.tables.clear()
            table = np.full(self.size, -1, np.int32)
            begin, end = self.lists[term]
            table[self.docs[begin:end]] = np.arange(begin, end, dtype=np.int32)
            self.tables[term] = table
        return self.tables[term]

    def search(self, weights: list[tuple[int, int]], best: "Best") -> None:
        """Offer ``best`` every document that can be among the k best for the (term, weight) pairs.

        All lists are read in step. A document seen for the first time is looked up in all lists, which tells its score and marks its
        position in each as seen. In a list whose positions up to p have all been seen, no new document has more than the impact at
        p + 1; the weighted sum of these over the lists bounds all new documents, and it falls faster than what the positions read so
        far would tell, as lookups fill positions in advance. Reading ends when the bound is strictly below the k-th score, so that ties
        of it are still found, or when all lists are through.
        """
        lists = [(t, w, *self.lists[t]) for t, w in weights if t in self.lists]
        if not lists:
            return
        weight = np.array([w for _, w, _, _ in lists], np.int64)
        tip = np.array([b for _, _, b, _ in lists], np.int64)
        ends = np.array([e for *_, e in lists], np.int64)
        first, step, depth = tip.copy(), FIRST_STEP, 0
        if best.full and int(weight @ self.impacts[tip]) < best.least:
            return
        places = np.stack([self._table(t) for t, *_ in lists])
        known = np.zeros(self.size, bool)
        seen = np.zeros(len(self.docs) + 1, bool)
        while True:
            part = [self.docs[b + depth : min(b + depth + step, e)] for b, e in zip(first, ends) if b + depth < e]
            self.read += sum(map(len, part))
            new = np.unique(np.concatenate(part))
            new = new[~known[new]]
            known[new] = True
            self.scored += len(new)
            at = places[:, new]
            there = at >= 0
            best.offer(new, weight @ np.where(there, self.impacts[at], 0))
            seen[at[there]] = True
            for i, (p, e) in enumerate(zip(tip.tolist(), ends.tolist())):
                if p < e and seen[p]:
                    gap = int(np.argmin(seen[p:e]))
                    tip[i] = e if seen[p + gap] else p + gap
            open_ = tip < ends
            bound = int(weight[open_] @ self.impacts[tip[open_]])
            depth += step
            step *= 2
            if not open_.any() or (best.full and bound < best.least):
                return


class Best:
    """The k documents of highest score that a task has found for an item: ties to the smaller id, missing ids last."""

    def __init__(self, k: int):
        self.k, self.rows, self.ids = k, [], None

    @property
    def full(self) -> bool:
        return len(self.rows) == self.k

    @property
    def least(self) -> int:
        return -self.rows[-1][0]

    def offer(self, docs: np.ndarray, scores: np.ndarray) -> None:
        """Documents by their place in ``ids``, the ids of the shard at hand."""
        good = scores >= max(1, self.least if self.full else 1)
        docs, scores = docs[good], scores[good]
        if len(docs) > self.k:  # none below the k-th of these can stay
            cut = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            docs, scores = docs[cut], scores[cut]
        if len(docs):
            found = [(-s, i is None, i or 0) for s, i in zip(scores.tolist(), (self.ids[d] for d in docs.tolist()))]
            self.rows = sorted(self.rows + found)[: self.k]


def _answers(items: list[list[tuple[int, int]]], names: pa.Array, documents: int, terms: int, k: int):
    """A task's best documents of each item: impact lists of up to SHARD_DOCS documents at a time, searched for one item after the other."""

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Shard, list]]:
        ids, where, words, counts, lengths, held, size = [], [], [], [], [], 0, 0
        for batch in batches:
            begin = 0
            while begin < batch.num_rows:
                offsets = batch.column("ids").offsets.to_numpy()[begin:]
                room = int(np.searchsorted(offsets - offsets[0], SHARD_POSTINGS - held, side="right"))
                take = max(1, min(SHARD_DOCS - size, batch.num_rows - begin, room))
                some = batch.slice(begin, take)
                per = np.diff(some.column("ids").offsets.to_numpy())
                ids += some.column("doc_id").to_pylist()
                where.append(np.repeat(np.arange(size, size + take), per))
                words.append(some.column("ids").flatten().to_numpy())
                counts.append(some.column("counts").flatten().to_numpy())
                lengths += some.column("n").to_pylist()
                held, size, begin = held + len(words[-1]), size + take, begin + take
                if size >= SHARD_DOCS or held >= SHARD_POSTINGS:
                    yield _shard(where, words, counts, lengths), ids
                    ids, where, words, counts, lengths, held, size = [], [], [], [], [], 0, 0
        if held:
            yield _shard(where, words, counts, lengths), ids

    def _shard(where: list, words: list, counts: list, lengths: list[int]) -> Shard:
        m = np.array([25 + 75 * n * documents // terms for n in lengths], np.int64)
        docs, tf = np.concatenate(where).astype(np.int32), np.concatenate(counts)
        return Shard(docs, np.concatenate(words), 1_000_000_000 * tf // (1000 * tf + 8 * m[docs]), len(lengths))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for shard, ids in shards(batches):
            for weights, own in zip(items, best):
                own.ids = ids
                shard.search(weights, own)
        out = [(i, None if none else d, -s) for i, b in enumerate(best) for s, none, d in b.rows]
        item = pa.array([i for i, _, _ in out], pa.int32())
        yield pa.RecordBatch.from_arrays([item, names.take(item), pa.array([d for _, d, _ in out], pa.int64()), pa.array([s for *_, s in out], pa.int64())],
                                         ["item", "item_id", "doc_id", "score"])

    return run


def _wave(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(item, item_id, doc_id, score) of each task's best documents for items of WAVE_BYTES together, which go through the driver."""
    rows = items.collect()
    asked = [Counter(t for part in terms_of((r.text or "").encode("utf-8", "replace")) for t in part) for r in rows]
    vocabulary = sorted(set().union(*asked))
    number = {t: i for i, t in enumerate(vocabulary)}
    kind = items.schema["item_id"].dataType
    lists = stored(postings(docs, vocabulary))
    count = lists.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    held = {r.id: r["count"] for r in lists.select(F.explode("ids").alias("id")).groupBy("id").count().collect()}
    weight = {i: math.floor(1000 * math.log((2 * count.documents + 2) / (2 * df + 1))) for i, df in held.items()}
    wanted = [[(number[t], n * weight[number[t]]) for t, n in sorted(a.items()) if weight.get(number[t], 0) > 0] for a in asked]
    run = _answers(wanted, pa.array([r.item_id for r in rows], to_arrow_type(kind)), count.documents, count.terms or 1, k)
    return lists.filter(F.size("ids") > 0).mapInArrow(run, f"item int, item_id {kind.simpleString()}, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents (doc_id, text) of highest score above 0 for each item (item_id, text).

    Equal scores go by ascending doc_id (missing last). Missing and empty texts have no terms and are never found; every row of documents is
    one of its own, also where ids repeat; an item that comes twice with the same text is answered once, and several texts of one item_id
    each by themselves. Empty tables give no rows; other columns are not looked at. The documents' texts are read once for each WAVE_BYTES
    of items: postings of the items' terms are kept, counted, and searched where they lie, in shards of bounded size, and each task hands over
    k rows an item at most. Statistics are of all documents.
    """
    asked = stored(fields(items, "item_id", "text").distinct())
    total = asked.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0]
    waves = max(1, -(-(total or 0) // WAVE_BYTES))
    parts = []
    for wave in range(waves):
        own = asked if waves == 1 else asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(waves)) == wave)
        found = _wave(docs, own, k)
        parts.append(found if waves == 1 else stored(found))
    by = F.desc("score"), F.col("doc_id").asc_nulls_last()
    ranked = [p.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by))).filter(F.col("rank") <= k) for p in parts]
    every = ranked[0]
    for part in ranked[1:]:
        every = every.unionByName(part)
    return every.select("item_id", "rank", "doc_id", "score")
