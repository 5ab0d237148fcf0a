"""Ranked search, token counts and vector codes against brute force on small tables with missing, empty, long, repeated and tied rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillmark.llm import ranked_search, token_counts, vector_codes

rng = np.random.default_rng(9)
WORDS = [f"w{i}" for i in range(60)] + ["Ünder", "日本", "the", "The"]
DOCUMENT = "doc_id long, text string, DOC_ID string, score string"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low(text))


def draw(n):
    return " ".join(WORDS[i] for i in np.minimum(rng.geometric(0.08, n) - 1, len(WORDS) - 1))


def test_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 64)
    monkeypatch.setattr(ranked_search, "PART", 40)
    texts = [draw(int(n)) for n in rng.integers(1, 60, 400)] + [None, "", " ,;. ", "the\x00the THE_the", "x" * 5000, draw(4000)] + ["w1 w2 w3 w9"] * 30
    rows = [(i, t, "other", "other") for i, t in enumerate(texts)] + [(3, texts[3], "again", ""), (None, "w1 w2 w3 w9", "no id", "")]
    items = [(i, draw(8)) for i in range(40)] + [(50, None), (51, ""), (52, "notthere"), (53, "w1 w2 w3 w9 w1"), (53, "w1 w2 w3 w9 w1"), (54, "THE the Ünder 日本"), (None, "w4")]
    docs = spark.createDataFrame(rows, DOCUMENT).repartition(3)
    got = defaultdict(list)
    for r in ranked_search.search(docs, spark.createDataFrame(items, "item_id long, text string"), 10).collect():
        got[r.item_id].append((r["rank"], r.doc_id, r.score))
    counts = [(d, Counter(terms(t))) for d, t, *_ in rows]
    n_docs, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    for item, text in dict.fromkeys(items):
        scores = []
        for d, c in counts:
            m = 100 - 75 + 75 * c.total() * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        want = [(k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scores)[:10])]
        assert sorted(got[item]) == want
    assert len(got[53]) == 10 and not got[50] and not got[52]
    none = docs.filter("false")
    assert ranked_search.search(none, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert ranked_search.search(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_search_in_waves(spark, monkeypatch):
    docs = spark.createDataFrame([(i, draw(30), "", "") for i in range(100)], DOCUMENT)
    items = spark.createDataFrame([(i, draw(6)) for i in range(30)], "item_id long, text string")
    one = sorted(ranked_search.search(docs, items, 3).collect())
    monkeypatch.setattr(ranked_search, "WAVE_BYTES", 300)
    assert sorted(ranked_search.search(docs, items, 3).collect()) == one and len(one) > 60


def test_best_positions_stop_early():
    """Common words with a falling impact and a few documents with most of them: few positions are read, and every answer is right."""
    size, lists = 5000, 6
    docs = np.concatenate([rng.permutation(size) for _ in range(lists)]).astype(np.int32)
    impacts = np.concatenate([np.sort(rng.pareto(1.5, size) * 1000).astype(np.int64)[::-1] + 1 for _ in range(lists)])
    words = np.repeat(np.arange(lists), size)
    for i in range(12):  # documents that lead in all lists
        at = docs == i
        impacts[at] = 10**6 + i // 2
    shard, best = ranked_search.Shard(docs, words, impacts, size), ranked_search.Best(10)
    best.ids = list(range(size))
    weights = [(t, 3 + t) for t in range(lists)]
    shard.search(weights, best)
    total = np.zeros(size, np.int64)
    np.add.at(total, docs, impacts * (3 + words))
    want = sorted((-int(s), False, i) for i, s in enumerate(total))[:10]
    assert best.rows == want
    assert shard.read < size * lists / 50 and shard.scored < size / 20
    before = shard.read
    shard.search([(0, 1)], best)  # cannot reach the k-th score: not a position is read
    assert shard.read == before and best.rows == want


PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts_equal_the_library(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_PARTS", 500)
    parts = [" ", "  ", "\n", "\n\n", " \n", "\t", " ", "　", "\x1c", "\x85", "a", "b", "é", "日本", "🙂", "1", "²", "'s", "!", "<|endoftext|>", "<|", "ab", " the", "x" * 60, "\r\n", "​", " <b>"]
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts), n)) for n in rng.integers(0, 30, 3000)]
    texts += [None, "", "a", "a", "word " * 3000, "x" * 100_000, " " * 5000 + "a", "<|endoftext|>", "a" * 1024 + " b", "many words " * 200_000]
    library = Tokenizer.from_file(PATH)
    docs = spark.createDataFrame([(i if i % 7 else None, t, "x", "y") for i, t in enumerate(texts)], DOCUMENT).repartition(3)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, PATH).collect())
    want = Counter()
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False))
        want[(i if i % 7 else None, len((t or "").encode()), n, n > 1024)] += 1
    assert got == want
    assert token_counts.token_counts(docs.filter("false"), PATH).count() == 0


def test_token_counts_of_other_files(spark):
    texts = ["Some words, of a text.", "", None, "two\nlines  and more", "Ünder 日本 🙂 <s>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    assert [r.n_tokens for r in token_counts.token_counts(docs, path).orderBy("doc_id").collect()] == [len(library.encode(t or "", add_special_tokens=False)) for t in texts]
    sentencepiece = pytest.importorskip("sentencepiece")
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert [r.n_tokens for r in token_counts.token_counts(docs, path).orderBy("doc_id").collect()] == [len(library.encode(t or "")) for t in texts]


def test_batches_by_bytes_cut_at_safe_places():
    text = "ab cd\n\nef  gh <|endoftext|> ij" * 40
    for size in (1, 7, 100):
        parts = list(token_counts.safe_parts(text, size))
        assert "".join(parts) == text and all(re.match(r"[ \n][^<\s]", p) for p in parts[1:])
    batches = list(token_counts.batches_by_bytes(["x" * 10] * 25 + ["word " * 100], True, 50))
    assert sum(len(p) for p, _ in batches) == sum(len(o) for _, o in batches) and all(sum(map(len, p)) < 50 + 60 for p, _ in batches)


def codes(rows, entries=256, rounds=4):
    """The definition, with all distances; rows are (vec_id, label, vector)."""
    def whole(v):
        return [min(2**25, max(-(2**25), math.floor(x * 1024))) for x in v]

    kept = sorted(((d is None, d or 0, whole(v), label) for d, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: r[:3])
    width = -(-max(len(r[2]) for r in kept) // 4) * 4
    points = np.array([r[2] + [0] * (width - len(r[2])) for r in kept], np.int64).reshape(len(kept), 4, width // 4)
    books = points[:entries].copy()
    for _ in range(rounds + 1):
        distances = ((points[:, None] - books[None]) ** 2).sum(3)
        nearest, last = distances.argmin(1), books.copy()
        for part in range(4):
            for e in set(nearest[:, part].tolist()):
                own = points[nearest[:, part] == e, part]
                books[e, part] = own.sum(0) // len(own)
    errors = distances.min(1).sum(1)
    by_label = Counter()
    for r, e in zip(kept, errors):
        by_label[r[3]] += int(e)
    digest = hashlib.sha256(",".join(str(x) for x in last.transpose(1, 0, 2).ravel()).encode()).hexdigest()
    return Counter((None if r[0] else r[1], "".join(f"{x:02x}" for x in n), int(e), by_label[r[3]], digest) for r, n, e in zip(kept, nearest, errors))


def check_codes(spark, rows, extra=()):
    table = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, label int, LABEL string").repartition(4)
    got = Counter(tuple(r) for r in vector_codes.vector_codes(table).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
    assert got == codes(rows)


def test_vector_codes(spark):
    centres = rng.normal(size=(12, 16))
    rows = [(int(i), (centres[rng.integers(12)] + rng.normal(size=16) * 0.1).tolist(), int(rng.integers(3)) if rng.random() < 0.6 else 7 if rng.random() < 0.9 else None) for i in rng.permutation(700)]
    rows += rows[:20] + [(900 + i, rows[0][1], 1) for i in range(50)]  # repeated rows, and copies
    rows += [(1000, None, 1), (1001, [1.0] * 15 + [None], 1), (1002, [1.0] * 15 + [float("nan")], 2), (1003, [float("inf")] * 16, 2), (None, rows[3][1], None)]
    check_codes(spark, rows)


def test_vector_codes_of_odd_tables(spark):
    check_codes(spark, [(i, [float(x) for x in rng.normal(size=3)], 0) for i in range(9)] + [(20, [1.0] * 6, 1), (21, [], 1), (22, [0.5], None)])
    check_codes(spark, [(i, [1e300, -1e12, 0.25, 3e4] if i % 3 else [1.0, 2.0, 3.0, float(i)], i % 2) for i in range(300)])
    check_codes(spark, [(5, [0.5, 0.25], None)])
    none = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<double>, label int")
    assert vector_codes.vector_codes(none).count() == 0 and vector_codes.vector_codes(none.filter("false")).count() == 0


def test_grid_is_exact_and_memory_spares_work():
    book = rng.integers(-500, 500, (256, 3))
    points = rng.integers(-600, 600, (20_000, 3))
    want = ((points[:, None] - book[None]) ** 2).sum(2)
    for shift in (0, 3, 6, 12):
        entry, error = vector_codes.Grid(book, shift).nearest(points)
        assert (entry == want.argmin(1)).all() and (error == want.min(1)).all()
    grid = vector_codes.Grid(book, vector_codes.coarsest_shift(points[:256], book))
    grid.nearest(points)
    assert grid.evaluated <= 20_000 * 256 / 16 and len(grid.cells) < 20_000 / 2
    tied = vector_codes.Grid(np.array([[4, 0], [0, 4], [4, 0], [-4, 0]]), 2).nearest(np.array([[0, 0], [4, 0], [3, 3]]))
    assert tied[0].tolist() == [0, 0, 0] and tied[1].tolist() == [16, 0, 10]
