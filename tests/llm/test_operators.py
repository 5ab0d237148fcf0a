"""The training-data operators against brute force on small tables with missing, empty, long and repeated rows."""

import base64
import collections
import hashlib
import heapq
import io
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from rillmark.llm.common import begin_task, stored
from rillmark.llm import bpe, jpeg, line_dedup, lm_scoring, mixing, pii, sharding, simhash, topk, toxicity

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = "alpha beta gamma delta omega the of and in to".split()
rng = np.random.default_rng(5)
LINE = "This very line is in many of the documents, and long enough."
TEXTS = [None, "", "   \t\n", "one", "One  TWO", "é🙂 ü x", LINE, "a\n" + LINE + "\nb", " " + LINE.upper() + "\t\nz", LINE + "\n" + LINE,
         LINE + "\nq", "mail a.b@c.de or 10.0.0.1, 999.1.1.1; 4111 1111 1111 1111 and 4111111111111112, call +1 (202) 555-0143!", "x" * 5000 + " " + "9" * 3000]
TEXTS += [" ".join(rng.choice(WORDS, n)) for n in (4, 6, 40, 200, 3000)] + ["one", "idiot you"]
ROWS = [(i, t, "en", None if i % 4 == 0 else f"s{i % 3}", len(t or ""), "clash") for i, t in enumerate(TEXTS)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).select("*", F.lit(1).alias("TEXT")).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_mixing(docs, none):
    rows = mixing.mix(docs).rows.collect()
    sizes = {i: len(words(t)) for i, t, *_ in ROWS}
    total = collections.Counter()
    for i, _, _, s, *_ in ROWS:
        total[s] += sizes[i]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(total, key=lambda s: (s is None, s or "")))}
    target, open_, left = {}, set(total), float(sum(total.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * total[s]] or list(open_)
        for s in over:
            target[s] = min(share[s], 3.0 * total[s])
            open_.discard(s)
            left -= target[s]
    taken = collections.Counter()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r["size"] == sizes[r.doc_id] and r.source_size == total[r.source] and abs(r.target - target[r.source]) < 1e-6 * (1 + r.target) and r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(taken[s] == int(target[s] + 1e-9) for s in total)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(5)).rows.collect()), key=str)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words(r[1])) for r in mixed.collect()) == sum(taken.values())
    assert mixing.mix(none).rows.count() == 0


def test_schedule_is_even(spark, docs):
    m = mixing.mix(docs)
    slots = m.slots.join(m.sources, "source_no").select("slot", "source_no", "target").toPandas()
    total = m.sources.agg(F.sum("target")).first()[0]
    first = slots[slots.slot < 500]
    for no, part in slots.groupby("source_no"):
        assert abs((first.source_no == no).sum() - 500 * part.target.iloc[0] / total) < 8 and part.slot.is_unique


def test_language_model(spark, docs, none):
    target = spark.createDataFrame([(14,), (15,), (15,), (None,)], "doc_id long")
    got = {r.doc_id: r for r in lm_scoring.score(docs, target).collect()}
    counts = [collections.Counter(), collections.Counter()]
    for i, t, *_ in ROWS:
        counts[1].update(words(t))
        counts[0].update(words(t) if i in (14, 15) else ())
    for m, name in ((0, "loss_target"), (1, "loss_background")):
        c3, c2, ctx2, c1 = collections.Counter(), collections.Counter(), collections.Counter(), collections.Counter()
        before = collections.Counter()
        for word, n in counts[m].items():
            b = b"\0\0" + word.encode() + b" "
            for x, y, z in zip(b, b[1:], b[2:]):
                c3[x, y, z] += n; c2[y, z] += n; ctx2[y] += n; c1[z] += n; before[x, y] += n
        n1, k = sum(c1.values()), lm_scoring.BACKOFF
        total, kinds = sum(counts[m].values()), len(counts[m])
        for i in (5, 7, 11, 14, 15, 17):
            loss = 0.0
            for word in words(TEXTS[i]):
                b, spelling = b"\0\0" + word.encode() + b" ", 1.0
                for x, y, z in zip(b, b[1:], b[2:]):
                    p1 = (c1[z] + k / 256) / (n1 + k)
                    p2 = (c2[y, z] + k * p1) / (ctx2[y] + k)
                    spelling *= (c3[x, y, z] + k * p2) / (before[x, y] + k)
                loss -= np.log((counts[m][word] + kinds * spelling) / (total + kinds))
            assert abs(got[i][name] - loss / len(words(TEXTS[i]))) < 1e-4 and got[i].n_tokens == len(words(TEXTS[i]))
    assert all(r.score == 0 for r in lm_scoring.score(docs.filter("doc_id < 3"), target).collect())
    assert got[14].score < got[12].score and got[0].score == 0 and len(got) == len(ROWS)
    assert lm_scoring.score(none, target).count() == 0


def brute_classes(texts):
    def fp(t):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(x).encode(), 42) for x in (zip(w, w[1:], w[2:]) if len(w) >= 3 else [w] if w else [])]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = {i: fp(t) for i, t in texts.items()}
    root = {i: i for i in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    return {i: (f"{fps[i]:016x}", root[i]) for i in fps}


def test_simhash(docs, none):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_classes(docs).collect()}
    assert got == brute_classes(dict(enumerate(TEXTS)))
    assert simhash.near_classes(none).count() == 0


def test_close_pairs_of_crowded_buckets(spark):
    flips = {0} | {1 << i for i in range(16)} | {1 << i | 1 << j for i in range(16) for j in range(i)} | {0b1111 << i for i in range(40)}
    rows = spark.createDataFrame([(f,) for f in flips], "f long")
    roots = {r.node: r.root for r in simhash.components(simhash.close_pairs(rows)).collect()}
    nodes = sorted(flips)
    own = {n: n for n in nodes}
    for _ in range(4):
        for a in nodes:
            for b in nodes:
                if (a ^ b).bit_count() <= 2:
                    own[a] = own[b] = min(own[a], own[b])
    assert {n: roots.get(n, n) for n in nodes} == own


def test_keep_one(spark):
    base = " ".join(f"w{i}" for i in range(400))
    near = base.replace("w200 ", "changed ")
    rows = [(1, base), (2, base), (3, near), (4, " ".join(f"v{i}" for i in range(300))), (5, None), (6, ""), (7, base), (7, base)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5]


def test_similar_classes_are_exact_within_crowded_buckets(spark, none):
    draw = np.random.default_rng(11)
    texts = []
    for _ in range(6):
        base = [f"w{x}" for x in draw.integers(0, 10**6, 120)]
        for share in (0.0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.2):
            texts.append(" ".join(f"z{draw.integers(0, 10**6)}" if draw.random() < share else x for x in base))
    hot = [f"h{x}" for x in range(200)]
    texts += [" ".join([*hot[:i], f"k{i}", *hot[i + 1 :]]) for i in range(60)] + ["a b c d e f g", "a b c d e f g h", "same words " * 300, "same words " * 200]
    texts = list(dict.fromkeys(texts))
    sets = [simhash.shingle_set(t.encode(), 5) for t in texts]
    own = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if common >= 0.8 * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                a, b = sorted((own[i], own[j]))
                own = [a if x == b else x for x in own]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = simhash.similar_classes(docs).collect()
    groups, want = collections.defaultdict(set), collections.defaultdict(set)
    for r in rows:
        groups[r.root].add(r.least)
    for i, root in enumerate(own):
        want[root].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values())) and len(want) < len(texts) - 60
    assert simhash.keep_one(none).count() == 0


def test_similar_classes_miss_no_pair(spark):
    draw, texts = np.random.default_rng(12), []
    for n, pairs in ((9, 60), (20, 120), (60, 120), (400, 120)):
        for similarity in np.linspace(0.8, 0.95, pairs):
            base = [f"w{x}" for x in draw.integers(0, 10**9, n + 4)]
            changed = int(n * (1 - similarity) / (1 + similarity) + 1e-9)  # of n shingles, at the end
            texts += [" ".join(base), " ".join(base[: n + 4 - changed] + [f"z{x}" for x in draw.integers(0, 10**9, changed)])]
    sets = [set(simhash.shingle_set(t.encode(), 5).tolist()) for t in texts]
    want = {i for i in range(0, len(texts), 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1]) - 1e-9}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    root = {r.least: r.root for r in simhash.similar_classes(docs).collect()}
    assert {i for i in range(0, len(texts), 2) if root[i] == root.get(i + 1, root[i])} == want and len(want) > 400  # equal texts are one row
    assert len(set(root.values())) == len(texts) - len(want)


def test_line_dedup(docs, none):
    strip = " \t\n\x0b\x0c\r"
    low = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(strip))
    where = collections.defaultdict(set)
    for i, t in enumerate(TEXTS):
        for line in (t or "").split("\n"):
            where[low(line)].add(i)
    got = {r.doc_id: r for r in line_dedup.drop_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept").collect()}
    for i, t in enumerate(TEXTS):
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(low(x)) < 40 or len(where[low(x)]) < 5 or max(where[low(x)]) == i]
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept) == (len(lines), len(lines) - len(kept), "\n".join(kept))
    assert sum(r.n_dropped for r in got.values()) > 3 and line_dedup.drop_lines(none).count() == 0


def test_line_runs_compact_and_admit(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for n in range(5):
        new = line_dedup.admit(runs, spark.createDataFrame([(k, k, n) for k in range(n, n + 3)], "h1 long, h2 long, doc long"))
        assert new.count() == (3 if n == 0 else 1)
    assert [len(x) for x in runs.levels] == [1, 0, 1] and runs.merged().count() == 7


def test_pii(docs, none):
    pats = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def right(kind, m):
        d = re.sub("[^0-9]", "", m)
        luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return kind == "email" or (all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else 12 <= len(d) <= 19 and luhn % 10 == 0 if kind == "card" else 9 <= len(d) <= 15)

    got = {r.doc_id: r for r in pii.summary(docs).collect()}
    for i, t in enumerate(TEXTS):
        spans = sorted((m.start(), k, m.end(), n) for k, (n, p) in enumerate(pats.items()) for m in re.finditer(p, t or "") if right(n, m[0]))
        assert got[i].base_spans == ",".join(f"{n}:{a}:{b}" for a, _, b, n in spans)
        assert set(got[i].base_spans.split(",")) <= set(got[i].spans.split(",")) or not spans
    text = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert text[11] == "mail [email] or [ip], 999.1.1.1; [card] and 4111111111111112, call [phone]!" and text[3] == "one" and text[0] is None
    assert pii.summary(none).count() == 0


def test_pii_adds_wide_forms(spark):
    draw = np.random.default_rng(3)

    def card():
        d = [int(x) for x in draw.integers(0, 10, 15)]
        d.append(-sum(x if i % 2 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10)
        return " ".join("".join(map(str, d[i : i + 4])) for i in range(0, 16, 4))

    rows = [(i, f"Please write to user{i}@site{i % 7}.org today. The server {'.'.join(map(str, draw.integers(1, 255, 4)))} is up. My card {card()} is new. "
                f"Then call +1 {draw.integers(200, 999)} 555 {draw.integers(1000, 9999)} now. See order {draw.integers(10**9, 10**10)} or 1, 2, 3, 4 there.") for i in range(300)]
    wanted = {"email": "bob.ray (at) example dot com", "card": "4111.1111.1111.1111", "phone": "202 555 0143", "ip": "10,20,130,41"}
    text = "Please write to {email}. Thanks. My card {card} is old. Then call {phone} now. The server {ip} is up.".format(**wanted)
    rows += [(1000, text), (1001, "My card 4111.1111.1111.1112 is old. Look at this. And see order 2025550143 then. The server 10,0,0,999 is up, or 1, 2, 3, 4 there. Call 2025 now.")]
    got = {r.doc_id: r for r in pii.summary(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got[1000].base_spans == "" and got[1001].spans == ""
    assert set(got[1000].spans.split(",")) == {f"{k}:{text.index(v)}:{text.index(v) + len(v)}" for k, v in wanted.items()}


def test_pii_learns_from_every_candidate(spark, monkeypatch):
    # 30,000 unsound numbers, more than any sample held, all count
    text = "tel +49 30 1234567 mail ann@example.org no 12345678901234567890123 " * 10
    rows = stored(pii._overlapping(pii.candidates(spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit(text), F.col("id").cast("string")).alias("text")))))
    wanted = rows.filter("valid or (wide = 1 and not covered)")
    valid, others = wanted.filter("valid").count(), wanted.filter("not valid and not sound").count()
    kept = []
    monkeypatch.setattr(pii, "stored", lambda df: kept.append(stored(df)) or kept[-1])
    pii.learn(rows)
    assert valid + others > 30_000
    assert kept[0].filter("wide = 0").agg(F.sum("n")).first()[0] == valid
    assert kept[0].agg(F.sum("n")).first()[0] >= valid + others


def test_tasks_free_what_other_operators_remember():
    bpe.encoder(PATH, PATTERN)("some words")
    begin_task(bpe.__name__)
    assert bpe.encoder.cache_info().currsize == 1
    begin_task(toxicity.__name__)
    assert bpe.encoder.cache_info().currsize == 0


def test_toxicity(spark, docs, none):
    rows = []
    for i in range(600):
        bad = i % 5 == 0
        t = " ".join(rng.choice(WORDS, 30))
        rows.append((i, t + (" you nasty" if bad and i % 2 else " nasty you awful" if bad else " you"), int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic")).collect()
    assert len(got) == 600
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got)
    labels = spark.createDataFrame([(3, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, labels).count() == len(ROWS) and toxicity.toxicity(none, labels).count() == 0


def test_toxicity_finds_compounds_of_few_stems(spark):
    """Toxic texts of four made-up languages; the marks of three are compounds, each of them rare."""
    draw, rows = np.random.default_rng(6), []
    syllables = {k: [a + b for a in p for b in "aeiou"] for k, p in {"a": "bdg", "b": "klm", "c": "nrt", "d": "svz"}.items()}
    stems = {"a": ["idiot", "moron", "loser"], "b": ["scheus", "dreck"], "c": ["imbec", "ordur"], "d": ["estup", "basur"]}
    word = lambda k: "".join(draw.choice(syllables[k], draw.integers(2, 5)))
    for i in range(2400):
        k = "abcd"[i % 7 % 4]
        toxic = draw.random() < 0.15
        text = [word(k) for _ in range(60)]
        if toxic:
            for place in draw.choice(60, 5, replace=False):
                text[place] = str(draw.choice(stems[k])) + (word(k) if k != "a" else "")
        rows.append((i, " ".join(text), k, int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").repartition(3)
    truth = {i: (k, t) for i, _, k, t in rows}
    held = [(truth[r.doc_id], r.predicted) for r in toxicity.toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic")).collect() if r.held_out]
    for k in "abcd":
        bad = [p for (lang, t), p in held if lang == k and t]
        assert sum(bad) >= 0.9 * len(bad) and len(bad) > 5
    clean = [p for (_, t), p in held if not t]
    assert sum(clean) <= 0.02 * len(clean)


def test_sharding(docs, none):
    got = {r.doc_id: r for r in sharding.shard(docs, 3).collect()}
    loads, by_text = [(0, s) for s in range(3)], collections.Counter()
    for t in TEXTS:
        by_text[t] += len((t or "").encode()) + 1
    for _, w in sorted(by_text.items(), key=lambda x: -x[1]):
        load, s = heapq.heappop(loads)
        heapq.heappush(loads, (load + w, s))
    sums, slots, where = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert r["size"] == len((t or "").encode()) + 1 and r.text_crc32 == zlib.crc32((t or "").encode())
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        where[t].add(r["shard"])
    assert max(sums.values()) <= max(x for x, _ in loads) and all(len(x) == 1 for x in where.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and sharding.shard(none, 3).count() == 0


def test_topk(spark):
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(150)] + [(150, None), (151, [1.0, None]), (152, [float("nan")]), (153, [float("inf")]), (None, [1.0]), (7, None)]
    rows += [(200 + i, [0.5] * 6) for i in range(8)] + [(300, [2.0, 1.0]), (10**12, [1e7] * 6)]
    vectors = topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = collections.defaultdict(list)
    for r in topk.search(vectors, vectors.filter("vec_id % 50 = 0"), 5).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = {i: [int(np.floor(256 * x)) for x in v] + [0] * (6 - len(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    for q in [i for i in good if i % 50 == 0]:
        best = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    empty = vectors.filter("vec_id < 0")
    assert topk.search(empty, empty, 5).count() == 0


def test_media_round_trip(docs, none):
    got = {r.doc_id: r for r in jpeg.media_columns(jpeg.store_texts(docs), "doc_id", "n_bytes").collect()}
    for i, t in enumerate(TEXTS):
        b = (t or "").encode()
        assert bytes(got[i].thumbnail) == b + bytes(-len(b) % 64 if b else 64) and got[i].n_bytes == len(b)
    assert got[3].thumb_hash == got[18].thumb_hash and jpeg.media_columns(jpeg.store_texts(none), "doc_id").count() == 0
    big = bytes(rng.integers(0, 256, 64 * 8200, np.uint8))
    grids = jpeg.thumbnails(jpeg.pictures([big, bytes(64)]))
    assert b"".join(g.tobytes() for g in grids[0]) == big and len(grids[0]) == 2 and grids[1][0].sum() == 0


def test_media_columns_cover_all_pictures(spark):
    first = "ab" * (32 * jpeg.MAX_ROWS)
    rows = [(0, first + "abcd" * 900), (1, first + "dacb" * 900), (2, first + "abcd" * 1900)]
    got = {r.doc_id: r for r in jpeg.media_columns(jpeg.store_texts(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id").collect()}
    assert {r.pictures for r in got.values()} == {2} and {r.width for r in got.values()} == {8 * jpeg.ROW}
    assert got[0].thumb_hash != got[1].thumb_hash and got[0].height == got[1].height < got[2].height
    assert all(8 * 8 * len(r.thumbnail) == r.width * r.height for r in got.values())


def test_media_of_another_coder():
    image = pytest.importorskip("PIL.Image")
    grey = np.kron(rng.integers(0, 256, (5, 7)), np.ones((8, 8))).astype(np.uint8) + 0
    out = io.BytesIO()
    image.fromarray(grey).save(out, "JPEG", quality=95)
    assert np.abs(jpeg.thumbnails([out.getvalue()])[0][0].astype(int) - grey[::8, ::8]).max() <= 3


def test_bpe(docs, none):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = {r.doc_id: r for r in bpe.encode_documents(docs, PATH, PATTERN).collect()}
    again = {r.doc_id: r for r in bpe.round_trip(docs, PATH, PATTERN).collect()}
    two = {r.doc_id: r for r in bpe.decode_documents(bpe.encode_documents(docs, PATH, PATTERN), PATH).collect()}
    for i, t in enumerate(TEXTS):
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        assert bytes(coded[i].ids) == bytes(again[i].ids) == ids and coded[i].n_tokens == len(ids) // 4
        assert again[i].text == two[i].text == (t or "")
    assert bpe.round_trip(none, PATH, PATTERN).count() == 0


def test_bpe_of_many_kinds_of_text(monkeypatch):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.read_ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = np.random.default_rng(8)
    parts = [" ", "  ", "\n", "\n\n", " \n", "\t", "\xa0", "\u3000", "\x1c", "\x85", "a", "b", "é", "日本", "🙂", "1", "²", "'s", "!", "<|", "ab", " the", "x" * 60, "\r\n", "\u200b"]
    texts = ["".join(parts[i] for i in draw.integers(0, len(parts), n)) for n in draw.integers(0, 40, 3000)]
    texts += [c * n for c in ("a", "é", " ", "!", "1", "ab", "日本語", "\n", "aaab", "🙂") for n in (1, 7, 300, 9000)] + [" " * 5000 + "x"]
    texts += ["".join(chr(c) for c in draw.integers(0x20, 0x3000, 50)) for _ in range(300)]
    vocabulary = bpe.Vocabulary(PATH)
    for states in (bpe.MAX_STATES, 50):  # with forgetting, too
        monkeypatch.setattr(bpe, "MAX_STATES", states)
        own = bpe.Parts(bpe.Transducer(ranks), PATTERN)
        for text in texts:
            ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
            assert own.of_text(text) == ids and "".join(bpe.decode(ids, vocabulary)) == text
        assert (own.transducer.forgot > 0) == (states == 50)


def test_bpe_states_repeat(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    own = bpe.Parts(bpe.Transducer(bpe.read_ranks(PATH)), PATTERN)
    for text in texts:
        own.of_text(text)
    size = sum(len(t.encode()) for t in texts)
    print(f"{size} bytes, {len(own.transducer.states)} states, {own.transducer.made} moves made")
    assert own.transducer.forgot == 0 and own.transducer.made < size / 10
    with pytest.raises(ValueError, match="not in the vocabulary"):
        bpe.Vocabulary(PATH).join(np.array([50256]))


def test_bpe_memory(spark, monkeypatch):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    own = bpe.Parts(bpe.Transducer(bpe.read_ranks(PATH)), PATTERN)
    tracemalloc.start()
    for text in texts:
        own.of_text(text)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    print(f"{held} bytes, {len(own)} parts, {len(own.transducer.moves)} moves")
    assert held < 250 * (len(own) + len(own.transducer.moves))
    monkeypatch.setattr(bpe, "MAX_PARTS", 64)
    few = bpe.Parts(own.transducer, PATTERN)
    for text in texts[:100]:
        assert few.of_text(text) == own.of_text(text)
        assert len(few) + len(few.before) <= 64


def test_utf8_stream():
    stream, data = bpe.Utf8Stream(), "aé€🙂".encode()
    assert [stream.feed(data[i : i + 1]) for i in range(len(data))] == ["a", "", "é", "", "", "€", "", "", "", "🙂"]
    assert stream.feed(b"\xe2\x82") == "" and stream.close() == "�"


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "mixing", "bpe"]
    out = corpus_pipeline.run(spark, sf_dir).collect()
    again = corpus_pipeline.run(spark, sf_dir).collect()
    assert out and sorted(out) == sorted(again) and {r.doc_id for r in out} <= {r.doc_id for r in docs.collect()}
    assert hashlib.sha256(b"").hexdigest() not in {r.decoded_sha256 for r in out}
