"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import begin_task, fields, plain, stored

#: Labelled rows learned from, at most (drawn by hash).
MAX_LABELLED = 40_000
#: Letters of a stem, the begin of a word; longer words are stems of their own as a whole, too. A text counts each stem this often at most.
STEM, OFTEN = range(3, 9), 4
#: A lexicon stem is in so many toxic texts, so many times as often in a toxic text as in another, and further from chance than this
#: (logarithm of a Poisson probability).
MIN_TEXTS, MIN_RATIO, MIN_EVIDENCE = 4, 8.0, 8.0
#: A longer stem is kept beside a shorter one that it begins with if its ratio is so many times as high.
BETTER = 1.5
#: Words whose stem a worker remembers.
REMEMBERED = 1 << 17
THRESHOLD = 0.7
SECOND_PERSON = frozenset("you your yours yourself ur u du dich dir dein deine ihr euch euer tu toi te ton ta tes vous votre vos tú tus usted ustedes ti".split())
#: Characters that stand for letters.
LEET = str.maketrans("0134578@$!", "oieastbasi", "*._-'\",;:?()[]")
MARKS = str.maketrans(dict.fromkeys(".,;:!?\"'()[]{}|/\\«»¿¡", " "))
REACH = 5
FEATURES = ["words", "lexicon", "hits", "kinds", "strength", "near_you", "you", "capitals", "shouts", "questions", "marks", "digits", "hidden", "obfuscated", "other_bytes"]


def stems(word: str) -> list[str]:
    return [word[:k] for k in STEM if k < len(word)] + [word]


class Lexicon:
    """Stems with the logarithm of how much more often toxic texts have them."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.masked = frozenset(w[:i] + "*" + w[i + 1 :] for w in weights for i in range(len(w)))
        self.known: dict[str, str | None] = {}

    def find(self, word: str) -> str | None:
        """The shortest stem of the lexicon that the word begins with."""
        if word not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = next((s for s in stems(word) if s in self.weights), None)
        return self.known[word]

    def hides(self, word: str) -> bool:
        """Whether the word is one of the lexicon with other characters for some letters."""
        return self.find(word) is None and (self.find(word.translate(LEET)) is not None or any(s in self.masked for s in stems(word)))


def features(text: str, lexicon: Lexicon) -> list[float]:
    low = text.lower()
    words = low.translate(MARKS).split()
    n = max(1, len(words))
    known = set(words)
    hits, kinds, near, strength = 0, 0, 0, 0.0
    found = {w: s for w in known if (s := lexicon.find(w)) is not None}
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON] if known & SECOND_PERSON else []
    if found:
        at = [i for i, w in enumerate(words) if w in found]
        counts = Counter(found[words[i]] for i in at)
        hits, kinds = len(at), len(counts)
        strength = sum(lexicon.weights[s] * min(c, OFTEN) for s, c in counts.items())
        if you:
            places = np.array(you)
            left = np.searchsorted(places, at)
            gap = np.minimum(np.abs(places[np.minimum(left, len(places) - 1)] - at), np.abs(places[np.maximum(left - 1, 0)] - at))
            near = int((gap <= REACH).sum())
    hidden = odd = 0
    for w in low.split():
        if not w.isalpha():
            core = w.strip(".,;:!?\"'()|")
            if core and not core.isalpha() and not core.isdigit() and any(map(str.isalpha, core)):
                odd += 1
                hidden += lexicon.hides(core)
    bytes_ = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = max(1, int(bytes_.sum()))
    upper, lower = int(bytes_[65:91].sum()), int(bytes_[97:123].sum())
    marks = int(bytes_[33:48].sum() + bytes_[58:65].sum() + bytes_[91:97].sum() + bytes_[123:127].sum())
    return [log1p(len(words)), hits / n, log1p(hits), float(kinds), strength, near / n, len(you) / n, upper / max(1, upper + lower), float(bytes_[33]) / n,
            float(bytes_[63]) / n, marks / size, float(bytes_[48:58].sum()) / size, float(hidden), odd / n, float(bytes_[128:].sum()) / size]


def with_features(docs: DataFrame, weights: dict[str, float], *keep: str) -> DataFrame:
    """The columns ``keep`` with an array of FEATURES for each text (missing: empty)."""
    rows = docs.select(*keep, plain("text").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(__name__)
        lexicon = Lexicon(weights)
        for batch in batches:
            made = [features(t.as_py(), lexicon) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(made, pa.list_(pa.float64()))], [*keep, "features"])

    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{types}, features array<double>")


def stem_counts(train: DataFrame) -> DataFrame:
    """(stem, bad, bad_texts, every): how often toxic texts have a stem, how many of them do, and how often all texts of (text, toxic) have it;
    a text counts a stem OFTEN times at most. Each task adds up its own texts first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(__name__)
        bad, bad_texts, every = Counter(), Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic")):
                own = Counter()
                for word, n in Counter(w for w in text.as_py().lower().translate(MARKS).split() if len(w) >= STEM[0] and w.isalpha()).items():
                    for s in stems(word):
                        own[s] += n
                own = {s: min(n, OFTEN) for s, n in own.items()}
                every.update(own)
                if toxic.as_py():
                    bad.update(own)
                    bad_texts.update(own.keys())
        names = list(every)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[s] for s in names], pa.int64()) for c in (bad, bad_texts, every))],
                                         ["stem", "bad", "bad_texts", "every"])

    counts = train.select(plain("text").alias("text"), "toxic").mapInArrow(run, "stem string, bad long, bad_texts long, every long")
    return counts.groupBy("stem").agg(*(F.sum(c).alias(c) for c in ("bad", "bad_texts", "every")))


def learn_lexicon(train: DataFrame) -> dict[str, float]:
    """Stems that mark the toxic ones of (text, toxic), with the logarithms of their ratios.

    Toxic words may be compounds, each of them rare, of a few stems that are not; so the begins of words are counted as well as words. A stem
    is taken for its ratio and its distance from chance, however small its share of all toxic texts is, as there may be many languages.
    """
    sums = train.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    bad, good = sums[0] or 0, (sums[1] or 0) - (sums[0] or 0)
    if not bad or not good:
        return {}
    ratio = (F.col("bad") + 0.5) / (bad + 1) / ((F.col("every") - F.col("bad") + 0.5) / (good + 1))
    chance = F.col("every") * (bad / (bad + good))
    evidence = (F.col("bad") * F.log(F.col("bad") / chance) - F.col("bad") + chance) * F.col("bad_texts") / F.col("bad")
    marks = stem_counts(train).filter((F.col("bad_texts") >= MIN_TEXTS) & (ratio >= MIN_RATIO) & (evidence >= MIN_EVIDENCE))
    found = {r.stem: r.ratio for r in marks.select("stem", ratio.alias("ratio")).collect()}
    kept: dict[str, float] = {}
    for stem in sorted(found, key=lambda s: (len(s), s)):
        if found[stem] > BETTER * max((kept[s] for s in stems(stem)[:-1] if s in kept), default=0.0):
            kept[stem] = found[stem]
    return {s: float(np.log(r)) for s, r in kept.items()}


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: object | None
    calibration: object | None
    prior: float

    def scores(self, docs: DataFrame) -> DataFrame:
        """doc_id, text_hash, score of documents (doc_id, text)."""
        rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
        if self.trees is None:
            return rows.select("doc_id", "text_hash", F.lit(self.prior).alias("score"))
        made = with_features(rows, self.lexicon, "doc_id", "text_hash").withColumn("v", array_to_vector("features"))
        raw = self.trees.transform(made).select("doc_id", "text_hash", vector_to_array("probability")[1].alias("p"))
        fixed = self.calibration.transform(raw) if self.calibration else raw.withColumn("prediction", F.col("p"))
        return fixed.select("doc_id", "text_hash", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "prediction")).alias("score"))


def fold(doc_id: str = "doc_id"):
    """CRC32 of the id as text, modulo 3; 1 is held out (fixed by the contract)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


def learn(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Model:
    """Trees and lexicon from the labelled rows of fold 0, calibration from those of fold 2; fold 1 is not looked at.

    At most about ``most`` labelled rows are drawn, by hash of the id, so the table of drawn labels that is broadcast is bounded. Several
    labels of one id count as toxic if one does; labels that are missing are left out. Where a fold lacks one of the classes, trees or
    calibration are left out: the score is then the trees' own, or the share of toxic labels.
    """
    marks = fields(labels, "doc_id", "toxic").filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = stored(marks.withColumn("fold", fold()).filter("fold <> 1"))
    count = marks.count()
    share = min(1.0, most / max(1, count))
    drawn = marks.filter(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).withColumnRenamed("doc_id", "_id")
    train = fields(docs, "doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_id")).select("_id", "text", "toxic", "fold")
    train = stored(train.repartition(8, F.xxhash64("_id")).drop("_id"))
    lexicon = learn_lexicon(train.filter("fold = 0"))
    table = stored(with_features(train, lexicon, "toxic", "fold")).coalesce(4)
    classes = {(r.fold, r.toxic): r["count"] for r in table.groupBy("fold", "toxic").count().collect()}
    bad = sum(n for (_, t), n in classes.items() if t == 1)
    prior = bad / max(1, sum(classes.values()))
    if not classes.get((0, 0)) or not classes.get((0, 1)):
        return Model(lexicon, None, None, prior)
    ready = table.withColumn("v", array_to_vector("features")).withColumn("label", F.col("toxic").cast("double"))
    trees = GBTClassifier(featuresCol="v", labelCol="label", maxIter=16, maxDepth=3, stepSize=0.3, seed=7).fit(ready.filter("fold = 0").sortWithinPartitions("features"))
    calibration = None
    if classes.get((2, 0)) and classes.get((2, 1)):
        held = trees.transform(ready.filter("fold = 2")).select(vector_to_array("probability")[1].alias("p"), "label")
        calibration = IsotonicRegression(featuresCol="p", labelCol="label").fit(held)
    return Model(lexicon, trees, calibration, prior)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from THRESHOLD on) for all documents (doc_id, text).

    Texts alone decide; missing ones count as empty, which have a score too. Repeated rows come back repeated.
    """
    model = learn(docs, labels)
    out = model.scores(fields(docs, "doc_id", "text"))
    return out.select("doc_id", (fold() == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
