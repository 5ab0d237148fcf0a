"""Personal data: high-recall candidate spans, boosted trees over format and context, calibrated thresholds.

Only DataFrame functions and Spark's own learners run on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.common import fields, plain, stored

KINDS = ("email", "ip", "card", "phone")
#: The kinds' patterns (fixed values of the contract), written so that they take linear time: a match begins where the last one ended or
#: where a run of its characters does, and no run is entered twice.
LOCAL, HOST = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider patterns of the same kinds: spelled-out signs, other separators, missing signs.
WIDE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}{{1,64}}+ ?(?:@|[(\[]at[)\]]| at ) ?{HOST}{{1,63}}+(?:(?:\.| \. | ?[(\[]dot[)\]] ?| dot ){HOST}{{1,63}}+){{1,6}}+",
    "ip": r"(?:\G|(?<![0-9]))[0-9]{1,3}+(?: ?[.,] ?[0-9]{1,3}+){3}+",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[ ./-]{0,2}+[0-9]){11,18}+",
    "phone": r"(?:\G|(?<![0-9]))\(?+\+?+[0-9](?:[ ()./-]{0,2}+[0-9]){6,14}+",
}
#: What a text must hold for a pattern to be tried (never less than the pattern needs).
NEEDS = {
    "ip": r"[0-9] ?[.,] ?[0-9]", "card": r"[0-9][ ./-]{0,2}[0-9]", "phone": r"[0-9][ ()./+-]{0,2}[0-9]",
}
CONTEXT = 24
#: Weight of a kind's right (or wrong) ones in all, and the share of right ones that a threshold must reach on the half kept for calibration.
EVEN, PRECISION = 1000.0, 0.98
#: What the trees see: nothing that only tells a base form from a wide one.
FEATURES = ["kind_no", "sound", "digits", "left_letter", "left_digit", "left_space", "left_sign", "right_letter", "right_digit", "right_space", "right_sign", "cue", "other_cue",
            "left_digits", "right_digits"]
#: Words before a span that speak for its kind, and for something else.
CUES = {"email": "e-?mail|contact|write|reach|addr|address", "ip": "ip|host|server|addr|address", "card": "card|visa|credit|kart|carte|tarjeta", "phone": "tel|phone|call|fax|mobile|cell"}
OTHER_CUES = "version|page|id|no|nr|order|ref|isbn|date|password|key|token|hash"
NEAR = r"\W*(?:\p{L}+\W+){0,2}$"
#: Sound spelled-out addresses: with a sign or brackets for the at, or with all dots spelled too.
SPELLED_DOT = r"(?: ?[(\[]dot[)\]] ?| dot )"
SOUND_EMAIL = (rf"^{LOCAL}+(?: ?(?:@|[(\[]at[)\]]) ?{HOST}+(?:(?:\.| \. |{SPELLED_DOT}){HOST}+)*(?:\.| \. |{SPELLED_DOT})"
               rf"| at {HOST}+(?:{SPELLED_DOT}{HOST}+)*{SPELLED_DOT})[A-Za-z]{{2,24}}$")


def _matches(text: Column, kind: str, wide: bool) -> Column:
    """(kind, wide, i, gap, found, left, right) of the matches of a pattern: split() gives what lies between them."""
    pattern = (WIDE if wide else BASE)[kind]
    between = F.split(text, pattern, -1)
    zipped = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), between.alias("g"), F.slice(between, 2, 2**30).alias("h"))
    rows = F.transform(zipped, lambda z, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind_no"), F.lit(int(wide)).alias("wide"), i.alias("i"), F.length(z["g"]).alias("gap"), z["m"].alias("found"),
        F.right(z["g"], F.lit(CONTEXT)).alias("left"), F.left(z["h"], F.lit(CONTEXT)).alias("right")))
    found = F.filter(rows, lambda r: r["found"].isNotNull())
    if kind == "email":
        need = F.contains(text, F.lit("@")) | text.rlike(r"[(\[ ]dot[)\] ]") if wide else F.contains(text, F.lit("@"))
    elif kind == "phone" and not wide:
        need = F.contains(text, F.lit("+"))
    else:
        need = text.rlike(NEEDS[kind])
    return F.when(need, found)


def candidates(docs: DataFrame) -> DataFrame:
    """All matches of all patterns: doc_id, text_hash, kind_no, wide, start, end (code points), found, left, right, valid (of base matches), sound."""
    text = plain("text")
    arrays = [_matches(text, k, wide) for k in KINDS for wide in (False, True)]
    none = F.expr("cast(array() as array<struct<kind_no:int,wide:int,i:int,gap:int,found:string,left:string,right:string>>)")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.explode(F.concat(*(F.coalesce(a, none) for a in arrays))).alias("c")).select("doc_id", "text_hash", "c.*")
    rows = rows.dropDuplicates(["doc_id", "text_hash", "kind_no", "wide", "i"])
    w = Window.partitionBy("doc_id", "text_hash", "kind_no", "wide").orderBy("i")
    end = F.sum(F.col("gap") + F.length("found")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("found"))
    right = _right(F.col("found"))
    return rows.select("doc_id", "text_hash", "kind_no", "wide", "start", "end", "found", "left", "right", (right & (F.col("wide") == 0)).alias("valid"), _sound().alias("sound"))


def _right(found: Column, ip: Column | None = None) -> Column:
    """Checksum, octets and number of digits of a match; ``ip`` is it with points between the octets."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    number = F.length(digits)
    small = F.lit(r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$")
    return (F.when(F.col("kind_no") == 0, True).when(F.col("kind_no") == 1, F.regexp_like(found if ip is None else ip, small))
            .when(F.col("kind_no") == 2, number.between(12, 19) & F.call_function("luhn_check", F.when(number.between(12, 19), digits).otherwise("1")))
            .otherwise(number.between(9, 15)))


def _sound() -> Column:
    """Whether a candidate, of whatever form, is well formed and no part of a longer number."""
    found = F.col("found")
    part = F.col("left").rlike("[0-9]$") | F.col("right").rlike("^[0-9]")
    ip = F.regexp_replace(found, " ?[.,] ?", ".")
    return ~part & F.when(F.col("kind_no") == 0, found.rlike(SOUND_EMAIL)).otherwise(_right(found, ip))


def _by_kind(*values: Column) -> Column:
    return F.coalesce(*(F.when(F.col("kind_no") == k, v) for k, v in enumerate(values)))


def _planted(rows: DataFrame) -> DataFrame:
    """Valid base spans written in wide forms (label 1), and with a wrong digit, octet or length (label 0), in the contexts of the spans."""
    found, v = F.col("found"), F.pmod(F.col("_d"), F.lit(3))
    digits = F.regexp_replace(found, "[^0-9]", "")

    def pick(*options: Column) -> Column:
        return F.coalesce(*(F.when(v == i, o) for i, o in enumerate(options)))

    def email(at: str, dot: str) -> Column:
        return F.concat(F.substring_index(found, "@", 1), F.lit(at), F.replace(F.substring_index(found, "@", -1), F.lit("."), F.lit(dot)))

    def parted(sign: str, size: int, number: Column = digits) -> Column:
        return F.regexp_replace(number, rf"([0-9]{{{size}}})(?=[0-9])", f"$1{sign}")

    def octets(sign: str, c: Column = found) -> Column:
        return F.replace(c, F.lit("."), F.lit(sign))

    unsigned = F.substring(found, 2, 2**30)
    good = _by_kind(pick(email(" (at) ", " dot "), email(" at ", " dot "), email("[at]", "[dot]")), pick(octets(","), octets(", "), octets(" . ")),
                    pick(parted(".", 4), parted("/", 4), parted(". ", 4)), pick(parted(".", 3), unsigned, digits))
    wrong = F.concat(F.left(digits, F.length(digits) - 1), F.pmod(F.right(digits, F.lit(1)).cast("int") + 1, F.lit(10)).cast("string"))
    bad = _by_kind(pick(email(" at ", "."), email(" at ", " . "), email(" at ", ".")), pick(*(octets(x, F.regexp_replace(found, "[0-9]+$", "999")) for x in (",", ", ", " . "))),
                   pick(*(parted(x, 4, wrong) for x in (".", "/", ". "))), pick(*(parted(x, 3, F.left(digits, F.lit(8))) for x in (".", " ", "-"))))
    both = rows.filter("valid").select("*", F.explode(F.array(F.struct(good.alias("f"), F.lit(1.0).alias("l")), F.struct(bad.alias("f"), F.lit(0.0).alias("l")))).alias("_w"))
    both = both.withColumns({"found": F.col("_w.f"), "label": F.col("_w.l"), "wide": F.lit(1)}).drop("_w")
    matches = _by_kind(*(F.regexp_extract("found", WIDE[k], 0) for k in KINDS))
    return both.filter(matches == F.col("found")).withColumn("sound", _sound()).filter("sound or label = 0")


def _features(rows: DataFrame) -> DataFrame:
    found, left, right = F.col("found"), F.col("left"), F.col("right")

    def count(pattern: str, c: Column = found) -> Column:
        return F.regexp_count(c, F.lit(pattern)).cast("double")

    def ends(c: Column, pattern: str) -> Column:
        return c.rlike(pattern).cast("double")

    return rows.withColumns({
        "sound": F.col("sound").cast("double"), "digits": count("[0-9]"),
        "left_letter": ends(left, r"\p{L}$"), "left_digit": ends(left, "[0-9]$"), "left_space": ends(left, r"(^|\s)$"), "left_sign": ends(left, r"[^\p{L}0-9\s]$"),
        "right_letter": ends(right, r"^\p{L}"), "right_digit": ends(right, "^[0-9]"), "right_space": ends(right, r"^(\s|$)"), "right_sign": ends(right, r"^[^\p{L}0-9\s]"),
        "cue": _cue().cast("double"), "other_cue": _other_cue().cast("double"), "left_digits": count("[0-9]", left), "right_digits": count("[0-9]", right),
    })


def _cue() -> Column:
    return _by_kind(*(F.col("left").rlike(rf"(?i)\b(?:{CUES[k]}){NEAR}") for k in KINDS))


def _other_cue() -> Column:
    return ~_cue() & _by_kind(*(F.col("left").rlike(rf"(?i)\b(?:{'|'.join([OTHER_CUES, *(c for o, c in CUES.items() if o != k)])}){NEAR}") for k in KINDS))


def _overlapping(rows: DataFrame) -> DataFrame:
    """Add ``hit`` (a valid base span of the same kind overlaps) and ``covered`` (one of any kind does).

    A span is overlapped if, of the base spans that begin before its end, one ends after its start: a running maximum in the order of
    begins and ends, so texts with very many spans stay cheap.
    """
    at = F.when(F.col("valid"), F.col("start")).otherwise(F.col("end") - 1)
    order = [at, (~F.col("valid")).cast("int")]
    any_kind = Window.partitionBy("doc_id", "text_hash").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    base_end = F.when(F.col("valid"), F.col("end"))
    kinds = {f"_m{k}": F.max(F.when(F.col("kind_no") == k, base_end)).over(any_kind) for k in range(len(KINDS))}
    df = rows.withColumns(kinds)
    own = F.coalesce(*(F.when(F.col("kind_no") == k, F.col(f"_m{k}")) for k in range(len(KINDS))), F.lit(-1))
    most = F.greatest(*(F.coalesce(F.col(f"_m{k}"), F.lit(-1)) for k in range(len(KINDS))))
    return df.withColumns({"hit": own > F.col("start"), "covered": most > F.col("start")}).drop(*kinds)


@dataclass
class Selector:
    """Boosted trees, their calibration, and the calibrated probability that each kind needs."""

    trees: object | None
    calibration: object | None
    thresholds: dict[int, float]

    def probability(self, rows: DataFrame) -> DataFrame:
        scored = self.trees.transform(VectorAssembler(inputCols=FEATURES, outputCol="v").transform(rows))
        scored = scored.withColumn("p", vector_to_array("probability")[1]).drop("v", "rawPrediction", "probability", "prediction")
        return self.calibration.transform(scored)


def learn(rows: DataFrame) -> Selector:
    """Learn from all candidates; those that look alike to the trees are counted once, with their number as weight.

    Right are valid base spans and the same spans written in wide forms in their contexts, wrong the same ones made invalid. Of the wide
    candidates that overlap no base span, those that are not sound are wrong, sound ones with a cue of their kind are right, those with
    another cue are wrong; without any cue addresses and cards are left out (they have a form or a checksum of their own), others are wrong.

    Half of them, by hash, fit the trees, half calibrate them, the right and the wrong ones of each kind with the same weight in all; a
    kind's threshold is the lowest calibrated probability from which on the share of right ones among the wide forms in that half is at
    least PRECISION.
    """
    mark = F.pmod(F.xxhash64("doc_id", "text_hash", "kind_no", "wide", "start"), F.lit(1_000_000))
    pool = rows.filter("valid or (wide = 1 and not covered)").withColumn("_d", mark).withColumn("half", F.floor(F.col("_d") / 3) % 2)
    natural = (F.when(F.col("valid"), 1.0).when(~F.col("sound"), 0.0).when(_cue(), 1.0).when(_other_cue(), 0.0).when(F.col("kind_no").isin(1, 3), 0.0))
    every = pool.withColumn("label", natural).filter("label is not null").unionByName(_planted(pool))
    alike = ["half", "label", "wide", "kind_no", *FEATURES[1:]]
    # its size depends on the values of the features, hardly on the number of candidates
    counted = stored(_features(every).groupBy(*alike).agg(F.count(F.lit(1)).alias("n")).repartition(4, *alike).sortWithinPartitions(*alike))
    sizes = {(r.half, r.kind_no, r.label): r.n for r in counted.groupBy("half", "kind_no", "label").agg(F.sum("n").alias("n")).collect()}
    if len({(half, label) for half, _, label in sizes}) < 4:
        return Selector(None, None, {})
    even = F.coalesce(*(F.when((F.col("half") == h) & (F.col("kind_no") == k) & (F.col("label") == y), F.lit(EVEN / n)) for (h, k, y), n in sizes.items()))
    ready = VectorAssembler(inputCols=FEATURES, outputCol="v").transform(counted.withColumn("weight", even * F.col("n")))
    trees = GBTClassifier(featuresCol="v", labelCol="label", weightCol="weight", maxIter=12, maxDepth=3, maxBins=64, stepSize=0.3, seed=5).fit(ready.filter("half = 0"))
    held = trees.transform(ready.filter("half = 1")).select("kind_no", "wide", "label", "weight", vector_to_array("probability")[1].alias("p"))
    calibration = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="weight").fit(held)
    steps = calibration.transform(held.filter("wide = 1")).groupBy("kind_no", F.floor(F.col("prediction") * 100).alias("step")).agg(
        F.sum(F.col("label") * F.col("weight")).alias("right"), F.sum("weight").alias("n")).collect()
    thresholds = {}
    for kind in range(len(KINDS)):
        right = n = 0.0
        for r in sorted((r for r in steps if r.kind_no == kind), key=lambda r: -r.step):
            right, n = right + r.right, n + r.n
            if right < PRECISION * n:
                break
            thresholds[kind] = r.step / 100
    return Selector(trees, calibration, thresholds)


def find(docs: DataFrame) -> DataFrame:
    """Every span of documents (doc_id, text): doc_id, text_hash, kind_no, start, end, base.

    Base spans are the valid matches of the base patterns. The method adds candidates that overlap none of them and whose calibrated
    probability reaches their kind's threshold, if they are sound; of added spans that overlap, the first (then the longest) stays. Missing texts count as empty;
    rows with the same id and text count once here; nothing is learned, and nothing added, where candidates are all right or all wrong.
    """
    rows = stored(_overlapping(candidates(fields(docs, "doc_id", "text"))))
    spans = rows.filter("valid").select("doc_id", "text_hash", "kind_no", "start", "end", F.lit(True).alias("base"))
    selector = learn(rows)
    if not selector.thresholds:
        return spans
    left = _features(rows.filter("not covered and not valid and wide = 1 and sound"))
    needed = F.coalesce(*(F.when(F.col("kind_no") == k, F.lit(t)) for k, t in selector.thresholds.items()), F.lit(2.0))
    added = selector.probability(left).filter(F.col("prediction") >= needed).select("doc_id", "text_hash", "kind_no", "start", "end")
    before = F.max("end").over(Window.partitionBy("doc_id", "text_hash").orderBy("start", F.desc("end"), "kind_no").rowsBetween(Window.unboundedPreceding, -1))
    added = added.withColumn("_b", before).filter("_b is null or _b <= start").drop("_b")
    return spans.unionByName(added.withColumn("base", F.lit(False)))


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans (kind:start:end by start, then kind, comma-joined) for every document."""
    found = find(docs)

    def listed(only_base: bool) -> Column:
        entry = F.struct("start", "kind_no", "end")
        spans = F.sort_array(F.collect_list(F.when(F.col("base"), entry) if only_base else entry))
        names = F.array(*map(F.lit, KINDS))
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    counts = [F.sum((F.col("base") & (F.col("kind_no") == i)).cast("long")).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    texts = found.groupBy("doc_id", "text_hash").agg(*counts, listed(True).alias("base_spans"), listed(False).alias("spans"))
    texts = texts.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    rows = fields(docs, "doc_id", "text").select("doc_id", F.xxhash64(plain("text")).alias("text_hash"))
    joined = rows.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return joined.select("doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS), F.coalesce("base_spans", F.lit("")).alias("base_spans"), F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """doc_id, text with every span replaced by its kind in brackets (spans within others go with them)."""
    spans = find(docs)
    w = Window.partitionBy("doc_id", "text_hash").orderBy("start", F.desc("end"), "kind_no")
    outer = spans.withColumn("_b", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))).filter("_b is null or _b < end")
    outer = outer.withColumn("start", F.greatest("start", F.coalesce("_b", F.lit(0))))
    outer = outer.withColumn("from", F.coalesce(F.lag("end").over(Window.partitionBy("doc_id", "text_hash").orderBy("start")), F.lit(0)))
    cuts = outer.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "from", "kind_no"))).alias("cuts"), F.max("end").alias("last"))
    cuts = cuts.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    rows = fields(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64(plain("text")))
    joined = rows.join(cuts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    names = F.array(*map(F.lit, KINDS))
    head = F.array_join(F.transform("cuts", lambda c: F.concat(F.substring("text", c["from"] + 1, c["start"] - c["from"]), F.lit("["), F.get(names, c["kind_no"]), F.lit("]"))), "")
    text = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.concat(head, F.substring("text", F.col("last") + 1, F.length("text"))))
    return joined.select("doc_id", text.alias("text"))
