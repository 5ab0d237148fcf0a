"""Token counts by a public tokenizer: batches balanced by bytes, long texts split where no token can reach over, lengths alone kept."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import begin_task, fields, plain, remembered

#: Bytes encoded by one call, parts whose lengths a worker remembers (when full, it starts anew), and the longest one it remembers.
BATCH_BYTES, MAX_PARTS, LONGEST = 1 << 20, 1 << 20, 48
#: The white space before a visible character. A byte-level pattern begins a match there, whatever comes before it: only the last white space
#: of a run can stand apart from the run or go with the word behind it. Special tokens are cut out first, so their first character ``<`` is left out.
BORDER = regex.compile(r"(?=[ \n][!-;=-~\p{L}\p{N}])", regex.V1)
#: What a part that may not stand alone counts as: more than any text can have.
UNSAFE = 1 << 48


@remembered
def counter(path: str):
    """A function from a list of texts to their numbers of tokens. ``.json`` files are read by tokenizers (without padding or truncation,
    special strings as the file has them), ``.model`` files by sentencepiece; neither adds tokens of its own."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share out the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Lengths(dict):
    """Numbers of tokens of parts of texts; a part is remembered without the space it begins with. New parts are encoded in batches of
    about BATCH_BYTES."""

    def __init__(self, count, split: bool):
        self.count, self.split = count, split

    def __missing__(self, part: str) -> int:
        return self.count([part if part[:1] == "\n" else " " + part])[0]

    def learn(self, parts: Iterable[str]) -> None:
        """Remember the lengths of those not yet known; of those that may not be cut off before them, that they are UNSAFE."""
        new = [p for p in parts if p not in self]
        if len(self) + len(new) > MAX_PARTS:
            self.clear()
        batch, size = [], 0
        for part in new:
            if not BORDER.match(part if part[:1] == "\n" else " " + part):
                self[part] = UNSAFE
            elif len(part) <= LONGEST:
                batch.append(part)
                size += len(part)
                if size >= BATCH_BYTES:
                    self._encode(batch)
                    batch, size = [], 0
        self._encode(batch)

    def _encode(self, batch: list[str]) -> None:
        if batch:
            self.update(zip(batch, self.count([p if p[0] == "\n" else " " + p for p in batch])))

    def of_texts(self, texts: list[str]) -> list[int]:
        if not self.split:
            return self.count(texts)
        heads, cut = [], []
        for text in texts:
            head, *rest = text.replace("\n", " \n").split(" ")
            heads.append(head)
            cut.append(rest)
        self.learn(set().union(*cut))
        totals = [n + sum(map(self.__getitem__, rest)) for n, rest in zip(self.count(heads), cut)]
        for i, total in enumerate(totals):
            if total >= UNSAFE:
                head, *rest = BORDER.split(texts[i])
                rest = [p.removeprefix(" ") for p in rest]
                self.learn(set(rest))
                totals[i] = self.count([head])[0] + sum(map(self.__getitem__, rest))
        return totals


def safe_parts(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut at BORDER alone; where none comes, a part is as long as need be."""
    begin = 0
    while len(text) - begin > size and (found := BORDER.search(text, begin + size)):
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:] if begin else text


def batches_by_bytes(texts: Iterable[str], split: bool, size: int = BATCH_BYTES) -> Iterator[tuple[list[str], list[int]]]:
    """Parts of the texts in order with the number of each one's text, in lists that end when they hold about ``size`` characters."""
    parts, owners, held = [], [], 0
    for i, text in enumerate(texts):
        for part in safe_parts(text, size) if split else (text,):
            parts.append(part)
            owners.append(i)
            held += len(part)
            if held >= size:
                yield parts, owners
                parts, owners, held = [], [], 0
    if parts:
        yield parts, owners


@remembered
def lengths(path: str) -> Lengths:
    return Lengths(counter(path), _splits(path))


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row of documents (doc_id, text).

    Missing and empty texts have no bytes and no tokens; repeated rows, and rows without doc_id, come back as often as they are there; an
    empty table gives none; other columns are not looked at, also where their names differ by case alone. Texts are cut at BORDER and their
    parts' lengths added (files of tokenizers that cut by a byte-level pattern; texts of others, whose merges can span words, stay whole), so
    memory holds a text, one batch of its parts and MAX_PARTS lengths. ``path`` is a file that every worker can open.
    """
    rows = fields(docs, "doc_id", "text").select("doc_id", plain("text").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(__name__)
        known = lengths(path)
        for batch in batches:
            column = batch.column("text")
            totals = np.zeros(batch.num_rows, np.int64)
            for parts, owners in batches_by_bytes((t.as_py() for t in column), known.split):
                np.add.at(totals, owners, known.of_texts(parts))
            sizes = pc.binary_length(column).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, pa.array(totals)], ["doc_id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


@remembered
def _splits(path: str) -> bool:
    """Whether the file cuts texts by the byte-level pattern before anything else, so that BORDER is safe."""
    if not path.endswith(".json"):
        return False
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cutter = spec.get("pre_tokenizer") or {}
    plain_words = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    added = spec.get("added_tokens") or []
    odd = [t for t in added if t.get("lstrip") or t.get("rstrip") or t["content"][:1] != "<" or any(map(str.isspace, t["content"]))]
    return bool(plain_words and not spec.get("normalizer") and not odd)
