"""Problem 1: evaluation texts leaking into training text.

Size-partitioned MinHash containment search. A test item of thirty words has next to no Jaccard similarity with a document of ten
thousand, so what is compared are passages of one size. Item texts are partitioned by the size of their shingle set; a
partition has a least passage, the shingles that must stand together in a text before it counts as a leak: those of `run_words`
words, or of the share `containment` of the partition's smallest item where that is more. All passages of that size, of items and
of corpus texts, are sets of equal size; their MinHashes under PERMUTATIONS permutations make a signature. The similarity to be
found is that of the threshold: a leak holds one whole passage, whose sets are equal, so a single band of all rows finds it with
certainty, and a second row keeps passages that share one shingle only from being candidates. Neighbouring passages mostly
choose the same minima, so a text has about three signatures in five words. Candidates are verified by exact containment of a
whole shingle as long as the least passage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .codepoints import Words, byte_sizes, row_slices, window_signatures

RUN_WORDS = 8
SHINGLE_WORDS = 5
PERMUTATIONS = 2  # rows of the one band
MAX_SIZE_CLASS = 24  # sizes double from class to class
BATCH_BYTES = 1 << 20
#: The item index goes to every executor if its texts have at most so many characters: it has no more than one signature
#: (16 bytes) for two of them. A larger one is joined by shuffle.
MAX_SENT_CHARS = 8_000_000
SALTS = 16  # parts of each signature in that shuffle
WORD = re.compile(r"[^\W_]+")


def least_passages(run_words: int, shingle_words: int, containment: float) -> np.ndarray:
    """By size class of an item text (class c holds sets of 2**c to 2**(c+1) - 1 shingles): the shingles of its least passage."""
    smallest = 2.0 ** np.arange(MAX_SIZE_CLASS)
    return np.maximum(run_words - shingle_words + 1, np.ceil(containment * smallest)).astype(np.int64)


def _size_classes(rows: np.ndarray, n: int) -> np.ndarray:
    """The size class of each of n texts by the rows of its shingles; -1 for none."""
    size = np.bincount(rows, minlength=n)
    return np.where(size > 0, np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), MAX_SIZE_CLASS - 1), -1)


def item_signatures(column: pa.Array, shingle_words: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, row, passage of each row): the passages of each item text, in the size of its partition."""
    hashes, rows = Words(column).shingles(shingle_words)
    of_class = _size_classes(rows, len(column))
    passage = np.where(of_class >= 0, least[of_class], 0)
    found = [window_signatures(hashes[passage[rows] == w], rows[passage[rows] == w], int(w), PERMUTATIONS) for w in np.unique(passage[passage > 0])]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), passage
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), passage


def text_signatures(column: pa.Array, shingle_words: int, passages: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of all passages of corpus texts, in the sizes of all partitions."""
    hashes, rows = Words(column).shingles(shingle_words)
    found = [window_signatures(hashes, rows, w, PERMUTATIONS) for w in passages]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def exact_shingles(text: str | None, k: int) -> set[tuple[str, ...]]:
    """The runs of k words of a text, as words."""
    words = WORD.findall((text or "").casefold())
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def _sent(texts: DataFrame, carry: list[str], items: list[tuple[int, str]], shingle_words: int, least: np.ndarray) -> DataFrame:
    """The search with the item index at hand on every executor: corpus text is read once and never shuffled."""
    sig, row, passage = item_signatures(pa.array([t for _, t in items], pa.string()), shingle_words, least)
    order = np.argsort(sig, kind="stable")
    sent = texts.sparkSession.sparkContext.broadcast((sig[order], row[order], passage, items))
    passages = [int(w) for w in np.unique(passage[passage > 0])]
    schema = T.StructType([*texts.select(*carry).schema.fields, T.StructField("item_id", T.LongType())])
    exact: dict[int, set] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, owner, passage, known = sent.value
        for batch in batches:
            if not passages:
                continue
            texts = batch.column("text")
            for start, stop in row_slices(byte_sizes(texts), BATCH_BYTES):
                part = texts.slice(start, stop - start)
                sig, row = text_signatures(part, shingle_words, passages)
                low, high = np.searchsorted(index, sig, "left"), np.searchsorted(index, sig, "right")
                hit = np.flatnonzero(high > low)
                if not len(hit):
                    continue
                # Every (text, item) once, however often a common passage occurs in them.
                n = (high - low)[hit]
                at = np.repeat(low[hit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                pairs = np.unique(np.repeat(row[hit], n) * len(known) + owner[at])
                found, ids, own, last = [], [], {}, -1
                for pair in pairs.tolist():
                    r, k = divmod(pair, len(known))
                    if r != last:
                        own, last = {}, r
                    size = int(passage[k]) + shingle_words - 1
                    if size not in own:
                        own[size] = exact_shingles(part[r].as_py(), size)
                    if k not in exact:
                        exact[k] = exact_shingles(known[k][1], size)
                    if not own[size].isdisjoint(exact[k]):
                        found.append(start + r)
                        ids.append(known[k][0])
                rows = batch.select(carry).take(pa.array(found, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(ids, pa.int64())], names=[*carry, "item_id"])

    return texts.select(*carry, "text").mapInArrow(run, schema)


def _signature_rows(df: DataFrame, carry: list[str], made, extra: list[T.StructField]) -> DataFrame:
    """(carried columns, sig, extra columns), a row for each signature that `made` gives of a slice of texts."""
    schema = T.StructType([*df.select(*carry).schema.fields, T.StructField("sig", T.LongType()), *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(carry))
            for start, stop in row_slices(byte_sizes(texts), BATCH_BYTES):
                sig, row, *more = made(texts.slice(start, stop - start))
                rows = batch.select(carry).take(pa.array(row + start))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sig.view(np.int64)), *map(pa.array, more)], names=schema.names)

    return df.select(*carry, "text").mapInArrow(run, schema)


def _shuffled(texts: DataFrame, carry: list[str], items: DataFrame, shingle_words: int, least: np.ndarray) -> DataFrame:
    """The search for an item index of any size: both sides meet on the signature. A common one is spread over SALTS tasks."""
    passages = [int(w) for w in np.unique(least)]

    def of_items(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sig, row, passage = item_signatures(column, shingle_words, least)
        return sig, row, passage[row].astype(np.int32)

    salt = F.pmod(F.xxhash64(*carry), F.lit(SALTS)).cast("int")
    ours = _signature_rows(texts, carry, lambda column: text_signatures(column, shingle_words, passages), []).withColumn("salt", salt)
    theirs = _signature_rows(items, ["item_id"], of_items, [T.StructField("passage", T.IntegerType())]).distinct()
    theirs = theirs.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    pairs = ours.join(theirs, ["sig", "salt"]).select(*carry, "item_id", "passage").distinct()
    # Signatures travel alone; a text is fetched once for each item it may hold.
    held = items.select("item_id", F.col("text").alias("item_text"))
    found = pairs.join(texts.select(*carry, "text"), carry).join(held, "item_id").select(*carry, "item_id", "passage", "text", "item_text")
    schema = T.StructType([*texts.select(*carry).schema.fields, T.StructField("item_id", T.LongType())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [w + shingle_words - 1 for w in batch.column("passage").to_pylist()]
            both = zip(batch.column("text").to_pylist(), batch.column("item_text").to_pylist(), sizes, strict=True)
            keep = [not exact_shingles(a, k).isdisjoint(exact_shingles(b, k)) for a, b, k in both]
            yield batch.select([*carry, "item_id"]).filter(pa.array(keep, pa.bool_()))

    return found.mapInArrow(verify, schema)


def leaked_items(
    texts: DataFrame, items: DataFrame, carry: list[str], *, run_words: int = RUN_WORDS, shingle_words: int = SHINGLE_WORDS, containment: float = 0.0, max_sent: int = MAX_SENT_CHARS
) -> DataFrame:
    """Distinct (carried columns, item_id): texts that hold a passage of a text of the item.

    A passage is a run of run_words words or, where that is more, of the share `containment` of the smallest item of its size
    class (sizes double from class to class). texts: the carried columns and `text`; items: `item_id` and `text`, a row for
    each text of an item. Null, empty and short texts match nothing; repeated rows and ties come out once; extra columns are
    ignored. The characters of the items are counted first: they bound what is sent to the executors, beyond max_sent both
    sides are shuffled on the signature.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    least = least_passages(run_words, shingle_words, containment)
    if items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] <= max_sent:
        kept = [(r[0], r[1]) for r in items.collect()]
        return _sent(texts, carry, kept, shingle_words, least).distinct()
    return _shuffled(texts, carry, items, shingle_words, least).distinct()


def corpus_texts(training: DataFrame, documents: DataFrame) -> DataFrame:
    """(corpus, row_key, text): question and answer of training_rows apart, and the texts of documents."""
    fields = F.explode(F.array("question", "answer")).alias("text")
    rows = training.select(F.lit("training_rows").alias("corpus"), F.col("record_number").alias("row_key"), fields)
    return rows.unionByName(documents.select(F.lit("documents").alias("corpus"), F.col("doc_id").alias("row_key"), "text"))


def item_texts(items: DataFrame) -> DataFrame:
    """(item_id, text): the question and the answer of each item."""
    return items.select("item_id", F.explode(F.array("question", "answer")).alias("text"))
