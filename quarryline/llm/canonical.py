"""Problem 10: visually identical text with different characters.

Every text is brought to one form: Arrow text becomes code-point arrays, each code point is replaced by lookup tables
(one gather, with expansion offsets where it grows or vanishes), marks are ordered and composed by array operations.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_unique
from ..runtime import Cuts
from .codepoints import N_CODES, Expansion, byte_sizes, codepoints, row_slices, to_arrow

# Letters that look like a Latin letter or an ASCII mark, with that letter: Cyrillic, Greek, Armenian, Cherokee, Coptic, others.
LOOK_ALIKES = (
    "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ԌG ԚQ ԜW ҮY ѴV ӀI "
    "аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ӏl үy ѵv "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ͿJ "
    "αa γy ιi κk οo ρp υu νv χx ϳj ϲc "
    "ՕO ՍU ՏS ԼL օo ոn սu հh ցg զq յj "
    "ᎠD ᎡR ᎢT ᎥI ᎩY ᎪA ᎫJ ᎬE ᎳW ᎷM ᎻH ᏀG ᏃZ ᏚS ᏞL ᏟC ᏢP ᏙV ᏦK ᏴB "
    "ⲀA ⲂB ⲈE ⲎH ⲔK ⲘM ⲚN ⲞO ⲢP ⲤC ⲦT ⲨY ⲬX ⲟo ⲣp ⲥc "
    "ɡg ɑa ʋv ıi ℓl ‐- ‑- −- ⁄/ ∕/ ․. ‚,"
)
# Compatibility forms that look like what they stand for.
SAME_LOOK = {"<wide>", "<narrow>", "<font>", "<noBreak>"}
# Letters without ink beside those of category Cf.
INVISIBLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
BATCH_BYTES = 1 << 20
PAIR_ROWS = 1000  # documents of a class that one salt pairs with all others of it


def _decomposed(code: int, alike: dict[str, str]) -> str:
    c = chr(code)
    if unicodedata.category(c) == "Cf" or code in INVISIBLE or (unicodedata.category(c) == "Cc" and c not in "\t\n\r\v\f\x85"):
        return ""
    if unicodedata.category(c) == "Zs":
        return " "
    if c in "\v\f\x85  \r":
        return "\n"
    kind = unicodedata.decomposition(c)
    if kind.startswith("<"):
        tag = kind.split()[0]
        name = unicodedata.name(c, "")
        ligature = tag == "<compat>" and (" LIGATURE " in name or "ROMAN NUMERAL " in name or c == "…")
        text = "".join(_decomposed(int(x, 16), alike) for x in kind.split()[1:]) if tag in SAME_LOOK or ligature else c
    elif 0xAC00 <= code <= 0xD7A3:
        return c  # a syllable is one form already
    else:
        text = unicodedata.normalize("NFD", c)
    return "".join(alike.get(x, x) for x in text)


def read_look_alikes(path: str) -> dict[str, str]:
    """Pairs of a larger list, in the format of Unicode's list of confusables (`source ; target ; kind`, hexadecimal).

    Taken are single characters beyond ASCII that look like one ASCII letter or mark; a digit is never put for a letter.
    """
    out = {}
    with open(path, encoding="utf-8-sig") as lines:
        for line in lines:
            parts = [p.strip() for p in line.split("#")[0].split(";")]
            if len(parts) > 1 and len(source := parts[0].split()) == 1 and len(target := parts[1].split()) == 1:
                a, b = chr(int(source[0], 16)), chr(int(target[0], 16))
                if a > "~" and "!" <= b <= "~" and not b.isdigit() and unicodedata.category(a)[0] != "N":
                    out[a] = b
    return out


@functools.cache
def tables(list_path: str | None = None) -> tuple[Expansion, np.ndarray, np.ndarray, np.ndarray]:
    """(expansion to base letters and marks, combining class, sorted (base, mark) keys, their compositions), with the pairs of a list where one is given."""
    alike = {pair[0]: pair[1] for pair in LOOK_ALIKES.split()} | (read_look_alikes(list_path) if list_path else {})
    changed, pairs = {}, {}
    classes = np.zeros(N_CODES, np.uint8)
    for code in range(N_CODES):
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code <= 0xD7A3 or 0x3400 <= code < 0xA000 or code >= 0x20000 and not 0xE0000 <= code < 0xE0200:
            continue
        c = chr(code)
        classes[code] = unicodedata.combining(c)
        if (text := _decomposed(code, alike)) != c:
            changed[code] = text
        kind = unicodedata.decomposition(c)
        if kind and kind[0] != "<" and " " in kind and unicodedata.normalize("NFC", c) == c:
            base, mark = (int(x, 16) for x in kind.split())
            pairs[base << 32 | mark] = code
    keys = np.array(sorted(pairs), np.uint64)
    return Expansion(changed), classes, keys, np.array([pairs[int(k)] for k in keys], np.uint32)


def _compose(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, classes, keys, made = tables()
    cls = classes[codes]
    if not cls.any():
        return codes, offsets
    mark = cls > 0
    row_start = np.zeros(len(codes) + 1, bool)
    row_start[offsets] = True
    # Order the marks behind one letter by their class; equal classes keep their order.
    group = np.cumsum(~mark | row_start[:-1])
    if (mark[1:] & mark[:-1] & (cls[1:] < cls[:-1])).any():
        order = np.lexsort((np.arange(len(codes)), cls, group))
        codes, cls = codes[order], cls[order]
        mark = cls > 0
    codes, alive = codes.copy(), np.ones(len(codes), bool)
    head = np.maximum.accumulate(np.where(~mark | row_start[:-1], np.arange(len(codes)), 0))
    rank = np.arange(len(codes)) - head
    left_out = np.zeros(len(codes) + 1, np.uint8)  # by head: the class of the last mark that found no composition
    for k in range(1, int(rank[mark].max(initial=0)) + 1):
        at = np.flatnonzero(mark & (rank == k))
        key = codes[head[at]].astype(np.uint64) << np.uint64(32) | codes[at].astype(np.uint64)
        found = np.searchsorted(keys, key)
        hit = (found < len(keys)) & (keys[np.minimum(found, len(keys) - 1)] == key) & (left_out[head[at]] != cls[at])
        codes[head[at[hit]]] = made[found[hit]]
        alive[at[hit]] = False
        left_out[head[at[~hit]]] = cls[at[~hit]]
    kept = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(alive, out=kept[1:])
    return codes[alive], kept[offsets]


def _blanks(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of blanks become one blank (a line feed where the run holds one); those at the ends of a text vanish."""
    line = codes == 10
    blank = line | (codes == 32) | (codes == 9)
    n = len(codes)
    if not n:
        return codes, offsets
    first = blank.copy()
    first[1:] &= ~blank[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    first[starts] = blank[starts]
    run = np.cumsum(first)
    holds = np.zeros(run[-1] + 1, bool)
    holds[run[line]] = True
    codes = codes.copy()
    codes[first] = np.where(holds[run[first]], 10, 32)
    alive = ~blank | first
    alive[starts[blank[starts]]] = False
    # The run that ends a text goes as well.
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    tail = np.zeros(run[-1] + 1, bool)
    tail[run[ends[blank[ends]]]] = True
    alive &= ~(first & tail[run])
    kept = np.zeros(n + 1, np.int64)
    np.cumsum(alive, out=kept[1:])
    return codes[alive], kept[offsets]


def canonical_array(column: pa.Array, list_path: str | None = None) -> pa.Array:
    """One consistent form of every text of an Arrow column; null stays null."""
    codes, offsets = codepoints(column)
    codes, offsets = tables(list_path)[0].apply(codes, offsets)
    codes, offsets = _compose(codes, offsets)
    codes, offsets = _blanks(codes, offsets)
    out = to_arrow(codes, offsets)
    return pa.compute.if_else(column.is_null(), pa.scalar(None, pa.large_string()), out) if column.null_count else out


def canonical_texts(df: DataFrame, text: str, into: str, list_path: str | None = None) -> DataFrame:
    """df with a column `into`: `text` in one consistent form. list_path: a larger list of look-alike letters that every executor can read.

    A null text gives null, an empty one the empty text. A column of that name is replaced; all others stay as they are.
    """
    kept = df.drop(into)
    schema = kept.select("*", F.col(f"`{text}`").cast("string").alias(into)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for start, stop in row_slices(byte_sizes(column), BATCH_BYTES):
                part = batch.slice(start, stop - start)
                made = canonical_array(column.slice(start, stop - start), list_path).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, into])

    return kept.mapInArrow(run, schema)


def fingerprint(text: Column) -> Column:
    """128 bits of SHA-256: equal for equal texts, for unequal ones with a probability below 1e-18 at 1e10 texts."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _classes(documents: DataFrame, key: str, text: str, list_path: str | None) -> DataFrame:
    """(class_id, docs, id, stored) of the documents whose form two or more different stored texts share."""
    cuts = Cuts(documents.sparkSession, "look-alike")
    forms = canonical_texts(documents.select(F.col(key).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull()), "text", "form", list_path)
    marked = cuts.cut(forms.where("form <> ''").select("id", fingerprint(F.col("text")).alias("stored"), fingerprint(F.col("form")).alias("form")))
    # Exact copies collapse on the map side, so a hot text costs one row a task.
    texts = marked.groupBy("form", "stored").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    shared = texts.groupBy("form").agg(F.min("first").alias("class_id"), F.count("*").alias("spellings"), F.sum("n").alias("docs")).where("spellings > 1")
    shared, seen = cuts.measured(shared.select("form", "class_id", "docs", F.col("docs").alias("rows")), most=F.max("docs"))
    return join_unique(marked, shared, "form", "rows", seen["most"]).select("class_id", "docs", "id", "stored")


def look_alike_classes(documents: DataFrame, key: str = "doc_id", text: str = "text", list_path: str | None = None) -> DataFrame:
    """(doc_id, class_id): every document that looks like another one stored differently, class_id being the smallest of them.

    One row a document, exact copies included. Null and blank texts, and texts that only have exact copies, are left out.
    """
    return _classes(documents, key, text, list_path).select(F.col("id").alias("doc_id"), "class_id")


def look_alike_pairs(documents: DataFrame, key: str = "doc_id", text: str = "text", list_path: str | None = None) -> DataFrame:
    """(doc_a, doc_b): doc_a < doc_b, stored texts that differ and have one form, derived from the classes.

    The pairs of a class are as many as the case demands; a class of many documents is spread over salts, so that no task makes
    more than about PAIR_ROWS times its share of them. Null and blank texts give no pair.
    """
    members = Cuts(documents.sparkSession, "look-alike").cut(_classes(documents, key, text, list_path))
    salts = F.ceil(F.col("docs") / PAIR_ROWS).cast("long")
    a = members.select("class_id", F.pmod(F.xxhash64("id"), salts).alias("salt"), F.col("id").alias("doc_a"), F.col("stored").alias("stored_a"))
    b = members.select("class_id", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.col("id").alias("doc_b"), F.col("stored").alias("stored_b"))
    return a.join(b, ["class_id", "salt"]).where((F.col("doc_a") < F.col("doc_b")) & (F.col("stored_a") != F.col("stored_b"))).select("doc_a", "doc_b")
