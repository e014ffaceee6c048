"""Problem 2: deduplicating new batches against all history, by incremental record linkage.

Everything accepted is kept in a store under a path that outlives the session: blocking keys (key, id) and members (id, kept rows,
text) in hash buckets, the learned model, the pairs found, and a union-find of representatives. A batch makes its own keys, reads
the buckets that those fall into, and only members that share a key are scored, field by field, with weights learned from synthetic
repeats. It appends its own part to each table; of the representatives, only rows of clusters that it ties together are written.
"""

from __future__ import annotations

import pickle
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chunks import canonical_refs
from ..functions.text import words
from ..operators.components import components
from ..operators.skew import join_unique
from ..runtime import Cuts, scratch_path
from .canonical import canonical_texts, fingerprint
from .sampling import least_hashes

SAMPLE_ROWS = 2000  # bound of the rows that the weights are learned from
BUCKETS = 1 << 16  # of the capital letter lexicon
STORE_BUCKETS = 8  # hash buckets of a store's keys and members; choose about one for a million rows of history
MAX_SENT_KEYS = 500_000  # a batch's rows go to every executor up to so many; beyond, both sides are shuffled
OVERLAP = 0.5  # rows that ask the same question share at least this part of the words of the longer one
MAX_BLOCK_PAIRS = 1_000_000  # a key that would pair more rows of a batch with members is split by words

# Names of months in the languages of the texts, case folded; "may" is one beside a number only.
MONTHS = frozenset(
    "january february march april june july august september october november december "
    "januar februar märz mai juni juli oktober dezember "
    "janvier février mars avril juin juillet août septembre octobre novembre décembre "
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre "
    "января февраля марта апреля мая июня июля августа сентября октября ноября декабря".split()
)
_WORD = re.compile(r"[^\W_]+")
FEATURES = ("bias", "names_replaced", "names_added", "numbers_changed", "months_changed", "words_replaced", "words_added", "misspelt", "order", "references")


def _close(a: str, b: str, most: int) -> bool:
    """Whether at most that many letters were changed, added, left out or swapped with their neighbour."""
    if abs(len(a) - len(b)) > most or min(len(a), len(b)) < 4:
        return False
    if sum(((Counter(a) - Counter(b)) + (Counter(b) - Counter(a))).values()) > 2 * most:
        return False
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
    return last[-1] <= most


def _months(tokens: list[str]) -> Counter:
    near = lambda i: any(0 <= k < len(tokens) and tokens[k].isdigit() for k in (i - 1, i + 1))
    return Counter(t for i, t in enumerate(tokens) if t in MONTHS or (t == "may" and near(i)))


def capital_share(lexicon: np.ndarray, word: str, written: dict[str, float] | None = None) -> float:
    """How often a word is written with a capital letter inside a sentence; for one never seen there, how it is written here."""
    share = lexicon[zlib.crc32(word.encode()) % BUCKETS]
    return float(share) if not np.isnan(share) else (written or {}).get(word, 0.6)


def _written(tokens: list[str]) -> dict[str, float]:
    """word -> how name-like it is written in a text whose words are mostly in lower case; the first word tells nothing."""
    plain = sum(t.islower() for t in tokens if t.isalpha()) > 0.5 * sum(t.isalpha() for t in tokens)
    shares = {t.casefold(): 0.9 if t[:1].isupper() else 0.1 for t in tokens[1:]} if plain else {}
    return shares | ({tokens[0].casefold(): 0.1} if tokens and tokens[0].casefold() not in shares else {})


def pair_features(a: str, b: str, lexicon: np.ndarray, references: float = 1.0) -> list[float]:
    """FEATURES of two questions; references is the share of chunk references that both hold."""
    as_x, as_y = _WORD.findall(a), _WORD.findall(b)
    x, y = [t.casefold() for t in as_x], [t.casefold() for t in as_y]
    written = [_written(as_x), _written(as_y)]
    n = max(1, len(x) + len(y))
    only_x, only_y = Counter(x) - Counter(y), Counter(y) - Counter(x)
    mx, my = _months(x), _months(y)
    months = sum(((mx - my) + (my - mx)).values())
    numbers = sum(c for side in (only_x, only_y) for t, c in side.items() if any(ch.isdigit() for ch in t))
    plain = lambda side: [t for t in side.elements() if not any(ch.isdigit() for ch in t)]
    left, right, slips = plain(only_x), plain(only_y), 0
    for t in list(left):
        name = capital_share(lexicon, t, written[0]) > 0.7
        twin = next((u for u in right if _close(t, u, 1 if name or len(t) < 8 else 2)), None)
        if twin is not None:
            left.remove(t)
            right.remove(twin)
            slips += 1
    shares = [[capital_share(lexicon, t, own) for t in side] for side, own in zip((left, right), written, strict=True)]
    names = [sum(side) for side in shares]
    rest = [len(side) - sum(side) for side in shares]
    pairs_x, pairs_y = Counter(zip(x, x[1:], strict=False)), Counter(zip(y, y[1:], strict=False))
    order = 2 * sum((pairs_x & pairs_y).values()) / max(1, len(x) + len(y) - 2)
    return [1.0, min(min(names), 3.0), min(abs(names[0] - names[1]), 3.0), float(numbers), float(months), 10 * min(rest) / n, 10 * abs(rest[0] - rest[1]) / n, 10 * slips / n, order, references]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray | None  # None where there was nothing to learn from: then only equal words are a repeat
    lexicon: np.ndarray
    threshold: float
    accuracy: float  # on synthetic pairs held out
    frequency: np.ndarray | None = None  # how often words occur, by bucket

    def score(self, a: str, b: str, references: float = 1.0) -> float:
        if self.weights is None:
            return float(_WORD.findall(a.casefold()) == _WORD.findall(b.casefold()))
        return float(1 / (1 + np.exp(-np.dot(self.weights, pair_features(a, b, self.lexicon, references)))))


def _repeat(q: str, fillers: list[str], rng: random.Random) -> str:
    """The same question otherwise put: slips, words replaced, added, left out or moved; names, numbers and dates stay."""
    toks = q.split(" ")
    common = [i for i, t in enumerate(toks) if t.isalpha() and t.islower() and t not in MONTHS]
    for i in rng.sample(common, min(len(common), rng.randint(0, 4))):
        what = rng.random()
        t = toks[i]
        if what < 0.35 and len(t) > 4:
            k = rng.randrange(1, len(t) - 1)
            toks[i] = t[:k] + t[k + 1] + t[k] + t[k + 2 :] if rng.random() < 0.7 else t[:k] + t[k + 1 :]
        elif what < 0.75:
            toks[i] = " ".join(rng.choice(fillers) for _ in range(rng.randint(1, 3)))
        else:
            toks[i] = ""
    toks = [t for t in toks if t]
    if rng.random() < 0.4 and len(toks) > 4:
        k = rng.randrange(len(toks) - 1)
        if not any(ch.isdigit() for ch in toks[k] + toks[k + 1]):
            toks[k], toks[k + 1] = toks[k + 1], toks[k]
    extra = " ".join(rng.choice(fillers) for _ in range(rng.randint(1, 5)))
    if rng.random() < 0.35:
        toks = [extra.capitalize() + ",", *toks]
    if rng.random() < 0.35:
        toks = [*toks, " ".join(rng.choice(fillers) for _ in range(rng.randint(1, 5))).capitalize() + "."]
    text, case = " ".join(toks), rng.random()
    if case < 0.1:
        return text.upper()
    return "".join(c.swapcase() if rng.random() < 0.3 else c for c in text) if case < 0.2 else text


def _other(q: str, names: list[str], rng: random.Random) -> str:
    """Another question: a name, number or month is a different one."""
    toks = q.split(" ")
    capital = [i for i, t in enumerate(toks) if i and t[:1].isupper() and t.strip(".,;:?!").isalpha()]
    digits = [i for i, t in enumerate(toks) if any(ch.isdigit() for ch in t)]
    if capital and (rng.random() < 0.7 or not digits):
        i = rng.choice(capital)
        toks[i] = rng.choice(names)
    elif digits:
        i = rng.choice(digits)
        at = rng.choice([k for k, ch in enumerate(toks[i]) if ch.isdigit()])
        toks[i] = toks[i][:at] + str((int(toks[i][at]) + rng.randint(1, 9)) % 10) + toks[i][at + 1 :]
    return " ".join(toks)


def fit(questions: list[str], lexicon: np.ndarray, seed: int = 7) -> Model:
    """Weights by logistic regression on synthetic repeats and near misses of the questions; a fifth is held out."""
    rng = random.Random(seed)
    fillers = sorted({t for q in questions for t in q.split(" ") if t.isalpha() and t.islower() and t not in MONTHS}) or ["so"]
    names = sorted({t for q in questions for t in q.split(" ")[1:] if t.isalpha() and t[:1].isupper()}) or ["Other"]
    rows, labels = [], []
    for i, q in enumerate(questions):
        for _ in range(2):
            rows.append(pair_features(_repeat(q, fillers, rng), q, lexicon, rng.choice((1, 1, 2 / 3, 1 / 2, 1 / 3))))
            labels.append(1.0)
        near = _other(q, names, rng)
        if _WORD.findall(near.casefold()) != _WORD.findall(q.casefold()):
            rows.append(pair_features(_repeat(near, fillers, rng) if rng.random() < 0.5 else near, q, lexicon, rng.choice((1, 1, 2 / 3, 1 / 2, 1 / 3))))
            labels.append(0.0)
        if len(questions) > 1:
            strange = questions[(i + rng.randrange(1, len(questions))) % len(questions)]
            if _WORD.findall(strange.casefold()) != _WORD.findall(q.casefold()):
                rows.append(pair_features(strange, q, lexicon, rng.choice((1, 2 / 3, 1 / 2, 1 / 3, 1 / 4))))
                labels.append(0.0)
    if not rows:
        return Model(None, lexicon, 0.5, float("nan"))
    x, y = np.array(rows), np.array(labels)
    held = np.arange(len(y)) % 5 == 4
    scale = np.maximum(np.abs(x[~held]).max(0), 1e-9)
    w = np.zeros(x.shape[1])
    xs = x[~held] / scale
    for _ in range(60):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(xs @ w, -30, 30)))
        grad = xs.T @ (p - y[~held]) + 0.05 * w
        hess = (xs * (p * (1 - p))[:, None]).T @ xs + 0.05 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    w /= scale
    score = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    cuts = np.linspace(0.05, 0.95, 91)
    right = [float(((score[~held] >= c) == (y[~held] > 0)).mean()) for c in cuts]
    best = float(np.mean(cuts[np.array(right) >= max(right) - 1e-12]))
    check = held if held.any() else ~held
    return Model(w, lexicon, best, float(((score[check] >= best) == (y[check] > 0)).mean()))


def word_statistics(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(share of capital initials, occurrences) by word bucket over all texts (column q): at most BUCKETS rows.

    Shares come from texts of mixed case without their first words, occurrences from all texts.
    """
    found = F.regexp_extract_all("q", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    mixed = F.col("q").rlike(r"\p{Lu}") & F.col("q").rlike(r"\p{Ll}\p{Ll} \p{Ll}")
    word = texts.select(mixed.alias("mixed"), F.posexplode(found).alias("at", "w"))
    bucket = F.pmod(F.crc32(F.encode(F.lower("w"), "UTF-8")), F.lit(BUCKETS)).cast("int")
    inner = (F.col("mixed") & (F.col("at") > 0)).cast("int")
    capital = inner * F.col("w").rlike(r"^\p{Lu}").cast("int")
    share, often = np.full(BUCKETS, np.nan), np.zeros(BUCKETS, np.int64)
    for b, c, n, every in word.groupBy(bucket.alias("b")).agg(F.sum(capital), F.sum(inner), F.count("*")).collect():
        share[b] = c / n if n else np.nan
        often[b] = every
    return share, often


def capital_lexicon(texts: DataFrame) -> np.ndarray:
    """Share of capital initials by word bucket over all texts (column q), first words and texts of one case left out."""
    return word_statistics(texts)[0]


def learn(accepted: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model: statistics of the words of all the questions given, weights from at most sample_rows of them, chosen by a hash of the id."""
    sample = least_hashes(accepted.where("q <> ''").select("id", "q"), "id", sample_rows).select("q").collect()
    share, often = word_statistics(accepted)
    made = fit([r[0] for r in sample], share)
    return Model(made.weights, share, made.threshold, made.accuracy, often)


def plain_numbers(c: Column) -> Column:
    """Numbers written one way: without separators of thousands, leading zeros and endings of ordinals."""
    c = F.regexp_replace(c, r"(?<=\p{Nd})[,'’](?=\p{Nd}{3}(?!\p{Nd}))", "")
    c = F.regexp_replace(c, r"(?<![\p{L}\p{N}.,])0+(?=\p{Nd})", "")
    return F.regexp_replace(c, r"(?i)(?<=\p{Nd})(?:st|nd|rd|th)\b", "")


def _prepared(df: DataFrame, key: str) -> DataFrame:
    """(id, q, form, refs, same) of rows with words and references; same is equal for rows with the same words and references."""
    base = df.select(F.col(key).cast("long").alias("id"), F.coalesce("question", F.lit("")).alias("question"), canonical_refs(F.col("chunk_ids")).alias("refs"))
    text = canonical_texts(base, "question", "q").drop("question").withColumn("q", plain_numbers(F.col("q"))).withColumn("form", words(F.col("q")))
    return text.where((F.size("refs") > 0) & F.col("q").rlike(r"[\p{L}\p{N}]")).withColumn("same", fingerprint(F.concat_ws("\n", "form", F.array_join("refs", "\n"))))


def _keys(df: DataFrame) -> DataFrame:
    """(key, id): a chunk reference with all numbers of the question. Repeats of a question share both."""
    numbers = F.array_join(F.array_sort(F.filter(F.split("form", " "), lambda w: w.rlike(r"\p{N}"))), " ")
    return df.select("id", F.explode("refs").alias("ref"), numbers.alias("n")).select(F.xxhash64("ref", "n").alias("key"), "id").distinct()


def _overlap(a: Column, b: Column) -> Column:
    """Whether two forms share at least OVERLAP of the different words of the longer one."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    return F.size(F.array_intersect(x, y)) >= OVERLAP * F.greatest(F.size(x), F.size(y))


def _rare_words(rows: DataFrame, model: Model) -> DataFrame:
    """(key, id, word) for rows (key, id, form): the rarest words of each, so many that any two rows which share OVERLAP of their words share one."""
    sent = rows.sparkSession.sparkContext.broadcast(model.frequency if model.frequency is not None else np.zeros(BUCKETS, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, form in enumerate(batch.column("form").to_pylist()):
                hashed = {w: zlib.crc32(w.encode()) for w in form.split(" ")}
                ordered = sorted(hashed, key=lambda w: (sent.value[hashed[w] % BUCKETS], hashed[w], w))  # noqa: B023
                kept = ordered[: len(ordered) - int(np.ceil(OVERLAP * len(ordered))) + 1]
                at += [i] * len(kept)
                found += kept
            yield pa.RecordBatch.from_arrays([*batch.select(["key", "id"]).take(pa.array(at, pa.int64())).columns, pa.array(found, pa.string())], names=["key", "id", "word"])

    return rows.select("key", "id", "form").mapInArrow(run, "key long, id long, word string")


def _scored(pairs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """The carried columns of pairs (q, member_q, refs, member_refs) that ask the same question."""
    sent = pairs.sparkSession.sparkContext.broadcast(model)
    shared = F.size(F.array_intersect("refs", "member_refs")) / F.size(F.array_union("refs", "member_refs"))
    given = pairs.select(*carry, "q", "member_q", shared.alias("references"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            both = zip(*(batch.column(c).to_pylist() for c in ("q", "member_q", "references")), strict=True)
            yield batch.select(carry).filter(pa.array([m.score(*x) >= m.threshold for x in both], pa.bool_()))

    return given.mapInArrow(run, given.select(*carry).schema)


def _sized(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= MAX_SENT_KEYS else df


TABLES = {
    "keys": "key long, id long, bucket int",
    "members": "id long, kept array<struct<id: long, refs: array<string>>>, q string, form string, refs array<string>, bucket int",
    "copies": "stand long, id long",
    "pairs": "kept_id long, dup_id long",
    "nodes": "node long, root long, bucket int",
    "unions": "root long, now long, part int",
}


class LinkStore:
    """Accepted rows and what repeats them, as tables under a path in a shared folder. Other sessions open it by that path.

    A part is one batch (part 0 the first rows given). It is written to folders of its own and counts once its mark in `commits`
    is there, so a batch that failed halfway is simply added again, and adding a committed one is refused.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.cuts = Cuts(spark, "linkage")
        self._fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        model = self._read_model()
        self.model, self.buckets = model if model else (None, STORE_BUCKETS)

    # -- files

    def _at(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def parts(self) -> list[int]:
        where = self._at("commits")
        return sorted(int(f.getPath().getName()) for f in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def _read_model(self):
        if not self._fs.exists(self._at("model", "_SUCCESS")):
            return None
        return pickle.loads(self.spark.read.parquet(f"{self.path}/model").first()[0])

    def _write(self, table: str, part: int, df: DataFrame, **figures: Column) -> dict:
        """Writes one part of a table, in its buckets where it has some; figures are taken on the way."""
        schema = T._parse_datatype_string(TABLES[table])
        bucketed = "bucket" in schema.names
        out = df.select(*[F.col(f.name).cast(f.dataType) for f in schema if f.name != "part"])
        seen = None
        if figures:
            seen = self.cuts.observed()
            out = out.observe(seen, *[c.alias(k) for k, c in figures.items()])
        if bucketed:
            out = out.hint("rebalance", "bucket")
        writer = out.write.mode("overwrite")
        (writer.partitionBy("bucket") if bucketed else writer).parquet(f"{self.path}/{table}/part={part}")
        return seen.get if seen else {}

    def read(self, table: str, buckets: list[int] | None = None, parts: list[int] | None = None) -> DataFrame:
        """The committed parts of a table, or those given, and of them only the buckets given."""
        schema = T._parse_datatype_string(TABLES[table])
        paths = [f"{self.path}/{table}/part={n}" for n in (self.parts() if parts is None else parts) if self._fs.exists(self._at(table, f"part={n}", "_SUCCESS"))]
        if not paths:
            return self.spark.createDataFrame([], schema)
        out = self.spark.read.option("basePath", f"{self.path}/{table}").schema(schema).parquet(*paths).select(*schema.names)
        return out if buckets is None else out.where(F.col("bucket").isin([int(b) for b in buckets]))

    def _bucket(self, c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")

    # -- linkage

    @classmethod
    def create(cls, spark: SparkSession, path: str, first: DataFrame, key: str = "eval_id", sample_rows: int = SAMPLE_ROWS, buckets: int = STORE_BUCKETS) -> LinkStore:
        """A new store with the rows accepted before any batch (key, question, chunk_ids), whose questions the model is learned from."""
        store = cls(spark, path)
        if store.parts():
            raise ValueError(f"there is a store under {path}")
        store.buckets = buckets
        rows = store.cuts.cut(_prepared(first, key))
        store.model = learn(rows, sample_rows)
        spark.createDataFrame([(bytearray(pickle.dumps((store.model, buckets))),)], "model binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
        mine, most, _ = store._stand_ins(rows)
        store._write("keys", 0, _keys(mine).withColumn("bucket", store._bucket("key")))
        store._write("members", 0, mine.select("id", F.array(F.struct("id", "refs")).alias("kept"), "q", "form", "refs", store._bucket("id").alias("bucket")))
        store._copies(0, rows, mine, most)
        store._commit(0)
        return store

    def _commit(self, part: int) -> None:
        self._fs.create(self._at("commits", str(part))).close()

    def _stand_ins(self, rows: DataFrame) -> tuple[DataFrame, int, int]:
        """(one row for all of equal words and references, the most rows that one stands for, how many there are)."""
        grouped = rows.groupBy("same").agg(F.min(F.struct("id", "q", "form", "refs")).alias("x"), F.count("*").alias("n")).select("x.*", "same", "n")
        mine, seen = self.cuts.measured(grouped, most=F.max("n"), count=F.count("*"))
        return mine, seen["most"] or 0, seen["count"]

    def _copies(self, part: int, rows: DataFrame, mine: DataFrame, most: int) -> None:
        if most > 1:
            several = mine.where("n > 1").select("same", F.col("id").alias("stand"), "n")
            self._write("copies", part, join_unique(rows.select("id", "same"), several, "same", "n", most))

    def _hits(self, own: DataFrame, n_own: int, part: int, old: list[int], mine: DataFrame, n_mine: int) -> DataFrame:
        """(id, member) once each: rows of the batch with members that share a key. A key that pairs too many is split by words."""
        folders = [f.getPath().getName() for f in self._fs.listStatus(self._at("keys", f"part={part}"))]
        touched = [int(name.split("=")[1]) for name in folders if name.startswith("bucket=")]
        held = self.read("keys", touched, old).select("key", F.col("id").alias("member"))
        counts = own.groupBy("key").agg(F.count("*").alias("n"))
        sizes = held.join(_sized(counts, n_own), "key").groupBy("key").agg(F.count("*").alias("m"), F.max("n").alias("n"))
        hot, seen = self.cuts.measured(sizes.where(F.col("m") * F.col("n") > MAX_BLOCK_PAIRS).select("key"), count=F.count("*"))
        plain = own.select("key", "id")
        if not seen["count"]:
            return held.join(_sized(plain, n_own), "key").select("id", "member").distinct()
        hot = _sized(hot, seen["count"])
        texts = self.read("members", None, old).select(F.col("id").alias("member"), "form")
        theirs = _rare_words(held.join(hot, "key").join(texts, "member").select("key", F.col("member").alias("id"), "form"), self.model)
        ours = _rare_words(plain.join(hot, "key").join(_sized(mine.select("id", "form"), n_mine), "id"), self.model)
        split = theirs.withColumnRenamed("id", "member").join(ours, ["key", "word"]).select("id", "member")
        rest = held.join(_sized(plain.join(hot, "key", "left_anti"), n_own), "key").select("id", "member")
        return rest.unionByName(split).distinct()

    def add(self, batch: DataFrame, part: int, key: str = "row_id") -> None:
        """Links one batch (key, question, chunk_ids) with all before it and adds it to the store as that part."""
        old = self.parts()
        if part in old:
            raise ValueError(f"part {part} is in the store")
        cuts = self.cuts
        rows = cuts.cut(_prepared(batch, key))
        mine, most, n_mine = self._stand_ins(rows)
        n_own = self._write("keys", part, _keys(mine).withColumn("bucket", self._bucket("key")), count=F.count("*"))["count"]
        own = self.read("keys", None, [part])
        hits, seen = cuts.measured(self._hits(own, n_own, part, old, mine, n_mine), count=F.count("*"), buckets=F.collect_set(self._bucket("member")))
        texts = self.read("members", seen["buckets"] or [], old).select(F.col("id").alias("member"), F.col("q").alias("member_q"), F.col("form").alias("member_form"), F.col("refs").alias("member_refs"), "kept")
        pairs = texts.join(_sized(hits, seen["count"]), "member").join(_sized(mine.select("id", "q", "form", "refs", "same", "n"), n_mine), "id")
        alike = _scored(pairs.where(_overlap(F.col("form"), F.col("member_form"))), self.model, ["id", "refs", "same", "n", "kept"])
        tied = alike.select("id", "refs", "same", "n", F.explode("kept").alias("k")).where(F.arrays_overlap("refs", "k.refs"))
        tied = tied.select("id", "same", "n", F.col("k.id").alias("kept_id"), F.col("k.refs").alias("kept_refs")).distinct()
        tied, seen = cuts.measured(tied, buckets=F.collect_set(self._bucket("kept_id")))
        self._write("pairs", part, join_unique(rows.select(F.col("id").alias("dup_id"), "same"), tied.select("same", "kept_id", "n"), "same", "n", most))
        kept_of = tied.groupBy("id").agg(F.collect_list(F.struct(F.col("kept_id").alias("id"), F.col("kept_refs").alias("refs"))).alias("of"))
        fresh = mine.join(kept_of, "id", "left").select("id", F.coalesce("of", F.array(F.struct("id", "refs"))).alias("kept"), "q", "form", "refs", self._bucket("id").alias("bucket"))
        self._write("members", part, fresh)
        self._copies(part, rows, mine, most)
        self._unite(part, old, tied.select(F.col("kept_id").alias("a"), F.col("id").alias("b")), seen["buckets"] or [])
        self._commit(part)

    def _unions(self, parts: list[int] | None = None) -> DataFrame:
        """(root, now): the representative of each root that was united with another one, as the last part says."""
        return self.read("unions", None, parts).groupBy("root").agg(F.max_by("now", "part").alias("now"))

    def _unite(self, part: int, old: list[int], links: DataFrame, buckets: list[int]) -> None:
        """Representatives after links from kept rows (a) to their repeats (b).

        A repeat takes the representative of its kept row. Clusters that one repeat ties together are united under the smallest of
        their representatives: a row of `unions` for each representative that changes, and no row of a member is written again.
        """
        known = self.read("nodes", buckets, old).select(F.col("node").alias("a"), "root")
        now = self._unions(old)
        up = links.join(known, "a", "left").join(now, "root", "left").select("a", "b", F.col("root").isNull().alias("fresh"), F.coalesce("now", "root", "a").alias("r"))
        lifted = self.cuts.cut(up)
        ends, seen = self.cuts.measured(lifted.groupBy("b").agg(F.min("r").alias("least"), F.max("r").alias("most")), tied=F.max(F.col("least") != F.col("most")))
        nodes = lifted.where("fresh").select(F.col("a").alias("node"), F.col("r").alias("root")).unionByName(ends.select(F.col("b").alias("node"), F.col("least").alias("root"))).distinct()
        self._write("nodes", part, nodes.withColumn("bucket", self._bucket("node")))
        if not seen["tied"]:
            return
        edges = lifted.join(ends.where("least <> most"), "b").select(F.col("least").alias("a"), F.col("r").alias("b"))
        changed = components(edges).where("node <> component").select(F.col("node").alias("root"), F.col("component").alias("now"))
        moved = now.select(F.col("root").alias("of"), F.col("now").alias("root")).join(changed, "root").select(F.col("of").alias("root"), "now")
        self._write("unions", part, changed.unionByName(moved))

    # -- results

    def pairs(self) -> DataFrame:
        """(kept_id, dup_id) of all parts. Every copy of a kept row is a kept row too."""
        copies = self.read("copies").select(F.col("stand").alias("kept_id"), "id")
        return self.read("pairs").join(copies, "kept_id", "left").select(F.coalesce("id", "kept_id").alias("kept_id"), "dup_id").distinct()

    def clusters(self) -> DataFrame:
        """(id, cluster) for every row that belongs to one of two or more, copies among them; cluster is the smallest kept row of it."""
        roots = self.read("nodes").join(self._unions(), "root", "left").select("node", F.coalesce("now", "root").alias("component"))
        return _with_copies(roots, self.read("copies"))


def link_batches(bank: DataFrame, batches: DataFrame, sample_rows: int = SAMPLE_ROWS, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(pairs, clusters): pairs (kept_id, dup_id), clusters (id, cluster) for every row that
    belongs to one of two or more, cluster being the smallest kept row of it. Copies within a batch or the bank are of one
    cluster, whether or not another row repeats them.

    bank: eval_id, question, chunk_ids; batches: row_id, batch_no, question, chunk_ids. The bank makes a new store under path (a
    scratch folder where none is given), to which the batches are added in order of batch_no; rows without one are the last
    batch. A row repeats an earlier row if the model says so, both share OVERLAP of their words and both hold a chunk reference. A
    kept row repeats none; what repeats a repeat is held against its kept rows. Rows without references or words repeat nothing.
    Rows of one batch (or of the bank) with the same words and references stand for each other in the key table, by the smallest id;
    the pairs hold each of them, both as kept rows and as repeats, so a question held k times and repeated m times gives k * m
    pairs. Empty tables give no pairs; extra columns are ignored.
    """
    spark = bank.sparkSession
    numbers = [r[0] for r in batches.select("batch_no").distinct().orderBy(F.asc_nulls_last("batch_no")).collect()]
    store = LinkStore.create(spark, path or scratch_path(spark, "linkage-store"), bank, sample_rows=sample_rows)
    for part, number in enumerate(numbers, 1):
        store.add(batches.where(F.col("batch_no").eqNullSafe(F.lit(number))), part)
    return store.pairs(), store.clusters()


def _with_copies(roots: DataFrame, copies: DataFrame) -> DataFrame:
    """(id, cluster): each copy (stand, id) is in the cluster of its stand-in; copies that nothing ties make one of their own."""
    every = roots.select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    up = roots.select(F.col("node").alias("stand"), "component")
    return every.unionByName(copies.join(up, "stand", "left").select("id", F.coalesce("component", "stand").alias("cluster"))).distinct()
