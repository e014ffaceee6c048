import hashlib
import json
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline.functions import chunks, keys, text


def run(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_references(spark):
    given_ = ["d#007", "a#b#7", " d # 02 ", "d#0", "d#00", "d", "#3", "d#x", "d#-1", "d#", "", " ", None, "x y#1", "d#１"]
    want = ["d#7", "a#b#7", "d#2", "d#0", "d#0", None, None, None, None, None, None, None, None, "x y#1", None]
    assert run(spark, given_, chunks.canonical_ref) == want
    lists = [["d#2", "d#1", None, "d#01", "zz"], [], None]
    assert run(spark, lists, chunks.canonical_refs, "array<string>") == [["d#1", "d#2"], [], []]
    assert run(spark, [[" b ", "a", None, "", "a"], None], chunks.canonical_docs, "array<string>") == [["a", "b"], []]
    assert run(spark, ["a#b#7", "d"], chunks.ref_doc) == ["a#b", "d"]
    assert run(spark, ["a#b#7", "d", "d#x"], chunks.ref_index) == [7, -1, -1]


def test_words_and_folding(spark):
    given_ = ["Straße, STRASSE!", "ſ ς Σ", "a_b-c", None, "", "x" * 300_000, "naïve café"]
    assert run(spark, given_, text.words) == ["strasse strasse", "s σ σ", "a b c", "", "", "x" * 300_000, "naïve café"]


@settings(max_examples=25, deadline=None)
@given(values=st.lists(st.text(st.characters(exclude_categories=["Cs", "Cc"]).filter(lambda c: unicodedata.ucd_3_2_0.category(c) != "Cn"), max_size=12), min_size=1, max_size=20))
def test_words_follow_python(spark, values):
    import re  # letters of later Unicode versions than the JVM's are no words to it

    want = [" ".join(re.findall(r"[^\W_]+", v.casefold())) for v in values]
    assert run(spark, values, text.words) == want


def test_fold_is_casefold_for_every_character(spark):
    import sys

    chars = [c for code in range(sys.maxunicode + 1) if unicodedata.category(c := chr(code)) not in ("Cs", "Cn", "Co")]
    values = ["".join(chars[i : i + 50]) for i in range(0, len(chars), 50)] + [c + "ΣAς" for c in chars if c.casefold() != c]
    assert run(spark, values, text.fold) == [v.casefold() for v in values]


def test_tokens_take_ascii_letters_only(spark):
    assert run(spark, ["20\u212aM Straße AB", None], text.tokens) == [["20", "stra", "ab"], []]


def test_keys(spark):
    def stable(value):
        return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    qs = ["tab\x01\x1b\x7f end", 'He said "hi" \\ there', "Größe  ÜBER", "a/b", "", None, "日本 \x7f", "𝔘nicode"]
    fold = [" ".join((q or "").split()).casefold() for q in qs]
    assert run(spark, qs, keys.question_hash) == [stable({"eval_question": q}) for q in fold]
    refs = [["d#1", "d#2"], ["ä#1", "日本#2"], ["q\x01#3", 'x"#4'], []]
    assert run(spark, refs, keys.doc_key, "array<string>") == [stable(r) for r in refs]
    df = spark.createDataFrame([("Q é", None, ["d#1", "d#2"])], "q string, a string, r array<string>")
    got = df.select(keys.train_key(F.col("q"), F.col("a"), F.col("r")).alias("k"), keys.doc_key(F.col("r")).alias("d")).first()
    assert got.k == stable({"question": "q é", "answer": "", "chunk_ids": ["d#1", "d#2"]}) and got.d == stable(["d#1", "d#2"])


@pytest.mark.parametrize(("a", "b", "want"), [("the cat sat", "the cat ran", 0.5), ("", "x y", 0.0), ("a b", "a b", 0.0), ("Aa bb", "aa BB", 1.0)])
def test_jaccard_of_tokens(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(text.jaccard(text.tokens(F.col("a")), text.tokens(F.col("b"))).alias("j")).first().j == want


def test_truncate(spark):
    assert run(spark, ["abc  def ghi", "short", None], lambda c: text.truncate(c, 8)) == ["abc d...", "short", ""]
