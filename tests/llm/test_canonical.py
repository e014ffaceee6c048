import unicodedata

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import canonical
from quarryline.llm.codepoints import codepoints, row_slices, to_arrow


def one(text):
    return canonical.canonical_array(pa.array([text], pa.string())).to_pylist()[0]


def rowwise(text):
    """The same form, one text and one character at a time."""
    alike = {p[0]: p[1] for p in canonical.LOOK_ALIKES.split()}
    flat = unicodedata.normalize("NFC", "".join(canonical._decomposed(ord(c), alike) for c in text))
    words, out = flat.split(" "), []
    del words
    run = ""
    for c in flat + "\0":
        if c in " \t\n":
            run += c
            continue
        if run and out and c != "\0":
            out.append("\n" if "\n" in run else " ")
        run = ""
        if c != "\0":
            out.append(c)
    return "".join(out)


LETTERS = st.sampled_from("aeoubnцёЁйсоеАВНpxȩ̣́́̈ﬁﬃＡ９０ \t\n​­ …‐Ωο가")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(LETTERS, max_size=12), max_size=6))
def test_equals_the_rowwise_form(texts):
    assert canonical.canonical_array(pa.array(texts, pa.string())).to_pylist() == [rowwise(t) for t in texts]


@given(st.lists(st.text(max_size=8), max_size=8))
def test_code_points_round_trip(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert to_arrow(*codepoints(pa.array(texts, pa.string()))).to_pylist() == texts


def test_what_looks_alike_and_what_does_not():
    assert one("Ｔｈｅ ﬁ​ling — café") == one("The filing — café")
    assert one("Неlena") == one("Helena")
    assert one("αρκυ ΟΗ օո ᎪᎬ Үѵ Ⅻ ⲢⲞ") == "apku OH on AE Yv XII PO"
    for a, b in (("Cafe", "Café"), ("word", "Word"), ("page 1", "page 2"), ("x²", "x2"), ("O", "0"), ("l", "1")):
        assert one(a) != one(b)


def test_null_empty_long_and_idempotent():
    assert canonical.canonical_array(pa.array([None, "", " ​ "], pa.string())).to_pylist() == [None, "", ""]
    long = "ｗｏｒｄ é " * 200_000
    assert one(one(long)) == one(long) == ("word é " * 200_000).strip()


def test_slices_cover_each_row_once():
    import numpy as np

    parts = list(row_slices(np.array([0, 5, 100, 1, 1, 0]), 10))
    assert [x for a, b in parts for x in range(a, b)] == list(range(6))


def test_pairs(spark):
    rows = [(1, "a ﬁle", "x"), (2, "a file", "x"), (3, "a file", "x"), (4, "A file", "x"), (5, None, "x"), (6, "", "x"), (7, "​", "x"), (8, "a file ", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string")
    assert {tuple(r) for r in canonical.look_alike_pairs(df).collect()} == {(1, 2), (1, 3), (1, 8), (2, 8), (3, 8)}
    assert canonical.look_alike_pairs(df.limit(0)).collect() == []
    kept = canonical.canonical_texts(df, "text", "form")
    assert kept.columns == ["doc_id", "text", "form"] and kept.where("doc_id = 1").first().form == "a file"


def test_classes_hold_every_document(spark):
    rows = [(1, "a ﬁle"), (2, "a file"), (3, "a file"), (4, "A file"), (5, None), (6, ""), (7, "other"), (8, "other")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class_id int").repartition(3)
    assert sorted(tuple(r) for r in canonical.look_alike_classes(df).collect()) == [(1, 1), (2, 1), (3, 1)]
    assert canonical.look_alike_classes(df.limit(0)).count() == 0


def test_a_hot_class_is_spread_over_salts(spark, monkeypatch):
    monkeypatch.setattr(canonical, "PAIR_ROWS", 7)
    df = spark.createDataFrame([(i, "hot " + "\u200b" * (i % 4) + "text") for i in range(60)], "doc_id long, text string")
    assert {tuple(r) for r in canonical.look_alike_pairs(df).collect()} == {(a, b) for a in range(60) for b in range(a + 1, 60) if a % 4 != b % 4}


def test_a_larger_list_is_read(tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("\ufeff# comment\n10D5 ; 006C ; MA # x\n0031 ; 006C ; MA\n0665 ; 006F ; MA\n1D7C ; 0069 0335 ; MA\n")
    assert canonical.read_look_alikes(str(path)) == {"\u10d5": "l"}
    assert canonical.canonical_array(pa.array(["\u10d5a"], pa.string()), str(path)).to_pylist() == ["la"] and one("\u10d5a") == "\u10d5a"
