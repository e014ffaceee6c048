import random

import numpy as np
import pyarrow as pa
import pytest

from quarryline.llm import defects

NAMES = ["Alderby Holdings", "Brunswick Trustees", "Carvene Clearing", "Dunmore Capital", "Eastvale Brokers"]
PAIRS = {
    "en": [("By when must {f} file the report under AB/{y}/{n}?", "{f} has {d} days from the day the quarter closes to file the report."), ("How large is the fee that {f} pays for the letter of {y}?", "The Board set a fee of {n} crowns, which {f} paid at the office on {d} May {y}."), ("Who signs the form that {f} sends under AB/{y}/{n}?", "Form R-{d}"), ("Why was the letter of {f} returned by the desk?", "{f} was unable to show the letter in time, so the rate of {d} per cent applied to it.")],
    "de": [("Welche Frist gilt für {f} nach dem Rundschreiben AB/{y}/{n}?", "{f} hat {d} Tage Zeit, den Bericht einzureichen, und eine Verlängerung ist ausgeschlossen.")],
    "fr": [("Quelle pénalité la circulaire AB/{y}/{n} prévoit-elle pour {f} ?", "La pénalité est de {n} couronnes et elle est due dès la réception de l'avis.")],
}


def pairs(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        q, a = rng.choice(PAIRS[rng.choices(list(PAIRS), [6, 1, 1])[0]])
        fill = {"f": rng.choice(NAMES), "y": rng.randint(2018, 2031), "n": rng.randint(1000, 9999), "d": rng.randint(2, 29)}
        out.append((q.format(**fill), a.format(**fill)))
    return out


@pytest.fixture(scope="module")
def model():
    return defects.fit(sorted(set(pairs(1500, 1))))


def found(model, rows):
    q, a = (pa.array([r[i] for r in rows], pa.string()) for i in (0, 1))
    return [defects.LABELS[k] if k >= 0 else None for k in model.defects(q, a)]


def test_held_out_accuracy(model):
    questions, answers, labels = defects.synthetic(pairs(400, 2), 9)
    got = model.defects(pa.array(questions, pa.string()), pa.array(answers, pa.string()))
    for k in range(5):
        assert (got[labels == k] == k).mean() > 0.9, defects.LABELS[k]
    assert (got[labels == -1] != -1).mean() < 0.02


def test_kinds(model):
    q, a = PAIRS["en"][1]
    fill = {"f": NAMES[0], "y": 2025, "n": 4321, "d": 7}
    q, a = q.format(**fill), a.format(**fill)
    rows = [(q, ""), (q, "N/A"), (q, " — "), (q, a[:30]), (q, "I'm sorry, but I can't help with that."), (q, q.upper()), (q, PAIRS["de"][0][1].format(**fill)), (q, a), (q, a.rstrip("."))]
    assert found(model, rows) == ["empty_answer"] * 3 + ["truncated_answer", "refusal", "copied_question", "wrong_language", None, None]


FAMILIES = list(defects.REFUSALS)


@pytest.mark.parametrize("turn", range(3))
def test_refusals_of_families_never_seen(turn):
    held = tuple(FAMILIES[turn::3])
    model = defects.fit(sorted(set(pairs(1500, 1))), families=tuple(f for f in FAMILIES if f not in held))
    rng = random.Random(turn)
    rows = [(q, defects.refusal(q.split(" ")[-2], rng, held)) for q, _ in pairs(300, 5)]
    assert sum(x == "refusal" for x in found(model, rows)) / len(rows) > 0.85


def test_languages_that_no_list_names():
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.01/training_rows.parquet", columns=["question", "answer"]).to_pylist()
    model = defects.fit(sorted({(r["question"], r["answer"]) for r in table if r["question"] and r["answer"]}))
    q = PAIRS["en"][1][0].format(f=NAMES[0], y=2025, n=4321, d=7)
    answers = ["Styrelsen fastställde en straffavgift på 17,250 kronor eftersom rapporten kom för sent.", "Rada stanovila pokutu 17,250 korun, protože zpráva přišla po uplynutí lhůty.", "Kurul, rapor çok geç geldiği için şirkete 17,250 kron para cezası verdi.", "董事会因客户资金报表逾期而处以罚款一万七千克朗。", "取締役会は顧客資金報告書の遅延により罰金を科しました。"]
    assert found(model, [(q, a) for a in answers]) == ["wrong_language"] * 5


def test_spun_templates():
    rng = random.Random(1)
    assert {defects.spun("(a|b (c|d)) e|f", rng) for _ in range(200)} == {"a e", "b c e", "b d e", "f"}
    assert all("(" not in x and "|" not in x for _ in range(500) for x in [defects.refusal("X", rng)])


def test_the_share_and_the_parting_of_scores():
    rng = np.random.default_rng(1)
    scores = np.concatenate([rng.normal(-9, 1, 9800), rng.normal(4, 1, 200)])
    assert defects.expected_share(scores, 0.17) == pytest.approx(0.02, abs=0.006)
    assert -6 < defects.parting(scores, 3.0) < 2 and defects.parting(np.linspace(-10, 10, 5000), 1.0) == 1.0


def test_lbfgs_finds_the_minimum():
    a = np.diag(np.arange(1.0, 21))
    w = defects.minimised(lambda w: (float(0.5 * w @ a @ w - w.sum()), a @ w - 1), np.zeros(20), 200)
    assert np.abs(w - 1 / np.arange(1.0, 21)).max() < 0.05


def test_whole_table(spark, model):
    rows = [(i, q, a, 1) for i, (q, a) in enumerate(pairs(200, 3))] + [(900, None, None, 1), (901, "", "", 1), (902, "q", "x " * 300_000, 1)]
    df = spark.createDataFrame(rows, "record_number long, question string, answer string, defect int").repartition(3)
    got = {r.record_number: r.defect for r in defects.broken_pairs(df, model).collect()}
    assert got.pop(900) == got.pop(901) == "empty_answer"
    assert len(got) < 8
    assert defects.broken_pairs(df.limit(0), model).count() == 0


def test_training_on_little_or_nothing(spark):
    df = spark.createDataFrame([], "record_number long, question string, answer string")
    nothing = defects.train(df)
    assert (nothing.defects(pa.array(["q"]), pa.array(["a"])) == -1).all()
    defects.fit(pairs(3, 1))


def test_features_do_not_depend_on_the_batch(model):
    rows = pairs(50, 4)
    q, a = (pa.array([r[i] for r in rows], pa.string()) for i in (0, 1))
    whole = model.defects(q, a)
    parts = np.concatenate([model.defects(q[i : i + 7], a[i : i + 7]) for i in range(0, 50, 7)])
    assert (whole == parts).all()


def test_every_row_counts_in_training(spark):
    """German stands only in the 900 of 13,000 rows with the greatest hash of their key."""
    from pyspark.sql import functions as F

    keys = [r[0] for r in spark.range(13_000).orderBy(F.xxhash64("id").desc()).collect()]
    english = [x for x in pairs(18_000, 6) if x[0].split(" ")[0] in ("By", "How", "Who", "Why")]
    q, a = PAIRS["de"][0]
    fills = [{"f": NAMES[i % 5], "y": 2018 + i % 13, "n": 1000 + 7 * i, "d": 2 + i % 27} for i in range(900)]
    german = [(q.format(**x), a.format(**x)) for x in fills]
    rows = [(k, *p) for k, p in zip(keys, german + english, strict=False)]
    assert len(rows) == 13_000
    model = defects.train(spark.createDataFrame(rows, "record_number long, question string, answer string").repartition(3))
    found_in = lambda some: [defects.LABELS[k] if k >= 0 else None for k in model.defects(*(pa.array([r[i] for r in some], pa.string()) for i in (0, 1)))]
    assert found_in(german[:50]) == [None] * 50
    assert found_in([(g[0], e[1]) for g, e in zip(german[:50], [x for x in english if "Board set" in x[1]], strict=False)]) == ["wrong_language"] * 50


def test_sums_of_parts_are_those_of_the_whole():
    some = pairs(300, 8)
    whole = defects.count_languages(*defects._columns(some))
    parts = [defects.count_languages(*defects._columns(some[i : i + 70])) for i in range(0, 300, 70)]
    for k in range(2):
        assert (whole[k] == sum(p[k] for p in parts)).all()
    texts = [t for p in some for t in p]
    names = [defects._LANGUAGES[k] if k >= 0 else None for k in defects.tongues_of(defects._Side(pa.array(texts)))]
    assert names == [defects.language(t) for t in texts]


def test_thresholds_from_counted_scores():
    rng = np.random.default_rng(2)
    scores = np.rint(np.concatenate([rng.normal(-9, 1, 9800), rng.normal(4, 1, 200)]) * 64) / 64
    values, times = np.unique(scores, return_counts=True)
    share = defects.expected_share(values, 0.17, times=times)
    assert share == pytest.approx(defects.expected_share(scores, 0.17))
    assert defects.parting(values, 3.0, times) == pytest.approx(defects.parting(scores, 3.0))


def test_a_frequent_short_answer_is_sound():
    some = pairs(1500, 1)
    yes = [(f"Does {f} hold a licence under AB/{y}/{n}?", "Yes") for f in NAMES for y in range(2018, 2024) for n in (1234, 5678, 9012)]
    model = defects.fit(sorted(set(some + yes)))
    assert found(model, yes) == [None] * len(yes)


def test_the_model_does_not_depend_on_partitions(spark):
    rows = [(i, q, a) for i, (q, a) in enumerate(pairs(500, 9))] * 2 + [(900, None, "x"), (901, "q", None), (902, "", "")]
    df = spark.createDataFrame(rows, "record_number long, question string, answer string")
    one, other = (defects.train(df.repartition(n), block_rows=60) for n in (1, 7))
    assert (one.weights == other.weights).all() and (one.thresholds == other.thresholds).all()
    assert one.weights.any()


def test_a_fit_takes_few_passes(monkeypatch):
    passes, minimised = [], defects.minimised

    def counted(value_and_slope, w, *args, **options):
        return minimised(lambda x: passes.append(len(x)) or value_and_slope(x), w, *args, **options)

    monkeypatch.setattr(defects, "minimised", counted)
    some = sorted(set(pairs(1500, 1)))
    defects.fit_block(some, defects.fit_languages(some))
    assert sum(passes) < 900_000  # weights that all passes together went over


def test_going_on_from_a_minimum_ends_at_once_and_no_higher():
    a = np.diag(np.arange(1.0, 21))
    values = []

    def bowl(w):
        values.append(float(0.5 * w @ a @ w - w.sum()) + 3)
        return values[-1], a @ w - 1

    w = defects.minimised(bowl, np.zeros(20), 200)
    lowest, values[:] = values[-1], []
    defects.minimised(bowl, w, 200, least_fall=0.005)
    assert len(values) < 8 and values[-1] <= lowest + 1e-9


def test_answers_to_one_question_share_its_side():
    some = pairs(60, 3)
    q, a = defects._columns(some)
    languages = defects.fit_languages(some)
    of = np.array([5, 5, 0, 41, 5, 7])
    each = lambda x: sorted(zip(*(y.tolist() for y in x), strict=True))
    answers = a.slice(10, len(of))
    shared = defects.features(defects._Side(q), answers, languages, of)
    assert each(shared) == each(defects.features(q.take(pa.array(of)), answers, languages))
    assert each(defects._made_features(defects._Side(q), answers.to_pylist(), languages, of)) == each(shared)


def test_features_see_neither_case_nor_kinds_of_blanks():
    some = pairs(40, 3)
    q, a = defects._columns(some)
    languages = defects.fit_languages(some)
    plain = [np.sort(x) for x in defects.features(q, a, languages)]
    for change in (str.upper, str.lower, str.title, str.swapcase, lambda t: t.replace(" ", " \n\t ")):
        other = defects.features(q, pa.array([change(x) for _, x in some]), languages)
        assert all((x == np.sort(y)).all() for x, y in zip(plain, other, strict=True))


def test_a_noisy_pair_that_is_the_same_counts_with_its_pair():
    some = pairs(400, 3)
    _, answers, labels, sources, times = defects.made_of(some, 1, tuple(defects.REFUSALS))
    of_pair = np.bincount(sources[:, 0], weights=times * (np.array(answers, object) == np.array([some[i][1] for i in sources[:, 0]], object)) * (labels == -1))
    changed = np.bincount(sources[:, 0], weights=(labels == -1) & (times == 1))
    assert set(times) == {1, 2} and ((of_pair == 2) | (changed >= 2)).all()


def test_held_is_membership():
    rng = np.random.default_rng(4)
    near = (np.uint64(7) << np.uint64(50)) + np.arange(300, dtype=np.uint64)  # all in one place of the first table
    of = np.concatenate([rng.integers(0, 1 << 63, 2000, dtype=np.uint64), near, near[:50]])
    some = np.concatenate([rng.permutation(of)[:900], rng.integers(0, 1 << 63, 900, dtype=np.uint64), near + np.uint64(200), np.zeros(3, np.uint64)])
    assert (defects._held(some, of) == np.isin(some, of)).all()
    assert not defects._held(some, of[:0]).any() and not len(defects._held(some[:0], of))
