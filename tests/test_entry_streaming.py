import glob
import json
import math
import os
import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from quarryline.streaming import ledger

DATA = "/root/testdata/sf0.001"
QUICK = ["source_row_counts", "source_unique_counts", "citations_per_row_summary", "top_chunks", "top_evidence_signatures", "question_reuse", "train_keys", "eval_question_hashes", "delta_summary", "cocitation_edges", "cocitation_components", "hydrated_chunks", "validated_candidates", "judge_gate", "filter_verdicts", "bank_append", "bank_subset", "export_dedupe", "p7_found"]


def test_names():
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    assert {"p6_found", "p7_found"} <= set(names)


def flat(rows, columns):
    plain = lambda v: round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    return sorted(([plain(r[c]) for c in columns] for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", QUICK)
def test_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {Path(f).stem} as select * from '{f}'")
    got = entry.queries()[name](spark, DATA)
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    want = [dict(zip(columns, r, strict=True)) for r in result.fetchall()]
    assert sorted(columns) == sorted(got.columns)
    a, b = flat([r.asDict() for r in got.collect()], sorted(columns)), flat(want, sorted(columns))
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert all(v == w or (isinstance(v, float) and math.isclose(v, w, abs_tol=1e-6)) for v, w in zip(x, y, strict=True))


def test_core_stands_without_the_subpackage(tmp_path):
    root = Path(entry.__file__).parent
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "class No:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('quarryline.llm'): raise ImportError(name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "names = e.queries(); assert 'p6_found' in names and 'p1_found' not in names; e.oracle_sql()\n"
    ) % str(root)
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
    for path in (root / "quarryline").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b", path.read_text()), path


def test_ledger_stream(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "ledger")
    folder.mkdir()
    row = lambda i, q: json.dumps({"row_id": i, "assignment_id": "a", "question": q, "eval_question_hash": None})
    (folder / "1.json").write_text("\n".join([row(1, "q one"), row(2, "Q  One"), row(3, "two")]))
    ledger.follow(spark, str(folder), path, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.row_id for r in ledger.ledger(spark, path).collect()) == [1, 3]
    (folder / "2.json").write_text("\n".join([row(4, "two"), row(5, "three")]))
    ledger.follow(spark, str(folder), path, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.row_id for r in ledger.ledger(spark, path).collect()) == [1, 3, 5]
    again = spark.createDataFrame([(5, "a", "three", None), (6, "a", "two", None)], ledger.ROW)
    ledger.append_batch(path)(again, 1)
    assert sorted(r.row_id for r in ledger.ledger(spark, path).collect()) == [1, 3, 5]
