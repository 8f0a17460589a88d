"""Every catalogue query against its SQL, and the rows-only ones against their invariants."""

import subprocess
import sys

import pytest

import __spark_entry__ as entry
from compare import connect, compare

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF), duck, SQL[name]) == []


def test_entry(spark):
    assert {r["split"] for r in entry.entry(spark).collect()} == {"train", "val", "test"}


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """The entry file works from another folder, where workers cannot import the package."""
    code = f"""
import sys, importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", {entry.__file__!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print([m.queries()[q](spark, {SF!r}).count() for q in ("retrieve_topk", "retrieve_topk_blocks", "greedy_token_f1")])
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    first, second, third = eval(done.stdout.strip().splitlines()[-1])
    assert first == second > 0 and third == 1


def test_train_predict(spark):
    rows = entry.queries()["train_predict"](spark, SF).collect()
    assert rows and all(0.5 <= r["confidence"] <= 1 and r["predicted"] in (0, 1) for r in rows)


def test_translation_report(spark):
    row = entry.queries()["translation_report"](spark, SF).first()
    assert row["language"] == "telugu" and row["pairs"] > 0 and 0 <= row["bleu"] <= 100 and 0 < row["token_f1"] <= 1


def test_text_token_f1_by_brute_force(spark):
    import numpy as np
    from phraseloom import catalog
    from phraseloom.operators.encode import gram_counts

    def unit(text):
        m = gram_counts([f" {w.lower()} " for w in text.split()])
        return m / np.linalg.norm(m, axis=1, keepdims=True)

    texts = {r["conv_id"] * 1000 + r["turn"]: r for r in catalog.pairs(spark, SF).collect()}
    for r in entry.queries()["text_token_f1"](spark, SF).collect():
        sims = unit(texts[r["pair_id"]]["target_idiom"]) @ unit(texts[r["pair_id"]]["source_idiom"]).T
        p, q = sims.max(axis=1).mean(), sims.max(axis=0).mean()
        assert r["f1"] == pytest.approx(2 * p * q / (p + q), abs=1e-4)


def test_translate_text(spark):
    df = entry.queries()["translate_text"](spark, SF)
    rows = df.collect()
    assert rows and len({r["query_id"] for r in rows}) == len(rows)
    assert all(r["target_language"] == "Hindi" for r in rows)
