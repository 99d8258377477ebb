"""Each stage of the pipeline against a plain version on its own input, and the run as a whole."""

import random

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline as cp  # noqa: E402

from tests.llm import test_jaccard_join as jaccard  # noqa: E402
from tests.llm import test_line_dedup as lines  # noqa: E402
from tests.llm import test_quality  # noqa: E402


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("al", "be", "co", "du", "el", "fa") for b in ("ra", "mo", "tin", "ser", "vo", "lin", "ga")]
    sentence = lambda n: " ".join(rng.choices(words, k=n)).capitalize() + "."
    benchmark = [(k, sentence(25) + " " + sentence(6)) for k in range(10)]
    rows = []
    for d in range(900):
        text = "\n".join(sentence(rng.randrange(8, 25)) for _ in range(rng.randrange(2, 9)))
        if d % 9 == 0:
            text = " | ".join(text.split())
        elif d % 50 == 1:
            text += " " + benchmark[d % 10][1] + " " + sentence(9)
        elif d % 50 == 4:
            text = rows[-1][1].replace(words[0], words[1], 1)
        rows.append((d, text, "en", f"s{d % 3}", len(text)))
    rows += [(2000, None, "en", "s", 0), (2001, "", None, "s", 0), (2002, "one line", "en", None, 8)]
    at = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(d, int(d % 9 > 0), 0) for d in range(0, 900, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return f"{at}", rows, benchmark


def test_stages(spark, world):
    sf_dir, rows, benchmark = world
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("keep_0", cp.F.lit(1))
    texts = {r[0]: r[1] for r in rows}

    deduped = cp.repeated_lines(spark, docs, sf_dir)
    assert deduped.columns == cp.COLUMNS
    want = lines.brute([r[:2] for r in rows])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in deduped.collect()}
    assert got == {d: (t, len(t)) for d, t in want.items() if t or not texts[d]}

    single = cp.near_duplicate_removal(spark, docs, sf_dir)
    assert single.columns == cp.COLUMNS
    groups = jaccard.brute([r[:2] for r in rows])
    assert {r["doc_id"] for r in single.collect()} == {d for d, g in groups.items() if g[0] == d}

    clean = cp.benchmark_removal(spark, docs, sf_dir)
    assert clean.columns == cp.COLUMNS
    assert {r["doc_id"] for r in clean.collect()} == {d for d, t in texts.items() if not any(b in (t or "") for _, b in benchmark)}


def test_quality_stage(spark, tmp_path):
    rows = [(k, t, label) for k, (t, label) in enumerate(test_quality.texts(5000, 8))] + [(9000, None, 1), (9001, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "1L as n_chars", "0 as score")
    spark.createDataFrame([(k, label, 0) for k, _, label in rows[:4000]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    good = cp.quality_filter(spark, docs, str(tmp_path))
    assert good.columns == cp.COLUMNS
    kept = {r["doc_id"] for r in good.select("doc_id").collect()}
    clean, junk = {k for k, _, label in rows[:5000] if label}, {k for k, _, label in rows if not label}
    assert len(clean - kept) <= 0.005 * len(clean) and len(junk & kept) <= 0.1 * len(junk)


def test_rows_without_an_id_stay(spark, world):
    sf_dir, _, _ = world
    docs = spark.createDataFrame([(None, "no id here", "en", "s", 10), (1, "some text of one", "en", "s", 16), (2, "some text of one", "en", "s", 16)], "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (cp.repeated_lines, cp.near_duplicate_removal, cp.benchmark_removal):
        assert None in {r["doc_id"] for r in stage(spark, docs, sf_dir).collect()}, stage
    assert {r["doc_id"] for r in cp.packing(spark, docs, sf_dir).collect()} == {None, 1, 2}
    empty = docs.limit(0)
    assert [f(spark, empty, sf_dir).count() for _, f in cp.STAGES] == [0, 0, 0, 0, 0]
    assert None in {r["doc_id"] for r in cp.quality_filter(spark, docs, sf_dir).collect()}


def test_run(spark, world):
    sf_dir, rows, _ = world
    out = cp.run(spark, sf_dir).toPandas()
    assert 0 < out["doc_id"].nunique() < len(rows)
    assert out.groupby("sequence_id")["length"].sum().max() <= 2048


def test_names():
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]


def test_rows_without_an_id_that_hold_an_item_go(spark, tmp_path):
    item = " ".join(f"item{k}" for k in range(60))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, item, "en", "s", 1), (None, "a clean text", "en", "s", 1), (None, None, "en", "s", 1), (1, item, "en", "s", 1), (2, "another text", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = cp.benchmark_removal(spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left) == [(0, ""), (0, "a clean text"), (2, "another text")]
