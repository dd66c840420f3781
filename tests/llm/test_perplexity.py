"""The perplexity model and its bands against a plain Kneser-Ney model."""

import os
import sys
from statistics import median

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from weirstone.llm import char_perplexity as module  # noqa: E402
from weirstone.llm import queries as q  # noqa: E402

FOLDER = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")
TEXTS = [
    (1, "en", "the cat sat on the mat, the rat ate the cat " * 3), (2, "en", "x"), (3, "en", "naïve 你好 \0\0 𝒳 end"), (4, "de", "das ist so\nund so"),
    (5, None, "the cat of no language"), (6, "", "the cat of no name"), (7, "en", None), (8, "de", ""), (9, "en", "x"), (10, "xx", None),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, lang string, text string, k1 int, surprise double").repartition(3)


def by_plain(rows):
    models = {lang: brute.KneserNey([t for _, own, t in rows if own == lang and t], module.ORDER) for lang in {r[1] for r in rows}}
    return {i: models[lang].surprise(t) if t else 0.0 for i, lang, t in rows}


@pytest.mark.parametrize("sizes", [(1 << 20, 64 << 20), (40, 16 * 30)])
def test_surprise_is_that_of_the_plain_model(spark, monkeypatch, sizes):
    """Also where texts are counted in pieces and the model goes to the tasks in several parts."""
    for name, size in zip(("PIECE", "MODEL_BYTES"), sizes):
        monkeypatch.setattr(module, name, size)
    found = {r.doc_id: r.surprise for r in module.document_facts(frame(spark, TEXTS)).collect()}
    assert found == pytest.approx(by_plain(TEXTS), rel=1e-9)


def test_the_plain_model_sums_to_one():
    model = brute.KneserNey([t for _, _, t in TEXTS if t], 3)
    letters = [*model.levels[0], "never seen"[0:0] + ""]
    for context in ("th", "\n\n", "zz", "e "):
        assert sum(model.probability(context + c) for c in letters) == pytest.approx(1)


def test_bands_of_whole_tables(spark):
    """Verdicts from the bits of all documents, and how much junk and clean text they keep in each language."""
    found = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "lang", "text"]).to_pylist()
    rows = {r.doc_id: r for r in module.judge(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()}
    assert len(rows) == len(found)
    bands = {}
    for lang in {d["lang"] for d in found}:
        bits = sorted(rows[d["doc_id"]].bits for d in found if d["lang"] == lang and not rows[d["doc_id"]].base_failed)
        middle = bits[(len(bits) - 1) // 2]
        bands[lang] = middle, 1.4826 * median(abs(b - middle) for b in bits)
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    count = {}
    for d in found:
        r, (middle, spread) = rows[d["doc_id"]], bands[d["lang"]]
        wide = module.BAND * spread + module.CHANCE / max(1, module.spoken(d["text"])) ** 0.5
        if abs(abs((r.bits or 0) - middle) - wide) > 0.02:  # the percentiles of the job are approximate
            assert r.kept == (not r.base_failed and r.bits is not None and abs(r.bits - middle) <= wide)
        if not r.base_failed and d["doc_id"] in labels:
            key = d["lang"], labels[d["doc_id"]]
            kept, all_of_them = count.get(key, (0, 0))
            count[key] = kept + r.kept, all_of_them + 1
    for (_, good), (kept, total) in count.items():
        assert kept >= 0.97 * total if good else kept < max(1, 0.5 * total)


def test_queries_and_operator_agree(spark):
    kept = {r.doc_id: r.kept for r in q.op10_char_perplexity(spark, FOLDER).collect()}
    assert kept == {r.doc_id: r.kept for r in module.judge(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()}


def test_signs_are_no_words():
    assert module.spoken("one | two ### three$$$ é !! 4 \n|\t|") == 5
    assert module.spoken(None) == module.spoken("") == module.spoken(" | ") == 0
