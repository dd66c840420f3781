"""Each query over whole tables against its contract computed plainly, or its SQL."""

import os
import sys
import zlib

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from compare import compare, duck  # noqa: E402

from weirstone.llm import queries as q  # noqa: E402

FOLDER = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")


def given(name, *columns):
    found = pq.read_table(f"{FOLDER}/{name}.parquet", columns=list(columns)).to_pydict()
    return list(zip(*(found[c] for c in columns)))


@pytest.mark.parametrize("name", list(q.ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(FOLDER), q.QUERIES[name], q.ORACLE[name], FOLDER) == []


def test_mix_reaches_its_targets_and_reruns_agree(spark):
    rows = q.op1_pareto_mix(spark, FOLDER).collect()
    assert sorted(rows) == sorted(q.op1_pareto_mix(spark, FOLDER).collect())
    texts = dict(given("documents", "doc_id", "text"))
    sources = dict(given("documents", "doc_id", "source"))
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert r.size == len(brute.words(texts[r.doc_id]))
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        s = sources[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
    assert len(rows) == len(texts)
    for s, value in brute.targets(sizes).items():
        assert target[s] == pytest.approx(value)
        assert taken[s] == pytest.approx(value, rel=0.04)  # forty documents a source
    assert all(r.source_size == sizes[sources[r.doc_id]] for r in rows)


def test_near_duplicates(spark):
    rows = [tuple(r)[:3] for r in q.op2_golay_simhash(spark, FOLDER).collect()]
    assert sorted(rows) == sorted(brute.near_duplicates(given("documents", "doc_id", "text")))


def test_pieces_equal_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=q.model_path())
    found = {r.doc_id: tuple(r)[1:] for r in q.op4_piece_codec(spark, FOLDER).collect()}
    for doc, text in given("documents", "doc_id", "text"):
        ids = model.encode(text or "", add_eos=True)
        assert found[doc] == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(model.decode(ids)))


def test_toxicity_on_held_out_labels(spark):
    found = {r.doc_id: r for r in q.op6_subword_toxicity(spark, FOLDER).collect()}
    assert len(found) == len(given("documents", "doc_id"))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in found.items())
    held = [(found[d].predicted, t) for d, t in given("labels", "doc_id", "toxic") if d in found and found[d].held_out]
    right = sum(p == t for p, t in held)
    hit = sum(p and t for p, t in held)
    assert right / len(held) >= 0.9
    assert hit >= 0.5 * sum(t for _, t in held)


def test_personal_data(spark):
    found = {r.doc_id: r for r in q.op7_disclosure(spark, FOLDER).collect()}
    for doc, text in given("documents", "doc_id", "text"):
        spans = brute.spans(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        r = found[doc]
        kinds = [k for k, _, _ in spans]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in ("email", "ip", "card", "phone")]
        assert r.base_sha256 == brute.sha(joined)
        assert r.spans == joined or r.spans.startswith(joined + "," if joined else "term:")


def test_articles_of_pages(spark):
    import html
    import re

    found = {r.page_id: r for r in q.op8_path_ratios(spark, FOLDER).collect()}
    for page, text in given("pages", "page_id", "html"):
        inner = re.search(r"<article>(.*?)(?:</article>|$)", text, re.S)[1]
        plain = re.sub(r"<[^>]*>?", lambda m: " " if re.match(r"</?(p|br|h1)\b", m[0]) else "", inner)
        assert found[page].text == " ".join(html.unescape(plain).split())
        assert found[page].n_chars == len(found[page].text)


def test_repeats(spark):
    rows = [tuple(r) for r in q.op9_recompression(spark, FOLDER).collect()]
    assert sorted(rows) == sorted(brute.without_repeats(given("documents", "doc_id", "text")))
    assert sum(r[2] for r in rows) > 0


def test_quality_rules(spark):
    found = {r.doc_id: tuple(r)[1:] for r in q.op10_char_perplexity(spark, FOLDER).collect()}
    good = dict(given("labels", "doc_id", "quality"))
    lost = kept_bad = bad = 0
    for doc, text in given("documents", "doc_id", "text"):
        n, chars, symbols, lines, repeats, failed, kept = found[doc]
        assert (n, chars, symbols, lines, repeats) == brute.base_counts(text)
        assert failed == (n < 10 or 100 * repeats > 20 * n)
        assert not (failed and kept)
        lost += good.get(doc) == 1 and not failed and not kept
        bad += good.get(doc) == 0
        kept_bad += good.get(doc) == 0 and kept
    assert lost <= 0.01 * len(found)
    assert kept_bad < bad / 2


def test_pipeline(spark):
    from corpus_pipeline import run

    rows = run(spark, FOLDER)
    assert rows.columns == ["doc_id", "source", "ids", "n_tokens", "round_trip"]
    toxic = {d for d, t in given("labels", "doc_id", "toxic") if t}
    found = rows.collect()
    assert found and all(r.round_trip and r.n_tokens == len(r.ids) for r in found)
    assert len({r.doc_id for r in found} & toxic) <= 0.3 * len(toxic)
