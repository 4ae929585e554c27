"""Whole work where a bound on size once cut it."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pandas as pd

import corpus_pipeline
from skylarder.llm import compact_windows, html_templates, log_bilinear, toxicity


def test_template_counts_every_token_of_a_wide_page(spark):
    """The article comes after more than 20,000 texts that differ from page to page."""
    page = "<html><body><div class=long>{}</div><article><p>Story {}</article></body></html>"
    rows = [(k, "http://wide.org/", page.format("".join(f"<p>w{i}x{k}" for i in range(20_100)), k)) for k in range(4)]
    got = html_templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {k: f"Story {k}" for k in range(4)}


def test_deep_pages_give_all_tokens_of_bounded_length():
    page = "<html><body>" + "<div>" * 30_000 + "<article><p>Deep</article>" + "</div>" * 30_000
    tokens = html_templates.page_tokens(page)
    assert len(tokens) > 30_000 and tokens["token"].map(len).max() < 1100
    rows = tokens.assign(low=0, high=0, pages=4, host_pages=4, least=tokens["times"], most=tokens["times"])
    template = html_templates.deduce_template(rows[rows["token"] != ""])
    assert template["main"].endswith("/article")
    assert html_templates.main_text(page, template) == "Deep"
    assert html_templates.main_text(page, {"main": "/html/body", "drop": []}) == "Deep"


def _deduced_plainly(tokens: pd.DataFrame) -> list[str]:
    """Classes in order, by all pairs of paths; then the named slot with the most letters below it."""
    slots = []
    for _, members in tokens.groupby(["low", "high", "pages"]):
        place = dict(zip(members["token"], members["place"]))
        if all(place[p] <= place[q] for p in place for q in place if q.startswith(f"{p}/")):
            slots += list(members[["token", "letters"]].itertuples(index=False))
    named = [t for t, _ in slots if t.endswith("/article")]
    return max(((sum(n for t, n in slots if f"{t}/".startswith(f"{m}/")), m) for m in named), default=(0, ""))[1]


def test_nesting_in_one_walk_equals_all_pairs():
    rng = random.Random(5)
    for _ in range(200):
        paths = {"/html"}
        for _ in range(30):
            paths.add(f"{rng.choice(sorted(paths))}/{rng.choice(['div', 'article', 'section'])}")
        rows = [(p, rng.randint(0, 9) + 3 * p.count("/"), rng.randint(0, 50), rng.randint(0, 6)) for p in sorted(paths)]
        tokens = pd.DataFrame(rows, columns=["token", "place", "letters", "low"])
        tokens = tokens.assign(high=0, pages=2, barred=False, least=1, most=1, host_pages=2, outer=None)
        want = _deduced_plainly(tokens)
        if want:
            assert html_templates.deduce_template(tokens)["main"] == want


def test_training_meets_every_trigram_with_its_count():
    """A target of one trigram among a million, which draws by count and the noise both miss."""
    size, rare = log_bilinear.CLASSES, 7
    cells = np.array([5, rare, size * 9 + 5], np.int64)
    n = np.array([10**6, 1, 10**4])
    share = np.full(size, 1.0)
    share[rare] = 1e-4
    share /= share.sum()
    start = log_bilinear.Parameters.start(share)
    done = log_bilinear.train_shard(start, cells, n, share, 0.03, 20, 1)
    assert (done.target[rare] != start.target[rare].astype(np.float32)).any()
    assert np.isfinite(done.flat()).all()


def test_visits_weigh_each_count_exactly():
    n = np.concatenate([[10**12], np.arange(1, 5000)])
    which, weights = log_bilinear.visits(n, 3)
    got = np.bincount(which, weights, len(n))
    assert np.allclose(got, n * (3 * log_bilinear.BATCH / n.sum()), rtol=1e-9) and (got > 0).all()
    assert weights.max() <= 1 and len(which) <= 3 * log_bilinear.BATCH + len(n)


def test_pipeline_hands_tasks_few_texts_at_a_time(spark, small_tables, monkeypatch):
    def largest_batch(spark, docs, sf_dir):
        many = docs.select("doc_id").crossJoin(spark.range(100)).coalesce(1)
        return many.select("doc_id").mapInPandas(lambda batches: (b.assign(rows=len(b))[:1] for b in batches), "doc_id long, rows long")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("rows", largest_batch)])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert corpus_pipeline.run(spark, small_tables).agg({"rows": "max"}).first()[0] <= corpus_pipeline.TASK_ROWS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_trigrams_are_counted_in_bounded_memory():
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcé ß.漢", k=rng.randint(0, 4000))) for _ in range(500)] + ["", "x" * 300_000]
    parts = list(toxicity.runs_of(texts, toxicity.COUNTED))
    assert [t for p in parts for t in p] == texts and max(sum(map(len, p)) for p in parts if len(p) > 1) <= toxicity.COUNTED
    tracemalloc.start()
    got = sum(toxicity.count_trigrams(p) for p in parts[:-1])
    assert tracemalloc.get_traced_memory()[1] < 16 << 20
    tracemalloc.stop()
    assert (got + toxicity.count_trigrams(parts[-1]) == toxicity.count_trigrams(texts)).all()


def test_passages_aligned_in_slices_are_the_same(spark, monkeypatch):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    shared = [words(70) for _ in range(6)]
    rows = [(k, " ".join(words(30) + shared[k % 6] + words(20))) for k in range(24)] + [(100 + k, " ".join(words(90))) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(compact_windows.repeats(docs).collect())
    monkeypatch.setattr(compact_windows, "SLICE_PAIRS", 1)
    asked, only = [], compact_windows.only
    monkeypatch.setattr(compact_windows, "only", lambda texts, ids: asked.append({r.id for r in ids.collect()}) or only(texts, ids))
    assert sorted(compact_windows.repeats(docs).collect()) == whole and sum(not r.kept for r in whole) == 18
    # the 30 texts without a passage are never shuffled, and no slice has all pairs
    assert len(set().union(*asked)) <= 24 and all(len(ids) < 24 for ids in asked) and len(asked) >= 2 * compact_windows.SLICES


def test_texts_are_cut_once_in_one_worker_a_task(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text), (2, text), (3, f"{text} more words")], "doc_id long, text string")
    left = compact_windows.drop_repeats(docs)
    assert left._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, text), (3, " more words")]
