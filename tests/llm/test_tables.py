"""Operators over small tables with nulls, empty and long texts, repeated rows and clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare, connect
from skylarder.llm import ORACLES, best_fit, compact_windows, exact_dedup, html_templates, learned_partitions, log_bilinear, order_minhash, piece_codec, token_scan, toxicity

SCHEMA = "doc_id long, text string, n int, `group` string, id long, a string"


def odd_rows():
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(6000))
    near = long.split()
    near[50] = "other"
    rows = [(1, None), (2, ""), (3, "one"), (4, "one"), (4, "one"), (5, long), (6, " ".join(near)), (7, "x " + long[:900]), (None, "one"), (8, "idiot talk"), (9, " \n ")]
    return [(i, t, 0, "g", 7, None) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_groups_equal_sql(spark, small_tables):
    assert "op1_exact_dedup" in ORACLES
    assert compare(spark, connect(small_tables), "op1_exact_dedup", small_tables) is None


def test_exact_dedup_survives_collisions(docs, none):
    weak = lambda text: F.unhex(F.substring(F.md5(text), 1, 1))
    good, bad = (sorted(map(str, exact_dedup.exact_groups(docs, hash_fn=h).collect())) for h in (exact_dedup.content_hash, lambda t: F.unhex(F.lit("00"))))
    assert good == bad == sorted(map(str, exact_dedup.exact_groups(docs, hash_fn=weak).collect()))
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 7, 8, 9]
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


def test_packing_places_every_token_once(docs, none):
    got = best_fit.pack(best_fit.cut(docs)).toPandas()
    assert len(got[got.doc_id.isin([1, 2, 9])]) == 3 and (got[got.doc_id.isin([1, 2, 9])].length == 1).all()
    assert len(got[got.doc_id == 5]) > 1 and got.length.max() == 4096
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == g.length.cumsum().shift(fill_value=0).to_numpy()).all() and g.length.sum() <= 4096
    assert best_fit.pack(best_fit.cut(none)).count() == 0


def test_near_groups(docs, none):
    got = {r.doc_id: r.group_id for r in order_minhash.groups(docs).collect() if r.doc_id}
    assert got == {1: 1, 2: 1, 9: 9, 3: 3, 4: 3, 5: 5, 6: 5, 7: 7, 8: 8}
    assert order_minhash.groups(none).count() == 0


def test_repeats_and_their_removal(docs, none):
    cut = {(r.doc_id, r.first_id, r.kept) for r in compact_windows.repeats(docs).collect()}
    assert {(6, 5, False), (7, 5, False), (5, 5, True)} <= cut and not {d for d, _, _ in cut} - {5, 6, 7}
    left = compact_windows.drop_repeats(docs)
    texts = {r.doc_id: r.text for r in left.collect() if r.doc_id}
    assert left.columns == docs.columns and texts[7].startswith("x") and len(texts[7]) < 60 and texts[3] == "one"
    assert compact_windows.repeats(none).count() == 0


def test_toxicity_learns_and_scores_every_row(spark, docs, none):
    rows = [(i, "you idiot " + "word " * (i % 7) if i % 4 == 0 else "fine words here " * (i % 5), 0, "", 1, "") for i in range(200)]
    corpus = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(corpus, labels)
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    assert got[8] > 0.5 and got[1] < 0.5 and got[5] < 0.5
    got = toxicity.scores(corpus, labels).toPandas()
    assert ((got.predicted == 1) == (got.doc_id % 4 == 0)).all() and 20 < got.held_out.sum() < 60
    assert toxicity.scores(none, labels).count() == 0


def test_language_model_scores(docs, none):
    got = log_bilinear.scores(docs).toPandas()
    assert len(got) == docs.count() and got.score.notna().all()
    assert (got[got.doc_id == 1].n_tokens == 1).all() and log_bilinear.scores(none).count() == 0


def test_token_files_and_block_boundaries(spark, docs, none):
    want = sorted((r.doc_id or 0, r.n_tokens) for r in token_scan.counts(docs).collect())
    own = token_scan.encoder(ordinary=True)
    assert want == sorted((r.doc_id or 0, len(own.encode([r.text or ""])[0])) for r in docs.collect())
    assert token_scan.counts(none).count() == 0


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_scan_stitches_blocks(spark, tmp_path, block):
    import numpy as np

    ids = np.array([5, 6, 9, 9, 1, 2, 3, 9, 4], "<u2")
    (tmp_path / "t.bin").write_bytes(ids.tobytes())
    files = spark.createDataFrame([(str(tmp_path / "t.bin"), ids.nbytes)], "file string, length long")
    got = sorted((r.place, r.start, r.n_tokens, r.closed) for r in token_scan.scan(files, end_id=9, block=block).collect())
    assert got == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 3, True), (3, 8, 1, False)]


def test_pieces_round_trip(docs, none):
    assert all(r.round_trip for r in piece_codec.summary(docs).collect()) and piece_codec.summary(none).count() == 0
    assert piece_codec.encode(docs).where("size(ids) = 0").count() == 2


def test_pages(spark):
    rows = [(i, "http://h.org/x", f"<html><body><nav>menu</nav><article><p>t{i}&amp;</article><footer>f</footer>") for i in range(6)]
    rows += [(None, None, None), (9, "odd", ""), (10, "http://h.org/", "<html><body><nav>menu</nav>")]
    got = {r.page_id: r.text for r in html_templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"t{i}&" for i in range(6)} | {None: "", 9: "", 10: ""}


def test_nearest_with_unusable_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    rows += [(100, None), (120, []), (140, [0.0] * 6), (160, [float("nan")] * 6), (180, [None] * 6), (None, [1.0] * 6), rows[0]]
    got = learned_partitions.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).toPandas()
    assert set(got.query_id) == {0, 20, 40} and (got.groupby("query_id").size() == 20).all() and got.vec_id.max() < 60


def test_pipeline_stages_keep_columns(spark, small_tables):
    docs = spark.read.parquet(f"{small_tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        out = stage(spark, docs, small_tables)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
