"""What keeps disk, memory and comparisons of the dedup stages from growing faster than their input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylarder.llm import compact_windows as cw
from skylarder.llm import exact_dedup, hot, order_minhash


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("sent", [0, 1 << 19])
def test_lone_texts_stay_where_they_are(spark, monkeypatch, sent):
    monkeypatch.setattr(exact_dedup, "SENT_HASHES", sent)
    rows = [(1, "a"), (2, "a"), (None, "a"), (None, "b"), (None, "b"), (3, None), (4, ""), (5, "c"), (5, "c"), (6, "d"), (6, "e"), (None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("of.it", F.lit(1))
    wanted = {(1, "a"), (None, "b"), (3, None), (5, "c"), (6, "d"), (6, "e"), (None, "f")}
    for hash_fn in (exact_dedup.content_hash, lambda t: F.length(t)):
        kept = exact_dedup.drop_copies(docs, hash_fn=hash_fn)
        found = [tuple(r)[:2] for r in kept.collect()]
        assert len(found) == len(wanted) and set(found) == wanted and kept.columns == docs.columns
    # rows whose hash nobody else has pass by an anti-join alone
    assert "LeftAnti" in plan_of(kept)


def test_hot_keys_are_told_by_a_list(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("k"), "id")
    groups = rows.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    for how, wanted in (("inner", 3600), ("left", 4000)):
        met = hot.join_counted(rows, groups, "k", "n", how)
        assert met.count() == wanted and "LeftAnti" not in plan_of(met)
    assert hot.join_counted(rows.where("k <> 'hot'"), groups.where("n > 1"), "k", "n").count() == 0


def test_common_lines_give_a_long_region_no_place():
    """Lines too short for a passage, many in one region: the shared shingles of all windows together were taken before."""
    rng, need = np.random.default_rng(3), cw.needed(46)
    grams, n = rng.integers(1, 1 << 60, 600).astype(np.uint64), np.ones(600, np.int64)
    for at in range(0, 600, 75):
        n[at : at + 35] = 5000
    assert len(cw.rare_places(n, grams, need, cw.SPARE)) == 0
    n[300:346] = 7
    assert set(cw.rare_places(n, grams, need, cw.SPARE)) & set(range(300, 346))


def test_passages_with_one_break_share_a_rare_place():
    rng, need = np.random.default_rng(4), cw.needed(46)
    for _ in range(300):
        common = rng.integers(1, 1 << 60, need).astype(np.uint64)
        often = dict(zip(common.tolist(), rng.integers(2, 6, need).tolist()))
        cut, sides = int(rng.integers(0, need)), []
        for gap in (int(x) for x in rng.integers(0, 11, 2)):
            own = lambda k: rng.integers(1, 1 << 60, k).astype(np.uint64)
            others = own(200)
            often |= dict(zip(others.tolist(), rng.integers(1, 9, 200).tolist()))
            before = int(rng.integers(0, 100))
            grams = np.concatenate([others[:before], common[:cut], others[100 : 100 + gap], common[cut:], others[120:]])
            places = cw.rare_places(np.array([often[g] for g in grams.tolist()]), grams, need, cw.SPARE)
            sides.append(set(grams[places].tolist()) & set(common.tolist()))
        assert sides[0] & sides[1]


def test_a_repeated_word_gives_few_places():
    grams, need = np.repeat(np.arange(1, 4, dtype=np.uint64), 200), cw.needed(46)
    assert len(cw.rare_places(np.full(600, 9), grams, need, cw.SPARE)) == 3


def test_stretches_dense_in_shared_shingles_by_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        sizes = rng.integers(0, 100, 4)
        has, wanted = [rng.random(n) < 0.88 for n in sizes], []
        for own in has:
            can = np.zeros(len(own), bool)
            for lo in range(len(own)):
                for hi in range(lo + 20, len(own) + 1):
                    can[lo:hi] |= 9 * own[lo:hi].sum() >= 8 * (hi - lo)
            wanted.append(can)
        got = cw.dense(np.concatenate(has), np.repeat(np.arange(4), sizes), 20)
        assert (got == np.concatenate(wanted)).all()


def test_a_passage_lies_in_a_dense_stretch_of_one_text():
    rng, met = np.random.default_rng(6), 0
    for _ in range(200):
        base = rng.integers(1, 1 << 32, 150)
        a, b = (np.where(rng.random(150) < rng.choice([0.02, 0.1]), rng.integers(1, 1 << 32, 150), base).astype("<u4") for _ in range(2))
        a, b = np.delete(a, rng.integers(0, 150, 2)), np.delete(b, rng.integers(0, 150, 3))
        text = [np.zeros(len(x), np.int64) for x in (a, b)]
        sides = [cw.dense(cw.maybe_held(x, t, y, u), t, 46) for x, t, y, u in ((a, text[0], b, text[1]), (b, text[1], a, text[0]))]
        _, i, j = np.intersect1d(a, b, return_indices=True)
        for p, q in zip(i.tolist(), j.tolist()):
            if cw.passage(a, b, p, q, 46):
                met += 1
                assert sides[0][p] or sides[1][q]
    assert met > 1000


def test_a_drifting_family_meets_few_leaders(spark, monkeypatch):
    """Each text has passages with some others only; leaders, drawn anew under each key, met the whole family before."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 10**9, 120)
    texts = [" ".join(f"w{w}" for w in np.where(rng.random(120) < 0.04, rng.integers(0, 10**9, 120), base)) for _ in range(80)]
    pairs, align = [], cw.align
    monkeypatch.setattr(cw, "align", lambda some, *more: pairs.append(some.count()) or align(some, *more))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = cw.repeats(docs).where("NOT kept").collect()
    assert len({r.doc_id for r in got}) > 55 and len(pairs) > 3
    # the texts that the first round of leaders settles don't meet the whole family
    assert pairs[2] < 600 and sum(pairs) < 4200


def test_near_copies_go_to_python_few_at_a_time(spark, monkeypatch):
    conf, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    stage = order_minhash.sketches
    monkeypatch.setattr(order_minhash, "sketches", lambda rows: seen.append(int(spark.conf.get(conf))) or stage(rows))
    before = spark.conf.get(conf)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert {r.group_id for r in order_minhash.groups(docs).collect()} == {1}
    assert seen == [500] and spark.conf.get(conf) == before
