"""Cases in which an operator once did less than the whole job."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylarder.llm import compact_windows, order_minhash, piece_codec, toxicity

from test_pure import brute_segmentation


def words(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def test_passages_around_a_common_line_are_all_found(spark):
    rng = random.Random(11)
    line = words(rng, 44)
    texts = [words(rng, 20) + line + words(rng, 20)]
    group_of = [None]
    for g in range(30):
        before, after = words(rng, 3), words(rng, 3)
        for _ in range(3):
            texts.append(words(rng, 20) + before + line + after + words(rng, 20))
            group_of.append(g)
    order = [0] + rng.sample(range(1, len(texts)), len(texts) - 1)
    rows = [(k, " ".join(texts[i])) for k, i in enumerate(order)]
    got = {r.doc_id: r.n_words for r in compact_windows.repeats(spark.createDataFrame(rows, "doc_id long, text string")).where("NOT kept").collect()}
    seen, want = {None}, set()
    for k, i in enumerate(order):
        if group_of[i] in seen and i:
            want.add(k)
        seen.add(group_of[i])
    assert set(got) == want and min(got.values()) >= 50


def test_no_link_that_a_bucket_holds_is_left_out(spark, monkeypatch):
    # one bucket for all: the centre's family C, A and the member X that only A comes near
    monkeypatch.setattr(order_minhash, "sketches", one_bucket)
    rng = random.Random(12)
    c = words(rng, 300)
    a = c[:-30] + words(rng, 30)
    x = words(rng, 28) + a[28:]
    far = words(rng, 300)
    rows = [(1, " ".join(c)), (2, " ".join(a)), (3, " ".join(x)), (4, " ".join(far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = order_minhash.WordHashes()
    grams = [order_minhash.shingles(hashes(t)) for t in (c, a, x)]
    assert order_minhash.similarity(grams[0], grams[1]) >= 0.8 and order_minhash.similarity(grams[1], grams[2]) >= 0.8
    assert order_minhash.similarity(grams[0], grams[2]) < 0.8
    got = {r.doc_id: r.group_id for r in order_minhash.groups(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def one_bucket(docs):
    return docs.select("id", F.xxhash64("text").alias("k1"), F.lit(0).cast("long").alias("k2"), F.array(F.lit(9).cast("long")).alias("buckets"))


def test_bound_of_similarity_holds():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a, b = (np.delete(np.tile(np.arange(40), 2), rng.integers(0, 80, rng.integers(1, 30))) for _ in range(2))
        assert order_minhash.similarity(a, b, 0.01) <= order_minhash.most_similar(a, b) + 1e-12


def drifting_texts(rng):
    """Families that drift by a few words a step, texts around a common line, short and repetitive ones."""
    line = words(rng, 18)
    texts = [line + words(rng, rng.randint(1, 12)) for _ in range(40)]
    for _ in range(6):
        now = words(rng, rng.randint(40, 160)) + line
        for _ in range(8):
            texts.append(now)
            now = list(now)
            for _ in range(rng.randint(1, 3)):
                now[rng.randrange(len(now))] = words(rng, 1)[0]
    for _ in range(12):
        texts.append(rng.choices(["a", "b", "c"], k=rng.randint(5, 40)))
    texts += [line * 3, line * 3 + ["end"], [*line, "x"], ["x", *line], line]
    rng.shuffle(texts)
    return texts


def brute_groups(texts):
    """The smallest place of each text's group, from all pairs."""
    hashes = order_minhash.WordHashes()
    grams = [order_minhash.shingles(hashes(t)) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if order_minhash.similarity(grams[i], grams[j]) >= 0.8 - 1e-12 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return dict(enumerate(label))


@pytest.mark.parametrize("crowded", [True, False])
def test_groups_equal_all_pairs(spark, monkeypatch, crowded):
    if crowded:
        monkeypatch.setattr(order_minhash, "sketches", one_bucket)
    texts = drifting_texts(random.Random(18))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in order_minhash.groups(docs).collect()}
    want = brute_groups(texts)
    assert len(set(want.values())) < len(texts) - 30 and got == want


def test_second_copy_in_one_document_is_cut(spark):
    rng = random.Random(13)
    passage = words(rng, 60)
    rows = [(1, " ".join(words(rng, 30) + passage + words(rng, 30))), (2, " ".join(words(rng, 30) + passage + words(rng, 70) + passage + words(rng, 5)))]
    got = compact_windows.repeats(spark.createDataFrame(rows, "doc_id long, text string")).where("NOT kept").collect()
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in got) == [(2, 30, 90), (2, 160, 220)]


def test_passages_at_the_threshold_share_a_key():
    rng, lost = np.random.default_rng(14), 0
    for _ in range(1000):
        a = rng.integers(0, 1 << 63, 46, dtype=np.uint64)
        b, at = a.copy(), rng.integers(0, 42)
        b[at : at + 5] = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
        lost += not set(zip(*compact_windows.keys_of(a, 46))) & set(zip(*compact_windows.keys_of(b, 46)))
    assert lost <= 10


@pytest.mark.parametrize("window", [1, 7, 50, 1 << 14])
def test_long_words_have_the_best_segmentation(monkeypatch, window):
    monkeypatch.setattr(piece_codec, "WINDOW", window)
    codec, rng = piece_codec.codec(), random.Random(15)
    for letters in ("theandofinrst", "中文字的一是不", "aé/.=&%?0123🙂"):
        word = "".join(rng.choices(letters, k=301))
        whole = piece_codec.SPACE + word
        got = codec.encode([word])[0]
        one = codec.viterbi(np.array([[ord(c) for c in whole]], np.uint32))[0]
        assert got.tolist() == one.tolist() and codec.decode(got) == word
        assert len(got) == brute_segmentation(codec, whole)[1]


def test_hidden_words_are_found_in_long_words_and_spaced_runs():
    text = ("idiot stupid worthless trash scum moron clown you such a the of and or there " * 30)
    reader = toxicity.Reader(toxicity.costs_of(toxicity.count_trigrams([text])), {"idiot": 0, "moron": 1})
    assert reader.of_text("such a m o r o n") == {1} and reader.of_text("y o u i d i o t") == {0}
    assert reader.of_text("i" + "d" * 60 + "iot") == {0} and reader.of_text("i-d-i-o-t".replace("-", "-" * 15)) == {0}
    assert reader.of_text("there" * 9 + "1d10t" + "there" * 9) == {0}
    assert reader.of_text("t h e r e") == set() and reader.of_text("there" * 20) == set()


def test_rows_of_one_id_are_cut_by_their_own_stretches(spark):
    rng = random.Random(16)
    passage, other = words(rng, 70), words(rng, 200)
    rows = [(1, " ".join(words(rng, 20) + passage)), (2, " ".join(passage + words(rng, 40))), (2, " ".join(other)), (3, " ".join(other)), (3, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted((r.doc_id, len(r.text.split())) for r in compact_windows.drop_repeats(docs).collect())
    assert left == [(1, 90), (2, 40), (2, 200)]
    cut = {(r.doc_id, r.first_id, r.n_words) for r in compact_windows.repeats(docs).where("NOT kept").collect()}
    assert cut == {(2, 1, 70), (3, 2, 200)}


def test_every_repeated_run_is_covered(spark):
    """All runs of 50 words that an earlier text holds, by brute force over a corpus of pasted passages."""
    rng = random.Random(17)
    pool = [words(rng, rng.randint(30, 90)) for _ in range(12)]
    texts = [sum((rng.choice(pool) if rng.random() < 0.5 else words(rng, rng.randint(1, 60)) for _ in range(rng.randint(1, 6))), []) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    spans = {}
    for r in compact_windows.repeats(docs).where("NOT kept").collect():
        spans.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    seen, missed, n = set(), 0, 0
    for i, t in enumerate(texts):
        runs = [tuple(t[k : k + 50]) for k in range(len(t) - 49)]
        for k, run in enumerate(runs):
            if run in seen:
                n += 1
                missed += not any(a <= k and k + 50 <= b for a, b in spans.get(i, []))
        seen.update(runs)
    assert n > 500 and missed == 0
