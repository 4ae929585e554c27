"""Filter audit, reversed search and line dedup against brute force, with awkward tables."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from check import compare, connect
from skylarder.llm import filter_audit, hot, item_search, line_dedup

SCHEMA = "doc_id long, text string, lang string, score int, part string, `id` string, line string, `key` int"
LINE = "A line that many of the documents hold"


def rows_of(texts):
    return [(i, t, lang, 0, "p", "x", None, None) for i, t, lang in texts]


def odd_texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)] + ["The", "of", "ÉTÉ", "中文", "a$b", " x", "\x1cy"]
    rows = [(1, None, None), (2, "", "en"), (3, "one", "en"), (3, "one", "en"), (4, "one", "de"), (None, "one", "en"), (None, LINE, None), (5, " \n\t", "")]
    for i in range(10, 70):
        lines = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(rng.randint(1, 8))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), rng.choice([LINE, "  " + LINE.upper() + "\r", LINE + "\t"]))
        rows.append((i, "\n".join(lines + ["", lines[0]]), rng.choice(["en", "de", None])))
    rows += [(200, "ABC " * 40_000, "fr"), (201, rows[20][1], "fr"), (12, rows[12][1] + "\nmore", "de"), (202, (LINE + "\n") * 3000, "en")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(odd_texts()), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_item_search", "op13_line_dedup"])
def test_equals_sql(spark, small_tables, name):
    assert compare(spark, connect(small_tables), name, small_tables) is None


# ---- lines


def brute_lines(rows, least_docs=3):
    def key(line):
        bare = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in bare)

    held = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20 and i is not None:
                held.setdefault(key(line), set()).add(i)
    common = {k: max(ids) for k, ids in held.items() if len(ids) >= least_docs}
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if common.get(key(x), i) == i and (i is not None or key(x) not in common)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines_equal_brute_force(docs, none):
    want = brute_lines(odd_texts())
    got = [tuple(r) for r in line_dedup.report(docs).collect()]
    digest = [(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in want]
    assert sorted(got, key=str) == sorted(digest, key=str)
    left = line_dedup.drop_common_lines(docs)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    texts = sorted((str(r.doc_id), r.text or "") for r in left.collect())
    assert texts == sorted((str(i), t) for i, _, _, t in want)
    assert left.where("text IS NULL").count() == 1  # an untouched null stays
    assert line_dedup.report(none).count() == 0 and line_dedup.drop_common_lines(none).count() == 0


def test_last_holder_keeps_every_line_of_the_key(spark):
    rows = [(1, LINE), (2, LINE + "\nx\n" + LINE), (3, LINE + "\n" + LINE), (4, "short\nshort"), (5, "short"), (6, "short")]
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1), 2: (3, 2), 3: (2, 0), 4: (2, 0), 5: (1, 0), 6: (1, 0)}


def test_keys_fold_ascii_only(spark):
    lines = ["  ÉTÉ Straße İ A-Z here now \r", " padded with no-break space ", "plain ASCII line of some length\x0b"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(line_dedup.line_key(F.col("line"))).collect()]
    assert got == ["ÉtÉ straße İ a-z here now", lines[1], "plain ascii line of some length"]


def test_hot_keys_join_without_a_shuffle_of_their_rows(spark, tmp_path):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"))
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    groups.write.parquet(f"{tmp_path}/groups")
    groups = spark.read.parquet(f"{tmp_path}/groups").where("k % 2 <> 0")
    inner = hot.join_counted(rows, groups, "k", "n")
    assert inner.count() == rows.where("k % 2 <> 0").count()
    assert inner.where("k = -1 AND n = 6667").count() == 6667
    assert hot.join_counted(rows, groups, "k", "n", "left").count() == 20_000


# ---- filters


def brute_audit(rows, labels):
    def fails(i, text):
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        smallest = min((j for j, t, _ in rows if (t or "") == text and j is not None), default=None)
        return {
            f
            for f, is_so in zip(
                "ABCDE",
                (
                    len(words) < 200,
                    100 * len(set(words)) < 50 * len(words),
                    100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
                    bool(set(text) & set("#$%&*|")),
                    i is not None and i > smallest,
                ),
            )
            if is_so
        }

    marked = [(lang or "", fails(i, t), labels.get(i, (0, 0)) if i is not None else (0, 0)) for i, t, lang in rows]
    out = {}
    for part in {p for p, *_ in marked}:
        own = [(f, said) for p, f, said in marked if p == part]
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order):
                before = set(order[:step])
                removed = [said for f, said in own if letter in f and not f & before]
                out[part, order, step + 1] = [
                    sum(not f & (before | {letter}) for f, _ in own),
                    len(removed),
                    sum(letter in f and bool(f & before) for f, _ in own),
                    sum(f == {letter} for f, _ in own),
                    sum(q for q, _ in removed),
                    sum(t for _, t in removed),
                ]
    for (part, order, step), row in out.items():
        row.append(sum(r[1] for (p, o, s), r in out.items() if p == part and o[s - 1] == order[step - 1]))
    return out


@pytest.mark.parametrize("size", [1, 7, 8192])
def test_audit_equals_brute_force(spark, docs, none, size):
    labels = [(1, 1, 0), (3, 0, 1), (10, 1, 1), (11, 1, None), (11, None, 1), (12, 0, 0), (200, 1, 1), (201, 1, 0), (None, 1, 1), (999, 1, 1)]
    said = {}
    for i, q, t in labels:
        was = said.get(i, (0, 0))
        said[i] = (max(was[0], q or 0), max(was[1], t or 0))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in filter_audit.audit(docs, table, size).collect()}
    assert got == brute_audit(odd_texts(), said)
    if size == 7:
        assert filter_audit.audit(none, table).count() == 0


def test_posting_lists_hold_each_document_once(spark, docs):
    labels = spark.createDataFrame([(10, 1, 1)], "doc_id long, quality int, toxic int")
    lists = filter_audit.posting_lists(filter_audit.marks(docs, labels), 16).collect()
    ids = Counter(i for r in lists for i in r.ids)
    assert ids == Counter(i for i, *_ in odd_texts()) and all(r.n_docs == len(r.ids) <= 16 for r in lists)
    assert [i for r in lists for k in r.good for i in [r.ids[k]]] == [10]
    assert all(list(r.fails_A) == sorted(set(r.fails_A)) for r in lists)


def test_galloping_merges():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(2))
        assert filter_audit.minus(a, b).tolist() == np.setdiff1d(a, b).tolist()
        assert filter_audit.union(a, b).tolist() == np.union1d(a, b).tolist()


# ---- search

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return _TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(rows, items, top=10):
    docs = [(i, Counter(terms(t))) for i, t, *_ in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in docs:
            m = 10 + 90 * c.total() * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) & c.keys())
            if s:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:top])]
    return out


ITEMS = [(1, "The of w1 w2 ÉTÉ été"), (2, None), (3, ""), (4, "abc ABC a b $"), (5, "W7, w8; w9 中文 " * 3), (5, "one"), (None, "one w3"), (6, "nowhere")]


@pytest.mark.parametrize("block,cells,exact", [(8 << 20, 1 << 20, 200_000), (150, 16, 2)])
def test_search_equals_brute_force(spark, docs, none, monkeypatch, block, cells, exact):
    monkeypatch.setattr(item_search, "SLICE", 64)
    items = spark.createDataFrame([(i, t, 0, "r") for i, t in ITEMS], "item_id long, text string, item int, `rank` string")
    monkeypatch.setattr(item_search, "CELLS", cells)
    monkeypatch.setattr(item_search, "EXACT_TERMS", exact)
    got = [tuple(r) for r in item_search.search(docs, items, block_bytes=block).collect()]
    assert sorted(got, key=str) == sorted(brute_search(odd_texts(), ITEMS), key=str)
    if cells == 16:
        assert item_search.search(none, items).count() == 0
        assert item_search.search(docs, items.limit(0)).count() == 0


def test_scores_in_slices_are_the_same(monkeypatch):
    rng = random.Random(9)
    index = item_search.ItemIndex([" ".join(f"w{rng.randrange(50)}" for _ in range(30)) for _ in range(7)])
    counts = [Counter(b"w%d" % rng.randrange(60) for _ in range(rng.randint(0, 80))) for _ in range(9)]
    index.weigh(9, sum(c.total() for c in counts), {k: 1 + k % 4 for k in range(len(index.vocabulary))})
    whole = index.scores(counts)
    monkeypatch.setattr(item_search, "EXACT_TERMS", 3)
    assert (index.scores(counts) == whole).all() and whole.any()


def test_heaps_keep_ties_by_smaller_id():
    heaps = item_search.Heaps(1, 2)
    for ids, scores in (([9, 4], [5, 5]), ([3], [5]), ([1, 2], [4, 0]), ([8], [7])):
        heaps.add(np.array(ids), np.zeros(len(ids), bool), np.array(scores)[:, None])
    assert list(zip(heaps.id.tolist(), heaps.score.tolist())) == [(8, 7), (3, 5)]
