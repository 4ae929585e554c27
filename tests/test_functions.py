"""Scalar expressions against plain-Python models of the same rules."""

import random
import struct
from fractions import Fraction

from pyspark.sql import functions as F

from skylarder import functions as fn

WHITE_POOL = "  \t\x0b\x0c\x1c\x1f\x85\xa0  　\r"


def apply(spark, values, ddl, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    rows = df.select("i", build(F.col("v")).alias("out")).collect()
    return [r.out for r in sorted(rows, key=lambda r: r.i)]


def test_prep_time_rules(spark):
    """Minutes by hand: 20 to 39 by length, then what the kind of dish adds or saves."""
    table = {
        None: 30,
        "": 30,
        " ": 36,  # length 1: 21, other: +15
        "Tomato tarts": 47,  # 12: 32 + 15
        "Leek soup": 89,  # 9: 29 + 60
        "BEEF STEW": 89,
        "roast": 85,  # 5: 25 + 60
        "Bean casserole": 94,  # 14: 34 + 60
        "salad": 15,  # 5: 25 - 10
        "Club Sandwich": 23,  # 13: 33 - 10
        "pancakes": 18,  # 8: 28 - 10
        "soup salad": 90,  # 10: 30, slow goes first
        "x" * 19: 54,
        "x" * 20: 35,
        "x" * 40 + " soup": 85,
        "éé": 37,
    }
    assert apply(spark, list(table), "string", fn.prep_time) == list(table.values())


def test_prep_time_depends_on_length_and_kind_only(spark):
    names = [f"{'y' * n}{word}" for word in ("", "stew", "salad") for n in range(1, 60)]
    got = apply(spark, names, "string", fn.prep_time)
    longer = apply(spark, ["z" * 20 + n for n in names], "string", fn.prep_time)
    assert got == longer and {g % 5 for g in got} == set(range(5))


def test_clean_steps_rules(spark):
    table = {
        None: "",
        "": "",
        "\n": "",
        " \r\n ": "",
        "a\rb\nc": "a\rb; c",
        "mix\r\n\r\n  bake \n": "mix; bake",
        "\u3000cut\u3000\n\x85\nfry": "cut; fry",
        "a;b\nc": "a;b; c",
        "\n".join(map(str, range(30))): "0; 1; 2; 3; 4; 5; 6; 7; 8; 9",
        "\n \n".join("abcdefghijkl"): "a; b; c; d; e; f; g; h; i; j",
    }
    assert apply(spark, list(table), "string", fn.clean_steps) == list(table.values())


def test_clean_steps_leaves_no_blank_step_and_keeps_letters_in_order(spark):
    rng = random.Random(2)
    alphabet = list(WHITE_POOL) + ["\n", "\n", "\r\n", "a", "bc", "é", "日"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(800)]
    got = apply(spark, texts, "string", fn.clean_steps)
    for text, steps in zip(texts, got):
        parts = steps.split("; ") if steps else []
        assert len(parts) <= 10 and all(x and x[0] not in WHITE_POOL + "\n" and x[-1] not in WHITE_POOL + "\n" for x in parts)
        letters = "".join(c for c in text if c in "abcé日")
        assert letters.startswith("".join(c for c in steps if c in "abcé日"))
    assert apply(spark, [g.replace("; ", "\n") for g in got], "string", fn.clean_steps) == got


def test_clean_steps_keeps_long_blank_runs_linear(spark):
    text = "a" + " " * 200_000 + "b\n" + " " * 200_000 + "\nc" + " " * 200_000
    assert apply(spark, [text], "string", fn.clean_steps) == ["a" + " " * 200_000 + "b; c"]


def test_wide_pairs(spark):
    df = spark.createDataFrame(
        [("salt", "1 g", "", "2", None, "3"), ("oil", None, "egg", "", " ", "x")],
        "n1 string, m1 string, n2 string, m2 string, n3 string, m3 string",
    )
    names = [F.col(f"n{i}") for i in (1, 2, 3)]
    amounts = [F.col(f"m{i}") for i in (1, 2, 3)]
    got = [r[0] for r in df.select(fn.wide_pairs(names, amounts)).collect()]
    assert got == ["salt: 1 g", "oil; egg: ;  : x"]
    none = spark.range(1).select(fn.wide_pairs([F.lit("")], [F.lit("x")]).alias("w"))
    assert none.first().w == ""


def test_round_half_even_matches_exact_binary_rounding(spark):
    rng = random.Random(3)
    values = [0.25, 18.25, 18.75, 0.15, 0.35, 0.05, -0.04, -0.05, -0.25, 2.5, 1e15, 1e300, 0.0, None]
    values += [rng.uniform(-60, 60) for _ in range(2000)]
    values += [round(rng.uniform(-60, 60), 2) for _ in range(4000)]
    values += [k / 20 for k in range(-400, 400)]
    values += [struct.unpack("f", struct.pack("f", rng.uniform(-40, 60)))[0] for _ in range(1000)]
    for digits in (1, 4):
        got = apply(spark, values, "double", lambda c: fn.round_half_even(c, digits))
        want = [None if v is None else round(v, digits) for v in values]
        assert list(map(repr, got)) == list(map(repr, want))


def test_round_to_int(spark):
    values = [0.5, 1.5, 2.5, -0.5, 42.49, 42.51]
    assert apply(spark, values, "double", fn.round_to_int) == [round(v) for v in values]


def test_bands(spark):
    temps = [None, -3.0, 4.99, 5.0, 14.9, 15.0, 20.5, 25.0, 34.9, 35.0, float("nan")]
    assert apply(spark, temps, "double", fn.temperature_category) == [
        None, "cold", "cold", "cool", "cool", "moderate", "moderate", "warm", "warm", "hot", "hot",
    ]
    starts = apply(spark, [9.9, 10.0, 19.9, 20.0, 29.9, 30.0, None], "double", fn.fallback_advice)
    assert [s and s.split()[0] for s in starts] == [
        "Perfect", "Great", "Great", "Pleasant", "Pleasant", "Hot", None,
    ]


def test_format_size(spark):
    """The number is within half a tenth of the exact quotient, with the unit that its power of 1024 names."""
    rng = random.Random(4)
    sizes = [0, 1, 1023, 1024, 1280, 1792, 1048575, 1048576, 2**30, 2**40, 5 * 2**50]
    sizes += [rng.randrange(2 ** rng.randint(1, 52)) for _ in range(500)]
    names = ["B", "KB", "MB", "GB", "TB"]
    for size, text in zip(sizes, apply(spark, sizes, "bigint", fn.format_size)):
        number, unit = text.split(" ")
        power = min(max(size.bit_length() - 1, 0) // 10, 4)
        assert unit == names[power] and number[-2] == "."
        assert abs(Fraction(number) - Fraction(size, 1024**power)) <= Fraction(1, 20)
    assert apply(spark, [1280, 1792, 1048575], "bigint", fn.format_size) == ["1.2 KB", "1.8 KB", "1024.0 KB"]


def test_paths(spark):
    paths = ["/d/raw/m/x", "/d/formatted/x", "/d/usage/raw/x", "/d/raw", "/usage/x", None]
    assert apply(spark, paths, "string", fn.layer_of) == [
        "raw", "formatted", "raw", "backup", "usage", "backup",
    ]
    names = ["/a/formatted_meals_20241219_153045.parquet/part-0", "/a/x.json", "/a/m_20241399_990000.json"]
    times = apply(spark, names, "string", fn.snapshot_time)
    assert [t and t.isoformat() for t in times] == ["2024-12-19T15:30:45", None, None]
    built = spark.sql("select timestamp'2024-12-19 15:30:45' t").select(
        fn.snapshot_name("formatted", "meals", F.col("t"), "parquet").alias("n")
    )
    assert built.first().n == "formatted_meals_20241219_153045.parquet"


def test_places_and_zones(spark):
    df = spark.createDataFrame(
        [("Lyon", "x", "France"), ("", "Arles", ""), (None, None, None), ("", "", "Peru")],
        "c string, t string, k string",
    )
    got = [r[0] for r in df.select(fn.place_name(F.col("c"), F.col("t"), F.col("k"))).collect()]
    assert got == ["Lyon, France", "Arles, ", "Unknown, Unknown", "Unknown, Peru"]
    zones = ["b'Europe/Paris'", "Europe/Paris", None]
    assert apply(spark, zones, "string", fn.repair_timezone) == ["Europe/Paris", "Europe/Paris", None]


def test_times(spark):
    assert apply(spark, [1749576600], "bigint", fn.epoch_to_iso) == ["2025-06-10T17:30:00+00:00"]
    assert apply(spark, [1749513600], "bigint", fn.epoch_to_date) == ["2025-06-10"]
    isos = ["2025-06-10T17:30:00+00:00", "T", None]
    assert apply(spark, isos, "string", fn.compact_time) == ["2025-06-10 17:30:00", " ", None]
    assert apply(spark, [45, None], "int", fn.minutes_text) == ["45 minutes", "30 minutes"]


def test_fingerprint_ignores_column_order_and_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "x", None)], "b int, a string, c string")
    one = df.select(fn.fingerprint(["a", "b", "c"]).alias("f")).first().f
    assert one == df.select("c", "b", "a").select(fn.fingerprint(["c", "b", "a"]).alias("f")).first().f
    assert df.select(fn.json_record(["b", "c"]).alias("j")).first().j == '{"b":1,"c":null}'
