import math
import random
import unicodedata

from pyspark.sql import functions as F

from corpusmill.functions.text import norm, row_text, safe_float, duration


def _col(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select(expr(F.col("v")).alias("o"), "i").orderBy("i").collect()]


def test_whitespace_collapse(spark):
    assert _col(spark, ["\tmu  lu\n\n ka"], norm) == ["mu lu ka"]


def test_none_is_empty(spark):
    assert _col(spark, [None, "", "\u200b", "\u3000"], norm) == ["", "", "", ""]


def test_whitespace_class_equals_python(spark):
    # Every code point Python treats as whitespace collapses; no other one does.
    cps = [c for c in range(0x0, 0x3100) if not (0xD800 <= c <= 0xDFFF)] + [0x205F, 0x3000, 0xFEFF, 0x180E]
    values = [f"a{chr(c)}b" for c in cps]
    got = _col(spark, values, norm)
    for c, v in zip(cps, got):
        if chr(c).isspace():
            assert v == "a b", hex(c)
        elif c == 0x200B:
            assert v == "ab"
        else:
            assert len(v.split()) == 1 and unicodedata.is_normalized("NFC", v), hex(c)


def test_nfc_composed_decomposed_and_hangul(spark):
    values = ["e\u0301", "é", "\u1100\u1161", "Å", "café e\u0301"]
    assert _col(spark, values, norm) == ["\u00e9", "\u00e9", "\uac00", "\u00c5", "caf\u00e9 \u00e9"]


def test_zero_width_space_removed_after_nfc(spark):
    # T2: one pass leaves e + combining acute (U+200B sat between them), two passes compose.
    v = "e\u200b\u0301"
    once = _col(spark, [v], norm)[0]
    twice = _col(spark, [v], lambda c: norm(norm(c)))[0]
    assert once == "e\u0301"
    assert twice == "é"


def test_normalised_random_strings_have_the_properties(spark):
    rng = random.Random(7)
    alphabet = ["a", "e", " ", "\t", "\n", "\u00a0", "\u3000", "\u200b", "\u0301", "é", "\x1c", "\x1f", "\u1100", "\u1161", "x"]
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    got2 = _col(spark, values, lambda c: norm(norm(c)))
    got3 = _col(spark, values, lambda c: norm(norm(norm(c))))
    assert got2 == got3  # a fixed point after two passes
    for raw, v in zip(values, got2):
        assert unicodedata.is_normalized("NFC", v) and "\u200b" not in v
        assert v == v.strip() and not any(a.isspace() and (a != " " or b == " ") for a, b in zip(v, v[1:]))
        kept = [c for c in unicodedata.normalize("NFD", raw) if not c.isspace() and c != "\u200b"]
        assert [c for c in unicodedata.normalize("NFD", v) if c != " "] == kept


def test_row_text(spark):
    df = spark.createDataFrame([(1, None), (2, "  x  y ")], "i int, v string")
    out = df.select(row_text(F.col("i")).alias("a"), row_text(F.col("v")).alias("b")).orderBy("a").collect()
    assert [(r.a, r.b) for r in out] == [("1", ""), ("2", "x y")]


FLOAT_CASES = {
    "1": 1.0, " 2.5 ": 2.5, "1_0": 10.0, "1__0": None, "_1": None, "1_": None, "+nan": math.nan, "-NaN": math.nan, "nan": math.nan,
    "inf": math.inf, "-Infinity": -math.inf, "+inf": math.inf, "1d": None, "1.0f": None, "1e400": math.inf, "-1e-400": -0.0, ".5": 0.5,
    "5.": 5.0, ".": None, "e5": None, "1e": None, "0x1p3": None, "\u00a01.5\u3000": 1.5, " 1": 1.0, "": None, "   ": None,
    None: None, "1.5e+3": 1500.0, "1_000.000_1e1_0": 10000001000000.0, "abc": None, "--1": None, "+-1": None, "1 2": None, "007": 7.0,
    "1.2.3": None,
}


def test_safe_float_values(spark):
    got = _col(spark, list(FLOAT_CASES), safe_float)
    for (v, w), g in zip(FLOAT_CASES.items(), got):
        assert (math.isnan(g) if w is not None and math.isnan(w) else g == w), (v, g, w)


def test_duration_rules(spark):
    # T6: NaN -> 0.0 (Python max(0.0, nan)), negative -> 0.0, NULL bound -> NULL.
    rows = [(0, 0.0, 1.5), (1, 2.0, 1.0), (2, None, 1.0), (3, 1.0, float("nan")), (4, 1.0, None)]
    df = spark.createDataFrame(rows, "i int, s double, e double")
    out = [r[0] for r in df.select(duration("s", "e"), "i").orderBy("i").collect()]
    assert out == [1.5, 0.0, None, 0.0, None]


def test_nfc_inert_ranges_are_inert():
    from corpusmill.functions.text import NFC_INERT_RANGES

    second = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))  # Hangul V / T jamo
    for cp in range(0x110000):
        d = unicodedata.decomposition(chr(cp))
        if d and not d.startswith("<"):
            parts = d.split()
            if len(parts) == 2 and unicodedata.normalize("NFC", "".join(chr(int(p, 16)) for p in parts)) == chr(cp):
                second.add(int(parts[1], 16))
    for lo, hi in NFC_INERT_RANGES:
        for cp in range(lo, hi + 1):
            c = chr(cp)
            assert unicodedata.normalize("NFC", c) == c and unicodedata.combining(c) == 0 and cp not in second, hex(cp)


def test_nfc_of_cjk_and_hangul_strings(spark):
    values = ["你好，世界。", "\u1100\u1161\u11a8", "\u304b\u3099", "\uf900", "\uff46\uff55\uff4c\uff4c", "\uac00\u11a8"]
    assert _col(spark, values, norm) == ["你好，世界。", "\uac01", "\u304c", "\u8c48", "\uff46\uff55\uff4c\uff4c", "\uac01"]
