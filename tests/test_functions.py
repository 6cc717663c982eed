"""Normalisation and similarity of single values."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions import fold, fuzzy, rules, similarity, text


def values(spark, rows, columns, *exprs):
    df = spark.createDataFrame(rows, columns)
    return [tuple(r) for r in df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).collect()]


def test_clean(spark):
    rows = [("  Acme,  Inc. ",), ("Café-Crème & Söhne GmbH",), ("Straße œuvre ŁÓDŹ",), (None,), ("",), ("a\tb\nc",), ("Москва 東京 नमस्ते",)]
    found = [r[0] for r in values(spark, rows, "s string", text.clean(F.col("s")))]
    assert found[:6] == ["acme inc", "cafe creme sohne gmbh", "strasse oeuvre lodz", "", "", "a b c"]
    assert found[6].isascii() and len(found[6].split()) >= 3  # nothing dropped without a trace


def test_other_scripts_stay_visible():
    for word in ("Москва", "東京", "नमस्ते", "서울", "Αθήνα", "القاهرة"):
        folded = fold.romanise(word)
        assert folded.isascii() and folded.strip()
    assert fold.without_marks("é ñ ﬁ") == "e n fi"


def test_is_latin(spark):
    rows = [("abc",), ("Москва",), ("123",), ("éa Мо",), ("a Москва",)]
    assert [r[0] for r in values(spark, rows, "s string", fold.is_latin(F.col("s")))] == [True, False, True, True, False]


@pytest.mark.parametrize(
    ("name", "country", "expected"),
    [
        ("Acme Robotics Incorporated", "US", "acme robotics inc"),
        ("ACME ROBOTICS Inc.", "US", "acme robotics inc"),
        ("Delta Foods Corporation", "US", "delta foods corp"),
        ("Zen Traders Private Limited", "IN", "zen traders pvt ltd"),
        ("Zen Traders Private Limited Private Ltd", "IN", "zen traders pvt ltd pvt ltd"),
        ("Zen Traders Private Limited", "US", "zen traders private ltd"),
        ("Section 8 Co-operative", "IN", "s8 coop"),
        ("Société Anonyme Dupont", "FR", "sa dupont"),
        ("Société à Responsabilité Limitée", "FR", "sarl"),
        ("", "US", ""),
    ],
)
def test_names(spark, name, country, expected):
    assert values(spark, [(name, country)], "s string, c string", text.normalize_name(F.col("s"), F.col("c"))) == [(expected,)]


@pytest.mark.parametrize(
    ("address", "country", "expected", "number"),
    [
        ("123 Innovation Drive, San Jose", "US", "123 innovation dr san jose", "123"),
        ("Innovation Drive 123 San Jose", "US", "123 innovation dr san jose", "123"),
        ("123a Main Street", "US", "123a main st", "123a"),
        ("Near Temple, MG Road", "IN", "nr temple mg rd", None),
        ("25 Avenue Résidence", "FR", "25 ave res", "25"),
        ("Flat 4 Block 7", "IN", "4 fl blk 7", "4"),
        ("0 Void Lane", "US", "0 void ln", "0"),
        ("12", "US", "12", "12"),
        ("", "US", "", None),
    ],
)
def test_addresses(spark, address, country, expected, number):
    tokens = text.address_tokens(text.clean(F.col("s")), F.col("c"))
    found = values(spark, [(address, country)], "s string, c string", text.number_first(tokens, text.street_number(tokens)), text.street_number(tokens))
    assert found == [(expected, number)]


def test_countries(spark):
    rows = [("Germany",), (" usa ",), ("",), (None,), ("xx",), ("United Kingdom",)]
    assert [r[0] for r in values(spark, rows, "s string", text.normalize_country(F.col("s")))] == ["DE", "US", "UNKNOWN", "UNKNOWN", "XX", "GB"]


def test_register_locale(spark):
    rules.register_locale("zz", rules.Locale(name={"gesellschaft": "ges"}))
    try:
        assert values(spark, [("Alte Gesellschaft", "ZZ")], "s string, c string", text.normalize_name(F.col("s"), F.col("c"))) == [("alte ges",)]
        assert rules.rules_for("zz").name["limited"] == "ltd"
    finally:
        rules._locales.pop("ZZ")


def test_numbers_and_grams(spark):
    assert values(spark, [("12 ab 123a 45_6 7",)], "s string", text.numeric_tokens(F.col("s"))) == [(["12", "7"],)]
    assert sorted(values(spark, [("ab c",)], "s string", text.char_ngrams(F.col("s")))[0][0]) == sorted([" ", "a", "b", " ", " a", "ab", "b ", " ", "c", " ", " c", "c "])


@pytest.mark.parametrize(
    ("a", "b", "jaccard", "prefix", "length"),
    [("acme corp", "acme foods", 1 / 3, 0.5, 0.9), ("", "", 1, 1, 1), ("", "a", 0, 0, 0), ("acme", "acorn", 0, 0.4, 0.8), ("abc", "abcdef", 0, 0.5, 0.5), ("a b", "b a", 1, 0, 1)],
)
def test_plain_similarities(spark, a, b, jaccard, prefix, length):
    x, y = F.col("a"), F.col("b")
    found = values(spark, [(a, b)], "a string, b string", similarity.token_jaccard(x, y), similarity.common_prefix(x, y), similarity.length_ratio(x, y))
    assert found[0] == pytest.approx((jaccard, prefix, length))


def test_flags(spark):
    rows = [("1", "1"), ("1", "2"), ("1", ""), (None, None)]
    assert [r[0] for r in values(spark, rows, "a string, b string", similarity.street_agreement(F.col("a"), F.col("b")))] == [1.0, 0.0, 0.5, 0.5]
    rows = [("a ", " a"), ("a", "b"), ("", "")]
    assert [r for r in values(spark, rows, "a string, b string", similarity.exact(F.col("a"), F.col("b")), similarity.missing(F.col("a"), F.col("b")))] == [(1.0, 0.0), (0.0, 0.0), (1.0, 1.0)]


def test_cosine(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])]
    assert [r[0] for r in values(spark, rows, "a array<float>, b array<float>", similarity.cosine(F.col("a"), F.col("b")))] == [1.0, 0.0, 0.0]


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def plain_indel(a, b):
    return 2 * table_lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def plain_sort(a, b):
    return plain_indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def plain_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    join = lambda t: " ".join(sorted(t))
    shared, left, right = join(x & y), join(x - y), join(y - x)
    if shared and (not left or not right):
        return 1.0
    sides = [f"{shared} {r}".strip() for r in (left, right)]
    # the shared tokens stand in front of both, so their distance is that of what follows
    best = 1 - (len(left) + len(right) - 2 * table_lcs(left, right)) / (len(sides[0]) + len(sides[1]))
    return max([best, *(plain_indel(shared, side) for side in sides if shared)])


def plain_partial(a, b):
    if not a or not b:
        return float(not a and not b)
    out = 0.0
    for short, long in ((a, b), (b, a)):
        if len(short) <= len(long):
            out = max([out, *(plain_indel(short, long[max(0, i) : i + len(short)]) for i in range(1 - len(short), len(long)))])
    return out


PLAIN = {"indel": plain_indel, "sorted": plain_sort, "set": plain_set, "partial": plain_partial}
words = st.text(alphabet="ab c", max_size=12) | st.text(alphabet="abcdefgh xyzé中", max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=6))
def test_fuzzy_ratios(pairs):
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    for name, of in fuzzy.KINDS.items():
        assert of(a, b).tolist() == pytest.approx([PLAIN[name](x, y) for x, y in pairs]), name


def test_fuzzy_ratios_of_long_strings(monkeypatch):
    """Patterns of several words of bits, and tables cut into small groups."""
    import random

    rng = random.Random(2)
    made = ["".join(rng.choice("abcd  e") for _ in range(rng.choice((0, 1, 63, 64, 65, 128, 130, 200)))) for _ in range(24)]
    pairs = [(x, y) for x in made[:5] for y in made[5:]]
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    expected = {name: [PLAIN[name](x, y) for x, y in pairs] for name in ("indel", "sorted", "set")}
    short = [(x[:40], y[:90]) for x, y in pairs[:30]]
    for cells, lanes, long in ((fuzzy.CELLS, fuzzy.LANES, fuzzy.LONG), (1000, 50, fuzzy.LONG), (fuzzy.CELLS, fuzzy.LANES, 20)):
        monkeypatch.setattr(fuzzy, "LONG", long)
        monkeypatch.setattr(fuzzy, "CELLS", cells)
        monkeypatch.setattr(fuzzy, "LANES", lanes)
        for name, values in expected.items():
            assert fuzzy.KINDS[name](a, b).tolist() == pytest.approx(values), name
        assert fuzzy.partial([x for x, _ in short], [y for _, y in short]).tolist() == pytest.approx([plain_partial(x, y) for x, y in short])


def test_partial_ratio_of_much_longer_strings():
    """Short strings against ones that are cut into parts, and a table of 64 million cells that windows one by one take minutes for."""
    import random
    import time

    rng = random.Random(3)
    text = lambda n, letters="abcd  e": "".join(rng.choice(letters) for _ in range(n))
    pairs = [(text(m), text(n)) for m, n in ((1, 170), (3, 320), (17, 161), (20, 180), (40, 199), (40, 200), (41, 300), (45, 600), (9, 700), (60, 60), (254, 255))]
    pairs += [(x, y[:400] + x + y[400:]) for x, y in pairs[4:9]] + [(x + "é中\U0001f600", y + "中") for x, y in pairs[:5]]
    expected = [plain_partial(x, y) for x, y in pairs]
    assert fuzzy.partial([x for x, _ in pairs], [y for _, y in pairs]).tolist() == expected
    assert fuzzy.partial([y for _, y in pairs], [x for x, _ in pairs]).tolist() == expected
    long, began = text(16_000), time.process_time()
    assert fuzzy.partial([long[7_000:11_000]], [long]).tolist() == [1.0]
    assert fuzzy.partial([text(4_000, "xyzabcd")], [long])[0] < 0.9
    assert time.process_time() - began < 30


def test_fuzzy_known_values(spark):
    rows = [("", "", 1, 1, 0, 1), ("a", "", 0, 0, 0, 0), ("b a", "a b", 1 / 3, 1, 1, 0.5), ("a b", "a b c", 0.75, 0.75, 1, 1), ("abc", "xxabcxx", 0.6, 0.6, 0.6, 1), ("kitten", "sitting", 8 / 13, 8 / 13, 8 / 13, 2 / 3), (None, "a", 0, 0, 0, 0), (None, None, 1, 1, 0, 1), ("  ", "  ", 1, 1, 0, 1)]
    df = spark.createDataFrame([r[:2] for r in rows for _ in range(3)], "a string, b string")
    found = [tuple(r["f"]) for r in df.select(fuzzy.fuzzy("a", "b").alias("f")).collect()]
    assert found[::3] == found[1::3] == [pytest.approx(r[2:]) for r in rows]


def test_windows_of_pairs_alike_in_size_are_counted_in_bytes(monkeypatch):
    """feat_partial: the same ratios as lanes of any sizes get, and those of a loop over windows."""
    import random

    from linkloom.functions import fuzzy

    draw, calls, alike = random.Random(7), [], fuzzy.best_alike
    monkeypatch.setattr(fuzzy, "best_alike", lambda *x: calls.append(x[1:3]) or alike(*x))
    for m, n in ((1, 1), (1, 6), (5, 5), (4, 9), (18, 18)):
        a, b = ([draw.choice("abc") for _ in range(k * 40)] for k in (m, n))
        a, b = ["".join(a[i * m : i * m + m]) for i in range(40)], ["".join(b[i * n : i * n + n]) for i in range(40)]
        best = []
        for x, y in zip(a, b):
            cut = [(s, w) for s, t in ((x, y), (y, x)) if len(s) <= len(t) for f in range(1 - len(s), len(t)) if (w := t[max(f, 0) : f + len(s)])]
            best.append(max(2 * fuzzy.long_lcs(s, w) / (len(s) + len(w)) for s, w in cut))
        assert fuzzy.partial(a, b).tolist() == best and (m, n) in calls
        assert fuzzy.partial(b, a).tolist() == best
