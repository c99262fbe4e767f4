import pytest
from pyspark.sql import functions as F

from tessera.functions import similarity as S, text as X


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize("a, b, expected", [("Acme Corp", "acme corp", 1.0), ("", "", 0.0), (None, None, 0.0), ("nan", "nan", 0.0)])
def test_exact(spark, a, b, expected):
    assert one(spark, S.exact("a", "b"), a=a, b=b) == expected


def test_token_sets(spark):
    a, b = "acme global services", "services acme corp"
    assert one(spark, S.token_jaccard("a", "b"), a=a, b=b) == 0.5
    assert one(spark, S.token_overlap("a", "b"), a=a, b=b) == pytest.approx(2 / 3)


def test_edit_distances(spark):
    assert one(spark, S.levenshtein_similarity("a", "b"), a="kitten", b="sitting") == pytest.approx(1 - 3 / 7)
    assert one(spark, S.jaro_winkler("a", "b"), a="martha", b="marhta") == pytest.approx(0.96111, abs=1e-4)
    assert one(spark, S.jaro_winkler("a", "b"), a="abcdef", b="abxyzw") == pytest.approx(0.5556, abs=1e-4)
    assert one(spark, S.prefix_ratio("a", "b"), a="Supermarket", b="Superstore") == pytest.approx(5 / 11)
    assert one(spark, S.suffix_ratio("a", "b"), a="Green Light", b="Red Light") == pytest.approx(6 / 11)


@pytest.mark.parametrize("a, b, expected", [("60016", "60016", (1, 1, 0, 0)), ("60016", "90210", (0, 1, 0, 0)), ("60016", None, (0, 0, 1, 0)), (None, "", (0, 0, 0, 1))])
def test_structured(spark, a, b, expected):
    got = [one(spark, c, a=a, b=b) for c in S.compare_field("a", "b").values()]
    assert tuple(got) == expected


def test_normalisation(spark):
    assert one(spark, X.casefold(X.unicode_form("a")), a="Ａｂｃ ß") == "abc ss"
    assert one(spark, X.stages("a")["unicode"], a="café") == "café"
    assert one(spark, X.collapse_whitespace(F.lower("a")), a="  HELLO   \t WORLD \n ") == "hello world"
    assert one(spark, X.cleaned("a"), a=None) is None
    assert one(spark, X.cleaned("a"), a="A–B “x” (y)_z%") == "a-b x y z"
    assert one(spark, X.alnum_tokens("a"), a="Acme & Co. (USA) #123") == ["Acme", "Co", "USA", "123"]
    assert one(spark, X.char_ngrams("a", 3), a="acme") == ["acm", "cme"]
    assert one(spark, X.char_ngrams("a", 3), a="ab") == ["ab"]
    assert one(spark, X.alternative_address("a"), a="12 n main st., apt 4") == "12 N main Street , Apt 4"


def test_names_and_addresses(spark):
    n = X.name_representations("a", suffixes={"llc": "llc"})
    assert one(spark, n["name"], a="Smith & Sons LLC") == "smith and sons llc"
    assert one(spark, n["name_core"], a="Smith & Sons LLC") == "smith and sons"
    a = X.address_representations("a", ({"st": "street"},))
    assert one(spark, a["address"], a="9 Main St, Springfield, 60016") == "9 main street, springfield, 60016"
    assert one(spark, a["address_postal"], a="9 Main St, Springfield, 60016") == "60016"
    assert one(spark, a["address_house_number"], a="Near 9 Main St, x") == "9"


@pytest.mark.parametrize("name, kind", [("country", "country"), ("ship_country", "country"), ("business_address", "address"), ("business_name", "name"), ("entity_id", "identifier"), ("size", "generic")])
def test_column_kinds(name, kind):
    assert X.classify_column(name) == kind


def test_case_folding_of_all_letters(spark):
    """Against Python's full case folding, for every letter that folds to one, and those that
    are listed; but for the Cherokee ones, whose small forms Unicode folds to capitals."""
    letters = [c for c in map(chr, range(0x20, 0x2FFFF)) if c.isalpha() and not 0x13A0 <= ord(c) <= 0x13FF and not 0xAB70 <= ord(c) <= 0xABBF and (len(c.casefold()) == 1 or c in X.SPELLED_OUT)]
    rows = spark.createDataFrame([(c,) for c in letters], "a string").select("a", X.casefold("a").alias("x")).collect()
    wrong = [hex(ord(r.a)) for r in rows if r.x != r.a.casefold()]
    assert len(wrong) <= 20, wrong  # letters newer than the JVM's tables


@pytest.mark.parametrize("form", X.FORMS)
def test_unicode_forms(spark, form):
    import unicodedata

    for text in ("plain", "e\u0301 \u00e9 \ufb01 \u2460", "\uac00\u1112\u1161\u11ab"):
        assert one(spark, X.unicode_form("a", form), a=text) == unicodedata.normalize(form, text)


def plain_winkler(a, b):
    """Jaro-Winkler, letter by letter."""
    if a == b:
        return 1.0
    reach, free, left = max(max(len(a), len(b)) // 2 - 1, 0), list(b), []
    for i, c in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if free[j] == c), None)
        if j is not None:
            left.append(c)
            free[j] = None
    right = [c for c, f in zip(b, free) if f is None]
    m = len(left)
    if not m:
        return 0.0
    jaro = (m / len(a) + m / len(b) + (m - sum(x != y for x, y in zip(left, right)) // 2) / m) / 3
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + 0.1 * same * (1 - jaro) if jaro > 0.7 else jaro


def test_jaro_winkler_against_letter_by_letter():
    import random

    rng = random.Random(3)
    words = ["".join(rng.choices("abcé 漢", k=rng.randint(1, 14))) for _ in range(300)]
    left, right = rng.choices(words, k=2000), rng.choices(words, k=2000)
    assert S.jaro_winkler_values(left, right).tolist() == pytest.approx([plain_winkler(a, b) for a, b in zip(left, right)])


@pytest.mark.parametrize("a, b", [("ABC ", "abc"), (" Straße", "STRASSE"), ("ÉCLAIR", " éclair "), ("ΣΑΣ", "σας")])
def test_case_and_outer_space_do_not_count(spark, a, b):
    for f in (S.exact, S.token_jaccard, S.token_overlap, S.char_ngram_jaccard, S.levenshtein_similarity, S.jaro_winkler, S.prefix_ratio, S.suffix_ratio, S.bigram_dice):
        assert one(spark, f("a", "b"), a=a, b=b) == 1.0, f.__name__


def test_stages_that_change(spark):
    assert one(spark, X.changed_at("a", "folded"), a="Abc") is True and one(spark, X.changed_at("a", "folded"), a="abc") is False
    with pytest.raises(KeyError):
        X.changed_at("a", "none")


def test_representations_keep_the_raw_columns(spark):
    df = spark.createDataFrame([("S1-7", "Löwe & Co", "9 Main St, Apt 4, 60016", None)], "entity_id string, business_name string, business_address string, country string")
    r = X.representations(df, rules={"suffixes": {"co": "co"}}).first()
    assert r.business_name == "Löwe & Co" and r.business_name__name_core == "löwe and" and r.business_address__address_unit == "4"
    assert r.entity_id__id_body == "7" and r.country__country is None and list(X.plan(["size"])["size"])[:2] == ["raw", "unicode"]
