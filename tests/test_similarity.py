import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearthline.functions.similarity import (
    chunks_needed,
    key_chunks,
    key_grams,
    lcs_length,
    similar_keys,
    token_sort_key,
    token_sort_ratio,
)


def plain_lcs(a, b):
    line = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(line[j + 1], new[-1], line[j] + (x == y)))
        line = new
    return line[-1]


def plain_score(a, b):
    if a == b:
        return 100.0
    if not a or not b:
        return 0.0
    return 200.0 * plain_lcs(a, b) / (len(a) + len(b))


def random_pairs(seed, lengths, alphabets, n):
    rnd = random.Random(seed)
    pairs = []
    for _ in range(n):
        alphabet = rnd.choice(alphabets)
        a = "".join(rnd.choices(alphabet, k=rnd.choice(lengths)))
        b = list(a) if rnd.random() < 0.7 else rnd.choices(alphabet, k=rnd.choice(lengths))
        for _ in range(rnd.randint(0, 5)):
            spot = rnd.randint(0, len(b))
            b[spot:spot + rnd.randint(0, 1)] = rnd.choices(alphabet, k=rnd.randint(0, 1))
        pairs.append((a, "".join(b)))
    return pairs


def test_lcs_matches_the_plain_table(spark):
    pairs = random_pairs(1, [1, 2, 13, 60, 61, 62, 122, 123, 200], ["ab", "abc de", "日本語é", "😀😁a"], 300)
    pairs = [(a, b) for a, b in pairs if a and b]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n"))
    for r in rows.collect():
        assert r.n == plain_lcs(r.a, r.b)


def test_token_sort_key(spark):
    texts = ["Program  Start", "start\tPROGRAM", "  a-b_c ", "", "!!", "é Z a"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    folded = [r[0] for r in rows.select(token_sort_key(F.col("t"))).collect()]
    raw = [r[0] for r in rows.select(token_sort_key(F.col("t"), False)).collect()]
    assert folded == ["program start", "program start", "a b_c", "", "", "a z é"]
    assert raw == ["Program Start", "PROGRAM start", "a-b_c", "", "!!", "Z a é"]


def test_known_scores(spark):
    cases = [
        ("Program start", "Program Start", False, 92.307692),
        ("program start", "Program Start", False, 84.615385),
        ("program start", "Program Start", True, 100.0),
        ("Program Start", "XXXXXXXXXXXXXXXXXXX", True, 0.0),
        ("", "", True, 100.0),
        ("", "a", True, 0.0),
    ]
    for a, b, fold, expected in cases:
        row = spark.createDataFrame([(a, b)], "a string, b string").select(
            token_sort_ratio(F.col("a"), F.col("b"), fold).alias("s")
        )
        assert abs(row.first().s - expected) < 1e-6


def test_quick_decision_equals_the_score(spark):
    pairs = random_pairs(2, [0, 1, 2, 5, 9, 13, 20, 40], ["ab", "program 0123456789"], 600)
    rows = spark.createDataFrame(pairs, "a string, b string")
    for threshold in (60, 80, 90, 97.5, 100):
        decided = rows.select("a", "b", similar_keys(F.col("a"), F.col("b"), threshold).alias("s")).collect()
        for r in decided:
            assert r.s == (plain_score(r.a, r.b) >= threshold), (r, threshold)


def test_any_choice_of_enough_chunks_finds_a_similar_key(spark):
    pairs = random_pairs(3, [1, 2, 4, 5, 9, 10, 13, 20, 33, 70], ["ab", "abcdef", "program 0123456789"], 900)
    pairs = [(min(p, key=len), max(p, key=len)) for p in pairs if p[0] and p[1]]
    rows = spark.createDataFrame(pairs, "a string, b string")
    for threshold in (30, 50, 70, 80, 90, 95, 100):
        n = chunks_needed(F.length("a"), threshold)
        table = rows.select(
            "a", "b", n.alias("n"), key_chunks(F.col("a"), threshold).alias("chunks"),
            key_grams(F.col("b"), threshold).alias("grams"),
        )
        for r in table.collect():
            if plain_score(r.a, r.b) >= threshold:
                shared = sum(c in set(r.grams) for c in r.chunks)
                assert shared > max(0, len(r.chunks) - r.n), (r, threshold)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=8), st.text(max_size=8)), min_size=1, max_size=5))
def test_score_is_symmetric_and_bounded(spark, pairs):
    clean = [(a.replace("\x00", ""), b.replace("\x00", "")) for a, b in pairs]
    clean = [p for p in clean if all(not 0xD800 <= ord(c) <= 0xDFFF for s in p for c in s)]
    if not clean:
        return
    rows = spark.createDataFrame(clean, "a string, b string").select(
        token_sort_ratio(F.col("a"), F.col("b")).alias("x"), token_sort_ratio(F.col("b"), F.col("a")).alias("y")
    )
    for r in rows.collect():
        assert 0 <= r.x <= 100 and abs(r.x - r.y) < 1e-9
