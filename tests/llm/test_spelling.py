"""op11: spelling variants by PartEnum signatures against all pairs by plain edit distance."""

from lakesearch.llm import spelling
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, word string, n long, root string"


def got(spark, docs):
    frame = spark.createDataFrame(docs, SCHEMA) if isinstance(docs, list) else docs
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(frame).collect()}


def test_variants_of_planted_words_and_odd_rows(spark):
    common = " ".join(["receive"] * 40 + ["separate"] * 120 + ["definitely"] * 50)
    rare = "definitly definitly recieve recieve seperate seperate separatte separatte definately definately receeive receeive"
    rows = [(1, common, "x", 1, "y"), (2, rare, None, None, None), (2, rare, None, None, None), (None, "Receive RECEIVE ÀÉÎõüÿéé ÀÉÎõüÿée", "x", 2, "z"),
            (4, None, None, None, None), (5, "", None, None, None), (6, "ÀÉÎõüÿéé ÀÉÎõüÿée " + "x" * 5000, None, None, None)]
    want = brute.spelling([r[:2] for r in rows])
    assert got(spark, rows) == want
    assert want["seperate"][0] == "separate" and want["definitly"][1] == "definitely" and want["recieve"][0] is None
    assert got(spark, spark.createDataFrame([], SCHEMA)) == {}


def test_whole_small_table_matches_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute.spelling([(r.doc_id, r.text) for r in docs.collect()])
    assert got(spark, docs) == want and any(v[0] for v in want.values())


def test_signatures_are_shared_by_words_one_edit_apart(spark):
    import random
    rng = random.Random(3)
    letters = "abcióné"
    pairs = [("abcdefgh", "abcdefg"), ("abcdefgh", "abcxefgh"), ("aaaaaaab", "aaaaaaaab"), ("zyxwvuts", "zyxwvutss")]
    for _ in range(400):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(7, 12)))
        at = rng.choice([0, 1, 2, 3, len(word) - 1, rng.randrange(len(word))])
        other = rng.choice([word[:at] + rng.choice(letters) + word[at + 1:], word[:at] + word[at + 1:], word[:at] + rng.choice(letters) + word[at:]])
        if len(other) >= 7 and other != word:
            pairs.append((word, other))
    frame = spark.createDataFrame(pairs, "a string, b string")
    rows = frame.select(spelling.signatures(frame.a).alias("x"), spelling.signatures(frame.b).alias("y")).collect()
    assert all(set(r.x) & set(r.y) for r in rows)
