import random

from stridelake.llm import truncation


def word(rnd, n):
    return "".join(rnd.choice("bcdfghjklmnp") for _ in range(n))


def labels(rnd):
    return ["the mark was at the lake"] + [f"the {word(rnd, rnd.randrange(3, 33))} took the markers to the lake" for _ in range(60)]


def stopped(rnd, length, n):
    """Distinct texts of one length that stop behind 'mark', a word by itself."""
    return [f"the {word(rnd, length - 20)} beside the mark"[-length:] for _ in range(n)]


def cut(spark, texts):
    df = spark.createDataFrame([(i, "label", t) for i, t in enumerate(texts)], "doc_id bigint, source string, text string")
    return {texts[r[0]] for r in truncation.truncated(df).collect()}


def test_both_limits_of_a_source_whose_limit_was_raised(spark):
    rnd = random.Random(3)
    ends = stopped(rnd, 90, 15) + stopped(rnd, 120, 15)
    assert cut(spark, labels(rnd) + ends) == set(ends)


def test_copies_hide_no_limit(spark):
    rnd = random.Random(4)
    ends = stopped(rnd, 90, 15)
    assert cut(spark, labels(rnd) + ["the old lake"] * 40 + ends) == set(ends)


def test_copies_make_no_limit(spark):
    rnd = random.Random(5)
    assert cut(spark, labels(rnd) + stopped(rnd, 90, 1) * 40) == set()
