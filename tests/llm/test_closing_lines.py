from stridelake.llm import truncation


def cut(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, source string, text string")
    return {r[0] for r in truncation.truncated(df).collect()}


def test_copies_make_no_closing_line(spark):
    rows = [("list", f"The crab number {i} climbs the ledge.\n- climbs the ledge") for i in range(200)]
    rows += [("list", "The mirrored copy was rejected.\n- climbs the led")] * 40
    assert cut(spark, rows) == set(range(200, 240))


def test_closing_line_of_a_small_source(spark):
    rows = [("diary", f"The mirrored copy number {i} was rejected.") for i in range(5000)]
    rows += [("post", f"The crab went home on day {i}.\n-- mirr") for i in range(4)]
    rows += [("post", "The crab stayed.\n-- mi")]
    assert cut(spark, rows) == {5004}


def test_lines_that_differ_beyond_their_first_200_characters(spark):
    opening = "This report was compiled by the night shift from the takes of the week " * 4
    rows = [("report", f"{opening}and the crab met the {a} on the ledge near the mirrored copy") for a in ("wolf", "heron", "lizard", "horse", "raven", "otter")]
    rows += [("report", f"{opening}and the crab met the {a} on the ledge near the mirr") for a in ("wolf", "heron", "lizard", "horse")]
    rows += [("report", f"the crab met the {a}") for a in ("wolf", "heron", "lizard", "horse", "raven", "otter")]  # a source that does not close its sentences
    assert cut(spark, rows) == {6, 7, 8, 9}
