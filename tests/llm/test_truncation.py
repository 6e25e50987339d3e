import random

import pytest

from stridelake.llm import truncation

FIRST = ["The grey wolf", "A small crab", "Our second reviewer", "The night shift"]
VERB = ["climbs the ledge", "rejected the mirrored copy", "compared it with the export", "asked for another pass"]
LAST = ["before lunch", "without losing balance", "because the caption was wrong", "near the last frame"]


def sentence(rnd):
    return f"{rnd.choice(FIRST)} {rnd.choice(VERB)} {rnd.choice(LAST)}."


def corpus():
    rnd = random.Random(1)
    rows, cut, n = [], set(), 0

    def add(source, text, is_cut=False):
        nonlocal n
        n += 1
        rows.append((n, text, source))
        if is_cut:
            cut.add(n)

    for _ in range(120):
        text = " ".join(sentence(rnd) for _ in range(rnd.randrange(2, 6)))
        add("diary", text + rnd.choice(["", "", "\n-- desk 4", "\n(see take_12.npy)", " [ok]"]))
        full = " ".join(sentence(rnd) for _ in range(9))
        add("form", full[:200], full[199:200] != "." and full[198:200] != ". ")
        add("label", f"{rnd.choice(FIRST)} {rnd.choice(VERB)}")
        add("memo", " ".join(sentence(rnd) for _ in range(3)).replace(".", "").lower())
        add("list", f"{sentence(rnd)}\n- {rnd.choice(VERB)}\n- {rnd.choice(LAST)}\nstatus: {rnd.choice(['open', 'closed'])}")
        add("page", f"<h2>Wolf</h2>\n<p>{sentence(rnd)}</p>")
    for bad in ("<p>The grey wolf climbs", "<p>The grey wolf climbs.</p", "<p>The grey wolf climbs.</p>\n<", "<p>The night shift &am", "<p>The grey wolf climbs.</p>\n<p>", "<p>The grey wo�"):
        add("page", bad, True)
    add("diary", "The grey wolf climbs the ledge before lunch. A small cr", True)
    add("diary", "The grey wolf climbs the ledge before lunch. A small crab", True)
    add("diary", "The grey wolf climbs the ledge before lunch. A small crab …", True)
    add("diary", "The grey wolf climbs the ledge before lunch.\n-- de", True)
    add("memo", "the night shift rejected the mirrored copy near the la", True)
    add("label", "The grey wolf rejected the mirr", True)
    add("list", "The night shift asked for another pass near the last frame.\n- climbs the led", True)
    add("list", "The night shift asked for another pass near the last frame.\nstatus: clo", True)
    add(None, "A small crab climbs the ledge before lunch.")
    for blank in (None, "", " \n ​"):
        add("diary", blank)
    add("diary", "A small crab climbs the ledge before lunch. " * 4000)
    add("diary", ("A small crab climbs the ledge before lunch. " * 4000)[:-20], True)
    return rows, cut


def test_planted_cuts(spark):
    rows, cut = corpus()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + rows[:30]], "doc_id bigint, text string, source string, token string, at0 int").repartition(3)
    got = [r[0] for r in truncation.truncated(df).collect()]
    assert len(got) == len(set(got))
    text = {r[0]: r for r in rows}
    assert set(got) == cut, [text[i] for i in set(got) ^ cut]
    shares = {r["source"]: r for r in truncation.source_shares(df).collect()}
    assert shares["memo"]["n_texts"] == 121 and shares["memo"]["n_cut"] == 1
    assert sum(r["n_texts"] for r in shares.values()) == len(rows) - 3


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert truncation.truncated(df).count() == truncation.source_shares(df).count() == 0


@pytest.mark.parametrize("text, closed, certain", [("Done.", True, False), ("It is “done.”", True, False), ("and then…", False, True), ("It is done. …", True, False), ("half�", False, True), ("<b>x</b> y", True, False), ("<ul><li>a", False, True), ("a < b", False, False)])
def test_endings(text, closed, certain):
    assert truncation.ending(text)[:2] == (closed, certain)


def test_trie(spark):
    words = spark.createDataFrame([("an", 3), ("and", 2), ("be", 1)], "word string, n bigint")
    nodes = {r["node"]: (r["n_word"], r["n_below"]) for r in truncation.trie(words).collect()}
    assert nodes == {"a": (0, 5), "an": (3, 2), "and": (2, 0), "b": (0, 1), "be": (1, 0)}


def test_trie_of_asked_nodes(spark):
    known = [("an", 3), ("and", 2), ("be", 1), ("a" * 200_000, 1), ("b" * 100_000 + "c", 4)]
    words = spark.createDataFrame(known, "word string, n bigint")
    asked = ["a", "an", "b", "bb", "bbb", "b" * 50_000, "zz", "anda"]
    made = truncation.trie(words, spark.createDataFrame([(x,) for x in asked], "node string"))
    nodes = {r["node"]: (r["n_word"], r["n_below"]) for r in made.collect()}
    every = {r["node"]: (r["n_word"], r["n_below"]) for r in truncation.trie(words.where("length(word) < 10")).collect()}
    for x in asked:
        n_word, n_below = sum(n for w, n in known if w == x), sum(n for w, n in known if w != x and w.startswith(x))
        assert nodes.get(x, (0, 0)) == (n_word, n_below), x
    assert len(nodes) < 40 and every["an"] == (3, 2)


@pytest.mark.parametrize("mark", ["lire la suite", "weiterlesen", "leer más", "[mehr]", "show more"])
def test_marks_of_several_languages(mark):
    assert truncation.ending(f"Der Wolf lief {mark}")[:2] == (False, True)
