import random

import pytest

from stridelake.llm import leakage
from stridelake.llm.words import lattice, plain, readings, words

ITEM = "Which of 158 recorded frosttusk turns first when the lower spine reaches 175 units, given that smoothly every nervous mossmane grazes?"


@pytest.mark.parametrize(
    "text",
    [
        ITEM.upper(), ITEM.replace("i", "í").replace("o", "ö"), ITEM.replace(" ", "\n\t "), "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in ITEM),
        ITEM.replace("recorded", "re­cor​ded"), ITEM.replace("recorded", "recor-\n  ded"), ITEM.replace("recorded", "recor-\r\n> ded"), ITEM.replace("frosttusk", "<b>frost</b>tusk").replace("first", "<p>first</p>"),
        ITEM.replace("recorded", "**recor**ded"), ITEM.replace("turns first", "turns [first](http://x.y/z_(1)?a=b)"), ITEM.replace("units", "uni&shy;ts").replace("turns", "turns &amp;"), ITEM.replace("recorded", "“recorded”—").replace("units,", "_units_ …"),
    ],
)
def test_words_see_through_disguise(text):
    assert words(text) == words(ITEM)


def test_hyphen_may_also_part_words():
    assert readings("a close-\nup view") == [["a", "closeup", "view"], ["a", "close", "up", "view"]]
    assert plain("x < y > z") == "x < y > z"
    assert words("ﬁve ½ Straße STRASSE") == ["five", "1", "2", "strasse", "strasse"]


def brute(docs, items, run):
    out = set()
    for d, t in docs:
        for w in readings(t or ""):
            have = {tuple(w[i : i + run]) for i in range(len(w) - run + 1)}
            for i, s in items:
                v = words(s or "")
                if any(tuple(v[k : k + run]) in have for k in range(len(v) - run + 1)):
                    out.add((d, i))
    return out


def test_matches_brute_force(spark, monkeypatch):
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(25)]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, say(rnd.randrange(3, 30))) for i in range(40)] + [(90, None), (91, ""), (92, "w1 " * 14)]
    docs = []
    for d in range(150):
        t = say(rnd.randrange(0, 60))
        if d % 3 == 0:
            w = rnd.choice(items[:40])[1].split()
            k = rnd.randrange(len(w))
            t = f"{t} {' '.join(w[k : k + rnd.randrange(2, 16)])} {say(5)}"
        docs.append((d, t))
    docs += [(200, None), (201, ""), (202, "w1 " * 40_000), (203, docs[0][1]), docs[3], (None, docs[3][1])]
    d = spark.createDataFrame([(*x, "q", 1) for x in docs], "doc_id bigint, text string, terms string, positions int").repartition(3)
    i = spark.createDataFrame([(*x, "q") for x in items], "item_id bigint, text string, doc_id string")
    want = brute([x for x in docs if x[0] is not None], items, 5)
    assert want
    for block, chunk in ((1_500_000, 2_000), (300, 7)):
        monkeypatch.setattr(leakage, "BLOCK_WORDS", block)
        monkeypatch.setattr(leakage, "ITEM_CHUNK", chunk)
        got = [tuple(r) for r in leakage.leaked_items(d, i, run=5).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_eleven_words_are_not_enough(spark):
    w = ITEM.split()
    docs = [(1, " ".join(w[:11])), (2, " ".join(w[:12])), (3, " ".join([*w[:11], "other", *w[12:20]])), (4, " ".join(w[8:20]) + " more")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame([(7, ITEM)], "item_id bigint, text string")
    assert {r[0] for r in leakage.leaked_items(d, i).collect()} == {2, 4}
    assert leakage.leaked_items(d, i.limit(0)).count() == leakage.leaked_items(d.limit(0), i).count() == 0
    assert {r[0] for r in leakage.near_items(d, i, terms=4, span=12).collect()} == {3, 4}


def test_each_hyphen_is_read_for_itself(spark):
    docs = [
        (1, ITEM.replace("recorded", "recor-\nded").replace("lower spine", "lower-\nspine")),  # one joins, one parts
        (2, ITEM.replace("recorded", "re-\ncor-\nded").replace("turns first", "turns-\nfirst").replace("spine reaches", "spine-\nreaches")),
        (3, ITEM.replace("lower spine", "low-\ner-\nspine")),  # in one chain, one joins and one parts
        (4, ITEM.replace("recorded", "-\n".join("recorded"))),
        (5, " ".join(ITEM.split()[:11]) + "-\nx"),
    ]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame([(7, ITEM), (8, ITEM.replace("lower spine", "lower-\nspine"))], "item_id bigint, text string")
    assert {tuple(r) for r in leakage.leaked_items(d, i).collect()} == {(n, k) for n in (1, 2, 3, 4) for k in (7, 8)}


def test_chain_of_hyphens_longer_than_the_longest_is_linear():
    found, tied, joined = lattice("-\n".join("ab" for _ in range(3000)))
    assert len(found) == 3000 and len(tied) == 2999 and len(joined) < 16 * 3000
    assert max(n for _, n, _ in joined) == 3000


def test_one_index_serves_many_items(spark):
    rnd = random.Random(11)
    say = lambda n: " ".join(f"w{rnd.randrange(400)}" for _ in range(n))
    docs = [(d, say(200)) for d in range(100)]
    items = [(i, " ".join(docs[i % 100][1].split()[40:60])) for i in range(300)] + [(1000 + i, say(20)) for i in range(300)]
    index = leakage.build_index(spark.createDataFrame(docs, "doc_id bigint, text string"))
    got = {tuple(r) for r in leakage.leaked_in(index, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {(i % 100, i) for i in range(300)}
