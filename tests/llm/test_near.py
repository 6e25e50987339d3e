import random
from collections import Counter

import numpy as np
import pytest

from stridelake.llm import leakage
from stridelake.llm.words import readings, words


def brute(docs, items, terms, span):
    used = {w for _, s in items for w in words(s)}
    count = Counter(w for _, t in docs for found in readings(t) for w in found if w in used)
    out = set()
    for i, s in items:
        rare = set(sorted({w for w in words(s) if w in count}, key=lambda w: (count[w], w))[:terms])
        out |= {(d, i) for d, t in docs for found in readings(t) if rare and any(rare <= set(found[k : k + span]) for k in range(len(found)))}
    return out


@pytest.mark.parametrize("terms, span, block", [(3, 8, 1_500_000), (6, 15, 300), (4, 100, 1_500_000)])
def test_near_items_match_brute_force(spark, monkeypatch, terms, span, block):
    monkeypatch.setattr(leakage, "BLOCK_WORDS", block)
    rnd = random.Random(terms)
    vocabulary = [f"w{i}" for i in range(30)]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    docs = [(d, say(rnd.randrange(0, 70))) for d in range(120)] + [(300, "w1-\nw2 " + say(20))]
    items = [(i, say(rnd.randrange(1, 12)) + " unseen") for i in range(40)] + [(90, ""), (91, "unseen")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(r) for r in leakage.near_items(d, i, terms=terms, span=span).collect()]
    want = brute(docs, items, terms, span)
    assert want and len(got) == len(set(got)) and set(got) == want


def test_not_only_the_nearest_occurrence_counts():
    lists = [np.array([100]), np.array([75, 126]), np.array([128])]
    assert leakage._spans(np.array([0]), lists, 40).tolist() == [0]
