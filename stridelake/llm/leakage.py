"""Passages of evaluation items inside training texts, by a positional inverted index.

The corpus is read once.  Each block of texts stores, for every term that occurs in it, the positions at which it
occurs, positions of different texts lying far apart; a block holds a bounded number of words.  The index is a table of its
own (``build_index``): its terms give each term's frequency over the corpus and the blocks that have it, and any number
of items can be looked up in it without another pass over the corpus.

An item is sent to the blocks that have the rarest term of one of its windows of ``RUN`` successive words.  There all windows are
looked up at once: those with a term the block lacks fall out; of the others the positions of the term rarest in
the block are taken, and the lists of the terms behind and before it are intersected with them, offset by offset, until
none is left or all agree, which is an exact phrase match.  Proximity matches are texts where the rarest terms of an
item lie within a short span in any order.

A hyphen at a line end may join a word or part two.  The index has the parted words and, at the same positions, every joined
one with the number of words it covers, so a phrase may read each hyphen either way.

Nothing is shuffled but terms, items and matches, so skew of sources or copies has no effect; a block meets its items in
shares of at most about ``ITEM_CHUNK``.

Defined results: null and empty texts or items contain no words and match nothing; an item of fewer than ``RUN``
words has no window and never matches; an item in which a hyphen ends a line is looked up with all of them joining and all
parting; rows repeated count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.words import lattice, readings, words
from stridelake.scratch import lookup, stored

RUN = 12
BLOCK_WORDS = 1_000_000
GAP = 64
ITEM_CHUNK = 20_000
NEAR_TERMS = 6
NEAR_SPAN = 40
SPACE = 1 << 40  # of positions, in keys made of a term's number and a position

INDEX = "block_id string, terms array<string>, counts array<bigint>, docs binary, starts binary, offsets binary, positions binary, tied binary, joined binary"


class _Writer:
    """One block in the making."""

    def __init__(self) -> None:
        self.docs: list[int] = []
        self.starts: list[int] = []
        self.spans: list[np.ndarray] = []
        self.words: list[str] = []
        self.again: list[str] = []  # further occurrences by the joined reading, for frequencies
        self.tied: list[int] = []
        self.joined: list[tuple[int, int, str]] = []
        self.end = 0

    def add(self, doc: int, text: str) -> None:
        found, tied, joined = lattice(text)
        self.docs.append(doc)
        self.starts.append(self.end)
        self.spans.append(np.arange(self.end, self.end + len(found)))
        self.words += found
        if tied:
            self.again += readings(text)[0]
            self.tied += [self.end + i for i in tied]
            self.joined += [(self.end + a, n, w) for a, n, w in joined]
        self.end += len(found) + GAP

    def row(self, block_id: str) -> pa.RecordBatch:
        n, m = len(self.words), len(self.joined)
        coded = pa.array([*self.words, *(w for _, _, w in self.joined), *self.again], pa.string()).dictionary_encode()
        code, terms = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        counts = np.bincount(np.r_[code[:n], code[n + m :]], minlength=len(terms))
        position = np.concatenate(self.spans) if self.spans else np.zeros(0, np.int64)
        order = np.argsort(code[:n], kind="stable")
        offsets = np.searchsorted(code[:n][order], np.arange(len(terms) + 1))
        joined = np.array([(code[n + i], a, k) for i, (a, k, _) in enumerate(self.joined)], np.int64).reshape(-1, 3)
        blobs = [np.array(self.docs, np.int64), np.array(self.starts, np.int64), offsets.astype(np.int64), position[order].astype(np.int64), np.array(self.tied, np.int64), joined]
        return pa.RecordBatch.from_arrays(
            [pa.array([block_id]), pa.array([terms.to_pylist()], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())), *(pa.array([b.tobytes()], pa.binary()) for b in blobs)],
            names=["block_id", "terms", "counts", "docs", "starts", "offsets", "positions", "tied", "joined"],
        )


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, made, block = TaskContext.get().partitionId(), 0, _Writer()
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            block.add(doc, text)
            if block.end >= BLOCK_WORDS:
                yield block.row(f"{part:06d}-{made:06d}")
                made, block = made + 1, _Writer()
    if block.docs:
        yield block.row(f"{part:06d}-{made:06d}")


def build_index(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional index of all texts over all their terms, as a stored table of blocks."""
    rows = documents.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).where("doc_id is not null and text is not null")
    return stored(rows.mapInArrow(_indexed, INDEX), "postings")


class _Block:
    """A block ready for lookups."""

    def __init__(self, row: dict) -> None:
        self.docs, self.starts, self.offsets, self.positions, self.tied = (np.frombuffer(row[k], np.int64) for k in ("docs", "starts", "offsets", "positions", "tied"))
        self.joined = np.frombuffer(row["joined"], np.int64).reshape(-1, 3)
        self.number = {t: i for i, t in enumerate(row["terms"])}
        term = np.repeat(np.arange(len(self.number)), np.diff(self.offsets))
        keys, spans = term * SPACE + self.positions, np.ones(len(term), np.int64)
        if len(self.joined):
            keys, spans = np.r_[keys, self.joined[:, 0] * SPACE + self.joined[:, 1]], np.r_[spans, self.joined[:, 2]]
            order = np.argsort(keys, kind="stable")
            keys, spans = keys[order], spans[order]
        self.keys, self.spans = keys, spans  # by (term, first position)
        ends = keys + spans
        order = np.argsort(ends, kind="stable")
        self.ends, self.of_end = ends[order], order  # by (term, position behind)
        self.since = np.searchsorted(keys, np.arange(len(self.number) + 1) * SPACE)

    def docs_at(self, positions: np.ndarray) -> np.ndarray:
        return self.docs[np.searchsorted(self.starts, positions, "right") - 1]

    def phrases(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n, run) numbers of terms, all of the block: every (window, position) at which its terms follow each other."""
        held = np.diff(self.since)[windows]
        rare = held.argmin(axis=1)
        row = np.arange(len(windows))
        many = held[row, rare]
        window = np.repeat(row, many)
        entry = np.repeat(self.since[windows[row, rare]] - np.cumsum(many) + many, many) + np.arange(many.sum())
        first = last = entry  # the entries of the first and last words that agree so far
        for step in range(1, windows.shape[1]):
            place = rare[window] + step  # behind the rarest
            behind = place < windows.shape[1]
            asked = windows[window[behind], place[behind]] * SPACE + self.keys[last[behind]] % SPACE + self.spans[last[behind]]
            at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
            fits = np.ones(len(window), bool)
            fits[behind] = self.keys[at] == asked
            last = last.copy()
            last[behind] = at
            window, first, last = window[fits], first[fits], last[fits]
            place = rare[window] - step  # before it
            before = place >= 0
            asked = windows[window[before], place[before]] * SPACE + self.keys[first[before]] % SPACE
            at = np.minimum(np.searchsorted(self.ends, asked), len(self.ends) - 1)
            fits = np.ones(len(window), bool)
            fits[before] = self.ends[at] == asked
            first = first.copy()
            first[before] = self.of_end[at]
            window, first, last = window[fits], first[fits], last[fits]
        return window, self.keys[first] % SPACE

    def lists(self, terms: list[str]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """Starts of texts and positions of each term: by the reading that parts at hyphens, and by the one that joins."""
        numbers = [self.number.get(t) for t in terms]
        if any(k is None for k in numbers):
            return
        parted = [self.positions[self.offsets[k] : self.offsets[k + 1]] for k in numbers]
        if all(map(len, parted)):
            yield self.starts, parted
        if len(self.tied):
            joins = lambda p: p - np.searchsorted(self.tied, p)
            whole = self.joined[~np.isin(self.joined[:, 1] - 1, self.tied) & ~np.isin(self.joined[:, 1] + self.joined[:, 2] - 1, self.tied)]
            pieces = np.union1d(self.tied, self.tied + 1)
            one = [np.sort(np.r_[joins(p[~np.isin(p, pieces)]), joins(whole[whole[:, 0] == k, 1])]) for p, k in zip(parted, numbers)]
            if all(map(len, one)):
                yield joins(self.starts), one


def _found(doc: np.ndarray, item: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([doc, item], axis=1), axis=0) if len(doc) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["doc_id", "item_id"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, list[dict]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
            yield _Block(row), row["items"]


def _phrases(run: int):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, items in _rows(batches):
            grids, owners = [], []
            for item in items:
                code = np.array([block.number.get(w, -1) for w in item["words"]], np.int64)
                if len(code) >= run:
                    grid = np.lib.stride_tricks.sliding_window_view(code, run)
                    grid = grid[(grid >= 0).all(axis=1)]
                    grids.append(grid)
                    owners.append(np.full(len(grid), item["item_id"], np.int64))
            if grids and sum(map(len, grids)):
                owner = np.concatenate(owners)
                window, at = block.phrases(np.concatenate(grids))
                yield _found(block.docs_at(at), owner[window])

    return look


def _spans(starts: np.ndarray, lists: list[np.ndarray], span: int) -> np.ndarray:
    """Places in ``starts`` of the texts in which some run of ``span`` words holds a position of every list, the first the rarest."""
    ends = []
    for have in lists:  # positions at which such a run may end: less than the span behind the rarest term
        since, upto = np.searchsorted(have, lists[0]), np.searchsorted(have, lists[0] + span)
        n = upto - since
        ends.append(have[np.repeat(since - np.cumsum(n) + n, n) + np.arange(n.sum())])
    high = np.unique(np.concatenate(ends))
    low = high
    for have in lists:  # the last occurrence of each term up to there
        at = np.searchsorted(have, high, "right") - 1
        kept = at >= 0
        high, low, at = high[kept], low[kept], at[kept]
        low = np.minimum(low, have[at])
    text = np.searchsorted(starts, high, "right") - 1
    return text[(high - low < span) & (low >= starts[text])]


def _near(span: int):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, items in _rows(batches):
            docs, owners = [], []
            for item in items:
                for starts, lists in block.lists(item["words"]):
                    d = np.unique(block.docs[_spans(starts, lists, span)])
                    docs.append(d)
                    owners.append(np.full(len(d), item["item_id"], np.int64))
            if docs:
                yield _found(np.concatenate(docs), np.concatenate(owners))

    return look


def _item_words(every: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, k, w) for i, t in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()) for k, w in enumerate(readings(t) if every else [words(t)])]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.list_(pa.string()))], names=["item_id", "reading", "words"])

    return run


ITEM = "item_id bigint, reading int, words array<string>"


def _rarest_of_windows(run: int):
    """Which terms an item is sent by: the rarest of each of its windows, of those whose terms are all known."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, found, known in zip(batch.column("item_key").to_pylist(), batch.column("words").to_pylist(), batch.column("known").to_pylist()):
                count = {t["term"]: t["n"] for t in known}
                ranks = [(count[w], w) if w in count else None for w in found]
                lacks = np.concatenate([[0], np.cumsum([r is None for r in ranks])])
                chosen = {min(ranks[i : i + run])[1] for i in range(len(found) - run + 1) if lacks[i + run] == lacks[i]}
                out += [(key, t, found) for t in chosen]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.list_(pa.string()))], names=["item_key", "term", "words"])

    return choose


def _rarest(terms: int):
    """An item's rarest known terms, the rarest first; it is sent by that one."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, known in zip(batch.column("item_key").to_pylist(), batch.column("known").to_pylist()):
                first = [t for _, t in sorted((t["n"], t["term"]) for t in known)[:terms]]
                out.append((key, first[0], first))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.list_(pa.string()))], names=["item_key", "term", "words"])

    return choose


def _looked_up(index: DataFrame, items: DataFrame, every: bool, choose, look) -> DataFrame:
    """items (item_id, text) sent to the blocks that may hold them, and looked up there."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    # the same words under one id are one query, told by their digest
    asked = rows.mapInArrow(_item_words(every), ITEM).where(F.size("words") > 0)
    asked = stored(asked.select("item_id", "words", F.sha2(F.concat_ws(" ", F.col("item_id").cast("string"), "words"), 256).alias("item_key")).dropDuplicates(["item_key"]), "items")
    used = stored(asked.select(F.explode("words").alias("term")).distinct(), "item-terms")
    entries = index.select("block_id", F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("n"))).alias("e")).select("block_id", "e.term", "e.n")
    entries = stored(lookup(entries, used, "term", "left_semi"), "entries")
    counts = stored(entries.groupBy("term").agg(F.sum("n").alias("n")), "frequencies")
    known = lookup(asked.select("item_key", F.explode(F.array_distinct("words")).alias("term")), counts, "term").groupBy("item_key").agg(F.collect_list(F.struct("term", "n")).alias("known"))
    sent = asked.join(known, "item_key").select("item_key", "words", "known").mapInArrow(choose, "item_key string, term string, words array<string>")
    routed = sent.join(entries.select("term", "block_id"), "term").dropDuplicates(["item_key", "block_id"])
    routed = routed.join(asked.select("item_key", "item_id"), "item_key")
    shares = max(1, -(-asked.count() // ITEM_CHUNK))
    share = F.pmod(F.xxhash64("item_key"), F.lit(shares))
    by_block = stored(routed.groupBy("block_id", share.alias("share")).agg(F.collect_list(F.struct("item_id", "words")).alias("items")).drop("share"), "items-by-block")
    return lookup(index, by_block, "block_id").mapInArrow(look, "doc_id bigint, item_id bigint").distinct()


def _items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    return items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))


def leaked_in(index: DataFrame, items: DataFrame, run: int = RUN) -> DataFrame:
    """``leaked_items`` of a corpus whose index is at hand; items: item_id, text."""
    return _looked_up(index, items, True, _rarest_of_windows(run), _phrases(run))


def leaked_items(documents: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", run: int = RUN) -> DataFrame:
    """(doc_id, item_id): the text contains at least ``run`` successive words of the item."""
    return leaked_in(build_index(documents), _items(items, item_id, text), run)


def near_in(index: DataFrame, items: DataFrame, terms: int = NEAR_TERMS, span: int = NEAR_SPAN) -> DataFrame:
    """``near_items`` of a corpus whose index is at hand; items: item_id, text."""
    return _looked_up(index, items, False, _rarest(terms), _near(span))


def near_items(documents: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", terms: int = NEAR_TERMS, span: int = NEAR_SPAN) -> DataFrame:
    """(doc_id, item_id): the rarest terms of the item that the corpus has lie within ``span`` words of the text, in any order; such texts may hold a reworded item.

    An item with fewer such terms is looked up by all it has.
    """
    return near_in(build_index(documents), _items(items, item_id, text), terms, span)
