"""Texts that lost their end to a field limit or a broken transfer.

One pass reads each text's end: whether it closes (punctuation, closed markup, a signature or reference line), the
form of its last line, its last token if the text stops right behind a letter, and ends that can only be cuts
(half a character, an open tag, half an entity, a mark of omission behind an unfinished sentence).  The same
pass counts the words of the corpus, leaving out the tokens that texts stop at.

The words become a trie as a table of nodes: one row per prefix, with the occurrences of the word that ends
there and of the words that go on.  A last token that is a node but no word is an unknown proper prefix of known words: a cut inside a
word.  Only nodes that last tokens can ask for are made: a word is cut at the lengths that tokens with its first
``HEAD`` letters have, so a run of a million letters makes few nodes.  Distinct tokens are joined with the nodes by equality,
so no task holds the trie and copies of a text or a source with most texts cost nothing more.

Evidence of length and style is gathered per source: a source closes its sentences if most texts that end in running
text close, leaving out unclosed ones near the source's greatest length; there, running text that stops
unclosed is cut.  A source has a limit at every length, in characters or bytes, that far more of its distinct texts
have than the lengths next to it; a text of exactly that length is cut if it stops at a word that whole texts
never stop at, although the word is frequent enough that they should or is mostly the beginning of longer words.  A last line that is a proper prefix of a closing line common in
its source or in all texts, and not common itself, is cut; distinct texts count, so copies make no line common.

Defined results: null and blank texts are no case and not counted; null source is a source of its own; repeated rows
count once; the same text under several ids is judged each time; very long texts are read whole.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.scratch import lookup, sized, stored

CLOSED_SHARE = 0.7
NEAR_LIMIT = 0.9
LIMIT_PEAK = 5
LIMIT_TEXTS = 3
NEIGHBOURS = 10
EXPECTED_STOPS = 5
COMMON_CLOSER = 1000
HEAD = 3

ENDING = "kind string, word string, n bigint, doc_id bigint, source string, n_chars bigint, n_bytes bigint, closed boolean, certain boolean, form string, token string, line string, digest binary"

# fixed values: marks that stand for left-out text, closing signs, and elements that need no end tag
MARKS = ("…", "...", "[...]", "[…]", "(...)", "(…)", "[more]", "(more)", "[truncated]", "[cut]", "[continued]", "read more", "show more",
         "[suite]", "(suite)", "[à suivre]", "(à suivre)", "lire la suite", "voir plus", "[mehr]", "(mehr)", "[gekürzt]", "[fortsetzung folgt]", "weiterlesen", "mehr anzeigen", "mehr lesen",
         "[más]", "(más)", "[cortado]", "[continúa]", "(continúa)", "leer más", "ver más", "seguir leyendo")
LONGEST_MARK = max(map(len, MARKS)) + 8  # as the case of a letter may change its length
STOPS = ".!?。！？؟।"
WRAPS = "\"'»”’›)]}*_`"
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_ASCII_WORDS = re.compile("[A-Za-z]+")
_LAST = regex.compile(r"(?r)\p{L}[\p{L}\p{M}]*$")
_UNSEEN = regex.compile(r"[\p{Cf}--[\n]]", regex.V1)
_ANY_TAG = regex.compile(r"<[^<>]*>?")
_ELEMENT = regex.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*?)?(/?)>")
_OPEN_TAG = regex.compile(r"<(?:/?[a-zA-Z][^<>]*|/|!-{0,2}[^<>]*)?$")
_HALF_ENTITY = regex.compile(r"&#?[a-zA-Z0-9]{0,8}$")
_BULLET = regex.compile(r"^\s*(?:[-*•+]|\d{1,3}[.)])\s")
_ROW = regex.compile(r"\s\|\s|\t|^\|")
_PAIR = regex.compile(r"^\s*\S+(?:\s\S+)?:\s+\S+(?:\s\S+){0,3}$")
_SIGNED = regex.compile(r"^\s*(?:[—–]|--)\s?\S+(?:\s\S+){0,3}$|^\s*\([^()]{1,60}\)$")
_TAGGED = regex.compile(r"\s\[[^\[\]\s]{1,12}\]$")
_DIGIT = regex.compile(r"\d")
_SYMBOL = regex.compile(r"[\p{So}\p{Sk}‍️]$|[:;]-?[)(DP]$")


def _markup(text: str) -> tuple[bool, bool]:
    """Whether the text is marked up, and whether its markup was left open."""
    if "<" not in text:
        return False, False
    open_elements: list[str] = []
    marked = False
    for end, name, empty in _ELEMENT.findall(text):
        name = name.lower()
        marked = True
        if end:
            if name in open_elements:
                while open_elements.pop() != name:
                    pass
        elif not empty and name not in VOID:
            open_elements.append(name)
    return marked, marked and (bool(open_elements) or bool(_OPEN_TAG.search(text)))


def ending(text: str) -> tuple[bool, bool, str, str | None, str]:
    """closed, certain (a cut by itself), form of the last line, last token where the text stops behind a letter, last line, where it is not closed running text, with digits as #."""
    whole = (text if text.isascii() else _UNSEEN.sub("", text)).rstrip()
    if whole[-1] == "�" or "\ud800" <= whole[-1] <= "\udfff":
        return False, True, "text", None, ""
    marked, left_open = _markup(whole)
    half = marked and bool(_HALF_ENTITY.search(whole))
    body = whole
    if marked:
        body = html.unescape(_ANY_TAG.sub("", whole)).rstrip() or whole
    omitted = False
    while body[-LONGEST_MARK:].lower().endswith(MARKS):
        body = next(body[: -len(m)] for m in MARKS if body[-LONGEST_MARK:].lower().endswith(m)).rstrip()
        omitted = True
    if not omitted and body.endswith("]"):
        body = _TAGGED.sub("", body).rstrip()
    line = body.rsplit("\n", 1)[-1].strip() if body else ""
    bare = body.rstrip(WRAPS + " ")
    closed = bool(bare) and bare[-1] in STOPS or marked and not left_open and not half and not omitted
    if _BULLET.search(line) or _ROW.search(line) or _PAIR.search(line):
        form = "list"
    elif _SIGNED.search(line):
        form = "sign"
    elif _SYMBOL.search(body[-4:]):
        form = "sign"
    else:
        form = "text"
    last = _LAST.search(body)
    token = last.group().casefold() if last and not closed else None
    return closed, left_open or half or (omitted and not closed), form, token, _DIGIT.sub("#", line) if form != "text" or not closed else ""


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One reading of the texts: a row for each text's end, and the words of a batch with their counts, without the token an unclosed text stops at."""
    names = ["kind", "word", "n", "doc_id", "source", "n_chars", "n_bytes", "closed", "certain", "form", "token", "line", "digest"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.binary()]
    for batch in batches:
        out = []
        seen: Counter[str] = Counter()
        for doc, source, text in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "source", "text"))):
            raw = text.encode("utf-8", "surrogatepass")
            half = text.rstrip("\ufffd")
            out.append((doc, source, len(text), len(raw) if len(half) == len(text) else len(half.encode("utf-8", "surrogatepass")), *ending(text), hashlib.md5(raw).digest()))
            clean = text if text.isascii() else _UNSEEN.sub("", text)
            clean = (_ANY_TAG.sub(" ", clean) if "<" in clean else clean).rstrip()
            found = (_ASCII_WORDS if clean.isascii() else _WORDS).findall(clean)
            if found and (clean[-1].isalpha() or clean[-1] == "\ufffd" or clean[-LONGEST_MARK:].lower().endswith(MARKS)):
                found.pop()
            seen.update(found)
        folded: Counter[str] = Counter()
        for w, n in seen.items():
            folded[w.casefold()] += n
        yield pa.RecordBatch.from_arrays([pa.array(["end"] * len(out)), pa.nulls(len(out), pa.string()), pa.nulls(len(out), pa.int64()), *(pa.array([r[i] for r in out], k) for i, k in enumerate(kinds[3:]))], names=names)
        m = len(folded)
        yield pa.RecordBatch.from_arrays([pa.array(["word"] * m, pa.string()), pa.array(list(folded), pa.string()), pa.array(list(folded.values()), pa.int64()), *(pa.nulls(m, k) for k in kinds[3:])], names=names)


def trie(words: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """The nodes of the vocabulary: every distinct prefix (of ``tokens`` (node), if given, those they may ask for), the occurrences of the word that ends there (0: none), and of the words that go on."""
    words = words.where("length(word) > 0")
    if tokens is None:
        ways = words.withColumn("lengths", F.sequence(F.lit(1), F.length("word")))
    else:
        head = lambda c: F.substring(c, 1, HEAD)
        asked = stored(tokens.select(head("node").alias("head"), F.length("node").alias("k")).groupBy("head").agg(F.collect_set("k").alias("lengths")), "heads")
        # a token shorter than HEAD has a head that is shorter too: a word meets the heads of each length
        ways = words.withColumn("head", F.explode(F.array_distinct(F.array(*[F.substring("word", 1, k) for k in range(1, HEAD + 1)]))))
        ways = lookup(ways, asked, "head").withColumn("lengths", F.filter("lengths", lambda k: k <= F.length("word")))
    node = F.explode(F.transform("lengths", lambda i: F.struct(F.substring(F.col("word"), F.lit(1), i).alias("node"), (i < F.length("word")).alias("goes_on"))))
    return ways.select("n", node.alias("p")).groupBy("p.node").agg(F.sum(F.when(~F.col("p.goes_on"), F.col("n")).otherwise(0)).alias("n_word"), F.sum(F.when(F.col("p.goes_on"), F.col("n")).otherwise(0)).alias("n_below"))


def _limits(ends: DataFrame, length: str) -> DataFrame:
    """source, at: every length that far more distinct texts of the source have than its neighbouring lengths."""
    per = ends.select("source", length, "digest").distinct().groupBy("source", length).agg(F.count(F.lit(1)).alias("k"))
    by_length = W.partitionBy("source").orderBy(length)  # one row per length a source has
    around = F.array_sort(F.concat(F.collect_list("k").over(by_length.rowsBetween(-NEIGHBOURS, -1)), F.collect_list("k").over(by_length.rowsBetween(1, NEIGHBOURS))))
    usual = F.coalesce(F.get("around", F.floor(F.size("around") / 2).cast("int")), F.lit(0))
    return per.withColumn("around", around).where((F.col("k") >= LIMIT_TEXTS) & (F.col("k") >= LIMIT_PEAK * usual)).select("source", F.col(length).alias("at"))


def _closers(ends: DataFrame) -> DataFrame:
    """scope, line_key, cut_line: lines that close texts (false), and lines that are a proper prefix of one (true).

    A scope is a source, or all texts (``*``).  Distinct texts count, so copies of one text make no line common.
    """
    scoped = ends.withColumn("scope", F.explode(F.array("own", F.lit("*"))))
    sizes = sized(stored(scoped.select("scope", "digest").distinct().groupBy("scope").agg(F.count(F.lit(1)).alias("n")), "texts"))
    lines = scoped.where("form <> 'text' or not closed").where("line <> ''")
    counts = stored(lines.select("scope", "line_key", "line_length", "digest").distinct().groupBy("scope", "line_key", "line_length").agg(F.count(F.lit(1)).alias("k")), "ending-lines")
    common = stored(counts.join(sizes, "scope").where((F.col("k") >= LIMIT_TEXTS) & (F.col("k") * COMMON_CLOSER >= F.col("n"))).select("scope", "line_key"), "common-lines")
    # the common lines are cut at the lengths that lines of their scope have, and the pieces found again by their keys
    whole = lines.join(sized(common), ["scope", "line_key"]).groupBy("scope", "line_key").agg(F.first("line").alias("line"), F.first("line_length").alias("upto"))
    lengths = sized(stored(counts.select("scope", "line_length").distinct(), "line-lengths"))
    pieces = whole.drop("line_key").join(lengths, "scope").where("line_length < upto").select("scope", _key(F.col("line").substr(F.lit(1), F.col("line_length"))).alias("line_key")).distinct()
    closing = common.withColumn("cut_line", F.lit(False))
    cut = counts.select("scope", "line_key").join(pieces, ["scope", "line_key"], "left_semi").join(sized(common), ["scope", "line_key"], "left_anti")
    return closing.unionByName(cut.withColumn("cut_line", F.lit(True)))


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def judged(documents: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per non-blank text: doc_id, source, cut, and the evidence (certain, word, sentence, closer, limit)."""
    rows = documents.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.where("doc_id is not null and text is not null").where(F.col("text").rlike(r"[^\s\p{Z}\p{C}]"))
    read = rows.mapInArrow(_read, ENDING).withColumns({"own": F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")), "line_key": _key(F.col("line")), "line_length": F.length("line")})
    read = stored(read, "read-texts", ["kind"])
    ends = read.where("kind = 'end'").drop("kind", "word", "n")
    words = stored(read.where("kind = 'word'").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    tokens = ends.where("token is not null").select(F.col("token").alias("node")).distinct()
    tokens = stored(tokens, "tokens")
    halves = stored(lookup(trie(words, tokens), tokens, "node").select(F.col("node").alias("token"), "n_word", "n_below"), "last-words")

    longest = ends.groupBy("source").agg(F.max("n_chars").alias("longest"))
    limits = [stored(_limits(ends, k), f"limits-{k}") for k in ("n_chars", "n_bytes")]
    style = stored(
        ends.join(sized(stored(longest, "longest")).withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).where("form = 'text'").groupBy("source")
        .agg(F.count_if("closed").alias("closes"), F.count_if(~F.col("closed") & (F.col("n_chars") < NEAR_LIMIT * F.col("longest"))).alias("leaves"))
        .select("source", (F.col("closes") >= CLOSED_SHARE * (F.col("closes") + F.col("leaves"))).alias("closing")),
        "styles",
    )

    closers = stored(_closers(ends), "closers")

    out = ends.join(sized(style).withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    for i, (limit, length) in enumerate(zip(limits, ("n_chars", "n_bytes"))):
        found = sized(limit).select(F.col("source").alias("s"), F.col("at").alias(f"at{i}"))
        out = out.join(found, F.col("source").eqNullSafe(F.col("s")) & (F.col(length) == F.col(f"at{i}")), "left").drop("s")
    out = out.withColumn("at_limit", F.col("at0").isNotNull() | F.col("at1").isNotNull())
    # tokens, and lines in a scope, are unique on the right, so these joins add no rows
    out = out.join(sized(halves), "token", "left")
    everywhere = F.col("scope") == "*"
    for name, found in (("cut_own", sized(closers).where(~everywhere)), ("cut_all", sized(closers).where(everywhere))):
        found = found.select(F.col("scope").alias("at_scope"), F.col("line_key").alias("at_key"), F.col("cut_line").alias(name))
        same = F.col("line_key") == F.col("at_key")
        out = out.join(found, same & (F.col("own") == F.col("at_scope")) if name == "cut_own" else same, "left").drop("at_scope", "at_key")
    out = out.withColumn("cut_line", F.least("cut_own", "cut_all"))  # a line that closes in either scope is whole
    open_end = ~F.col("closed") & F.coalesce("cut_line", F.lit(True))
    evidence = {
        "certain": F.col("certain"),
        "word": open_end & F.coalesce((F.col("n_word") == 0) & (F.col("n_below") > 0), F.lit(False)),
        "sentence": open_end & (F.col("form") == "text") & F.coalesce("closing", F.lit(False)),
        "closer": open_end & F.coalesce("cut_line", F.lit(False)),
    }
    out = stored(out.withColumns(evidence).withColumn("open_end", open_end), "judging")
    sound = out.where("token is not null and not (certain or word or sentence or closer)")
    stops = stored(sound.where("not at_limit and form <> 'list'").groupBy("token").agg(F.count(F.lit(1)).alias("stops_at")), "stops")
    n_words, n_stops = words.agg(F.sum("n")).first()[0] or 1, stops.agg(F.sum("stops_at")).first()[0] or 0
    never = F.col("stops_at").isNull() & ((F.col("n_below") > F.col("n_word")) | (F.col("n_word") * n_stops >= EXPECTED_STOPS * n_words))
    limit = F.col("open_end") & F.col("at_limit") & F.col("token").isNotNull() & F.coalesce(never, F.lit(False))
    out = out.join(sized(stops), "token", "left").select("doc_id", "source", *evidence, limit.alias("limit"))
    return out.withColumn("cut", F.greatest(*evidence, "limit"))


def truncated(documents: DataFrame) -> DataFrame:
    """doc_id of every text that lost its end."""
    return judged(documents).where("cut").select("doc_id").distinct()


def source_shares(documents: DataFrame) -> DataFrame:
    """Per source: texts, cut texts, and their share."""
    per_text = judged(documents).groupBy("doc_id", "source").agg(F.max("cut").alias("cut"))
    return per_text.groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), F.count_if("cut").alias("n_cut")).withColumn("share", F.round(F.col("n_cut") / F.col("n_texts"), 6))
