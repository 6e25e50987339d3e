"""Captions from action names, their review, and paraphrases: column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions import strings as T

# fixed values: what an action's first word says an animal does
PREDICATES = {
    "walk": "walks", "run": "runs", "trot": "trots", "canter": "canters", "gallop": "gallops", "swim": "swims", "climb": "climbs", "jump": "jumps", "sleep": "sleeps", "nap": "naps", "eat": "eats", "drink": "drinks",
    "idle": "stands idle", "stand": "stands", "look": "looks", "groom": "grooms itself", "shake": "shakes itself", "stretch": "stretches", "roll": "rolls over", "dig": "digs", "burrow": "burrows", "pounce": "pounces", "limp": "limps",
    "back": "backs away", "land": "lands", "take": "takes off", "glide": "glides", "scratch": "scratches", "call": "calls out", "attack": "attacks", "turn": "turns", "rest": "rests", "sidestep": "steps aside",
}


def subject(object_type: Column) -> Column:
    """``an agile`` style subject: article and animal, sex or age first."""
    phrase = T.animal_phrase(object_type)
    return F.concat_ws(" ", T.article(phrase), phrase)


def predicate(action: Column) -> Column:
    """What the animal does, by the action's first word; else ``performs`` and the action's words."""
    words = T.spaced_action(action)
    first = F.substring_index(words, " ", 1)
    table = F.create_map(*[F.lit(x) for kv in PREDICATES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, first), F.concat(F.lit("performs "), words))


def with_draft(rows: DataFrame, object_type: str, action: str) -> DataFrame:
    """Rows with ``draft``: a sentence for the action's name, from one state to another, turning, on the spot, or plain.

    Each stage is a select of its own, which keeps the generated code small.
    """
    keep = rows.columns
    t = rows.withColumn("_turn", T.turn_of(F.col(action))).withColumn("_body", T.without_onspot(F.col("_turn.body"))).withColumn("_pair", F.split("_body", "_to_", 2))
    t = t.withColumns({"_from": T.spaced_action(F.col("_pair")[0]), "_to": T.spaced_action(F.get("_pair", F.lit(1))), "_does": predicate(F.col("_body")), "_who": T.animal_phrase(F.col(object_type))})
    said = F.when(F.size("_pair") == 2, F.concat(F.lit("goes from "), "_from", F.lit(" to "), "_to")).otherwise(F.col("_does"))
    about = F.when(F.col("_turn.degrees").isNotNull(), F.concat(F.lit(" about "), F.col("_turn.degrees").cast("string"), F.lit(" degrees"))).otherwise("")
    turning = F.when(F.col("_turn.direction").isNotNull(), F.concat(F.lit(" while turning "), F.col("_turn.direction"), about)).otherwise("")
    spot = F.when(F.lower(action).endswith("onspot"), " on the spot").otherwise("")
    t = t.withColumn("_raw", F.concat(T.article(F.col("_who")), F.lit(" "), "_who", F.lit(" "), said, turning, spot))
    return t.select(*keep, T.clean_sentence(F.col("_raw")).alias("draft"))


def review(text: Column, object_type: Column) -> Column:
    """struct(text, reasons, rejected): the cleaned caption, why it is doubtful, and whether it names another subject or is raw text."""
    reasons = T.caption_reasons(text, object_type)
    cleaned = T.clean_sentence(T.light_caption(text))
    bad = F.arrays_overlap(reasons, F.array(F.lit("empty"), F.lit("other subject"), F.lit("raw text")))
    return F.struct(cleaned.alias("text"), reasons.alias("reasons"), F.coalesce(bad, F.lit(True)).alias("rejected"))


def with_paraphrases(rows: DataFrame, object_type: str, action: str, most: int) -> DataFrame:
    """Rows with ``paraphrases``: sentences that say the same with other subjects and frames, without repeats, at most ``most``."""
    keep = rows.columns
    t = rows.withColumns({"_who": T.animal_phrase(F.col(object_type)), "_does": predicate(F.col(action))}).withColumn("_art", T.article(F.col("_who")))
    tail = F.concat(F.col("_who"), F.lit(" "), F.col("_does"))
    forms = F.array(
        F.concat(F.lit("the "), tail), F.concat(F.col("_art"), F.lit(" "), tail), F.concat(F.lit("in this clip the "), tail), F.concat(F.lit("a motion in which the "), tail),
        F.concat(F.lit("the animal, "), F.col("_art"), F.lit(" "), F.col("_who"), F.lit(", "), F.col("_does")),
    )
    t = t.withColumn("_forms", forms)
    return t.select(*keep, F.slice(F.array_distinct(F.transform("_forms", T.clean_sentence)), 1, most).alias("paraphrases"))
