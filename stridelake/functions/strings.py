"""Name, key and caption functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stem(path: Column) -> Column:
    """Last part of a path without its last extension."""
    return F.regexp_replace(F.regexp_replace(path, r"^.*[/\\]", ""), r"\.[^.]*$", "")


def norm_key(value: Column) -> Column:
    """Letters and digits in lower case; of a path only its stem."""
    base = F.when(value.rlike(r"[/\\]"), stem(value)).otherwise(value)
    return F.regexp_replace(F.lower(base), "[^a-z0-9]+", "")


def safe_name(value: Column) -> Column:
    """Usable as a file name; ``unnamed`` where nothing is left."""
    clean = F.regexp_replace(F.regexp_replace(F.trim(value), r"[@.]+", "_"), r"[^A-Za-z0-9_-]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(clean, "_+", "_"), "^_|_$", ""), F.lit("")), F.lit("unnamed"))


def before_hash(line: Column) -> Column:
    return F.trim(F.substring_index(line, "#", 1))


def clean_sentence(text: Column) -> Column:
    """Single spaces, a capital at the start and a stop at the end; null where nothing is left."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    t = F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30))
    t = F.when(t.rlike(r"[.!?]$"), t).otherwise(F.concat(t, F.lit(".")))
    return F.when(F.trim(text) == "", None).otherwise(t)


def article(phrase: Column) -> Column:
    return F.when(F.lower(F.substring(phrase, 1, 1)).isin("a", "e", "i", "o", "u"), "an").otherwise("a")


def animal_phrase(key: Column) -> Column:
    """``red_wolf_female`` as ``female red wolf``."""
    parts = F.split(F.lower(key), "_")
    sex = F.element_at(parts, -1)
    rest = F.array_join(F.slice(parts, 1, F.size(parts) - 1), " ")
    return F.when((F.size(parts) > 1) & sex.isin("male", "female", "juvenile"), F.concat_ws(" ", sex, rest)).otherwise(F.array_join(parts, " "))


def spaced_action(value: Column) -> Column:
    """Underscores and camel case as words, numbers apart."""
    t = F.regexp_replace(value, "_", " ")
    t = F.regexp_replace(t, "([a-z])([A-Z])", "$1 $2")
    t = F.regexp_replace(t, "([A-Za-z])([0-9])", "$1 $2")
    t = F.regexp_replace(t, "([0-9])([A-Za-z])", "$1 $2")
    return F.lower(F.trim(F.regexp_replace(t, r"\s+", " ")))


def turn_of(action: Column) -> Column:
    """A trailing ``turnl``, ``turnr`` with degrees: struct(body, direction, degrees)."""
    pattern = r"(?i)^(.*?)_?turn([lr])(\d*)$"
    hit = action.rlike(pattern)
    return F.struct(
        F.when(hit, F.regexp_extract(action, pattern, 1)).otherwise(action).alias("body"),
        F.when(hit, F.when(F.lower(F.regexp_extract(action, pattern, 2)) == "l", "left").otherwise("right")).alias("direction"),
        F.when(hit, F.nullif(F.regexp_extract(action, pattern, 3), F.lit("")).cast("int")).alias("degrees"),
    )


def without_onspot(action: Column) -> Column:
    return F.regexp_replace(action, "(?i)_?onspot$", "")


# fixed values: words that decide an action's class, in the order they are tried
ACTION_CLASSES = (
    ("fight", ("fight", "attack")), ("climb", ("climb", "hang")), ("swim", ("swim", "dive")), ("run", ("run",)), ("walk", ("walk",)), ("turn", ("turn",)), ("jump", ("jump",)),
    ("food", ("drink", "eat", "graze")), ("rest", ("rest", "sleep", "idle")),
)


def action_class(action: Column) -> Column:
    out = None
    low = F.lower(action)
    for name, words in ACTION_CLASSES:
        hit = low.rlike("|".join(words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def object_key(raw_stem: Column) -> Column:
    """First part before ``__`` with each of its words capitalised."""
    parts = F.split(F.element_at(F.split(raw_stem, "__"), 1), "_")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 20)))), "_")


def without_counter(name: Column) -> Column:
    return F.regexp_replace(name, "_[0-9]+$", "")


def short_action(name: Column, animal: Column) -> Column:
    """The action of a name without the animal before it, joined by ``_`` or ``@``."""
    low, key = F.lower(name), F.lower(animal)
    begins = F.startswith(low, F.concat(key, F.lit("_"))) | F.startswith(low, F.concat(key, F.lit("@")))
    return F.when(begins, F.substring(name, F.length(key) + 2, F.lit(1 << 20))).otherwise(name)


def raw_stem_of_caption_file(name: Column) -> Column:
    """``animal__group_set__action`` from a caption file's name ``animal__group.set_action...``; null where the name has another form."""
    base = F.regexp_replace(name, r"(?i)(_keypoints)?(\.json)?\.txt$", "")
    pattern = r"^(.+?)__(animation(?:not)?motionextracted[^.]+)\.([A-Za-z0-9]+)_(.+)$"
    part = lambda k: F.regexp_extract(base, pattern, k)
    return F.when(base.rlike(pattern), F.concat(part(1), F.lit("__"), part(2), F.lit("_"), part(3), F.lit("__"), part(4)))


def stem_parts(raw_stem: Column) -> Column:
    """struct(animal, group, action) of a stem joined by ``__``; null where it does not have three parts."""
    p = F.split(raw_stem, "__", 3)
    return F.when(F.size(p) == 3, F.struct(p[0].alias("animal"), p[1].alias("group"), p[2].alias("action")))


def joint_words(name: Column) -> Column:
    """A joint's name as words: split at capitals and underscores, digits dropped, sides written out, single letters left out."""
    parts = F.split(F.regexp_replace(name, "(?<=.)([A-Z_])", "~$1"), "~")
    words = F.transform(parts, lambda p: F.lower(F.regexp_replace(p, "[_0-9]", "")))
    words = F.transform(words, lambda w: F.when(w == "l", "left").when(w == "r", "right").otherwise(w))
    return F.array_join(F.filter(words, lambda w: F.length(w) > 1), " ")


def hash_word(word: Column, size: int) -> Column:
    """SHA-256 of a word as one number modulo ``size``."""
    digits = F.split(F.sha2(word, 256), "")
    value = F.transform(F.filter(digits, lambda d: d != ""), lambda d: F.conv(d, 16, 10).cast("bigint"))
    return F.aggregate(value, F.lit(0).cast("bigint"), lambda a, d: (a * 16 + d) % size)


def is_float_text(value: Column) -> Column:
    return F.trim(value).rlike(r"^[-+]?[0-9]+\.[0-9]+$")


def is_number_text(value: Column) -> Column:
    return F.trim(value).rlike(r"^[0-9]+$")


def preview_name(place: Column, path: Column) -> Column:
    return F.concat(F.lpad(place.cast("string"), 5, "0"), F.lit("_"), stem(path), F.lit("_"), F.substring(F.md5(path), 1, 10), F.lit(".jpg"))


def length_mask(length: Column, longest: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(longest - 1)), lambda i: i < length)


CAPTION_RULES = (  # light clean-up of captions, in this order
    (r"\s+", " "), (r"\s+([,.;:!?])", "$1"), (r"([,.;:!?])\1+", "$1"), (r"(?i)\b(\w+) \1\b", "$1"), (r"(?i)\ba ([aeiou])", "an $1"), (r"(?i)\ban ([^aeiou\W])", "a $1"), (r"[.]$", ""),
)


def light_caption(text: Column) -> Column:
    out = F.trim(text)
    for pattern, by in CAPTION_RULES:
        out = F.regexp_replace(out, pattern, by)
    return F.trim(out)


def caption_reasons(text: Column, subject: Column) -> Column:
    """Why a caption may be rejected: names another subject, is raw text, is too short, repeats, or has odd marks."""
    low = F.lower(text)
    return F.array_compact(
        F.array(
            F.when(text.isNull() | (F.trim(text) == ""), "empty"), F.when(F.length(F.trim(text)) != F.length(text), "padded"), F.when(~F.contains(low, F.lower(F.substring_index(subject, "_", 1))), "other subject"),
            F.when(text.rlike(r"[_@#]|__"), "raw text"), F.when(F.size(F.split(F.trim(text), r"\s+")) < 3, "short"),
        )
    )
