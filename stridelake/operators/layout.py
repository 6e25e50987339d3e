"""Upkeep of folders and manifests: paths, indexes over file names, filters, mappings with precedence, selections and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.functions.strings import norm_key, stem, without_counter

# fixed values: endings of caption files, the longest first; names of joints that are measured, left out, or stand on the ground; actions that need review; actions preferred as samples
TEXT_SUFFIXES = ("_keypoints.json.txt", "_keypoints.txt", ".json.txt", ".txt")
SCALE_TOKENS = ("spine2", "spine3", "chest_joint", "neck1", "neck2", "head_joint", "frontlegupr_joint", "frontleglwr_joint", "frontfoot_joint", "rearlegupr_joint", "rearleglwr_joint", "rearfoot_joint")
SCALE_EXCLUDED = ("end_site", "twist", "srb", "breath")
GROUND_TOKENS = ("toe", "foot", "hoof", "ashi")
HIGH_RISK = ("eat", "drink", "trough", "graze", "swimtreadwater", "enrichment", "idle", "jumpin", "jumpout")
PREFERRED = ("walkbase", "runbase", "walk", "run", "turn", "swimbase", "idle")


def basename(path: Column) -> Column:
    return F.regexp_replace(path, r"^.*[/\\]", "")


def any_token(text: Column, tokens: tuple[str, ...]) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for t in tokens:
        out = out | F.contains(low, F.lit(t))
    return out


def source_key(name: Column, suffixes: tuple[str, ...] = TEXT_SUFFIXES) -> Column:
    """A caption file's name without the first of the suffixes that it ends in; the stem where it has none."""
    base, out = basename(name), None
    for s in suffixes:
        hit, cut = F.endswith(F.lower(base), F.lit(s)), F.left(base, F.length(base) - len(s))
        out = F.when(hit, cut) if out is None else out.when(hit, cut)
    return out.otherwise(stem(name))


def caption_records(lines: DataFrame, path: str, place: str, line: str) -> DataFrame:
    """Per caption file: source_key, captions in order without repeats, sorted distinct animals and sexes, tagged lines.

    A line of at least three fields parted by ``#`` is animal, sex, caption and tags; any other is a caption as a whole.  Files without a caption are left out.
    """
    text = F.trim(F.col(line))
    rows = lines.select(F.col(path).alias("path"), F.col(place).alias("place"), text.alias("line")).where("line <> ''").withColumn("p", F.split("line", "#"))
    full = F.size("p") >= 3
    field = lambda i: F.trim(F.get("p", F.lit(i)))
    caption = F.trim(F.regexp_replace(F.when(full, field(2)).otherwise(F.col("line")), r"\s+", " "))
    rows = rows.select("path", "place", F.nullif(caption, F.lit("")).alias("caption"), F.when(full, F.nullif(field(0), F.lit(""))).alias("animal"), F.when(full, F.nullif(field(1), F.lit(""))).alias("sex"), F.when(full, F.nullif(field(3), F.lit(""))).alias("tag"))
    held = rows.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("place", "caption", "tag"))).alias("r"), F.array_sort(F.collect_set("animal")).alias("animals"), F.array_sort(F.collect_set("sex")).alias("sexes"))
    pick = lambda k: F.array_compact(F.transform("r", lambda x: x[k]))
    return held.select("path", source_key(F.col("path")).alias("source_key"), F.array_distinct(pick("caption")).alias("captions"), "animals", "sexes", pick("tag").alias("tagged")).where("size(captions) > 0")


def last_by_key(records: DataFrame, key: Column, order: str) -> DataFrame:
    """One record per normalised key: the last in ``order``."""
    rows = records.withColumn("norm", norm_key(key))
    return rows.groupBy("norm").agg(F.max_by(F.struct(*records.columns), F.col(order)).alias("r")).select("norm", "r.*")


def stem_index(paths: DataFrame, path: str) -> DataFrame:
    """stem, path: of files with one stem the last path."""
    return paths.groupBy(stem(F.col(path)).alias("stem")).agg(F.max(path).alias("path"))


def processed_index(paths: DataFrame, path: str, owner: str) -> DataFrame:
    """raw_stem, paths: processed files, whose names are ``<owner>_<raw stem>_<counter>``, by raw stem; other names are left out."""
    s, prefix = stem(F.col(path)), F.concat(F.col(owner), F.lit("_"))
    rows = paths.where(F.startswith(s, prefix)).select(without_counter(F.substring(s, F.length(prefix) + 1, F.lit(1 << 20))).alias("raw_stem"), F.col(path).alias("path"))
    return rows.groupBy("raw_stem").agg(F.array_sort(F.collect_set("path")).alias("paths"))


def layout_kind(paths: DataFrame, path: str) -> DataFrame:
    """root, kind: pooled where a root holds ``motions`` itself, per_object where folders below it do."""
    found = paths.select(F.regexp_extract(path, "^([^/]+)/(.*)$", 1).alias("root"), F.regexp_extract(path, "^([^/]+)/(.*)$", 2).alias("rest")).where("root <> ''")
    return found.groupBy("root").agg(F.when(F.max(F.startswith("rest", F.lit("motions/"))), "pooled").otherwise("per_object").alias("kind"), F.count(F.lit(1)).alias("n_files"))


def pooled_paths(rows: DataFrame, path: str, root: str) -> DataFrame:
    """The row's motion, skeleton and preview files in the pooled layout."""
    name = basename(F.col(path))
    base = F.regexp_replace(name, r"\.[^.]*$", "")
    return rows.withColumns({"motion": F.concat(F.lit(f"{root}/motions/"), name), "skeleton": F.concat(F.lit(f"{root}/bvhs/"), base, F.lit(".bvh")), "preview": F.concat(F.lit(f"{root}/animations/"), base, F.lit("_from_ric.mp4"))})


def newest(paths: DataFrame, path: str, by: list[str]) -> DataFrame:
    """Per group the file with the greatest number at the end of its stem."""
    number = F.regexp_extract(stem(F.col(path)), "([0-9]+)$", 1).try_cast("bigint")
    return paths.withColumn("number", number).where("number is not null").groupBy(*by).agg(F.max_by(path, F.struct("number", path)).alias("path"), F.max("number").alias("number"))


def chosen(rows: DataFrame, key: str, wanted: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Rows whose key is in the list of ``wanted`` (blank entries do not count); with an empty list all but the excluded."""
    names = wanted.select(F.trim(F.col(wanted.columns[0])).alias(key)).where(F.col(key) != "").distinct()
    if names.limit(1).count():
        return rows.join(names, key, "left_semi")
    return rows if excluded is None else rows.join(excluded.select(F.col(excluded.columns[0]).alias(key)).distinct(), key, "left_anti")


def mapped(rows: DataFrame, key: str, manifest: DataFrame, guess: Column) -> DataFrame:
    """owner, origin: what the manifest says of a key; the guess only where the manifest says nothing of it, and nothing at all where neither does."""
    said = manifest.select(key, F.col("owner").alias("said"), F.lit(True).alias("listed"))
    return rows.join(said, key, "left").withColumns({"owner": F.when(F.col("listed"), F.col("said")).otherwise(guess), "origin": F.when(F.col("listed"), "manifest").when(guess.isNotNull(), "guess").otherwise("none")}).drop("said", "listed")


def resolved(rows: DataFrame, keys: list[str], assets: DataFrame, fallback: DataFrame, order: list[Column]) -> DataFrame:
    """Per owner the first row, in ``order``, with an asset of its own (origin ``listed``), or with the only fallback asset of its group (``inferred``).

    assets: keys, asset; fallback: group, asset (a group with several assets gives none); rows: owner, keys, group.
    """
    only = fallback.groupBy("group").agg(F.count_distinct("asset").alias("n"), F.min("asset").alias("spare")).where("n = 1").drop("n")
    met = rows.join(assets, keys, "left").join(only, "group", "left").withColumns({"origin": F.when(F.col("asset").isNotNull(), "listed").when(F.col("spare").isNotNull(), "inferred"), "asset": F.coalesce("asset", "spare")}).drop("spare")
    rest = [c for c in met.columns if c != "owner"]
    return met.where("asset is not null").groupBy("owner").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select("owner", "r.*")


def prefer_actions(name: Column, preferred: tuple[str, ...] = PREFERRED) -> Column:
    """0 for names with a preferred action, 1 for others."""
    return F.when(any_token(name, preferred), 0).otherwise(1)


def selected(rows: DataFrame, name: str, prefix: str, pattern: str, most: int, names: list[str] | None = None) -> DataFrame:
    """The first ``most`` names of a list, or by prefix and pattern (any case)."""
    hit = F.col(name).isin(names) if names else F.startswith(name, F.lit(prefix)) & F.col(name).rlike(f"(?i){pattern}")
    return rows.where(hit).orderBy(name).limit(most)


def page(rows: DataFrame, order: str, start: int, most: int) -> DataFrame:
    return rows.orderBy(order).offset(start).limit(most)


def largest_sample(rows: DataFrame, size: str, name: str, most: int) -> DataFrame:
    """The rows of greatest size, marked as a sample, which no gate may pass."""
    return rows.orderBy(F.desc(size), name).limit(most).withColumn("sampled", F.lit(True))


def scale_joints(joints: DataFrame) -> DataFrame:
    """Joints (name, ox, oy, oz) that are measured for the scale: named by a token, not left out by another, not the root, and off their parent."""
    length = F.sqrt(F.col("ox") ** 2 + F.col("oy") ** 2 + F.col("oz") ** 2)
    return joints.where((F.col("joint") > 0) & (length > 1e-8) & any_token(F.col("name"), SCALE_TOKENS) & ~any_token(F.col("name"), SCALE_EXCLUDED))


def ground_joints(joints: DataFrame) -> DataFrame:
    return joints.where(any_token(F.col("name"), GROUND_TOKENS))


def declared_joints(joints: DataFrame, prefix: str) -> DataFrame:
    """Per object_type whose name begins with ``prefix`` the scale and ground joints by name; null lists for all others."""
    per = joints.groupBy("object_type").agg(F.lit(1).alias("one"))
    lists = lambda df, k: df.where(F.startswith("object_type", F.lit(prefix))).groupBy("object_type").agg(F.array_sort(F.collect_set("joint")).alias(k))
    ours = F.startswith("object_type", F.lit(prefix))
    empty = F.array().cast("array<int>")
    out = per.join(lists(scale_joints(joints), "scale"), "object_type", "left").join(lists(ground_joints(joints), "ground"), "object_type", "left")
    return out.select("object_type", *(F.when(ours, F.coalesce(k, empty)).alias(k) for k in ("scale", "ground")))


def without_prefixes(name: Column, prefixes: list[str]) -> Column:
    """A joint's name without each of the prefixes, tried in order, each once."""
    for p in prefixes:
        name = F.when(F.startswith(name, F.lit(p)), F.substring(name, len(p) + 1, 1 << 20)).otherwise(name)
    return name


def owner_of(key: Column, source_file: Column) -> Column:
    """The text before ``_<stem of the source file>_`` in a key, else the key without its last two parts."""
    at = F.call_function("locate", F.concat(F.lit("_"), stem(source_file), F.lit("_")), key)
    return F.when(at > 1, F.left(key, at - 1)).otherwise(F.regexp_extract(key, "^(.*?)(?:_[^_]+)?_[0-9]+$", 1))


def manifest_totals(parts: list[DataFrame], owner: str) -> DataFrame:
    """Several manifests as one: per owner the rows and in how many of the manifests it stands."""
    out = None
    for i, p in enumerate(parts):
        rows = p.select(F.col(owner).alias("owner"), F.lit(i).alias("part"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("owner").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("part").alias("n_parts"))


def vertex_summary(points: DataFrame, by: list[str], xyz: tuple[str, str, str]) -> DataFrame:
    """Per group: points, whether all are finite, and least, greatest and mean of each axis over the finite ones."""
    fine = F.lit(True)
    for c in xyz:
        fine = fine & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    of = lambda f, c: f(F.when(fine, F.col(c)))
    return points.groupBy(*by).agg(F.count(F.lit(1)).alias("n_points"), F.min(fine).alias("finite"), *(of(f, c).alias(f"{n}_{c}") for c in xyz for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))))


def audit_totals(results: DataFrame, status: str, error: str, passing: str = "pass") -> DataFrame:
    """Per status: rows and the greatest error; the range of errors over the passing ones on every row."""
    ok = F.when(F.col(status) == passing, F.col(error))
    whole = results.agg(F.min(ok).alias("least_passing"), F.max(ok).alias("most_passing"))
    return results.groupBy(status).agg(F.count(F.lit(1)).alias("n_rows"), F.max(error).alias("max_error")).join(F.broadcast(whole))
