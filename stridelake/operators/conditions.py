"""What a batch of clips is conditioned on: masks over joints and lengths, relations and statistics padded to a common size, and the choice of augmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drawn(key: Column, ways: Column | int) -> Column:
    """A whole number from 0 to ``ways`` - 1, by the digest of ``key``."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), ways if isinstance(ways, Column) else F.lit(ways)).cast("int")


def pair_mask(sizes: DataFrame, longest: int, size: str = "n_joints") -> DataFrame:
    """Rows (i, j, mask) of the (longest + 1) squared grid: set where neither place lies beyond the size; place 0 is the rest pose's."""
    places = F.explode(F.sequence(F.lit(0), F.lit(longest)))
    grid = sizes.withColumn("i", places).withColumn("j", places)
    return grid.withColumn("mask", ((F.col("i") <= F.col(size)) & (F.col("j") <= F.col(size))).cast("int"))


def padded_relation(cells: DataFrame, sizes: DataFrame, longest: int, key: str = "object_type") -> DataFrame:
    """cells (key, i, j, value) on the full grid of ``longest`` squared, 0 where there is none."""
    places = F.explode(F.sequence(F.lit(0), F.lit(longest - 1)))
    grid = sizes.select(key).withColumn("i", places).withColumn("j", places)
    return grid.join(cells, [key, "i", "j"], "left").withColumn("value", F.coalesce("value", F.lit(0)))


def padded_statistics(stats: DataFrame, sizes: DataFrame, longest: int, channels: int = 13, key: str = "object_type") -> DataFrame:
    """stats (key, joint, channel, mean, std) on the full grid: a mean of 0 and a deviation of 1 where there is none, so that padding stays 0 when normalised."""
    grid = sizes.select(key).withColumn("joint", F.explode(F.sequence(F.lit(0), F.lit(longest - 1)))).withColumn("channel", F.explode(F.sequence(F.lit(0), F.lit(channels - 1))))
    return grid.join(stats, [key, "joint", "channel"], "left").withColumns({"mean": F.coalesce("mean", F.lit(0.0)), "std": F.coalesce("std", F.lit(1.0))})


def augmentation(clip: Column, keeps_joints: Column, seed: int = 0) -> Column:
    """none, remove or add, each alike often; skeletons that must not grow draw among the first two.  A removal says its share, a tenth to three tenths."""
    way = drawn(F.concat_ws("|", clip, F.lit(str(seed))), F.when(keeps_joints, 2).otherwise(3))
    share = (drawn(F.concat_ws("|", clip, F.lit(str(seed)), F.lit("share")), 3) + 1) / 10
    return F.struct(F.when(way == 0, "none").when(way == 1, "remove").otherwise("add").alias("way"), F.when(way == 1, share).alias("share"))


def collated(clips: DataFrame, batch: str, size: int) -> DataFrame:
    """Per batch, longest clip first: ids, lengths, joint numbers, the common length and joint number, and each clip's length mask.  Batches hold ``size`` clips, so a row is bounded.

    clips: the batch column, motion_id, length, n_joints.
    """
    held = clips.groupBy(batch).agg(F.array_sort(F.collect_list(F.struct((-F.col("length")).alias("o"), "motion_id", "length", "n_joints"))).alias("c"), F.max("length").alias("longest"), F.max("n_joints").alias("most_joints"))
    held = held.where(F.size("c") <= size)
    mask = F.transform("c", lambda x: F.transform(F.sequence(F.lit(0), F.col("longest") - 1), lambda i: (i < x["length"]).cast("int")))
    return held.select(batch, F.transform("c", lambda x: x["motion_id"]).alias("motion_ids"), F.transform("c", lambda x: x["length"]).alias("lengths"), F.transform("c", lambda x: x["n_joints"]).alias("joints"), "longest", "most_joints", mask.alias("masks"))


def nullified(condition: Column) -> tuple[Column, Column]:
    """A condition without content: one 0 and a mask of one 0, whatever it held."""
    return F.array(F.lit(0.0)), F.array(F.lit(0))


def token_or_pad(text: Column, size: int, pad: int) -> tuple[Column, Column]:
    """A whole text as one token, by its hash; a missing one as the pad with a mask of 0."""
    from stridelake.functions.strings import hash_word

    return F.coalesce(hash_word(text, size), F.lit(pad)), text.isNotNull().cast("int")
