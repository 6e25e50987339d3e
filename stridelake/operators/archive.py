"""Millions of tiny files into a few indexed containers, without losing or repeating a record.

``pack`` writes the original bytes of the files back to back into blocks of a target size and keeps, for
each file, its path, block, offset, length and checksum; ``unpack`` reads files back from blocks, many
blocks at once, and verifies the checksums.  ``idle_files`` and ``consolidate`` work on what is read back
from the containers: the first names the files that add nothing, the second gives every (clip, frame)
record exactly once, as the very line it was read from; ``consolidated_containers`` streams those lines, in
clip and frame order, into members of the same kind of blocks.

Containment of record sets is searched without comparing all files of a clip: equal sets meet by their
digest first; each remaining set looks only at the sets that share its rarest record, are larger, and whose
256-bit signature covers its own, which is tested in the join, before any pair is formed.

Defined results: a null payload is packed as no bytes with ``length`` null, an empty one with length 0, and
both read back as they were; the same file delivered twice is one member (the row with the smallest path
counts); rows without ``file_id`` are packed too, equal ones once, and rank last where file_ids are compared, by path
and payload (they cannot be named as idle); null ``motion_id`` is a clip of its own; a line
whose first field is no whole number holds no record (headers, blanks); numbers of any length are records, equal
if they differ by leading zeros only; of two copies of a record the one of
the smallest file_id counts, of two lines in a file the first; a payload larger than a block gets a block alone;
a consolidated clip that does not fit its block goes on as a further member in the next.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.scratch import discard, lookup, partitions, stored

BLOCK_BYTES = 8 << 20
PARTITION_BLOCKS = 8

BLOCKS = "block_id string, data binary, members array<struct<file_id:bigint,motion_id:string,path:string,offset:bigint,length:bigint,crc:bigint>>"
_MEMBER = pa.struct([("file_id", pa.int64()), ("motion_id", pa.string()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())])
FILES = "file_id bigint, motion_id string, path string, block_id string, offset bigint, length bigint, crc bigint, intact boolean, payload string"


def _member_list(columns: list[list]) -> pa.Array:
    struct = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MEMBER)], fields=list(_MEMBER))
    return pa.ListArray.from_arrays(pa.array([0, len(struct)], pa.int32()), struct)


def _packer(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        data, members = bytearray(), [[] for _ in _MEMBER]

        def block() -> pa.RecordBatch:
            nonlocal data, members, made
            row = pa.RecordBatch.from_arrays([pa.array([f"{part:06d}-{made:06d}"]), pa.array([bytes(data)], pa.binary()), _member_list(members)], names=["block_id", "data", "members"])
            made += 1
            data, members = bytearray(), [[] for _ in _MEMBER]
            return row

        for batch in batches:
            for file_id, clip, path, payload in zip(*(batch.column(k).to_pylist() for k in ("file_id", "motion_id", "path", "payload"))):
                raw = b"" if payload is None else payload.encode()
                if data and len(data) + len(raw) > block_bytes:
                    yield block()
                for column, v in zip(members, (file_id, clip, path, len(data), None if payload is None else len(raw), zlib.crc32(raw))):
                    column.append(v)
                data += raw
        if members[0]:
            yield block()

    return run


def _once(rows: DataFrame) -> DataFrame:
    """Each file once.  Only ids are shuffled to find those that repeat; the payloads of all others stay where they are."""
    named = F.col("file_id").isNotNull()
    key = F.coalesce(F.col("file_id").cast("string"), F.concat(F.lit("h:"), F.sha2(F.concat_ws("|", F.coalesce("motion_id", F.lit("\u0000")), F.coalesce("path", F.lit("\u0000")), F.coalesce("payload", F.lit("\u0000"))), 256)))
    repeated = stored(rows.select(key.alias("file_key")).groupBy("file_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("file_key"), "repeated-files")
    if repeated.limit(1).count() == 0:
        return rows.withColumn("named", named)
    keyed = rows.withColumn("file_key", key)
    again = lookup(keyed, repeated, "file_key", "left_semi").groupBy("file_key").agg(F.min_by(F.struct("file_id", "motion_id", "path", "payload"), F.struct(F.col("path").isNull(), "path", F.col("payload").isNull(), "payload")).alias("r"))
    return lookup(keyed, repeated, "file_key", "left_anti").drop("file_key").unionByName(again.select("r.*")).withColumn("named", named)


def _tasks(spark, total: int, block_bytes: int) -> int:
    """Tasks that fill blocks: several blocks each only where there are more blocks than the cluster takes at once."""
    n_blocks = max(1, -(-total // block_bytes))
    return min(n_blocks, max(partitions(spark), -(-n_blocks // PARTITION_BLOCKS)))


def pack(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """files: file_id, motion_id, path, payload.  Blocks of about ``block_bytes`` with their members' index, as a stored table."""
    rows = files.select(F.col("file_id").cast("bigint").alias("file_id"), F.col("motion_id").cast("string").alias("motion_id"), F.col("path").cast("string").alias("path"), F.col("payload").cast("string").alias("payload"))
    n = _tasks(files.sparkSession, rows.agg(F.sum(F.octet_length("payload"))).first()[0] or 0, block_bytes)
    rows = _once(rows)
    placed = rows.repartitionByRange(n, "motion_id", F.desc("named"), "file_id", "path") if n > 1 else rows.coalesce(1)
    return stored(placed.sortWithinPartitions("motion_id", F.desc("named"), "file_id", "path").drop("named").mapInArrow(_packer(block_bytes), BLOCKS), "containers")


def index(blocks: DataFrame) -> DataFrame:
    """One row per file: where its bytes lie.  Reads no data."""
    return blocks.select("block_id", F.explode("members").alias("m")).select("m.file_id", "m.motion_id", "m.path", "block_id", "m.offset", "m.length", "m.crc")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block_id, data, members in zip(batch.column("block_id"), batch.column("data"), batch.column("members")):
            file_id, clip, path, offset, length, crc = members.values.flatten()
            if not len(file_id):
                continue
            whole = data.as_py()
            places = list(zip(offset.to_pylist(), length.to_pylist(), crc.to_pylist()))
            raw = [whole[at : at + (n or 0)] for at, n, _ in places]
            intact = [zlib.crc32(r) == c for r, (_, _, c) in zip(raw, places)]
            payload = pa.array([None if n is None else r.decode(errors="replace") for r, (_, n, _) in zip(raw, places)], pa.string())
            names = ["file_id", "motion_id", "path", "block_id", "offset", "length", "crc", "intact", "payload"]
            yield pa.RecordBatch.from_arrays([file_id, clip, path, pa.array([block_id.as_py()] * len(raw)), offset, length, crc, pa.array(intact), payload], names=names)


def unpack(blocks: DataFrame) -> DataFrame:
    """The files as they were packed, with ``intact`` telling whether the checksum holds."""
    return blocks.mapInArrow(_reader, FILES)


_FRAME = re.compile("^\ufeff? *([0-9]+)(?= *$|[^\\S\n]*,)", re.M)


def _plain_lines(payload: str) -> str:
    return payload.replace("\r\n", "\n").replace("\r", "\n") if "\r" in payload else payload


def _frames(payload: str | None) -> list[str]:
    """The distinct record numbers of a file, in numeric order, without leading zeros."""
    found = _FRAME.findall(_plain_lines(payload)) if payload else ()
    if all(len(x) < 1000 for x in found):
        return [str(x) for x in sorted({int(x) for x in found})]
    return sorted({x.lstrip("0") or "0" for x in found}, key=lambda x: (len(x), x))


SETS = "file_id bigint, clip string, frames array<string>, n int, digest binary, s0 bigint, s1 bigint, s2 bigint, s3 bigint"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _reader(batches):
        out: list[list] = [[] for _ in range(9)]
        for file_id, clip, payload in zip(*(batch.column(k).to_pylist() for k in ("file_id", "motion_id", "payload"))):
            if file_id is None:
                continue
            frames, name, bits = _frames(payload), "\u0000" if clip is None else clip, 0
            for x in frames:
                bits |= 1 << (int(x[-18:]) % 251)
            words = [(bits >> (63 * i)) & ((1 << 63) - 1) for i in range(4)]
            digest = hashlib.sha256(f"{name}|{','.join(frames)}".encode()).digest()
            for column, v in zip(out, (file_id, name, frames, len(frames), digest, *words)):
                column.append(v)
        kinds = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.binary(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["file_id", "clip", "frames", "n", "digest", "s0", "s1", "s2", "s3"])


def record_sets(blocks: DataFrame) -> DataFrame:
    """Per file of the containers its distinct record numbers in order, their digest, and a signature that covers that of every subset."""
    return blocks.mapInArrow(_sets, SETS)


def idle_files(blocks: DataFrame) -> DataFrame:
    """Files of the containers that hold no record, or only records that one other file of their clip also holds (more of them, or the same under a smaller file_id)."""
    sets = stored(record_sets(blocks), "record-sets")
    empty = sets.where("n = 0").select("file_id")
    full = sets.where("n > 0")
    copies = full.groupBy("digest").agg(F.min("file_id").alias("set_id"), F.count(F.lit(1)).alias("n_files")).where("n_files > 1").select("digest", "set_id")
    copies = stored(copies, "equal-sets")
    member = lookup(full.select("file_id", "digest"), copies, "digest").select("file_id", "set_id")
    same = stored(member.where("file_id <> set_id"), "same-sets")
    first = full.join(same.select("file_id"), "file_id", "left_anti")  # each distinct set by its smallest file_id
    first = stored(first.withColumnRenamed("file_id", "set_id").drop("digest"), "distinct-sets")

    # postings of the distinct sets under a hash of (clip, record); should two records share a hash, that only leaves more to check
    signature = [f"s{i}" for i in range(4)]
    postings = first.select("set_id", "n", *signature, "clip", F.explode("frames").alias("frame")).withColumn("record", F.xxhash64("clip", "frame")).drop("clip", "frame")
    held = stored(postings.groupBy("record").agg(F.count(F.lit(1)).alias("held_by"), F.min("set_id").alias("set_id")), "held-by")
    # a set that alone holds some record lies in no other
    own = held.where("held_by = 1").select("set_id").distinct()
    asking = stored(first.join(own, "set_id", "left_anti"), "asking-sets")
    wanted = asking.select("set_id", "n", *signature, "clip", F.explode("frames").alias("frame")).withColumn("record", F.xxhash64("clip", "frame")).drop("clip", "frame")
    shared = wanted.join(held.where("held_by > 1").select("record", "held_by"), "record")
    rarest = shared.groupBy("set_id").agg(F.min(F.struct("held_by", "record")).alias("r"), F.first("n").alias("its_n"), *(F.first(s).alias(f"its_{s}") for s in signature))
    rarest = stored(rarest.select(F.col("set_id").alias("asks"), F.col("r.record").alias("asked"), "its_n", *(f"its_{s}" for s in signature)), "rarest-records")
    covers = (F.col("record") == F.col("asked")) & (F.col("n") > F.col("its_n"))
    for s in signature:
        covers = covers & (F.col(f"its_{s}").bitwiseAND(F.bitwise_not(F.col(s))) == 0)
    pairs = postings.join(rarest, covers).select("asks", F.col("set_id").alias("holds"))
    pairs = pairs.join(asking.select(F.col("set_id").alias("asks"), F.col("clip").alias("its_clip"), F.col("frames").alias("mine")), "asks").join(first.select(F.col("set_id").alias("holds"), "clip", "frames"), "holds")
    covered = stored(pairs.where((F.col("clip") == F.col("its_clip")) & (F.size(F.array_except("mine", "frames")) == 0)).select(F.col("asks").alias("set_id")).distinct(), "covered-sets")
    discard(held, asking, rarest)
    inside = covered.select(F.col("set_id").alias("file_id"))
    others = lookup(same, covered, "set_id", "left_semi").select("file_id")
    return empty.unionByName(same.select("file_id")).unionByName(inside).unionByName(others).distinct()


RECORD = "motion_id string, frame_text string, file_id bigint, tie string, line int, text string"
_LINE = re.compile("^(\ufeff?) *([0-9]+)(?= *$|[^\\S\n]*,)")


def _record_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _reader(batches):
        out: list[list] = [[] for _ in range(6)]
        for file_id, clip, path, payload in zip(*(batch.column(k).to_pylist() for k in ("file_id", "motion_id", "path", "payload"))):
            for i, text in enumerate(_plain_lines(payload).split("\n") if payload else ()):
                found = _LINE.match(text)
                if found:
                    for column, v in zip(out, (clip, found[2].lstrip("0") or "0", file_id, None if file_id is not None else (path or ""), i, text[len(found[1]) :])):
                        column.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string()))], names=["motion_id", "frame_text", "file_id", "tie", "line", "text"])


def kept_lines(blocks: DataFrame) -> DataFrame:
    """Every (clip, frame) record exactly once, as its line stands: motion_id, frame_text, file_id it is taken from, text."""
    lines = blocks.mapInArrow(_record_lines, RECORD)
    kept = lines.groupBy("motion_id", "frame_text").agg(F.min_by(F.struct("file_id", "text"), F.struct(F.col("file_id").isNull(), "file_id", "tie", "line", "text")).alias("k"))
    return kept.select("motion_id", "frame_text", "k.*")


def consolidate(blocks: DataFrame) -> DataFrame:
    """Every (clip, frame) record exactly once: motion_id, frame (null beyond 64 bits), height, contacts (null where they are no numbers), file_id it is taken from."""
    field = lambda i: F.get(F.split("text", r"\s*,\s*"), F.lit(i))
    return kept_lines(blocks).select("motion_id", F.col("frame_text").try_cast("bigint").alias("frame"), field(1).try_cast("double").alias("height"), F.trim(field(2)).try_cast("int").alias("contacts"), "file_id")


def _line_packer(block_bytes: int):
    """Sorted lines into blocks; a member is one clip's run of lines within a block, each line ended by a line feed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        data, members, since = bytearray(), [], 0

        def close() -> None:
            if members and members[-1]["length"] is None:
                members[-1] |= {"length": len(data) - since, "crc": zlib.crc32(data[since:])}

        def block() -> pa.RecordBatch:
            nonlocal data, members, made
            close()
            row = pa.RecordBatch.from_arrays([pa.array([f"{part:06d}-{made:06d}"]), pa.array([bytes(data)], pa.binary()), pa.array([members], pa.list_(_MEMBER))], names=["block_id", "data", "members"])
            made += 1
            data, members = bytearray(), []
            return row

        for batch in batches:
            for clip, text in zip(*(batch.column(k).to_pylist() for k in ("motion_id", "text"))):
                raw = text.encode() + b"\n"
                if data and len(data) + len(raw) > block_bytes:
                    yield block()
                if not members or members[-1]["motion_id"] != clip:
                    close()
                    since = len(data)
                    members.append({"file_id": None, "motion_id": clip, "path": f"clips/{'_' if clip is None else clip}-{part:06d}-{made:06d}.csv", "offset": since, "length": None, "crc": None})
                data += raw
        if members:
            yield block()

    return run


def consolidated_containers(blocks: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The records exactly once, their lines byte for byte in clip and frame order, streamed into blocks of the target size; no task gathers a clip."""
    kept = stored(kept_lines(blocks), "kept-lines")
    n = _tasks(blocks.sparkSession, kept.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0, block_bytes)
    order = ["motion_id", F.length("frame_text"), "frame_text"]
    placed = kept.repartitionByRange(n, *order) if n > 1 else kept.coalesce(1)
    out = stored(placed.sortWithinPartitions(*order).mapInArrow(_line_packer(block_bytes), BLOCKS), "consolidated")
    discard(kept)
    return out
