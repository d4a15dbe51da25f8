"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxlake.llm import bpe
from wxlake.llm.common import materialise, pin

CAPACITY = 1024
#: Id after each document.
END = 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
SLOTS = "length long, first_rank long, last_rank long, copies long, first_sequence long, first_offset long"


def cut(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: only a longer one is cut, and its first piece takes the rest."""
    first = total if total <= capacity else total % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, total, capacity)]


def encoded_pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str = bpe.VOCABULARY) -> DataFrame:
    """Pieces of all documents, with their rank within their length and task.

    Null texts are empty; an empty document is its end id alone. ``part`` and
    ``place`` number the pieces of equal length: the task, and the count within it.
    Write the result before using these, as another run of a task may get its rows in another order.
    """
    pin(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("part", pa.int32()), ("place", pa.int64())])
    closing = end.to_bytes(4, "little")

    def pieces(batches):
        coder, places, part = bpe.encoder(vocabulary), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for own in bpe.in_portions(texts):
                rows = []
                for doc, tokens in zip(ids[own], coder.encode(texts[own])):
                    tokens = memoryview(tokens + closing)
                    for i, (start, length) in enumerate(cut(len(tokens) // 4, capacity)):
                        crc = zlib.crc32(tokens[4 * start : 4 * (start + length)])
                        rows.append((doc, i, start, length, crc, part, places[length]))
                        places[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return whole.mapInArrow(pieces, PIECES)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts of lengths: rows of SLOTS.

    Sequences of equal content form a group, and a whole group takes pieces at
    once: of a group with room for k pieces each, all sequences take k. At most one
    group is split for each length, so the number of groups, and of rows, depends on the
    capacity alone. Ranks ``first_rank``..``last_rank`` of a length go, ``copies`` to a sequence, to
    the sequences from ``first_sequence`` on, from ``first_offset`` on.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # free places -> (first sequence, sequences)
    slots, opened = [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} beyond 1..{capacity}")
        left, rank = counts[length], 0

        def take(first: int, sequences: int, free: int, copies: int) -> None:
            nonlocal left, rank
            placed = sequences * copies
            slots.append((length, rank, rank + placed - 1, copies, first, capacity - free))
            room.setdefault(free - copies * length, []).append((first, sequences))
            rank, left = rank + placed, left - placed

        for free in sorted(f for f in room if f >= length):
            for first, sequences in room.pop(free) if left else ():
                each = free // length
                full = min(sequences, left // each)
                if full:
                    take(first, full, free, each)
                rest = sequences - full
                if rest and left and full < sequences:
                    take(first + full, 1, free, left)
                    full, rest = full + 1, rest - 1
                if rest:
                    room.setdefault(free, []).append((first + full, rest))
        each = capacity // length
        for sequences, copies in ((left // each, each), (1, left % each)):
            if sequences and copies:
                opened += sequences
                take(opened - sequences, sequences, capacity, copies)
    return slots


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str = bpe.VOCABULARY) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``capacity`` tokens.

    Repeated rows are packed each. A null ``doc_id`` stays null. No documents: no rows.
    The histogram has a row per length, at most ``capacity``, and is all that
    reaches the driver; the plan's size depends on the capacity alone.
    """
    spark = docs.sparkSession
    pieces = materialise(encoded_pieces(docs, capacity, end, vocabulary), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(best_fit(counts, capacity), SLOTS)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(firsts, ["length", "part"]).withColumn("rank", F.col("first") + F.col("place"))
    inside = F.col("rank") - F.col("first_rank")
    in_slot = (ranked.length == slots.length) & F.col("rank").between(F.col("first_rank"), F.col("last_rank"))
    return ranked.join(F.broadcast(slots), in_slot).select(
        "doc_id", "piece", "start", ranked.length, "ids_crc32",
        (F.col("first_sequence") + F.floor(inside / F.col("copies"))).alias("sequence_id"),
        (F.col("first_offset") + inside % F.col("copies") * ranked.length).alias("offset"),
    )
