"""Best-fit packing by length histogram.

Texts become pieces of at most ``max_tokens`` ids. Only the histogram of piece
lengths (at most ``max_tokens`` rows) reaches the driver, which plans
best-fit-decreasing over counts: whole ranges of equal sequences are filled
at once. A plan row says "the pieces of this length with ranks from..to go to
sequences first.. at this offset", and every piece finds its row by its rank
within its length. The plan's size depends on ``max_tokens`` alone, so it can
be broadcast whatever the input.

Defined cases: null and empty text give one piece that holds only the end id;
a text over the limit is cut into full pieces and a shorter last one; rows
with the same doc_id are packed as separate documents; an empty table gives no
rows; input columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import bounded, materialise, text_runs, tokenizer_file, word_encoder

MAX_TOKENS = 2048
END_ID = 0
# Pieces of one length are ranked in this many parts, so that a length that
# most pieces share is ranked by many tasks.
RANK_PARTS = 1024
# Words that a worker remembers. More would save some time, but two workers of
# an executor hold them beside what earlier stages left.
KNOWN_WORDS = 160_000

PLAN = T.StructType([
    T.StructField("p_length", T.IntegerType()), T.StructField("rank_from", T.LongType()),
    T.StructField("rank_to", T.LongType()), T.StructField("sequence_from", T.LongType()),
    T.StructField("p_offset", T.LongType())])


def cut_pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json",
               max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit)."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType())])

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        enc = word_encoder(tokenizer_file(tokenizer), KNOWN_WORDS)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for first, texts in text_runs(batch.column(1)):
                ids, bounds = enc.encode(texts)
                row, piece, out = [], [], []
                for i in range(len(texts)):
                    raw = ids[bounds[i]:bounds[i + 1]].tobytes() + end
                    for k in range(0, len(raw), 4 * max_tokens):
                        row.append(first + i)
                        piece.append(k // (4 * max_tokens))
                        out.append(raw[k:k + 4 * max_tokens])
                piece = np.array(piece, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece),
                     pa.array(piece.astype(np.int64) * max_tokens),
                     pa.array([len(x) // 4 for x in out], pa.int64()), pa.array(out, pa.binary())],
                    names=schema.names)

    return bounded(docs.select("doc_id", "text")).mapInArrow(cut, schema)


def plan_slots(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple]:
    """Best-fit-decreasing over a length histogram.

    Returns (length, rank_from, rank_to, sequence_from, offset) rows: the
    piece of that length with rank r goes to sequence_from + r - rank_from.
    Gives the sequences that piece-by-piece best fit gives, longest first.
    """
    rows: list[tuple] = []
    free: dict[int, list[tuple[int, int]]] = {}  # room left -> [(first sequence, how many)]
    rooms: list[int] = []
    made = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in free:
                free[room] = []
                insort(rooms, room)
            free[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = free[room].pop()
                if not free[room]:
                    del free[room]
                    rooms.pop(at)
            else:
                room = max_tokens
                per = room // length
                first, n = made, -(-left // per)
                made += n
            per = room // length
            full = min(n, left // per)
            for j in range(per if full else 0):
                rows.append((length, rank, rank + full, first, max_tokens - room + j * length))
                rank += full
            left -= full * per
            put(room - per * length, first, full)
            if full < n and left < per:
                for j in range(left):  # the last pieces of this length share one sequence
                    rows.append((length, rank, rank + 1, first + full, max_tokens - room + j * length))
                    rank += 1
                if left:
                    put(room - left * length, first + full, 1)
                    full += 1
                left = 0
                put(room, first + full, n - full)
    return rows


def place(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces.

    ``pieces`` has doc_id, piece and length (1 to ``max_tokens``); it is read
    more than once and must not change between reads (see ``materialise``).
    """
    spark = pieces.sparkSession
    parts = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_PARTS)))
    counts = materialise(parts.groupBy("length", "_part").agg(F.count("*").alias("_n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = spark.createDataFrame(plan_slots(histogram, max_tokens), PLAN)

    before = counts.withColumn("_before", F.sum("_n").over(
        Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    ).select("length", "_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece")
    ranked = (parts.withColumn("_rank", F.row_number().over(within) - 1)
              .join(before, ["length", "_part"])
              .withColumn("_rank", F.col("_rank") + F.col("_before")))
    return (ranked.join(F.broadcast(plan), (F.col("length") == F.col("p_length"))
                        & (F.col("_rank") >= F.col("rank_from")) & (F.col("_rank") < F.col("rank_to")))
            .withColumn("sequence_id", F.col("sequence_from") + F.col("_rank") - F.col("rank_from"))
            .withColumn("offset", F.col("p_offset"))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json",
         max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with ids, sequence_id and offset."""
    return place(materialise(cut_pieces(docs, tokenizer, max_tokens, end_id), "pack-pieces"), max_tokens)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids: the pieces of a sequence joined by offset."""
    got = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return got.select("sequence_id", F.aggregate(
        "p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def pack_digest(docs: DataFrame) -> DataFrame:
    """Packed pieces with the checksum of their ids in place of the ids."""
    pieces = cut_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(materialise(pieces, "pack-pieces")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
