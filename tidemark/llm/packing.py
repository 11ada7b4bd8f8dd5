"""Best-fit packing of documents into sequences, after a Martello-Toth reduction."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import PieceCache, stored, table, text_or_empty
from tidemark.llm.segments import byte_level, cut, large, uncut

CAPACITY = 1024
#: Segments whose ids a worker remembers.
KEPT_SEGMENTS = 300_000
#: Parts in which the pieces of a length are numbered: as many at least, and one more for so many rows.
PARTS, PART_ROWS = 64, 200_000


class Encoder:
    """Ids of whole texts by the tokenizers library, remembered by segment."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(file)
        _, self.added, self.known = byte_level(file)

        def learn(texts: list[str]) -> list[bytes]:
            return [np.array(e.ids, np.int32).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        self.words, self.learn = PieceCache(learn, limit=KEPT_SEGMENTS), learn

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a line, and how many each text has.

        A text that holds an added token is encoded whole, as a cut could split the token.
        """
        segments, begins = (cut if self.known else uncut)(texts)
        alone = np.zeros(len(texts), bool)
        for token in self.added if self.known else ():
            alone |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        known = segments.dictionary_encode()
        at, lengths = self.words.places(known.dictionary.to_pylist())
        which = known.indices.to_numpy(zero_copy_only=False)
        counts = lengths[which]
        ids = self.words.rows(at[which], counts).ravel()
        upto = np.concatenate([[0], np.cumsum(counts)])[begins]
        if alone.any():
            parts = [ids[a:b] for a, b in zip(upto[:-1], upto[1:])]
            for i in np.nonzero(alone)[0].tolist():
                parts[i] = np.frombuffer(self.learn([texts[i].as_py()])[0], np.int32)
            return np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, np.diff(upto)


@cache
def encoder(file: str) -> Encoder:
    """Kept while the worker lives."""
    return Encoder(file)


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, checksums: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every document, its end id included.

    Only documents of more than ``capacity`` ids are cut, so that all pieces but the first are
    full. ``ids`` are little-endian unsigned 32-bit integers; with ``checksums`` their CRC-32
    (``ids_crc32``) stands in their place. A null text is empty and has its end id. Rows that
    repeat an identifier are documents of their own, a null identifier stays null.
    """
    last = "ids_crc32 long" if checksums else "ids binary"
    declared = f"doc_id long, piece int, start long, length int, {last}"
    schema = to_arrow_schema(StructType.fromDDL(declared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            ids, lengths = own.encode(large(batch.column("text")))
            ids = np.insert(ids, np.cumsum(lengths), end_id).astype("<u4")
            lengths = lengths + 1
            n = -(-lengths // capacity)
            doc = np.repeat(np.arange(len(lengths)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            first = lengths - (n - 1) * capacity
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[doc], capacity)
            data, ends = ids.tobytes(), 4 * np.cumsum(length)
            held = [data[e - 4 * k : e] for e, k in zip(ends.tolist(), length.tolist())]
            values = pa.array(list(map(zlib.crc32, held)), pa.int64()) if checksums else pa.array(held, pa.binary())
            columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), values]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, declared)


class Plan:
    """Where the pieces of each length go, by their number among those of the length.

    A step puts ``per`` pieces of a length, one behind the other from ``offset`` on, into each
    of a run of sequences. Pieces of equal length are interchangeable, so the whole instance
    is a count for each length and its plan a few steps for each, however many documents.
    """

    def __init__(self, counts: Mapping[int, int], capacity: int):
        self.left = {int(w): int(n) for w, n in counts.items() if n}
        if self.left and (min(self.left) < 1 or max(self.left) > capacity):
            raise ValueError("lengths lie between 1 and the capacity")
        self.capacity, self.sequences, self.fixed = capacity, 0, 0
        self.taken: dict[int, int] = defaultdict(int)
        self.steps: list[tuple[int, int, int, int, int]] = []  # length, from number, first sequence, per, offset
        self._reduce()
        self.fixed = self.sequences
        self._best_fit()

    def _put(self, width: int, sequence: int, many: int, per: int, offset: int) -> None:
        self.steps.append((width, self.taken[width], sequence, per, offset))
        self.taken[width] += many * per
        self.left[width] -= many * per
        if not self.left[width]:
            del self.left[width]

    def _fix(self, many: int, *widths: int) -> None:
        """``many`` sequences that hold a piece of each of these lengths."""
        offset = 0
        for w in widths:
            self._put(w, self.sequences, many, 1, offset)
            offset += w
        self.sequences += many

    def _without(self, *widths: int) -> dict[int, int]:
        rest = dict(self.left)
        for w in widths:
            rest[w] -= 1
        return {w: n for w, n in rest.items() if n > 0}

    def _reduce(self) -> None:
        """Fix the sets that dominate every other set with the same largest piece.

        A set dominates another if the other's pieces can be dealt into its pieces' places;
        some best packing then has it. That holds for a piece that nothing fits beside; for
        its largest partner, if the two fill a sequence or only one partner fits, or no two
        that fit are longer than it together; and for the fullest pair of partners, if no pair
        has both a larger one and a larger other. All sets that are alike are fixed at once.
        """
        for w in sorted(self.left, reverse=True):
            while w in self.left and self._fix_one(w):
                pass

    def _fix_one(self, w: int) -> bool:
        room, rest = self.capacity - w, self._without(w)
        fitting = sorted(x for x in rest if x <= room)
        if not fitting:
            # Others of this length do not fit beside it either.
            self._fix(self.left[w], w)
            return True
        smallest = [x for x in fitting for _ in range(min(3, rest[x]))][:3]
        partner = fitting[-1]
        pair = None
        alone = sum(smallest[:2]) > room or len(smallest) < 2
        if not alone and partner != room:
            if sum(smallest) <= room and len(smallest) == 3:
                return False
            pair = self._fullest(fitting, rest, room)
        if pair is None or partner >= sum(pair):
            return self._fix_sets(w, partner)
        a, b = pair
        # A pair whose smaller one is larger than b takes two of the smallest such pieces at least.
        larger = [x for x in fitting if x > b for _ in range(min(2, rest[x] - (x == a)))][:2]
        if a == partner and (len(larger) < 2 or sum(larger) > room):
            return self._fix_sets(w, a, b)
        return False

    def _fix_sets(self, *widths: int) -> bool:
        need = {w: widths.count(w) for w in widths}
        # What made one set dominant holds as long as its pieces last, as the others only get fewer.
        self._fix(min(self.left[w] // k for w, k in need.items()), *widths)
        return True

    @staticmethod
    def _fullest(fitting: list[int], rest: Mapping[int, int], room: int) -> tuple[int, int] | None:
        """The two pieces that fill the most of the room, the larger first."""
        best, low, high = None, 0, len(fitting) - 1
        while low <= high:
            a, b = fitting[high], fitting[low]
            if a + b > room:
                high -= 1
                continue
            if (a != b or rest[a] > 1) and (best is None or a + b > sum(best)):
                best = a, b
            low += 1
        return best

    def _best_fit(self) -> None:
        """Longest first, each into the fullest sequence that has room, or a new one."""
        runs: dict[int, list[tuple[int, int]]] = {}  # by room: (first sequence, how many)
        rooms: list[int] = []

        def opened(room: int, first: int, many: int) -> None:
            if room and many:
                if room not in runs:
                    insort(rooms, room)
                runs.setdefault(room, []).append((first, many))

        for w in sorted(self.left, reverse=True):
            while n := self.left.get(w):
                i = bisect_left(rooms, w)
                if i < len(rooms):
                    room = rooms[i]
                    first, many = runs[room].pop()
                    if not runs[room]:
                        del runs[room], rooms[i]
                else:
                    room, first = self.capacity, self.sequences
                    many = -(-n // (room // w))
                    self.sequences += many
                per = min(room // w, n)
                full = min(many, n // per)
                self._put(w, first, full, per, self.capacity - room)
                opened(room - per * w, first, full)
                over = n - full * per
                if over and full < many:
                    self._put(w, first + full, 1, over, self.capacity - room)
                    opened(room - over * w, first + full, 1)
                    full += 1
                opened(room, first + full, many - full)

    def arrays(self) -> tuple[np.ndarray, ...]:
        """The steps in order of length and number, the key of each first."""
        steps = np.array(sorted(self.steps), np.int64).reshape(-1, 5)
        return ((steps[:, 0] << 48) | steps[:, 1], *steps.T)


def numbered(rows: DataFrame) -> DataFrame:
    """``number``: the place of each row among those of its ``length``, from 0.

    A length that a third of all rows have is dealt over parts by hash: counts by (length,
    part) are summed over the parts, and rows are numbered within a part only. Equal rows are
    interchangeable, so a rerun gives the same.
    """
    total = rows.count()
    own = [c for c in rows.columns]
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64(*own), F.lit(PARTS + total // PART_ROWS)))
    counts = dealt.groupBy("length", "__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__base"))
    inside = F.row_number().over(Window.partitionBy("length", "__part").orderBy(*own)) - 1
    placed = dealt.withColumn("__inside", inside).join(bases, ["length", "__part"])
    return placed.select(*own, (F.col("__base") + F.col("__inside")).alias("number"))


def packed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A stored table with a ``length`` (1 to ``capacity``) gets ``sequence_id`` and ``offset``.

    Only the count of each length, ``capacity`` numbers at most, comes to the driver; a task
    finds the place of a row in the plan by its length and number. Columns stay as they are.
    """
    counts = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    key, _, begin, first, per, offset = Plan(counts, capacity).arrays()
    out = StructType([*rows.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    names, schema = rows.columns, to_arrow_schema(out)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "number"))
            step = np.searchsorted(key, length << 48 | number, "right") - 1
            among = number - begin[step]
            sequence, at = first[step] + among // per[step], offset[step] + among % per[step] * length
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(at)], schema=schema)

    return numbered(rows).mapInArrow(place, out)


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, checksums: bool = False) -> DataFrame:
    """The pieces of all documents with the sequence and the place in it of each."""
    return packed(stored(pieces(docs, vocabulary, end_id, capacity, checksums), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids, doc_ids, lengths`` of each sequence, from pieces with ids."""
    held = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    rows = placed.groupBy("sequence_id").agg(F.sum("length").cast("int").alias("n_tokens"), held.alias("__held"))
    hexes = F.transform("__held", lambda x: F.hex(x["ids"]))
    return rows.select("sequence_id", "n_tokens", F.unhex(F.array_join(hexes, "")).alias("ids"), F.col("__held.doc_id").alias("doc_ids"), F.col("__held.length").alias("lengths"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2, checksums=True)
    return rows.withColumn("length", F.col("length").cast("long"))
