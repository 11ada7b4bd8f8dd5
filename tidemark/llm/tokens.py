"""Token-ID output: patched frame-of-reference blocks in a table of shards."""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache, partial
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import PieceCache, gather_words, table
from tidemark.session import new_dir

#: Ids in a block; ids after which a row of blocks ends, at the next document's end.
BLOCK, CHUNK = 1024, 1 << 16
#: The width of a block holds this share of its values; the rest are exceptions.
PERCENTILE = 95
#: Words whose ids a worker remembers, and as many stems and marks, some 200 bytes each.
KEPT_WORDS = 600_000
#: Letters before U+0130, where lowering knows no exceptions, and marks that are no apostrophe.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-į]+")
_LETTERS_MARKS = re.compile(f"({_LETTERS.pattern})([.,;:!?*&%$#]*)")
#: The normaliser and the pattern of words for which the cuts below are right.
_LOWERED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_HEAD = struct.Struct("<IHBH")  # minimum, values, width in bits, exceptions

CHUNKS = (
    "shard int, chunk int, start long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, block_starts binary, blocks binary"
)


def pack_block(values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """Up to 65,535 unsigned 32-bit values: header, low bits, exceptions' places and high bits."""
    low = values.min()
    rest = (values - low).astype("<u4")
    k = min(len(rest) - 1, int(len(rest) * percentile / 100))
    width = int(np.partition(rest, k)[k]).bit_length()
    over = np.nonzero(rest >> np.uint32(width))[0] if width < 32 else np.empty(0, int)
    bits = np.unpackbits(rest.view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little") if width else np.empty(0, np.uint8)
    return b"".join(
        (
            _HEAD.pack(int(low), len(rest), width, len(over)),
            np.packbits(bits, bitorder="little").tobytes(),
            over.astype("<u2").tobytes(),
            (rest[over] >> np.uint32(width)).astype("<u4").tobytes(),
        )
    )


def unpack_block(data: memoryview) -> np.ndarray:
    low, n, width, n_over = _HEAD.unpack_from(data)
    at, size = _HEAD.size, (n * width + 7) // 8
    out = np.zeros((n, 32), np.uint8)
    if width:
        packed = np.frombuffer(data, np.uint8, size, at)
        out[:, :width] = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
    values = np.packbits(out, axis=1, bitorder="little").view("<u4").ravel().copy()
    if n_over:
        places = np.frombuffer(data, "<u2", n_over, at + size)
        values[places] |= np.frombuffer(data, "<u4", n_over, at + size + 2 * n_over) << np.uint32(width)
    return values + np.uint32(low)


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[bytes, bytes]:
    """Where each block starts, and the blocks."""
    blocks = [pack_block(ids[i : i + block]) for i in range(0, len(ids), block)]
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    return starts.astype("<u8").tobytes() if blocks else b"", b"".join(blocks)


def unpack(starts: bytes, blocks: bytes) -> np.ndarray:
    data = memoryview(blocks)
    found = [unpack_block(data[i:]) for i in np.frombuffer(starts, "<u8")]
    return np.concatenate(found) if found else np.empty(0, "<u4")


def cuts_words(vocabulary: str) -> bool:
    """Whether no token of this tokenizer crosses white space, letters end at marks, and case is ignored."""
    with open(vocabulary, encoding="utf-8") as held:
        spec = json.load(held)
    first, *rest = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    bytewise = [(p["type"], p.get("add_prefix_space"), p.get("use_regex")) for p in rest] == [("ByteLevel", False, False)]
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    return bool(
        spec["added_tokens"]
        and plain
        and (spec["normalizer"] or {}).get("normalizers") == _LOWERED
        and first.get("pattern") == {"Regex": _CUT}
        and bytewise
        and spec["model"]["type"] == "BPE"
        and not spec["model"].get("dropout")
    )


@cache
def whole_encoder(vocabulary: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Ids of all texts in a line and how many each has, by the library alone."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
        return np.array([i for ids in found for i in ids], np.int64), np.array([len(ids) for ids in found], np.int64)

    return encode


def encoder(vocabulary: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """By words that a worker remembers where the tokenizer cuts texts so, else whole."""
    if not cuts_words(vocabulary):
        return whole_encoder(vocabulary)
    return partial(gather_words, word_encoder(vocabulary))


@cache
def word_encoder(vocabulary: str) -> PieceCache:
    """Ids by word, kept while the worker lives.

    The tokenizer drops white space and no piece crosses it, so a text's ids are its words'
    ids in a line. New words are encoded many at a time, with a token between that none of
    them holds.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    between, stop = next(iter(special.items()))

    def alone(words: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.int32).tobytes() for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    comma = tokenizer.encode(",", add_special_tokens=False).ids

    def together(words: list[str], between: str, stop: int) -> list[bytes]:
        found = []
        for some in (words[i : i + 500] for i in range(0, len(words), 500)):
            ids = np.array(tokenizer.encode(between.join([*some, ""]), add_special_tokens=False).ids, np.int32)
            ends = (np.nonzero(ids == stop)[0] * 4).tolist()
            data = ids.tobytes()
            found += [data[i:j] for i, j in zip([0, *(e + 4 for e in ends)], ends)]
        return found

    parts = {"": b""}

    def learn(new: list[str]) -> list[bytes]:
        # Letters, then marks: the tokenizer cuts between them and ignores case, so both
        # are looked up alone. Letters are lowered here only where that is beyond doubt.
        cut = map(_LETTERS_MARKS.fullmatch, new)
        pieces = [(m[1].lower(), m[2]) if m else (w, "") for w, m in zip(new, cut)]
        if len(parts) > KEPT_WORDS:
            for young in list(islice(parts, KEPT_WORDS // 2, None)):
                del parts[young]
        missing = list(dict.fromkeys(p for both in pieces for p in both if p not in parts))
        # Between letters a comma parts as well, and is cheaper: it is a word of its own.
        if len(comma) == 1:
            stems = [p for p in missing if _LETTERS.fullmatch(p)]
            parts.update(zip(stems, together(stems, ",", comma[0])))
            missing = [p for p in missing if p not in parts]
        # A word that holds part of a special token could complete one at its border.
        odd = [p for p in missing if "<" in p or ">" in p or "|" in p]
        parts.update(zip(odd, alone(odd)))
        plain = [p for p in missing if p not in parts]
        parts.update(zip(plain, together(plain, between, stop)))
        return [parts[a] + parts[b] for a, b in pieces]

    return PieceCache(learn, limit=KEPT_WORDS)


def encode_texts(
    encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], texts: pa.Array, end_id: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each ended by ``end_id``, and how many each has."""
    ids, lengths = encode(texts)
    return np.insert(ids.ravel(), np.cumsum(lengths), end_id).astype(np.uint32), lengths + 1


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, chunk: int = CHUNK) -> None:
    """Encode ``docs`` in ascending doc_id order and write shards under ``path``.

    ``path/blocks`` holds rows of blocks, each with its documents and their lengths, so a
    row can be read alone; ``path/shards`` holds the ids before each shard. Shards follow
    each other in doc_id order (null first, ties by text). A null text counts as empty and
    has its end id. Nothing is gathered: a task streams its range, Spark commits its file.
    """

    schema = to_arrow_schema(StructType.fromDDL(CHUNKS))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids_of = TaskContext.get().partitionId(), encoder(vocabulary)
        number = start = held = 0
        ids, doc_ids, lengths = [], [], []

        def row():
            nonlocal number, start, held, ids, doc_ids, lengths
            starts, blocks = pack(np.concatenate(ids))
            out = {"shard": shard, "chunk": number, "start": start, "n_ids": held, "doc_ids": doc_ids, "lengths": lengths, "block_starts": starts, "blocks": blocks}
            number, start, held = number + 1, start + held, 0
            ids, doc_ids, lengths = [], [], []
            return pa.RecordBatch.from_pylist([out], schema=schema)

        for batch in batches:
            own, counts = encode_texts(ids_of, batch.column("text"), end_id)
            at = 0
            for doc_id, n in zip(batch.column("doc_id").to_pylist(), counts.tolist()):
                ids.append(own[at : at + n])
                doc_ids.append(doc_id)
                lengths.append(n)
                at, held = at + n, held + n
                if held >= chunk:
                    yield row()
        if doc_ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(encode, CHUNKS).write.parquet(f"{path}/blocks")
    blocks = docs.sparkSession.read.schema(CHUNKS).parquet(f"{path}/blocks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (
        blocks.groupBy("shard")
        .agg(F.sum("n_ids").alias("n_ids"))
        .withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
        .write.parquet(f"{path}/shards")
    )


def read_ids(spark: SparkSession, path: str, checksums: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document.

    With ``checksums`` the ids' CRC-32 stands in their place, for checks that need not move
    the ids out of the task.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids = unpack(r.block_starts, r.blocks)
                ends = np.cumsum(r.lengths)
                own = [ids[e - n : e].astype("<u4", copy=False).tobytes() for e, n in zip(ends.tolist(), r.lengths.tolist())]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(list(r.doc_ids), dtype="Int64"),
                        "start": r.before + r.start + ends - r.lengths,
                        "n_tokens": r.lengths,
                        **({"ids_crc32": list(map(zlib.crc32, own))} if checksums else {"ids": own}),
                    }
                )

    shards = spark.read.schema("shard int, before long").parquet(f"{path}/shards")
    found = spark.read.schema(CHUNKS).parquet(f"{path}/blocks").join(shards, "shard")
    last = "ids_crc32 long" if checksums else "ids binary"
    return found.mapInPandas(decode, f"doc_id long, start long, n_tokens long, {last}")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_dir(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, path, checksums=True)
