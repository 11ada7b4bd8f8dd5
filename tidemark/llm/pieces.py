"""SentencePiece encoding and decoding that keeps the byte span of every piece."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, texts_of, text_or_empty

SPACE_MARK = "▁"
_MARK = SPACE_MARK.encode()

ENCODED = "doc_id long, n_tokens long, ids binary, begins binary, ends binary, decoded string"


class CharacterMap:
    """The compiled map of a model: a double-array trie, then the replacements it points to."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.replacements = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that is a prefix of ``text`` at ``at``."""
        if not self.units:
            return None
        found, units = None, self.units
        unit = units[0]
        place = (unit >> 10) << ((unit & (1 << 9)) >> 6)
        for n, byte in enumerate(text[at:], 1):
            place ^= byte
            unit = units[place]
            if unit & ((1 << 31) | 0xFF) != byte:
                break
            place ^= (unit >> 10) << ((unit & (1 << 9)) >> 6)
            if unit >> 8 & 1:
                start = units[place] & ((1 << 31) - 1)
                found = n, self.replacements[start : self.replacements.index(b"\0", start)]
        return found


def normalise(text: bytes, mapping: CharacterMap, dummy_prefix: bool, squeeze: bool) -> tuple[bytes, np.ndarray]:
    """The normalised bytes, and for each (and the end) the source byte it comes from.

    At each place the longest prefix in the map is replaced, else one character is kept.
    ``squeeze`` drops spaces at both ends and repeats. Spaces become marks.
    """
    out, source, at = bytearray(), [], 0
    parts: list[tuple[bytes, int, int]] = []
    while at < len(text):
        hit = mapping.longest(text, at)
        if hit is None:
            first = text[at]
            n = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            hit = n, text[at : at + n]
        parts.append((hit[1], at, at + hit[0]))
        at += hit[0]
    if squeeze:
        while parts and parts[0][0] == b" ":
            parts.pop(0)
        while parts and parts[-1][0].strip(b" ") == b"":
            parts.pop()
    if parts and dummy_prefix:
        out += _MARK
        source += [parts[0][1]] * len(_MARK)
    spaced = squeeze
    for new, begin, _ in parts:
        if squeeze and spaced:
            new = new.lstrip(b" ")
        for byte in new:
            unit = _MARK if byte == 0x20 else bytes([byte])
            out += unit
            source += [begin] * len(unit)
        spaced = new.endswith(b" ") if new else spaced
    source.append(parts[-1][2] if parts else len(text))
    return bytes(out), np.array(source)


@cache
def codec(model: str) -> Codec:
    """Kept while the worker lives."""
    return Codec(model)


class Codec:
    """A model's encoder with spans, and its decoder.

    The library finds the ids; the widths of the pieces are laid along the normalised bytes
    and taken back to the source. With an empty map every byte is its own source, and only
    spaces grow to marks, so that the way back is one running sum.
    """

    def __init__(self, model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(model, "rb") as file:
            data = file.read()
        proto = sentencepiece_model_pb2.ModelProto.FromString(data)
        spec, kinds = proto.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.mapping = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        # Normalised bytes by piece; a byte piece stands for one.
        self.widths = np.array([1 if p.type == kinds.BYTE else 0 if p.type == kinds.CONTROL else len(p.piece.encode()) for p in proto.pieces])
        self.plain = not (self.mapping.units or self.squeeze)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text its ids and the source byte each piece ends at (it begins where the last ended)."""
        spans = self._straight if self.plain else self._walk
        return [spans(t, np.array(ids, np.int64)) for t, ids in zip(texts, self.library.encode(texts, num_threads=1))]

    def _straight(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        made = np.cumsum(self.widths[ids]) - (len(_MARK) if self.dummy else 0)
        source = np.frombuffer(text.encode(), np.uint8)
        upto = np.cumsum(np.where(source == 0x20, len(_MARK), 1))
        # Byte pieces inside a character end where it begins, but the last.
        places = np.arange(len(source) + 1)
        begins = np.maximum.accumulate(np.where(np.append(source & 0xC0, 0) == 0x80, 0, places))
        return ids, begins[np.searchsorted(upto, made, "right")]

    def _walk(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        normal, source = normalise(text.encode(), self.mapping, self.dummy, self.squeeze)
        made = np.minimum(np.cumsum(self.widths[ids]), len(normal)) if len(ids) else np.empty(0, np.int64)
        return ids, source[made] if len(ids) else made


def encode(docs: DataFrame, model: str) -> DataFrame:
    """Ids with begin and end ids, byte spans, and the decoded text of every document.

    ``ids``, ``begins`` and ``ends`` are little-endian unsigned 32-bit integers, one for
    each id; begin and end ids have empty spans at the text's ends. The spans of the others
    tile the UTF-8 text. A null text counts as empty: two ids, an empty text back. Ties and
    repeated rows are encoded each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(model)
        begin, end = own.library.bos_id(), own.library.eos_id()
        for batch in batches:
            texts = texts_of(batch["text"])
            rows = []
            for text, (ids, ends) in zip(texts, own.encode(texts)):
                last = ends[-1] if len(ends) else 0
                whole = np.concatenate([[begin], ids, [end]])
                to = np.concatenate([[0], ends, [last]]).astype("<u4")
                rows.append((len(whole), whole.astype("<u4").tobytes(), np.concatenate([[0], to[:-1]]).astype("<u4").tobytes(), to.tobytes(), own.library.decode(whole.tolist())))
            made = pd.DataFrame(rows, columns=["n_tokens", "ids", "begins", "ends", "decoded"])
            made.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield made.astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInPandas(run, ENCODED)


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Digests of the ids, of the decoded text and, in ``spans_sha256``, of all begins and then all ends."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    return encode(docs, model).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.concat("begins", "ends"), 256).alias("spans_sha256"),
    )


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
