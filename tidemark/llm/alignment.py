"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import PieceCache, stored, table, text_or_empty
from tidemark.llm.segments import MARKS, byte_level, cut, large, piece_marks, uncut

#: Segments whose alignment a worker remembers and finds at a time; pairs of ids whose counts go to every task.
KEPT_SEGMENTS, LEARNT_AT_ONCE, SENT_PAIRS = 200_000, 4_096, 1_000_000
_A_ENDS, _B_ENDS = 1, 2

SPANS = "doc_id long, a_ids binary, a_ends binary, b_ids binary, b_ends binary, group_ends binary"
LINKS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def refined_ends(begin: np.ndarray, end: np.ndarray, width: np.ndarray, heads: np.ndarray, origin: np.ndarray) -> np.ndarray:
    """Where tokens end in bytes, from the spans a library gives and the tokens' decoded widths.

    ``heads`` are the places of the first token of each text, ``origin`` the byte it begins at.
    A span that ends where the next begins, or before, is a sure cut. Tokens that share a
    character with others, or whose span is empty, as those of a character in several byte
    tokens, are laid from the cut before them by their widths.
    """
    n = len(end)
    if not n:
        return end
    head = np.zeros(n, bool)
    head[heads] = True
    follows = np.append(begin[1:], 0)
    last = np.append(head[1:], True)
    sure = (end > begin) & (last | (follows >= end))
    laid = np.cumsum(width)
    # What to add to the running sum of widths, from each cut on.
    shift = np.zeros(n, np.int64)
    after = np.append(False, sure[:-1])
    shift[1:][after[1:]] = (end - laid)[:-1][after[1:]]
    shift[heads] = origin - (laid - width)[heads]
    known = np.maximum.accumulate(np.where(after | head, np.arange(n), 0))
    return np.where(sure, end, shift[known] + laid)


class Aligner:
    """Two tokenizers, and the links between their tokens, remembered by segment.

    Both encode a space and the text. Neither has a token across the places where
    ``segments.cut`` cuts, so a text's links are its segments' in a line. A link is a row: id
    of A, id of B, bytes that both cover, and which of the two ends there.
    """

    def __init__(self, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        bytes_a, _, known = byte_level(file_a)
        with open(file_b, "rb") as file:
            proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        kinds, spec, trainer = sentencepiece_model_pb2.ModelProto.SentencePiece, proto.normalizer_spec, sentencepiece_model_pb2.TrainerSpec
        self.whole_b = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        bytes_b = [bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else p.piece.replace("▁", " ").encode() for p in proto.pieces]
        marks = piece_marks([p.piece for p in proto.pieces if p.type == kinds.NORMAL])
        plain = spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap and not proto.trainer_spec.treat_whitespace_as_suffix
        own = any(p.type == kinds.USER_DEFINED for p in proto.pieces)
        self.known = bool(known and plain and not own and marks is not None and proto.trainer_spec.model_type == trainer.BPE)
        self.marks = "".join(m for m in MARKS if m in (marks or ""))
        # A segment holds its own space, so the model must not add one.
        spec.add_dummy_prefix = False
        self.b = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.tables = bytes_a, bytes_b
        self.widths = tuple(np.array([len(t) for t in x], np.int64) for x in self.tables)
        self.size_b = len(bytes_b)
        self.cache, self.groups = PieceCache(self._learn, 4, KEPT_SEGMENTS), np.empty(0, object)

    def _tokens(self, texts: list[str], data: bytes, begins: np.ndarray, whole: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For A and B: ids, ends in the bytes of all texts, and how many tokens each text has."""
        first = np.nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)[0]
        places = np.append(first, len(data))
        chars = np.cumsum([0, *map(len, texts)])[:-1]
        found = []
        encoded = self.a.encode_batch(texts, add_special_tokens=False)
        ids, spans = [e.ids for e in encoded], [e.offsets for e in encoded]
        sides = [(ids, spans, chars, places)]
        if whole:  # the model adds the space, which its spans leave out
            mapped = self.whole_b.encode([t[1:] for t in texts], return_type="offset_mapping", return_bytes=True, num_threads=1)
            shifted = [[(b + 1 if k else 0, e + 1) for k, (b, e) in enumerate(m["offsets"])] for m in mapped]
            sides.append(([m["ids"] for m in mapped], shifted, begins, None))
        else:
            mapped = self.b.encode(texts, return_type="offset_mapping", return_bytes=True, num_threads=1)
            sides.append(([m["ids"] for m in mapped], [m["offsets"] for m in mapped], begins, None))
        for (ids, spans, base, to_bytes), width in zip(sides, self.widths):
            counts = np.array([len(i) for i in ids], np.int64)
            flat = np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum()))
            span = np.fromiter(chain.from_iterable(chain.from_iterable(spans)), np.int64, 2 * len(flat)).reshape(-1, 2) + np.repeat(base, counts)[:, None]
            span = span if to_bytes is None else to_bytes[span]
            heads = (np.cumsum(counts) - counts)[counts > 0]
            found.append((flat, refined_ends(span[:, 0], span[:, 1], width[flat], heads, begins[counts > 0]), counts))
        return found

    def links(self, texts: list[str], whole: bool = False) -> tuple[list[bytes | None], list[str]]:
        """The links of each text and its groups as text; None where tokens do not give its bytes."""
        held = [t.encode() for t in texts]
        data = b"".join(held)
        sizes = np.array([len(h) for h in held], np.int64)
        begins = np.cumsum(sizes) - sizes
        sides = self._tokens(texts, data, begins, whole)
        good = np.ones(len(texts), bool)
        for (ids, _, counts), table in zip(sides, self.tables):
            decoded = [table[i] for i in ids.tolist()]
            if b"".join(decoded) != data or (counts[sizes == 0] > 0).any():
                upto = np.cumsum([0, *counts]).tolist()
                good &= np.array([b"".join(decoded[i:j]) == h for i, j, h in zip(upto, upto[1:], held)], bool)
        (ids_a, ends_a), (ids_b, ends_b) = ((ids[keep], ends[keep]) for ids, ends, counts in sides for keep in [np.repeat(good, counts)])
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        flag = np.where(ends_a[at_a] == ends, _A_ENDS, 0) | np.where(ends_b[at_b] == ends, _B_ENDS, 0) if len(ends) else ends
        upto = np.searchsorted(ends, begins + sizes, "right")
        of = np.searchsorted(begins + sizes, ends)
        covered = ends - np.maximum(np.concatenate([[0], ends])[:-1], begins[of]) if len(ends) else ends
        rows = np.stack([ids_a[at_a], ids_b[at_b], covered, flag], 1).astype(np.int32)
        data, cuts = rows.tobytes(), [0, *upto.tolist()]
        parts = [data[16 * i : 16 * j] if ok else None for i, j, ok in zip(cuts, cuts[1:], good.tolist())]
        # Groups end where both end; each is written once, and each text joins its own.
        names_a, names_b = ([str(i) for i in ids.tolist()] for ids in (ids_a, ids_b))
        both = np.nonzero(flag == (_A_ENDS | _B_ENDS))[0]
        to_a, to_b = at_a[both] + 1, at_b[both] + 1
        written = [
            f"{','.join(names_a[i:j])}|{','.join(names_b[k:m])}"
            for i, j, k, m in zip([0, *to_a.tolist()], to_a.tolist(), [0, *to_b.tolist()], to_b.tolist())
        ]
        last = [0, *np.searchsorted(both, upto).tolist()]
        return parts, [";".join(written[i:j]) for i, j in zip(last, last[1:])]

    def _learn(self, texts: list[str]) -> list[bytes]:
        """The links of new segments, some at a time, as the libraries' spans are large objects."""
        at, found = len(self.cache.place), []
        while at + len(texts) > len(self.groups):
            self.groups = np.concatenate([self.groups, np.empty(max(1024, len(self.groups)), object)])
        odd = np.array([-1, -1, 0, 0], np.int32).tobytes()
        for i in range(0, len(texts), LEARNT_AT_ONCE):
            parts, self.groups[at + i : at + min(i + LEARNT_AT_ONCE, len(texts))] = self.links(texts[i : i + LEARNT_AT_ONCE])
            found += [odd if p is None else p for p in parts]
        return found

    def align(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The links of all texts in a line, where each text's begin (and the end), and its groups.

        A text that is empty, or whose tokens do not give a space and its bytes, has none.
        """
        filled = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
        filled = large(pc.if_else(pc.equal(texts, ""), texts, filled))
        if not self.known:
            return self._put_whole(filled, [True] * len(texts), np.empty((0, 4), np.int32), np.zeros(len(texts) + 1, np.int64), [""] * len(texts))
        segments, begins = cut(filled, self.marks)
        known = segments.dictionary_encode()
        which = known.indices.to_numpy(zero_copy_only=False)
        distinct = known.dictionary.to_pylist()
        starts, lengths = self.cache.places(distinct)
        place = np.fromiter(map(self.cache.place.__getitem__, distinct), np.int64, len(distinct))
        rows = self.cache.rows(starts[which], lengths[which])
        upto = np.concatenate([[0], np.cumsum(lengths[which])])[begins]
        names = self.groups[place[which]].tolist()
        groups = [";".join(names[i:j]) for i, j in zip(begins.tolist(), begins.tolist()[1:])]
        odd = np.add.reduceat(np.append(rows[:, 0] < 0, False), upto[:-1]) * (np.diff(upto) > 0) if len(texts) else np.empty(0)
        return self._put_whole(filled, (odd > 0).tolist(), rows, upto, groups)

    def _put_whole(self, texts: pa.LargeStringArray, odd: list[bool], rows: np.ndarray, upto: np.ndarray, groups: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The same with the texts that are ``odd`` encoded whole."""
        if not any(odd):
            return rows, upto, groups
        parts = [rows[i:j] for i, j in zip(upto, upto[1:])]
        for k in np.nonzero(odd)[0].tolist():
            text = texts[k].as_py()
            (found,), (named,) = self.links([text], whole=True) if text else ([b""], [""])
            parts[k] = np.frombuffer(found or b"", np.int32).reshape(-1, 4)
            groups[k] = named if found else ""
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)]), groups


@cache
def aligner(file_a: str, file_b: str) -> Aligner:
    """Kept while the worker lives."""
    return Aligner(file_a, file_b)


def spans(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """``doc_id`` and, as little-endian unsigned 32-bit integers, ids of A and B, the byte of
    the space and text that each ends at, and where both end. Documents without tokens (null or empty
    text, or tokens that do not give its bytes) have none of them."""

    schema = to_arrow_schema(StructType.fromDDL(SPANS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(file_a, file_b)
        for batch in batches:
            rows, upto, _ = own.align(large(batch.column("text")))
            found = []
            for i, j in zip(upto, upto[1:]):
                a, b, covered, flag = rows[i:j].T
                ends = np.cumsum(covered)
                in_a, in_b = (flag & _A_ENDS) > 0, (flag & _B_ENDS) > 0
                found.append([x.astype("<u4").tobytes() for x in (a[in_a], ends[in_a], b[in_b], ends[in_b], ends[in_a & in_b])])
            columns = [pa.array([f[k] for f in found], pa.binary()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=schema)

    return _texts(docs).mapInArrow(run, SPANS)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def linked(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """Per row: its numbers of tokens, groups and links, the digest of its groups, and its links
    as pairs ``a * size of B + b``, little-endian unsigned 64-bit. ``row`` tells equal rows apart;
    it is fixed only once the table is stored."""

    schema = to_arrow_schema(StructType.fromDDL(LINKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(file_a, file_b)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows, upto, groups = own.align(large(batch.column("text")))
            n = batch.num_rows
            flags = rows[:, 3]
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[upto]) for x in ((flags & _A_ENDS) > 0, (flags & _B_ENDS) > 0, flags == (_A_ENDS | _B_ENDS))]
            data = (rows[:, 0].astype("<u8") * np.uint64(own.size_b) + rows[:, 1].astype("<u8")).tobytes()
            held = [data[8 * i : 8 * j] for i, j in zip(upto.tolist(), upto.tolist()[1:])]
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            numbers = [pa.array(x, pa.int64()) for x in (*sums, np.diff(upto))]
            columns = [pa.array(np.arange(row, row + n)), batch.column("doc_id"), *numbers, pa.array(digests, pa.string()), pa.array(held, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            row += n

    return _texts(docs).mapInArrow(run, LINKS)


def _distinct(links: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of all rows, and which of them each link is."""
    whole = np.frombuffer(b"".join(links.to_pylist()), np.int64)
    known = pa.array(whole).dictionary_encode()
    return known.dictionary.to_numpy(), known.indices.to_numpy()


def pair_counts(held: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: links of each pair in the corpus, and whether none of its B id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, which = _distinct(batch.column("links"))
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(np.bincount(which, minlength=len(pairs)))], ["pair", "n"])

    counts = stored(held.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.pmod("pair", F.lit(size_b))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.join(most, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(held: DataFrame, pairs: DataFrame, most: int = SENT_PAIRS) -> DataFrame:
    """The rows of a stored table of links with ``n_best`` and ``count_sum`` in place of the links.

    The counts of the ``most`` frequent pairs go to every task. Links of the others, each of
    which is rare, are counted by row, joined with their counts by shuffle and summed.
    """
    bits = F.floor(F.log2("n")).cast("int")
    by_size = {r.bits: r.pairs for r in pairs.groupBy(bits.alias("bits")).agg(F.count("*").alias("pairs")).collect()}
    least, sent = 0, 0
    for k in sorted(by_size, reverse=True):
        if sent + by_size[k] > most:
            least = 1 << (k + 1)
            break
        sent += by_size[k]
    frequent = pairs.where(F.col("n") >= least).toArrow().sort_by("pair")
    shared = held.sparkSession.sparkContext.broadcast(tuple(frequent[c].to_numpy() for c in ("pair", "n", "best")))
    kept = [f for f in StructType.fromDDL(LINKS).fields if f.name != "links"]
    out = StructType(kept + StructType.fromDDL("n_best long, count_sum long, rest array<struct<pair:bigint,links:bigint>>").fields)

    names, schema = [f.name for f in kept], to_arrow_schema(out)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            pairs, which = _distinct(batch.column("links"))
            upto = np.cumsum([0, *batch.column("n_links").to_pylist()])
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            counts, bests = (np.where(hit, x[at] if len(known) else 0, 0).astype(np.int64)[which] for x in (n, best))
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[upto]) for x in (bests, counts)]
            # Links of pairs whose counts were not sent, by row and pair.
            missing = np.nonzero(~hit[which])[0]
            of = np.searchsorted(upto, missing, "right") - 1
            cell, many = np.unique(of * max(1, len(pairs)) + which[missing], return_counts=True)
            ends = np.searchsorted(cell // max(1, len(pairs)), np.arange(batch.num_rows + 1))
            fields = [pa.array(pairs[cell % max(1, len(pairs))], pa.int64()), pa.array(many, pa.int64())]
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["pair", "links"]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *map(pa.array, sums), rest], schema=schema)

    rows = stored(held.mapInArrow(score, out), "scored")
    loose = rows.select("row", F.inline("rest")).join(pairs.where(F.col("n") < least), "pair")
    added = loose.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("__best"), F.sum(F.col("links") * F.col("n")).alias("__sum"))
    joined = rows.drop("rest").join(added, "row", "left")
    return joined.select(
        *names[1:],
        (F.col("n_best") + F.coalesce("__best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("__sum", F.lit(0))).alias("count_sum"),
    )


def alignment(docs: DataFrame, file_a: str, file_b: str, most: int = SENT_PAIRS) -> DataFrame:
    """Per document: tokens, groups and links, links whose pair is its B id's most frequent
    (``n_best``, ties included), the sum of the pairs' counts (``count_sum``) and the groups' digest.

    A null or empty text, and one whose tokens do not give a space and its bytes, as one with
    the mark that the second tokenizer writes for a space, has zeros and an empty digest. Rows
    that repeat an identifier, or have none, are documents of their own and each counts. An
    empty table gives no rows. Columns beside doc_id and text are not read.
    """
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=file_b).get_piece_size()
    path = stored(linked(docs, file_a, file_b), "links", compression="zstd")
    return scored(path, stored(pair_counts(path, size_b), "pair-counts"), most)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
