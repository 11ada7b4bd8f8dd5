"""Divergence audit, packing and alignment against plain versions of themselves."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm import alignment, divergence, packing
from tidemark.llm.segments import byte_level, cut, piece_marks

from .conftest import PIECES, WORDS, odd_texts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
LINES = ["it's we'll x<|endoftext|> y", "a\n\nb\nc \n d", "élan  où ça, «là»; 1,234.5", "tabs\tand  runs   of spaces ", "▁ mark", "<s> </s> <0x41>", "漢字 and 😀😀 emoji!?", "\x00 zero", "é combined, a×b÷c"]


# Audit


def plain_audit(rows, least, most):
    rows = [tuple(x or "" for x in r) for r in rows]
    terms = [Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))) for t, _, _ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        own = [(r[2], t) for r, t in zip(rows, terms) if r[1] == lang]
        found = Counter(w for _, t in own for w in t)
        kept = sorted((w for w, n in found.items() if n >= least), key=str.encode)
        sources = sorted({s for s, _ in own})

        def shares(of):
            count = Counter()
            for t in of:
                count.update(t)
            n = sum(count[w] for w in kept)
            return {w: (count[w], 1 + 10**9 * (count[w] + 1) // (n + len(kept))) for w in kept}

        whole = shares([t for _, t in own])
        by = {s: shares([t for x, t in own if x == s]) for s in sources}
        for s in sources:
            pairs = [(sum((by[s][w][1] - by[o][w][1]) ** 2 // by[o][w][1] for w in kept), o) for o in sources if o != s]
            up = [((p - whole[w][1]) ** 2 // whole[w][1], w) for w, (n, p) in by[s].items() if n and p > whole[w][1]]
            for part, items, limit in (("pair", pairs, None), ("term", up, most)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(items[:limit], 1)]
    return sorted(out)


def audited(frame, **more):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in divergence.audit(frame, **more).collect())


def test_audit_against_plain_python(spark):
    rng = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["É", "é", "Zz", "zz"]
    rows = []
    for i in range(150):
        pick = [words[min(int(rng.expovariate(0.05)), len(words) - 1)] for _ in range(rng.randrange(40))]
        rows.append((rng.choice(" .1-").join(pick), rng.choice(["en", "en", "fr", None]), rng.choice(["a", "a", "b", "é", "z", None])))
    rows += [("", "xx", "only"), (None, "xx", "other"), ("one two", "yy", "s")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    assert audited(frame) == plain_audit(rows, 3, 200)
    # A cell of equal counts is cut by the rank limit inside one value.
    assert audited(frame, least_docs=1, most=5) == plain_audit(rows, 1, 5)


def test_audit_on_odd_rows(odd, empty):
    assert audited(empty) == []
    rows = [(r["text"], r["lang"], r["source"]) for r in odd.collect()]
    assert audited(odd) == plain_audit(rows, 3, 200)


def test_terms_do_not_cross_texts():
    terms, of = divergence.terms_of(pa.array(["ab", "", "Cd-e", "\t", "É1é"], pa.large_string()))
    assert terms.to_pylist() == ["ab", "cd", "e", "É", "é"] and of.tolist() == [0, 2, 2, 4, 4]


# Cuts


def whole_ids(tokenizer, texts):
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


ANY = st.text(st.sampled_from(" \n\t.,'!?-ab Zé×ñß 漢😀▁0<|>s"), max_size=40) | st.text(max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(ANY, max_size=6))
def test_segments_encode_as_the_whole(texts):
    encoder = packing.encoder(BYTES)
    ids, lengths = encoder.encode(pa.array(texts, pa.large_string()))
    ends = np.cumsum(lengths)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, lengths)] == whole_ids(Tokenizer.from_file(BYTES), texts)


def test_segments_lie_in_their_texts():
    segments, begins = cut(pa.array(["", " a b", "", "c,d  e"], pa.large_string()))
    assert segments.to_pylist() == [" a", " b", "c", ",d  e"] and begins.tolist() == [0, 0, 2, 2, 4]


def test_unknown_tokenizers_are_not_cut():
    assert byte_level(BYTES)[2] and not byte_level(WORDS)[2]
    assert packing.Encoder(WORDS).known is False
    ids, lengths = packing.Encoder(WORDS).encode(pa.array(["A b,c", ""], pa.large_string()))
    assert [ids[: lengths[0]].tolist(), []] == whole_ids(Tokenizer.from_file(WORDS), ["A b,c", ""])
    assert piece_marks(["▁a", "b.", "é,"]) == "".join(m for m in "!\"#$%&'()*+-/:;<=?@[\\]^_`{|}~")
    assert piece_marks(["a▁b"]) is None and piece_marks(["a\n"]) is None


# Packing


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + items[i] <= capacity}.values():
            bins[k] += items[i]
            put(i + 1, bins)
            bins[k] -= items[i]
        put(i + 1, [*bins, items[i]])

    put(0, [])
    return best[0]


def placed(plan, items, capacity):
    """Every piece in its place: sequences without gaps, none too long."""
    key, _, begin, first, per, offset = plan.arrays()
    held = defaultdict(list)
    for w, n in Counter(items).items():
        for number in range(n):
            s = np.searchsorted(key, w << 48 | number, "right") - 1
            among = number - begin[s]
            held[first[s] + among // per[s]].append((offset[s] + among % per[s] * w, w))
    for some in held.values():
        at = 0
        for start, w in sorted(some):
            assert start == at
            at += w
        assert at <= capacity
    assert sorted(held) == list(range(plan.sequences))
    return len(held)


class Reduced(packing.Plan):
    def _best_fit(self):
        pass


def test_the_reduction_keeps_an_optimum():
    rng = random.Random(1)
    worse = 0
    for _ in range(600):
        capacity = rng.choice([10, 20, 30])
        items = [rng.randrange(1, capacity + 1) if rng.random() < 0.5 else rng.randrange(max(1, capacity // 4), capacity // 2 + 2) for _ in range(rng.randrange(1, 10))]
        best = optimum(items, capacity)
        part = Reduced(Counter(items), capacity)
        rest = [w for w, n in part.left.items() for _ in range(n)]
        assert part.fixed + (optimum(rest, capacity) if rest else 0) == best
        worse += placed(packing.Plan(Counter(items), capacity), items, capacity) - best
    assert worse <= 6


def test_plans_do_not_grow_with_the_counts():
    few, many = ({w: k * (1024 // w) for w in range(1, 1025)} for k in (1, 10**9))
    plans = [packing.Plan(c, 1024) for c in (few, many)]
    assert len(plans[1].steps) < 2 * len(plans[0].steps) + 1024
    assert plans[1].sequences <= -(-sum(w * n for w, n in many.items()) // 1024) * 1.001
    assert plans[1].fixed > 0


def checked_pieces(rows, texts, capacity, end_id):
    tokenizer, by = Tokenizer.from_file(BYTES), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    total = 0
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        total += len(ids)
        own = sorted(by[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // capacity)))
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)]).tolist()[:-1]
        assert all(r["length"] == capacity for r in own[1:]) and sum(r["length"] for r in own) == len(ids)
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]].tobytes()
            assert r["ids_crc32"] == zlib.crc32(part) if "ids_crc32" in r else bytes(r["ids"]) == part
    return total


def test_packing_query(spark, sf, texts):
    rows = [r.asDict() for r in packing.op12_packing(spark, sf).collect()]
    total = checked_pieces(rows, texts, 1024, 2)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in held.values():
        some.sort()
        assert [o for o, _ in some] == np.cumsum([0, *(n for _, n in some)]).tolist()[:-1] and sum(n for _, n in some) <= 1024
    assert len(held) <= 1.02 * total / 1024 + 1


def test_sequences_hold_the_ids(spark):
    texts = dict(enumerate([*LINES, *odd_texts()[:7], "word " * 3000]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.pack(docs, BYTES, 2, 64)
    checked_pieces([r.asDict() for r in rows.collect()], texts, 64, 2)
    by = {r.sequence_id: r for r in packing.sequences(rows).collect()}
    for r in rows.collect():
        s = by[r.sequence_id]
        assert bytes(s.ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
        assert len(s.ids) == 4 * s.n_tokens == 4 * sum(s.lengths) and r.doc_id in s.doc_ids


def test_packing_on_odd_rows(odd, empty):
    rows = packing.pack(odd, BYTES, 2, checksums=True)
    assert rows.where("piece = 0").count() == odd.count()
    assert rows.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0
    assert rows.select("sequence_id", "offset").distinct().count() == rows.count()
    assert packing.pack(empty, BYTES, 2).count() == 0


# Alignment


def plain_links(text, a, b, tables):
    whole = (" " + (text or "")).encode()
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)] if text else [[], []]
    if not text or any(b"".join(t[i] for i in x) != whole for x, t in zip(ids, tables)):
        return [], [], [], []
    ends = [np.cumsum([len(t[i]) for i in x]).tolist() for x, t in zip(ids, tables)]
    links, groups, held, i, j = [], [], ([], []), 0, 0
    while i < len(ids[0]):
        links.append((ids[0][i], ids[1][j]))
        x, y = ends[0][i], ends[1][j]
        if x <= y:
            held[0].append(str(ids[0][i]))
        if y <= x:
            held[1].append(str(ids[1][j]))
        i, j = i + (x <= y), j + (y <= x)
        if x == y:
            groups.append("|".join(map(",".join, held)))
            held = [], []
    return ids[0], ids[1], links, groups


@pytest.fixture(scope="module")
def both():
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    tables = byte_level(BYTES)[0], [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]
    return a, b, tables


def plain_alignment(texts, both):
    found = [plain_links(t, *both) for t in texts]
    counts = Counter(x for f in found for x in f[2])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (len(a), len(b), len(g), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for a, b, x, g in found
    ]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("most", [alignment.SENT_PAIRS, 300, 0])
def test_alignment_against_a_plain_walk(spark, texts, both, most):
    """The same whether all counts, some or none of them are sent to the tasks."""
    held = [*LINES, *odd_texts(), *list(texts.values())[:60], LINES[0], LINES[0]]
    docs = spark.createDataFrame(list(enumerate(held)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in alignment.alignment(docs, BYTES, PIECES, most).collect()}
    assert [got[i] for i in range(len(held))] == plain_alignment(held, both)


def test_alignment_query(spark, sf, texts, both):
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in alignment.op13_alignment(spark, sf).collect()}
    assert [got[i] for i in texts] == plain_alignment(texts.values(), both)


@settings(max_examples=200, deadline=None)
@given(st.lists(ANY, max_size=5))
def test_links_of_any_texts(both, texts):
    rows, upto, groups = alignment.aligner(BYTES, PIECES).align(pa.array(texts, pa.large_string()))
    for text, i, j, named in zip(texts, upto, upto[1:], groups):
        _, _, links, plain = plain_links(text, *both)
        assert [tuple(r) for r in rows[i:j, :2].tolist()] == links and named == ";".join(plain)
        assert rows[i:j, 2].sum() == (len((" " + text).encode()) if links else 0)


def test_models_that_cannot_be_cut_are_encoded_whole(both):
    own = alignment.Aligner(BYTES, PIECES)
    own.known = False
    texts = [*LINES, "", "plain words, more words"]
    rows, upto, groups = own.align(pa.array(texts, pa.large_string()))
    for text, i, j, named in zip(texts, upto, upto[1:], groups):
        _, _, links, plain = plain_links(text, *both)
        assert [tuple(r) for r in rows[i:j, :2].tolist()] == links and named == ";".join(plain)


def test_ends_are_refined_inside_characters():
    # Spans of a letter, three byte tokens of one character (empty, empty, whole), and a word.
    begin, end = np.array([0, 1, 1, 1, 4]), np.array([1, 1, 1, 4, 8])
    assert alignment.refined_ends(begin, end, np.array([1, 1, 1, 1, 4]), np.array([0]), np.array([0])).tolist() == [1, 2, 3, 4, 8]
    # Two byte tokens that both span the character, and a token over its rest and the next.
    begin, end = np.array([0, 0, 0]), np.array([2, 2, 3])
    assert alignment.refined_ends(begin, end, np.array([1, 1, 1]), np.array([0]), np.array([0])).tolist() == [1, 2, 3]


def test_spans_tile_the_text(spark, both):
    docs = spark.createDataFrame(list(enumerate(LINES)), "doc_id long, text string")
    for r in alignment.spans(docs, BYTES, PIECES).collect():
        ids, ends, ids_b, ends_b, cuts = (np.frombuffer(r[c], "<u4").tolist() for c in ("a_ids", "a_ends", "b_ids", "b_ends", "group_ends"))
        whole = (" " + LINES[r.doc_id]).encode()
        for some, at, table in ((ids, ends, both[2][0]), (ids_b, ends_b, both[2][1])):
            assert [whole[i:j] for i, j in zip([0, *at], at)] == [table[k] for k in some]
        assert cuts == sorted(set(ends) & set(ends_b))


def test_alignment_on_odd_rows(odd, empty):
    assert alignment.alignment(odd, BYTES, PIECES).count() == odd.count()
    assert alignment.spans(odd, BYTES, PIECES).count() == odd.count()
    assert alignment.alignment(empty, BYTES, PIECES).count() == 0
