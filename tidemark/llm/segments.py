"""Texts cut where no token of a tokenizer can lie across, so that pieces are encoded once."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

#: ASCII marks, and what the byte-level pre-tokenizer's alphabet leaves as it is.
MARKS = "!\"#$%&'()*+,-./:;<=?@[\\]^_`{|}~"
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

_VISIBLE, _LETTER, _MARK = 1, 2, 4
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] |= _VISIBLE
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] |= _LETTER
_LATIN = "[A-Za-zÀ-ÖØ-öø-ÿ]"


def byte_level(file: str) -> tuple[list[bytes], list[str], bool]:
    """The bytes of each id, the added tokens, and whether texts may be cut as below.

    Cuts are right for the byte-level BPE whose pre-tokenizer parts letters, digits, marks and
    white space, and for nothing else; other files are encoded whole.
    """
    with open(file, encoding="utf-8") as held:
        spec = json.load(held)
    alphabet = {chr(b): b for b in _PRINTED}
    alphabet |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}
    added = spec["added_tokens"]
    size = max([*spec["model"]["vocab"].values(), *(t["id"] for t in added)]) + 1
    table = [b""] * size
    for token, i in spec["model"]["vocab"].items():
        table[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    for token in added:
        table[token["id"]] = token["content"].encode()
    before, model = spec["pre_tokenizer"] or {}, spec["model"]
    known = (
        before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and spec["normalizer"] is None
        and model["type"] == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"] for t in added)
    )
    return table, [t["content"] for t in added], bool(known)


def piece_marks(pieces: list[str]) -> str | None:
    """The marks that no piece has behind a letter; None if a piece crosses a space or a line end."""
    if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
        return None
    crossed = {m for p in pieces for m in re.findall(f"(?<={_LATIN})[{re.escape(MARKS)}]", p)}
    return "".join(m for m in MARKS if m not in crossed)


def cut(texts: pa.LargeStringArray, marks: str = MARKS) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The segments of all texts in a line, and where each text's begin (and the end).

    Cuts lie before a single space that stands between a character and a visible one, between
    a letter and a mark behind it, and around a single line end. A space belongs to the word
    behind it. Whatever is not sure, as runs of spaces, stays inside a segment.
    """
    _, offsets, data = texts.buffers()
    begins = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    low = int(begins[0])
    text = np.frombuffer(data, np.uint8)[low : begins[-1]] if data is not None else np.empty(0, np.uint8)
    begins, n = begins - low, int(begins[-1]) - low
    if n == 0:
        return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
    kinds = _KINDS.copy()
    kinds[[ord(m) for m in marks]] |= _MARK
    kind = kinds[text]
    visible, letter = (kind & _VISIBLE) > 0, (kind & _LETTER) > 0
    # U+00C0 to U+00FF but the signs of multiplication and division are letters.
    letter[1:] |= (text[:-1] == 0xC3) & (text[1:] >= 0x80) & (text[1:] < 0xC0) & (text[1:] != 0x97) & (text[1:] != 0xB7)
    shown = visible | (text == 0xC3)
    here = np.zeros(n + 1, bool)
    space = text == 0x20
    here[1 : n - 1] = space[1:-1] & ~space[:-2] & shown[2:]
    here[1:n] |= ((kind[1:] & _MARK) > 0) & letter[:-1]
    line = np.zeros(n, bool)
    line[1:-1] = (text[1:-1] == 0x0A) & visible[:-2] & shown[2:]
    here[:n] |= line
    here[1:] |= line
    here[begins] = True
    starts = np.nonzero(here)[0]
    if starts[-1] != n:
        starts = np.append(starts, n)
    segments = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer((starts + low).astype(np.int64)), data)
    return segments, np.searchsorted(starts, begins)


def uncut(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    return texts, np.arange(len(texts) + 1)


def large(texts: pa.Array | pa.ChunkedArray) -> pa.LargeStringArray:
    """One array of texts with an empty one for null."""
    whole = texts.cast(pa.large_string()).fill_null("")
    return whole.combine_chunks() if isinstance(whole, pa.ChunkedArray) and whole.num_chunks != 1 else whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole
