"""BPE encoding by forced-boundary splitting, and decoding.

Byte pairs that occur inside no vocabulary token can never be merged, so a text may be
cut there and its fragments encoded on their own; their ids, concatenated, are the ids
of the text.  The pairs are collected from the vocabulary file.  A cut is taken only
where it is certain whatever surrounds it:

* between two ASCII bytes (compared in lower case, as the vocabulary is), so that neither
  composition nor case folding reaches across it;
* where the two bytes are of different classes (space, letter, digit, symbol) or both
  digits or spaces, the tokenizer's own word border: the left fragment ends a word;
* between two letters or two symbols, inside a word: the left fragment is encoded
  without the word-end mark, which only the last fragment of a word carries.  The
  apostrophe, which starts the contractions, is never cut from its neighbours so.

Fragments repeat, so each task keeps bounded tables of fragments and of
space-delimited chunks and encodes a batch's missing fragments at once.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from cinerank.llm.common import bounded_batches, text_of

LETTER, DIGIT, SYMBOL, SPACE, WIDE = range(5)
BORDER, INSIDE = 1, 2
TABLE_SIZE = 150_000     # chunks, and fragments, a task remembers
SLICE = 256              # documents encoded and handed on at a time
ENCODED = "n_tokens long, ids_le binary, decoded string"


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: bytes that print stand for
    themselves, the others follow from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


def _byte_class() -> np.ndarray:
    out = np.full(256, SYMBOL)
    out[128:] = WIDE
    for members, c in ((range(97, 123), LETTER), (range(65, 91), LETTER), (range(48, 58), DIGIT), ((32, *range(9, 14)), SPACE)):
        out[list(members)] = c
    return out


class Encoder:
    """Encoder of one tokenizer file (BPE over byte stand-ins with a word-end suffix)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        spec["truncation"] = spec["padding"] = None
        self.whole = Tokenizer.from_str(json.dumps(spec))
        suffix = spec["model"]["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        bare = json.loads(json.dumps(spec))
        bare["model"]["end_of_word_suffix"], bare["added_tokens"] = None, []
        self.bare = Tokenizer.from_str(json.dumps(bare))
        self.names = {i: t for t, i in (spec["model"]["vocab"] | special).items()}
        self.cuts = self._cuts(spec["model"]["vocab"], suffix)
        self.hides = (_byte_class() == WIDE) | (np.arange(256) == 39)        # bytes next to which a word border is not cut
        self.special_ids = {t: np.uint32(i).tobytes() for t, i in special.items()}
        self.ids = dict(self.special_ids)            # chunk -> ids
        self.shown = {t: t for t in special}         # chunk -> decoded text
        self.fragments: dict[bytes, bytes] = {}      # fragment that ends a word -> ids
        self.inner: dict[bytes, bytes] = {}          # fragment inside a word -> ids

    @staticmethod
    def _cuts(vocab: dict[str, int], suffix: str) -> np.ndarray:
        """(256, 256) table: 0 no cut, BORDER or INSIDE, for bytes x, y side by side."""
        alphabet, inside = _byte_alphabet(), np.zeros((256, 256), bool)
        for token in vocab:
            raw = [alphabet[c] for c in token.removesuffix(suffix)]
            inside[raw[:-1], raw[1:]] = True
        kind, low = _byte_class(), np.arange(256)
        low[65:91] += 32
        never = ~inside[low[:, None], low[None, :]]
        a, b = kind[:, None], kind[None, :]
        ascii_pair = (a != WIDE) & (b != WIDE)
        border = (a == SPACE) | (b == SPACE) | (a != b) | ((a == DIGIT) & (b == DIGIT))
        quote = (np.arange(256) == 39)
        inner = (a == b) & ((a == LETTER) | (a == SYMBOL)) & ~quote[:, None] & ~quote[None, :]
        return np.where(never & ascii_pair & border, BORDER, np.where(never & ascii_pair & inner, INSIDE, 0)).astype(np.uint8)

    def _encode_fragments(self, wanted: set[bytes], model, table: dict[bytes, bytes]) -> None:
        if len(table) + len(wanted) > TABLE_SIZE:
            table.clear()
        todo = wanted - table.keys()
        plain = [f for f in todo if f.isalpha()]              # lower-case ASCII words need no normalising
        merges = model.model
        for f in plain:
            table[f] = array("I", [t.id for t in merges.tokenize(f.decode("ascii"))]).tobytes()
        other = list(todo.difference(plain))
        for f, e in zip(other, model.encode_batch_fast([f.decode("utf-8") for f in other], add_special_tokens=False)):
            table[f] = array("I", e.ids).tobytes()

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks not yet in the tables: cut, encode the fragments, concatenate."""
        raw = [c.encode("utf-8") for c in chunks]
        b = np.frombuffer(b" ".join(raw), np.uint8)
        limits = np.cumsum([len(r) + 1 for r in raw]) - 1            # where each chunk ends
        cut = self.cuts[b[:-1], b[1:]]
        after_wide = np.append(b[2:] >= 128, False)[:len(cut)]       # the right byte may compose with what follows it
        cut[(cut == INSIDE) & after_wide] = 0
        cut[limits[:-1] - 1] = cut[limits[:-1]] = BORDER
        hidden = np.append(0, np.cumsum(self.hides[b]))
        at = np.nonzero(cut)[0]
        word = np.append(0, np.maximum.accumulate(np.where(cut[at] == BORDER, at + 1, 0))[:-1])
        at = at[(cut[at] == BORDER) | (hidden[at + 1] == hidden[word])]      # the left fragment must lie in one word
        starts, ends = np.append(0, at + 1), np.append(at + 1, len(b))
        inner = np.append(cut[at] == INSIDE, False)
        keep = np.isin(starts, limits, invert=True)                  # not the spaces between chunks
        buffer = b.tobytes()
        pieces = [buffer[i:j] for i, j in zip(starts[keep].tolist(), ends[keep].tolist())]
        pieces = [f.lower() if f.isascii() else f for f in pieces]
        inner = inner[keep].tolist()
        self._encode_fragments({f for f, i in zip(pieces, inner) if not i}, self.whole, self.fragments)
        self._encode_fragments({f for f, i in zip(pieces, inner) if i}, self.bare, self.inner)
        found = [(self.inner if i else self.fragments)[f] for f, i in zip(pieces, inner)]
        first = np.searchsorted(starts[keep], np.append(0, limits + 1)).tolist()
        for chunk, i, j in zip(chunks, first, first[1:]):
            ids = found[i] if j == i + 1 else b"".join(found[i:j])
            self.ids[chunk] = ids
            self.shown[chunk] = " ".join([self.names[k] for k in memoryview(ids).cast("I")])

    def _parts(self, text: str) -> list[str]:
        """Chunks of a text: cut at spaces and around special tokens."""
        if self.split_special is None or not self.split_special.search(text):
            return _chunks(text)
        out = []
        for i, piece in enumerate(self.split_special.split(text)):
            out += [piece] if i % 2 else _chunks(piece)
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(little-endian unsigned 32-bit ids, decoded text) of each text."""
        parts = [self._parts(t) for t in texts]
        wanted: set[str] = set()
        for own in parts:
            wanted.update(own)
        if len(self.ids) + len(wanted) > TABLE_SIZE:
            self.ids, self.shown = dict(self.special_ids), {t: t for t in self.special_ids}
        missing = list(wanted - self.ids.keys())
        if missing:
            self._learn(missing)
        for own in parts:
            yield b"".join(map(self.ids.__getitem__, own)), " ".join(filter(None, map(self.shown.__getitem__, own)))


def _chunks(text: str) -> list[str]:
    """Space-delimited chunks.  Only characters that every part of the tokenizer takes for
    white space separate; str.split() also splits at four control characters."""
    return re.split("[ \t\n\r\x0b\x0c]+", text.strip(" \t\n\r\x0b\x0c")) if _CONTROL.search(text) else text.split()


_CONTROL = re.compile("[\x1c-\x1f]")


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs``: ``keep`` columns, n_tokens, ids_le (ids as little-endian unsigned
    32-bit integers) and decoded (the decoder's text of these ids).

    * Whole texts, one narrow pass without a shuffle; null counts as empty, and an empty
      text, or one of white space only, has no ids and decodes to the empty text.
    * ``tokenizer_path`` names the file on every worker (part of an installed library).
    * Repeated rows are encoded one by one; an empty table gives an empty result; other
      columns are ignored."""
    bounded_batches(docs.sparkSession)
    own = docs.select(*keep, text_of(text_col).alias("text__"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer_path)
        for rows in batches:
            for i in range(0, len(rows), SLICE):
                part = rows.iloc[i:i + SLICE]
                done = list(encoder.encode(part["text__"].tolist()))
                yield part[list(keep)].assign(n_tokens=[len(d[0]) // 4 for d in done], ids_le=[d[0] for d in done],
                                              decoded=[d[1] for d in done])
    return own.mapInPandas(run, f"{schema}, {ENCODED}" if schema else ENCODED)
