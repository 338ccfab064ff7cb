"""Byte-level BPE by a dynamic programme over prefixes.

For every prefix of a piece there is exactly one token that can end its BPE
encoding.  The tokens that end at a position come from the automaton of the
vocabulary (Aho-Corasick: a trie with suffix links); among them, token ``t`` is
the one whose start position holds a last token ``s`` such that merging the
pair's text leaves ``s, t`` as they are (pair compatibility).  Storing that one
token per prefix and following the back-pointers from the end gives the exact
ids, in time linear in the piece, whatever its length.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, text_or_empty

#: Fixed value: the public pattern of byte-level BPE vocabularies, with white
#: space written as the Unicode property.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

#: Entries kept in a worker's memo of pieces and of pair tests; a full memo is
#: emptied or aged, so memory stays bounded and results don't change.
PIECE_MEMO = 300_000
PAIR_MEMO = 500_000
#: Longer pieces are encoded each time instead of remembered.
MEMO_CHARS = 64


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceMemo(dict):
    """Encoded pieces, in two generations of bounded size: a full young one
    becomes the old one, and what is used again moves back."""

    def __init__(self, bpe: ByteBPE):
        super().__init__()
        self.bpe, self.old = bpe, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = self.bpe.encode_piece(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= PIECE_MEMO:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


class ByteBPE:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library."""

    def __init__(self, spec: str):
        import ahocorasick
        import regex

        j = json.loads(spec)
        model = j["model"]
        if model["type"] != "BPE" or j["pre_tokenizer"]["type"] != "ByteLevel" or j["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level BPE file without prefix space is needed")
        alphabet = _byte_of_char()
        vocab = {bytes(alphabet[c] for c in k): i for k, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.bytes_of = {i: k for k, i in vocab.items()}
        self.bytes_of |= {i: k.encode() for k, i in self.special.items()}
        self.coded = {i: i.to_bytes(4, "little") for i in self.bytes_of}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for r, m in enumerate(model["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            x, y = (vocab[bytes(alphabet[c] for c in s)] for s in (left, right))
            z = vocab[self.bytes_of[x] + self.bytes_of[y]]
            self.rank[x, y] = r
            if z not in self.halves:
                self.halves[z], self.made[z] = (x, y), r
        self.automaton = ahocorasick.Automaton()
        for k, i in vocab.items():
            if len(k) == 1 or i in self.halves:
                self.automaton.add_word(k.decode("latin-1"), (len(k), i))
        self.automaton.make_automaton()
        self.split = regex.compile(PATTERN).findall
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pairs: dict[int, bool] = {}
        self.pieces = PieceMemo(self)

    def compatible(self, s: int, t: int) -> bool:
        """Whether the BPE encoding of the text of ``s, t`` is ``s, t``.

        Undo merges from the later one back: at each step the two tokens that
        touch are the ends of partly built ``s`` and ``t``.  If the table would
        have merged them before the next merge inside ``s`` or ``t`` ran, the
        pair can't stand side by side."""
        rank, halves, made = self.rank, self.halves, self.made
        before = 1 << 60  # a merge of the two runs if its rank is below this
        while True:
            if rank.get((s, t), before) < before:
                return False
            made_s, made_t = made.get(s, -1), made.get(t, -1)
            if made_s < 0 and made_t < 0:
                return True
            if made_s > made_t:
                before, s = made_s, halves[s][1]
            else:  # on equal ranks the left pair merges first, so the right one is undone first
                before, t = made_t + 1, halves[t][0]

    def encode_piece(self, piece: str) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit integers."""
        text = piece.encode().decode("latin-1")
        n, pairs, compatible = len(text), self.pairs, self.compatible
        last, start = [-1] * (n + 1), [0] * (n + 1)
        done = 0  # the prefix that has its last token
        for at, (size, t) in self.automaton.iter(text):
            if at < done:
                continue
            begin = at + 1 - size
            if begin:
                key = last[begin] << 32 | t
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= PAIR_MEMO:
                        pairs.clear()
                    fits = pairs[key] = compatible(last[begin], t)
                if not fits:
                    continue
            done = at + 1
            last[done], start[done] = t, begin
        ids, end, coded = [], n, self.coded
        while end:
            ids.append(coded[last[end]])
            end = start[end]
        ids.reverse()
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text, special tokens recognised, as little-endian bytes."""
        if not self.at_special or not any(s in text for s in self.special):
            return self._ordinary(text)
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += self._ordinary(text[at:m.start()]), self.special[m[0]].to_bytes(4, "little")
            at = m.end()
        return b"".join([*out, self._ordinary(text[at:])])

    def _ordinary(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, special tokens written out."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", errors="replace")


_LOADED: dict[str, ByteBPE] = {}


def load(spec: str) -> ByteBPE:
    """One tokenizer per worker and file."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBPE(spec)
    return _LOADED[key]


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = True) -> DataFrame:
    """Encode whole texts and decode the ids again.

    ``tokenizer`` is the path of a byte-level BPE file (kept out of the
    repository); the driver reads it once and ships it with the tasks, so
    workers need no copy.  Result, one row per input row: ``id_col``,
    ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit
    integers), ``decoded_sha256``, and with ``with_ids`` also ``ids``
    (array of long) and ``decoded``.  A null text is encoded as the empty one:
    no tokens.  Texts stay whole; a piece of any length costs linear time.
    Map-only: no shuffle, each batch stands alone.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType
    fields = [T.StructField(id_col, kind), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("decoded", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(spec.value)
        for batch in batches:
            rows: list[list] = [[] for _ in fields[1:]]
            for text in batch.column(1).to_pylist():
                raw = bpe.encode(text)
                ids = np.frombuffer(raw, dtype="<u4")
                back = bpe.decode(ids)
                row = [len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()]
                for column, value in zip(rows, row + [ids.astype(np.int64), back] if with_ids else row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=k) for c, k in zip(rows, kinds, strict=False))],
                names=[f.name for f in fields])

    return map_batches(docs.select(F.col(id_col), text_or_empty(text_col)), run, T.StructType(fields))
