"""SentencePiece encoding and decoding by a forward pass over shared prefixes.

A text is normalised and cut before each run of word marks, where no piece crosses (this is checked when the model is
read). Of each batch of texts, the distinct marked words are sorted, which lists the paths of their trie depth-first, and
each word goes on from the forward states of the prefix that it shares with the one before. A prefix's state is the best
score of a segmentation, and the last piece of that; a word's ids are read back from its last state.

Which pieces may follow which is a constraint on the transitions, and depends on the model's type:

* unigram: any piece may follow any other (plain Viterbi);
* BPE: piece p may follow piece q only if merging q and p together leaves them apart. Merging by rank never changes what
  it made of a prefix unless its last piece goes, so the segmentations that hold to this are those that merging makes, and
  the best of them has the library's ids. Without the constraint, the best score is often another segmentation's: the
  scores of a BPE model are ranks. Piece pairs are judged once and remembered.

Texts are encoded where they lie; nothing is shuffled. What is remembered is bounded by MEMO words and MEMO pairs. The
model file's bytes travel with the tasks.

Defined cases: a null text counts as empty and has no pieces; repeated rows are encoded alike; a character without a
piece becomes its UTF-8 bytes' pieces (or the unknown piece where the model has no bytes). Decoding gives back the
normalised text; the mark character itself (U+2581) in a text comes back as a space.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words, and pairs of pieces, that a worker remembers at most.
MEMO = 1_000_000
#: Characters of text that are encoded together.
BATCH = 8_000_000
_INT = struct.Struct("<i").pack
_UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if data[at - 1] < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Pieces:
    """A model's pieces, and the encoder over them."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self.library.get_piece_size())
        # the trainer's settings are field 2; of these, field 3 is the type, 1 for unigram (which is the default) and 2 for BPE
        self.unigram = dict(_fields(dict(_fields(model))[2])).get(3, 1) == 1
        text = {i: self.library.id_to_piece(i) for i in ids}
        plain = [i for i in ids if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))]
        if any(re.search(f"[^{MARK}]{MARK}", text[i]) for i in plain):
            raise ValueError("a piece has a word mark after another character")
        self.codes = {text[i]: _INT(i) for i in plain}
        self.scores = {text[i]: self.library.get_score(i) for i in plain}
        self.bytes = {int(text[i][3:5], 16): i for i in ids if self.library.is_byte(i)}
        self.unknown = self.library.unk_id()
        self.unknown_score = min(self.scores.values(), default=0.0) - 10.0
        self.longest = max(map(len, self.codes), default=1)
        self.out = [text[i].replace(MARK, " ").encode() for i in ids]
        for byte, i in self.bytes.items():
            self.out[i] = bytes([byte])
        for i in ids:
            if self.library.is_control(i):
                self.out[i] = b""
        self.apart: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        #: Forward states that words shared with the word before, and all that they have.
        self.forward = [0, 0]

    def forget(self) -> None:
        """Empties the memos: a worker outlives its task, and would hold them while it does others' work."""
        self.apart, self.words = {}, {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging the neighbours of best score, the first of equals, again and again."""
        symbols, scores = list(text), self.scores
        while len(symbols) > 1:
            best = max((s, -k) for k in range(len(symbols) - 1) if (s := scores.get(symbols[k] + symbols[k + 1], -np.inf)) is not None)
            if best[0] == -np.inf:
                break
            k = -best[1]
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return symbols

    def _stay_apart(self, first: str, second: str) -> bool:
        if len(self.apart) >= MEMO:
            self.apart.clear()
        self.apart[first, second] = known = self.merged(first + second) == ([first, second] if first else [second])
        return known

    def _extend(self, word: str, state: list[tuple[float, str]]) -> None:
        """Adds to state, which has those of shorter prefixes, the best score and the last piece of every further prefix of word; of equal scores the longer piece's."""
        scores, longest, apart, free = self.scores, self.longest, self.apart, self.unigram
        for end in range(len(state), len(word) + 1):
            best = None
            for start in range(max(0, end - longest), end):
                piece = word[start:end]
                score = scores.get(piece)
                if score is None:
                    if end - start > 1:
                        continue
                    score = self.unknown_score
                before, last = state[start]
                if not free and end - start > 1:
                    stay = apart.get((last, piece))
                    if not (self._stay_apart(last, piece) if stay is None else stay):
                        continue
                if best is None or before + score > best[0]:
                    best = (before + score, piece)
                if not free:
                    break  # of the pieces that end here, one fits what is before it
            state.append(best)

    def _code(self, piece: str) -> bytes:
        """For a character without a piece."""
        return b"".join(_INT(self.bytes[b]) for b in piece.encode()) if self.bytes else _INT(self.unknown)

    def learn(self, words: set[str]) -> None:
        """Puts the ids of words into self.words, as the bytes of 32-bit numbers."""
        new = sorted(words.difference(self.words))
        if len(self.words) + len(new) > MEMO:
            self.words = {w: self.words[w] for w in words & self.words.keys()}
        state = [(0.0, "")]
        before, codes = "", self.codes
        for word in new:
            shared = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                shared += 1
            del state[shared + 1 :]
            self.forward[0] += shared
            self.forward[1] += len(word)
            self._extend(word, state)
            before, end, found = word, len(word), []
            while end:
                piece = state[end][1]
                code = codes.get(piece)
                found.append(self._code(piece) if code is None else code)
                end -= len(piece)
            found.reverse()
            if not self.bytes:  # neighbours without a piece are one unknown piece
                unknown = _INT(self.unknown)
                found = [x for k, x in enumerate(found) if x != unknown or not k or found[k - 1] != unknown]
            self.words[word] = b"".join(found)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as the bytes of 32-bit numbers."""
        units = [_UNIT.findall(x) for x in self.library.normalize(texts)]
        self.learn(set().union(*units))
        get = self.words.__getitem__
        return [b"".join(map(get, x)) for x in units]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.out.__getitem__, ids))
        return text.removeprefix(b" ").decode(errors="replace")


@lru_cache(2)
def pieces(model: bytes) -> Pieces:
    return Pieces(model)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _over(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in runs of about BATCH characters."""
    run, size = [], 0
    for x in texts:
        run.append(x.as_py())
        size += len(run[-1])
        if size >= BATCH:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """doc_id, ids (array of int), decoded (the text that the ids give): a row for each of docs."""
    model, id_type = Path(model_file or default_model()).read_bytes(), docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        try:
            for batch in batches:
                at = 0
                for texts in _over(batch.column("t")):
                    found = [np.frombuffer(x, np.int32) for x in coder.encode(texts)]
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                    decoded = pa.array([coder.decode(x.tolist()) for x in found], pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), ids, decoded], ["doc_id", "ids", "decoded"])
                    at += len(texts)
        finally:
            coder.forget()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, f"doc_id {id_type}, ids array<int>, decoded string")


def report(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 (of the ids as little-endian 32-bit numbers), decoded_sha256, n_bytes of the decoded text."""
    model, id_type = Path(model_file or default_model()).read_bytes(), docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, sha = pieces(model), hashlib.sha256
        for batch in batches:
            rows = []
            for texts in _over(batch.column("t")):
                for x in coder.encode(texts):
                    back = coder.decode(np.frombuffer(x, np.int32).tolist()).encode()
                    rows.append((len(x) // 4, sha(x).hexdigest(), sha(back).hexdigest(), len(back)))
            n, ids, texts, size = zip(*rows) if rows else ((), (), (), ())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(size, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "ids_sha256", "decoded_sha256", "n_bytes"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, f"doc_id {id_type}, n_pieces bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint")
