"""Token counts by a finite-state transducer compiled from a byte-level BPE vocabulary.

Words. The vocabulary is compiled, state by state as inputs need them, into a deterministic transducer over bytes. A
state knows the longest end of the input that can still grow into a token, and for each place in it the last token of the
input up to there and how many tokens fewer or more that has than the whole. A transition on a byte is annotated with the
number of tokens that it adds to the count (a merge takes some back). Which token comes last is decided as merging
decides it: exactly one token that ends the input follows the last token of what is before it, such that merging both
leaves them apart. A word's count is the sum along its path.

Texts. Between a letter and what is no letter, outside special strings, all states fall together: pre-tokens end there
whatever came before. So the state of the text transducer is what was read since the last such place, a transition reads a
chunk of text, and its annotation is the number of tokens that it finishes. Long texts are cut into chunks of CHUNK
characters. Each chunk's map from entry states to exit states and counts is made by itself: its reachable entry states are
those that the LOOK characters before it allow, one if there is a place in these at which all states fall together. Where
there is none (in a word of more than LOOK characters), the map is kept as the chunk, to be applied to any state. Maps are
composed FAN_IN at a time in a parallel scan until one a text is left, which is applied to the empty state.

Defined cases: a null text counts as empty, with no token; repeated rows are counted each; a very long text without a
place to fall together stays one piece of text. What a worker remembers is bounded by MEMO words and STATES states, also
inside one long word.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let, save

#: Characters in a chunk, and before it that tell its entry state; chunk maps composed at once.
CHUNK, LOOK, FAN_IN = 32_768, 256, 16
MEMO, STATES = 400_000, 300_000
#: How byte-level BPE cuts text, a fixed value; \s is Unicode's White_Space.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_FALLS_TOGETHER = regex.compile(r"(?<=\p{L})(?=\P{L})")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable Latin-1 stands for itself, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


#: entry state (None: any), text read from it first where it is None, tokens finished (after that), exit state (None: the one that the text leads to).
ChunkMap = tuple[str | None, str, int, str | None]


class Words(dict):
    """Word to token count, filled by its transducer."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        n = self[word] = self.count(word.encode())
        return n


class Transducer:
    def __init__(self, file: str):
        content = json.loads(file)
        model, letters = content["model"], _byte_letters()
        to_bytes = lambda x: bytes(letters[c] for c in x)
        self.special = [t["content"] for t in content["added_tokens"]]
        self.known = {to_bytes(t) for t in model["vocab"] if t not in self.special}
        self.ranks = {tuple(map(to_bytes, pair)): k for k, pair in enumerate(model["merges"])}
        self.prefixes = {t[:k] for t in self.known for k in range(1, len(t) + 1)}
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.margin = max(map(len, self.special), default=1) - 1
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.words = Words(self.count)
        self._reset()

    def _reset(self) -> None:
        start = (b"", (b"",), (0,))
        self.states, self.numbers, self.moves = [start], {start: 0}, [{}]

    def merged(self, text: bytes) -> list[bytes]:
        symbols = [text[k : k + 1] for k in range(len(text))]
        while len(symbols) > 1:
            rank, k = min((self.ranks.get((symbols[k], symbols[k + 1]), 1 << 60), k) for k in range(len(symbols) - 1))
            if rank == 1 << 60:
                break
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return symbols

    def _stay_apart(self, first: bytes, second: bytes) -> bool:
        if (known := self.apart.get((first, second))) is None:
            if len(self.apart) >= MEMO:
                self.apart.clear()
            known = self.apart[first, second] = self.merged(first + second) == ([first, second] if first else [second])
        return known

    def _move(self, number: int, byte: int) -> tuple[int, int]:
        """Compiles the transition of a state on a byte: the next state and the tokens it adds."""
        end, lasts, counts = self.states[number]
        grown = end + bytes([byte])
        while grown not in self.prefixes:
            grown = grown[1:]
        # lasts and counts are of the places len(end), ..., 1, 0 bytes before the end
        for k in range(len(grown), 0, -1):
            token = grown[-k:]
            if token in self.known and self._stay_apart(lasts[len(end) - k + 1], token):
                added = counts[len(end) - k + 1] + 1
                break
        keep = len(grown)
        following = (grown, (*lasts[len(lasts) - keep :], token), tuple(c - added for c in (*counts[len(counts) - keep :], added)))
        if (to := self.numbers.get(following)) is None:
            to = self.numbers[following] = len(self.states)
            self.states.append(following)
            self.moves.append({})
        self.moves[number][byte] = (to, added)
        return to, added

    def count(self, word: bytes) -> int:
        at = total = 0
        for byte in word:
            if len(self.states) > STATES:
                here = self.states[at]
                self._reset()
                if (at := self.numbers.setdefault(here, 1)) == 1:
                    self.states.append(here)
                    self.moves.append({})
            at, added = self.moves[at].get(byte) or self._move(at, byte)
            total += added
        return total

    def tokens(self, text: str) -> int:
        """In a text that is whole, or lies between places that fall together."""
        parts = self.cut.split(text) if self.cut else [text]
        get = self.words.__getitem__
        return len(parts) - 1 + sum(sum(map(get, PRE_TOKENS.findall(x))) for x in parts)

    def last_place(self, text: str, first: int) -> int | None:
        """The last place from first on at which all states fall together, as far as text alone can tell."""
        inside = [m.span() for m in self.cut.finditer(text)] if self.cut else []
        place = None
        for m in _FALLS_TOGETHER.finditer(text, first):
            p = m.start()
            if first <= p <= len(text) - self.margin and not any(a < p < b for a, b in inside):
                place = p
        return place

    def step(self, state: str, text: str) -> tuple[str, int]:
        """Reads text in a state: the exit state, and the tokens finished."""
        whole = state + text
        place = self.last_place(whole, 1)
        return (whole, 0) if place is None else (whole[place:], self.tokens(whole[:place]))

    def chunk_map(self, before: str | None, text: str) -> ChunkMap:
        """Of a chunk after the characters before (None at the start): from its one reachable entry state, or the chunk itself where that can't be told."""
        if before is None:
            entry = ""
        elif (place := self.last_place(before, max(1, self.margin))) is None:
            return None, text, 0, None
        else:
            entry = before[place:]
        leaves, n = self.step(entry, text)
        return entry, "", n, leaves

    def apply(self, some: ChunkMap, state: str) -> tuple[str, int]:
        """The exit state and the tokens finished, from a state."""
        entry, text, n, leaves = some
        if entry is None:
            state, own = self.step(state, text)
            return state if leaves is None else leaves, own + n
        if entry != state:
            raise ValueError("a chunk's entry state is not the exit state of the one before")
        return leaves, n

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a[3] is not None:
            leaves, n = self.apply(b, a[3])
            return a[0], a[1], a[2] + n, leaves
        return None, a[1] + (b[1] if b[0] is None else ""), b[2], b[3]

    def total(self, some: ChunkMap) -> int:
        state, n = self.apply(some, "")
        return n + self.tokens(state)


@lru_cache(2)
def compiled(file: str) -> Transducer:
    return Transducer(file)


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_MAP = "entry string, text string, n bigint, leaves string"
_FIELDS = ["entry", "text", "n", "leaves"]


def _plain(row: tuple) -> ChunkMap:
    return tuple(None if x is None or x != x else x for x in row)


def token_counts(docs: DataFrame, limit: int = 512, tokenizer_file: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than limit tokens): a row for each of docs."""
    file, id_type = Path(tokenizer_file or default_file()).read_text(), docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(file)
        for batch in batches:
            n = [machine.tokens(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    def read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(file)
        for batch in batches:
            made = [machine.chunk_map(b.as_py(), t.as_py()) for b, t in zip(batch.column("before"), batch.column("text"))]
            columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "n_bytes", "row", "of", "place")] + columns, ["doc_id", "n_bytes", "row", "of", "place", *_FIELDS])

    def compose(some: pd.DataFrame) -> pd.DataFrame:
        some, machine = some.sort_values("place"), compiled(file)
        made = None
        for row in some[_FIELDS].itertuples(index=False, name=None):
            made = _plain(row) if made is None else machine.compose(made, _plain(row))
        out = some.iloc[:1].copy()
        for name, value in zip(_FIELDS, made):
            out[name] = [value]
        out["place"] = out["place"] // FAN_IN
        return out

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = compiled(file)
        for some in batches:
            yield some[["doc_id", "n_bytes"]].assign(n_tokens=[machine.total(_plain(x)) for x in some[_FIELDS].itertuples(index=False, name=None)])

    result = f"doc_id {id_type}, n_bytes bigint, n_tokens bigint"
    short = rows.filter(F.char_length("text") <= CHUNK).mapInArrow(count, result)
    pieces = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))
    told = let(pieces, lambda p: F.transform(p, lambda x, i: F.struct(F.right(F.get(p, i - 1), F.lit(LOOK)).alias("before"), x.alias("text"))))
    long = rows.filter(F.char_length("text") > CHUNK).select("doc_id", "n_bytes", F.monotonically_increasing_id().alias("row"), told.alias("pieces"))
    long = long.select("doc_id", "n_bytes", "row", F.size("pieces").alias("of"), F.posexplode("pieces").alias("place", "p")).select("doc_id", "n_bytes", "row", "of", "place", "p.before", "p.text")
    # a very long text's chunks are read by many tasks
    maps = long.repartition("row", "place").mapInArrow(read_chunks, f"doc_id {id_type}, n_bytes bigint, row bigint, of int, place int, {_MAP}")
    maps = save(maps, "chunk-maps")
    longest = maps.agg(F.max("of")).first()[0] or 1
    done = maps
    while longest > 1:
        done = done.groupBy("row", F.floor(F.col("place") / FAN_IN).alias("part")).applyInPandas(compose, maps.schema)
        longest = -(-longest // FAN_IN)
    out = short.unionByName(done.mapInPandas(close, result))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
