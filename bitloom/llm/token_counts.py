"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

Texts go through the library of the tokenizer's file, in batches of about equal
bytes.  Long texts are cut into pieces first, and the pieces' counts added up,
but only for a byte-level BPE whose file proves the cuts safe:

* before a space or line feed that follows a letter, mark, number or sign: no
  pre-token of the byte-level pattern reaches from a sign into white space;
* before a comma or full stop that follows a letter or digit;
* between two other characters, away from apostrophes, where no token of the
  vocabulary holds the byte before the cut followed by the byte after it: every
  merge makes a token, so none can reach over the cut.

Cut wherever a byte tells that a place is of the first two kinds, a text falls
into units, most of them a word with the white space before it.  Arrow finds the
distinct units of a block of bytes, each goes through the library once, and a
worker remembers its count, up to a bound of memory; what was forgotten is
encoded again, so counts do not depend on it.

Any other kind of tokenizer gets whole texts.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spill import tune

#: Characters of a piece, bytes of a batch for the library and of a block of units, bytes of a unit that is remembered, how many of these.
PIECE, BATCH, BLOCK, LONG, KEPT = 8_000, 1 << 20, 4 << 20, 64, 1 << 18
_CUT = regex.compile(r"(?<=[\p{L}\p{M}\p{N}\p{P}\p{S}])(?=[ \n])")
_SOLID = regex.compile(r"[\p{L}\p{M}\p{N}\p{P}\p{S}]")


def _byte_of() -> dict[str, int]:
    """The bytes that the printable stand-ins of a byte-level vocabulary mean: printable Latin-1 characters are themselves, others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(other)}


def joined_bytes(spec: dict) -> np.ndarray | None:
    """Which pairs of neighbouring bytes some token holds (256 x 256); None if the tokenizer is not a plain byte-level BPE, whose texts must stay whole."""
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and spec.get("normalizer") is None
    bpe = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
    added = spec.get("added_tokens") or []
    if not (plain and bpe) or any(t["lstrip"] or t["rstrip"] or t["single_word"] or regex.search(r"[\s.,]", t["content"]) for t in added):
        return None
    meaning, pairs = _byte_of(), np.zeros((256, 256), bool)
    tokens = [[meaning[c] for c in t] for t in model["vocab"] if all(c in meaning for c in t)] + [list(t["content"].encode()) for t in added]
    for t in tokens:
        pairs[t[:-1], t[1:]] = True
    return pairs


@lru_cache(4)
def counter(path: str) -> tuple[Callable[[list[str]], list[int]], np.ndarray | None]:
    """A function from a list of texts to their token counts, and the byte pairs that must not be cut (None: nothing may)."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], None
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    with open(path, encoding="utf-8") as f:
        pairs = joined_bytes(json.load(f))
    return lambda texts: list(map(len, library.encode_batch_fast(texts, add_special_tokens=False))), pairs


def _inside(text: str, start: int, stop: int, pairs: np.ndarray) -> int:
    """The first safe place between two characters that are not white space, or -1."""
    for k in range(start, stop):
        a, b = text[k - 1], text[k]
        if "'" not in text[max(0, k - 3) : k + 1] and not pairs[a.encode("utf-8", "replace")[-1], b.encode("utf-8", "replace")[0]] and _SOLID.match(a) and _SOLID.match(b):
            return k
    return -1


def pieces_of(text: str, pairs: np.ndarray | None, size: int = PIECE) -> list[str]:
    """The text cut at safe places into pieces of ``size`` characters or little more; a run without a safe place stays whole."""
    out, at = [], 0
    while pairs is not None and len(text) - at > size:
        m = _CUT.search(text, at + size)
        end = m.start() if m else len(text)
        if end - at > 2 * size:
            inside = _inside(text, at + size, end, pairs)
            end = end if inside < 0 else inside
        if end == len(text):
            break
        out.append(text[at:end])
        at = end
    out.append(text[at:])
    return out


def unit_cuts(data: np.ndarray) -> np.ndarray:
    """Where UTF-8 bytes have a space or line feed after a character that its bytes show not to be white space, or a comma or full stop after an ASCII letter or digit.

    No white space is visible ASCII, or begins with a byte other than C2, E1, E2
    and E3 beyond ASCII.  No pre-token holds a letter or digit and then a stop.
    """
    space = np.flatnonzero((data == 0x20) | (data == 0x0A))
    at = space[space > 0]
    last = data[at - 1]
    safe = (last > 0x20) & (last < 0x7F)
    beyond = np.flatnonzero(last >= 0x80)
    for back, low, high in ((2, 0xC3, 0xDF), (3, 0xE0, 0xE0), (3, 0xE4, 0xEF), (4, 0xF0, 0xF4)):
        lead = data[np.maximum(at[beyond] - back, 0)]
        # A lead byte so many places back belongs to the character before the cut: other bytes of it are under C0.
        safe[beyond] |= (at[beyond] >= back) & (lead >= low) & (lead <= high)
    stop = np.flatnonzero((data == 0x2C) | (data == 0x2E))
    stop = stop[stop > 0]
    before = data[stop - 1]
    folded = before | 0x20
    alnum = ((folded >= 0x61) & (folded <= 0x7A)) | ((before >= 0x30) & (before <= 0x39))
    return np.sort(np.concatenate([at[safe], stop[alnum]]), kind="stable")


class Remembered:
    """Counts of units: those asked for lately are remembered, at most twice KEPT of LONG bytes each."""

    def __init__(self, count: Callable[[list[str]], list[int]], pairs: np.ndarray, kept: int = KEPT):
        self.count, self.pairs, self.kept = count, pairs, kept
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def _encode(self, units: list[bytes]) -> list[int]:
        """The counts of units that are not remembered, the library's batches bounded by bytes."""
        out: list[int] = []
        for at in range(0, len(units), BATCH // LONG):
            some = units[at : at + BATCH // LONG]
            short = iter(self.count([unit.decode() for unit in some if len(unit) <= LONG]))
            out += [next(short) if len(unit) <= LONG else self._long(unit.decode()) for unit in some]
        return out

    def _long(self, unit: str) -> int:
        pieces = pieces_of(unit, self.pairs)
        step = max(1, BATCH // (4 * PIECE))
        return sum(sum(self.count(pieces[k : k + step])) for k in range(0, len(pieces), step))

    def __call__(self, units: list[bytes]) -> list[int]:
        """The count of each of some distinct units."""
        counts = list(map(self.young.get, units))
        unknown = [k for k, n in enumerate(counts) if n is None]
        names = [units[k] for k in unknown]
        found = list(map(self.old.get, names))
        fresh = iter(self._encode([unit for unit, n in zip(names, found) if n is None]))
        found = [next(fresh) if n is None else n for n in found]
        for k, n in zip(unknown, found):
            counts[k] = n
        lately = [(unit, n) for unit, n in zip(names, found) if len(unit) <= LONG][: self.kept]
        if len(self.young) + len(lately) > self.kept:
            self.old, self.young = self.young, {}
        self.young.update(lately)
        return counts


@lru_cache(4)
def remembered(path: str) -> Remembered:
    return Remembered(*counter(path))


def _unit_lengths(sums: Remembered, texts: pa.Array, block: int = BLOCK) -> np.ndarray:
    """Token counts of texts, a block of bytes at a time."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    totals = np.zeros(len(texts), np.int64)
    if not len(texts) or ends[-1] == ends[0]:
        return totals
    every, at, size = np.frombuffer(data, np.uint8), int(ends[0]), block
    while at < ends[-1]:
        stop = min(at + size, int(ends[-1]))
        inside = ends[np.searchsorted(ends, at, "right") : np.searchsorted(ends, stop, "right")]
        edges = np.sort(np.concatenate([unit_cuts(every[at:stop]) + at, inside]), kind="stable")
        edges = edges[np.flatnonzero(np.diff(edges, prepend=at))]
        if not len(edges):  # a unit longer than the block
            size *= 2
            continue
        edges = np.concatenate([[at], edges])
        # A unit that the block cuts off is left for the next one.
        units = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), data]).dictionary_encode()
        counts = np.array(sums(units.dictionary.to_pylist()), np.int64)[units.indices.to_numpy()]
        owners = np.searchsorted(ends, edges[:-1], "right") - 1
        np.add.at(totals, owners, counts)
        at, size = int(edges[-1]), block
    return totals


def _lengths(tokenizer: str, texts: pa.Array) -> pa.Array:
    count, pairs = counter(tokenizer)
    if pairs is not None:
        return pa.array(_unit_lengths(remembered(tokenizer), texts))
    out: list[int] = []
    pending: list[str] = []
    held = 0
    for text in texts:
        whole = text.as_py() or ""
        n = len(whole.encode())
        if pending and held + n > BATCH:
            out += count(pending)
            pending, held = [], 0
        pending.append(whole)
        held += n
    return pa.array(out + (count(pending) if pending else []), pa.int64())


def with_token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """docs with ``n_tokens`` (a column of that name is replaced): how many tokens each whole text has. A null text has none. No shuffle."""
    tune(docs.sparkSession)
    others = [c for c in docs.columns if c not in (text_col, "n_tokens")]
    row = docs.select(F.struct(*others).alias("row") if others else F.struct(F.lit(0).alias("none")).alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lengths(tokenizer, batch.column(1))], names=["row", "text", "n_tokens"])

    out = row.mapInArrow(run, f"row {row.schema['row'].dataType.simpleString()}, text string, n_tokens long")
    own = {text_col: F.col("text")} | {c: F.col("row")[c] for c in others}
    return out.select(*(own[c].alias(c) for c in docs.columns if c in own), "n_tokens")


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """Rows of (id, n_bytes, n_tokens, over_limit), one for each row of docs.

    ``tokenizer``: path of a ``.json`` (tokenizers) or ``.model`` (sentencepiece)
    file that every executor can read.  No special tokens are added, nothing is
    truncated or padded; special strings in a text count as the library takes
    them by default.  A null text counts as empty: no bytes, no tokens.  Null
    ids, repeated rows and long texts are counted like any other; other columns
    are ignored.  A worker holds an Arrow batch, or one row that is longer.
    """
    tune(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), _lengths(tokenizer, batch.column(1))], names=["id", "n_bytes", "n_tokens"])

    counted = sized.mapInArrow(run, "id long, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
