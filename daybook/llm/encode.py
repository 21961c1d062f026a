"""Encoding of a whole corpus with a public byte-level BPE tokenizer (problem 8).

Forced-boundary splitting: two bytes that stand next to each other in no token
of the vocabulary can never end up in one token, so the text may be cut between
them.  The fragments are encoded independently and their ids concatenated.

The cut must not disturb the pattern that splits text before merging.  It may
fall before anything and inside a run of blanks, but not right after a blank
that something else follows (the pattern looks ahead there) and not next to an
apostrophe (contractions).  Between such bytes the text stays whole.

Fragments repeat heavily, so a task remembers their ids up to a fixed number.
The vocabulary file has a fixed size and is read by each worker.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k"
#: Where the vocabulary files lie unless a path is given.
TOKENIZER_DIR = "/opt/tokenizers"
#: Fragments whose ids a task remembers; longer ones than FRAGMENT_BOUND bytes are not kept.
CACHE_BOUND = 200_000
FRAGMENT_BOUND = 64

# Fixed value: the pattern that splits text before the merges of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path(name: str = TOKENIZER, folder: str | None = None) -> str:
    """Path of the rank file of ``name``; ``folder`` defaults to the public tokenizers of the machine."""
    folder = folder or TOKENIZER_DIR
    if not os.path.isdir(folder) and (spec := importlib.util.find_spec("public_tokenizers")):
        folder = os.path.dirname(spec.origin)
    return os.path.join(folder, f"{name}.tiktoken")


@cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@cache
def forced_pairs(path: str) -> np.ndarray:
    """Boolean 256 x 256 table: True where no token holds the two bytes side by side."""
    forced = np.ones((256, 256), dtype=bool)
    for token in load_ranks(path):
        if len(token) > 1:
            b = np.frombuffer(token, dtype=np.uint8)
            forced[b[:-1], b[1:]] = False
    return forced


def _blank_ends(b: np.ndarray) -> np.ndarray:
    """True at the last byte of every character that may count as a blank."""
    ends = (b == 32) | ((b >= 9) & (b <= 13)) | ((b >= 28) & (b <= 31))
    if len(b) > 1 and (b >= 128).any():
        two, one = np.zeros(len(b), np.uint8), np.zeros(len(b), np.uint8)
        one[1:], two[2:] = b[:-1], b[:-2]
        ends |= (one == 0xC2) & ((b == 0x85) | (b == 0xA0))
        ends |= (two == 0xE2) & (one == 0x80) & (((b >= 0x80) & (b <= 0x8A)) | (b == 0xA8) | (b == 0xA9) | (b == 0xAF))
        ends |= (two == 0xE2) & (one == 0x81) & (b == 0x9F)
        ends |= ((two == 0xE1) & (one == 0x9A) & (b == 0x80)) | ((two == 0xE3) & (one == 0x80) & (b == 0x80))
    return ends


def _blank_starts(b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True at the first byte of every character that counts as a blank for certain (separators 28 to 31 don't)."""
    starts = ends & (b <= 32) & ((b < 28) | (b == 32))
    last = np.flatnonzero(ends & (b >= 128))
    if len(last):
        wide = b[last - 1] >= 0xC0
        starts[np.where(wide, last - 1, last - 2)] = True
    return starts


def forced_boundaries(data: bytes, forced: np.ndarray) -> list[int]:
    """Offsets at which ``data`` may be cut without changing its encoding."""
    b = np.frombuffer(data, dtype=np.uint8)
    if len(b) < 2:
        return []
    left, right = b[:-1], b[1:]
    cut = forced[left, right] & ((right & 0xC0) != 0x80) & (left != 39) & (right != 39)
    ends = _blank_ends(b)
    cut &= ~ends[:-1] | _blank_starts(b, ends)[1:]
    return (np.flatnonzero(cut) + 1).tolist()


def make_encoder(path: str, bound: int = CACHE_BOUND) -> Callable[[str | None], list[int]]:
    """Function from a text to its ids; null and empty text have none."""
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    forced = forced_pairs(path)
    kept: dict[bytes, list[int]] = {}

    def encode(text: str | None) -> list[int]:
        if not text:
            return []
        data = text.encode("utf-8", "replace")
        ids: list[int] = []
        at = 0
        for to in [*forced_boundaries(data, forced), len(data)]:
            fragment = data[at:to]
            at = to
            got = kept.get(fragment)
            if got is None:
                got = encoding.encode_ordinary(fragment.decode("utf-8"))
                if len(fragment) <= FRAGMENT_BOUND:
                    if len(kept) >= bound:
                        kept.clear()
                    kept[fragment] = got
            ids += got
        return ids

    return encode


_encoders: dict[str, Callable[[str | None], list[int]]] = {}


def worker_encoder(path: str) -> Callable[[str | None], list[int]]:
    """The encoder of this Python worker, made once."""
    if path not in _encoders:
        _encoders[path] = make_encoder(path)
    return _encoders[path]


def encode_documents(documents: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", lengths_only: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and ids (or n_tokens) of every document, with the columns ``keep`` after doc_id.

    Null and empty texts get an empty list (0 tokens).  Text that looks like a
    special token is ordinary text.  Bytes that are no UTF-8 count as the
    replacement character.  Whole texts of any length are encoded; repeated
    documents are each encoded.  No shuffle is needed.
    """
    path = path or vocabulary_path()
    picked = documents.select(F.make_valid_utf8(F.col(text).cast("string")).alias("text"), F.col(doc_id).cast("bigint").alias("doc_id"), *keep)
    kind = "n_tokens bigint" if lengths_only else "ids array<int>"
    fields = {f.name: f for f in picked.schema.fields}
    schema = ", ".join(["doc_id bigint", *[f"`{k}` {fields[k].dataType.simpleString()}" for k in keep], kind])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(path)
        for batch in batches:
            texts = batch.column(0)
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            if lengths_only:
                out = pa.array([len(encode(t.as_py())) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*rest, out], names=["doc_id", *keep, "n_tokens"])
                continue
            # Long lists: slices keep the memory of a batch bounded by its tokens, not by its rows.
            offsets, flat, start, done = [0], [], 0, 0
            for t in texts:
                flat.append(np.asarray(encode(t.as_py()), dtype=np.int32))
                offsets.append(offsets[-1] + len(flat[-1]))
                done += 1
                if offsets[-1] > 2_000_000:
                    yield _lists(rest, start, done, offsets, flat, keep)
                    start, offsets, flat = done, [0], []
            if flat:
                yield _lists(rest, start, done, offsets, flat, keep)

    return picked.mapInArrow(run, schema)


def _lists(rest: list, start: int, stop: int, offsets: list[int], flat: list, keep: tuple[str, ...]) -> pa.RecordBatch:
    values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32), pa.int32())
    ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    return pa.RecordBatch.from_arrays([*[c.slice(start, stop - start) for c in rest], ids], names=["doc_id", *keep, "ids"])
