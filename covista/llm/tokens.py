"""The whole corpus as token ids of a public byte-level BPE, with tiktoken.

The rank file is read once on the driver and broadcast (its size is checked), so
executors need no copy of it. Each Python worker builds one encoder.
"""

from __future__ import annotations

import base64
import os

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_FOLDER = os.environ.get("COVISTA_TOKENIZERS", "/opt/tokenizers")
# Fixed value: the published split pattern of this vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A rank file beyond this is refused: it is broadcast.
MAX_RANK_BYTES = 32 * 2**20
#: Texts beyond this many characters are encoded in pieces.
LONG_TEXT = 50_000

_encoders: dict = {}


def load_encoder(ranks_file: bytes, special_tokens: dict[str, int] | None = None):
    """A tiktoken encoding from the bytes of a local rank file."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
    return tiktoken.Encoding("local", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special_tokens or {})


def safe_pieces(text: str, limit: int = LONG_TEXT) -> list[str]:
    """``text`` cut into pieces of about ``limit`` characters where no token can span the cut.

    A cut lies between a character that isn't white space and a white-space run
    after it: no branch of the split pattern holds both in this order, and what
    follows the cut is matched without a look behind. A stretch without such a place stays whole.
    """
    if len(text) <= limit:
        return [text]
    out, start = [], 0
    cut = regex.compile(r"(?<=\S)(?=\s)")
    while len(text) - start > limit:
        m = cut.search(text, start + limit)
        if not m:
            break
        out.append(text[start : m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def encode_text(encoder, text: str | None, limit: int = LONG_TEXT) -> list[int]:
    """Token ids of one text; strings that look like special tokens are ordinary text, null and '' give []."""
    if not text:
        return []
    if len(text) <= limit:
        return encoder.encode_ordinary(text)
    return [i for piece in safe_pieces(text, limit) for i in encoder.encode_ordinary(piece)]


def decode_ids(encoder, ids) -> bytes:
    """Raw bytes of a list of ids: the exact UTF-8 of the text, also where an id ends within a character."""
    return b"".join(encoder.decode_single_token_bytes(int(i)) for i in ids)


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  tokenizer: str = "byte_bpe_50k", folder: str = DEFAULT_FOLDER) -> DataFrame:
    """(doc_id, ids array<int>), one row for each row of ``docs``.

    Null and empty texts give an empty list; repeated rows stay repeated; a null
    doc_id stays null. Texts are encoded whole. No shuffle: one pass over the scan.
    """
    path = f"{folder}/{tokenizer}.tiktoken"
    if os.path.getsize(path) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is too large to be broadcast")
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        enc = _encoders.get(path)
        if enc is None:
            enc = _encoders[path] = load_encoder(shared.value)
        for b in batches:
            lists, offsets, n = [], [0], 0
            for t in b.column(1).to_pylist():
                ids = encode_text(enc, t)
                lists.append(ids)
                n += len(ids)
                offsets.append(n)
            flat = pa.array([i for ids in lists for i in ids], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)], names=["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>")
