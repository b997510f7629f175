"""Token counts of a piece vocabulary with the whole-token shortcut.

The driver proves once, offline, what the counting relies on:

* no piece holds a space mark behind another character, so a run of space marks
  and the word behind it (a pre-token) never merges with what follows;
* which of the control characters tab, newline, return occur in no longer piece,
  so that they stand alone and cut pre-tokens;
* which vocabulary strings encode alone as one token (by running the merges on
  each of them).

Documents are then cut into pre-tokens.  Those in the proven set count one;
only the rest is merged, each distinct one once per worker while it stays in a
bounded memory.  The work is one map over the documents without any shuffle; a
very long pre-token is merged with a heap and not remembered.

Defined results: a null or empty text has 0 bytes and 0 tokens; strings that
look like special tokens are ordinary text; repeated rows are counted row by
row; an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, load
from .merges import merged

LIMIT = 4096
#: Distinct pre-tokens that a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 600_000, 200
MARK = "▁"
ALONE = "\t\n\r"


@dataclass(frozen=True)
class PieceModel:
    """What the counting needs of a vocabulary, with the proofs."""
    ranks: dict          # piece -> rank, least first
    whole: frozenset     # pieces that encode alone as one token
    alone: str           # control characters that never merge
    dummy_prefix: bool


def read_pieces(path: str) -> PieceModel:
    """Read a piece model (bounded by its vocabulary) and prove the shortcut.
    Raises if the vocabulary does not allow it."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(sp.get_piece_size())
              if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    order = sorted(normal, key=lambda i: -sp.get_score(i))
    ranks = {sp.id_to_piece(i): r for r, i in enumerate(order)}
    if any(MARK in p.lstrip(MARK) for p in ranks):
        raise ValueError("a piece holds a space behind another character: pre-tokens could merge")
    alone = "".join(c for c in ALONE if not any(c in p for p in ranks if len(p) > 1))
    whole = frozenset(p for p in ranks if len(merged(list(p), ranks)) == 1)
    return PieceModel(ranks, whole, alone, sp.encode("a", out_type=str)[0] == MARK + "a")


def pieces(model: PieceModel, pre_token: str) -> list[str]:
    """The pieces of one pre-token; characters without a piece become their
    bytes (the vocabulary's byte fallback)."""
    out = []
    for p in merged(list(pre_token), model.ranks):
        out += [p] if p in model.ranks else [f"<0x{b:02X}>" for b in p.encode()]
    return out


class Counts(dict):
    """pre-token -> number of tokens."""

    def __init__(self, model: PieceModel):
        self.model = model
        super().__init__(dict.fromkeys(model.whole, 1))
        cut = re.escape(model.alone)
        self.cut = re.compile(f"{MARK}*[^{MARK}{cut}]+|{MARK}+" + (f"|[{cut}]" if cut else ""))

    def __missing__(self, word: str) -> int:
        n = len(pieces(self.model, word))
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED + len(self.model.whole):
                self.clear()
                self.update(dict.fromkeys(self.model.whole, 1))
            self[word] = n
        return n

    def of(self, text: str) -> int:
        if not text:
            return 0
        marked = (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)
        return sum(map(self.__getitem__, self.cut.findall(marked)))


def token_counts(model: PieceModel):
    """A column function: text -> struct(n_bytes, n_tokens).  The model, bounded
    by the vocabulary, travels with the function."""

    @F.arrow_udf("struct<n_bytes: bigint, n_tokens: bigint>")
    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = Counts(model)
        for texts in parts:
            raw = bytes_of(texts)
            yield pa.StructArray.from_arrays(
                [pa.array([len(b) for b in raw], pa.int64()), pa.array([counts.of(b.decode()) for b in raw], pa.int64())],
                names=["n_bytes", "n_tokens"])

    return count


def count_tokens(documents: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per document."""
    count = token_counts(read_pieces(path))
    return documents.select("doc_id", count(F.col(text)).alias("_c")) \
                    .select("doc_id", "_c.n_bytes", "_c.n_tokens", (F.col("_c.n_tokens") > limit).alias("over_limit"))


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
