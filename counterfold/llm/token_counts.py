"""Tokens of whole texts, counted without making them where that is possible.

Whole-token shortcut: before any text is read, every string of the vocabulary is encoded
alone.  Those that give exactly their own id, and that the pre-tokenizer leaves in one
piece, are proven to be one token wherever they stand as a pre-token.  Such pre-tokens
are counted directly; only the others are merged by the library, each spelling once.
"""

from __future__ import annotations

import functools
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from counterfold.llm import bpe
from counterfold.llm.common import byte_texts, parts, ship

#: The pattern of byte-level pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def is_byte_level(path: str) -> bool:
    """Whether the file cuts texts by the pattern above and changes nothing before."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
    )


def prove_whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that are one token when they stand alone; at most the vocabulary."""
    tok, cut = bpe.library(path), regex.compile(PRE_TOKEN)
    special = set(bpe.special_strings(path))
    strings = {i: tok.decode([i], skip_special_tokens=False) for i in range(tok.get_vocab_size())}
    strings = {i: s for i, s in strings.items() if s and "�" not in s and s not in special}
    found = tok.encode_batch_fast(list(strings.values()), add_special_tokens=False)
    return frozenset(
        s for (i, s), e in zip(strings.items(), found) if e.ids == [i] and cut.findall(s) == [s]
    )


@functools.lru_cache(maxsize=2)
def _counter(path: str, whole_tokens) -> bpe.Memory:
    """``whole_tokens``: a broadcast of the proven strings."""
    tok, cut, whole = bpe.library(path), regex.compile(PRE_TOKEN), whole_tokens.value
    merged: dict[str, int] = {}

    def learn(chunks: list[str]) -> list[int]:
        pieces = [cut.findall(c) for c in chunks]
        rest = list({p for c in pieces for p in c if p not in whole and p not in merged})
        if len(merged) + len(rest) > bpe.MEMORY:
            merged.clear()
            rest = list({p for c in pieces for p in c if p not in whole})
        found = tok.encode_batch_fast(rest, add_special_tokens=False)
        merged.update((p, len(e.ids)) for p, e in zip(rest, found))
        return [sum(1 if p in whole else merged[p] for p in c) for c in pieces]

    def uncut(text: str) -> int:
        return len(tok.encode(text, add_special_tokens=False).ids)

    return bpe.Memory(path, learn, lambda first, rest: first + sum(rest), uncut)


@functools.lru_cache(maxsize=2)
def _plain(path: str):
    """Counts by the library alone, for files whose pre-tokens are not byte-level."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    tok = bpe.library(path)
    return lambda texts: [
        len(e.ids) for e in tok.encode_batch_fast(texts, add_special_tokens=False)
    ]


def count_tokens(
    docs: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text",
    limit: int = 512,
) -> DataFrame:
    """Per row: the id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    ``path``: a ``.json`` file of the tokenizers library or a ``.model`` of sentencepiece,
    readable on every executor.  No special tokens are added, nothing is cut off or padded;
    special strings inside a text are handled as the library does by default.  A null text
    is empty; an empty one has 0 bytes and tokens.  Repeated rows and null ids are kept row by
    row, other columns are ignored, an empty table gives an empty result.  No shuffle.
    """
    sc = ship(docs.sparkSession).sparkContext
    whole = sc.broadcast(prove_whole_tokens(path)) if is_byte_level(path) else None
    kind = docs.schema[id_column].dataType

    def rows(batches):
        for batch in parts(batches, "text"):
            raw = byte_texts(batch, "text")
            texts = [b.decode("utf-8", "replace") for b in raw]
            counts = _counter(path, whole).values(texts) if whole else _plain(path)(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(b) for b in raw], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                [id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.selectExpr(f"`{id_column}` AS id", f"CAST(`{text_column}` AS STRING) AS text"
                           ).mapInArrow(
        rows, f"`{id_column}` {kind.simpleString()}, n_bytes long, n_tokens long, "
        "over_limit boolean")
