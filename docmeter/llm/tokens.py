"""Token counts and ids of whole texts, in Arrow batches balanced by bytes.

A tokenizer file is a parameter: ``.json`` (tokenizers) or ``.model``
(sentencepiece). Byte-level BPE files with the usual word pattern and no
normaliser also run through tiktoken, with ranks read from the same file: the
ids are the same (tests compare them) at a quarter of the CPU time. Texts with
a special string or with characters outside long-settled Unicode blocks go to
the file's own library, whose tables may be of another Unicode version.

Long texts are split where a run of white space begins after another
character, and runs of more than ``RUN_CHARS`` are set apart but for their last
character: no piece of the word pattern crosses such a place, so the pieces'
ids are the whole's. A text without one stays whole. Pieces of all texts of an
Arrow batch go to the library together, in batches balanced by length, and
are counted piece by piece. Long runs go to the file's own library: a pattern
engine that backtracks would hold a state for each character of them. Files
with another pattern, or special strings that take white space along, are never
split.

Defined results: null or empty text has 0 tokens. Batches keep row order; other
columns pass through. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmeter.llm.common import sliced, table, text_of

BATCH_BYTES = 4 << 20
SPLIT_CHARS = 1 << 18
RUN_CHARS = 1 << 16
#: Characters that one call to a library gets, or one piece if that is longer.
CALL_CHARS = 1 << 20
_SETTLED = re.compile("[^\u0000-\u052f\u1e00-\u1fff\u2000-\u206f\u20a0-\u20bf\u2190-\u23ff\u2500-\u27bf\u3000-\u30ff\u4e00-\u9fcc\uac00-\ud7a3]")
#: Unicode's White_Space, which the pattern's \s means (Python's has four control characters more).
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BREAK = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])")
#: The pre-tokeniser's pattern that byte-level BPE files with use_regex mean. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level BPE files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def split_safely(text: str, most: int = SPLIT_CHARS) -> list[str]:
    """Pieces of about ``most`` characters, cut only before white space that follows another character."""
    parts, at = [], 0
    while len(text) - at > most:
        cut = _BREAK.search(text, at + most)
        if cut is None:
            break
        parts.append(text[at : cut.start()])
        at = cut.start()
    parts.append(text[at:])
    return parts


def split_runs(text: str, longest: int = RUN_CHARS) -> Iterator[tuple[str, bool]]:
    """Pieces, and whether each is a white-space run of ``longest`` characters or more.

    A run before another character keeps its last character back: the pattern joins that to what follows.
    """
    at = 0
    for run in re.finditer(f"[{_WHITE}]{{{longest},}}", text) if len(text) >= longest else ():
        start, end = run.start(), run.end() - (run.end() < len(text))
        if start > at:
            yield text[at:start], False
        yield text[start:end], True
        at = end
    if at < len(text) or not text:
        yield text[at:], False


class Encoder:
    """ids(texts) and counts(texts) of one tokenizer file."""

    def __init__(self, path: str):
        self.fast = self.slow = self.pieces = None
        self.specials: list[str] = []
        self.splits = False
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or []
        self.specials = [x["content"] for x in added]
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        usual = (
            spec.get("normalizer") is None
            and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) == ("ByteLevel", False, True)
            and model["type"] == "BPE"
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        )
        if not usual:
            return
        self.splits = not any(re.search(f"[{_WHITE}]", x["content"]) or any(x.get(k) for k in ("lstrip", "rstrip", "single_word")) for x in added)
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        vocab = {k: v for k, v in model["vocab"].items() if k not in set(self.specials)}
        ids = [vocab[m] for m in merged]
        alphabet = _byte_alphabet()
        if ids == sorted(ids) and len(vocab) == 256 + len(ids):  # ranks in the order of the merges
            import tiktoken

            ranks = {bytes(alphabet[c] for c in k): v for k, v in vocab.items()}
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _parts(self, texts: list[str]) -> Iterator[tuple[int, str, bool]]:
        """Text's number, piece, and whether it is one for the file's own library."""
        for i, text in enumerate(texts):
            for piece, run in split_runs(text) if self.splits else [(text, False)]:
                for part in split_safely(piece) if self.splits and not run else [piece]:
                    plain = self.fast is not None and not run and not any(s in part for s in self.specials)
                    if plain and not self.splits and re.search(f"[{_WHITE}]{{{RUN_CHARS}}}", part):
                        plain = False
                    yield i, part, not (plain and (part.isascii() or _SETTLED.search(part) is None))

    def _called(self, parts: list[tuple[int, str, bool]]) -> Iterator[tuple[int, list[int]]]:
        own = [p for p in parts if p[2]]
        other = [p for p in parts if not p[2]]
        found: dict[bool, Iterator[list[int]]] = {
            True: iter(e.ids for e in self.slow.encode_batch_fast([p[1] for p in own], add_special_tokens=False)),
            False: iter(self.fast.encode_ordinary_batch([p[1] for p in other], num_threads=1) if other else ()),
        }
        for i, _, slow in parts:
            yield i, next(found[slow])

    def pieces_of(self, texts: list[str]) -> Iterator[tuple[int, list[int]]]:
        """(text's number, ids of its next piece), in order, ``CALL_CHARS`` at a time."""
        if self.pieces is not None:
            yield from enumerate(self.pieces.encode(texts, num_threads=1))
            return
        held: list[tuple[int, str, bool]] = []
        size = 0
        for part in self._parts(texts):
            if held and size + len(part[1]) > CALL_CHARS:
                yield from self._called(held)
                held, size = [], 0
            held.append(part)
            size += len(part[1])
        if held:
            yield from self._called(held)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for i, ids in self.pieces_of(texts):
            out[i].append(np.array(ids, "<u4"))
        return [x[0] if len(x) == 1 else np.concatenate([*x, np.zeros(0, "<u4")]) for x in out]

    def counts(self, texts: list[str]) -> list[int]:
        """Lengths only: no piece's ids outlive its batch."""
        out = [0] * len(texts)
        for i, ids in self.pieces_of(texts):
            out[i] += len(ids)
        return out


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def count_tokens(df: DataFrame, path: str, text: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The rows without the text, with n_bytes (UTF-8) and n_tokens. Only lengths leave Python."""
    kept = [c for c in df.columns if c not in (text, "n_bytes", "n_tokens")]
    rows = df.select(*kept, F.octet_length(text_of(text)).cast("long").alias("n_bytes"), text_of(text).alias("n_tokens"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, len(kept) + 1, batch_bytes):
            n = encoder(path).counts(batch.column(len(kept) + 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], names=[*batch.schema.names[:-1], "n_tokens"])

    return rows.mapInArrow(run, schema)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_count_tokens(spark: SparkSession, sf_dir: str, limit: int = 1024) -> DataFrame:
    """Contract digest: token counts of every whole text of ``documents``."""
    counted = count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
