"""Operator 9, BPE encoding and decoding by tree concatenation.

Most texts are encoded where they are read. A long one is cut into pieces that other tasks encode in parallel; then its
pieces are put together pairwise, as a tree. Where a word starts after something else than white space, the vocabulary's
pattern always cuts, so these joins need nothing. Text that the pattern doesn't cut for long is halved again and again;
there, each join re-encodes a window around it, which grows until its first token is one the left side has in that place
and its last one is one the right side has. All neighbouring tokens then stand together in some encoding of theirs,
which for byte pairs merged by rank makes the whole the encoding of the whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.llm.shared import tasks

#: Characters beyond which a text is encoded in pieces, and about as many in a piece.
LONG, PIECE = 65_536, 16_384
#: Characters that both libraries' patterns sort into letters, digits and white space alike, checked by a test.
_LATIN = re.compile(r"[\n\r\t -~ -ɏ‐-‧€]*")
_SAFE = re.compile(r"(?<=[!-~¡-ɏ])(?=[ \n])")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Codec:
    """The tokenizer of a file of the tokenizers library; Latin text goes through tiktoken with the same vocabulary, faster."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        own = json.loads(self.whole.to_str())
        special = {t["content"]: t["id"] for t in own["added_tokens"]}
        own["added_tokens"], own["pre_tokenizer"] = [], None
        self.raw = Tokenizer.from_str(json.dumps(own))  # merges only: it cuts nothing
        self.raw.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed value: that of ByteLevel
        byte = _bytes_by_sign()
        ranks = {bytes(byte[c] for c in token): i for token, i in own["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def encode(self, text: str) -> list[int]:
        if _LATIN.fullmatch(text):
            return self.fast.encode(text, allowed_special="all")
        return self.whole.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> bytes:
        return self.fast.decode_bytes(ids)

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(part of something unsplit, text) of each piece: others can be encoded by themselves."""
        at = 0
        while at < len(text):
            cut = _SAFE.search(text, min(len(text), at + PIECE), min(len(text), at + 2 * PIECE))
            if cut or len(text) - at <= PIECE:
                end = cut.start() if cut else len(text)
                yield False, text[at:end]
                at = end
                continue
            cut = _SAFE.search(text, at + 2 * PIECE)
            end = cut.start() if cut else len(text)
            yield from self._unsplit(text[at:end])
            at = end

    def _unsplit(self, text: str) -> Iterator[tuple[bool, str]]:
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                yield False, part
                continue
            start = last = end = 0  # of the words gathered so far: where they and the last of them begin

            def gathered() -> Iterator[tuple[bool, str]]:
                # alone, white space at an end would be one word, with the white space before it
                for a, b in ((start, last), (last, end)) if part[last:end].isspace() else ((start, end),):
                    if a < b:
                        yield False, part[a:b]

            for _, (a, b) in self.whole.pre_tokenizer.pre_tokenize_str(part) if part else ():
                if b - a > PIECE:
                    yield from gathered()
                    for i, x in enumerate(halves(part[a:b])):
                        yield i > 0, x  # a first piece joins nothing on its left
                    start = b
                elif b - start > PIECE:
                    yield from gathered()
                    start = a
                last, end = min(b, max(a, start)), b
            yield from gathered()

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring parts of one unsplit text, from theirs."""
        n = 4
        while left and right:
            a, b = left[-n:], right[:n]
            data = self.fast.decode_bytes(a + b)
            try:
                window = self.raw.encode(data.decode(), add_special_tokens=False).ids
            except UnicodeDecodeError:  # an end of the window is within a character
                window = []
            whole_left, whole_right = len(a) == len(left), len(b) == len(right)
            if window and (whole_left or window[0] == a[0]) and (whole_right or window[-1] == b[-1]):
                return left[: len(left) - len(a)] + window + right[len(b) :]
            n *= 2
        return left + right

    def tree(self, parts: list[tuple[bool, list[int]]]) -> list[int]:
        """Join neighbours pairwise until one is left. parts: (joins its left neighbour within unsplit text, tokens)."""
        runs: list[list[list[int]]] = []
        for inner, ids in parts:
            if inner and runs:
                runs[-1].append(ids)
            else:
                runs.append([ids])
        out: list[int] = []
        for run in runs:
            while len(run) > 1:
                run = [self.join(run[i], run[i + 1]) if i + 1 < len(run) else run[i] for i in range(0, len(run), 2)]
            out += run[0]
        return out


def _bytes_by_sign() -> dict[str, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves, and the others, in order, as U+0100 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def halves(text: str) -> list[str]:
    """The text, halved until no part is longer than PIECE."""
    if len(text) <= PIECE:
        return [text]
    return halves(text[: len(text) // 2]) + halves(text[len(text) // 2 :])


def _row(codec: Codec, ids: list[int]) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()


def _out(doc_ids: list, rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, path: str, long: int = LONG) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of ``docs`` (doc_id, text; other columns are ignored).

    Whole texts, null as empty, which has no tokens; repeated rows give repeated results. ``path``: a byte-level BPE file
    of the tokenizers library that the executors can read."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for b in batches:
            for a in range(0, b.num_rows, 500):
                c = b.slice(a, 500)
                yield _out(c.column(0).to_pylist(), [_row(codec, codec.encode(t.as_py())) for t in c.column(1)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = text.as_py()
                sha, made = hashlib.sha256(data.encode()).digest(), list(codec.pieces(data))
                columns = [[doc_id] * len(made), [sha] * len(made), list(range(len(made))), [x for x, _ in made], [x for _, x in made]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.string()], strict=True)], ["doc_id", "sha", "piece", "inner", "text"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for b in batches:
            # pieces of unsplit text, the first one too, are cut anywhere: encode() of a first one is that of its merges
            ids = [np.array(codec.raw.encode(t, add_special_tokens=False).ids if inner else codec.encode(t), "<u4").tobytes() for inner, t in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(ids, pa.binary())], ["doc_id", "sha", "piece", "inner", "ids"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From pieces sorted by text and place; a repeated row has each of its pieces as often."""
        codec = Codec(path)
        key, parts, copies = None, [], 0

        def done() -> pa.RecordBatch:
            return _out([key[0]] * copies, [_row(codec, codec.tree(parts))] * copies)

        for b in batches:
            for doc_id, sha, piece, inner, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (doc_id, sha) != key:
                    if key:
                        yield done()
                    key, parts, copies = (doc_id, sha), [], 0
                copies += piece == 0
                if piece == len(parts):
                    parts.append((inner, np.frombuffer(ids, "<u4").tolist()))
        if key:
            yield done()

    size = F.length("text")
    short = rows.where(size <= long).mapInArrow(here, SCHEMA)
    pieces = rows.where(size > long).mapInArrow(cut, "doc_id long, sha binary, piece long, inner boolean, text string")
    n = tasks(docs.sparkSession)
    pieces = pieces.repartition(n, "doc_id", "sha", "piece").mapInArrow(leaves, "doc_id long, sha binary, piece long, inner boolean, ids binary")
    return short.unionByName(pieces.repartition(n, "doc_id", "sha").sortWithinPartitions("doc_id", "sha", "piece").mapInArrow(together, SCHEMA))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary())


QUERIES = {"op9_bpe": op9_bpe}
ORACLE_SQL: dict[str, str] = {}
