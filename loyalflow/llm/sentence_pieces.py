"""Operator 12, SentencePiece encoding and decoding by vectorised merge rounds.

A text is cut wherever two neighbouring characters stand together in no piece of the vocabulary, since no merge can cross
such a place. The words between the cuts tile the text, so Arrow's dictionary encoding names each distinct one exactly, and
only distinct words are encoded: all of a slice at once, as one flat array of symbols with the number of each symbol's word.
A round takes each word's best pair, merges its leftmost places at the same time in all words, and closes the gaps, until
no pair is left. Several places of a word merge in one round only while no pair that a merge makes ranks as high as the
word's best one; otherwise, the rest waits for the next round, so that merges happen in the order in which the library
makes them. Words that are not done after ROUNDS rounds (runs of thousands of blanks) finish one merge after the other, from a queue.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.llm.words import buffers

#: Bytes of text that are worked on at once, and rounds before the queue takes over.
SLICE, ROUNDS = 1 << 21, 64
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_BLANK, _NONE = "▁", np.iinfo(np.int64).max
_BITS = 21  # of a symbol's number within a pair's key


class Pieces:
    """A byte-fallback BPE model of the sentencepiece library, as arrays; other kinds of models raise ValueError."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules, types = model.normalizer_spec, {t.type for t in model.pieces}
        plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix or not plain or not types <= {1, 2, 3, 6}:
            raise ValueError("only BPE models with byte fallback, blanks kept and no normalisation are supported")
        normal = {t.piece: i for i, t in enumerate(model.pieces) if t.type == 1}
        score = {i: t.score for i, t in enumerate(model.pieces)}
        self.byte = np.zeros(256, np.int64)
        for i, t in enumerate(model.pieces):
            if t.type == 6:
                self.byte[int(t.piece[3:5], 16)] = i
        # characters: 0 is one that no piece holds
        chars = sorted({c for x in normal for c in x} | {_BLANK})
        self.char_of = np.zeros(0x110000, np.int32)
        self.char_of[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.char_of[ord(" ")] = self.char_of[ord(_BLANK)]
        place = {c: k + 1 for k, c in enumerate(chars)}
        self.joins = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for x in normal:
            for a, b in zip(x, x[1:], strict=False):
                self.joins[place[a], place[b]] = True
        # symbols: a piece's own id; characters that are no piece by themselves come after the pieces; 0 stays itself
        n = len(model.pieces)
        symbol = dict(normal)
        for c in chars:
            symbol.setdefault(c, n + place[c])
        self.symbol_of = np.array([-1, *(symbol[c] for c in chars)], np.int64)
        best = {s: k for k, s in enumerate(sorted({score[i] for i in normal.values()}, reverse=True))}
        pairs = {}
        for x, i in normal.items():
            for k in range(1, len(x)):
                a, b = symbol.get(x[:k]), symbol.get(x[k:])
                if a is not None and b is not None:
                    pairs[a << _BITS | b] = (best[score[i]], i)
        self.index = pairs
        # the same as a table of slots; a key whose slot is taken has the next free one
        self.shift = 64 - max(8, (len(pairs) * 4).bit_length())
        size = 1 << (64 - self.shift)
        self.keys, self.rank, self.made = np.full(size, -1, np.int64), np.full(size, _NONE), np.zeros(size, np.int64)
        for key, slot in zip(pairs, self._slot(np.array(list(pairs), np.int64)).tolist(), strict=True):
            while self.keys[slot] >= 0:
                slot = (slot + 1) % size
            self.keys[slot], (self.rank[slot], self.made[slot]) = key, pairs[key]
        self.surface = [bytes([int(t.piece[3:5], 16)]) if t.type == 6 else t.piece.replace(_BLANK, " ").encode() if t.type == 1 else b" \xe2\x81\x87 " if t.type == 2 else b"" for t in model.pieces]
        self.ids_text = _ragged([b"%d," % i for i in range(n)])
        self.surfaces = _ragged(self.surface)

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, what it becomes) of each pair of symbols; the rank is _NONE where they don't merge."""
        key = np.where((a | b) < 0, -2, a << _BITS | b)
        at = self._slot(key)
        there = self.keys[at]
        while len(more := np.flatnonzero((there != key) & (there >= 0))):
            at[more] = (at[more] + 1) % len(self.keys)
            there[more] = self.keys[at[more]]
        return np.where(there == key, self.rank[at], _NONE), self.made[at]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def words(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of words given as code points; starts: where each word begins, and the end."""
        char = self.char_of[points]
        symbol, word = self.symbol_of[char], np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        at = np.arange(len(symbol))  # of each symbol: where it begins
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for _ in range(ROUNDS):
            if not len(symbol):
                break
            rank, made = self._ranks(symbol, word)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(word)))
            over = np.repeat(least == _NONE, size)
            if over.any():
                done.append((symbol[over], word[over], at[over]))
                keep = ~over
                symbol, word, at, rank, made = symbol[keep], word[keep], at[keep], rank[keep], made[keep]
                size, least = size[least != _NONE], least[least != _NONE]
            if not len(symbol):
                break
            here = _leftmost(rank == np.repeat(least, size), word)
            here = self._in_order(symbol, word, rank, made, here)
            symbol[here] = made[here]
            keep = np.ones(len(symbol), bool)
            keep[here + 1] = False
            symbol, word, at = symbol[keep], word[keep], at[keep]
        if len(symbol):
            done.append(self._queued(symbol, word, at))
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
        symbol, word, at = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(at, kind="stable")
        return self._fallen_back(symbol[order], word[order], points[at[order]], len(starts) - 1)

    def _ranks(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, made = np.full(len(symbol), _NONE), np.zeros(len(symbol), np.int64)
        if len(symbol) > 1:
            rank[:-1], made[:-1] = self.pair(symbol[:-1], symbol[1:])
            rank[:-1][word[:-1] != word[1:]] = _NONE
        return rank, made

    def _in_order(self, symbol: np.ndarray, word: np.ndarray, rank: np.ndarray, made: np.ndarray, here: np.ndarray) -> np.ndarray:
        """Of each word's places to merge, those up to the first one that makes a pair of the same rank or a better one."""
        n, new, own = len(symbol), made[here], word[here]
        last = np.append(own[1:] != own[:-1], True)
        if last.all() and (np.append(True, own[1:] != own[:-1])).all():  # one place each: always in order
            return here
        sooner = np.zeros(len(here), bool)
        merged = symbol.copy()
        merged[here] = new
        gone = np.zeros(n, bool)
        gone[here + 1] = True
        left, right = here - 1, here + 2
        inside = (left >= 0) & (word[left] == own)
        for before in (symbol[left], merged[np.where(gone[left], left - 1, left)]):
            sooner |= inside & (self.pair(before, new)[0] <= rank[here])
        inside = (right < n) & (word[np.minimum(right, n - 1)] == own)
        right = np.minimum(right, n - 1)
        for after in (symbol[right], merged[right]):
            sooner |= inside & (self.pair(new, after)[0] <= rank[here])
        # the number of such places before each one within its word
        before = np.cumsum(sooner) - sooner
        begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        return here[before == np.repeat(before[begin], np.diff(np.append(begin, len(own))))]

    def _queued(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rest of long words, one merge after the other: the best rank first, then the leftmost place."""
        n, symbol = len(symbol), symbol.tolist()
        index, own = self.index, word.tolist()
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int, j: int) -> None:
            if 0 <= i and j < n and own[i] == own[j] and symbol[i] >= 0 and symbol[j] >= 0 and (found := index.get(symbol[i] << _BITS | symbol[j])):
                heapq.heappush(heap, (found[0], i, j, symbol[i], symbol[j]))

        for i in range(n - 1):
            push(i, i + 1)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if not (alive[i] and alive[j] and symbol[i] == a and symbol[j] == b and after[i] == j):
                continue
            symbol[i], alive[j], after[i] = index[a << _BITS | b][1], False, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(before[i], i)
            push(i, after[i])
        rest = np.array(alive)
        return np.array(symbol, np.int64)[rest], word[rest], at[rest]

    def _fallen_back(self, symbol: np.ndarray, word: np.ndarray, points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no pieces as the bytes of their character."""
        none = (symbol < 0) | (symbol >= len(self.surface))
        size = np.ones(len(symbol), np.int64)
        cp = points[none].astype(np.int64)
        size[none] = 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000)
        ids = np.repeat(symbol, size)
        if len(cp):
            ids[np.repeat(none, size)] = self.byte[np.frombuffer(cp.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)]
        return ids, np.concatenate([[0], np.cumsum(np.bincount(word, size, n).astype(np.int64))])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of texts as they stand: the blank before a text, which the library adds, must be in them."""
        offsets, data = buffers(texts)
        if offsets[-1] == offsets[0]:
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        data = data[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        at = np.flatnonzero((data & 0xC0) != 0x80)  # the first bytes of characters
        char = self.char_of[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")]
        cut = np.append(True, ~self.joins[char[:-1], char[1:]])
        cut[np.searchsorted(at, offsets[:-1][offsets[:-1] < offsets[-1]])] = True
        start = np.append(at[cut], len(data))
        words = pa.LargeStringArray.from_buffers(len(start) - 1, pa.py_buffer(start.astype(np.int64)), pa.py_buffer(data)).dictionary_encode()
        distinct = words.dictionary
        length = pc.utf8_length(distinct).to_numpy()
        o, own = buffers(distinct)
        points = np.frombuffer(own[o[0] : o[-1]].tobytes().decode().encode("utf-32-le"), "<u4")
        ids, of = self.words(points, np.concatenate([[0], np.cumsum(length, dtype=np.int64)]))
        code = words.indices.to_numpy()
        flat, ends = _gather(ids, of, code)
        return flat, ends[np.searchsorted(start, offsets)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids that ``encode`` made, without the blank before it."""
        out = _gather(*self.surfaces, ids)[0].tobytes()
        return out[1:] if out[:1] == b" " else out


def _ragged(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def _gather(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the rows asked for, in their order, and where each one's begin."""
    size = np.diff(offsets)[rows]
    ends = np.concatenate([[0], np.cumsum(size)])
    return values[np.arange(ends[-1]) + np.repeat(offsets[:-1][rows] - ends[:-1], size)], ends


def _leftmost(same: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Of neighbouring places, every other one, from the left: they would share a symbol. A word's last symbol is none."""
    at = np.flatnonzero(same)
    fresh = np.append(True, (at[1:] != at[:-1] + 1) | (word[at[1:]] != word[at[:-1]]))
    begin = np.flatnonzero(fresh)
    nth = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    return at[nth % 2 == 0]


def _parts(text: str, joins: Pieces) -> Iterator[str]:
    """A long text in parts of about SLICE characters, cut where no piece crosses."""
    a = 0
    while len(text) - a > SLICE:
        b = a + SLICE
        while b < len(text):
            char = joins.char_of[np.frombuffer(text[b - 1 : b + 4096].encode("utf-32-le"), "<u4")]
            found = np.flatnonzero(~joins.joins[char[:-1], char[1:]])
            if len(found):
                b += int(found[0])
                break
            b += 4096
        yield text[a : min(b, len(text))]
        a = min(b, len(text))
    yield text[a:]


def _rows(model: Pieces, texts: pa.Array) -> Iterator[tuple[int, str, str]]:
    """(tokens, hash of ids, hash of the decoded text) of each text of a slice."""
    ids, ends = model.encode(texts)
    digits, cut = _gather(*model.ids_text, ids)
    chars, stop = _gather(*model.surfaces, ids)
    digits, chars = memoryview(digits), memoryview(chars)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        own = digits[cut[a] : max(cut[b] - 1, cut[a])]
        blank = int(stop[b] > stop[a] and chars[stop[a]] == 32)
        yield b - a, hashlib.sha256(own).hexdigest(), hashlib.sha256(chars[stop[a] + blank : stop[b]]).hexdigest()


def _long_row(model: Pieces, text: str) -> tuple[int, str, str]:
    n, ids_sum, text_sum = 0, hashlib.sha256(), hashlib.sha256()
    for k, part in enumerate(_parts(" " + text, model)):
        ids = model.encode(pa.array([part], pa.large_string()))[0]
        digits, chars = _gather(*model.ids_text, ids)[0].tobytes(), _gather(*model.surfaces, ids)[0].tobytes()
        ids_sum.update((b"," if n and len(ids) else b"") + digits[:-1])
        text_sum.update(chars[1:] if not k and chars[:1] == b" " else chars)
        n += len(ids)
    return n, ids_sum.hexdigest(), text_sum.hexdigest()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of ``docs`` (doc_id, text; other columns are ignored).

    Whole texts; null counts as empty, which has no tokens, and repeated rows give repeated results. A text beyond SLICE
    characters is worked on in parts of that size. ``path``: a model file that the executors can read."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces(path)
        for b in batches:
            text = b.column(1).cast(pa.large_string())
            size = pc.binary_length(text).to_numpy()
            a = 0
            while a < b.num_rows:
                e = a + max(1, int(np.searchsorted(np.cumsum(size[a:]), SLICE, "right")))
                part = text.slice(a, e - a)
                if size[a] > SLICE:
                    out = [_long_row(model, part[0].as_py())]
                else:  # the library puts a blank before a text, but not before an empty one
                    full = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), part, pa.scalar("", pa.large_string()))
                    out = list(_rows(model, pc.if_else(pc.equal(part, ""), part, full)))
                n, ids, texts = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, e - a), pa.array(n, pa.int64()), pa.array(ids), pa.array(texts)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                a = e

    return rows.mapInArrow(run, SCHEMA)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path())


QUERIES = {"op12_sentencepiece": op12_sentencepiece}
ORACLE_SQL: dict[str, str] = {}
