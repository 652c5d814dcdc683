"""Operator 1, license scan: fuzzy search for short notices.

A notice with ``k`` allowed edits is cut into ``k + 1`` seeds: wherever the notice stands with at most ``k`` edits, one
seed stands unchanged (pigeonhole). One automaton finds all seeds of all notices in a text's normalised words. A seed
that is found fixes a window; there the notice is compared exactly first, and else searched by the regex library with
its bounded-error matching, which also tells the edits and the span.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Notice:
    phrase: str
    label: str
    edits: int
    base: bool = False


#: Phrases and labels asked for, then the method's own.
NOTICES = (
    Notice("gnu general public license", "gpl", 3, True),
    Notice("apache license", "apache", 2, True),
    Notice("cc by", "cc-by", 0, True),
    Notice("mit license", "mit", 1, True),
    Notice("gnu lesser general public license", "lgpl", 3),
    Notice("gnu affero general public license", "agpl", 3),
    Notice("mozilla public license", "mpl", 2),
    Notice("eclipse public license", "epl", 2),
    Notice("bsd license", "bsd", 1),
    Notice("creative commons attribution", "cc-by", 3),
    Notice("boost software license", "boost", 2),
)
_NOT_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPAN = "struct<label: string, edits: int, first_word: bigint, n_words: bigint, start: bigint, stop: bigint, base: boolean>"
SCHEMA = f"doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<{SPAN}>"


class Scanner:
    def __init__(self, notices: tuple[Notice, ...] = NOTICES):
        self.notices = notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        self.patterns = []
        for i, n in enumerate(notices):
            cuts = [len(n.phrase) * j // (n.edits + 1) for j in range(n.edits + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(n.phrase[a:b], []).append((i, a))
            self.patterns.append(regex.compile(f"(?b)(?<= )(?:{regex.escape(n.phrase)}){{e<={n.edits}}}(?= )"))
        self.seeds = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()

    def matches(self, words: list[str]) -> list[tuple[int, int, int, int]]:
        """(notice, first word, number of words, edits) of each place, by notice and place; of overlapping places of a
        notice the exact ones stay, and else the leftmost."""
        text = " " + " ".join(words) + " "
        exact: dict[int, set[int]] = {}
        near: dict[int, list[int]] = {}
        for end, (size, places) in self.seeds.iter(text):
            for i, offset in places:
                at, phrase = end - size + 1 - offset, self.notices[i].phrase
                if at >= 1 and text.startswith(phrase, at) and text[at - 1] == " " and text.startswith(" ", at + len(phrase)):
                    exact.setdefault(i, set()).add(at)
                elif self.notices[i].edits:
                    near.setdefault(i, []).append(at)
        found = []
        for i in exact.keys() | near.keys():
            n, size = self.notices[i], len(self.notices[i].phrase)
            places = sorted((at, at + size, 0) for at in exact.get(i, ()))
            starts, done = [p[0] for p in places], 0
            fuzzy = []
            for at in sorted(set(near.get(i, ()))):
                k = bisect_right(starts, at)
                before = places[k - 1][1] if k else 0  # the window ends where the exact places beside it begin
                after = places[k][0] if k < len(starts) else len(text)
                a, b = max(0, at - n.edits - 1, done - 1, before), min(len(text), at + size + n.edits + 1, after)
                if b - a >= size - n.edits and (m := self.patterns[i].search(text, a, b)):
                    fuzzy.append((m.start(), m.end(), sum(m.fuzzy_counts)))
                    done = m.end()
            found += [(i, *p) for p in places + fuzzy]
        out, at, count = [], 0, -1
        for i, a, b, edits in sorted(found, key=lambda x: x[1]):  # words before a place = blanks before it
            count += text.count(" ", at, a)
            at = a
            out.append((i, count, text.count(" ", a, b) + 1, edits))
        return out

    def scan(self, text: str | None) -> tuple:
        """The row of one text, without its identifier."""
        words = (text or "").encode().translate(_NOT_WORDS).decode().split(" ")
        words = [w for w in words if w]
        found = self.matches(words)
        base = [first for i, first, _, edits in found if self.notices[i].base and not edits]
        label = lambda keep: ",".join(sorted({self.notices[i].label for i, *x in found if keep(i, x[2])}))
        score = max((1 - edits / len(self.notices[i].phrase) for i, _, _, edits in found), default=0.0)
        places = [m.span() for m in _WORD.finditer(text)] if found else []
        spans = [{"label": self.notices[i].label, "edits": e, "first_word": f, "n_words": k, "start": places[f][0], "stop": places[f + k - 1][1], "base": self.notices[i].base and not e} for i, f, k, e in found]
        return len(words), len(base), min(base, default=None), max(base, default=None), label(lambda i, e: self.notices[i].base and not e), label(lambda i, e: True), score, spans


def license_scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored), whole texts, null as empty.

    n_base, first_word, last_word and base_labels tell of places where a base phrase stands word for word; labels adds
    fuzzy places and other notices; score is the best place's share of unchanged characters, 0 without any; spans has
    each place with its edits, words and characters [start, stop) of the text. Repeated rows give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for b in batches:
            rows = [scanner.scan(x.as_py()) for x in b.column(1)]
            cols = [[r[k] for r in rows] for k in range(8)]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), spans]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names)

    spans = pa.list_(pa.struct([("label", pa.string()), ("edits", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_license_scan": op1_license_scan}
ORACLE_SQL: dict[str, str] = {}
