"""Exact token counts of every prefix by dynamic programming over a piece vocabulary.

The last token of the encoding of a prefix is the one candidate ending there that holds next to the last token
of what comes before it, so the encoding of all prefixes is found left to right, one table row for each
character: its last token, and the count up to there. A truncation or a budget is then a look-up.

Where no piece has the space mark after another character, a space mark after another character always starts
a token; the text falls into units there, whose tables are kept and added up.

Null and empty texts have 0 tokens. Whole texts are counted: no truncation, no special tokens.
"""

from __future__ import annotations

import re
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame

from .common import MEMO, Memo, map_rows, prepare, read, texts

MARK = "▁"
#: Piece types of the model format.
NORMAL, CONTROL, BYTE = 1, 3, 6


class PrefixCounter:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap and norm.name != "identity" or norm.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a BPE model without normalisation is needed")
        if not proto.trainer_spec.byte_fallback:
            raise ValueError("a model with byte pieces is needed")
        if any(p.type not in (NORMAL, 2, CONTROL, BYTE) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.dummy = norm.add_dummy_prefix
        #: piece -> order of merging; larger scores merge first, so ranks are comparable across pieces
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type == NORMAL}
        #: the last two characters of pieces -> their lengths, longest first
        self.ends: dict[str, tuple[int, ...]] = {}
        for p in sorted(self.rank, key=len, reverse=True):
            if len(p) > 1 and len(p) not in (known := self.ends.get(p[-2:], ())):
                self.ends[p[-2:]] = (*known, len(p))
        inner = any(MARK in p.lstrip(MARK) for p in self.rank)
        #: a unit is marks and what follows up to the next mark; with marks inside pieces the text is one unit
        self.units = (lambda s: [s]) if inner else re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
        self._holds: dict[tuple[str, str], bool] = {}
        self._states = Memo(self._state, MEMO)
        self._totals = Memo(self._total, MEMO)

    def normal(self, text: str) -> str:
        return (MARK if self.dummy and text else "") + text.replace(" ", MARK)

    def merge(self, s: str) -> list[str]:
        """Best score first, leftmost of equals: the definition, for pairs of tokens."""
        parts, get, none = list(s), self.rank.get, float("inf")
        pair = [get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while pair and (low := min(pair)) != none:
            i = pair.index(low)
            parts[i] += parts.pop(i + 1)
            pair.pop(i)
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], none)
        return parts

    def holds(self, a: str, b: str) -> bool:
        if (known := self._holds.get((a, b))) is None:
            if len(self._holds) > MEMO:
                self._holds.clear()
            known = self._holds[a, b] = self.merge(a + b) == [a, b]
        return known

    def alone(self, c: str) -> int:
        """Tokens of a character by itself: a piece, or its bytes."""
        return 1 if c in self.rank else len(c.encode())

    def table(self, unit: str) -> list[int]:
        """Tokens of unit[:i] for each i from 1: the whole table of the dynamic program."""
        last: list[str] = []
        count: list[int] = []
        for i in range(1, len(unit) + 1):
            for n in self.ends.get(unit[max(0, i - 2) : i], ()):
                if n <= i and (t := unit[i - n : i]) in self.rank and (self.merge(t) == [t] if n == i else self.holds(last[i - n - 1], t)):
                    last.append(t)
                    count.append(count[i - n - 1] + 1 if n < i else 1)
                    break
            else:
                last.append(c := unit[i - 1])
                count.append((count[-1] if count else 0) + self.alone(c))
        return count

    def _state(self, prefix: str) -> tuple[str, int]:
        """Last token and count of a prefix, from the states of the shorter prefixes that it needs."""
        i = len(prefix)
        for n in self.ends.get(prefix[-2:], ()):
            if n <= i and (t := prefix[i - n :]) in self.rank:
                if n == i:
                    if self.merge(t) == [t]:
                        return t, 1
                else:
                    before = self._states[prefix[: i - n]]
                    if self.holds(before[0], t):
                        return t, before[1] + 1
        c = prefix[-1]
        return c, (self._states[prefix[:-1]][1] if i > 1 else 0) + self.alone(c)

    def _total(self, unit: str) -> int:
        return (self._state(unit) if len(unit) <= 64 else (None, self.table(unit)[-1]))[1]

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of text[:i] for each i from 0 to its length."""
        s, out, base = self.normal(text), [], 0
        for u in self.units(s):
            row = self.table(u)
            out.append(np.array(row, np.int64) + base)
            base += row[-1]
        row = np.concatenate([[0], *out]).astype(np.int64)
        if self.dummy and text:  # the added mark is no character of the text
            row = np.concatenate([[0], row[2:]])
        return row

    def longest_within(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most budget tokens."""
        return int(np.flatnonzero(self.prefix_counts(text) <= budget)[-1])

    def count(self, text: str) -> int:
        return sum(map(self._totals.__getitem__, self.units(self.normal(text))))

    def count_and_cut(self, text: str, budget: int) -> tuple[int, int]:
        """Tokens of the text, and the characters of its longest prefix within the budget."""
        units = self.units(self.normal(text))
        sums = list(accumulate(map(self._totals.__getitem__, units), initial=0))
        if sums[-1] <= budget:
            return sums[-1], len(text)
        # A unit's table can dip, never below 1: a prefix that ends in unit k has over sums[k] tokens.
        k = int(np.searchsorted(sums, budget, "left"))
        start = sum(map(len, units[:k])) - self.dummy
        while k:
            k -= 1
            start -= len(units[k])
            row = self.table(units[k])
            fit = [i for i, n in enumerate(row, 1) if sums[k] + n <= budget]
            if fit:
                return sums[-1], max(0, start + fit[-1])
        return sums[-1], 0


_made: dict[tuple[str, int], PrefixCounter] = {}


def made(name: str, model: bytes) -> PrefixCounter:
    if (key := (name, len(model))) not in _made:
        _made[key] = PrefixCounter(model)
    return _made[key]


def count_documents(docs: DataFrame, model: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and cut_chars, the characters of the longest prefix within limit.

    One narrow pass: no shuffle. Null and empty texts have 0 of each; repeated rows and null ids come back as
    they are; extra columns are not read.
    """
    spark = prepare(docs.sparkSession)
    with open(model, "rb") as f:
        blob = spark.sparkContext.broadcast(f.read())  # a fixed file of half a MB

    def work():
        counter = made(model, blob.value)

        def each(c: dict) -> dict:
            n = [counter.count_and_cut(t, limit) for t in c["text"]]
            return {"doc_id": c["doc_id"], "n_bytes": [len(t.encode()) for t in c["text"]], "n_tokens": [x for x, _ in n], "over_limit": [x > limit for x, _ in n], "cut_chars": [x for _, x in n]}

        return each

    return map_rows(texts(docs, id_col, text_col), work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_chars long")


def op8(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), 4096)
