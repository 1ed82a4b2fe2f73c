"""Byte-level BPE by a monoid of encoded spans.

An encoded span is a list of token ids. Two neighbouring spans join by re-encoding a window of tokens around
their border. The window grows on a side for as long as its outermost token does not hold next to the token
left standing there. A token sequence is the encoding of its bytes if and only if every two neighbours are
the encoding of their own bytes, so once both rims hold, nothing outside the window can change. The join is
associative, so a span of any length is encoded as a balanced tree; decoding concatenates up such a tree.

Null and empty texts have no tokens. Every text is encoded whole; its pattern matches are separate spans.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Sequence
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame

from .common import MEMO, Memo, map_rows, prepare, texts

#: Bytes up to which a span is merged directly.
LEAF = 16


def parse_ranks(blob: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in blob.splitlines() if line)}


class TreeBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.by_name = {str(i): b for b, i in ranks.items()}
        self.find = regex.compile(pattern).findall
        self._holds: dict[tuple[int, int], bool] = {}
        self._named = Memo(lambda piece: " ".join(map(str, self.encode_span(piece.encode()))))

    def merge(self, raw: bytes) -> list[int]:
        """Lowest rank first, leftmost of equals: the definition, for short spans."""
        if (whole := self.ranks.get(raw)) is not None:
            return [whole]
        if len(raw) > 4 * LEAF:
            return self.merge_queued(raw)
        parts = [raw[i : i + 1] for i in range(len(raw))]
        get, none = self.ranks.get, 1 << 60
        pair = [get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while pair:
            low = min(pair)
            if low == none:
                break
            i = pair.index(low)
            parts[i] += parts.pop(i + 1)
            pair.pop(i)
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def merge_queued(self, raw: bytes) -> list[int]:
        """The same for long windows: pairs wait in a queue by rank and place, and those that are gone are passed over."""
        n, get = len(raw), self.ranks.get
        part: list[bytes | None] = [raw[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i) for i in range(n - 1) if (r := get(raw[i : i + 2])) is not None]
        heapify(queue)
        while queue:
            rank, i = heappop(queue)
            if part[i] is None or (j := after[i]) >= n or get(both := part[i] + part[j]) != rank:
                continue
            part[i], part[j], after[i] = both, None, after[j]
            if (k := after[i]) < n:
                before[k] = i
                if (r := get(both + part[k])) is not None:
                    heappush(queue, (r, i))
            if (h := before[i]) >= 0 and (r := get(part[h] + both)) is not None:
                heappush(queue, (r, h))
        return [self.ranks[p] for p in part if p is not None]

    def holds(self, a: int, b: int) -> bool:
        """Whether tokens a, b are the encoding of their own bytes."""
        if (known := self._holds.get((a, b))) is None:
            if len(self._holds) > MEMO:
                self._holds.clear()
            known = self._holds[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left or right
        if self.holds(left[-1], right[0]):
            return left + right
        i = j = 1  # tokens of either side inside the window
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            inner = self.merge(b"".join(map(self.bytes_of.__getitem__, left[len(left) - i :] + right[:j])))
            ok_left = i == len(left) or self.holds(left[-i - 1], inner[0])
            ok_right = j == len(right) or self.holds(inner[-1], right[j])
            if ok_left and ok_right:
                return left[: len(left) - i] + inner + right[j:]
            i, j = i if ok_left else 2 * i, j if ok_right else 2 * j

    def encode_span(self, raw: bytes) -> list[int]:
        if len(raw) <= LEAF:
            return self.merge(raw) if raw else []
        mid = len(raw) // 2
        return self.join(self.encode_span(raw[:mid]), self.encode_span(raw[mid:]))

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.find(text) for i in self.encode_span(piece.encode())]

    def encode_named(self, text: str) -> str:
        """Decimal ids joined by spaces; the spans of a text join by concatenation, as no token crosses a match."""
        return " ".join(map(self._named.__getitem__, self.find(text)))

    def decode(self, ids: Sequence[int]) -> bytes:
        return concatenated([self.bytes_of[i] for i in ids])

    def decode_named(self, ids: str) -> bytes:
        return concatenated(list(map(self.by_name.__getitem__, ids.split()))) if ids else b""


def concatenated(parts: list[bytes], fan: int = 256) -> bytes:
    """Bytes of token strings, joined level by level."""
    while len(parts) > 1:
        parts = [b"".join(parts[i : i + fan]) for i in range(0, len(parts), fan)]
    return parts[0] if parts else b""


_made: dict[tuple[str, int], TreeBPE] = {}


def made(name: str, blob: bytes, pattern: str) -> TreeBPE:
    """One encoder for each worker process and vocabulary."""
    if (key := (name + pattern, len(blob))) not in _made:
        _made[key] = TreeBPE(parse_ranks(blob), pattern)
    return _made[key]


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """doc_id, ids (space-joined decimals), decoded (text of the decoded bytes), n_tokens and both digests.

    One narrow pass: no shuffle. keep=False leaves the two long columns out. Null and empty texts give 0 tokens
    and the digests of nothing; repeated rows and null ids come back as they are; extra columns are not read.
    """
    spark = prepare(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        blob = spark.sparkContext.broadcast(f.read())  # a fixed file of under a MB

    def work():
        bpe = made(vocabulary, blob.value, pattern)

        def each(c: dict) -> dict:
            named = [bpe.encode_named(t) for t in c["text"]]
            raw = [bpe.decode_named(x) for x in named]
            out = {"doc_id": c["doc_id"], "n_tokens": [x.count(" ") + 1 if x else 0 for x in named]}
            out |= {"ids_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in named], "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in raw]}
            return out | ({"ids": named, "decoded": [x.decode() for x in raw]} if keep else {})

        return each

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string, decoded string" * keep
    return map_rows(texts(docs, id_col, text_col), work, schema)


def op5(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import read

    return encode_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=False)
