"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For each byte prefix of a piece exactly one token can end the prefix's encoding. The coder stores
that token for every prefix: the candidates are the tokens that are suffixes of the prefix, and the
right one is the one that may follow the last token of what remains, a question about two tokens
alone whose answer is kept. An append extends the table; an edit keeps the table up to the piece
before it and from the first piece boundary after it.

Results equal those of the rank-merging encoder: a piece that is a token is that token, and any
other piece is the encoding whose neighbours are all compatible.

Defined cases: null text is the empty text, which has no tokens (the digest of nothing); special
token strings are ordinary text; texts of any length and repeated rows are encoded alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Texts' chunks and pieces whose encodings a worker keeps, and pairs of tokens whose compatibility it keeps.
CACHE_CHUNKS, CACHE_PIECES, CACHE_PAIRS = 500_000, 100_000, 1_000_000
#: Tables are kept of first bytes in steps of so many; the longest text that is kept.
HEAD_BYTES, LONGEST_KEPT = 4, 64
MARKS = ".,;:!?"
_NEVER = 1 << 60
_UNSAFE = re.compile(r"\s | \s")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Kept(dict):
    """Values by key, made where missing; of bounded size: when it is full, only what is used again stays."""

    def __init__(self, size: int, make):
        super().__init__()
        self.half, self.make, self.old = size // 2, make, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class PrefixCoder:
    """Encodes by a table of last tokens of prefixes; decodes by the vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.text_bytes = {str(r): t for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._pairs: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._splits: dict[int, tuple[int, int] | None] = {}
        self._heads = Kept(CACHE_PIECES, self.table)
        self._pieces = Kept(CACHE_PIECES, self._piece)
        #: Ids, as text, of a space and the word.
        self._words = Kept(CACHE_CHUNKS, self._word)

    def merge(self, piece: bytes, parts_left: int = 1) -> list[bytes]:
        """By definition: the adjacent pair whose union has the lowest rank merges first. Used on single tokens only."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        get = self.ranks.get
        while len(parts) > parts_left:
            low, at = min((get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if low == _NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the last merge that makes the token; None for a single byte or one that no merges make."""
        if token not in self._splits:
            raw = self.bytes_of[token]
            parts = self.merge(raw, 2)
            made = len(raw) > 1 and len(parts) == 2
            self._splits[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if made else None
            self._whole[token] = made or len(raw) == 1
        return self._splits[token]

    def reachable(self, token: int) -> bool:
        """Whether merging the token's bytes gives the token; only such tokens can stand beside others."""
        if token not in self._whole:
            self.split(token)
        return self._whole[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens as they are when they stand side by side.

        Goes back through both tokens' merges, the later one first: the tokens stay apart if at no time
        the parts on the two sides of the border could have merged before the merge that comes next.
        """
        key = left << 32 | right
        if (known := self._pairs.get(key)) is not None:
            return known
        if len(self._pairs) >= CACHE_PAIRS:
            self._pairs.clear()
        a, b, before, apart = left, right, _NEVER, True
        while True:
            # Of equal ranks the leftmost merges first: left of the border at its own rank, right of it after.
            if self.ranks.get(self.bytes_of[a] + self.bytes_of[b], _NEVER) < before:
                apart = False
                break
            sa, sb = self.split(a), self.split(b)
            if sa is None and sb is None:
                break
            if sb is None or (sa is not None and a > b):
                before, a = a, sa[1]
            else:
                before, b = b + 1, sb[0]
        self._pairs[key] = apart
        return apart

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """last[i] is the last token of the encoding of the first i + 1 bytes; goes on from where it stops."""
        ranks, pairs, compatible, longest = self.ranks.get, self._pairs.get, self.compatible, self.longest
        for end in range(len(last) + 1, len(piece) + 1):
            start = end - 1
            while start > 0:  # exactly one candidate is right, so the short ones, mostly right, come first
                token = ranks(piece[start:end])
                if token is not None:
                    known = pairs(last[start - 1] << 32 | token)
                    if (compatible(last[start - 1], token) if known is None else known) and self.reachable(token):
                        last.append(token)
                        break
                start = start - 1 if end - start < longest else -1
            else:
                token = ranks(piece[:end]) if start == 0 else None
                if token is None or not self.reachable(token):
                    raise ValueError("the vocabulary lacks single bytes")
                last.append(token)
        return last

    def table(self, piece: bytes) -> list[int]:
        """The table of a whole piece; goes on from that of its first bytes, which many pieces share."""
        head = (len(piece) - 1) // HEAD_BYTES * HEAD_BYTES
        if not head or head > LONGEST_KEPT:
            return self.extend(piece, [])
        return self.extend(piece, self._heads[piece[:head]].copy())

    def unwind(self, last: list[int]) -> list[int]:
        """The encoding, read from its end."""
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes_of[last[at - 1]])
        return out[::-1]

    def _piece(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8")
        whole = self.ranks.get(raw)
        return [whole] if whole is not None else self.unwind(self.table(raw))

    def _word(self, word: str) -> str:
        """Ids, as text, of a space and the word; a word of letters is one piece, a mark after it another."""
        if word.isalpha():
            return ",".join(map(str, self._piece(" " + word)))
        if word[-1:] in MARKS and (letters := word[:-1]).isalpha():
            return f"{self._words[letters]},{self.ranks[word[-1].encode()]}"
        return ",".join(map(str, self.encode(" " + word)))

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in self._pieces[piece]]

    def encode_joined(self, text: str) -> str:
        """The ids in decimal, joined by commas.

        A single space between two characters that are not white space always begins a piece, so a text
        without other spaces is cut there, and the encodings of the chunks are kept.
        """
        if not text:
            return ""
        if _UNSAFE.search(text):
            return ",".join(map(str, self.encode(text)))
        first, *rest = text.split(" ")
        ids = ",".join(map(self._words.__getitem__, rest))
        head = ",".join(map(str, self.encode(first)))
        return f"{head},{ids}" if head and ids else head + ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_joined(self, ids: str) -> bytes:
        return b"".join(map(self.text_bytes.__getitem__, ids.split(","))) if ids else b""


class EncodedText:
    """A text with its pieces' prefix tables; appends and edits encode only what they touch."""

    def __init__(self, coder: PrefixCoder, text: str = ""):
        self.coder, self.text = coder, ""
        self.pieces: list[tuple[str, list[int]]] = []
        self.edit(0, 0, text)

    def ids(self) -> list[int]:
        out = []
        for piece, last in self.pieces:
            whole = self.coder.ranks.get(piece.encode("utf-8"))
            out += [whole] if whole is not None else self.coder.unwind(last)
        return out

    def append(self, text: str) -> None:
        self.edit(len(self.text), len(self.text), text)

    def edit(self, start: int, end: int, text: str) -> None:
        """Puts text in the place of characters start to end."""
        old, new = self.pieces, self.text[:start] + text + self.text[end:]
        keep = at = 0
        # White space looks one character ahead, so the piece before the touched one is cut anew too.
        while keep < len(old) and at + len(old[keep][0]) < start:
            at += len(old[keep][0])
            keep += 1
        if keep:
            keep -= 1
            at -= len(old[keep][0])
        tail, where = {}, len(self.text)
        for k in range(len(old) - 1, keep - 1, -1):
            where -= len(old[k][0])
            if where < end:
                break
            tail[where - end + start + len(text)] = k
        fresh = []
        for m in self.coder.pattern.finditer(new, at):
            if m.start() in tail and m.start() > start + len(text):
                fresh += old[tail[m.start()] :]
                break
            piece = m.group()
            raw = piece.encode("utf-8")
            before = old[keep + len(fresh)] if keep + len(fresh) < len(old) else ("", [])
            common = 0
            for a, b in zip(piece, before[0], strict=False):
                if a != b:
                    break
                common += 1
            table = list(before[1][: len(piece[:common].encode("utf-8"))])
            fresh.append((piece, self.coder.extend(raw, table)))
        self.pieces, self.text = old[:keep] + fresh, new


@lru_cache(maxsize=2)
def _coder(path: str, pattern: str) -> PrefixCoder:
    return PrefixCoder(read_ranks(path), pattern)


_OUT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; with ids, the token ids too.

    vocabulary: a rank file of any place that the driver reads; executors get it by Spark's file distribution.
    """
    spark = docs.sparkSession
    prepare(spark)
    spark.sparkContext.addFile(vocabulary)
    name = vocabulary.rpartition("/")[2]
    schema = f"doc_id long, {_OUT}" + (", ids array<int>" if ids else "")
    kinds = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if ids:
        kinds.append(("ids", pa.list_(pa.int32())))
    arrow = pa.schema(kinds)

    def run(batches):
        coder = _coder(SparkFiles.get(name), pattern)
        for b in batches:
            rows = []
            for t in b.column(1):
                joined = coder.encode_joined(t.as_py() or "")
                n = joined.count(",") + 1 if joined else 0
                row = (n, hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(coder.decode_joined(joined)).hexdigest())
                rows.append((*row, list(map(int, joined.split(","))) if joined else []) if ids else row)
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds[1:]]
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(c, k) for c, (_, k) in zip(cols, kinds[1:], strict=True)], schema=arrow)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def op4(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


QUERIES = {"op4_bpe": op4}
