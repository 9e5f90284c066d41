"""Token counts: overlap resynchronisation for huge documents.

A text of up to ``chunk_chars`` code points is encoded in one piece. A longer one is cut into
chunks that overlap; each chunk is encoded with offsets, and neighbouring encodings are spliced
at a boundary that both show. Such a boundary is proven stable when

* it is a pre-token boundary of both encodings (merges never cross a pre-token, and the
  pre-token scan has no state but its position, so from a common boundary on both scans agree);
* it is a true boundary of the whole text on the left side: the left chunk was entered at a true
  boundary, and the boundary lies ``MARGIN`` code points before the cut, out of reach of the
  scanner's look-ahead and of a special string that the cut divides.

Where the overlap shows no such boundary (one pre-token longer than the overlap), the right
chunk is widened to the left, doubling the overlap, at most to the left chunk's last splice,
and the left chunk to the right when it holds no later boundary at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
MARGIN = 16
#: Pre-token counts a worker keeps (bounds its memory; later pre-tokens are encoded again).
CACHE_WORDS = 400_000

#: The pre-token pattern of byte-level vocabularies, and code points on which
#: all Unicode versions agree (other texts take the library's own splitting).
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
PLAIN = regex.compile(r"[\t\n\r\x20-\x7EÀ-ÖØ-öø-ſ]*+")


class TokenCounter:
    """Counts tokens of whole texts as ``Tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk_chars, overlap_chars
        if overlap_chars <= MARGIN or chunk_chars <= 2 * overlap_chars:
            raise ValueError("overlap must exceed the margin, and a chunk two overlaps")
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        counts = [0] * len(texts)
        whole: list[int] = []
        plain: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            if len(text) > self.chunk:
                counts[i] = self.count_huge(text)
            elif PLAIN.fullmatch(text) and not any(s in text for s in self.specials):
                plain.append((i, PRE_TOKEN.findall(text)))
            elif text:
                whole.append(i)
        if whole:
            got = self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)
            for i, e in zip(whole, got, strict=True):
                counts[i] = len(e)
        if plain:
            known = self.cache
            new = list({w for _, words in plain for w in words if w not in known})
            sizes = dict(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)),
                             strict=True))
            if len(known) + len(sizes) <= CACHE_WORDS:
                known.update(sizes)
            else:
                known = _Both(sizes, known)
            for i, words in plain:
                counts[i] = sum(map(known.__getitem__, words))
        return counts

    def boundaries(self, text: str, start: int, end: int) -> list[tuple[int, int]]:
        """(offset in ``text``, tokens before it in this chunk) of each pre-token boundary."""
        e = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        out, last = [], None
        for k, (word, (low, _)) in enumerate(zip(e.word_ids, e.offsets, strict=True)):
            if word != last:
                out.append((start + low, k))
                last = word
        out.append((end, len(e)))
        return out

    def count_huge(self, text: str) -> int:
        """Tokens of a text that is encoded in overlapping chunks."""
        n = len(text)
        start, end = 0, min(self.chunk, n)
        left = self.boundaries(text, start, end)
        total, entered, before = 0, 0, 0  # tokens up to ``entered``, which the left chunk shows after ``before``
        while end < n:
            overlap = self.overlap
            while True:
                begin = max(entered, end - overlap)
                stop = min(begin + self.chunk, n) if begin + self.chunk > end else min(end + self.chunk, n)
                right = self.boundaries(text, begin, stop)
                shown = {p: k for p, k in right if p > begin or begin == entered}
                splice = next(((p, k) for p, k in left if entered < p <= end - MARGIN and p in shown), None)
                if splice or begin == entered:
                    break
                overlap *= 2
            if splice is None:  # no boundary after ``entered`` in the left chunk: the right one replaces it
                left, end, before = right, stop, 0
                if stop < n and not any(entered < p <= stop - MARGIN for p, _ in right):
                    end = min(entered + 2 * (stop - entered), n)
                    left = self.boundaries(text, entered, end)
                continue
            at, tokens = splice
            total += tokens - before
            entered, before, left, end = at, shown[at], right, stop
        return total + left[-1][1] - before


class _Both:
    def __init__(self, first: dict[str, int], second: dict[str, int]):
        self.first, self.second = first, second

    def __getitem__(self, key: str) -> int:
        found = self.first.get(key)
        return self.second[key] if found is None else found


_counters: dict[tuple[str, int, int], TokenCounter] = {}


def counter(path: str, chunk_chars: int, overlap_chars: int) -> TokenCounter:
    """The worker's counter for a vocabulary file."""
    key = (path, chunk_chars, overlap_chars)
    if key not in _counters:
        _counters[key] = TokenCounter(*key)
    return _counters[key]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 token_limit: int = 512, chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    Null and empty texts have 0 bytes and 0 tokens; null ids and repeated rows are kept, one row
    out for each row in; other columns of ``docs`` are not read; an empty table gives no rows.
    ``tokenizer_path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(tokenizer_path, chunk_chars, overlap_chars)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(tool.count(texts), pa.int64())],
                    names=["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                         F.octet_length(text).cast("long").alias("n_bytes"))
    out = narrow.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > token_limit).alias("over_limit"))
