"""Token counts by a byte-level BPE tokenizer of the tokenizers library.

Huge documents: overlap resynchronisation. The text is cut into chunks that overlap; each
chunk is encoded by the library with offsets and word numbers. A chunk that starts at a
proven boundary (the start of the text, or the last splice) is right up to a margin before
its end, as the pre-tokenizer's pattern matches from left to right and looks one character
ahead. A later chunk starts anywhere, so its first tokens may differ; the first place in
the overlap where both encodings begin a word is a common boundary, and from there on the
later chunk is right too, because what follows a word start depends on the text after it
only. There the two are spliced. If an overlap has no common boundary, it is widened to
twice its length, at last to the whole of the left chunk.

Other documents: a space after a sure non-space always begins a word of the pre-tokenizer,
so the text is cut there and the library's counts for the pieces are remembered in a
bounded memo.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.common import id_and_text, map_arrow

#: texts with more characters than this go by overlapping chunks of this length
CHUNK_CHARS = 65_536
#: first overlap of two chunks
OVERLAP_CHARS = 1_024
#: pieces remembered by a Python worker (two generations)
MEMO_PIECES = 400_000
#: longer pieces are encoded each time
MEMO_CHARS = 48


class TokenCounter:
    """Counts for one tokenizer file; ``splices`` and ``widened`` tell what the chunks did."""

    def __init__(self, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.chunk, self.overlap = chunk, overlap
        #: a boundary this near the end of a chunk isn't proven: an added token or the pattern may reach over the end
        self.margin = 2 + max([0, *(len(t.content) for t in self.lib.get_added_tokens_decoder().values())])
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.splices = self.widened = 0

    def count_plain(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def starts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Character where each word of the pre-tokenizer starts, and the number of its first token.
        An added token is a word of its own."""
        e = self.lib.encode(text, add_special_tokens=False)
        words = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
        offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
        first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.zeros(0, np.int64)
        return offsets[first, 0], first

    def count_huge(self, text: str) -> int:
        """Tokens of a text, by overlapping chunks."""
        total, at, n = 0, 0, len(text)
        while True:
            end = min(n, at + self.chunk)
            if end == n:
                return total + len(self.lib.encode(text[at:], add_special_tokens=False))
            left_at, left_first = self.starts(text[at:end])
            left_at = left_at + at
            overlap = self.overlap
            while True:
                begin = max(at + 1, end - overlap)
                right_at, _ = self.starts(text[begin:min(n, end + self.margin)])
                # a word start of the left chunk is proven if the next one is, too, before the margin
                proven = left_at[(left_at > begin) & (left_at < end - self.margin)]
                common = np.intersect1d(proven, right_at + begin)
                if len(common):
                    break
                if begin == at + 1:
                    return total + self.count_wider(text, at)
                overlap *= 2
                self.widened += 1
            cut = int(common[0])
            total += int(left_first[np.searchsorted(left_at, cut)])
            at = cut
            self.splices += 1

    def count_wider(self, text: str, at: int) -> int:
        """No boundary in a whole chunk: go on from its start with chunks of twice the length."""
        self.widened += 1
        wide = TokenCounter.__new__(TokenCounter)
        wide.__dict__ = self.__dict__ | {"chunk": 2 * self.chunk, "overlap": 2 * self.overlap}
        found = wide.count_huge(text[at:])
        self.splices, self.widened = wide.splices, wide.widened
        return found

    def pieces(self, text: str) -> list[str]:
        """The text cut before each space that follows a character which is surely no space."""
        parts = text.split(" ")
        if "  " not in text and all([p and p[-1] > " " and not p[-1].isspace() for p in parts]):
            return [parts[0], *[" " + p for p in parts[1:]]]
        out, open_ = [], ""
        for k, p in enumerate(parts):
            open_ += (" " if k else "") + p
            if p and p[-1] > " " and not p[-1].isspace():
                out.append(open_)
                open_ = ""
        return [*out, open_] if open_ else out

    def count_texts(self, texts: list[str | None]) -> list[int]:
        cut = [self.pieces(t) if t and len(t) <= self.chunk else [] for t in texts]
        young, old = self.young, self.old
        fresh, now = [], {}
        for w in {w for ws in cut for w in ws}:
            if w in young:
                continue
            if w in old:
                young[w] = old[w]
            else:
                fresh.append(w)
        for w, k in zip(fresh, self.count_plain(fresh), strict=True):
            if len(w) <= MEMO_CHARS:
                young[w] = k
            else:
                now[w] = k
        out = []
        for t, ws in zip(texts, cut, strict=True):
            if t and len(t) > self.chunk:
                out.append(self.count_huge(t))
            elif now:
                out.append(sum([young[w] if w in young else now[w] for w in ws]))
            else:
                out.append(sum([young[w] for w in ws]))
        if len(young) > MEMO_PIECES:
            self.old, self.young = young, {}
        return out


_counters: dict[tuple, TokenCounter] = {}


def count_tokens(df: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """Tokens of every whole text, as the library counts them without special tokens added.

    Returns ``id_col``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than
    ``limit``). Null counts as the empty text (0, 0, false). Repeated rows each give a row;
    other columns are left out; an empty table gives an empty result. No shuffle; a task
    holds one Arrow batch, and of a huge text the tokens of one chunk.
    """
    src = id_and_text(df, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer_path, chunk_chars, overlap_chars)
        if key not in _counters:
            _counters[key] = TokenCounter(*key)
        c = _counters[key]
        for b in batches:
            texts = b.column(1).to_pylist()
            n = np.array(c.count_texts(texts), np.int64)
            size = [len(t.encode("utf-8", "replace")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(n), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return map_arrow(src, run, f"`{id_col}` {src.schema['__id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
