"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps a score-ordered agenda of adjacent symbol pairs: the pair whose merged
piece has the highest score goes first, the leftmost among equals; a merge puts the two
new neighbour pairs on the agenda. The agenda of one string is a heap, whose entries are
skipped when their symbols have changed meanwhile; the agendas of many short words are the
rows of one numpy array, each row popped at its best entry once in a round. Symbols that
end outside the vocabulary fall back to byte pieces (or to the unknown piece where the
model has none).

If no piece holds the word mark after another character, merges never cross the start of
a word, so a text is cut there and the ids of a word are remembered in a bounded memo.
The ids of a text are those that the agenda gave its words, and its decoded text comes from
these ids. Every word that an Arrow batch adds to the memo is checked against the
sentencepiece library in that batch; a difference is counted in ``n_corrected``, and only
then the library's ids are taken.
"""

from __future__ import annotations

import gc
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.common import id_and_text, map_arrow

MARK = "▁"
#: words remembered by a Python worker (two generations of this size at most)
MEMO_WORDS = 200_000
#: longer words are encoded each time, by the heap
MEMO_CHARS = 48
#: priority of a pair that isn't on the agenda
NONE = np.int32(2**31 - 1)

SCHEMA = "{id} {id_type}, ids array<int>, decoded string, n_corrected long"


class PieceCodec:
    """Encoder and decoder for one model file."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.lib = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = sp.get_piece_size()
        special = [sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(size)]
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.rank = {p: (-sp.get_score(i), i) for i, p in enumerate(self.pieces) if not special[i]}
        self.unknown = sp.unk_id()
        self.byte_of = {i: int(p[3:5], 16) for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.of_byte = {b: i for i, b in self.byte_of.items()}
        self.control = {i for i in range(size) if sp.is_control(i)}
        #: ids from here on are plain pieces
        self.first_plain = 1 + max([-1, self.unknown, *self.byte_of, *self.control])
        self.cuts = not any(MARK in p.lstrip(MARK) for p in self.rank)
        self.plain = [p.replace(MARK, " ") for p in self.pieces]
        #: ids (int32 bytes) of words without their mark, and what these ids decode to
        self.young: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}
        self.pair_table()

    def pair_table(self) -> None:
        """Sorted keys of the id pairs that merge, with the place of their score and the merged id."""
        place = {s: k for k, s in enumerate(sorted({s for s, _ in self.rank.values()}))}
        rows = []
        for p, (score, i) in self.rank.items():
            for k in range(1, len(p)):
                left, right = self.rank.get(p[:k]), self.rank.get(p[k:])
                if left and right:
                    rows.append((left[1] * len(self.pieces) + right[1], place[score], i))
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.keys, self.order, self.merged = table[:, 0], table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)
        code = {ord(p): i for p, (_, i) in self.rank.items() if len(p) == 1}
        self.char_id = np.full(0x110000, -1, np.int32)
        self.char_id[list(code)] = list(code.values())

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Priority and merged id of id pairs; an id of -1 merges with nothing."""
        if not len(self.keys):
            return np.full(left.shape, NONE), np.full(left.shape, -1, np.int32)
        key = left.astype(np.int64) * len(self.pieces) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.order[at], NONE), np.where(hit, self.merged[at], np.int32(-1))

    def encode_many(self, words: list[str]) -> list[list[int] | None]:
        """Ids of short words, all at once; None for a word with a character outside the vocabulary."""
        out: list[list[int] | None] = [None] * len(words)
        size = np.array([len(w) for w in words])
        by_size = np.argsort(size, kind="stable")
        for part in np.array_split(by_size, range(4096, len(words), 4096)):
            width = int(size[part].max())
            chars = np.frombuffer("".join([words[i].ljust(width, "\0") for i in part]).encode("utf-32-le", "replace"), np.uint32).reshape(len(part), width)
            sym = self.char_id[chars]
            real = np.arange(width) < size[part][:, None]
            sym[~real] = -1
            whole = ~((sym < 0) & real).any(axis=1)
            part, sym = part[whole], sym[whole]
            n = size[part]
            if width > 1 and len(part):
                todo = np.arange(len(part))
                prio, into = self.pairs(sym[:, :-1], sym[:, 1:])
                cur, cols = sym.copy(), np.arange(width)
                while len(todo):
                    best = prio.argmin(axis=1)
                    row = np.arange(len(todo))
                    live = prio[row, best] != NONE
                    if not live.all():
                        done = todo[~live]
                        sym[done] = cur[~live]
                        todo, cur, prio, into, best = todo[live], cur[live], prio[live], into[live], best[live]
                        row = np.arange(len(todo))
                        if not len(todo):
                            break
                    cur[row, best] = into[row, best]
                    shift = np.minimum(cols + (cols > best[:, None]), width - 1)
                    cur = np.take_along_axis(cur, shift, axis=1)
                    cur[:, -1] = -1
                    move = np.minimum(cols[:-1] + (cols[:-1] > best[:, None]), width - 2)
                    prio, into = np.take_along_axis(prio, move, axis=1), np.take_along_axis(into, move, axis=1)
                    prio[:, -1] = NONE
                    n[todo] -= 1
                    inner = best < width - 1
                    r, b = row[inner], best[inner]
                    prio[r, b], into[r, b] = self.pairs(cur[r, b], cur[r, b + 1])
                    outer = best > 0
                    r, b = row[outer], best[outer] - 1
                    prio[r, b], into[r, b] = self.pairs(cur[r, b], cur[r, b + 1])
            for i, ids, k in zip(part.tolist(), sym.tolist(), n.tolist(), strict=True):
                out[i] = ids[:k]
        return out

    def symbols(self, text: str) -> str:
        """The text as the model sees it: word marks for spaces, one in front."""
        return MARK + text.replace(" ", MARK) if text else ""

    def encode_symbols(self, s: str) -> list[int]:
        """Ids of a marked string, by the agenda."""
        rank, n = self.rank, len(s)
        if n == 0:
            return []
        sym: list[str | None] = list(s)
        if n > 1:
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            agenda = []
            for i in range(n - 1):
                r = rank.get(s[i:i + 2])
                if r:
                    agenda.append((r[0], i, i + 1, 2))
            heapq.heapify(agenda)
            pop, push = heapq.heappop, heapq.heappush
            while agenda:
                _, a, b, size = pop(agenda)
                left, right = sym[a], sym[b]
                if left is None or right is None or after[a] != b or len(left) + len(right) != size:
                    continue
                sym[a] = left = left + right
                sym[b] = None
                c = after[a] = after[b]
                if c < n:
                    before[c] = a
                    r = rank.get(left + sym[c])
                    if r:
                        push(agenda, (r[0], a, c, size + len(sym[c])))
                p = before[a]
                if p >= 0:
                    r = rank.get(sym[p] + left)
                    if r:
                        push(agenda, (r[0], p, a, size + len(sym[p])))
        out: list[int] = []
        for x in sym:
            if x is None:
                continue
            r = rank.get(x)
            if r:
                out.append(r[1])
            elif self.of_byte:
                out.extend(self.of_byte[b] for b in x.encode("utf-8", "replace"))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def decode_marked(self, ids: list[int]) -> str:
        """Text of ids with the leading space of the first word still in place."""
        if ids and min(ids) >= self.first_plain:
            return "".join([self.plain[i] for i in ids])
        out: list[str] = []
        run = bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.control:
                out.append(self.pieces[i].replace(MARK, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.decode_marked(ids)
        return text[1:] if text.startswith(" ") else text

    def encode(self, text: str | None) -> list[int]:
        ids, _, _ = self.encode_texts([text])[0]
        return np.frombuffer(ids, np.int32).tolist()

    def words(self, text: str) -> list[str]:
        """The marked text cut where a word mark follows another character; each without its first mark."""
        if not text:
            return []
        if not self.cuts:
            return [self.symbols(text)[1:]]
        if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", self.symbols(text))]

    def encode_texts(self, texts: list[str | None]) -> list[tuple[bytes, str, int]]:
        """For each text: ids as int32 bytes, decoded text, words corrected by the check."""
        cut = [self.words(t or "") for t in texts]
        every: set[str] = set()
        for ws in cut:
            every.update(ws)
        young, old = self.young, self.old
        fresh = list(every - young.keys())
        if old:
            for w in fresh:
                if w in old:
                    young[w] = old[w]
            fresh = [w for w in fresh if w not in young]
        wrong = self.learn(fresh, later := {})
        found = {w: young[w] if w in young else later[w] for w in every} if later else young
        out = []
        for ws in cut:
            known = [found[w] for w in ws]
            # byte pieces never run across a word mark, so words decode one by one; the first mark goes
            text = "".join([k[1] for k in known])
            out.append((b"".join([k[0] for k in known]), text[1:] if text.startswith(" ") else text, len(wrong.intersection(ws)) if wrong else 0))
        if len(young) > MEMO_WORDS:
            self.old, self.young = young, {}
        return out

    def learn(self, fresh: list[str], later: dict[str, tuple[bytes, str]]) -> set[str]:
        """Encode new words by the agenda, check them against the library, decode their ids, and remember both: short ones
        in the memo, others in ``later``. Returns the words that the check corrected."""
        if not fresh:
            return set()
        fresh.sort(key=len)
        short = sum([len(w) < MEMO_CHARS for w in fresh])
        many = self.encode_many([MARK + w for w in fresh[:short]]) if short else []
        many = [self.encode_symbols(MARK + w) if ids is None else ids for w, ids in zip(fresh, [*many, *[None] * (len(fresh) - short)], strict=True)]
        # the library puts the first mark in front itself; it can't be given a lone mark, as an empty text has no ids
        want = self.lib.encode([w.replace(MARK, " ") for w in fresh], num_threads=1)
        if not fresh[0]:
            want[0] = many[0]
        wrong = {w for w, a, b in zip(fresh, many, want, strict=True) if a != b} if many != want else set()
        for w, ids, checked in zip(fresh, many, want, strict=True):
            ids = checked if w in wrong else ids
            (self.young if len(w) < MEMO_CHARS else later)[w] = array("i", ids).tobytes(), self.decode_marked(ids)
        return wrong


_codecs: dict[str, PieceCodec] = {}


def codec(model_path: str) -> PieceCodec:
    """One codec for each model in a Python worker."""
    if model_path not in _codecs:
        _codecs[model_path] = PieceCodec(model_path)
    return _codecs[model_path]


def encode_decode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode its ids again.

    Returns ``id_col``, ``ids`` (array of int), ``decoded`` (string) and ``n_corrected``
    (words where the check found another encoding than the agenda; 0 for every known
    model). Null counts as the empty text: no ids, empty string. Repeated rows each give a
    row; other columns of ``df`` are left out, whatever their names; an empty table gives
    an empty result. Long texts are worked on whole. No shuffle.
    """
    src = id_and_text(df, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        gc.disable()  # the memo's many entries have no cycles, and walking them over and over takes long
        try:
            for b in batches:
                texts = b.column(1).to_pylist()
                at, chars = 0, 0
                for k, t in enumerate(texts, 1):
                    chars += len(t or "")
                    if k == len(texts) or chars > 1_000_000:
                        got = c.encode_texts(texts[at:k])
                        ends = np.cumsum([0, *(len(x[0]) // 4 for x in got)]).astype(np.int32)
                        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join([x[0] for x in got]), np.int32)))
                        yield pa.RecordBatch.from_arrays([b.column(0).slice(at, k - at), ids, pa.array([x[1] for x in got], pa.string()), pa.array([x[2] for x in got], pa.int64())], names=[id_col, "ids", "decoded", "n_corrected"])
                        at, chars = k, 0
        finally:
            gc.enable()  # the worker's next task may make cycles

    return map_arrow(src, run, SCHEMA.format(id=f"`{id_col}`", id_type=src.schema["__id"].dataType.simpleString()))
