import random

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tidewatch.llm.piece_codec import PieceCodec, encode_decode
from tidewatch.llm.token_counts import TokenCounter, count_tokens

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [*"ab ▁ \n\t\0é日😀<>s/x0'́19 .,", "  ", "hello", "the ", "<|endoftext|>", "<s>", "ing", "　", "\x1c", "​", "\x85"]


def fuzz(seed, n, size):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randrange(size))) for _ in range(n)]


def test_codec_equals_library(docs, clashing, empty, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.ids, r.decoded, r.n_corrected) for r in encode_decode(clashing, PIECES).collect())
    want = sorted((i is None, i or 0, ids, sp.decode(ids), 0) for i, ids in ((i, sp.encode(t or "")) for i, t in texts))
    assert got == want
    assert encode_decode(empty, PIECES).count() == 0


def test_codec_fuzz_and_agendas_agree():
    c = PieceCodec(PIECES)
    strings = [*fuzz(1, 3000, 60), " ", "", "  ", "▁", "a " * 5]
    got = c.encode_texts(strings)
    want = c.lib.encode(strings)
    assert [np.frombuffer(g[0], np.int32).tolist() for g in got] == want
    assert [g[1] for g in got] == c.lib.decode(want)
    assert not any(g[2] for g in got)
    assert [c.decode(w) for w in want] == c.lib.decode(want)
    words = ["▁" + w for s in strings for w in c.words(s) if len(w) < 48]
    assert all(ids is None or ids == c.encode_symbols(w) for w, ids in zip(words, c.encode_many(words)))


def test_ids_come_from_the_agenda():
    """Without the right pairs the agenda gives other ids, which only the check sees and mends."""
    texts = ["the whole of the matter is a long story", "ünïcode strings, too"]
    right = PieceCodec(PIECES)
    assert [g[2] for g in right.encode_texts(texts)] == [0, 0]
    broken = PieceCodec(PIECES)
    broken.merged = broken.merged[::-1].copy()
    got = broken.encode_texts(texts)
    assert [g[2] for g in got] != [0, 0] and [g[0] for g in got] == [g[0] for g in right.encode_texts(texts)]
    unchecked = PieceCodec(PIECES)
    unchecked.merged = broken.merged

    class Agreeing:
        def encode(self, words, num_threads):
            many = unchecked.encode_many(["▁" + w for w in words])
            return [unchecked.encode_symbols("▁" + w) if ids is None else ids for w, ids in zip(words, many)]

    unchecked.lib = Agreeing()
    got = unchecked.encode_texts(texts)
    assert [g[2] for g in got] == [0, 0] and [g[0] for g in got] != [g[0] for g in right.encode_texts(texts)]
    assert [g[1] for g in got] != texts                        # the text is decoded from these ids


def test_counts_equal_library(docs, clashing, empty, texts):
    lib = Tokenizer.from_file(BYTES)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(clashing, BYTES, chunk_chars=5000, overlap_chars=64).collect())
    want = []
    for i, t in texts:
        n = len(lib.encode(t or "", add_special_tokens=False))
        want.append((i is None, i or 0, len((t or "").encode()), n, n > 512))
    assert got == sorted(want)
    assert count_tokens(empty, BYTES).count() == 0


def test_splices_and_widening():
    c = TokenCounter(BYTES, chunk=64, overlap=8)
    hard = ["a" * 1000, " " * 1000, "日" * 700, "1" * 999, "<|endoftext|>" * 100, "'s" * 300]
    for t in [*fuzz(2, 400, 900), *hard]:
        assert c.count_huge(t) == len(c.lib.encode(t, add_special_tokens=False))
    assert c.splices and c.widened
    strings = fuzz(3, 3000, 60)
    assert c.count_texts(strings) == [len(c.lib.encode(t, add_special_tokens=False)) for t in strings]
